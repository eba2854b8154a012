"""Licence scan with a positional index of rare words.

The index holds, for each template, its key words by inverse document frequency over the
templates, with their positions. A text's words are coded once; where one of the rarest words of
a template's mandatory phrase stands, the posting's position proposes where the template would
begin, and postings that agree on that place are one candidate. A candidate counts if enough of
the template, weighted by frequency, stands at its relative positions and the mandatory phrase is
complete.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from exactnn.llm.arrow import id_and_text, slices, span_hashes, text_buffer


@dataclass(frozen=True)
class Template:
    """``words`` with the ``key`` phrase, which has to be there whole, and the share required."""

    label: str
    words: str
    key: str
    least: float = 0.8
    base: bool = False


# The phrases and labels of the base scan.
BASE_TEMPLATES = tuple(
    Template(label, phrase, phrase, 1.0, True)
    for phrase, label in (
        ("gnu general public license", "gpl"),
        ("apache license", "apache"),
        ("cc by", "cc-by"),
        ("mit license", "mit"),
    )
)

# Opening sentences and notices of public licences.
LICENCE_TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "except in compliance with the license",
    ),
    Template("gpl-2.0", "gnu general public license version 2", "gnu general public license version 2", 1.0),
    Template("gpl-3.0", "gnu general public license version 3", "gnu general public license version 3", 1.0),
    Template(
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        "gnu general public license as published by the free software foundation",
    ),
    Template(
        "lgpl",
        "gnu lesser general public license as published by the free software foundation",
        "gnu lesser general public license",
        0.4,
    ),
    Template("agpl", "gnu affero general public license", "gnu affero general public license", 1.0),
    Template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "permission is hereby granted free of charge to any person obtaining a copy",
        0.7,
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "redistribution and use in source and binary forms",
        0.7,
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "distribute this software for any purpose with or without fee is hereby granted",
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mozilla public license v 2 0",
        0.4,
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "unencumbered software released into the public domain",
    ),
    Template("cc-by-4.0", "cc by 4 0", "cc by 4 0", 1.0),
    Template("cc-by-sa-4.0", "cc by sa 4 0", "cc by sa 4 0", 1.0),
    Template("cc-by-nc-4.0", "cc by nc 4 0", "cc by nc 4 0", 1.0),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0", 0.6),
    Template("mit-notice", "licensed under the mit license", "under the mit license"),
)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
#: Rarest words of a mandatory phrase whose postings are intersected.
ANCHORS = 2


class RareTokenIndex:
    """Codes of the licence words, and the postings of each template's rarest mandatory words."""

    def __init__(self, templates: tuple[Template, ...]):
        self.templates = templates
        words = [t.words.split() for t in templates]
        seen = Counter(w for ws in words for w in set(ws))
        idf = {w: math.log((1 + len(words)) / n) for w, n in seen.items()}
        vocabulary = sorted(seen)
        data = np.frombuffer("".join(vocabulary).encode(), np.uint8)
        ends = np.cumsum([len(w.encode()) for w in vocabulary])
        hashes = span_hashes(data, np.append(0, ends[:-1]), ends)
        order = np.argsort(hashes)
        self._hashes = hashes[order]
        self._codes = order.astype(np.int16)
        code = {w: i for i, w in enumerate(vocabulary)}
        self.codes = [np.array([code[w] for w in ws], np.int16) for ws in words]
        self.weights = [np.array([idf[w] for w in ws]) for ws in words]
        self.mandatory: list[slice] = []
        #: code of a word -> (template, position) where it anchors
        self.postings: dict[int, list[tuple[int, int]]] = {}
        self.needed: list[int] = []  # anchors that have to agree on one place
        for t, template in enumerate(templates):
            key = template.key.split()
            at = next(i for i in range(len(words[t])) if words[t][i : i + len(key)] == key)
            self.mandatory.append(slice(at, at + len(key)))
            places = sorted(range(at, at + len(key)), key=lambda i, t=t: (-self.weights[t][i], i))[:ANCHORS]
            self.needed.append(len(places))
            for place in places:
                self.postings.setdefault(int(self.codes[t][place]), []).append((t, place))

    def code_words(self, hashes: np.ndarray) -> np.ndarray:
        """The code of each word, -1 for words of no template."""
        at = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
        return np.where(self._hashes[at] == hashes, self._codes[at], -1).astype(np.int16)

    def candidates(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(template, places where it would begin) on which all its anchors agree."""
        places = {}
        for code in self.postings:
            places[code] = np.flatnonzero(codes == code)
        begins: dict[int, list[np.ndarray]] = {}
        for code, posting in self.postings.items():
            for template, place in posting:
                begins.setdefault(template, []).append(places[code] - place)
        for template, lists in sorted(begins.items()):
            common = lists[0]
            for other in lists[1:]:
                common = np.intersect1d(common, other)
            if len(common):
                yield template, common

    def matches(self, codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(text, template, begin, share): verified places; words of text i are first[i]..last[i]."""
        found = []
        for t, begins in self.candidates(codes):
            template, own, weights = self.templates[t], self.codes[t], self.weights[t]
            key = self.mandatory[t]
            anchor = np.clip(begins + key.start, 0, len(codes) - 1)
            text = np.searchsorted(first, anchor, "right") - 1
            index = begins[:, None] + np.arange(len(own))
            inside = (index >= first[text][:, None]) & (index < last[text][:, None])
            same = inside & (codes[np.clip(index, 0, len(codes) - 1)] == own)
            share = same @ weights / weights.sum()
            good = same[:, key].all(axis=1) & (share >= template.least - 1e-9)
            for i in np.flatnonzero(good).tolist():
                found.append((int(text[i]), t, int(begins[i]), float(share[i])))
        return found


@functools.lru_cache(maxsize=4)
def _index(templates: tuple[Template, ...]) -> RareTokenIndex:
    return RareTokenIndex(templates)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in lower-cased ``data``, and the first word of each text."""
    inside = _WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    begins &= inside
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    closes[lasts] = inside[lasts]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def scan_licenses(
    docs: DataFrame,
    templates: tuple[Template, ...] = BASE_TEMPLATES + LICENCE_TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Licence phrases and notices in every row of ``docs``.

    Columns: doc_id, n_words, n_base (places of base phrases), first_word and last_word (their
    smallest and largest first word, from 0, null without any), base_labels, labels (both sorted,
    comma-joined; labels has those of all verified templates), score (0 without a match, nearer
    to 1 the longer and the more complete the best template is), matches (template label, first
    word, share). Letters A-Z are lower-cased. Null and empty texts have no words and no matches.
    Rows with null or equal ids, and repeated rows, are scanned each; of matches as good as each
    other the first counts. Other columns are not looked at, whatever their names; an empty table
    gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(templates)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            rows = len(offsets) - 1
            n_words = np.zeros(rows, np.int64)
            found: dict[int, list[tuple[int, int, float]]] = {}
            for a, b in slices(offsets):
                part = _LOWER[data[offsets[a] : offsets[b]]]
                starts, ends, bounds = _words(part, offsets[a : b + 1] - offsets[a])
                n_words[a:b] = np.diff(bounds)
                codes = index.code_words(span_hashes(part, starts, ends))
                filled = np.flatnonzero(np.diff(bounds))
                for text, t, begin, share in index.matches(codes, bounds[:-1][filled], bounds[1:][filled]):
                    row = int(filled[text])
                    found.setdefault(a + row, []).append((t, begin - int(bounds[row]), share))
            yield _result(batch, templates, n_words, found)

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string,"
        " labels string, score double, matches array<struct<label string, first_word long, share double>>",
    )


def _result(batch, templates, n_words, found) -> pa.RecordBatch:
    rows = len(n_words)
    base = [[] for _ in range(rows)]
    labels, base_labels, score = [""] * rows, [""] * rows, [0.0] * rows
    matches: list[list[dict]] = [[] for _ in range(rows)]
    for row, hits in found.items():
        hits.sort(key=lambda h: (h[1], h[0]))
        base[row] = [begin for t, begin, _ in hits if templates[t].base]
        base_labels[row] = ",".join(sorted({templates[t].label for t, _, _ in hits if templates[t].base}))
        labels[row] = ",".join(sorted({templates[t].label for t, _, _ in hits}))
        sizes = [(share, len(templates[t].words.split())) for t, _, share in hits]
        score[row] = max(share * n / (n + 2) for share, n in sizes)
        matches[row] = [{"label": templates[t].label, "first_word": b, "share": s} for t, b, s in hits]
    kind = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("share", pa.float64())]))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"), pa.array(n_words), pa.array([len(b) for b in base], pa.int64()),
            pa.array([min(b, default=None) for b in base], pa.int64()),
            pa.array([max(b, default=None) for b in base], pa.int64()),
            pa.array(base_labels), pa.array(labels), pa.array(score), pa.array(matches, kind),
        ],
        ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"],
    )
