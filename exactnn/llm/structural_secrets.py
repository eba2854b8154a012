"""Secret scan with structural confirmation.

Patterns only propose. Assignments, access keys and hex strings are reported by their patterns;
beyond them, base64 and hex strings are decoded and reported if what they hold is built like a
secret: a private key whose nested lengths add up, or a signed token with a readable header.
Base64 may be wrapped: lines of one length and a last one that is not longer, between breaks that
are real ones or, as in JSON and source code, written as backslash-n, with quotes and plus signs.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exactnn.llm.arrow import id_and_text, slices, text_buffer

#: In the order in which spans of equal start are listed.
KINDS = ("assign", "access", "hex", "key", "jwt")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_WORD = re.compile(rb"password|passwd|secret|token|api_?key|AKIA|eyJ|-----BEGIN ", re.IGNORECASE)
_CODED = re.compile(r"[A-Za-z0-9+/_-]{40,}")
#: What can stand between two lines of a wrapped string; possessive, so that it is read once.
_BETWEEN = r"""(?>\\++[nrt]?+|\s++|["'](?:\s*+\+(?=\s*+\\*+["']))?+)++"""
_GLUE = re.compile(_BETWEEN)
_NEXT_LINE = re.compile(rf"({_BETWEEN})([A-Za-z0-9+/_-]+)")
_BREAK = re.compile(r"[\r\n]|\\[nr]")
_PADDING = re.compile(r"={0,2}")
_NEXT_PADDING = re.compile(rf"({_BETWEEN})(={{1,2}})(?!=)")
_HEX_ANY = re.compile(r"[0-9a-fA-F]{80,}")
_PEM = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)(?=-----)")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")

_OPENSSH = b"openssh-key-v1\0"

_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[list(b"0123456789abcdefABCDEF")] = True
_CODED_BYTE = np.zeros(256, bool)
_CODED_BYTE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True
#: Shortest run of each class that any pattern can take.
_LEAST_HEX, _LEAST_CODED = 32, 40


def _der(raw: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, begin, end) of the DER value at ``at``, if its length fits before ``end``."""
    if at + 2 > end:
        return None
    size, begin = raw[at + 1], at + 2
    if size >= 0x80:
        count = size & 0x7F
        if not 1 <= count <= 4 or begin + count > end:
            return None
        size = int.from_bytes(raw[begin : begin + count], "big")
        begin += count
        if size < 0x80 or size >> (8 * (count - 1)) == 0:
            return None  # not the shortest form
    return (raw[at], begin, begin + size) if begin + size <= end else None


def _members(raw: bytes, begin: int, end: int) -> list[tuple[int, int, int]] | None:
    """The values that fill raw[begin:end] exactly; more than a key can have is none."""
    found = []
    while begin < end:
        value = _der(raw, begin, end)
        if value is None or len(found) > 12:
            return None
        found.append(value)
        begin = value[2]
    return found


def is_private_key(raw: bytes) -> bool:
    """Whether ``raw`` is a whole private key: RSA, DSA, EC, PKCS#8, its encrypted form, OpenSSH."""
    if raw.startswith(_OPENSSH):
        at, parts = len(_OPENSSH), 0
        while at + 4 <= len(raw) and parts < 3:  # cipher, key derivation and its options
            at += 4 + int.from_bytes(raw[at : at + 4], "big")
            parts += 1
        keys = int.from_bytes(raw[at : at + 4], "big") if at + 4 <= len(raw) else 0
        return parts == 3 and 1 <= keys <= 16
    outer = _der(raw, 0, len(raw))
    return outer is not None and outer[2] == len(raw) and _is_der_key(raw, outer)


def _is_der_key(raw: bytes, outer: tuple[int, int, int]) -> bool:
    """Whether ``outer``, a value in ``raw``, is a private key."""
    if outer[0] != 0x30:
        return False
    inner = _members(raw, outer[1], outer[2])
    if not inner:
        return False
    tags = [t for t, _, _ in inner]
    first = raw[inner[0][1] : inner[0][2]]
    if tags[0] == 0x02 and first in (b"\0", b"\1"):
        if len(tags) >= 9 and all(t == 0x02 for t in tags[:9]) or len(tags) == 6 and set(tags) == {0x02}:
            return True  # RSA, DSA
        if tags[1:2] == [0x04] and all(t in (0xA0, 0xA1) for t in tags[2:]):
            return first == b"\1" and inner[1][2] - inner[1][1] >= 16  # EC
        if tags[1:3] == [0x30, 0x04]:  # PKCS#8
            kind = _members(raw, inner[1][1], inner[1][2])
            return bool(kind) and kind[0][0] == 0x06 and inner[2][2] - inner[2][1] >= 16
    if tags == [0x30, 0x04]:  # encrypted PKCS#8
        kind = _members(raw, inner[0][1], inner[0][2])
        return bool(kind) and kind[0][0] == 0x06 and len(kind) == 2 and kind[1][0] == 0x30
    return False


def _decode(text: str) -> bytes | None:
    text = text.replace("-", "+").replace("_", "/").rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _der_key_end(raw: bytes, at: int) -> int | None:
    """Where the DER private key that begins at ``at`` ends, if one does."""
    outer = _der(raw, at, len(raw))
    if outer is None or not _is_der_key(raw, outer):
        return None
    return outer[2]


def _openssh_key_end(raw: bytes, at: int) -> int | None:
    """Where the OpenSSH private key that begins at ``at`` ends, if all of it is there."""
    at += len(_OPENSSH)
    for _ in range(3):
        at += 4 + int.from_bytes(raw[at : at + 4], "big")
    keys = int.from_bytes(raw[at : at + 4], "big")
    at += 4
    for _ in range(keys + 1):  # the public keys and the private part
        if at + 4 > len(raw):
            return None
        at += 4 + int.from_bytes(raw[at : at + 4], "big")
    return at if at <= len(raw) else None


def _coded_lines(text: str) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """(lines, end): each base64 run of 40 characters or more with the lines that go on with it.

    All lines but the last have the length of the first; ``end`` is behind the padding. A shorter
    last line can be the first of the next ones, so a run is in two of these at most.
    """
    at = 0
    while m := _CODED.search(text, at):
        start, end = m.span()
        if start and text[start - 1] == "\\" and text[start] in "nrt":
            start += 1  # of an escape
        lines = [(start, end)]
        while (n := _NEXT_LINE.match(text, end)) and _BREAK.search(n[1]):
            begin, after = n.span(2)
            if after - begin > lines[0][1] - start:
                break
            lines.append((begin, after))
            end = after
            if after - begin < lines[0][1] - start:
                break
        yield lines, _PADDING.match(text, end).end()
        last = lines[-1]
        at = last[0] if len(lines) > 1 and last[1] - last[0] < lines[0][1] - start else last[1]


def _coded_keys(text: str, lines: list[tuple[int, int]], end: int) -> Iterator[tuple[int, int]]:
    """Spans of the private keys that fill some of ``lines``, from one line to the same or a later one.

    The lines are decoded at most four times, once for each place of a line's start in a group of
    four characters; then a look at a few headers tells whether a key starts there, and how long it is.
    """
    width = lines[0][1] - lines[0][0]
    joined = "".join(text[a:b] for a, b in lines)
    decoded: dict[int, bytes] = {}
    first = 0
    for k in range(len(lines)):
        if k < first:
            continue
        skip = k * width % 4
        if skip not in decoded:
            part = joined[skip:]
            decoded[skip] = _decode(part[:-1] if len(part) % 4 == 1 else part) or b""
        raw, at = decoded[skip], (k * width - skip) // 4 * 3
        whole = False
        if raw.startswith(_OPENSSH, at):
            stop = _openssh_key_end(raw, at)
            whole = stop is None and is_private_key(raw[at:])
        else:
            stop = _der_key_end(raw, at)
        last = None
        if stop is not None:
            size = k * width + -(-(stop - at) * 4 // 3)
            if size == len(joined):
                last = len(lines) - 1
            elif size % width == 0:
                last = size // width - 1
        if last is None and (whole or stop is not None and raw.startswith(_OPENSSH, at)):
            last = len(lines) - 1  # cut off, or with more behind it
        if last is not None:
            first = last + 1
            yield lines[k][0], _padded(text, lines[last][1], end, -(len(joined) - k * width) % 4) if first == len(lines) else lines[last][1]


def _padded(text: str, last: int, end: int, size: int) -> int:
    """``end``, or behind the rest of ``size`` signs of padding if a break parts them from ``last``."""
    m = _NEXT_PADDING.match(text, end)
    return m.end() if m and _BREAK.search(m[1]) and end - last + len(m[2]) == size else end


def is_signed_token(token: str) -> bool:
    """Whether header and claims of header.claims.signature are JSON objects, with an algorithm."""
    parts = token.split(".")
    if len(parts) != 3:
        return False
    try:
        header, claims = (json.loads(_decode(p) or b"") for p in parts[:2])
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(claims, dict):
        return False
    algorithm = header.get("alg")
    return isinstance(algorithm, str) and (bool(parts[2]) or algorithm.lower() == "none")


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _within(spans: list[tuple[int, int]], at: int) -> bool:
    """Whether ``at`` is in one of the disjoint, ascending ``spans``."""
    k = bisect.bisect_right(spans, (at, len(spans) and spans[-1][1])) - 1
    return k >= 0 and at < spans[k][1]


def _pem_keys(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the private keys between BEGIN and END lines of one label, of any length.

    An END belongs to the last BEGIN before it, so that no two bodies overlap and each is read once.
    """
    begin = None
    for m in _PEM.finditer(text):
        if m[1] == "BEGIN":
            begin = m
        elif begin and begin[2] == m[2]:
            body = _GLUE.sub("", text[begin.end() + 5 : m.start()])
            if body and (raw := _decode(body)) and is_private_key(raw):
                yield begin.start(), m.end() + 5
            begin = None


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text) if len(m[0]) >= 32]
    keys = list(_pem_keys(text))
    pems = _merged(keys)
    coded = [s for lines, end in _coded_lines(text) for s in _coded_keys(text, lines, end)]
    coded = sorted({s for s in coded if not _within(pems, s[0])})
    keys += coded
    pems = _merged(keys)
    for m in _HEX_ANY.finditer(text):
        if not _within(pems, m.start()) and (raw := _unhex(m[0])) and is_private_key(raw):
            keys.append(m.span())
    found += [("key", a, b) for a, b in keys]
    found += [("jwt", m.start(), m.end()) for m in _JWT.finditer(text) if is_signed_token(m[0])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _unhex(text: str) -> bytes | None:
    return bytes.fromhex(text) if len(text) % 2 == 0 else None


def _suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that can hold a match of any pattern."""
    suspect = np.zeros(len(offsets) - 1, bool)
    hits = [at for m in _WORD.finditer(data.tobytes()) for at in (m.start(), m.end() - 1)]
    for member, least in ((_HEX_BYTE, _LEAST_HEX), (_CODED_BYTE, _LEAST_CODED)):
        inside = np.concatenate([[0], member[data].view(np.int8), [0]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        hits.extend(edges[0::2][edges[1::2] - edges[0::2] >= least].tolist())
    suspect[np.searchsorted(offsets, hits, "right") - 1] = True
    # a run of text may span rows here: then every row it touches is looked at
    for member, least in ((_HEX_BYTE, _LEAST_HEX), (_CODED_BYTE, _LEAST_CODED)):
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        crossed = inner[member[data[inner]] & member[data[inner - 1]]]
        suspect[np.searchsorted(offsets, crossed, "right") - 1] = True
    return suspect


def _per_row(batch: pa.RecordBatch, name: str):
    """(row, text, spans) of the rows that have any."""
    column = batch.column(name)
    data, offsets = text_buffer(column)
    for first, last in slices(offsets):
        suspect = _suspects(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        for row in (first + np.flatnonzero(suspect)).tolist():
            text = data[offsets[row] : offsets[row + 1]].tobytes().decode()
            if spans := find_secrets(text):
                yield row, text, spans


_SPANS = "array<struct<kind string, start long, end long>>"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end) of every row, ordered by start and then kind.

    Places are code points, ends exclusive. Null and empty texts, and texts without a secret, have
    an empty list. Each row is scanned whole and by itself, also repeated rows and rows with null
    or equal ids. Other columns are not looked at, whatever their names; an empty table gives an
    empty one.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for row, _, found in _per_row(batch, "text"):
                spans[row] = [{"kind": k, "start": a, "end": b} for k, a, b in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"]
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id long, spans {_SPANS}")


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret of ``text_col`` replaced by ``[kind]``; all rows stay.

    Overlapping spans are replaced together, under the kind that comes first. Null stays null,
    empty texts stay empty, an empty table stays empty; repeated rows are changed alike, and
    columns may have any names.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            changed = {row: _redact(text, spans) for row, text, spans in _per_row(batch, text_col)}
            if changed:
                texts = batch.column(at).to_pylist()
                for row, text in changed.items():
                    texts[row] = text
                columns = batch.columns
                columns[at] = pa.array(texts, batch.column(at).type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(run, docs.schema)


def _redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def span_list(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    part = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.concat_ws(",", part)


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, counts of the three plain kinds, the hash of their list, and the list of all."""
    plain = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size("spans") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in ("assign", "access", "hex")
    ]
    return scanned.select(
        "doc_id", *counts, F.sha2(span_list(plain), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )
