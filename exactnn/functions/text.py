"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What ends a sentence, also where no blank follows, and what counts as blank at either end of one.
SENTENCE_END = ".!?。！？…"
WIDE_END = "。！？"
BLANKS = " \t\n\r\f\v"

DEFAULT_MODEL = "text-embedding-ada-002"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentences(text: Column | str) -> Column:
    """Split after an end mark followed by white space; trim; drop empties.

    After the wide marks, which are written without blanks, any text but a further mark may follow.
    """
    wide = rf"(?<=[{WIDE_END}])(?![{SENTENCE_END}\s])"
    parts = F.split(_col(text), rf"(?<=[{SENTENCE_END}])\s+|{wide}")
    trimmed = F.transform(parts, lambda s: F.btrim(s, F.lit(BLANKS)))
    return F.filter(trimmed, lambda s: F.length(s) > 0)


def explode_sentences(df: DataFrame, text: str, position: str = "sent_idx") -> DataFrame:
    """One row per sentence: the parent's columns, the sentence in place of the text."""
    others = [c for c in df.columns if c != text]
    exploded = df.select(*others, F.posexplode(sentences(text)).alias(position, text))
    return exploded.select(*df.columns, position)


def normalise_title(title: Column | str) -> Column:
    return F.translate(_col(title), "_", " ")


def model_input(text: Column | str, model: str) -> Column:
    """Text as the model wants it: the e5 family takes a ``query:`` prefix."""
    return F.concat(F.lit("query:"), _col(text)) if "e5" in model else _col(text)


def model_prefix(model: Column | str) -> Column:
    """Model name as part of a path, for a column of names."""
    return F.coalesce(
        F.translate(F.when(F.length(_col(model)) > 0, _col(model)), "/", "_"),
        F.lit(DEFAULT_MODEL),
    )
