"""The training-data pipeline: quality, near-duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
DataFrame, which is stored in the shared folder and read again for the next one. All but the last
return the columns of ``documents``; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exactnn.llm import bwt_dedup, byte_cnn, odd_minhash, pow2_packing, structural_secrets
from exactnn.session import materialize

#: 50 words of four bytes with their spaces; the gram that places strings in blocks.
PASSAGE_BYTES, PASSAGE_GRAM = 200, 80

#: SQL cannot express the trained network or the tokenizer; the tests compare with plain Python.
ORACLE_SQL = None


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network takes for good ones, row by row."""
    return byte_cnn.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five words, 0.8), the one of the smallest id.

    Groups are of texts, not of ids: rows without an id are linked like others, and of rows that
    repeat id and text one stays. Else the next stage would cut a text from all of its copies.
    """
    return odd_minhash.one_of_each(docs, shingle_words=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of PASSAGE_BYTES that stand more than once."""
    return _recounted(bwt_dedup.remove_repeats(docs, length=PASSAGE_BYTES, gram=PASSAGE_GRAM))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind."""
    return _recounted(structural_secrets.redact_secrets(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length with their token ids (four little-endian bytes each), a sequence each."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pow2_packing.pack(docs, path, keep_ids=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secrets", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the whole pipeline returns."""
    return run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
