"""A table of vectors that texts were given before, so that a stopped or repeated run goes on.

Vectors are kept by the hash of their text, by model, role and width. Texts that have none yet go to
the model, each distinct one once; the rest is a join. What a run makes is appended as whole files, so
a run that ends early keeps what its finished jobs stored.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from exactnn.operators.embed import MAX_CHUNK, Factory, embed_text
from exactnn.operators.joins import keyed_filter

SCHEMA = "text_hash binary, vector array<float>, embedded boolean"


def text_hash(text: Column | str) -> Column:
    """SHA-256 of a text; a null text has that of the empty one."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


class VectorStore:
    """Vectors under ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")

    def _folder(self, model: str, role: str | None, dim: int, packed: int) -> str:
        return f"{self._path}/{quote(model, safe='')}-{role or 'any'}-{dim // packed}"

    def vectors(self, model: str, role: str | None, dim: int, packed: int = 1) -> DataFrame:
        """(text_hash, vector, embedded) that are stored, one row for each text."""
        try:
            found = self._spark.read.schema(SCHEMA).parquet(self._folder(model, role, dim, packed))
        except AnalysisException:
            return self._spark.createDataFrame([], SCHEMA)
        # two runs at a time may have made the same text
        return found.dropDuplicates(["text_hash"])

    def add(self, df: DataFrame, text: str, factory: Factory, dim: int, *, model: str, role: str | None = None,
            chunk: int = MAX_CHUNK, packed: int = 1, retry: bool = False) -> None:
        """Store vectors of the texts of ``df`` that have none. ``retry`` asks again for those that failed."""
        known = self.vectors(model, role, dim, packed)
        if retry:
            known = known.where("embedded")
        texts = df.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
        # distinct texts are found where they lie, before anything is moved
        texts = texts.withColumn("text_hash", text_hash("text")).groupBy("text_hash").agg(F.first("text").alias("text"))
        new = keyed_filter(texts, known.select("text_hash"), "text_hash", "text_hash", "left_anti")
        made = embed_text(
            new, "text", factory, dim, model=model, role=role, chunk=chunk, output="vector", packed=packed,
            flag="embedded", bisect=True,
        ).select("text_hash", "vector", "embedded")
        if retry:
            made = made.where("embedded")
        made.write.mode("append").parquet(self._folder(model, role, dim, packed))

    def embed(self, df: DataFrame, text: str, factory: Factory, dim: int, *, model: str, role: str | None = None,
              chunk: int = MAX_CHUNK, packed: int = 1, output: str = "embedding", flag: str | None = None) -> DataFrame:
        """``df`` with one vector for each text, from the store; missing ones are made and stored first.

        Only texts that fail by themselves have zero vectors; ``flag`` names a column that is false
        for them. All rows stay, also those that repeat a text; a null text is an empty one.
        """
        self.add(df, text, factory, dim, model=model, role=role, chunk=chunk, packed=packed)
        key = "_hash"
        while key in df.columns:
            key = "_" + key
        stored = self.vectors(model, role, dim, packed).select(
            F.col("text_hash").alias(key), F.col("vector").alias(f"{key}v"), F.col("embedded").alias(f"{key}e")
        )
        joined = df.withColumn(key, text_hash(text)).join(stored, key)
        made = {output: F.col(f"{key}v")} | ({flag: F.col(f"{key}e")} if flag else {})
        return joined.withColumns(made).drop(key, f"{key}v", f"{key}e")
