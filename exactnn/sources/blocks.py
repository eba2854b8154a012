"""Positional block files of partial neighbour lists.

A search over one block of the base leaves two Parquet files in the run folder, ``indices<block>``
and ``distances<block>``, with a column for each of the k places and a row for each query: the row
position is the query. Spark names the files that it writes itself, so they are written by a data
source of their own. A block's files come from one task, which streams its rows; they are moved to
their names on commit, the distances first, so that an index file always has its partner.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from exactnn.operators.knn import RESULT_SCHEMA
from exactnn.operators.topk import merge_lists
from exactnn.sources.tables import read_blocks
from exactnn.sources.xvec import _clear, _shared, open_path

BLOCK_SCHEMA = "block_id int, query_id long, neighbors array<long>, distances array<double>"
#: Written first and last.
KINDS = ("distances", "indices")
GROUP_ROWS = 64_000
#: A row number column that files of older runs have.
ROW_NUMBER = "RowNum"


@dataclass
class _Blocks(WriterCommitMessage):
    folder: str
    blocks: list[int]


class BlockWriter(DataSourceArrowWriter):
    """Rows come by block, then by query."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.k = options["path"], int(options["k"])
        self.numbered = options.get("rownum", "false") == "true"
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex

    def _temporary(self) -> str:
        return f"{self.path.rstrip('/')}/_temporary-{self.job}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Blocks:
        from pyspark import TaskContext

        context = TaskContext.get()
        system, root = open_path(f"{self._temporary()}/{context.partitionId()}-{context.taskAttemptId()}")
        system.create_dir(root, recursive=True)
        done: list[int] = []
        current, files, row = None, {}, 0
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if blocks[a] != current:
                    for file in files.values():
                        file.close()
                    current, row = int(blocks[a]), 0
                    done.append(current)
                    files = {kind: pq.ParquetWriter(f"{root}/{kind}{current}.parquet", self._schema(kind), filesystem=system) for kind in KINDS}
                part = batch.slice(a, b - a)
                queries = part.column(1).to_numpy()
                if (queries != np.arange(row, row + len(queries))).any():
                    raise ValueError(f"block {current}: queries have to be positions, each once")
                for kind, column in zip(KINDS, (part.column(3), part.column(2))):
                    files[kind].write_table(self._wide(kind, column, row), row_group_size=GROUP_ROWS)
                row += len(queries)
        for file in files.values():
            file.close()
        return _Blocks(root, done)

    def _schema(self, kind: str) -> pa.Schema:
        element = pa.int64() if kind == "indices" else pa.float64()
        fields = [pa.field(str(i), element) for i in range(self.k)]
        return pa.schema([*fields, *([pa.field(ROW_NUMBER, pa.int64())] if self.numbered else [])])

    def _wide(self, kind: str, lists: pa.Array, first: int) -> pa.Table:
        """One column for each place; a shorter list leaves the last ones null."""
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        if lists.null_count or (len(sizes) and sizes.max() > self.k):
            raise ValueError(f"a list is null or longer than {self.k}")
        flat, starts = lists.flatten(), np.cumsum(sizes) - sizes
        columns = []
        for place in range(self.k):
            has = sizes > place
            columns.append(flat.take(pa.array(np.where(has, starts + place, 0), mask=~has)))
        if self.numbered:
            columns.append(pa.array(np.arange(first, first + len(sizes))))
        return pa.Table.from_arrays(columns, schema=self._schema(kind))

    def commit(self, messages: list[_Blocks | None]) -> None:
        system, path = open_path(self.path)
        written = {}
        for message in messages:
            for block in message.blocks if message else ():
                if block in written:
                    raise ValueError(f"block {block} is dealt to two tasks")
                written[block] = message.folder
        if not self.overwrite:
            there = [b for b in written if system.get_file_info(f"{path}/indices{b}.parquet").type != fs.FileType.NotFound]
            if there:
                _clear(*open_path(self._temporary()))
                raise FileExistsError(f"blocks {there} are already in {self.path}")
        for block, folder in sorted(written.items()):
            for kind in KINDS:
                system.move(f"{folder}/{kind}{block}.parquet", f"{path}/{kind}{block}.parquet")
        _clear(*open_path(self._temporary()))

    def abort(self, messages: list[_Blocks | None]) -> None:
        _clear(*open_path(self._temporary()))


class BlockSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "knnblocks"

    def schema(self) -> str:
        return BLOCK_SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> BlockWriter:
        return BlockWriter(dict(self.options), overwrite)


def write_blocks(lists: DataFrame, folder: str, k: int, row_number: bool = False, mode: str = "append") -> None:
    """Write (block_id, query_id, neighbors, distances) as block files of k places in ``folder``.

    ``query_id`` is a position: 0, 1, ... in each block. Lists shorter than k are filled with nulls.
    ``mode`` append refuses blocks that are there, overwrite replaces those blocks and no others.
    """
    spark = lists.sparkSession
    _shared(spark, folder)
    spark.dataSource.register(BlockSource)
    rows = lists.select(
        F.col("block_id").cast("int").alias("block_id"), F.col("query_id").cast("long").alias("query_id"),
        F.col("neighbors").cast("array<long>").alias("neighbors"), F.col("distances").cast("array<double>").alias("distances"),
    )
    placed = rows.repartition("block_id").sortWithinPartitions("block_id", "query_id")
    placed.write.format("knnblocks").mode(mode).options(k=k, rownum=str(row_number).lower()).save(folder)


def block_lists(spark: SparkSession, folder: str) -> DataFrame:
    """(block_id, query_id, neighbors, distances) of the block files, paired by row position.

    The places are taken by their order, whatever the columns are called; RowNum and places without
    a neighbour are dropped. An index row without distances, or the other way round, ends the job that reads it.
    """
    sides = []
    for kind, name, element in (("indices", "neighbors", "long"), ("distances", "distances", "double")):
        wide = read_blocks(spark, folder, kind)
        places = [c for c in wide.columns if c not in ("block_id", "query_id")]
        packed = F.filter(F.array(*[F.col(f"`{c}`").cast(element) for c in places]), lambda x: x.isNotNull())
        sides.append(wide.select("block_id", "query_id", packed.alias(name)))
    both = sides[0].join(sides[1], ["block_id", "query_id"], "full")
    whole = F.col("neighbors").isNotNull() & F.col("distances").isNotNull() & (F.size("neighbors") == F.size("distances"))
    lost = F.raise_error(F.concat(F.lit("unpaired row in block "), F.col("block_id")))
    checked = F.when(whole, F.col("neighbors")).otherwise(lost.cast("array<long>"))
    return both.select("block_id", "query_id", checked.alias("neighbors"), "distances")


def merge_blocks(spark: SparkSession, folder: str, k: int, decimals: int | None = None) -> DataFrame:
    """The k nearest over all blocks in ``folder``: (query_id, rank, base_id, distance)."""
    lists = block_lists(spark, folder).select("query_id", F.col("neighbors").alias("base_ids"), "distances")
    together = lists.repartition("query_id").sortWithinPartitions("query_id")
    return together.mapInArrow(merge_lists(k, decimals), RESULT_SCHEMA)


def block_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(block_id, kind, row_count, places) of the files, places being non-null neighbours."""
    found = None
    for kind in sorted(KINDS):
        df = read_blocks(spark, folder, kind)
        places = [c for c in df.columns if c not in ("block_id", "query_id")]
        filled = sum((F.col(f"`{c}`").isNotNull().cast("long") for c in places), F.lit(0).cast("long"))
        part = df.groupBy("block_id").agg(F.count("*").alias("row_count"), F.sum(filled).alias("places"))
        part = part.select("block_id", F.lit(kind).alias("kind"), "row_count", "places")
        found = part if found is None else found.unionByName(part)
    return found
