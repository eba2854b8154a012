"""``fvec`` and ``ivec`` files as Spark data sources.

A record is a little-endian int32 dimension followed by that many little-endian float32 (fvec)
or int32 (ivec) values; all records of a dataset have the same dimension. A dataset is one file,
or a folder of part files whose concatenation in name order is that file.

Reading gives ``idx`` (record number from 0) and ``vector``. Tasks read byte ranges cut at
record borders. The options ``start``, ``end`` and ``records`` (numbers, comma-joined) choose what is
read: a run of wanted records is a slice, and nothing else is opened or read. They are options and
no pushed filters, as Spark 4.1.2 plans all scans of a DataFrame by the filters of one. Writing is one part file per task, moved into place on commit; or, with
``layout=single`` on a shared POSIX file system, one file that all tasks write at their own
offsets (``idx`` has to be dense). Either way a task that is repeated writes the same bytes.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from exactnn.session import MIB, range_partitioned

# Format -> (element type on disk, Spark type, Arrow type).
FORMATS = {
    "fvec": (np.dtype("<f4"), "float", pa.float32()),
    "ivec": (np.dtype("<i4"), "int", pa.int32()),
}
SPLIT_BYTES = 128 * MIB
READ_BYTES = 8 * MIB
DONE = "_SUCCESS"  # marks a folder whose parts are complete
MAX_SPLITS = 50_000  # bounds the list of splits the driver plans


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path[len("file:"):]
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), os.path.abspath(path)


@dataclass
class Slice(InputPartition):
    """A run of records in one file."""

    file: str
    byte: int
    records: int
    first_idx: int
    dim: int


class XvecReader(DataSourceReader):
    def __init__(self, kind: str, options: dict):
        self.kind, self.path = kind, options["path"]
        self.start = int(options.get("start", 0))
        self.end = int(options["end"]) if "end" in options else None
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        named = options.get("records")
        self.wanted = None if named is None else sorted({int(i) for i in named.split(",") if i.strip()})

    def _runs(self, low: int, high: int) -> Iterator[tuple[int, int]]:
        """The wanted records from ``low`` to ``high``, as ranges."""
        if self.wanted is None:
            yield low, high
            return
        own = [i for i in self.wanted if low <= i < high]
        first = 0
        for at in range(1, len(own) + 1):
            if at == len(own) or own[at] != own[at - 1] + 1:
                yield own[first], own[at - 1] + 1
                first = at

    def partitions(self) -> list[Slice]:
        system, path = open_path(self.path)
        slices: list[Slice] = []
        stride, seen = 0, 0
        files = _data_files(system, path, self.kind)
        split = max(self.split, sum(f.size for f in files) // MAX_SPLITS)
        for info in files:
            if not stride:
                with system.open_input_file(info.path) as f:
                    dim = int(np.frombuffer(f.read(4), "<i4")[0])
                stride = 4 * (1 + dim)
            if info.size % stride:
                raise ValueError(f"{info.path}: size is not a multiple of {stride} bytes")
            rows = info.size // stride
            step = max(1, split // stride)
            last = seen + rows if self.end is None else min(seen + rows, self.end)
            for low, high in self._runs(max(self.start, seen), last):
                for at in range(low, high, step):
                    slices.append(Slice(info.path, (at - seen) * stride, min(step, high - at), at, dim))
            seen += rows
        return slices or [Slice("", 0, 0, 0, 0)]

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        element, _, arrow = FORMATS[self.kind]
        if not part.records:
            return
        system, _ = open_path(self.path)
        stride = 4 * (1 + part.dim)
        step = max(1, READ_BYTES // stride)
        with system.open_input_file(part.file) as f:
            f.seek(part.byte)
            for at in range(0, part.records, step):
                n = min(step, part.records - at)
                raw = np.frombuffer(f.read(n * stride), "<i4").reshape(n, 1 + part.dim)
                if (raw[:, 0] != part.dim).any():
                    raise ValueError(f"{part.file}: records differ in dimension")
                flat = np.ascontiguousarray(raw[:, 1:]).view(element).ravel()
                offsets = np.arange(n + 1, dtype=np.int32) * part.dim
                vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, arrow))
                idx = pa.array(np.arange(n, dtype=np.int64) + part.first_idx + at)
                yield pa.RecordBatch.from_arrays([idx, vectors], names=["idx", "vector"])


def _data_files(system: fs.FileSystem, path: str, kind: str) -> list[fs.FileInfo]:
    info = system.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [info] if info.size else []
    found = system.get_file_info(fs.FileSelector(path))
    parts = [i for i in found if i.type == fs.FileType.File and i.base_name.endswith(f".{kind}")]
    return sorted((i for i in parts if i.size), key=lambda i: i.base_name)


@dataclass
class Written(WriterCommitMessage):
    partition: int
    temporary: str
    rows: int
    dim: int
    powers: tuple[int, ...] = ()  # sums of idx, its square and its cube


class XvecWriter(DataSourceArrowWriter):
    def __init__(self, kind: str, options: dict, schema: StructType, overwrite: bool):
        self.kind, self.path, self.overwrite = kind, options["path"], overwrite
        self.single = options.get("layout", "parts") == "single"
        self.job = uuid.uuid4().hex
        names = schema.fieldNames()
        self.vector = names.index("vector")
        self.idx = names.index("idx") if "idx" in names else None
        if self.single and self.idx is None:
            raise ValueError("layout=single needs a dense idx column")

    def _temporary(self) -> str:
        return f"{self.path.rstrip('/')}.tmp-{self.job}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        number, attempt = context.partitionId(), context.taskAttemptId()
        rows, dim = 0, 0
        if self.single:
            powers = [0, 0, 0]
            for records, idx in self._records(batches):
                dim = self._same(dim, records.shape[1] - 1)
                self._place(records, idx)
                rows += len(records)
                places = idx.tolist()
                for i in range(3):
                    powers[i] += sum(x ** (i + 1) for x in places)
            return Written(number, "", rows, dim, tuple(powers))
        system, root = open_path(self._temporary())
        system.create_dir(root, recursive=True)
        name = f"{root}/part-{number:08d}-{attempt}.{self.kind}"
        with system.open_output_stream(name) as out:
            for records, _ in self._records(batches):
                dim = self._same(dim, records.shape[1] - 1)
                out.write(records.tobytes())
                rows += len(records)
        return Written(number, name, rows, dim)

    @staticmethod
    def _same(known: int, found: int) -> int:
        if known and known != found:
            raise ValueError(f"vectors of {known} and of {found} components in one dataset")
        return found

    def _records(self, batches) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        element, _, arrow = FORMATS[self.kind]
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(self.vector)
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            if column.null_count or (sizes != sizes[0]).any():
                raise ValueError("vectors are null or differ in dimension")
            flat = column.flatten().cast(arrow).to_numpy(zero_copy_only=False)
            dim = int(sizes[0])
            records = np.empty((batch.num_rows, 1 + dim), "<i4")
            records[:, 0] = dim
            records[:, 1:] = np.ascontiguousarray(flat.astype(element)).view("<i4").reshape(-1, dim)
            yield records, None if self.idx is None else batch.column(self.idx).to_numpy()

    def _place(self, records: np.ndarray, idx: np.ndarray) -> None:
        """Write each run of consecutive records at its own offset of the shared file."""
        _, target = open_path(self._temporary())
        stride = records.shape[1] * 4
        cuts = np.flatnonzero(np.diff(idx) != 1) + 1
        os.makedirs(os.path.dirname(target), exist_ok=True)
        handle = os.open(target, os.O_CREAT | os.O_WRONLY, 0o644)
        try:
            for start, end in zip([0, *cuts], [*cuts, len(idx)]):
                data = memoryview(records[start:end].tobytes())
                offset = int(idx[start]) * stride
                while data:
                    done = os.pwrite(handle, data, offset)
                    data, offset = data[done:], offset + done
        finally:
            os.close(handle)

    def commit(self, messages: list[Written | None]) -> None:
        done = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.partition)
        if len({m.dim for m in done}) > 1:
            raise ValueError("vectors differ in dimension")
        system, path = open_path(self.path)
        _, temporary = open_path(self._temporary())
        if self.overwrite:
            _clear(system, path)
        if self.single:
            if not done:
                system.open_output_stream(path).close()
                return
            rows = sum(m.rows for m in done)
            found = tuple(map(sum, zip(*(m.powers for m in done))))
            whole = system.get_file_info(temporary).size == rows * 4 * (1 + done[0].dim)
            if not whole or found != _power_sums(rows):
                raise ValueError("idx is not dense from 0")
            system.move(temporary, path)
            return
        system.create_dir(path, recursive=True)
        for place, message in enumerate(done):
            system.move(message.temporary, f"{path}/part-{place:08d}.{self.kind}")
        _clear(system, temporary)
        with system.open_output_stream(f"{path}/{DONE}") as mark:  # last: all parts are in place
            mark.write(b"")

    def abort(self, messages: list[Written | None]) -> None:
        _clear(*open_path(self._temporary()))


def _power_sums(n: int) -> tuple[int, int, int]:
    """Sums of i, i**2 and i**3 for i below ``n``, which repeats and holes together do not keep."""
    first = n * (n - 1) // 2
    return first, n * (n - 1) * (2 * n - 1) // 6, first * first


def _clear(system: fs.FileSystem, path: str) -> None:
    kind = system.get_file_info(path).type
    if kind == fs.FileType.File:
        system.delete_file(path)
    elif kind == fs.FileType.Directory:
        system.delete_dir(path)


class _XvecSource(DataSource):
    kind = ""

    @classmethod
    def name(cls) -> str:
        return cls.kind

    def schema(self) -> str:
        return f"idx long, vector array<{FORMATS[self.kind][1]}>"

    def reader(self, schema: StructType) -> XvecReader:
        return XvecReader(self.kind, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> XvecWriter:
        return XvecWriter(self.kind, dict(self.options), schema, overwrite)


class FvecSource(_XvecSource):
    kind = "fvec"


class IvecSource(_XvecSource):
    kind = "ivec"


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FvecSource)
    spark.dataSource.register(IvecSource)


# --- functions over the sources -------------------------------------------------------------


def _shared(spark: SparkSession, path: str) -> None:
    """Refuse, on a cluster, a path that would be another disk on each executor."""
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", path) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{path}: name the file system, as all executors have to reach it")


def read_xvec(spark: SparkSession, path: str, kind: str = "fvec", **options) -> DataFrame:
    """(idx, vector) of a dataset. Options: ``start``, ``end``, ``splitBytes``, ``records`` (a list of idx)."""
    _shared(spark, path)
    register(spark)
    if not isinstance(options.get("records", ""), str):
        options["records"] = ",".join(str(int(i)) for i in options["records"])
    return spark.read.format(kind).options(**options).load(path)


def write_xvec(
    df: DataFrame,
    path: str,
    kind: str = "fvec",
    vector: str = "vector",
    order: str = "idx",
    single_file: bool = False,
    mode: str = "overwrite",
) -> None:
    """Write vectors in ``order`` (with ``single_file`` a dense position from 0). ``mode`` is overwrite, ignore (keep what exists) or error."""
    _shared(df.sparkSession, path)
    if mode not in ("overwrite", "ignore", "error"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode != "overwrite" and exists(path):
        if mode == "ignore":
            return
        raise FileExistsError(path)
    register(df.sparkSession)
    element = FORMATS[kind][1]
    rows = df.select(
        F.col(order).cast("long").alias("idx"), F.col(vector).cast(f"array<{element}>").alias("vector")
    )
    # in a single file each record has its place, so nothing has to be sorted or shuffled
    placed = rows if single_file else range_partitioned(rows, ["idx"])
    layout = "single" if single_file else "parts"
    placed.write.format(kind).mode("overwrite").option("layout", layout).save(path)


def exists(path: str) -> bool:
    """True for a non-empty file, or a folder whose writing was finished."""
    system, local = open_path(path)
    info = system.get_file_info(local)
    if info.type == fs.FileType.Directory:
        return system.get_file_info(f"{local}/{DONE}").type == fs.FileType.File
    return info.type == fs.FileType.File and info.size > 0


def count_vectors(spark: SparkSession, path: str, kind: str = "fvec") -> DataFrame:
    """(row_count, dim) of a dataset, from file sizes and the first record's dimension."""
    system, local = open_path(path)
    files = _data_files(system, local, kind)
    if not files:
        return spark.createDataFrame([(0, 0)], "row_count long, dim int")
    with system.open_input_file(files[0].path) as f:
        dim = int(np.frombuffer(f.read(4), "<i4")[0])
    rows = sum(i.size for i in files) // (4 * (1 + dim))
    return spark.createDataFrame([(rows, dim)], "row_count long, dim int")


def nth_vector(spark: SparkSession, path: str, n: int, kind: str = "fvec") -> DataFrame:
    """The n-th record as (idx, vector); only its bytes are read."""
    return read_xvec(spark, path, kind, start=n, end=n + 1)


def first_vector(spark: SparkSession, path: str, kind: str = "fvec") -> Row | None:
    return nth_vector(spark, path, 0, kind).first()
