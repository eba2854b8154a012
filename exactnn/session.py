"""Session helpers: where intermediate tables go and how input is spread over tasks."""

from __future__ import annotations

import math
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

MIB = 1 << 20
PARTITION_BYTES = 256 * MIB
MAX_PARTITIONS = 20_000
UNKNOWN_BYTES = 1 << 60
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is absent and the session is local,
    as in tests; on a cluster every executor has to see the folder. The path names its file
    system, as Spark resolves it: a plain one would mean the local disk to readers other than Spark.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context = spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(configured)
        return path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.gettempdir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/exactnn-{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and keeps column pruning, which a
    checkpoint of whole rows does not.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers, once per application.

    Only needed where neither ``--py-files`` nor an installation does so already.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="exactnn-")) / folder.name
    context.addPyFile(shutil.make_archive(str(target), "zip", folder.parent, folder.name))
    _shipped.add(context.applicationId)


def parallelism(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def input_bytes(df: DataFrame) -> int | None:
    """Bytes that ``df`` reads: the sum over its scans, known without a job.

    None where a source has no size. The estimate for the whole plan is not used, as a join
    multiplies its sides there.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.length())]
    except AttributeError:  # no access to the plan, as on a remote session
        return None
    return None if any(size >= UNKNOWN_BYTES for size in sizes) else sum(sizes)


def range_partitioned(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` in ``order``: range partitions, each sorted.

    The number of partitions follows the size of the input where the session's default would
    make partitions of more than ``PARTITION_BYTES``; it is capped, as the shuffle has a block
    for every pair of a map task and a partition. Larger partitions sort with spilling.
    """
    spark = df.sparkSession
    size = input_bytes(df)
    # an input of unknown size keeps at least as many partitions as its splits
    wanted = df.rdd.getNumPartitions() if size is None else math.ceil(size / PARTITION_BYTES)
    wanted = min(MAX_PARTITIONS, wanted)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        ranged = df.repartitionByRange(wanted, *order)
    else:
        ranged = df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a small input one partition per core; leave a large one as its splits are.

    A Parquet row group is never split, so a file of one row group is one task however many
    cores there are. The shuffle is only made for inputs with fewer bytes than one split per
    core; anything larger keeps its scan partitions and moves nothing. Hashing ``key`` (a
    unique id) places rows the same way when a task is run again.
    """
    spark = df.sparkSession
    size = input_bytes(df)
    cores = parallelism(spark)
    split = _bytes_setting(spark, "spark.sql.files.maxPartitionBytes", 128 * MIB)
    if size is None or size >= cores * split:
        return df
    return df.repartition(cores, key)


def _bytes_setting(spark: SparkSession, key: str, default: int) -> int:
    raw = (spark.conf.get(key, None) or "").strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    if not raw:
        return default
    if raw[-1] in units:
        return int(raw[:-1]) * units[raw[-1]]
    return int(raw)
