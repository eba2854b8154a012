"""Explicit row positions: dense ids, first-N and paging without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from exactnn.session import MIB, input_bytes, materialize, range_partitioned

# An ordered limit brings this many rows of every split to one task, so both have to be few.
TOP_ROWS = 10_000
TOP_BYTES = 2048 * MIB
_LOW_BITS = (1 << 33) - 1


def _range_sorted(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` range-partitioned and sorted, with its partition and place, as a written table."""
    placed = (
        range_partitioned(df, order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS)))
    )
    return materialize(placed, name)


def _offsets(table: DataFrame, weight: Column) -> DataFrame:
    """Total weight before each range partition: one row per partition."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = table.groupBy("_part").agg(F.sum(weight).alias("_total"))
    return totals.withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))


def dense_index(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """Add the 0-based position of each row under ``order``, a unique key.

    Rows are range-partitioned and sorted once and numbered inside their partition; the offset
    of each partition comes from a table of one row per partition, which bounds the broadcast.
    """
    table = _range_sorted(df, order, "ordered")
    offsets = _offsets(table, F.lit(1)).select("_part", "_before")
    return table.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + F.col("_place")).cast("long").alias(name)
    )


class _Keys:
    """Order keys, range-sorted and stored once, with the weight before each range partition.

    The totals, one number for each of at most MAX_PARTITIONS partitions, are on the driver.
    """

    def __init__(self, df: DataFrame, order: Sequence[str], weight: Column | None = None):
        self.order, self.weighted = list(order), weight is not None
        step = [] if weight is None else [weight.cast("long").alias("_w")]
        self.table = _range_sorted(df.select(*order, *step), order, "keys")
        total = F.count("*") if weight is None else F.coalesce(F.sum("_w"), F.lit(0))
        self.before: dict[int, int] = {}
        self.total = 0
        for part in self.table.groupBy("_part").agg(total.alias("n")).orderBy("_part").collect():
            self.before[part["_part"]] = self.total
            self.total += part.n

    def at(self, n: int) -> Row | None:
        """Key and partition of the first row at which the running weight reaches ``n``."""
        if n > self.total:
            return None
        part = next(p for p, b in reversed(self.before.items()) if b < n)
        own = self.table.where(F.col("_part") == part)
        if not self.weighted:
            return own.where(F.col("_place") == n - self.before[part] - 1).select(*self.order, "_part").first()
        running = Window.partitionBy("_part").orderBy(*self.order)
        reached = own.withColumn("_run", F.sum("_w").over(running) + F.lit(self.before[part])).where(F.col("_run") >= n)
        return reached.orderBy(*self.order).select(*self.order, "_part").first()

    def count(self, key: Row, strictly: bool = False) -> int:
        """Rows up to, or before, a key that :meth:`at` gave; equal keys lie in one partition."""
        own = self.table.where((F.col("_part") == key["_part"]) & up_to(self.order, key, strictly))
        return self.before[key["_part"]] + own.count()


def position_boundary(
    df: DataFrame, order: Sequence[str], n: int, weight: str | None = None
) -> Row | None:
    """Order key of the first row at which the running weight reaches ``n``.

    None if the whole table weighs less than ``n``. Only the order columns and the weight are
    moved, and only the range partition that contains the boundary is summed row by row.
    """
    return _Keys(df, order, F.col(weight) if weight else None).at(n)


def up_to(order: Sequence[str], key: Row, strictly: bool = False) -> Column:
    """Predicate, never null: the row's order key is not after ``key``, or before it.

    Nulls come first, as Spark sorts them.
    """
    test = None
    for name in reversed(order):
        x, bound = F.col(name), key[name]
        if bound is None:
            here = x.isNull()
            test = (here & F.lit(not strictly)) if test is None else here & test
        elif test is None:
            test = x.isNull() | ((x < F.lit(bound)) if strictly else (x <= F.lit(bound)))
        else:
            test = x.isNull() | (x < F.lit(bound)) | ((x == F.lit(bound)) & test)
    return test


def _small_limit(df: DataFrame, n: int) -> bool:
    size = input_bytes(df)
    return n <= TOP_ROWS and size is not None and size <= TOP_BYTES


def _with_tie(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with a hash of the other columns, by which rows of equal keys are ordered."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() != "map" and f.name not in order]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in plain]) if plain else F.lit(0).cast("long")
    return df.withColumn("_tie", tie), [*order, "_tie"]


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows under ``order``, exactly ``n`` if there are as many.

    Nulls come first. Rows of equal keys are ordered by a hash of their other columns, so that
    both forms give the same rows: a small ``n`` of a small input is an ordered limit; otherwise
    the key of the n-th row is found first, and the rows are then a filter on the scan, without a
    sort or shuffle of the rows themselves.
    """
    return _between(df, order, 0, n)


def page(df: DataFrame, order: Sequence[str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` .. ``offset + limit - 1`` under ``order``; see :func:`first_n`."""
    return _between(df, order, offset, offset + limit)


def _between(df: DataFrame, order: Sequence[str], low: int, high: int) -> DataFrame:
    """The rows at positions ``low`` .. ``high - 1``."""
    tied, keys = _with_tie(df, order)
    if high <= low:
        return df.limit(0)
    if _small_limit(df, high):
        return tied.orderBy(*keys).offset(low).limit(high - low).drop("_tie")
    ranked = _Keys(tied, keys)
    lower = ranked.at(low) if low else None
    if low and lower is None:
        return df.limit(0)
    upper = ranked.at(high)
    if lower is not None and lower == upper:  # all rows are copies of one
        return _some(tied.where(_at(keys, upper)), high - low).drop("_tie")
    inner, parts = F.lit(True), []
    if lower is not None:
        inner = ~up_to(keys, lower)
        surplus = ranked.count(lower) - low
        if surplus:
            parts.append(_some(tied.where(_at(keys, lower)), surplus))
    if upper is not None:
        surplus = ranked.count(upper) - high
        inner = inner & up_to(keys, upper, strictly=surplus > 0)
        if surplus:
            parts.append(_some(tied.where(_at(keys, upper)), high - ranked.count(upper, strictly=True)))
    out = tied.where(inner)
    for part in parts:
        out = out.unionByName(part)
    return out.drop("_tie")


def _at(keys: Sequence[str], key: Row) -> Column:
    return up_to(keys, key) & ~up_to(keys, key, strictly=True)


def _some(copies: DataFrame, n: int) -> DataFrame:
    """``n`` of rows that are all equal."""
    if n <= TOP_ROWS:
        return copies.limit(n)
    return dense_index(copies, ["_tie"], "_idx").where(F.col("_idx") < n).drop("_idx")


def pages(df: DataFrame, order: Sequence[str], rows: int, name: str = "page") -> DataFrame:
    """All rows with their page number; the last page may be short."""
    indexed = dense_index(df, order, "_idx")
    return indexed.withColumn(name, F.floor(F.col("_idx") / rows).cast("long")).drop("_idx")
