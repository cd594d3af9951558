"""Ranks and quantiles inside groups of any size.

Rows are dealt out by ranges of (group, order), so a group may lie on many
partitions. How many rows each partition has of a group is a small table; its
running sums say where a partition's own ranks begin. No group is ever sorted,
counted or held in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.storage import materialize

PART = "__part"


def _dealt(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, *key, *order).withColumn(PART, F.spark_partition_id()), "ranges")


def _bases(dealt: DataFrame, key: list[str], weight) -> DataFrame:
    """(key, part, own, before, total): one row for each group and partition that has some of it."""
    own = dealt.groupBy(*key, PART).agg(weight.alias("own"))
    w = Window.partitionBy(*key).orderBy(PART)
    before = F.coalesce(F.sum("own").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return own.withColumn("before", before).withColumn("total", F.sum("own").over(Window.partitionBy(*key)))


def ranked(df: DataFrame, key: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """Adds the row's number, from 1, in its group by ``order``, which must name its rows uniquely."""
    dealt = _dealt(df, key, order)
    base = _bases(dealt, key, F.count("*")).select(*key, PART, "before")
    local = F.row_number().over(Window.partitionBy(*key, PART).orderBy(*order))
    return dealt.withColumn(name, local).join(base, [*key, PART]).withColumn(name, F.col(name) + F.col("before")).drop("before", PART)


def running(df: DataFrame, key: list[str], order: list[str], n: str, name: str) -> DataFrame:
    """Adds the sum of ``n`` up to the row in its group by ``order``; of rows alike in that, one at most has an ``n`` other than 0, or their sums are undefined."""
    dealt = _dealt(df, key, order)
    base = _bases(dealt, key, F.sum(n)).select(*key, PART, "before")
    local = F.sum(n).over(Window.partitionBy(*key, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.withColumn(name, local).join(base, [*key, PART]).withColumn(name, F.col(name) + F.col("before")).drop("before", PART)


def quantiles(values: DataFrame, key: list[str], probabilities: tuple[float, ...], x: str = "x", n: str = "n", totals: bool = False) -> DataFrame:
    """(key, quantiles), with ``totals`` the total of n too: exact interpolated quantiles of ``x``, which occurs ``n`` times; (key, x) is unique and x not null."""
    dealt = _dealt(values, key, [x])
    base = _bases(dealt, key, F.sum(n))
    at = [F.lit(p) * (F.col("total") - 1) for p in probabilities]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(a).cast("long"), F.ceil(a).cast("long")) for a in at])))
    wanted = base.withColumn("ranks", F.filter(ranks, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("own")))).where(F.size("ranks") > 0)
    up_to = F.sum(n).over(Window.partitionBy(*key, PART).orderBy(x).rowsBetween(Window.unboundedPreceding, 0))
    rows = dealt.join(wanted.select(*key, PART, "before", "total", "ranks"), [*key, PART]).withColumn("end", F.col("before") + up_to)
    found = rows.select(*key, "total", F.col(x).alias("x"), F.explode(F.filter("ranks", lambda r: (r >= F.col("end") - F.col(n)) & (r < F.col("end")))).alias("r"))
    # Two ranks for each probability at most.
    told = found.groupBy(*key, "total").agg(F.map_from_entries(F.collect_list(F.struct("r", "x"))).alias("by"))

    def between(a):
        lo, hi = F.floor(a).cast("long"), F.ceil(a).cast("long")
        low, high = F.element_at("by", lo), F.element_at("by", hi)
        return F.when(lo == hi, low).otherwise((hi - a) * low + (a - lo) * high)

    return told.select(*key, *(["total"] if totals else []), F.array(*[between(a) for a in at]).alias("quantiles"))
