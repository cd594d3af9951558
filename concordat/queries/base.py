"""What query modules share: registration, and driver tables as source datasets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

# Key and columns of the driver tables that serve as datasets.
TABLES = {
    "customer": ("c_custkey", ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")),
    "supplier": ("s_suppkey", ("s_name", "s_nationkey", "s_acctbal")),
    "part": ("p_partkey", ("p_name", "p_brand", "p_type", "p_size", "p_retailprice")),
    "orders": ("o_orderkey", ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")),
}


def query(sql: str | None = None):
    """Register a function under its own name, with its oracle if SQL can say it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dataset(spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """A table of text with cohort_id, dataset_id, row_no and record_id; rows are named by their key."""
    key, cols = TABLES[name]
    df = table(spark, sf_dir, name)
    text = df.select(F.col(key).alias("__key"), *[F.col(c).cast("string").alias(c) for c in columns or cols])
    return T.identified(text, "tpch", name, F.col("__key")).drop("__key")


def cells(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return T.union_all([T.cells(dataset(spark, sf_dir, n), list(TABLES[n][1])) for n in names])


def cells_sql(*names: str) -> str:
    """The same cells in SQL."""
    parts = []
    for n in names:
        key, cols = TABLES[n]
        parts += [f"select 'tpch' as cohort_id, '{n}' as dataset_id, {key} as row_no, 'tpch#{n}#' || {key} as record_id, '{c}' as \"column\", cast({c} as varchar) as value from {n}" for c in cols]
    return " union all ".join(parts)


MISSING = "(value is null or value in ('', 'NA', 'NULL', '.'))"
