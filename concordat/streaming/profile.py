"""An extension: running column counts over a stream of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.config import Params
from concordat.functions import text as X
from concordat.operators.profile import is_missing


def running_counts(rows: DataFrame, columns: list[str], time: str, delay: str = "10 minutes", window: str = "1 hour", p: Params = Params()) -> DataFrame:
    """(window, column, n_rows, n_missing, n_int) of a streaming table, late rows bounded by a watermark."""
    long = rows.withWatermark(time, delay).select(F.col(time), F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])).alias("x"))
    v = F.col("x.value")
    gone = is_missing(v, p.na_strings)
    return long.groupBy(F.window(time, window), F.col("x.column").alias("column")).agg(F.count("*").alias("n_rows"), F.count_if(gone).alias("n_missing"), F.count_if(~gone & X.is_int(v)).alias("n_int"))
