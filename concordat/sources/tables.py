"""Source tables as text cells, with stable row numbers; and their sinks."""

from __future__ import annotations

import csv
import json
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.errors import IngestError
from concordat.storage import write_bytes

CELL = "replicate int, cohort_id string, dataset_id string, row_no long, record_id string, column string, value string"


def headers(path: str, spark: SparkSession | None = None) -> list[str]:
    """The header of a CSV file; paths with a scheme are read by Spark."""
    if "://" in path:
        row = (spark or SparkSession.active()).read.csv(path, header=False, multiLine=True, escape='"').first()
        found = [x or "" for x in row] if row else []
    else:
        with open(path, newline="", encoding="utf-8", errors="replace") as f:
            found = next(csv.reader(f), [])
    if repeated := sorted({h for h in found if found.count(h) > 1}):
        raise IngestError(f"{path}: repeated headers {repeated}")
    return found


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether some cell has a line break: only then has a line an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_text_csv(spark: SparkSession, path: str, columns: list[str] | None = None, multiline: bool | None = None) -> DataFrame:
    """A CSV file with a header, every cell as text.

    Rows that are too short are padded, too long ones cut; bytes that are not
    UTF-8 become U+FFFD. Empty cells are null. With ``columns`` the header is
    not read again. Repeated headers are refused. A file with line breaks inside
    of cells can't be split; unless ``multiline`` says it, the lines are looked
    through for them, and all other files are read in splits.
    """
    names = columns or headers(path, spark)
    if multiline is None:
        multiline = spans_lines(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE", multiLine=multiline, enforceSchema=True, escape='"')


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def numbered(df: DataFrame, name: str = "row_no") -> DataFrame:
    """Row numbers from 1 in the order of the files, without bringing rows together.

    Rows are numbered inside each split; splits are few, so their running
    counts are a small table that every task can have.
    """
    at = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"))
    inside = Window.partitionBy("__file", "__block").orderBy("__id")
    local = at.withColumn("__local", F.row_number().over(inside))
    counts = at.groupBy("__file", "__block").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return local.join(base, ["__file", "__block"]).withColumn(name, F.col("__base") + F.col("__local")).drop("__file", "__block", "__id", "__local", "__base")


def identified(df: DataFrame, cohort: Column | str, dataset: Column | str, row: Column) -> DataFrame:
    """Adds cohort_id, dataset_id, row_no and record_id (cohort#dataset#row)."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return df.withColumns({"cohort_id": lit(cohort), "dataset_id": lit(dataset), "row_no": row.cast("long")}).withColumn("record_id", F.concat_ws("#", "cohort_id", "dataset_id", "row_no"))


def cells(df: DataFrame, columns: list[str], replicate: int = -1) -> DataFrame:
    """One row for each cell of ``columns``: the long form that all later stages read.

    One scan of the table, whatever the number of columns; ``replicate`` -1 is
    the baseline.
    """
    ids = [F.lit(replicate).alias("replicate"), "cohort_id", "dataset_id", "row_no", "record_id"]
    wide = df.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return wide.unpivot(["replicate", "cohort_id", "dataset_id", "row_no", "record_id"], columns, "column", "value")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all tables; columns that a table lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One table from Parquet files whose columns may differ."""
    return union_all([spark.read.parquet(p) for p in paths])


def write_parquet(df: DataFrame, path: str, order: list[str] | None = None, single: bool = False) -> None:
    """Write with a schema even if there are no rows. ``order`` sorts the whole; ``single`` only for small published tables."""
    out = df.orderBy(*order) if order else df
    (out.coalesce(1) if single else out).write.mode("overwrite").parquet(path)


def write_json(value, path: str) -> None:
    save(json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False, default=str) + "\n", path)


def save(data: bytes | str, path: str) -> None:
    """Write a small file, local or at a URL of a file system."""
    raw = data if isinstance(data, bytes) else data.encode()
    if "://" in path:
        write_bytes(path, raw)
    else:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_bytes(raw)


def yaml_text(value) -> str:
    """YAML with keys in the order given."""
    return yaml.safe_dump(value, sort_keys=False, allow_unicode=True)


def write_yaml(value, path: str) -> str:
    """Keys in the order given; returns the text."""
    text = yaml_text(value)
    save(text, path)
    return text


def strict_csv(path: str) -> tuple[list[str], list[list[str]]]:
    """Header and rows of a CSV file, bytes preserved; ragged and empty tables are refused."""
    with open(path, newline="", encoding="utf-8", errors="surrogateescape") as f:
        rows = list(csv.reader(f))
    if len(rows) < 2:
        raise IngestError(f"{path}: no rows")
    if any(len(r) != len(rows[0]) for r in rows):
        raise IngestError(f"{path}: rows of different lengths")
    return rows[0], rows[1:]


def write_strict_csv(path: str, header: list[str], rows: list[list[str]]) -> None:
    """Write a CSV file and read it again; a difference is an error."""
    with open(path, "w", newline="", encoding="utf-8", errors="surrogateescape") as f:
        csv.writer(f, lineterminator="\n").writerows([header, *rows])
    if strict_csv(path) != (header, rows):
        raise IngestError(f"{path} does not read back as written")
