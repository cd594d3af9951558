"""Column profiles from the long form.

How often each value of a column occurs is one aggregate over all cells. Types,
counts, lists and quantiles are read off that table of distinct values; only
examples and samples of failures, which go by row order, look at cells again.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.config import Params
from concordat.errors import ProfileError
from concordat.functions import text as X
from concordat.operators import ranks
from concordat.storage import materialize

KEY = ["replicate", "cohort_id", "dataset_id", "column"]
PROBABILITIES = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)

# Header patterns that name a unit (label, pattern, UCUM code, confidence), in the order in which hits are listed.
UNIT_PATTERNS = (
    ("(%)", r"\(\s*%\s*\)|_pct$|_percent$", "%", 0.9),
    ("MONTHS", r"(^|_)months?($|_)|_mo$", "mo", 0.9),
    ("DAYS", r"(^|_)days?($|_)|_d$", "d", 0.9),
    ("WEEKS", r"(^|_)weeks?($|_)|_wk$", "wk", 0.9),
    ("YEARS", r"(^|_)years?($|_)|_yr$", "a", 0.9),
    ("mg/dL", r"mg[_/]?d[lL]", "mg/dL", 0.9),
    ("mmol/L", r"mmol[_/]?[lL]", "mmol/L", 0.9),
    ("kg", r"(^|_)kgs?($|_)", "kg", 0.9),
    ("cm", r"(^|_)cm($|_)", "cm", 0.9),
    ("bpm", r"bpm$", "/min", 0.9),
)
RANGE_CONFIDENCE = 0.3
# What values from 0 up to a limit suggest (limit, unit, source); the narrowest range counts.
SHARES = ((1, "1", "range:0..1"), (100, "1", "range:0..100"))
# The other unit of time that values of a header's unit may be in (unit, limit, other, source).
SWAPS = (("d", 60, "mo", "range:0..60"), ("mo", 60, "d", "range:0..60"))


def is_missing(value: Column, na: tuple[str, ...]) -> Column:
    """Null or exactly one of the given texts."""
    return value.isNull() | value.isin(*na)


def value_counts(cells: DataFrame) -> DataFrame:
    """(key, value, n): how often each value occurs, missing ones and null too; map-side combined."""
    return cells if "n" in cells.columns else cells.groupBy(*KEY, "value").agg(F.count("*").alias("n"))


def flagged(rows: DataFrame, p: Params) -> DataFrame:
    """Cells or counted values with what each value looks like."""
    v = F.col("value")
    return rows.select("*", is_missing(v, p.na_strings).alias("gone"), X.is_int(v).alias("i"), X.is_float(v).alias("f"), X.is_bool(v).alias("b"), X.is_date(v, p.date_formats).alias("d"), F.contains(v, F.lit("�")).alias("bad"))


def types(cells: DataFrame, p: Params) -> DataFrame:
    """Per column: n_rows, n_missing, inferred_type, reason; of cells or their :func:`value_counts`.

    Precedence: no value at all is empty; then int, float, bool, date. Numbers
    or dates beside other text are a failure (mixed_type), numbers beside dates
    only are text; a replacement character anywhere is a failure (encoding)
    that comes first.
    """
    there = ~F.col("gone")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    some = lambda c: count(there & c)
    numeric = F.col("i") | F.col("f")
    # A year alone reads as a number and a date; it counts as the number it is.
    other = ~numeric & ~F.col("d")
    agg = flagged(value_counts(cells), p).groupBy(*KEY).agg(
        F.sum("n").alias("n_rows"),
        count(F.col("gone")).alias("n_missing"),
        some(F.col("i")).alias("ints"),
        some(F.col("f") | F.col("i")).alias("nums"),
        some(F.col("b")).alias("bools"),
        some(F.col("d")).alias("dates"),
        some(~numeric & F.col("d")).alias("only_dates"),
        some(other).alias("others"),
        count(F.coalesce("bad", F.lit(False))).alias("broken"),
    )
    n = F.col("n_rows") - F.col("n_missing")
    clean = (
        F.when(n == 0, "empty")
        .when(F.col("ints") == n, "int")
        .when(F.col("nums") == n, "float")
        .when(F.col("bools") == n, "bool")
        .when(F.col("dates") == n, "date")
        .when((F.col("others") > 0) & (F.col("nums") + F.col("only_dates") > 0), F.lit(None))
        .otherwise("str")
    )
    reason = F.when(F.col("broken") > 0, "encoding").when(clean.isNull(), "mixed_type")
    return agg.select(*KEY, "n_rows", "n_missing", F.when(reason.isNull(), clean).alias("inferred_type"), reason.alias("reason"), (F.col("others") <= F.col("nums") + F.col("only_dates")).alias("others_fewer"))


def uniques(cells: DataFrame, p: Params) -> DataFrame:
    """Per column: n_unique, unique_values (sorted; null beyond ``max_unique_listed``), unique_truncated.

    Values are gathered only for columns that are known to have few.
    """
    values = value_counts(cells).where(~is_missing(F.col("value"), p.na_strings))
    counts = values.groupBy(*KEY).agg(F.count("*").alias("n_unique"))
    few = counts.where(F.col("n_unique") <= p.max_unique_listed).select(*KEY)
    lists = values.join(few, KEY, "left_semi").groupBy(*KEY).agg(F.array_sort(F.collect_list("value")).alias("unique_values"))
    return counts.join(lists, KEY, "left").withColumn("unique_truncated", F.col("n_unique") > p.max_unique_listed)


def quantiles(cells: DataFrame, kinds: DataFrame, p: Params) -> DataFrame:
    """Exact interpolated quantiles of the numeric columns, however many distinct numbers they have."""
    numeric = kinds.where(F.col("inferred_type").isin("int", "float")).select(*KEY)
    rows = value_counts(cells).where(~is_missing(F.col("value"), p.na_strings)).join(numeric, KEY, "left_semi")
    numbers = rows.groupBy(*KEY, F.col("value").try_cast("double").alias("x")).agg(F.sum("n").alias("n")).where("x is not null")
    return ranks.quantiles(numbers, KEY, PROBABILITIES)


def first_values(cells: DataFrame, k: int, keep: Column | None = None) -> DataFrame:
    """The first ``k`` values of each column in row order, by a bounded aggregate."""
    rows = cells if keep is None else cells.where(keep)
    # Heaps of size k merge, so no column is ever sorted whole.
    top = F.expr(f"slice(array_sort(collect_list(struct(row_no, value))), 1, {max(k, 1)})")
    salted = rows.groupBy(*KEY, F.expr("row_no div 4096").alias("stripe")).agg(top.alias("part"))
    merged = salted.groupBy(*KEY, F.expr("stripe div 4096").alias("stripe")).agg(F.expr(f"slice(array_sort(flatten(collect_list(part))), 1, {max(k, 1)})").alias("part"))
    out = merged.groupBy(*KEY).agg(F.expr(f"slice(array_sort(flatten(collect_list(part))), 1, {max(k, 1)})").alias("part"))
    return out.select(*KEY, F.expr(f"slice(transform(part, x -> x.value), 1, {k})" if k else "cast(array() as array<string>)").alias("values"))


def unit_patterns(path: str | None) -> tuple:
    """The patterns of a YAML file (label, regex, ucum, confidence), in its order; without a file the fixed ones."""
    if path is None:
        return UNIT_PATTERNS
    import yaml

    from concordat.sources.ingest import control_file

    return tuple((x["label"], x["regex"], x["ucum"], float(x["confidence"])) for x in yaml.safe_load(control_file(path))["patterns"])


def header_units(column: str, patterns=UNIT_PATTERNS) -> list[dict]:
    return [{"ucum": u, "source": f"header:{label}", "confidence": c} for label, rx, u, c in patterns if re.search(rx, column, re.IGNORECASE)]


def unit_candidates(column: str, quantile: list[float] | None, infer_from_range: bool = True, patterns=UNIT_PATTERNS) -> list[dict]:
    """Units that a header or a range of values suggests; never one alone by force."""
    found = header_units(column, patterns)
    if not infer_from_range or not quantile or quantile[0] < 0:
        return found
    first, most = found[0]["ucum"] if found else None, quantile[-1]
    fits = [r for r in SHARES if most <= r[0]][:1] + [r[1:] for r in SWAPS if r[0] == first and most <= r[1]]
    return found + [{"ucum": u, "source": source, "confidence": RANGE_CONFIDENCE} for _, u, source in fits]


def profile(cells: DataFrame, p: Params = Params()) -> DataFrame:
    """One row for each column: all evidence that later stages use, or the reason for failing."""
    values = materialize(value_counts(cells), "profile-values")
    kinds = materialize(types(values, p), "profile-types")
    wide = kinds.join(uniques(values, p), KEY, "left").join(quantiles(values, kinds, p), KEY, "left")
    shown = first_values(cells, p.example_k, ~is_missing(F.col("value"), p.na_strings)).withColumnRenamed("values", "example_values")
    return wide.join(shown, KEY, "left").select(
        *KEY,
        "inferred_type",
        "reason",
        "others_fewer",
        "n_rows",
        "n_missing",
        F.coalesce("n_unique", F.lit(0)).alias("n_unique"),
        F.when(~F.coalesce("unique_truncated", F.lit(False)), F.coalesce("unique_values", F.array().cast("array<string>"))).alias("unique_values"),
        F.coalesce("unique_truncated", F.lit(False)).alias("unique_truncated"),
        "quantiles",
        F.coalesce("example_values", F.array().cast("array<string>")).alias("example_values"),
    )


def failures(cells: DataFrame, kinds: DataFrame, p: Params) -> DataFrame:
    """(key, reason, sample): of a mixed column the rarer kind of value, of a broken one the broken cells."""
    failed = kinds.where("reason is not null").select(*KEY, "reason", "others_fewer")
    rows = flagged(cells, p).join(failed, KEY)
    numeric = F.col("i") | F.col("f") | F.col("d")
    keep = F.when(F.col("reason") == "encoding", F.coalesce("bad", F.lit(False))).otherwise(~F.col("gone") & (numeric != F.col("others_fewer")))
    sample = first_values(rows, p.fail_sample_k, keep).withColumnRenamed("values", "sample")
    return failed.drop("others_fewer").join(sample, KEY, "left")


def check_failures(kinds: DataFrame, p: Params) -> tuple[int, int]:
    """(failed, all) columns; an error if the share is over ``max_failed_frac``."""
    r = kinds.agg(F.count_if(F.col("reason").isNotNull()).alias("bad"), F.count("*").alias("n")).first()
    if r["n"] and r["bad"] / r["n"] > p.max_failed_frac:
        raise ProfileError(f"{r['bad']} of {r['n']} columns failed")
    return r["bad"], r["n"]
