"""Derived data: dates with precision, endpoints, responses, coverage, missingness, balance, provenance."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.config import DOMAIN_TABLES
from concordat.errors import ConcordatError
from concordat.operators.mapping import table_of
from concordat.sources.tables import write_json

PRECISIONS = ("day", "month", "year")
# Response categories from best to worst.
RESPONSES = ("CR", "PR", "SD", "PD", "NE")


def dates(df: DataFrame, column: str, policy: str = "mid_interval", least: str = "year", today: str | None = None) -> DataFrame:
    """Adds date, precision and reason for text like 2021, 2021-3 or 2021-03-15.

    ``policy``: mid_interval (the 15th; the 1st of July), start or reject of
    what is less than a day; ``least`` is the lowest precision taken; dates
    after ``today`` are refused.
    """
    if policy not in ("mid_interval", "start", "reject") or least not in PRECISIONS:
        raise ConcordatError(f"date policy {policy!r}, precision {least!r}")
    c = F.trim(F.col(column))
    y, m, d = (F.regexp_extract(c, r"^(\d{4})(?:-(\d{1,2}))?(?:-(\d{1,2}))?$", i) for i in (1, 2, 3))
    precision = F.when(y == "", F.lit(None)).when(m == "", "year").when(d == "", "month").otherwise("day")
    mid = policy == "mid_interval"
    month = F.when(m != "", m.try_cast("int")).otherwise(F.lit(7 if mid else 1))
    day = F.when(d != "", d.try_cast("int")).when(m != "", F.lit(15 if mid else 1)).otherwise(F.lit(1))
    made = F.try_to_timestamp(F.format_string("%04d-%02d-%02d", y.try_cast("int"), month, day), F.lit("yyyy-MM-dd")).cast("date")
    order = F.array_position(F.array(*[F.lit(x) for x in PRECISIONS]), precision)
    bad = (
        F.when(F.col(column).isNull() | (c == ""), F.lit(None))
        .when(precision.isNull() | made.isNull(), "unreadable")
        .when((order > PRECISIONS.index(least) + 1) | ((policy == "reject") & (precision != "day")), "too-coarse")
        .when(made > F.lit(today).cast("date") if today else F.lit(False), "future")
    )
    keep = bad.isNull()
    return df.withColumns({"date": F.when(keep, made), "precision": F.when(keep, precision), "reason": bad})


def endpoint(df: DataFrame, start: str, event: str, last: str) -> DataFrame:
    """Adds time_days and event (1: seen, 0: censored at ``last``), both or neither; negative times are refused as null."""
    stop = F.coalesce(F.col(event), F.col(last))
    days = F.datediff(stop, F.col(start))
    ok = days >= 0
    return df.withColumns({"time_days": F.when(ok, days), "event": F.when(ok, F.col(event).isNotNull().cast("int"))})


def kaplan_meier(df: DataFrame, time: str, event: str, group: list[str]) -> DataFrame:
    """(group, time, at_risk, events, survival): the product-limit estimate.

    Subjects are first counted by time, so windows run over distinct times.
    """
    at = df.where(F.col(time).isNotNull() & F.col(event).isNotNull()).groupBy(*group, F.col(time).alias("time")).agg(F.count("*").alias("n"), F.sum(F.col(event).cast("long")).alias("events"))
    later = Window.partitionBy(*group).orderBy(F.desc("time"))
    earlier = Window.partitionBy(*group).orderBy("time")
    rows = at.withColumn("at_risk", F.sum("n").over(later))
    left = 1 - F.col("events") / F.col("at_risk")
    log = F.sum(F.when(left > 0, F.log(left))).over(earlier)
    gone = F.max(F.when(left <= 0, 1).otherwise(0)).over(earlier) == 1
    return rows.select(*group, "time", "at_risk", "events", F.when(gone, 0.0).otherwise(F.exp(F.coalesce(log, F.lit(0.0)))).alias("survival"))


def best_response(df: DataFrame, subject: str, time: str, response: str, confirm_days: int = 28, criteria: str = "1.1") -> DataFrame:
    """(subject, best_response, criteria_version): CR and PR count if a later assessment confirms them.

    Confirmed means an assessment at least ``confirm_days`` later that is no worse; else they count as SD.
    """
    rank = F.array_position(F.array(*[F.lit(r) for r in RESPONSES]), F.col(response))
    rows = df.select(subject, F.col(time).alias("t"), F.col(response).alias("r"), rank.alias("k")).where("k > 0")
    w = Window.partitionBy(subject).orderBy("t").rangeBetween(confirm_days, Window.unboundedFollowing)
    held = F.min(F.when(F.col("r") != "NE", F.col("k"))).over(w) <= F.col("k")
    settled = F.when((F.col("k") <= 2) & ~F.coalesce(held, F.lit(False)), F.lit(3)).otherwise(F.col("k"))
    best = rows.withColumn("s", settled).groupBy(subject).agg(F.min("s").alias("s"))
    return best.select(subject, F.element_at(F.array(*[F.lit(r) for r in RESPONSES]), F.col("s").cast("int")).alias("best_response"), F.lit(criteria).alias("criteria_version"))


def coverage(mapped: DataFrame, cohort: str, variable: str, person: str, value: str) -> DataFrame:
    """(cohort, variable, n, n_present, coverage)."""
    return mapped.groupBy(cohort, variable).agg(F.countDistinct(person).alias("n"), F.countDistinct(F.when(F.col(value).isNotNull(), F.col(person))).alias("n_present")).withColumn("coverage", F.col("n_present") / F.col("n"))


def frontier(cohorts: dict[str, dict[str, float]], sizes: dict[str, int], least: float = 0.5, limit: int = 100_000) -> list[dict]:
    """Sets of cohorts that no other set beats in both persons and shared variables.

    All subsets are tried while there are at most ``limit``, else cohorts are
    added greedily; ``method`` says which.
    """
    names = sorted(cohorts)
    have = {c: {v for v, x in cohorts[c].items() if x >= least} for c in names}
    if 2 ** len(names) - 1 <= limit:
        sets, method = [s for k in range(1, len(names) + 1) for s in combinations(names, k)], "all"
    else:
        sets, method, cur, rest = [], "greedy", (), list(names)
        while rest:
            nxt = max(rest, key=lambda c: (len(set.intersection(*[have[x] for x in (*cur, c)])), sizes[c], c))
            cur = tuple(sorted((*cur, nxt)))
            rest.remove(nxt)
            sets.append(cur)
    points = [(s, sum(sizes[c] for c in s), len(set.intersection(*[have[c] for c in s]))) for s in sets]
    best = [p for p in points if not any(q[1] >= p[1] and q[2] >= p[2] and (q[1], q[2]) != (p[1], p[2]) for q in points)]
    return [{"cohorts": list(s), "persons": n, "variables": v, "method": method} for s, n, v in sorted(best, key=lambda p: (-p[1], p[0]))]


def missingness(df: DataFrame, group: list[str], value: str, near: float = 0.95) -> DataFrame:
    """(group, n, n_missing, fraction, class): complete, sporadic, near (almost all) or systematic (all)."""
    out = df.groupBy(*group).agg(F.count("*").alias("n"), F.count_if(F.col(value).isNull()).alias("n_missing")).withColumn("fraction", F.col("n_missing") / F.col("n"))
    f = F.col("fraction")
    return out.withColumn("class", F.when(f == 0, "complete").when(f == 1, "systematic").when(f >= near, "near").otherwise("sporadic"))


def standardised_difference(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, n, mean, pooled_mean, smd) of each group against all other groups, from moments alone."""
    v = F.col(value)
    m = df.where(v.isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.sum(v).alias("s"), F.sum(v * v).alias("q"))
    total = m.agg(F.sum("n").alias("tn"), F.sum("s").alias("ts"), F.sum("q").alias("tq"))
    x = m.join(F.broadcast(total), F.lit(True))  # one row
    rest_n, rest_s, rest_q = F.col("tn") - F.col("n"), F.col("ts") - F.col("s"), F.col("tq") - F.col("q")
    var = lambda n, s, q: (q - s * s / n) / (n - 1)
    mean, other = F.col("s") / F.col("n"), rest_s / rest_n
    spread = F.sqrt((var(F.col("n"), F.col("s"), F.col("q")) + var(rest_n, rest_s, rest_q)) / 2)
    return x.where((F.col("n") > 1) & (rest_n > 1)).select(group, "n", mean.alias("mean"), other.alias("pooled_mean"), F.when(spread > 0, (mean - other) / spread).alias("smd"))


def bootstrap_difference(df: DataFrame, group: str, value: str, key: str, replicates: int = 200, level: float = 0.95) -> DataFrame:
    """(group, low, high): Poisson bootstrap interval of the difference of means, weights drawn from a hash of row and replicate."""
    r = F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("b")
    u = (F.xxhash64(key, "b") % 1_000_003 + 1_000_003) % 1_000_003 / 1_000_003.0
    # Poisson(1) by its inverse distribution function.
    w = F.when(u < 0.36787944, 0).when(u < 0.73575888, 1).when(u < 0.91969860, 2).when(u < 0.98101184, 3).when(u < 0.99634015, 4).otherwise(5)
    rows = df.where(F.col(value).isNotNull()).select(group, F.col(value).alias("v"), key, r).withColumn("w", w)
    m = rows.groupBy(group, "b").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("v")).alias("s"))
    t = m.groupBy("b").agg(F.sum("n").alias("tn"), F.sum("s").alias("ts"))
    d = m.join(t, "b").where("n > 0 and tn > n").select(group, (F.col("s") / F.col("n") - (F.col("ts") - F.col("s")) / (F.col("tn") - F.col("n"))).alias("d"))
    a = (1 - level) / 2
    return d.groupBy(group).agg(F.percentile("d", F.array(F.lit(a), F.lit(1 - a))).alias("q")).select(group, F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))


def provenance(mapped: DataFrame, plan: DataFrame) -> DataFrame:
    """(cdm_table, person_id, field, value, rule_id, cohort_id, dataset_id, column) of each written cell."""
    about = plan.select("rule_id", F.col("dataset_id"), F.col("column"))
    fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in ("concept_id", "source_value", "value_as_number")])).alias("f")
    return mapped.select("cdm_table", "person_id", "cohort_id", "rule_id", fields).select("cdm_table", "person_id", "cohort_id", "rule_id", "f.*").where("value is not null").join(about, "rule_id", "left")


def audit(cells: DataFrame, spec: str) -> DataFrame:
    """Provenance of ``table:row:field``, where the row is a person."""
    parts = spec.split(":")
    if len(parts) != 3 or not all(parts):
        raise ConcordatError(f"audit {spec!r}: table:row:field")
    t, r, f = parts
    return cells.where((F.col("cdm_table") == t) & (F.col("person_id") == r) & (F.col("field") == f))


def emit(mapped: DataFrame, path: str, extension: DataFrame | None = None, pack: str = "pack", compression: str = "zstd", publish_schema: bool = True) -> None:
    """One table for each target that occurs, the pack's own variables beside them, and a JSON Schema of each."""
    domains = {t: d for d, t in DOMAIN_TABLES.items()}
    for table in sorted(r["cdm_table"] for r in mapped.select("cdm_table").distinct().collect()):
        made = table_of(mapped, table, domains[table])
        made.write.mode("overwrite").option("compression", compression).parquet(f"{path}/{table}.parquet")
        if publish_schema:
            write_json(json_schema(made, table), f"{path}/schema/{table}.schema.json")
    if extension is not None:
        extension.write.mode("overwrite").option("compression", compression).parquet(f"{path}/_extension/{pack}.parquet")


JSON_TYPES = {"string": "string", "boolean": "boolean", "double": "number", "float": "number", "bigint": "integer", "int": "integer"}


def json_schema(df: DataFrame, title: str) -> dict:
    """What consumers of a table may rely on; times are texts, null is allowed where a column may hold it."""
    kinds = {f.name: JSON_TYPES.get(f.dataType.simpleString(), "string") for f in df.schema.fields}
    return {
        "$schema": "https://json-schema.org/draft/2020-12/schema",
        "title": title,
        "type": "object",
        "properties": {f.name: {"type": [kinds[f.name], "null"] if f.nullable else kinds[f.name]} for f in df.schema.fields},
        "required": df.columns,
        "additionalProperties": False,
    }
