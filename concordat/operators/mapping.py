"""Confirmed rules applied to cells: concepts, units and value vocabularies.

All rules are one small table; a cell meets its rule in one join, whatever the
number of rules, and one scan serves mapped and unmapped cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.config import DOMAIN_TABLES, Params
from concordat.errors import ConversionError, MappingError, ValueMapError
from concordat.functions import text as X
from concordat.operators import ranks
from concordat.sources.ingest import Pack

KEY = ["cohort_id", "dataset_id", "column"]
BROADCAST_RULES = 100_000

# Conversion factors (analyte, from, to, factor).
UNIT_FACTORS = (
    ("creatinine", "mg/dL", "umol/L", 88.4),
    ("glucose", "mg/dL", "mmol/L", 0.05551),
    ("urea", "mg/dL", "mmol/L", 0.1665),
    ("uric_acid", "mg/dL", "umol/L", 59.48),
    ("bilirubin_total", "mg/dL", "umol/L", 17.1),
    ("calcium", "mg/dL", "mmol/L", 0.2495),
    ("cholesterol_total", "mg/dL", "mmol/L", 0.02586),
    ("triglycerides", "mg/dL", "mmol/L", 0.01129),
    ("albumin", "g/dL", "g/L", 10.0),
    ("hemoglobin", "g/dL", "g/L", 10.0),
)


def small(df: DataFrame, n: int) -> DataFrame:
    """A rule table of ``n`` rows: broadcast while it is small, else left to a shuffled join."""
    return F.broadcast(df) if n <= BROADCAST_RULES else df


def route(rules: list[dict], pack: Pack, p: Params = Params()) -> tuple[list[dict], list[str]]:
    """(plan, notes): where each column rule writes. Rules outside the chosen tables are noted and map nothing."""
    plan, notes = [], []
    for r in rules:
        if r["kind"] != "column_map":
            continue
        name = r["to"]["variable"]
        if name not in pack:
            raise MappingError(f"rule {r['rule_id']} names {name}, which the pack does not declare")
        domain = pack[name].domain
        table = DOMAIN_TABLES.get(domain)
        if table not in p.cdm_domains:
            notes.append(f"{r['from']['column']} -> {name}: {table or domain} is not among the chosen tables")
            continue
        concept = r["to"]["concept_id"] if r["to"]["concept_id"] is not None else pack[name].concept_id
        plan.append({**r["from"], "rule_id": r["rule_id"], "rule_version": r["rule_version"], "variable": name, "domain": domain, "cdm_table": table, "concept_id": concept or 0, "unit_in": r["params"].get("unit_in"), "unit_out": pack[name].unit})
    return plan, notes


PLAN = "cohort_id string, dataset_id string, column string, rule_id string, rule_version string, variable string, domain string, cdm_table string, concept_id long"
MAPPED = ("person_id", "cohort_id", "cdm_table", "domain", "concept_id", "source_value", "source_concept_id", "datetime", "value_as_number", "rule_id", "rule_version")


def map_cells(cells: DataFrame, plan: DataFrame, n_rules: int = 0) -> DataFrame:
    """Every non-null cell with its rule, or with nulls where no rule maps its column."""
    names = [c for c in plan.columns if c not in KEY]
    return cells.where("value is not null").join(small(plan.select(*KEY, *names), n_rules), KEY, "left")


def mapped_rows(joined: DataFrame, persons: DataFrame, keep_source_concept: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """The long mapped table of cells that have a rule; ``persons`` is (record_id, person_id), and ``by`` if given.

    Concept ids are always 64 bits wide, also where there are no rows.
    """
    rows = joined.where("rule_id is not null").join(persons, [*by, "record_id"])
    out = rows.select(
        *by,
        "person_id",
        "cohort_id",
        "cdm_table",
        "domain",
        F.col("concept_id").cast("long").alias("concept_id"),
        F.col("value").alias("source_value"),
        F.lit(0).cast("long").alias("source_concept_id"),
        F.lit(None).cast("timestamp_ntz").alias("datetime"),
        X.to_number(F.col("value")).alias("value_as_number"),
        "rule_id",
        "rule_version",
    )
    return out if keep_source_concept else out.drop("source_concept_id")


def persons_of(people: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return people.select(*by, "person_id", F.explode("source_row_id").alias("record_id"))


def check_attached(joined: DataFrame, mapped: DataFrame) -> None:
    """Each mapped cell has exactly one person."""
    want, got = joined.where("rule_id is not null").count(), mapped.count()
    if want != got:
        raise MappingError(f"{want} cells were to be mapped, {got} have a person")


def unmapped(joined: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(cohort_id, dataset_id, column, source_value, n_rows) of cells without a rule."""
    return joined.where("rule_id is null").groupBy(*by, *KEY, F.col("value").alias("source_value")).agg(F.count("*").alias("n_rows"))


def unmapped_fraction(joined: DataFrame) -> DataFrame:
    """(n_source, n_unmapped, fraction) in one pass."""
    return joined.agg(F.count("*").alias("n_source"), F.count_if(F.col("rule_id").isNull()).alias("n_unmapped")).withColumn("fraction", F.when(F.col("n_source") > 0, F.col("n_unmapped") / F.col("n_source")).otherwise(0.0))


def check_unmapped(joined: DataFrame, p: Params) -> float:
    """To be asked after outputs are written."""
    f = unmapped_fraction(joined).first()["fraction"]
    if f > p.max_unmapped_frac:
        raise MappingError(f"{f:.4f} of the values are unmapped")
    return f


def table_of(mapped: DataFrame, table: str, domain: str) -> DataFrame:
    """One target table with its own column names; with its schema even if empty."""
    names = {"concept_id": f"{domain}_concept_id", "source_value": f"{domain}_source_value", "source_concept_id": f"{domain}_source_concept_id", "datetime": f"{domain}_datetime"}
    return mapped.where(F.col("cdm_table") == table).drop("cdm_table", "domain").withColumnsRenamed(names)


def source_value_column(df: DataFrame) -> str:
    """The one column of source values."""
    found = [c for c in df.columns if c.endswith("_source_value") and c != "unit_source_value"]
    if len(found) != 1:
        raise ValueMapError(f"one source value column is needed, not {found}")
    return found[0]


def factor_table(rows: list[dict] | tuple) -> dict[tuple[str, str, str], float]:
    """Factors by exact (analyte, from, to); a repeated key is refused even if its factors agree."""
    out: dict[tuple[str, str, str], float] = {}
    for r in rows:
        a, b, c, f = (r["analyte"], r["from"], r["to"], r["factor"]) if isinstance(r, dict) else r
        if (a, b, c) in out:
            raise ConversionError(f"{a} {b} -> {c} occurs twice")
        out[a, b, c] = float(f)
    return out


def plan_units(plan: list[dict], factors: dict) -> list[dict]:
    """(rule_id, status, factor, unit_out) of each rule; all refusals come before anything is written.

    A factor is looked up as it stands: no inverse is formed, and none is
    assumed to be 1.
    """
    out = []
    for r in plan:
        if not r["unit_out"]:
            out.append({"rule_id": r["rule_id"], "status": "no-target-unit", "factor": None, "unit_out": None})
        elif r["unit_in"] == r["unit_out"]:
            out.append({"rule_id": r["rule_id"], "status": "identity", "factor": 1.0, "unit_out": r["unit_out"]})
        elif not r["unit_in"]:
            raise ConversionError(f"{r['column']} -> {r['variable']}: its unit is not stated")
        elif (f := factors.get((r["variable"], r["unit_in"], r["unit_out"]))) is None:
            raise ConversionError(f"no factor for {r['variable']} from {r['unit_in']} to {r['unit_out']}")
        else:
            out.append({"rule_id": r["rule_id"], "status": "converted", "factor": f, "unit_out": r["unit_out"]})
    return out


def convert_units(mapped: DataFrame, units: DataFrame, n_rules: int = 0) -> DataFrame:
    """Numbers in target units; ``units`` is (rule_id, factor, unit_out). Column positions stay."""
    names = mapped.columns
    met = mapped.join(small(units.select("rule_id", "factor", "unit_out"), n_rules), "rule_id", "left")
    number = F.when(F.col("factor").isNotNull(), F.col("value_as_number") * F.col("factor")).otherwise(F.col("value_as_number"))
    cols = [number.alias(c) if c == "value_as_number" else F.col(c) for c in names]
    return met.select(*cols, F.lit(0).cast("long").alias("unit_concept_id"), F.col("unit_out").alias("unit_source_value"))


def range_check(converted: DataFrame, rules: DataFrame, quantiles: tuple[float, float]) -> DataFrame:
    """(variable, n, low, high, status) of each variable over all its rules.

    ``rules`` is (rule_id, variable, converted, plausible_range).
    """
    r = F.broadcast(rules) if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else rules
    numbers = converted.where("value_as_number is not null").join(r.select("rule_id", "variable"), "rule_id").groupBy("variable", F.col("value_as_number").alias("x")).agg(F.count("*").alias("n"))
    rows = ranks.quantiles(numbers, ["variable"], quantiles, n="n", totals=True).select("variable", F.col("total").alias("n"), F.col("quantiles").alias("q"))
    about = rules.groupBy("variable").agg(F.max("converted").alias("converted"), F.first("plausible_range", True).alias("range"))
    out = about.join(rows, "variable", "left")
    status = (
        F.when(~F.col("converted"), "not-converted")
        .when(F.col("range").isNull(), "no-plausible-range")
        .when(F.coalesce("n", F.lit(0)) == 0, "no-numeric-values")
        .when((F.col("q")[0] >= F.col("range")[0]) & (F.col("q")[1] <= F.col("range")[1]), "in-range")
        .otherwise("out-of-range")
    )
    return out.select("variable", F.coalesce("n", F.lit(0)).alias("n"), F.col("q")[0].alias("low"), F.col("q")[1].alias("high"), status.alias("status"))


def check_ranges(rows: list[dict], p: Params) -> list[dict]:
    """To be asked after the report is written."""
    if p.fail_on_implausible_range and (bad := [r["variable"] for r in rows if r["status"] == "out-of-range"]):
        raise ConversionError(f"implausible after conversion: {sorted(bad)}")
    return rows


def plan_values(rules: list[dict], pack: Pack) -> list[dict]:
    """(column_rule_id, value, value_rule_id, to, concept_id) of each claimed value; refusals first."""
    columns = {tuple(r["from"][k] for k in KEY): r for r in rules if r["kind"] == "column_map"}
    out, claimed = [], {}
    for r in rules:
        if r["kind"] != "value_map":
            continue
        key, name = tuple(r["from"][k] for k in KEY), r["to"]["variable"]
        if name not in pack:
            raise ValueMapError(f"{name} is not declared")
        if pack[name].domain == "derived":
            raise ValueMapError(f"{name} is derived")
        if r["to"]["value"] not in pack[name].domain_values:
            raise ValueMapError(f"{r['to']['value']!r} is no value of {name}")
        if key not in columns:
            raise ValueMapError(f"{key} has a value map but no column map")
        for v in r["from"]["values"]:
            at = (columns[key]["rule_id"], v)
            if at in claimed:
                raise ValueMapError(f"{v!r} of {key} is claimed twice")
            claimed[at] = r["rule_id"]
            out.append({"rule_id": at[0], "value": v, "value_rule_id": r["rule_id"], "to_value": r["to"]["value"], "value_concept_id": r["to"]["concept_id"] or 0})
    return out


def map_values(mapped: DataFrame, values: DataFrame, n_values: int = 0, source: str = "source_value") -> DataFrame:
    """Adds value_as_concept_id (null: not claimed; 0: claimed without a concept) and value_rule_id."""
    v = values.select("rule_id", F.col("value").alias(source), F.col("value_concept_id").cast("long").alias("value_as_concept_id"), "value_rule_id")
    names = mapped.columns
    return mapped.join(small(v, n_values), ["rule_id", source], "left").select(*names, "value_as_concept_id", "value_rule_id")


def collapse_report(rewritten: DataFrame, values: DataFrame, max_fan_in: int, source: str = "source_value") -> DataFrame:
    """(value_rule_id, to_value, source_value, n_rows, fan_in, wide_collapse) of each claimed value, also of those in no row."""
    counts = rewritten.where("value_rule_id is not null").groupBy("value_rule_id", F.col(source).alias("source_value")).agg(F.count("*").alias("n_rows"))
    fan = values.groupBy("value_rule_id").agg(F.countDistinct("value").alias("fan_in"))
    claimed = values.select("value_rule_id", "to_value", F.col("value").alias("source_value"))
    return claimed.join(fan, "value_rule_id").join(counts, ["value_rule_id", "source_value"], "left").select(
        "value_rule_id", "to_value", "source_value", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "fan_in", (F.col("fan_in") > max_fan_in).alias("wide_collapse")
    )


def values_unclaimed(rewritten: DataFrame, values: DataFrame, source: str = "source_value") -> DataFrame:
    """(rule_id, source_value, n_rows) of values that no group of their rule claims."""
    with_groups = values.select("rule_id").distinct()
    return rewritten.where("value_rule_id is null").join(with_groups, "rule_id", "left_semi").groupBy("rule_id", F.col(source).alias("source_value")).agg(F.count("*").alias("n_rows"))


def check_values(unclaimed: DataFrame, p: Params) -> int:
    n = unclaimed.count()
    if n and p.unmapped_value_policy == "fail":
        raise ValueMapError(f"{n} values are claimed by no group")
    return n


def plan_frame(spark: SparkSession, plan: list[dict]) -> DataFrame:
    names = [x.split()[0] for x in PLAN.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in plan], PLAN)
