"""Queries of mapping, the invariant harness and derived data."""

from __future__ import annotations

from pyspark.sql import functions as F

from concordat.operators import derive as D
from concordat.operators import invariant as I
from concordat.operators import mapping as M
from concordat.queries.base import cells, cells_sql, query, table

PLAN = [
    ("tpch", "customer", "c_acctbal", "R-bal", "1.0.0", "account_balance", "measurement", "measurement", 105),
    ("tpch", "customer", "c_mktsegment", "R-seg", "1.0.0", "market_segment", "person", "person", 104),
    ("tpch", "orders", "o_totalprice", "R-price", "1.0.0", "total_price", "measurement", "measurement", 103),
    ("tpch", "orders", "o_orderpriority", "R-prio", "1.0.0", "priority", "observation", "observation", 102),
    ("tpch", "orders", "o_orderstatus", "R-stat", "1.0.0", "order_status", "observation", "observation", 101),
]
UNITS = [("R-bal", 2.5, "umol/L"), ("R-price", 0.05551, "mmol/L")]
VALUES = [("R-prio", "1-URGENT", "V-high", "high", 9001), ("R-prio", "2-HIGH", "V-high", "high", 9001), ("R-prio", "5-LOW", "V-low", "low", 0), ("R-stat", "F", "V-done", "done", 9002), ("R-stat", "Z", "V-done", "done", 9002)]
CELLS = f"c as ({cells_sql('customer', 'orders')})"


def _rows(rows) -> str:
    return ", ".join("(" + ", ".join(repr(x) for x in r) + ")" for r in rows)


PLAN_SQL = f"p as (select * from (values {_rows(PLAN)}) x(cohort_id, dataset_id, \"column\", rule_id, rule_version, variable, domain, cdm_table, concept_id))"
VALUE_SQL = f"v as (select * from (values {_rows(VALUES)}) x(rule_id, value, value_rule_id, to_value, value_concept_id))"
UNIT_SQL = f"u as (select * from (values {_rows(UNITS)}) x(rule_id, factor, unit_out))"
NUMBER = "case when regexp_full_match(trim(value), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') then try_cast(value as double) end"
MAPPED_SQL = f"""{CELLS}, {PLAN_SQL}, m as (select 'P-' || record_id as person_id, cdm_table, p.rule_id, variable, concept_id, value, {NUMBER} as number from c join p using (cohort_id, dataset_id, "column") where value is not null)"""


def _joined(spark, sf):
    plan = spark.createDataFrame(PLAN, M.PLAN)
    return M.map_cells(cells(spark, sf, "customer", "orders"), plan, len(PLAN))


def _mapped(spark, sf):
    joined = _joined(spark, sf)
    people = cells(spark, sf, "customer", "orders").select("record_id", F.concat(F.lit("P-"), "record_id").alias("person_id")).distinct()
    return M.mapped_rows(joined, people)


def _units(spark):
    return spark.createDataFrame(UNITS, "rule_id string, factor double, unit_out string")


def _values(spark):
    return spark.createDataFrame(VALUES, "rule_id string, value string, value_rule_id string, to_value string, value_concept_id long")


def _text(c: str, digits: int = 4):
    return F.when(F.col(c).isNotNull(), F.format_string(f"%.{digits}f", c)).alias(c)


@query(f"with {MAPPED_SQL} select person_id, cdm_table, cast(concept_id as bigint) as concept_id, value as source_value, cast(0 as bigint) as source_concept_id, printf('%.4f', number) as value_as_number, rule_id from m")
def map_concepts_long(spark, sf):
    return _mapped(spark, sf).select("person_id", "cdm_table", "concept_id", "source_value", "source_concept_id", _text("value_as_number"), "rule_id")


@query(f"with {CELLS}, {PLAN_SQL} select cohort_id, dataset_id, \"column\", value as source_value, count(*) as n_rows from c anti join p using (cohort_id, dataset_id, \"column\") where value is not null group by all")
def unmapped_values(spark, sf):
    return M.unmapped(_joined(spark, sf))


@query(f"with {CELLS}, {PLAN_SQL} select count(*) as n_source, count(*) filter (rule_id is null) as n_unmapped, count(*) filter (rule_id is null) / count(*) as fraction from c left join p using (cohort_id, dataset_id, \"column\") where value is not null")
def unmapped_fraction(spark, sf):
    return M.unmapped_fraction(_joined(spark, sf))


@query(f"with {MAPPED_SQL}, {UNIT_SQL} select person_id, m.rule_id, printf('%.7f', number * coalesce(factor, 1)) as value_as_number, unit_out as unit_source_value, cast(0 as bigint) as unit_concept_id from m left join u on m.rule_id = u.rule_id")
def convert_units(spark, sf):
    return M.convert_units(_mapped(spark, sf), _units(spark), len(UNITS)).select("person_id", "rule_id", _text("value_as_number", 7), "unit_source_value", "unit_concept_id")


@query(
    f"""with {MAPPED_SQL}, {UNIT_SQL}, x as (select variable, number * coalesce(factor, 1) as n from m left join u on m.rule_id = u.rule_id),
q as (select variable, count(n) as n, quantile_cont(n, 0.01) as low, quantile_cont(n, 0.99) as high from x group by all), a as (select * from (values ('account_balance', true, -3000.0, 30000.0), ('total_price', true, 0.0, 100.0), ('priority', false, null, null), ('market_segment', true, 0.0, 1.0), ('order_status', true, null, null)) t(variable, converted, a, b))
select a.variable, coalesce(n, 0) as n, printf('%.3f', low) as low, printf('%.3f', high) as high, case when not converted then 'not-converted' when a is null then 'no-plausible-range' when coalesce(n, 0) = 0 then 'no-numeric-values' when low >= a and high <= b then 'in-range' else 'out-of-range' end as status
from a left join q on a.variable = q.variable"""
)
def unit_range_check(spark, sf):
    rules = spark.createDataFrame(
        [("R-bal", "account_balance", True, [-3000.0, 30000.0]), ("R-price", "total_price", True, [0.0, 100.0]), ("R-prio", "priority", False, None), ("R-seg", "market_segment", True, [0.0, 1.0]), ("R-stat", "order_status", True, None)],
        "rule_id string, variable string, converted boolean, plausible_range array<double>",
    )
    out = M.range_check(M.convert_units(_mapped(spark, sf), _units(spark), len(UNITS)), rules, (0.01, 0.99))
    return out.select("variable", "n", _text("low", 3), _text("high", 3), "status")


@query(f"with {MAPPED_SQL}, {VALUE_SQL} select person_id, m.rule_id, m.value as source_value, cast(value_concept_id as bigint) as value_as_concept_id, value_rule_id from m left join v on m.rule_id = v.rule_id and m.value = v.value")
def value_map(spark, sf):
    return M.map_values(_mapped(spark, sf), _values(spark), len(VALUES)).select("person_id", "rule_id", "source_value", "value_as_concept_id", "value_rule_id")


@query(
    f"""with {MAPPED_SQL}, {VALUE_SQL}, k as (select v.value_rule_id, v.value, count(*) as n from m join v on m.rule_id = v.rule_id and m.value = v.value group by all), f as (select value_rule_id, count(distinct value) as fan_in from v group by all)
select v.value_rule_id, to_value, v.value as source_value, coalesce(n, 0) as n_rows, fan_in, fan_in > 1 as wide_collapse from v join f using (value_rule_id) left join k using (value_rule_id, value)"""
)
def value_map_collapse(spark, sf):
    return M.collapse_report(M.map_values(_mapped(spark, sf), _values(spark), len(VALUES)), _values(spark), 1)


@query(f"with {MAPPED_SQL}, {VALUE_SQL} select m.rule_id, m.value as source_value, count(*) as n_rows from m where rule_id in (select rule_id from v) and (rule_id, value) not in (select (rule_id, value) from v) group by all")
def value_unmapped(spark, sf):
    return M.values_unclaimed(M.map_values(_mapped(spark, sf), _values(spark), len(VALUES)), _values(spark))


@query(f"with {MAPPED_SQL} select cdm_table, count(*) as n_rows, count(distinct person_id) as n_persons, count(number) as n_numbers from m group by all")
def mapped_tables(spark, sf):
    return _mapped(spark, sf).groupBy("cdm_table").agg(F.count("*").alias("n_rows"), F.countDistinct("person_id").alias("n_persons"), F.count("value_as_number").alias("n_numbers"))


@query(f"with {MAPPED_SQL} select person_id, field, val as value, p.dataset_id, p.\"column\" from (unpivot (select person_id, rule_id, cast(concept_id as varchar) as concept_id, value as source_value from m) on concept_id, source_value into name field value val) x join p using (rule_id)")
def provenance(spark, sf):
    return D.provenance(_mapped(spark, sf), spark.createDataFrame(PLAN, M.PLAN)).where("field <> 'value_as_number'").select("person_id", "field", "value", "dataset_id", "column")


# The invariant harness.


def _event_cells(spark, sf):
    e = table(spark, sf, "events").select(F.lit(I.BASELINE).alias("replicate"), F.lit("stream").alias("cohort_id"), F.lit("events").alias("dataset_id"), F.col("event_id").alias("row_no"), F.concat(F.lit("stream#events#"), "event_id").alias("record_id"), "event_type", F.col("user_id").cast("string").alias("user_id"))
    return e.unpivot(["replicate", "cohort_id", "dataset_id", "row_no", "record_id"], ["event_type", "user_id"], "column", "value")


EVENT_CELLS = "e as (select 'event_type' as \"column\", event_type as value from events union all select 'user_id', cast(user_id as varchar) from events)"


@query(f"with {EVENT_CELLS} select replicate, \"column\", value, count(*) as n from e, (values (-1), (1), (2), (3)) r(replicate) group by all")
def permutation_marginals(spark, sf):
    """Value counts of every replicate: shuffling the outcome moves none."""
    return I.permute(_event_cells(spark, sf), ("event_type",), [1, 2, 3]).groupBy("replicate", "column", "value").agg(F.count("*").alias("n"))


@query("select r as replicate, count(*) as n_unmoved from events, (values (1), (2)) x(r) group by all")
def permutation_untouched(spark, sf):
    """Other columns keep each cell in its row."""
    every = I.permute(_event_cells(spark, sf), ("event_type",), [1, 2])
    base = every.where("replicate = -1 and column = 'user_id'").select("record_id", F.col("value").alias("was"))
    same = every.where("replicate <> -1 and column = 'user_id'").join(base, "record_id").where(F.col("value").eqNullSafe(F.col("was")))
    return same.groupBy("replicate").agg(F.count("*").alias("n_unmoved"))


@query("select 'V' || c_custkey || chr(31) || 'V' || c_name || chr(31) || case when c_custkey % 3 = 0 then 'N' else 'V' || printf('%.6f', c_acctbal) end as row from customer")
def table_digest_rows(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("b"))
    return I.encoded(c)


@query(
    """with h as (select event_type as artefact, cast(user_id % 4 as integer) - 1 as replicate, case when event_type = 'click' then 'same' else event_type || (user_id % 2) end as hash from events)
select artefact, count(*) filter (replicate <> -1) as n, count(distinct hash) as n_distinct, case when count(distinct hash) = 1 then 'proof' else 'leak' end as verdict from h group by all"""
)
def invariance_verdict(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("artefact"), (F.col("user_id") % 4).cast("int").alias("r"), F.when(F.col("event_type") == "click", "same").otherwise(F.concat("event_type", F.col("user_id") % 2)).alias("hash"))
    return I.verdicts(e.select("artefact", (F.col("r") - 1).alias("replicate"), "hash"))


# Derived data.


@query(
    """with x as (select o_orderkey, case o_orderkey % 4 when 0 then strftime(o_orderdate, '%Y') when 1 then strftime(o_orderdate, '%Y-%m') when 2 then strftime(o_orderdate, '%Y-%m-%d') else 'about ' || strftime(o_orderdate, '%Y') end as t, o_orderdate as d from orders)
select o_orderkey, case o_orderkey % 4 when 0 then strftime(d, '%Y') || '-07-01' when 1 then strftime(d, '%Y-%m') || '-15' when 2 then t end as date, case o_orderkey % 4 when 0 then 'year' when 1 then 'month' when 2 then 'day' end as precision, case when o_orderkey % 4 = 3 then 'unreadable' end as reason from x"""
)
def date_precision(spark, sf):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    text = F.when(k % 4 == 0, F.date_format(d, "yyyy")).when(k % 4 == 1, F.date_format(d, "yyyy-MM")).when(k % 4 == 2, F.date_format(d, "yyyy-MM-dd")).otherwise(F.concat(F.lit("about "), F.date_format(d, "yyyy")))
    return D.dates(table(spark, sf, "orders").select(k, text.alias("t")), "t").select("o_orderkey", F.col("date").cast("string").alias("date"), "precision", "reason")


SURVIVAL = """s as (select o_orderpriority as arm, o_orderkey % 50 + 1 as t, case when o_orderstatus = 'F' then 1 else 0 end as event from orders), a as (select arm, t, count(*) as n, sum(event) as events from s group by all),
r as (select *, sum(n) over (partition by arm order by t desc) as at_risk from a)"""


@query(
    f"""with {SURVIVAL} select arm, t as time, cast(at_risk as bigint) as at_risk, cast(events as bigint) as events,
printf('%.6f', exp(sum(case when events < at_risk then ln(1 - events / at_risk) else 0 end) over w) * (1 - max(case when events >= at_risk then 1 else 0 end) over w)) as survival from r window w as (partition by arm order by t)"""
)
def km_curve(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("arm"), (F.col("o_orderkey") % 50 + 1).alias("t"), (F.col("o_orderstatus") == "F").cast("int").alias("event"))
    return D.kaplan_meier(o, "t", "event", ["arm"]).withColumn("survival", F.format_string("%.6f", "survival"))


@query(
    """with x as (select l_orderkey, l_linenumber, o_orderdate as a, l_shipdate as z, case when l_returnflag = 'R' then l_shipdate end as e from lineitem join orders on l_orderkey = o_orderkey)
select l_orderkey, l_linenumber, case when date_diff('day', a, coalesce(e, z)) >= 0 then cast(date_diff('day', a, coalesce(e, z)) as integer) end as time_days, case when date_diff('day', a, coalesce(e, z)) >= 0 then case when e is null then 0 else 1 end end as event from x"""
)
def endpoint(spark, sf):
    x = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    x = x.select("l_orderkey", "l_linenumber", F.col("o_orderdate").alias("a"), F.col("l_shipdate").alias("z"), F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("e"))
    return D.endpoint(x, "a", "e", "z").select("l_orderkey", "l_linenumber", "time_days", "event")


@query(
    """with x as (select o_custkey as s, o_orderkey as t, ['CR','PR','SD','PD','NE'][1 + o_orderkey % 5] as r, 1 + o_orderkey % 5 as k from orders),
h as (select s, case when k <= 2 and not exists (select 1 from x y where y.s = x.s and y.t >= x.t + 28 and y.r <> 'NE' and y.k <= x.k) then 3 else k end as k from x)
select s as subject, ['CR','PR','SD','PD','NE'][min(k)] as best_response from h group by s"""
)
def best_response(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("subject"), F.col("o_orderkey").alias("t"), F.element_at(F.array(*[F.lit(r) for r in D.RESPONSES]), (F.col("o_orderkey") % 5 + 1).cast("int")).alias("r"))
    return D.best_response(o, "subject", "t", "r").select("subject", "best_response")


COVERED = "x as (select c_mktsegment as cohort, 'v' || (o_orderkey % 3) as variable, o_custkey as person, case when o_orderkey % 4 = 0 or o_orderkey % 3 = 2 and c_mktsegment = 'BUILDING' then null else o_totalprice end as value from orders join customer on o_custkey = c_custkey)"


def _covered(spark, sf):
    k = F.col("o_orderkey")
    x = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    gone = (k % 4 == 0) | ((k % 3 == 2) & (F.col("c_mktsegment") == "BUILDING"))
    return x.select(F.col("c_mktsegment").alias("cohort"), F.concat(F.lit("v"), k % 3).alias("variable"), F.col("o_custkey").alias("person"), F.when(~gone, F.col("o_totalprice")).alias("value"))


@query(f"with {COVERED} select cohort, variable, count(distinct person) as n, count(distinct case when value is not null then person end) as n_present, count(distinct case when value is not null then person end) / count(distinct person) as coverage from x group by all")
def coverage_matrix(spark, sf):
    return D.coverage(_covered(spark, sf), "cohort", "variable", "person", "value")


@query(f"with {COVERED}, g as (select cohort, variable, count(*) as n, count(*) filter (value is null) as n_missing from x group by all) select *, n_missing / n as fraction, case when n_missing = 0 then 'complete' when n_missing = n then 'systematic' when n_missing / n >= 0.95 then 'near' else 'sporadic' end as class from g")
def missingness_class(spark, sf):
    return D.missingness(_covered(spark, sf), ["cohort", "variable"], "value")


@query(
    """with g as (select c_mktsegment as segment, count(*) as n, avg(c_acctbal) as m, var_samp(c_acctbal) as v from customer group by all), o as (select a.segment, avg(c_acctbal) as om, var_samp(c_acctbal) as ov from g a join customer b on b.c_mktsegment <> a.segment group by all)
select segment, n, printf('%.6f', m) as mean, printf('%.6f', om) as pooled_mean, printf('%.5f', (m - om) / sqrt((v + ov) / 2)) as smd from g join o using (segment)"""
)
def smd(spark, sf):
    d = D.standardised_difference(table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment"), "c_acctbal"), "segment", "c_acctbal")
    return d.select("segment", "n", _text("mean", 6), _text("pooled_mean", 6), _text("smd", 5))


@query()
def smd_interval(spark, sf):
    return D.bootstrap_difference(table(spark, sf, "customer"), "c_mktsegment", "c_acctbal", "c_custkey", 50)


@query()
def coverage_frontier(spark, sf):
    rows = coverage_matrix(spark, sf).collect()  # cohorts times variables
    cov: dict = {}
    for r in rows:
        cov.setdefault(r["cohort"], {})[r["variable"]] = r["coverage"]
    sizes = {c: max(r["n"] for r in rows if r["cohort"] == c) for c in cov}
    return spark.createDataFrame([(",".join(x["cohorts"]), x["persons"], x["variables"]) for x in D.frontier(cov, sizes)], "cohorts string, persons long, variables int")
