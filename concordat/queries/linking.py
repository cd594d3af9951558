"""Queries of record linkage, on customers and suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from concordat.config import Params
from concordat.operators import linkage as L
from concordat.queries.base import dataset, query

RULES = L.parse_rules([{"id": "br_nation_segment", "on": ["c_nationkey", "c_mktsegment"]}, {"id": "br_name", "on": ["substr(c_name, 1, 17)", "c_nationkey"]}, {"id": "br_mrn", "on": ["mrn"]}])
NATION = L.parse_rules([{"id": "br_nation", "on": ["c_nationkey"]}])
SUPPLIERS = L.parse_rules([{"id": "br_nation", "on": ["s_nationkey"]}])
LIMIT = 60
ID = "'tpch#customer#' || c_custkey"
KEYED = f"""k as (select 'br_nation_segment' as rule_id, {ID} as id, cast(c_nationkey as varchar) || chr(31) || c_mktsegment as b from customer where c_mktsegment <> ''
 union all select 'br_name', {ID}, substr(c_name, 1, 17) || chr(31) || cast(c_nationkey as varchar) from customer where c_name <> '')"""


def _customers(spark, sf):
    return dataset(spark, sf, "customer")


@query(f"with {KEYED} select 'tpch' as cohort_id, x.id as left_id, y.id as right_id, x.rule_id as blocking_rule_id from k x join k y on x.rule_id = y.rule_id and x.b = y.b and x.id < y.id")
def block_pairs(spark, sf):
    return L.block(_customers(spark, sf), RULES, 10_000)[0]


@query(f"with {KEYED}, b as (select rule_id, b, count(*) as n from k group by all having count(*) > 1) select rule_id, count(*) as n_blocks, cast(sum(n) as bigint) as n_records, cast(sum(n * (n - 1) // 2) as bigint) as n_pairs, max(n) as largest from b group by all")
def block_report(spark, sf):
    blocks = L.block(_customers(spark, sf), RULES, 10_000)[1]
    return blocks.groupBy("rule_id").agg(F.count("*").alias("n_blocks"), F.sum("n").alias("n_records"), F.sum(F.expr("n * (n - 1) div 2")).alias("n_pairs"), F.max("n").alias("largest"))


@query(f"with b as (select cast(c_nationkey as varchar) as block_key, count(*) as n from customer group by all having count(*) > 1) select 'br_nation' as rule_id, n > {LIMIT} as skipped, count(*) as n_blocks, cast(sum(n) as bigint) as n_records from b group by all")
def block_oversize_skip(spark, sf):
    blocks = L.block(_customers(spark, sf), NATION, LIMIT)[1]
    return blocks.groupBy("rule_id", "skipped").agg(F.count("*").alias("n_blocks"), F.sum("n").alias("n_records"))


NARROW = L.parse_rules([{"id": "br_narrow", "on": ["c_nationkey", "c_mktsegment", "substr(c_name, 18, 1)"]}])


@query(f"with k as (select {ID} as id, c_nationkey, c_mktsegment, substr(c_name, 18, 1) as x from customer), n as (select *, count(*) over (partition by c_nationkey, c_mktsegment, x) as n from k) select id as record_id from n where n = 1 or x = '' or c_mktsegment = ''")
def block_unblocked(spark, sf):
    """Records that no block brings together with another."""
    records = _customers(spark, sf)
    pairs, _ = L.block(records, NARROW, 10_000)
    touched = pairs.select(F.explode(F.array("left_id", "right_id")).alias("record_id"))
    return records.select("record_id").join(touched, "record_id", "left_anti")


SPEC = L.parse_comparisons(
    {
        "fields": [
            {"name": "nation", "on": "s_nationkey", "compare": "exact", "m": {"agree": 0.9, "disagree": 0.06, "missing": 0.04}, "u": {"agree": 0.04, "disagree": 0.91, "missing": 0.05}},
            {"name": "name", "on": "s_name", "compare": "prefix:16", "m": {"agree": 0.85, "disagree": 0.05, "missing": 0.1}, "u": {"agree": 0.2, "disagree": 0.7, "missing": 0.1}},
            {"name": "balance", "on": "s_acctbal", "compare": "numeric:250", "m": {"agree": 0.94, "disagree": 0.05, "missing": 0.01}, "u": {"agree": 0.05, "disagree": 0.94, "missing": 0.01}},
            {"name": "mrn", "on": "mrn", "compare": "exact_ci", "m": {"agree": 0.8, "disagree": 0.1, "missing": 0.1}, "u": {"agree": 0.3, "disagree": 0.3, "missing": 0.4}},
        ]
    }
)
# One supplier in seven has no balance.
SUPPLIER = "s as (select 'tpch#supplier#' || s_suppkey as id, cast(s_nationkey as varchar) as nation, s_name as name, case when s_suppkey % 7 = 0 then null else s_acctbal end as bal from supplier)"
LEVEL_SQL = """case when x.nation = y.nation then 'agree' else 'disagree' end as nation, case when lower(substr(x.name, 1, 16)) = lower(substr(y.name, 1, 16)) then 'agree' else 'disagree' end as name,
case when x.bal is null or y.bal is null then 'missing' when abs(x.bal - y.bal) <= 250 then 'agree' else 'disagree' end as balance, 'missing' as mrn"""
LEVELS_SQL = f"{SUPPLIER}, l as (select x.id as left_id, y.id as right_id, {LEVEL_SQL} from s x join s y on x.nation = y.nation and x.id < y.id)"


def _suppliers(spark, sf):
    s = dataset(spark, sf, "supplier")
    return s.withColumn("s_acctbal", F.when(F.col("row_no") % 7 != 0, F.col("s_acctbal")))


def _levels(spark, sf):
    records = _suppliers(spark, sf)
    return L.compare(L.block(records, SUPPLIERS, 10_000)[0], records, SPEC)


@query(f"with {LEVELS_SQL} select * from l")
def compare_levels(spark, sf):
    return _levels(spark, sf).drop("cohort_id")


@query(f"with {LEVELS_SQL} select nation, name, balance, mrn, count(*) as n from l group by all")
def vector_counts(spark, sf):
    return L.vector_counts(_levels(spark, sf), SPEC)


@query(
    f"""with {SUPPLIER}, l as (select {LEVEL_SQL} from s x join s y on x.id < y.id), u as (unpivot l on nation, name, balance, mrn into name field value level),
g as (select field, level, count(*) / (select count(*) from l) as u from u group by all), a as (select * from (select distinct field from g), (values ('agree'), ('disagree'), ('missing')) v(level))
select a.field, a.level, printf('%.9f', greatest(coalesce(u, 0), 1e-9)) as u from a left join g on a.field = g.field and a.level = g.level"""
)
def u_exact(spark, sf):
    u = L.exact_u(_suppliers(spark, sf), SPEC)
    return spark.createDataFrame([(f, k, f"{x:.9f}") for f, v in u.items() for k, x in v.items()], "field string, level string, u string")


def _weights():
    return L.weight_table(SPEC, {c.name: c.m for c in SPEC}, {c.name: c.u for c in SPEC})


def _case(c: L.Comparison) -> str:
    return f"case l.{c.name} " + " ".join(f"when '{k}' then log2({c.m[k]} / {c.u[k]})" for k in L.LEVELS) + " end"


SCORES_SQL = f"{LEVELS_SQL}, w as (select *, {' + '.join(_case(c) for c in SPEC)} as weight from l)"
BANDS = Params(match_threshold=6.0, clerical_threshold=2.0)


@query(f"with {SCORES_SQL} select left_id, right_id, printf('%.6f', weight) as match_weight, 'nation=' || nation || ';name=' || name || ';balance=' || balance || ';mrn=' || mrn as fields from w")
def pair_scores(spark, sf):
    s = L.score(_levels(spark, sf), SPEC, _weights())
    fields = F.array_join(F.transform("per_field_agreement", lambda x: F.concat(x["field"], F.lit("="), x["level"])), ";")
    return s.select("left_id", "right_id", F.format_string("%.6f", "match_weight").alias("match_weight"), fields.alias("fields"))


@query(f"with {SCORES_SQL} select case when weight >= 6 then 'link' when weight >= 2 then 'clerical' else 'distinct' end as band, count(*) as n from w group by all")
def link_bands(spark, sf):
    return L.banded(L.score(_levels(spark, sf), SPEC, _weights()), BANDS).groupBy("band").agg(F.count("*").alias("n"))


@query(
    f"""with {SCORES_SQL}, r as (select least(min(weight), 2.0) as a, greatest(max(weight), 6.0) as b from w), e as (select a - (b - a) * 0.05 as lo, b + (b - a) * 0.05 as hi from r)
select cast(least(greatest(floor((weight - lo) / (hi - lo) * 60), 0), 59) as integer) as bin, count(*) as n from w, e group by all"""
)
def match_histogram(spark, sf):
    return L.histogram(L.score(_levels(spark, sf), SPEC, _weights()), BANDS)[2]


@query(
    f"""with recursive {SCORES_SQL}, e as (select left_id as a, right_id as b from w where weight >= 6 union select right_id, left_id from w where weight >= 6),
r(id, root) as (select id, id from s union select e.b, r.root from r join e on e.a = r.id), c as (select id, min(root) as root from r group by all),
p as (select root, list_sort(list(id)) as m from c group by all)
select 'P-' || substr(sha256('tpch' || chr(31) || array_to_string(m, chr(31))), 1, 16) as person_id, array_to_string(m, ',') as members from p"""
)
def components_person_id(spark, sf):
    records = _suppliers(spark, sf)
    scores = L.score(L.compare(L.block(records, SUPPLIERS, 10_000)[0], records, SPEC), SPEC, _weights())
    return L.resolve(records, scores.where("match_weight >= 6")).select("person_id", F.array_join("source_row_id", ",").alias("members"))


@query(f"with {SCORES_SQL}, counted as (select count(*) as n_links from w where weight >= 6) select (select count(*) from s) as n_in, n_links from counted")
def link_counts(spark, sf):
    records = _suppliers(spark, sf)
    scores = L.score(_levels(spark, sf), SPEC, _weights())
    links = scores.agg(F.count_if(F.col("match_weight") >= 6).alias("n_links"))
    return records.agg(F.count("*").alias("n_in")).join(links, F.lit(True))
