"""Queries of proposals: candidates, channels and the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from concordat.config import Params
from concordat.functions import text as X
from concordat.operators import confirm as K
from concordat.operators import profile as P
from concordat.operators import propose as G
from concordat.queries.base import MISSING, cells, cells_sql, query, table
from concordat.sources.ingest import Pack, Variable

STATUS = ("F", "O", "P", "X")
PRIORITY = ("1-URGENT", "2-HIGH", "3-MEDIUM", "9-NONE")
SEGMENTS = ("automobile", "building", "furniture", "machinery", "household")
PACK = Pack(
    "orders",
    "1.0.0",
    "none",
    (
        Variable("order_status", "observation", 101, "nominal", STATUS),
        Variable("priority", "observation", 102, "ordinal", PRIORITY),
        Variable("total_price", "measurement", 103, "continuous", unit="mg/dL"),
        Variable("market_segment", "person", 104, "nominal", SEGMENTS),
        Variable("account_balance", "measurement", 105, "continuous"),
        Variable("order_date", "observation", 106, None),
        Variable("nation_key", "person", 107, "nominal"),
        Variable("outcome_flag", "observation", 108, "boolean", outcome=True),
    ),
)
SETS = {"order_status": STATUS, "priority": PRIORITY, "market_segment": SEGMENTS}


def _list(v) -> str:
    return "[" + ", ".join(f"'{x}'" for x in v) + "]::varchar[]"


VARS = "v as (select variable, cast(concept_id as bigint) as concept_id, type, dom from (values " + ", ".join(f"('{v.name}', {v.concept_id}, {repr(v.type) if v.type else 'null'}, {_list(v.domain_values)})" for v in PACK.variables if not v.outcome) + ") x(variable, concept_id, type, dom))"
COLS = f"""c as ({cells_sql('customer', 'orders')}), u as (select cohort_id, dataset_id, "column", count(*) as n_rows, count(distinct value) filter (not {MISSING}) as n_unique, list_sort(list(distinct value) filter (not {MISSING})) as vals,
  bool_and(regexp_full_match(value, '[+-]?[0-9]+')) as is_int, bool_and(regexp_full_match(value, '[+-]?([0-9]+\\.[0-9]*|\\.[0-9]+|[0-9]+)([eE][+-]?[0-9]+)?')) as is_float from c group by all)"""
GRAMS = "list_distinct(list_transform(range(1, greatest(length({0}) - 1, 2)), lambda i: substr({0}, i, 3)))"
NORM = "regexp_replace(lower({0}), '[^a-z0-9]+', '', 'g')"
NGRAM = f"""n as (select u.*, v.*, {GRAMS.format(NORM.format('"column"'))} as a, {GRAMS.format(NORM.format('variable'))} as b from u, v)"""
GEN_SQL = f"""with {COLS}, {VARS}, {NGRAM},
g as (select dataset_id, "column", variable, concept_id, 'name_ngram' as generator_id from n where len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) >= 0.2
 union all select dataset_id, "column", variable, concept_id, 'value_set' from n where n_unique between 1 and 500 and len(dom) > 0 and
   len(list_intersect(list_distinct(list_transform(vals, lambda x: lower(trim(x)))), list_transform(dom, lambda x: lower(trim(x))))) / len(list_distinct(list_transform(vals, lambda x: lower(trim(x))))) >= 0.5)"""


def _profiles(spark, sf, *names):
    p = Params()
    rows = [r.asDict() for r in P.profile(cells(spark, sf, *names), p).collect()]  # one row a column
    return G.with_units([r for r in rows if r["reason"] is None], p)


def _frame(spark, profiles):
    keys = ("cohort_id", "dataset_id", "column", "unique_values")
    rows = [(*(x[k] for k in keys), []) for x in profiles]  # units play no part here: headers of these tables name none
    return spark.createDataFrame(rows, "cohort_id string, dataset_id string, column string, unique_values array<string>, candidate_units array<struct<ucum:string,source:string,confidence:double>>")


@query(GEN_SQL + ' select * from g union all select dataset_id, "column", null, null, null from u where (dataset_id, "column") not in (select (dataset_id, "column") from g)')
def candidates(spark, sf):
    made = G.candidates(_frame(spark, _profiles(spark, sf, "customer", "orders")), G.pack_frame(spark, PACK), Params(), PACK.outcomes)
    return made.select("dataset_id", "column", "variable", "concept_id", "generator_id")


@query(
    GEN_SQL
    + """, r as (select dataset_id, "column", variable, dense_rank() over (partition by dataset_id, "column" order by variable) as k from g),
o as (select dataset_id, "column", count(distinct variable) filter (k > 1) as excluded_candidates, coalesce(string_agg(distinct variable, ',' order by variable) filter (k > 1), '') as excluded_variables from r group by all)
select distinct dataset_id, "column", variable, excluded_candidates, excluded_variables from r join o using (dataset_id, "column") where k = 1"""
)
def recall_ceiling(spark, sf):
    made = G.candidates(_frame(spark, _profiles(spark, sf, "customer", "orders")), G.pack_frame(spark, PACK), Params(max_candidates_per_column=1), PACK.outcomes)
    return made.where("variable is not null").select("dataset_id", "column", "variable", "excluded_candidates", "excluded_variables").distinct()


def _evidence(spark, sf, channel):
    profiles = _profiles(spark, sf, "customer", "orders")
    variables = [r.asDict() for r in G.pack_frame(spark, PACK).collect()]
    every = [{k: x[k] for k in G.COLUMN} | {"variable": v["variable"]} for x in profiles for v in variables]
    rows = [(e["dataset_id"], e["column"], e["variable"], None if e["score"] is None else f"{e['score']:.6f}") for e in G.evidence(profiles, every, variables, Params(), PACK.outcomes) if e["channel"] == channel]
    return spark.createDataFrame(rows, "dataset_id string, column string, variable string, score string")


@query(
    f"""with {COLS}, {VARS} select dataset_id, "column", variable, printf('%.6f', case when type is null then null
when type = 'continuous' then case when is_int or is_float then 1.0 else 0.0 end else case when is_int or not is_float then 1.0 else 0.0 end end) as score from u, v"""
)
def channel_type_agreement(spark, sf):
    return _evidence(spark, sf, "type_agreement")


@query(f"with {COLS}, {VARS} select dataset_id, \"column\", variable, printf('%.6f', case when len(dom) > 0 then 1 - abs(n_unique - len(dom)) / greatest(n_unique, len(dom)) when type = 'continuous' then least(1.0, n_unique / n_rows) end) as score from u, v")
def channel_cardinality(spark, sf):
    return _evidence(spark, sf, "cardinality")


@query(
    f"""with {COLS}, {VARS}, l as (select dataset_id, "column", variable, n_unique, dom, list_distinct(list_transform(vals, lambda x: lower(trim(x)))) as a, list_distinct(list_transform(dom, lambda x: lower(trim(x)))) as b from u, v)
select dataset_id, "column", variable, printf('%.6f', case when len(dom) > 0 and n_unique between 1 and 500 then len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) end) as score from l"""
)
def channel_value_overlap(spark, sf):
    return _evidence(spark, sf, "value_overlap")


@query(
    f"""with {COLS}, {VARS}, s as (select dataset_id, "column", variable, trim(regexp_replace(lower("column"), '[^a-z0-9]+', ' ', 'g')) as a, trim(regexp_replace(lower(variable), '[^a-z0-9]+', ' ', 'g')) as b from u, v),
j as (select *, jaro_similarity(a, b) as j, case when left(a, 4) = left(b, 4) then 4 when left(a, 3) = left(b, 3) then 3 when left(a, 2) = left(b, 2) then 2 when left(a, 1) = left(b, 1) then 1 else 0 end as k from s)
select dataset_id, "column", variable, printf('%.6f', j + k * 0.1 * (1 - j)) as score from j"""
)
def channel_name_similarity(spark, sf):
    return _evidence(spark, sf, "name_similarity")


# Fixed scores of four channels for each order, to weigh and rank.
SCORED = """s as (select o_orderkey as key, channel, weight, case channel when 'name' then (o_custkey % 10) / 10.0 when 'value' then case when o_orderkey % 3 = 0 then null else (o_orderkey % 7) / 7.0 end
 when 'type' then case when o_orderkey % 5 = 0 then null else 1.0 end else null end as score from orders, (values ('name', 0.15), ('value', 0.3), ('type', 0.15), ('dist', 0.15)) c(channel, weight)),
e as (select *, case when score is not null then weight else 0 end / nullif(sum(case when score is not null then weight else 0 end) over (partition by key), 0) as effective_weight from s)"""


def _scored(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey", F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.lit(w).alias("weight")) for c, w in (("name", 0.15), ("value", 0.3), ("type", 0.15), ("dist", 0.15))])).alias("c"))
    k, ch = F.col("key"), F.col("c.channel")
    score = F.when(ch == "name", F.col("o_custkey") % 10 / 10.0).when(ch == "value", F.when(k % 3 != 0, k % 7 / 7.0)).when(ch == "type", F.when(k % 5 != 0, 1.0))
    return G.effective_weights(o.select("key", "o_custkey", ch.alias("channel"), F.col("c.weight").alias("weight"), score.alias("score")), ["key"])


@query(f"with {SCORED} select key, channel, printf('%.6f', effective_weight) as effective_weight from e")
def effective_weights(spark, sf):
    return _scored(spark, sf).select("key", "channel", F.format_string("%.6f", "effective_weight").alias("effective_weight"))


@query(
    f"""with {SCORED}, t as (select o_custkey as col, 'v' || (key % 9) as variable, round(sum(score * effective_weight), 6) as total from e join orders on o_orderkey = key group by o_custkey, key),
b as (select col, variable, max(total) as total from t group by all), r as (select *, row_number() over (partition by col order by total desc, variable) as rank from b)
select col, variable, cast(rank as integer) as rank, printf('%.4f', total) as total from r where rank <= 5"""
)
def ledger_topk(spark, sf):
    totals = _scored(spark, sf).groupBy(F.col("o_custkey").alias("col"), "key").agg(F.round(F.sum(F.col("score") * F.col("effective_weight")), 6).alias("total"))
    best = totals.groupBy("col", F.concat(F.lit("v"), F.col("key") % 9).alias("variable")).agg(F.max("total").alias("total"))
    return G.top_proposals(best, ["col"], 5).select("col", "variable", "rank", F.format_string("%.4f", "total").alias("total"))


@query(
    """with m as (select 'tpch' as cohort_id, case when c_custkey % 2 = 0 then 'a' else 'b' end as dataset_id, c_mktsegment as variable, 'col' || (c_nationkey % (1 + length(c_mktsegment) % 3)) as "column" from customer)
select cohort_id, dataset_id, variable, array_to_string(list_sort(list(distinct "column")), ',') as columns from m group by 1, 2, 3 having count(distinct "column") > 1"""
)
def rule_collisions(spark, sf):
    c = table(spark, sf, "customer").select(
        F.lit("tpch").alias("cohort_id"), F.when(F.col("c_custkey") % 2 == 0, "a").otherwise("b").alias("dataset_id"), F.col("c_mktsegment").alias("variable"), F.concat(F.lit("col"), F.col("c_nationkey") % (1 + F.length("c_mktsegment") % 3)).alias("column")
    )
    return K.collisions(c).withColumn("columns", F.array_join("columns", ","))


@query(
    GEN_SQL
    + """, k as (select distinct dataset_id, "column", variable from g)
select k.dataset_id, k."column", k.variable, 6 as n_channels, 2 as n_disabled, 2 + 1 + case when type is null then 1 else 0 end + case when len(dom) = 0 and type is distinct from 'continuous' then 1 else 0 end as n_unscored
from k join v on v.variable = k.variable"""
)
def evidence_channels(spark, sf):
    """Six rows of evidence for each candidate, also of channels that are switched off or can't tell."""
    p, profiles = Params(enabled_channels=("name_similarity", "type_agreement", "cardinality", "distribution_distance")), _profiles(spark, sf, "customer", "orders")
    made = [r.asDict() for r in G.candidates(_frame(spark, profiles), G.pack_frame(spark, PACK), p, PACK.outcomes).collect()]
    rows = [(e["dataset_id"], e["column"], e["variable"], int(e["detail"].get("status") == "disabled"), int(e["status"] != "scored")) for e in G.evidence(profiles, made, [r.asDict() for r in G.pack_frame(spark, PACK).collect()], p, PACK.outcomes)]
    out = spark.createDataFrame(rows, "dataset_id string, column string, variable string, off int, unscored int").groupBy("dataset_id", "column", "variable")
    return out.agg(F.count("*").cast("int").alias("n_channels"), F.sum("off").cast("int").alias("n_disabled"), F.sum("unscored").cast("int").alias("n_unscored"))


UNIT_HEADERS = (("l_quantity", "OS_MONTHS"), ("l_extendedprice", "GLUCOSE_MGDL"), ("l_discount", "RATE_PCT"), ("l_suppkey", "PATIENT_ID"))
UNIT_PACK = Pack("units", "1.0", "none", (Variable("survival", "measurement", 1, "continuous", unit="d"), Variable("sugar", "measurement", 2, "continuous", unit="mg/dL"), Variable("share", "measurement", 3, "continuous", unit="%"), Variable("fraction", "measurement", 4, "continuous", unit="1")))


@query(
    """with r as (select min(l_quantity) as q0, max(l_quantity) as q1, min(l_discount) as d0, max(l_discount) as d1, min(l_suppkey) as s0, max(l_suppkey) as s1, min(l_extendedprice) as p0, max(l_extendedprice) as p1 from lineitem)
select 'OS_MONTHS' as "column", 'survival' as variable, 'unit' as generator_id from r where q0 >= 0 and q1 <= 60
union all select 'GLUCOSE_MGDL', 'sugar', 'unit' union all select 'RATE_PCT', 'share', 'unit'
union all select 'OS_MONTHS', 'fraction', 'unit' from r where q0 >= 0 and q1 <= 100 union all select 'RATE_PCT', 'fraction', 'unit' from r where d0 >= 0 and d1 <= 100
union all select 'PATIENT_ID', 'fraction', 'unit' from r where s0 >= 0 and s1 <= 100 union all select 'GLUCOSE_MGDL', 'fraction', 'unit' from r where p0 >= 0 and p1 <= 100"""
)
def unit_generator(spark, sf):
    """Candidates by unit, from headers and ranges of values."""
    ends = table(spark, sf, "lineitem").agg(*[F.array(F.min(c).cast("double"), F.max(c).cast("double")).alias(n) for c, n in UNIT_HEADERS]).first()
    profiles = G.with_units([{"cohort_id": "tpch", "dataset_id": "lineitem", "column": n, "unique_values": [], "quantiles": ends[n]} for _, n in UNIT_HEADERS], Params())
    rows = [tuple(x[k] for k in ("cohort_id", "dataset_id", "column", "unique_values", "candidate_units")) for x in profiles]
    frame = spark.createDataFrame(rows, "cohort_id string, dataset_id string, column string, unique_values array<string>, candidate_units array<struct<ucum:string,source:string,confidence:double>>")
    made = G.candidates(frame, G.pack_frame(spark, UNIT_PACK), Params(candidate_generators=("unit",)))
    return made.where("variable is not null").select("column", "variable", "generator_id")


@query(
    """with n as (select distinct n_name as a from nation), r as (select distinct r_name as b from region), j as (select a, b, jaro_similarity(lower(a), lower(b)) as j,
case when left(a, 4) = left(b, 4) then 4 when left(a, 3) = left(b, 3) then 3 when left(a, 2) = left(b, 2) then 2 when left(a, 1) = left(b, 1) then 1 else 0 end as k from n, r) select a, b, printf('%.6f', j + k * 0.1 * (1 - j)) as score from j"""
)
def jaro_winkler_names(spark, sf):
    a = [r[0] for r in table(spark, sf, "nation").select("n_name").distinct().collect()]  # fixed, small tables
    b = [r[0] for r in table(spark, sf, "region").select("r_name").distinct().collect()]
    return spark.createDataFrame([(x, y, f"{X.jaro_winkler(x.lower(), y.lower()):.6f}") for x in a for y in b], "a string, b string, score string")
