"""Queries of profiling and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from concordat.config import Params
from concordat.functions import text as X
from concordat.operators import profile as P
from concordat.queries.base import MISSING, cells, cells_sql, query, table
from concordat.sources import tables as T

NAMES = ("customer", "supplier", "part", "orders")
SHOWN = ["dataset_id", "column"]
FLAGS = f"""
c as ({cells_sql(*NAMES)}),
f as (select *, {MISSING} as gone,
        regexp_full_match(value, '[+-]?[0-9]+') as i,
        regexp_full_match(value, '[+-]?([0-9]+\\.[0-9]*|\\.[0-9]+|[0-9]+)([eE][+-]?[0-9]+)?') as n,
        value in ('true','false','True','False','TRUE','FALSE') as b,
        regexp_full_match(value, '[0-9]{{4}}(-(1[0-2]|0?[1-9]))?') or (regexp_full_match(value, '[0-9]{{4}}-(1[0-2]|0?[1-9])-(3[01]|[12][0-9]|0?[1-9])') and try_cast(value as date) is not null) as d
      from c),
k as (select dataset_id, "column", count(*) as n_rows, count(*) filter (gone) as n_missing,
        count(*) filter (not gone) as m, count(*) filter (not gone and i) as ints, count(*) filter (not gone and (i or n)) as nums,
        count(*) filter (not gone and b) as bools, count(*) filter (not gone and d) as dates,
        count(*) filter (not gone and d and not n) as only_dates, count(*) filter (not gone and not n and not d) as others
      from f group by all),
t as (select dataset_id, "column", n_rows, n_missing,
        case when m = 0 then 'empty' when ints = m then 'int' when nums = m then 'float' when bools = m then 'bool' when dates = m then 'date'
             when others > 0 and nums + only_dates > 0 then null else 'str' end as inferred_type
      from k)
"""


@query(f"with {FLAGS} select *, case when inferred_type is null then 'mixed_type' end as reason from t")
def profile_types(spark, sf):
    return P.types(cells(spark, sf, *NAMES), Params()).select(*SHOWN, "n_rows", "n_missing", "inferred_type", "reason")


@query(f"with c as ({cells_sql('customer', 'part')}) select dataset_id, \"column\", count(*) as n_rows, count(*) filter ({MISSING}) as n_missing, count(distinct value) filter (not {MISSING}) as n_unique from c group by all")
def profile_missing(spark, sf):
    c, p = cells(spark, sf, "customer", "part"), Params()
    return P.types(c, p).join(P.uniques(c, p), P.KEY, "left").select(*SHOWN, "n_rows", "n_missing", F.coalesce("n_unique", F.lit(0)).alias("n_unique"))


@query(
    f"""with c as ({cells_sql(*NAMES)}), u as (select dataset_id, "column", count(distinct value) as n_unique, list_sort(list(distinct value)) as v from c where not {MISSING} group by all)
select dataset_id, "column", n_unique, n_unique > 500 as unique_truncated, case when n_unique <= 500 then array_to_string(v, '|') end as unique_values from u"""
)
def profile_distinct_capped(spark, sf):
    u = P.uniques(cells(spark, sf, *NAMES), Params())
    return u.select(*SHOWN, "n_unique", "unique_truncated", F.array_join("unique_values", "|").alias("unique_values"))


@query(
    f"""with {FLAGS}, q as (select f.dataset_id, f."column", quantile_cont(cast(value as double), [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]) as v from f join t using (dataset_id, "column") where inferred_type in ('int', 'float') and not gone group by all)
select dataset_id, "column", [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0][i]::double as p, printf('%.4f', v[i]) as v from q, range(1, 8) r(i)"""
)
def profile_quantiles(spark, sf):
    c, p = cells(spark, sf, *NAMES), Params()
    q = P.quantiles(c, P.types(c, p), p).select(*SHOWN, F.posexplode("quantiles").alias("i", "x"))
    return q.select(*SHOWN, F.element_at(F.array(*[F.lit(x) for x in P.PROBABILITIES]), F.col("i") + 1).alias("p"), F.format_string("%.4f", "x").alias("v"))


@query(
    f"""with c as ({cells_sql('part', 'orders')}), r as (select *, row_number() over (partition by dataset_id, "column" order by row_no) as k from c where not {MISSING})
select dataset_id, "column", string_agg(value, '|' order by row_no) as example_values from r where k <= 5 group by all"""
)
def profile_examples(spark, sf):
    v = P.first_values(cells(spark, sf, "part", "orders"), 5, ~P.is_missing(F.col("value"), Params().na_strings))
    return v.select(*SHOWN, F.array_join("values", "|").alias("example_values"))


def _mixed(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, "not_a_number").otherwise(F.col("p_size").cast("string")).alias("mixed"), F.when(F.col("p_partkey") % 11 == 3, "caf�").otherwise(F.col("p_brand")).alias("broken"), F.lit("").alias("nothing"))
    return T.cells(T.identified(part, "tpch", "part", F.col("p_partkey")), ["mixed", "broken", "nothing"])


@query(
    """select * from (select 'mixed' as "column", 'mixed_type' as reason, (select string_agg('not_a_number', '|') from (select * from part where p_partkey % 5 = 0 limit 3)) as sample
union all select 'broken', 'encoding', (select string_agg('caf' || chr(65533), '|') from (select * from part where p_partkey % 11 = 3 limit 3)))"""
)
def profile_failures(spark, sf):
    c, p = _mixed(spark, sf), Params()
    return P.failures(c, P.types(c, p), p).select("column", "reason", F.array_join("sample", "|").alias("sample"))


HEADERS = (("l_quantity", "OS_MONTHS"), ("l_discount", "RATE_PCT"), ("l_tax", "TAX"), ("l_extendedprice", "GLUCOSE_MGDL"), ("l_linenumber", "DAYS"), ("l_suppkey", "PATIENT_ID"))


@query(
    """with h as (select * from (values ('OS_MONTHS','mo','header:MONTHS',0.9,'q'), ('RATE_PCT','%','header:(%)',0.9,'d'), ('GLUCOSE_MGDL','mg/dL','header:mg/dL',0.9,'p'), ('DAYS','d','header:DAYS',0.9,'n')) v(name, ucum, source, confidence, c)),
r as (select 'OS_MONTHS' as name, min(l_quantity) as lo, max(l_quantity) as hi, 'd' as swap from lineitem union all select 'RATE_PCT', min(l_discount), max(l_discount), null from lineitem
 union all select 'TAX', min(l_tax), max(l_tax), null from lineitem union all select 'GLUCOSE_MGDL', min(l_extendedprice), max(l_extendedprice), null from lineitem
 union all select 'DAYS', min(l_linenumber), max(l_linenumber), 'mo' from lineitem union all select 'PATIENT_ID', min(l_suppkey), max(l_suppkey), null from lineitem)
select name as "column", ucum, source, cast(confidence as double) as confidence from h
union all select name, '1', case when lo >= 0 and hi <= 1 then 'range:0..1' else 'range:0..100' end, 0.3 from r where lo >= 0 and hi <= 100
union all select name, swap, 'range:0..60', 0.3 from r where swap is not null and lo >= 0 and hi <= 60"""
)
def unit_candidates(spark, sf):
    ends = table(spark, sf, "lineitem").agg(*[F.array(F.min(c).cast("double"), F.max(c).cast("double")).alias(n) for c, n in HEADERS]).first()
    rows = [(n, u["ucum"], u["source"], u["confidence"]) for _, n in HEADERS for u in P.unit_candidates(n, ends[n])]
    return spark.createDataFrame(rows, "column string, ucum string, source string, confidence double")


@query(
    """select p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') as normalised, trim(regexp_replace(lower(p_type), '[^a-z0-9]+', ' ', 'g')) as spaced, substr(p_brand, 3, 4) as piece,
case when regexp_full_match(p_brand, '[+-]?[0-9]+') then 1 else 0 end as is_int from part"""
)
def text_functions(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.normalised(F.col("p_name")).alias("normalised"), X.spaced(F.col("p_type")).alias("spaced"), F.substring("p_brand", 3, 4).alias("piece"), X.is_int(F.col("p_brand")).cast("int").alias("is_int"))


@query(
    """with w as (select distinct p_type as t from part), g as (select t, regexp_replace(lower(t), '[^a-z0-9]+', '', 'g') as x from w),
s as (select t, list_distinct(list_transform(range(1, greatest(length(x) - 1, 2)), lambda i: substr(x, i, 3))) as a from g)
select a.t as t1, b.t as t2, printf('%.6f', len(list_intersect(a.a, b.a)) / len(list_distinct(list_concat(a.a, b.a)))) as jaccard from s a, s b where a.t < b.t"""
)
def trigram_jaccard(spark, sf):
    t = table(spark, sf, "part").select(F.col("p_type").alias("t")).distinct()
    g = t.select("t", X.trigrams(X.normalised(F.col("t"))).alias("a"))
    # All types against all: some hundred at any size of the table.
    pairs = g.select(F.col("t").alias("t1"), F.col("a").alias("a1")).join(g.select(F.col("t").alias("t2"), F.col("a").alias("a2")), F.col("t1") < F.col("t2"))
    return pairs.select("t1", "t2", F.format_string("%.6f", X.jaccard(F.col("a1"), F.col("a2"))).alias("jaccard"))


@query(
    """select event_id, printf('%.6f', case when regexp_full_match(x, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') then try_cast(x as double) end) as number
from (select event_id, case event_id % 4 when 0 then cast(event_id as varchar) || 'd' when 1 then '1_000' when 2 then cast(event_id as varchar) || '.5' else '-' || cast(event_id as varchar) end as x from events)"""
)
def number_parse(spark, sf):
    k = F.col("event_id")
    x = F.when(k % 4 == 0, F.concat(k.cast("string"), F.lit("d"))).when(k % 4 == 1, "1_000").when(k % 4 == 2, F.concat(k.cast("string"), F.lit(".5"))).otherwise(F.concat(F.lit("-"), k.cast("string")))
    n = X.to_number(x)
    return table(spark, sf, "events").select("event_id", F.when(n.isNotNull(), F.format_string("%.6f", n)).alias("number"))


@query("select o_orderkey, row_number() over () as row_no from orders")
def row_numbers(spark, sf):
    return T.numbered(table(spark, sf, "orders").select("o_orderkey", "_metadata")).select("o_orderkey", "row_no")


@query(
    """select 'customer#' || c_custkey as record_id, c_name as name, c_mktsegment as segment, cast(null as varchar) as brand from customer
union all select 'part#' || p_partkey, p_name, null, p_brand from part"""
)
def union_by_name(spark, sf):
    c = table(spark, sf, "customer").select(F.concat(F.lit("customer#"), "c_custkey").alias("record_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    p = table(spark, sf, "part").select(F.concat(F.lit("part#"), "p_partkey").alias("record_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return T.union_all([c, p])
