"""Queries of control files, sources and sinks, linkage reports, evidence, decisions and rules."""

from __future__ import annotations

import hashlib
import json
import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from concordat.config import DOMAIN_TABLES, Params
from concordat.functions import text as X
from concordat.operators import classes as C
from concordat.operators import confirm as K
from concordat.operators import derive as D
from concordat.operators import linkage as L
from concordat.operators import mapping as M
from concordat.operators import propose as G
from concordat.operators import ranks
from concordat.queries import linking, proposing
from concordat.queries.base import dataset, query, table
from concordat.sources import ingest as S
from concordat.sources import tables as T
from concordat.storage import scratch

NATIONS = "nation join region on n_regionkey = r_regionkey"


def _nations(spark, sf):
    """(nation, region, key): some dozens of rows at any scale, so they may make a control file."""
    rows = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return [(r[0], r[1], r[2]) for r in rows.select("n_name", "r_name", "n_nationkey").orderBy("n_nationkey").collect()]


@query(f"select r_name as cohort_id, n_name as dataset_id, 'clinical' as role, n_nationkey % 5 = 0 as holdout from {NATIONS} where n_nationkey % 5 <> 0 or n_nationkey = 10")
def sheet_admission(spark, sf):
    """A samplesheet written, read, checked, sealed and listed; one held-out dataset is unsealed."""
    found = _nations(spark, sf)
    opened = next(n for n, _, k in found if k == 10)
    with tempfile.TemporaryDirectory() as d:
        T.write_strict_csv(f"{d}/sheet.csv", list(S.SHEET_COLUMNS), [[r, n, "clinical", "file:///data", str(k % 5 == 0).lower()] for n, r, k in found])
        lines = S.manifest(S.admitted(S.read_sheet(f"{d}/sheet.csv"), S.Lock((opened,))))
    rows = [tuple(json.loads(x)[k] for k in ("cohort_id", "dataset_id", "role", "holdout")) for x in lines]
    return spark.createDataFrame(rows, "cohort_id string, dataset_id string, role string, holdout boolean")


@query(f"select n_name as dataset_id, sha256('input=' || n_name || chr(10) || 'concept_pack=' || r_name || chr(10) || 'allow_single_dataset=' || case when n_nationkey % 2 = 0 then 'true' else 'false' end) as params_hash from {NATIONS}")
def params_hashes(spark, sf):
    """The hash that a lock must name, logged for each dataset that it opens."""
    with tempfile.TemporaryDirectory() as d:
        for n, r, k in _nations(spark, sf):
            h = S.params_hash(n, r, k % 2 == 0)
            T.write_json({"covers": [n], "params_hash": h}, f"{d}/lock.json")
            S.open_lock([n], f"{d}/lock.json", h, None, f"{d}/log")
        rows = [x.split("\t") for x in Path(f"{d}/log").read_text().splitlines()]
    return spark.createDataFrame([(x[1], x[3]) for x in rows], "dataset_id string, params_hash string")


@query("""select c_custkey as row_id, c_name || ', "' || c_mktsegment || '"' || chr(10) || c_nationkey as quoted, nullif(c_mktsegment, 'BUILDING') as segment, cast(c_acctbal as varchar) as balance from customer""")
def csv_round_trip(spark, sf):
    """A table with quotes, commas and line breaks inside of cells, through CSV and back as text."""
    quoted = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\n'), "c_nationkey")
    df = table(spark, sf, "customer").select(F.col("c_custkey").alias("row_id"), quoted.alias("quoted"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), F.col("c_acctbal").alias("balance"))
    path = scratch(spark, "round-trip")
    T.as_text(df).write.csv(path, header=True, escape='"', nullValue="")
    back = T.read_text_csv(spark, path, df.columns)
    return back.select(F.col("row_id").cast("long").alias("row_id"), "quoted", "segment", "balance")


@query("select p_brand, count(*) as n, min(p_partkey) as first from part group by p_brand")
def sorted_sink(spark, sf):
    """Rows counted and numbered after a sorted Parquet sink."""
    path = scratch(spark, "sorted")
    T.write_parquet(table(spark, sf, "part").select("p_partkey", "p_brand"), path, ["p_brand", "p_partkey"])
    return T.read_parquet(spark, path).groupBy("p_brand").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first"))


TARGETS = [(d, t) for d, t in DOMAIN_TABLES.items() if t in Params().cdm_domains]


@query("select * from (values " + ", ".join(f"('{t}', '{d}_source_value', 9, cast(0 as bigint))" for d, t in TARGETS) + ") v(cdm_table, source_column, n_columns, n_rows)")
def empty_targets(spark, sf):
    """Target tables without rows keep their schema, with one column of source values each."""
    none = _mapped(spark, sf).where("false")
    out = []
    for d, t in TARGETS:
        made = M.table_of(none, t, d)
        out.append((t, M.source_value_column(made), len(made.columns), made.count()))
    return spark.createDataFrame(out, "cdm_table string, source_column string, n_columns int, n_rows long")


def _mapped(spark, sf):
    cells = T.cells(dataset(spark, sf, "customer"), ["c_mktsegment"])
    plan = spark.createDataFrame([("tpch", "customer", "c_mktsegment", "R-1", "1.0", "segment", "person", "person", 104)], M.PLAN)
    people = table(spark, sf, "customer").select(F.concat(F.lit("tpch#customer#"), "c_custkey").alias("record_id"), F.concat(F.lit("P-"), "c_custkey").alias("person_id"))
    return M.mapped_rows(M.map_cells(cells, plan, 1), people)


@query(
    f"""with {linking.KEYED}, b as (select rule_id, b, count(*) as n from k group by all having count(*) > 1), p as (select x.rule_id, x.id as l, y.id as r from k x join k y on x.rule_id = y.rule_id and x.b = y.b and x.id < y.id),
per as (select rule_id, count(*) as n_blocks, cast(sum(n * (n - 1) // 2) as bigint) as n_pairs from b group by rule_id), every as (select * from per union all select 'br_mrn', 0, 0),
touched as (select count(distinct id) as t from (select l as id from p union all select r from p))
select rule_id, n_pairs, n_blocks, rule_id = 'br_mrn' as not_applicable, (select count(*) from (select distinct l, r from p)) as n_candidate_pairs, (select count(*) from customer) - t as n_records_unblocked,
(select count(*) from (select distinct l, r from p)) / (select count(*) * (count(*) - 1) / 2 from customer) > 0.001 as warned from every, touched"""
)
def block_run_report(spark, sf):
    """The report of a blocking run: each rule's counts, the run's totals and whether it warns."""
    records = linking._customers(spark, sf)
    _, blocks = L.block(records, linking.RULES, 10_000)
    r = L.block_report(records, linking.RULES, None, blocks, 0.001)
    rows = [(x["rule_id"], x["n_pairs"], x["n_blocks"], bool(x["not_applicable_columns"]), r["n_candidate_pairs"], r["n_records_unblocked"], any("cross product" in w for w in r["warnings"])) for x in r["rules"]]
    return spark.createDataFrame(rows, "rule_id string, n_pairs long, n_blocks long, not_applicable boolean, n_candidate_pairs long, n_records_unblocked long, warned boolean")


def _em_sql(rounds: int) -> str:
    """Expectation-maximisation unrolled: a table of weights and a row of parameters for each round."""
    spec, floor = linking.SPEC, "1e-9"
    cols = [(c.name, k) for c in spec for k in L.LEVELS]
    first = ", ".join(f"{c.m[k]} as {c.name}_{k}" for c in spec for k in L.LEVELS)
    parts = [f"{linking.LEVELS_SQL}, v as (select nation, name, balance, mrn, count(*) as n from l group by all), m0 as (select 0.1::double as lam, {first})"]
    m = " * ".join(f"greatest(case v.{c.name} " + " ".join(f"when '{k}' then {c.name}_{k}" for k in L.LEVELS) + f" end, {floor})" for c in spec)
    u = " * ".join(f"greatest(case v.{c.name} " + " ".join(f"when '{k}' then {c.u[k]}" for k in L.LEVELS) + f" end, {floor})" for c in spec)
    for i in range(rounds):
        parts.append(f"g{i} as materialized (select v.*, lam * {m} / (lam * {m} + (1 - lam) * {u}) as g from v, m{i})")
        # Without pairs nothing is learnt.
        sums = ", ".join(f"case when sum(g * n) > 0 then greatest(coalesce(sum(g * n) filter ({f} = '{k}'), 0) / sum(g * n), {floor}) else (select {f}_{k} from m{i}) end as {f}_{k}" for f, k in cols)
        parts.append(f"m{i + 1} as materialized (select case when sum(g * n) > 0 then sum(g * n) / sum(n) else (select lam from m{i}) end as lam, {sums} from g{i})")
    each = " union all ".join(f"select '{c.name}' as field, '{k}' as level, printf('%.6f', {c.name}_{k}) as m, printf('%.5f', log2({c.name}_{k} / {c.u[k]})) as weight from m{rounds}" for c in spec for k in L.LEVELS)
    return f"with {', '.join(parts)} {each}"


@query(_em_sql(20))
def em_weights(spark, sf):
    """m by expectation-maximisation over the suppliers' pairs, and the weights that follow."""
    spec, names = linking.SPEC, [c.name for c in linking.SPEC]
    vectors = sorted((tuple(r[n] for n in names), r["n"]) for r in linking.vector_counts(spark, sf).collect())
    u = {c.name: c.u for c in spec}
    m, _ = L.em(vectors, spec, u, 20)
    w = L.weight_table(spec, m, u)
    return spark.createDataFrame([(f, k, f"{m[f][k]:.6f}", f"{w[f][k]:.5f}") for f in names for k in L.LEVELS], "field string, level string, m string, weight string")


@query(
    f"""with recursive {linking.SCORES_SQL}, e as (select left_id as a, right_id as b from w where weight >= 6 union select right_id, left_id from w where weight >= 6),
r(id, root) as (select id, id from s union select e.b, r.root from r join e on e.a = r.id), c as (select id, min(root) as root from r group by all),
p as (select root, 'P-' || substr(sha256('tpch' || chr(31) || string_agg(id, chr(31) order by id)), 1, 16) as person_id from c group by root)
select id as record_id, person_id from c join p using (root)"""
)
def record_persons(spark, sf):
    """The person of each record, unnested from the persons' rows."""
    records = linking._suppliers(spark, sf)
    links = C.links(C.classes(records, linking.SUPPLIERS, linking.SPEC), linking._weights(), linking.BANDS.match_threshold)
    return M.persons_of(L.resolve(records, links)).select("record_id", "person_id")


@query(
    f"""with {linking.SCORES_SQL}, recs as (select count(*) as n from s), n as (select count(*) filter (weight >= 6) as links, count(*) filter (weight >= 2 and weight < 6) as clerical from w)
select recs.n as n_in, links as n_linked_pairs, clerical as n_clerical_pairs from recs, n"""
)
def link_report(spark, sf):
    records = linking._suppliers(spark, sf)
    made, weights = C.classes(records, linking.SUPPLIERS, linking.SPEC), linking._weights()
    people = L.resolve(records, C.links(made, weights, linking.BANDS.match_threshold))
    r = L.report_of(C.bands(C.vector_counts(made), linking.SPEC, weights, linking.BANDS), people)
    return spark.createDataFrame([(r["n_in"], r["n_linked_pairs"], r["n_clerical_pairs"])], "n_in long, n_linked_pairs long, n_clerical_pairs long")


SCORE_SQL = f"""{proposing.GEN_SQL},
k as (select distinct g.dataset_id, g."column", g.variable, g.concept_id from g),
s as (select k.*, u.*, v.type, v.dom, trim(regexp_replace(lower(k."column"), '[^a-z0-9]+', ' ', 'g')) as a, trim(regexp_replace(lower(k.variable), '[^a-z0-9]+', ' ', 'g')) as b,
  list_distinct(list_transform(vals, lambda x: lower(trim(x)))) as av, list_distinct(list_transform(dom, lambda x: lower(trim(x)))) as bv
  from k join u on u.dataset_id = k.dataset_id and u."column" = k."column" join v on v.variable = k.variable),
j as (select *, jaro_similarity(a, b) as jj, case when left(a, 4) = left(b, 4) then 4 when left(a, 3) = left(b, 3) then 3 when left(a, 2) = left(b, 2) then 2 when left(a, 1) = left(b, 1) then 1 else 0 end as pre from s),
e as (select *, jj + pre * 0.1 * (1 - jj) as c1, case when type is null then null when type = 'continuous' then case when is_int or is_float then 1.0 else 0.0 end else case when is_int or not is_float then 1.0 else 0.0 end end as c2,
  case when len(dom) > 0 then 1 - abs(n_unique - len(dom)) / greatest(n_unique, len(dom)) when type = 'continuous' then least(1.0, n_unique / n_rows) end as c3,
  case when len(dom) > 0 and n_unique between 1 and 500 then len(list_intersect(av, bv)) / len(list_distinct(list_concat(av, bv))) end as c4 from j),
t as (select dataset_id, "column", variable, concept_id, (coalesce(c1 * 0.15, 0) + coalesce(c2 * 0.15, 0) + coalesce(c3 * 0.1, 0) + coalesce(c4 * 0.3, 0))
  / (0.15 + case when c2 is null then 0 else 0.15 end + case when c3 is null then 0 else 0.1 end + case when c4 is null then 0 else 0.3 end) as total from e),
r as (select *, row_number() over (partition by dataset_id, "column" order by round(total, 4) desc, variable) as rank from t)"""


@query(SCORE_SQL + ' select dataset_id, "column", cast(rank as integer) as rank, variable, concept_id, printf(\'%.4f\', total) as total from r where rank <= 5')
def evidence_ledger(spark, sf):
    """The ranked ledger of two tables as rows: candidates, six channels, weights and totals."""
    p, profiles = Params(), proposing._profiles(spark, sf, "customer", "orders")
    made = [r.asDict() for r in G.candidates(proposing._frame(spark, profiles), G.pack_frame(spark, proposing.PACK), p, proposing.PACK.outcomes).collect()]
    rows = G.evidence(profiles, made, [r.asDict() for r in G.pack_frame(spark, proposing.PACK).collect()], p, proposing.PACK.outcomes)
    out = [(e["dataset_id"], e["column"], i, x["variable"], x["concept_id"], f"{x['total']:.4f}") for e in G.ledger(made, rows, p) for i, x in enumerate(e["proposals"], 1)]
    return spark.createDataFrame(out, "dataset_id string, column string, rank int, variable string, concept_id long, total string")


UNITS = ("d", "wk", "mo", "a", "mg", "g", "kg", "cm")


@query(
    f"""with s(u, kind, size) as (values ('d', 'time', 1.0), ('wk', 'time', 7.0), ('mo', 'time', 30.4375), ('a', 'time', 365.25), ('mg', 'mass', 0.001), ('g', 'mass', 1.0), ('kg', 'mass', 1000.0), ('cm', null, 1.0)),
f(x) as (values (1.0), (30.4375), (365.25), (0.001), (1000.0)), g as (select x from f union select 1 / x from f)
select a.u as unit, b.u as wanted, cast(case when a.u = b.u then 0.9 when a.kind = b.kind and exists (select 1 from g where abs(a.size::double / b.size::double - x) <= 0.01 * x) then 0.45 else 0 end as double) as score from s a, s b"""
)
def channel_unit_plausibility(spark, sf):
    rows = [(a, b, float(G.unit_plausibility({"candidate_units": [{"ucum": a, "source": "header:x", "confidence": 0.9}]}, {"unit": b}, Params())[0])) for a in UNITS for b in UNITS]
    return spark.createDataFrame(rows, "unit string, wanted string, score double")


@query(
    """with a as (select o_orderpriority as g, quantile_cont(o_totalprice, [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]) as q from orders group by all), b as (select quantile_cont(o_totalprice, [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]) as q from orders)
select g, printf('%.6f', 1 / (1 + list_avg(list_transform(range(1, 8), lambda i: abs(a.q[i] - b.q[i]))))) as score from a, b"""
)
def channel_distribution_distance(spark, sf):
    """Orders of each priority against all orders as the reference."""
    orders = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("g"), F.col("o_totalprice").cast("double").alias("x"))
    probs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
    every = ranks.quantiles(orders.groupBy(F.lit(0).alias("g"), "x").agg(F.count("*").alias("n")), ["g"], probs).first()["quantiles"]
    rows = [(r["g"], f"{G.distribution_distance({'quantiles': r['quantiles']}, {}, Params(), {'quantiles': every})[0]:.6f}") for r in ranks.quantiles(orders.groupBy("g", "x").agg(F.count("*").alias("n")), ["g"], probs).collect()]
    return spark.createDataFrame(rows, "g string, score string")


RULE = """'{"from":{"cohort_id":"' || r_name || '","column":"c","dataset_id":"' || n_name || '"},"kind":"column_map","params":{"unit_in":' || case when n_nationkey % 2 = 0 then '"kg"' else 'null' end || '},"to":{"concept_id":' || n_nationkey || ',"variable":"weight"}}'"""
VALUE = """'{"from":{"cohort_id":"' || r_name || '","column":"c","dataset_id":"' || n_name || '","values":["a","b"]},"kind":"value_map","params":{},"to":{"concept_id":null,"value":"' || lower(n_name) || '","variable":"weight"}}'"""


@query(f"with r as (select 'R-' || sha256({RULE}) as rule_id, 'column_map' as kind, n_name as dataset_id, n_nationkey as k from {NATIONS} union all select 'R-' || sha256({VALUE}), 'value_map', n_name, n_nationkey from {NATIONS}) select rule_id, kind, dataset_id from r where k % 3 <> 1")
def confirmed_rules(spark, sf):
    """Decisions on each nation's column, checked against a ledger and compiled into rules."""
    found = _nations(spark, sf)
    ledger = [{"cohort_id": r, "dataset_id": n, "column": "c"} for n, r, _ in found]
    text = T.yaml_text(ledger).encode()
    about = {"column": "c", "confirmed_by": "reviewer", "rationale": "seen", "proposed_hash": hashlib.sha256(text).hexdigest(), "variable": "weight"}
    rows = [about | {"cohort_id": r, "dataset_id": n, "decision": ("accept", "reject", "remap")[k % 3], "concept_id": k} | ({"unit_in": "kg"} if k % 2 == 0 else {}) | ({"value_map": [{"from": ["b", "a"], "to": n.lower(), "rationale": "same"}]} if k % 3 != 1 else {}) for n, r, k in found]
    rules = K.compile_rules(K.confirm(rows, ledger, text), "1.0")
    return spark.createDataFrame([(r["rule_id"], r["kind"], r["from"]["dataset_id"]) for r in rules], "rule_id string, kind string, dataset_id string")


@query("select regexp_replace(lower(p_name), '[^\\p{L}\\p{N}]', '', 'g') as canonical, count(*) as n from (select p_name || ' Ünï-' || p_size || '_é' as p_name from part) group by all")
def canonical_names(spark, sf):
    name = F.concat("p_name", F.lit(" Ünï-"), "p_size", F.lit("_é"))
    return table(spark, sf, "part").select(X.canonical(name).alias("canonical")).groupBy("canonical").agg(F.count("*").alias("n"))


@query("with c as (select c_mktsegment as g, c_acctbal as x, row_number() over (partition by c_mktsegment order by c_acctbal, c_custkey) as rank, c_custkey from customer) select g, rank, c_custkey from c")
def grouped_ranks(spark, sf):
    """Ranks in groups of any size, counted over ranges of rows."""
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("g"), F.col("c_acctbal").alias("x"), "c_custkey")
    return ranks.ranked(c, ["g"], ["x", "c_custkey"]).select("g", F.col("rank").cast("long").alias("rank"), "c_custkey")


@query("select n_name as variable, case when n_nationkey % 3 = 0 then 'no-target-unit' when n_nationkey % 3 = 1 then 'identity' else 'converted' end as status, cast(case n_nationkey % 3 when 1 then 1.0 when 2 then n_nationkey + 0.5 end as double) as factor from nation")
def unit_plans(spark, sf):
    """How the unit of each rule is to be treated, from a table of exact factors."""
    found = _nations(spark, sf)
    factors = M.factor_table([{"analyte": n, "from": "mg", "to": "kg", "factor": k + 0.5} for n, _, k in found])
    plan = [{"rule_id": str(k), "column": "c", "variable": n, "unit_in": ("mg", "kg", "mg")[k % 3], "unit_out": (None, "kg", "kg")[k % 3]} for n, _, k in found]
    made = {u["rule_id"]: u for u in M.plan_units(plan, factors)}
    return spark.createDataFrame([(r["variable"], made[r["rule_id"]]["status"], made[r["rule_id"]]["factor"]) for r in plan], "variable string, status string, factor double")


DOMAINS = sorted(S.DOMAINS)


@query(
    "with d(i, domain) as (values " + ", ".join(f"({i}, '{d}')" for i, d in enumerate(DOMAINS)) + "), t(domain, cdm_table) as (values " + ", ".join(f"('{d}', '{t}')" for d, t in TARGETS) + ") "
    "select n_name as dataset_id, lower(n_name) as variable, d.domain, cdm_table, n_nationkey as concept_id from nation join d on d.i = n_nationkey % " + str(len(DOMAINS)) + " join t on t.domain = d.domain"
)
def concept_routes(spark, sf):
    """The target table of each rule; rules of tables that were not chosen are noted and map nothing."""
    found = _nations(spark, sf)
    name = lambda n: n.lower()
    pack = S.Pack("p", "1.0", "none", tuple(S.Variable(name(n), DOMAINS[k % len(DOMAINS)], k) for n, _, k in found))
    rules = [{"kind": "column_map", "rule_id": n, "rule_version": "1.0", "from": {"cohort_id": r, "dataset_id": n, "column": "c"}, "to": {"variable": name(n), "concept_id": None}, "params": {}} for n, r, _ in found]
    plan, _ = M.route(rules, pack)
    return spark.createDataFrame([(x["dataset_id"], x["variable"], x["domain"], x["cdm_table"], x["concept_id"]) for x in plan], "dataset_id string, variable string, domain string, cdm_table string, concept_id long")


@query("select 'person' as cdm_table, 'P-' || c_custkey as person_id, 'source_value' as field, c_mktsegment as value, 'c_mktsegment' as \"column\" from customer where c_custkey = 7")
def audit_cell(spark, sf):
    """Where one written value comes from."""
    plan = spark.createDataFrame([("R-1", "customer", "c_mktsegment")], "rule_id string, dataset_id string, column string")
    return D.audit(D.provenance(_mapped(spark, sf), plan), "person:P-7:source_value").select("cdm_table", "person_id", "field", "value", "column")
