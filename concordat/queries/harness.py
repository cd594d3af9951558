"""The permutation harness as queries, and a study of 54 records to time it on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.config import Params
from concordat.operators import confirm as K
from concordat.plans import harmonise as H
from concordat.queries.base import dataset, query
from concordat.sources import tables as T
from concordat.sources.ingest import Pack, Variable

PACK = Pack(
    "harness",
    "1.0.0",
    "none",
    (
        Variable("age_at_index", "measurement", 1, "continuous", unit="a"),
        Variable("sex", "person", 2, "nominal", ("male", "female", "other", "unknown")),
        Variable("vital_status", "observation", 3, "nominal", ("alive", "dead", "lost")),
        Variable("exposure_count", "drug", 4, "continuous"),
        Variable("time_to_event", "observation", 5, "continuous", outcome=True),
    ),
)
FIELDS = ("given", "middle", "family", "birth_date")


def _person(i: int, middle: str | None) -> tuple:
    return (f"BK{i % 8:02d}", f"given{i}", middle, f"family{i // 2}", f"19{50 + i % 40}-01-{1 + i % 28:02d}")


def tables(spark: SparkSession) -> dict[tuple[str, str], DataFrame]:
    """Three tables of two cohorts; most of one cohort's people are in two of them, some with a middle name gone or changed."""
    link = "block_key string, given string, middle string, family string, birth_date string"
    clinical = f"PATIENT_ID string, AGE_AT_INDEX string, SEX string, VITAL_STATUS string, TIME_TO_EVENT string, {link}"

    def seen(n: int, shift: int) -> list[tuple]:
        return [(str(i + shift), str(30 + 7 * i % 50), PACK["sex"].domain_values[i % 4], PACK["vital_status"].domain_values[i % 3], str(10 + 3.5 * i), *_person(i + shift, f"m{i}")) for i in range(n)]

    treated = [(str(i), str(1 + i % 5), str(3 * i), *_person(i, None if i % 5 == 0 else f"x{i}" if i % 5 == 1 else f"m{i}")) for i in range(20)] + [(str(90 + i), "1", "2", *_person(300 + i, "z")) for i in range(2)]
    made = {
        ("COHORT_A", "clinical"): spark.createDataFrame(seen(20, 0), clinical),
        ("COHORT_A", "treatment"): spark.createDataFrame(treated, f"PATIENT_ID string, EXPOSURE_COUNT string, EXPOSURE_START_DAY string, {link}"),
        ("COHORT_B", "clinical"): spark.createDataFrame(seen(12, 500), clinical.replace("PATIENT_ID", "SUBJECT_ID")),
    }
    key = {"COHORT_A": "PATIENT_ID", "COHORT_B": "SUBJECT_ID"}
    return {k: T.identified(t, *k, F.col(key[k[0]]).cast("long") + 1) for k, t in made.items()}


def study(spark: SparkSession, folder: str) -> H.Run:
    """The run up to its rules, as :func:`concordat.plans.harmonise.run` would make it; control files go to ``folder``."""
    levels = lambda a, d, m: {"agree": a, "disagree": d, "missing": m}
    T.write_yaml([{"id": "br_block", "on": ["block_key"]}, {"id": "br_name", "on": ["substr(family, 1, 8)", "birth_date"]}], f"{folder}/rules.yaml")
    T.write_yaml({"fields": [{"name": f, "on": f, "compare": "exact_ci", "m": levels(0.9, 0.05, 0.05), "u": levels(0.1, 0.85, 0.05)} for f in FIELDS]}, f"{folder}/fields.yaml")
    p = Params(blocking_rules=f"{folder}/rules.yaml", link_comparison_spec=f"{folder}/fields.yaml", match_threshold=3.0, clerical_threshold=1.0, max_failed_frac=1.0)
    r = H.Run(p, PACK, [], tables(spark))
    decided = [("COHORT_A", "clinical", "AGE_AT_INDEX", "age_at_index", "a"), ("COHORT_A", "clinical", "SEX", "sex", None), ("COHORT_A", "clinical", "VITAL_STATUS", "vital_status", None), ("COHORT_A", "treatment", "EXPOSURE_COUNT", "exposure_count", None), ("COHORT_B", "clinical", "SEX", "sex", None), ("COHORT_B", "clinical", "AGE_AT_INDEX", "age_at_index", "a")]
    groups = [{"from": ["male", "female"], "to": "male", "concept_id": 8507}, {"from": ["other"], "to": "other", "concept_id": None}]
    decisions = [{"cohort_id": c, "dataset_id": d, "column": x, "decision": "accept", "variable": v, "concept_id": PACK[v].concept_id, "unit_in": u, "value_map": groups if v == "sex" else []} for c, d, x, v, u in decided]
    r.results["rules"] = K.compile_rules(decisions, PACK.version)
    return r


def prove(spark: SparkSession, seeds: int, scope: str) -> dict:
    with tempfile.TemporaryDirectory() as d:
        return H.prove(spark, study(spark, d), list(range(1, seeds + 1)), scope=scope)


def _same(spark: SparkSession, found: dict) -> DataFrame:
    rows = [(int(k), h == found["hashes"]["null"], found["verdict"]) for k, h in found["hashes"].items() if k != "null"]
    return spark.createDataFrame(rows, "seed int, same boolean, verdict string")


@query("select cast(seed as integer) as seed, true as same, 'proof' as verdict from range(1, 5) r(seed)")
def harness_map_scope(spark, sf):
    """Ledger and mapped tables of each permutation against the baseline's, profiled, proposed, linked and mapped anew."""
    return _same(spark, prove(spark, 4, "map"))


@query("select cast(seed as integer) as seed, true as same, 'proof' as verdict from range(1, 4) r(seed)")
def harness_propose_scope(spark, sf):
    """The same over two whole tables whose balances are the outcome."""
    pack = Pack("balances", "1.0", "none", (Variable("nation_key", "person", 1, "nominal"), Variable("market_segment", "person", 2, "nominal", ("BUILDING", "MACHINERY")), Variable("c_acctbal", "measurement", 3, "continuous", outcome=True), Variable("s_acctbal", "measurement", 4, "continuous", outcome=True)))
    r = H.Run(Params(max_failed_frac=1.0), pack, [], {("tpch", n): dataset(spark, sf, n) for n in ("customer", "supplier")})
    return _same(spark, H.prove(spark, r, [1, 2, 3]))
