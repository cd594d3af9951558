"""Record linkage: blocking, comparison, Fellegi-Sunter weights, persons."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import combinations, product
from math import comb, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.config import Params
from concordat.errors import LinkError
from concordat.functions import text as X
from concordat.operators.components import connected_components
from concordat.storage import materialize

LEVELS = ("agree", "disagree", "missing")

# Blocking rules and comparison fields of a run that names no files of its own.
DEFAULT_RULES = [
    {"id": "br_dob_sex", "on": ["birth_date", "sex"]},
    {"id": "br_name3", "on": ["substr(last_name, 1, 3)", "birth_year"]},
    {"id": "br_mrn", "on": ["mrn"]},
]
DEFAULT_FIELDS = {
    "fields": [
        {"name": "sex", "on": "gender", "compare": "exact_ci", "m": {"agree": 0.94, "disagree": 0.05, "missing": 0.01}, "u": {"agree": 0.50, "disagree": 0.49, "missing": 0.01}},
        {"name": "birth_year", "on": "anchor_year", "compare": "exact", "m": {"agree": 0.90, "disagree": 0.06, "missing": 0.04}, "u": {"agree": 0.02, "disagree": 0.93, "missing": 0.05}},
        {"name": "marital_status", "on": "marital_status", "compare": "exact_ci", "m": {"agree": 0.85, "disagree": 0.05, "missing": 0.10}, "u": {"agree": 0.20, "disagree": 0.70, "missing": 0.10}},
        {"name": "race", "on": "race", "compare": "exact_ci", "m": {"agree": 0.92, "disagree": 0.04, "missing": 0.04}, "u": {"agree": 0.15, "disagree": 0.80, "missing": 0.05}},
        {"name": "language", "on": "language", "compare": "exact_ci", "m": {"agree": 0.88, "disagree": 0.04, "missing": 0.08}, "u": {"agree": 0.60, "disagree": 0.32, "missing": 0.08}},
    ]
}
FLOOR = 1e-9
SEPARATOR = "\x1f"
SUBSET_RULES = 6  # with more rules their sets are too many, and pairs are made to be counted


@dataclass(frozen=True)
class Rule:
    id: str
    on: tuple[str, ...]


@dataclass(frozen=True)
class Comparison:
    name: str
    on: str
    compare: str
    m: dict
    u: dict


def component(spec: str) -> tuple[str, int | None, int | None]:
    """(column, start, length) of ``column`` or ``substr(column, start, length)``."""
    text = spec.strip()
    if m := re.fullmatch(r"substr\(\s*(\w+)\s*,\s*(\d+)\s*,\s*(\d+)\s*\)", text):
        return m[1], int(m[2]), int(m[3])
    if re.fullmatch(r"\w+", text):
        return text, None, None
    raise LinkError(f"blocking component {spec!r}: a column or substr(column, start, length)")


def parse_rules(raw: list[dict]) -> list[Rule]:
    """Blocking rules; YAML 1.1 reads the bare key ``on`` as true, which is taken too."""
    if not isinstance(raw, list) or not raw:
        raise LinkError("blocking rules are a non-empty list")
    out = []
    for r in raw:
        on = r.get("on", r.get(True))
        if not r.get("id") or not isinstance(on, list) or not on:
            raise LinkError(f"blocking rule {r}: id and on are needed")
        for c in on:
            component(c)
        out.append(Rule(r["id"], tuple(on)))
    if len({r.id for r in out}) != len(out):
        raise LinkError("a blocking rule's id occurs twice")
    return out


def parse_comparisons(raw: dict) -> list[Comparison]:
    out = []
    for f in raw.get("fields") or []:
        for side in ("m", "u"):
            if set(f[side]) != set(LEVELS) or abs(sum(f[side].values()) - 1) > 1e-6:
                raise LinkError(f"{f['name']}: {side} has agree, disagree and missing, and sums to 1")
        agreement(F, f["compare"])
        out.append(Comparison(f["name"], f.get("on", f.get(True)), f["compare"], dict(f["m"]), dict(f["u"])))
    if not out:
        raise LinkError("no comparison fields")
    return out


def refuse_outcome(columns: list[str], outcomes: tuple[str, ...], what: str) -> None:
    """No decision may look at the outcome: neither blocks nor weights."""
    banned = {X.normalised_text(o) for o in outcomes}
    if hit := [c for c in columns if X.normalised_text(c) in banned]:
        raise LinkError(f"{what} uses the outcome variable: {hit}")


def keys(records: DataFrame, rules: list[Rule], group: list[str]) -> DataFrame:
    """(group, record_id, rule_id, block_key), one shuffle for all rules.

    A record takes no part in a rule whose columns it lacks (null or empty), and
    none does in a rule that names a column of no table.
    """
    parts = [F.when(k.isNotNull(), F.struct(F.lit(r.id).alias("rule_id"), k.alias("block_key"))) for r, k in key_columns(records, rules)]
    if not parts:
        return records.select(*group, "record_id", F.lit("").alias("rule_id"), F.lit("").alias("block_key")).where("false")
    return records.select(*group, "record_id", F.explode(F.array_compact(F.array(*parts))).alias("k")).select(*group, "record_id", "k.*")


def key_columns(records: DataFrame, rules: list[Rule]) -> list[tuple[Rule, Column]]:
    """The block key of each rule that applies, null for records that take no part in it."""
    out = []
    for r in rules:
        specs = [component(c) for c in r.on]
        if any(c not in records.columns for c, _, _ in specs):
            continue
        cols = [F.col(f"`{c}`") for c, _, _ in specs]
        there = reduce(lambda a, b: a & b, [c.isNotNull() & (c != "") for c in cols])
        values = [c if s is None else F.substring(c, s, n) for c, (_, s, n) in zip(cols, specs, strict=True)]
        out.append((r, F.when(there, F.concat_ws(SEPARATOR, *values))))
    return out


def block(records: DataFrame, rules: list[Rule], max_block_size: int, outcomes: tuple[str, ...] = (), group: tuple[str, ...] = ("cohort_id",)) -> tuple[DataFrame, DataFrame]:
    """(pairs, blocks): candidate pairs of every rule, and all blocks of two records or more.

    Pairs are (group, left_id, right_id, blocking_rule_id), left below right as
    text. Blocks over the limit are reported with ``skipped``, never expanded;
    that limit is the operator's own guard against squares of a block.
    """
    for r in rules:
        refuse_outcome([component(c)[0] for c in r.on], outcomes, f"blocking rule {r.id}")
    g = list(group)
    keyed = keys(records, rules, g)
    at = [*g, "rule_id", "block_key"]
    blocks = keyed.groupBy(*at).agg(F.count("*").alias("n")).where("n > 1").withColumn("skipped", F.col("n") > max_block_size)
    return _pairs(_live(keyed, blocks, g), g), blocks


def _live(keyed: DataFrame, blocks: DataFrame, g: list[str]) -> DataFrame:
    """Only keys of blocks with a partner, within the limit: fewer rows meet in a join."""
    at = [*g, "rule_id", "block_key"]
    return keyed.join(blocks.where("not skipped").select(*at), at, "left_semi")


def _pairs(live: DataFrame, g: list[str]) -> DataFrame:
    left = live.withColumnRenamed("record_id", "left_id")
    right = live.withColumnRenamed("record_id", "right_id")
    return left.join(right, [*g, "rule_id", "block_key"]).where("left_id < right_id").select(*g, "left_id", "right_id", F.col("rule_id").alias("blocking_rule_id"))


def block_report(records: DataFrame, rules: list[Rule], pairs: DataFrame | None, blocks: DataFrame, warn_frac: float, group: tuple[str, ...] = ("cohort_id",)) -> dict:
    """Counts of each rule and of the run, with warnings; a few rows reach the driver.

    Without ``pairs`` those of :func:`block` are counted from its keys and none
    is made; a record id that occurs twice is then two records of its block.
    """
    made = {r["rule_id"]: r for r in blocks.groupBy("rule_id").agg(F.count_if(~F.col("skipped")).alias("live"), F.count_if("skipped").alias("over"), F.coalesce(F.sum(F.when(F.col("skipped"), F.col("n"))), F.lit(0)).alias("lost"), F.sum(F.when(~F.col("skipped"), F.expr("n * (n - 1) div 2"))).alias("pairs")).collect()}
    sizes = records.groupBy(*group).agg(F.count("*").alias("n"))
    cross = sizes.agg(F.sum(F.expr("n * (n - 1) div 2")).alias("c"), F.sum("n").alias("n")).first()
    live = [r.id for r in rules if r.id in made and made[r.id]["live"]]
    if pairs is None and len(live) > SUBSET_RULES:
        pairs = _pairs(_live(keys(records, rules, list(group)), blocks, list(group)), list(group))
    if pairs is None:
        per = {k: made[k]["pairs"] for k in live}
        pairs_n, touched = _pair_counts(_live(keys(records, rules, list(group)), blocks, list(group)), live, list(group))
    else:
        per = {r["blocking_rule_id"]: r["n"] for r in pairs.groupBy("blocking_rule_id").agg(F.count("*").alias("n")).collect()}
        touched = pairs.select(*group, F.explode(F.array("left_id", "right_id")).alias("r")).distinct().count()
        pairs_n = pairs.select(*group, "left_id", "right_id").distinct().count()
    out, absent = [], []
    for r in rules:
        gone = [component(c)[0] for c in r.on if component(c)[0] not in records.columns]
        absent.append(bool(gone))
        m = made.get(r.id)
        out.append({"rule_id": r.id, "n_pairs": per.get(r.id, 0), "n_blocks": m["live"] if m else 0, "n_blocks_skipped_oversize": m["over"] if m else 0, "n_records_in_skipped_blocks": m["lost"] if m else 0, "not_applicable_columns": gone})
    warnings = []
    if cross["c"] and pairs_n / cross["c"] > warn_frac:
        warnings.append(f"pairs are {pairs_n / cross['c']:.4f} of the cross product")
    if all(absent):
        warnings.append("no rule applies to any table")
    return {"rules": out, "n_records": cross["n"] or 0, "n_records_unblocked": (cross["n"] or 0) - touched, "n_candidate_pairs": pairs_n, "warnings": warnings}


def _pair_counts(live: DataFrame, rules: list[str], g: list[str]) -> tuple[int, int]:
    """(distinct pairs of different ids, ids in one at least), exact by inclusion and exclusion over sets of rules.

    A set of rules has the pairs that share the keys of all of them, which a
    count of records for each combination of keys tells. An id with two keys of
    one rule (it occurs in two records) doesn't fit that: its pairs are made.
    """
    if not rules:
        return 0, 0
    at = [*g, "rule_id", "block_key"]
    met = live.groupBy(*at).agg(F.min("record_id").alias("a"), F.max("record_id").alias("b")).where("a < b").select(*at)
    live = live.where("record_id is not null").join(met, at, "left_semi")
    of = [F.when(F.col("rule_id") == r, F.col("block_key")) for r in rules]
    wide = live.groupBy(*g, "record_id").agg(*[F.min(c).alias(f"k{i}") for i, c in enumerate(of)], *[F.max(c).alias(f"x{i}") for i, c in enumerate(of)])
    many = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"k{i}") < F.col(f"x{i}"), F.lit(False)) for i in range(len(rules))])
    none = F.lit(None).cast("string")
    row = lambda mask, s=(): F.struct(F.lit(mask).alias("mask"), *[(F.col(f"k{i}") if i in s else none).alias(f"k{i}") for i in range(len(rules))])
    sets = [s for n in range(1, len(rules) + 1) for s in combinations(range(len(rules)), n)]
    # Mask 0 counts the ids, -1 those with several keys.
    parts = [row(0), F.when(many, row(-1)), *[F.when(reduce(lambda a, b: a & b, [~many, *[F.col(f"k{i}").isNotNull() for i in s]]), row(sum(1 << i for i in s), s)) for s in sets]]
    combos = wide.select(*g, F.explode(F.array_compact(F.array(*parts))).alias("c")).select(*g, "c.*").groupBy(*g, "mask", *[f"k{i}" for i in range(len(rules))]).agg(F.count("*").alias("n"))
    found = {r["mask"]: r for r in combos.groupBy("mask").agg(F.sum("n").alias("n"), F.sum(F.expr("n * (n - 1) div 2")).alias("p")).collect()}
    total = sum(r["p"] * (1 if k.bit_count() % 2 else -1) for k, r in found.items() if k > 0)
    if -1 in found:
        own = live.join(wide.where(many).select(*g, "record_id"), [*g, "record_id"], "left_semi").distinct().withColumnRenamed("record_id", "other")
        met = live.join(own, at).where("record_id <> other")
        total += met.select(*g, F.least("record_id", "other").alias("l"), F.greatest("record_id", "other").alias("r")).distinct().count()
    return total, found[0]["n"] if 0 in found else 0


def agreement(f, how: str):
    """A function (left, right) -> Column for ``exact``, ``exact_ci``, ``prefix:n`` or ``numeric:tolerance``."""
    kind, _, arg = how.partition(":")
    if kind == "exact" and not arg:
        return lambda a, b: a == b
    if kind == "exact_ci" and not arg:
        return lambda a, b: f.lower(a) == f.lower(b)
    if kind == "prefix" and arg.isdigit() and int(arg) > 0:
        return lambda a, b: f.lower(f.left(a, f.lit(int(arg)))) == f.lower(f.left(b, f.lit(int(arg))))
    if kind == "numeric":
        try:
            tol = float(arg)
        except ValueError:
            raise LinkError(f"comparison {how!r}") from None
        return lambda a, b: f.coalesce(f.abs(X.to_number(a) - X.to_number(b)) <= tol, f.lit(False))
    raise LinkError(f"comparison {how!r} is not known")


def level(a: Column, b: Column, how: str) -> Column:
    """agree, disagree or missing; a side is missing if null or blank, and missing is no disagreement."""
    a, b = X.stripped(a), X.stripped(b)
    gone = a.isNull() | b.isNull() | (a == "") | (b == "")
    return F.when(gone, "missing").when(agreement(F, how)(a, b), "agree").otherwise("disagree")


def compare(pairs: DataFrame, records: DataFrame, spec: list[Comparison], group: tuple[str, ...] = ("cohort_id",)) -> DataFrame:
    """(group, left_id, right_id, level of each field) of each distinct pair; an unknown record is missing everywhere."""
    g = list(group)
    distinct = pairs.select(*g, "left_id", "right_id").distinct()
    has = {c.on for c in spec if c.on in records.columns}
    side = lambda s: records.select(*g, F.col("record_id").alias(f"{s}_id"), *[F.col(f"`{c}`").alias(f"{s}__{c}") for c in sorted(has)])
    wide = distinct.join(side("left"), [*g, "left_id"], "left").join(side("right"), [*g, "right_id"], "left")
    cols = [level(F.col(f"`left__{c.on}`"), F.col(f"`right__{c.on}`"), c.compare).alias(c.name) if c.on in has else F.lit("missing").alias(c.name) for c in spec]
    return wide.select(*g, "left_id", "right_id", *cols)


def vector_counts(levels: DataFrame, spec: list[Comparison]) -> DataFrame:
    """How often each combination of levels occurs: at most 3 to the number of fields."""
    return levels.groupBy(*[c.name for c in spec]).agg(F.count("*").alias("n"))


def exact_u(records: DataFrame, spec: list[Comparison], group: str = "cohort_id", by: str | None = None) -> dict:
    """u over all pairs within a group, in closed form from value counts; no pair is made.

    One result, or with ``by`` one for each value of that column. ``numeric``
    fields count pairs within the tolerance over their distinct values by a
    range join that is bucketed by the tolerance. Counts of all groups come back
    in one job a field.
    """
    at = [by, group] if by else [group]
    of = lambda r: r[by] if by else None

    def pairs_of(rows: DataFrame) -> dict:
        out: dict = {}
        for r in rows.groupBy(*at).agg(F.count("*").alias("n")).collect():
            out[of(r)] = out.get(of(r), 0) + comb(r["n"], 2)
        return out

    every = pairs_of(records)
    out = {k: {} for k in (every or {None: 0})}
    for c in spec:
        agree, missing = {}, every
        if c.on in records.columns:
            there = records.select(*at, X.stripped(F.col(f"`{c.on}`")).alias("v")).where("v is not null and v <> ''")
            present = pairs_of(there)
            missing = {k: n - present.get(k, 0) for k, n in every.items()}
            agree = {of(r): r["a"] for r in _agreeing(there, c.compare, at).groupBy(*at[:-1]).agg(F.sum("a").alias("a")).collect()}
        for k in out:
            if not every.get(k) or c.on not in records.columns:
                out[k][c.name] = {"agree": FLOOR, "disagree": FLOOR, "missing": 1.0}
                continue
            n, a = missing[k], agree.get(k) or 0
            out[k][c.name] = {x: max(y / every[k], FLOOR) for x, y in (("agree", a), ("disagree", every[k] - n - a), ("missing", n))}
    return out if by else out[None]


def _agreeing(there: DataFrame, how: str, at: list[str]) -> DataFrame:
    """(group, a): how many pairs of values ``v`` agree, in parts to be summed."""
    kind, _, arg = how.partition(":")
    same = F.expr("n * (n - 1) div 2").alias("a")
    if kind != "numeric":
        key = {"exact": F.col("v"), "exact_ci": F.lower("v")}.get(kind)
        key = F.lower(F.left("v", F.lit(int(arg)))) if key is None else key
        return there.groupBy(*at, key.alias("k")).agg(F.count("*").alias("n")).select(*at, same)
    counts = there.select(*at, X.to_number(F.col("v")).alias("x")).where("x is not null").groupBy(*at, "x").agg(F.count("*").alias("n"))
    tolerance = float(arg)
    if tolerance <= 0:
        return counts.select(*at, same)
    cell = F.floor(F.col("x") / tolerance).cast("long")
    a = counts.select(*at, F.col("x").alias("x1"), F.col("n").alias("n1"), F.explode(F.array(cell, cell + 1)).alias("c"))
    b = counts.select(*at, F.col("x").alias("x2"), F.col("n").alias("n2"), cell.alias("c"))
    near = a.join(b, [*at, "c"]).where((F.col("x1") < F.col("x2")) & (F.col("x2") - F.col("x1") <= tolerance))
    return counts.select(*at, same).unionByName(near.select(*at, (F.col("n1") * F.col("n2")).alias("a")))


def em(vectors: list[tuple[tuple[str, ...], int]], spec: list[Comparison], u: dict, iterations: int, start: float = 0.1) -> tuple[dict, dict]:
    """m by expectation-maximisation over level combinations, with u fixed.

    If the fields' agreement weights sum to less than 0, the classes are the
    wrong way round and are exchanged, once.
    """
    m = {c.name: dict(c.m) for c in spec}
    share, run = start, 0
    weights: list[float] = []
    for _ in range(iterations):
        weights = []
        for levels, _ in vectors:
            a, b = share, 1 - share
            for c, lv in zip(spec, levels, strict=True):
                a *= max(m[c.name][lv], FLOOR)
                b *= max(u[c.name][lv], FLOOR)
            weights.append(a / (a + b) if a + b else 0.0)
        total = sum(w * n for w, (_, n) in zip(weights, vectors, strict=True))
        if total <= 0:
            break
        m = _m_step(vectors, weights, spec, total)
        share = total / sum(n for _, n in vectors)
        run += 1
    swapped = False
    if weights and sum(log2(max(m[c.name]["agree"], FLOOR) / max(u[c.name]["agree"], FLOOR)) for c in spec) < 0:
        other = [1 - w for w in weights]
        total = sum(w * n for w, (_, n) in zip(other, vectors, strict=True))
        if total > 0:
            m, swapped = _m_step(vectors, other, spec, total), True
    return m, {"lambda": share, "em_iterations_run": iterations, "em_passes": run, "labels_swapped": swapped}


def _m_step(vectors, weights, spec, total) -> dict:
    out = {c.name: dict.fromkeys(LEVELS, 0.0) for c in spec}
    for w, (levels, n) in zip(weights, vectors, strict=True):
        for c, lv in zip(spec, levels, strict=True):
            out[c.name][lv] += w * n
    return {f: {k: max(x / total, FLOOR) for k, x in v.items()} for f, v in out.items()}


def weight_table(spec: list[Comparison], m: dict, u: dict) -> dict[str, dict[str, float]]:
    return {c.name: {k: log2(max(m[c.name][k], FLOOR) / max(u[c.name][k], FLOOR)) for k in LEVELS} for c in spec}


def score(levels: DataFrame, spec: list[Comparison], weights: dict, group: tuple[str, ...] = ("cohort_id",)) -> DataFrame:
    """(group, left_id, right_id, match_weight, per_field_agreement): literals per field and level, summed in the spec's order."""
    parts = []
    for c in spec:
        w = reduce(lambda e, k, c=c: e.when(F.col(c.name) == k, F.lit(weights[c.name][k])), LEVELS[1:], F.when(F.col(c.name) == LEVELS[0], F.lit(weights[c.name][LEVELS[0]])))
        parts.append(F.struct(F.lit(c.name).alias("field"), F.col(c.name).alias("level"), w.alias("weight")))
    total = reduce(lambda a, b: a + b, [p.getField("weight") for p in parts])
    return levels.select(*group, "left_id", "right_id", total.alias("match_weight"), F.array(*parts).alias("per_field_agreement"))


def banded(scores: DataFrame, p: Params) -> DataFrame:
    """Adds ``band``: link, clerical (reported, never linked) or distinct."""
    w = F.col("match_weight")
    return scores.withColumn("band", F.when(w >= p.match_threshold, "link").when(w >= p.clerical_threshold, "clerical").otherwise("distinct"))


def person_id(cohort: Column, members: Column) -> Column:
    """A name that depends on the members alone."""
    return F.concat(F.lit("P-"), F.left(F.sha2(F.concat_ws(SEPARATOR, cohort, F.array_join(F.array_sort(members), SEPARATOR)), 256), F.lit(16)))


def resolve(records: DataFrame, links: DataFrame, group: tuple[str, ...] = ("cohort_id",)) -> DataFrame:
    """(person_id, group, source_row_id): connected components over all records, single ones too.

    A person's rows are gathered in one array; that is the operator's output
    format, and persons are small by the collapse alarm.
    """
    g = list(group)
    at = F.struct(*g, F.col("record_id"))
    key = lambda c: F.to_json(F.struct(*g, F.col(c).alias("record_id")))
    parts = connected_components(links.select(key("left_id").alias("a"), key("right_id").alias("b")))
    rows = records.select(*g, "record_id").distinct().withColumn("node", F.to_json(at))
    labelled = rows.join(parts, "node", "left").withColumn("root", F.coalesce("component", "node"))
    # A person's records share a group, so the root alone would do; the group is carried along.
    people = labelled.groupBy(*g, "root").agg(F.array_sort(F.collect_list("record_id")).alias("source_row_id"))
    return people.select(person_id(F.col("cohort_id"), F.col("source_row_id")).alias("person_id"), *g, "source_row_id")


def link_report(scores: DataFrame, people: DataFrame, p: Params) -> dict:
    """Counts and the collapse ratio; :func:`check_collapse` judges it after outputs are written."""
    return report_of({r["band"]: r["n"] for r in banded(scores, p).groupBy("band").agg(F.count("*").alias("n")).collect()}, people)


def report_of(bands: dict[str, int], people: DataFrame) -> dict:
    """:func:`link_report` from the number of pairs in each band."""
    r = people.agg(F.count("*").alias("persons"), F.coalesce(F.sum(F.size("source_row_id")), F.lit(0)).alias("rows")).first()
    ratio = r["persons"] / r["rows"] if r["rows"] else 1.0
    return {"n_in": r["rows"], "n_persons": r["persons"], "collapse_ratio": ratio, "n_linked_pairs": bands.get("link", 0), "n_clerical_pairs": bands.get("clerical", 0)}


def check_collapse(report: dict, p: Params) -> None:
    if report["collapse_ratio"] < p.max_collapse_ratio_drop:
        raise LinkError(f"linkage left {report['collapse_ratio']:.3f} of the records as persons")


def histogram(scores: DataFrame, p: Params, bins: int = 60) -> tuple[float, float, DataFrame]:
    """(low, high, (bin, n)): equal bins over weights and thresholds, 5 % wider on both sides."""
    r = scores.agg(F.min("match_weight").alias("a"), F.max("match_weight").alias("b")).first()
    values = [x for x in (r["a"], r["b"], p.match_threshold, p.clerical_threshold) if x is not None]
    lo, hi = min(values), max(values)
    pad = (hi - lo) * 0.05 or 1.0
    lo, hi = lo - pad, hi + pad
    at = F.least(F.greatest(F.floor((F.col("match_weight") - lo) / (hi - lo) * bins), F.lit(0)), F.lit(bins - 1))
    return lo, hi, scores.groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def link(records: DataFrame, rules: list[Rule], spec: list[Comparison], p: Params = Params(), outcomes: tuple[str, ...] = (), by: str | None = None, blocker: Callable = block, scorer: Callable = score, resolver: Callable = resolve) -> dict:
    """The whole stage: pairs, weights, persons and reports.

    With ``by`` all is done for each value of that column apart, in the same
    jobs: blocks, u, m, weights and persons. ``m``, ``u`` and ``provenance`` are
    then by that value. Compared pairs are stored once, as counts, scores and
    persons all read them.
    """
    for c in spec:
        refuse_outcome([c.on], outcomes, f"comparison {c.name}")
    group = (by, "cohort_id") if by else ("cohort_id",)
    pairs, blocks = blocker(records, rules, p.max_block_size, outcomes, group)
    pairs = materialize(pairs, "candidate-pairs")
    levels = materialize(compare(pairs, records, spec, group), "pair-levels")
    names = [c.name for c in spec]
    vectors: dict = {}
    for r in levels.groupBy(*([by] if by else []), *names).agg(F.count("*").alias("n")).collect():  # at most 3 to the number of fields, for each replicate
        vectors.setdefault(r[by] if by else None, []).append((tuple(r[n] for n in names), r["n"]))
    u = exact_u(records, spec, "cohort_id", by) if p.link_u_from_random_pairs else None
    m, told, table = {}, {}, []
    for k, found in sorted(vectors.items(), key=lambda x: (x[0] is None, x[0])):
        own = {c.name: dict(c.u) for c in spec} if u is None else u[k] if by else u
        m[k], told[k] = em(sorted(found), spec, own, p.link_em_iterations)
        table += [(k, w) for w in [weight_table(spec, m[k], own)]]
    if by:
        scores = _score_by(levels, spec, dict(table), by)
    else:
        scores = scorer(levels, spec, dict(table).get(None) or weight_table(spec, {c.name: c.m for c in spec}, {c.name: c.u for c in spec}))
    people = resolver(records, scores.where(F.col("match_weight") >= p.match_threshold), group)
    source = "exact" if u is not None else "spec"
    if by:
        return {"pairs": pairs, "blocks": blocks, "scores": scores, "people": people, "m": m, "u": u, "provenance": {k: v | {"u_source": source} for k, v in told.items()}}
    one = m.get(None) or {c.name: dict(c.m) for c in spec}
    return {"pairs": pairs, "blocks": blocks, "scores": scores, "people": people, "m": one, "u": u if u is not None else {c.name: dict(c.u) for c in spec}, "provenance": (told.get(None) or {"em_iterations_run": 0}) | {"u_source": source}}


def _score_by(levels: DataFrame, spec: list[Comparison], weights: dict, by: str) -> DataFrame:
    """(by, cohort_id, left_id, right_id, match_weight) with weights of its own for each value of ``by``, from a table of fields and levels."""
    spark, names = levels.sparkSession, [c.name for c in spec]
    rows = [(k, *[w[n][lv] for n in names for lv in LEVELS]) for k, w in weights.items()]
    cols = [f"{n}__{lv}" for n in names for lv in LEVELS]
    schema = f"`{by}` int, " + ", ".join(f"`{c}` double" for c in cols)
    met = levels.join(F.broadcast(spark.createDataFrame(rows, schema)), by)  # a row for each replicate
    part = lambda n: F.when(F.col(n) == LEVELS[0], F.col(f"`{n}__{LEVELS[0]}`")).when(F.col(n) == LEVELS[1], F.col(f"`{n}__{LEVELS[1]}`")).otherwise(F.col(f"`{n}__{LEVELS[2]}`"))
    return met.select(by, "cohort_id", "left_id", "right_id", reduce(lambda a, b: a + b, [part(n) for n in names]).alias("match_weight"))


def all_vectors(spec: list[Comparison]):
    return list(product(LEVELS, repeat=len(spec)))
