"""The staged run: ingest, profile, block, link, propose, confirm, map; and its permutation harness.

Stages are functions of tables; files are only written by :func:`publish`. A
gate that a stage fails is raised after what the stage made is on disk, so that
it can be looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat import plots
from concordat.config import Params
from concordat.errors import ConcordatError
from concordat.operators import confirm as K
from concordat.operators import invariant as I
from concordat.operators import linkage as L
from concordat.operators import mapping as M
from concordat.operators import profile as P
from concordat.operators import propose as G
from concordat.sources import ingest as S
from concordat.sources import tables as T
from concordat.storage import materialize


@dataclass(frozen=True)
class Seams:
    """What another implementation may be put in for, by name."""

    sheet_reader: Callable = S.read_sheet
    holdout_policy: Callable = S.admits
    profiler: Callable = P.profile
    unit_parser: Callable = P.unit_candidates
    failure_policy: Callable = P.check_failures
    blocker: Callable = L.block
    pair_scorer: Callable = L.score
    resolver: Callable = L.resolve
    candidate_generator: Callable = G.candidates
    evidence_channels: dict = field(default_factory=lambda: dict(G.REGISTRY))
    ledger_writer: Callable = G.ledger
    confirmation_source: Callable = K.confirm
    rule_compiler: Callable = K.compile_rules
    concept_mapper: Callable = M.mapped_rows
    unit_converter: Callable = M.convert_units
    value_mapper: Callable = M.map_values
    invariant_probe: Callable = I.permute


@dataclass
class Run:
    params: Params
    pack: S.Pack
    datasets: list[S.Dataset]
    tables: dict[tuple[str, str], DataFrame] = field(default_factory=dict)
    results: dict = field(default_factory=dict)
    seams: Seams = field(default_factory=Seams)

    @property
    def cells(self) -> DataFrame:
        return T.union_all([T.cells(t, _columns(t)) for t in self.tables.values()])

    @property
    def records(self) -> DataFrame:
        return T.union_all(list(self.tables.values()))

    def gate(self, check: Callable, *args):
        """Remember a refusal until the stage's results are published."""
        try:
            return check(*args)
        except ConcordatError as e:
            self.results.setdefault("refusals", []).append(e)


def _columns(t: DataFrame) -> list[str]:
    return [c for c in t.columns if c not in ("cohort_id", "dataset_id", "row_no", "record_id")]


def _yaml(path: str):
    return yaml.safe_load(S.control_file(path))


def start(spark: SparkSession, p: Params, base: str | None = None, git_sha: str | None = None, seams: Seams = Seams()) -> Run:
    """Check the control files, open what may be opened, and read it."""
    pack = S.load_pack(p.concept_pack)
    sheet = seams.sheet_reader(p.input, base)
    lock = S.open_lock(p.unseal, p.locked_model, S.params_hash(p.input, p.concept_pack, p.allow_single_dataset), git_sha, p.unseal_log if p.unseal else None)
    run = Run(p, pack, S.admitted(sheet, lock, seams.holdout_policy), seams=seams)
    for d in run.datasets:
        t = T.numbered(T.read_text_csv(spark, d.path))
        run.tables[d.cohort_id, d.dataset_id] = T.identified(t, d.cohort_id, d.dataset_id, F.col("row_no"))
    run.results["manifest"] = S.manifest(run.datasets)
    return run


def profile(run: Run) -> Run:
    cells = run.cells
    frame = materialize(run.seams.profiler(cells, run.params), "profiles")
    rows = [r.asDict() for r in frame.drop("others_fewer").orderBy(*P.KEY).collect()]  # one row for each source column
    run.results["profiles"] = G.with_units([r for r in rows if r["reason"] is None], run.params, run.seams.unit_parser)
    failed = [r for r in rows if r["reason"] is not None]
    run.results["failures"] = [r.asDict() for r in P.failures(cells, frame, run.params).orderBy(*P.KEY).collect()] if failed else []
    run.gate(run.seams.failure_policy, frame, run.params)
    return run


PROFILE = "replicate int, cohort_id string, dataset_id string, column string, unique_values array<string>, candidate_units array<struct<ucum:string,source:string,confidence:double>>"


def ledgers(spark: SparkSession, run: Run, profiles: list[dict]) -> dict[int, dict]:
    """Candidates, evidence and ledger of each replicate among the profiles; candidates are found in one job."""
    p, seams = run.params, run.seams
    keys = [x.split()[0] for x in PROFILE.split(", ")]
    table = spark.createDataFrame([tuple(x[k] for k in keys) for x in profiles], PROFILE)
    frame = G.pack_frame(spark, run.pack)
    variables = [r.asDict() for r in frame.collect()]
    by: dict[int, dict] = {}
    for x in profiles:
        by.setdefault(x["replicate"], {"profiles": [], "candidates": []})["profiles"].append(x)
    order = ["replicate", *G.COLUMN, "variable", "generator_id"]
    for r in seams.candidate_generator(table, frame, p, run.pack.outcomes, ("replicate",)).orderBy(*order).collect():
        row = r.asDict()
        by[row.pop("replicate")]["candidates"].append(row)
    for one in by.values():
        one["evidence"] = G.evidence(one["profiles"], one["candidates"], variables, p, run.pack.outcomes, seams.evidence_channels)
        one["ledger"] = seams.ledger_writer(one["candidates"], one["evidence"], p)
        one["ledger_bytes"] = T.yaml_text(one["ledger"]).encode()
    return by


def propose(spark: SparkSession, run: Run) -> Run:
    none = {"candidates": [], "evidence": [], "ledger": [], "ledger_bytes": T.yaml_text([]).encode()}
    run.results |= next(iter(ledgers(spark, run, run.results["profiles"]).values()), none)
    return run


def _link_files(p: Params) -> tuple[list, list]:
    return L.parse_rules(_yaml(p.blocking_rules) if p.blocking_rules else L.DEFAULT_RULES), L.parse_comparisons(_yaml(p.link_comparison_spec) if p.link_comparison_spec else L.DEFAULT_FIELDS)


def link(run: Run) -> Run:
    """Persons of all records; without files of its own, by the fixed rules and fields."""
    p = run.params
    rules, spec = _link_files(p)
    made = L.link(run.records, rules, spec, p, run.pack.outcomes, blocker=run.seams.blocker, scorer=run.seams.pair_scorer, resolver=run.seams.resolver)
    made["people"] = materialize(made["people"], "people")
    made["scores"] = materialize(made["scores"], "pair-scores")
    run.results["link"] = made
    run.results["block_report"] = L.block_report(run.records, rules, None if run.seams.blocker is L.block else made["pairs"], made["blocks"], p.max_pairs_warn_frac)
    run.results["link_report"] = L.link_report(made["scores"], made["people"], p) | {"provenance": made["provenance"], "m": made["m"], "u": made["u"]}
    run.gate(L.check_collapse, run.results["link_report"], p)
    return run


def confirm(run: Run) -> Run:
    p = run.params
    K.gate(p.confirmed_ledger)
    decisions = run.seams.confirmation_source(_yaml(p.confirmed_ledger), run.results["ledger"], run.results["ledger_bytes"], p.require_rationale, p.allow_stale_ledger)
    run.results["rules"] = run.seams.rule_compiler(decisions, run.pack.version, p.rule_id_prefix)
    run.gate(K.check_collisions, run.results["rules"], p.fail_on_rule_collision)
    return run


@dataclass
class Mapping:
    """Rules as tables, made once: the plan, units and values."""

    plan: list[dict]
    units: list[dict]
    values: list[dict]
    notes: list[str]
    plan_frame: DataFrame
    unit_frame: DataFrame
    value_frame: DataFrame


def rule_tables(spark: SparkSession, run: Run) -> Mapping:
    """All refusals of the rules come from here, before anything is mapped."""
    p, rules = run.params, run.results["rules"]
    plan, notes = M.route(rules, run.pack, p)
    units = M.plan_units(plan, M.factor_table(_yaml(p.unit_conversion_table)["factors"] if p.unit_conversion_table else M.UNIT_FACTORS))
    values = M.plan_values(rules, run.pack)
    return Mapping(
        plan,
        units,
        values,
        notes,
        M.plan_frame(spark, plan),
        spark.createDataFrame([(u["rule_id"], u["factor"], u["unit_out"]) for u in units], "rule_id string, factor double, unit_out string"),
        spark.createDataFrame([tuple(v.values()) for v in values], "rule_id string, value string, value_rule_id string, to_value string, value_concept_id long"),
    )


def apply_rules(run: Run, m: Mapping, cells: DataFrame, people: DataFrame, by: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells with their rules, converted rows, rows with values too); ``by`` keeps replicates apart."""
    seams = run.seams
    joined = M.map_cells(cells, m.plan_frame, len(m.plan))
    mapped = seams.concept_mapper(joined, M.persons_of(people, by), run.params.keep_source_concept, by)
    converted = seams.unit_converter(mapped, m.unit_frame, len(m.units))
    return joined, converted, seams.value_mapper(converted, m.value_frame, len(m.values))


def map_values(spark: SparkSession, run: Run) -> Run:
    p, made = run.params, rule_tables(spark, run)
    run.results["notes"] = made.notes
    cells = materialize(run.cells, "cells")
    joined, converted, rewritten = apply_rules(run, made, cells, run.results["link"]["people"])
    M.check_attached(joined, converted)
    mapped = run.results["mapped"] = materialize(rewritten, "mapped")
    run.results["unmapped"] = M.unmapped(joined)
    rule_frame = spark.createDataFrame(
        [(r["rule_id"], r["variable"], u["status"] == "converted", list(run.pack[r["variable"]].plausible_range) if run.pack[r["variable"]].plausible_range else None) for r, u in zip(made.plan, made.units, strict=True)],
        "rule_id string, variable string, converted boolean, plausible_range array<double>",
    )
    checked = M.range_check(mapped, rule_frame, p.plausible_range_quantiles)
    run.results["ranges"] = [r.asDict() for r in checked.orderBy("variable").collect()]
    run.results["collapse"] = [r.asDict() for r in M.collapse_report(mapped, made.value_frame, p.max_fan_in_warn).orderBy("value_rule_id", "source_value").collect()]  # a row for each claimed value
    run.results["unclaimed"] = M.values_unclaimed(mapped, made.value_frame)
    run.gate(M.check_ranges, run.results["ranges"], p)
    run.gate(M.check_values, run.results["unclaimed"], p)
    run.gate(M.check_unmapped, joined, p)
    return run


def run(spark: SparkSession, p: Params, base: str | None = None, git_sha: str | None = None, out: str | None = None, seams: Seams = Seams()) -> Run:
    """All stages up to ``stop_after``; with ``out`` each publishes what it made, before its gates close.

    With ``permute_outcome_seed`` the harness follows: ``results["proof"]`` has
    its verdict on the artefacts up to ``invariant_scope``.
    """
    seeds = check_seeds(p)
    r = start(spark, p, base, git_sha, seams)
    stages = {"ingest": lambda: r, "profile": lambda: profile(r), "link": lambda: link(r), "propose": lambda: propose(spark, r), "confirm": lambda: confirm(r), "map": lambda: map_values(spark, r)}
    last = "link" if p.stop_after == "block" else p.stop_after or "map"
    for name, stage in stages.items():
        stage()
        if out:
            publish(r, out, name)
        for e in r.results.pop("refusals", [])[:1]:
            e.run = r
            raise e
        if name == last:
            break
    if seeds:
        r.results["proof"] = prove(spark, r, seeds, scope=p.invariant_scope, requested=p.invariant_n_permutations)
        if out:
            T.write_json(r.results["proof"], f"{out}/invariant/report.json")
    return r


def check_seeds(p: Params) -> list[int]:
    """Seeds of the harness; a seeded run ends at the stage that its claim covers."""
    seeds = S.seeds(p.permute_outcome_seed)
    if seeds and (p.stop_after or "map") != p.invariant_scope:
        order = ["ingest", "profile", "block", "link", "propose", "confirm", "map"]
        stop = order.index(p.stop_after or "map")
        if stop < order.index("profile"):
            raise ConcordatError("a permutation can't show before the profiles: stop at profile or later")
        if stop > order.index(p.invariant_scope):
            raise ConcordatError(f"the run would go beyond its invariant_scope {p.invariant_scope!r}: stop there, or widen the scope")
    return seeds


def prove(spark: SparkSession, base: Run, seeds: list[int], propose_with: Callable | None = None, scope: str = "propose", people_with: Callable | None = None, requested: int | None = None) -> dict:
    """Repeat the run under permuted outcomes, from the original each time, and compare what it decides.

    All replicates go through the same few jobs, told apart by a column; the
    baseline is one of them. Scope ``propose`` profiles and proposes anew;
    ``map`` also links and maps anew, by the baseline's rules. ``requested``: how
    many permutations a proof needs, all of ``seeds`` by default. Another
    ``propose_with(spark, run)`` is asked for each replicate by itself, another
    ``people_with(records)`` for the persons of all replicates.
    """
    requested = len(seeds) if requested is None else requested
    carries = I.outcome_columns([c for t in base.tables.values() for c in _columns(t)], base.pack.outcomes)
    if not carries:
        return I.verdict(None, {}, requested, False, scope=scope)
    every = materialize(base.seams.invariant_probe(base.cells, base.pack.outcomes, seeds), "replicates")
    kept = I.marginals(every).groupBy(*I.TABLE, "column").agg(F.countDistinct("digest").alias("k"), F.count("*").alias("n"))
    bad = kept.agg(F.max("k").alias("k"), F.min("n").alias("n")).first()
    outcome = F.col("column").isin(*carries)
    was = every.where((F.col("replicate") == I.BASELINE) & outcome).select("record_id", "column", F.col("value").alias("was"))
    moved = every.where((F.col("replicate") != I.BASELINE) & outcome).join(was, ["record_id", "column"]).where(~F.col("value").eqNullSafe(F.col("was"))).select("replicate").distinct().count()
    rows = [x.asDict() for x in base.seams.profiler(every, base.params).drop("others_fewer").where("reason is null").orderBy(*P.KEY).collect()]
    rows = G.with_units(rows, base.params, base.seams.unit_parser)
    if propose_with is None:
        made = ledgers(spark, base, rows)
    else:
        made = {k: propose_with(spark, Run(base.params, base.pack, base.datasets, results={"profiles": [x for x in rows if x["replicate"] == k]}, seams=base.seams)).results for k in [I.BASELINE, *seeds]}
    found = {k: hashlib.sha256(one["ledger_bytes"]).hexdigest() for k, one in made.items()}
    mapped = mapped_digests(spark, base, every, people_with) if scope == "map" and "rules" in base.results else {}
    return I.verdict(found.pop(I.BASELINE, None), found, requested, True, bad["k"] == 1, bad["n"] == len(seeds) + 1, moved, mapped.pop(I.BASELINE, None), mapped, scope)


def mapped_digests(spark: SparkSession, base: Run, every: DataFrame, people_with: Callable | None = None) -> dict[int, str]:
    """A digest of the mapped tables of each replicate, linked anew from its own cells."""
    rules, spec = _link_files(base.params)
    columns = sorted({L.component(c)[0] for r in rules for c in r.on} | {c.on for c in spec})
    at = ["replicate", *I.TABLE, "record_id"]
    wide = every.groupBy(*at).pivot("column", columns).agg(F.first("value"))
    there = {r["column"] for r in every.select("column").distinct().collect()}
    wide = wide.select(*at, *[F.col(f"`{c}`") for c in columns if c in there])
    people = (people_with or (lambda records: L.link(records, rules, spec, base.params, base.pack.outcomes, "replicate")["people"]))(wide)
    joined, _, rewritten = apply_rules(base, rule_tables(spark, base), every, people, ("replicate",))
    return I.digests(rewritten, M.unmapped(joined, ("replicate",)), base.params.ledger_float_precision)


def publish(r: Run, out: str, stage: str | None = None) -> None:
    """Write what a run has made, or what one of its stages has."""
    have, p = r.results, r.params

    def due(name: str, key: str) -> bool:
        return key in have and stage in (None, name)

    if due("ingest", "manifest"):
        T.save("".join(x + "\n" for x in have["manifest"]), f"{out}/ingest/ingest_manifest.json")
    if due("profile", "profiles"):
        T.write_json(have["profiles"], f"{out}/profile/profiles.json")
        T.write_json(have["failures"], f"{out}/profile/failures.json")
    if due("link", "link"):
        _publish_link(r, f"{out}/link")
    if due("propose", "ledger_bytes"):
        T.save(have["ledger_bytes"], f"{out}/propose/ledger.yaml")
        T.write_json(have["candidates"], f"{out}/propose/candidates.json")
        T.write_json(have["evidence"], f"{out}/propose/evidence.json")
        if p.emit_confirmation_plots:
            by: dict[str, list] = {}
            for e in have["evidence"]:
                by.setdefault(e["candidate_key"], []).append((e["channel"], e["score"]))
            for k, v in by.items():
                T.save(plots.evidence_svg(k, v), f"{out}/propose/confirmation_plots/{G.plot_name(k)}")
    if due("confirm", "rules"):
        T.write_json(have["rules"], f"{out}/rules/ruleset.json")
    if due("map", "mapped"):
        _publish_mapped(r, f"{out}/mapped")


def _publish_link(r: Run, out: str) -> None:
    made, p = r.results["link"], r.params
    pair = ["cohort_id", "left_id", "right_id"]
    T.write_parquet(made["pairs"], f"{out}/candidate_pairs.parquet", [*pair, "blocking_rule_id"])
    T.write_parquet(made["scores"], f"{out}/scores.parquet", pair)
    T.write_parquet(L.banded(made["scores"], p).where("band = 'clerical'").drop("band"), f"{out}/clerical.parquet", pair)
    T.write_parquet(made["people"], f"{out}/links.parquet", ["cohort_id", "person_id"])
    lo, hi, bins = L.histogram(made["scores"], p)
    counts = {x["bin"]: x["n"] for x in bins.collect()}
    png, at = plots.histogram_png(counts, lo, hi, p.match_threshold, p.clerical_threshold)
    T.save(png, f"{out}/match_weights.png")
    T.write_json(r.results["block_report"], f"{out}/block_report.json")
    T.write_json(r.results["link_report"] | {"histogram": {"low": lo, "high": hi, "bins": counts, "columns": at}}, f"{out}/link_report.json")


def _publish_mapped(r: Run, out: str) -> None:
    have, p = r.results, r.params
    for domain, table in M.DOMAIN_TABLES.items():
        if table in p.cdm_domains:
            T.write_parquet(M.table_of(have["mapped"], table, domain), f"{out}/{table}.parquet", ["person_id", "rule_id"])
    T.write_parquet(have["unmapped"], f"{out}/_unmapped.parquet", [*M.KEY, "source_value"])
    T.write_json(have["ranges"], f"{out}/unit_qc.json")
    flows = [(x["source_value"], x["to_value"], x["n_rows"]) for x in have["collapse"]]
    picture, geometry = plots.alluvial_png(flows)
    T.write_json({"collapse": have["collapse"], "alluvial": geometry, "notes": have["notes"]}, f"{out}/value_qc.json")
    T.write_parquet(have["unclaimed"], f"{out}/value_unmapped.parquet", ["rule_id", "source_value"])
    if p.emit_alluvial:
        T.save(picture, f"{out}/alluvial.png")
