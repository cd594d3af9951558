"""Parameters of a run, their defaults and domains."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

from concordat.errors import ConcordatError

STAGES = ("ingest", "profile", "block", "link", "propose", "confirm", "map")
PLANNED_STAGES = ("derive", "coverage", "emit")

# Names that profiles, ledgers and rules carry.
CHANNELS = ("name_similarity", "type_agreement", "cardinality", "value_overlap", "distribution_distance", "unit_plausibility")
CHANNEL_KEYS = {"name_similarity": "name", "type_agreement": "type", "cardinality": "card", "value_overlap": "value", "distribution_distance": "dist", "unit_plausibility": "unit"}
GENERATORS = ("name_ngram", "value_set", "unit")
DOMAIN_TABLES = {
    "person": "person",
    "observation": "observation",
    "measurement": "measurement",
    "condition": "condition_occurrence",
    "drug": "drug_exposure",
    "procedure": "procedure_occurrence",
    "device": "device_exposure",
}


@dataclass(frozen=True)
class Params:
    input: str | None = None
    concept_pack: str | None = None
    stop_after: str | None = None
    allow_single_dataset: bool = False
    unseal: tuple[str, ...] = ()
    locked_model: str = "locked_model.json"
    unseal_log: str = "unseal.log"
    max_unique_listed: int = 500
    date_formats: tuple[str, ...] = ("%Y-%m-%d", "%Y-%m", "%Y")
    example_k: int = 5
    na_strings: tuple[str, ...] = ("", "NA", "NULL", ".")
    unit_header_patterns: str | None = None
    ucum_release: str = "2.2"
    infer_unit_from_range: bool = True
    max_failed_frac: float = 0.05
    fail_sample_k: int = 3
    permute_outcome_seed: str | None = None
    invariant_n_permutations: int = 100
    invariant_scope: str = "propose"
    blocking_rules: str | None = None
    max_block_size: int = 10000
    max_pairs_warn_frac: float = 0.1
    link_em_iterations: int = 20
    link_comparison_spec: str | None = None
    link_u_from_random_pairs: bool = True
    link_random_pair_n: int = 1_000_000
    match_threshold: float = 12.0
    clerical_threshold: float = 6.0
    max_collapse_ratio_drop: float = 0.5
    max_candidates_per_column: int = 20
    candidate_generators: tuple[str, ...] = GENERATORS
    channel_weights: dict = field(default_factory=lambda: {"name": 0.15, "type": 0.15, "card": 0.1, "value": 0.3, "dist": 0.15, "unit": 0.15})
    enabled_channels: tuple[str, ...] = CHANNELS
    unit_factor_candidates: tuple[float, ...] = (1, 30.4375, 365.25, 0.001, 1000)
    emit_confirmation_plots: bool = True
    ledger_top_k: int = 5
    ledger_float_precision: int = 4
    confirmed_ledger: str | None = None
    require_rationale: bool = True
    allow_stale_ledger: bool = False
    rule_id_prefix: str = "R-"
    fail_on_rule_collision: bool = True
    cdm_version: str = "5.4"
    cdm_domains: tuple[str, ...] = ("person", "condition_occurrence", "drug_exposure", "measurement", "observation")
    max_unmapped_frac: float = 0.2
    keep_source_concept: bool = True
    unit_conversion_table: str | None = None
    fail_on_implausible_range: bool = True
    plausible_range_quantiles: tuple[float, float] = (0.01, 0.99)
    max_fan_in_warn: int = 3
    emit_alluvial: bool = True
    unmapped_value_policy: str = "manifest"

    # Closed ranges of the numeric parameters.
    RANGES = {
        "max_unique_listed": (1, 100_000),
        "example_k": (0, 50),
        "max_failed_frac": (0.0, 1.0),
        "fail_sample_k": (0, 20),
        "invariant_n_permutations": (10, 10_000),
        "max_block_size": (100, 1_000_000),
        "max_pairs_warn_frac": (0.0, 1.0),
        "link_em_iterations": (1, 200),
        "link_random_pair_n": (10_000, 100_000_000),
        "max_collapse_ratio_drop": (0.0, 1.0),
        "max_candidates_per_column": (1, 500),
        "ledger_top_k": (1, 50),
        "ledger_float_precision": (2, 8),
        "max_unmapped_frac": (0.0, 1.0),
        "max_fan_in_warn": (1, 20),
    }

    def __post_init__(self):
        for name, (lo, hi) in self.RANGES.items():
            if not lo <= getattr(self, name) <= hi:
                raise ConcordatError(f"{name} must lie in {lo}..{hi}, not {getattr(self, name)}")
        if self.stop_after in PLANNED_STAGES:
            raise ConcordatError(f"stage {self.stop_after} can't be asked for")
        for name, allowed in (("stop_after", (None, *STAGES)), ("cdm_version", ("5.3", "5.4")), ("unmapped_value_policy", ("manifest", "fail"))):
            if getattr(self, name) not in allowed:
                raise ConcordatError(f"{name} must be one of {allowed}, not {getattr(self, name)!r}")
        if self.invariant_scope not in ("propose", "map"):
            raise ConcordatError(f"invariant_scope {self.invariant_scope!r} is refused: propose or map")
        lo, hi = self.plausible_range_quantiles
        if not 0 <= lo < hi <= 1:
            raise ConcordatError("plausible_range_quantiles must be ordered within [0, 1]")
        if self.clerical_threshold > self.match_threshold:
            raise ConcordatError("clerical_threshold lies above match_threshold")
        if unknown := set(self.enabled_channels) - set(CHANNELS):
            raise ConcordatError(f"unknown channels: {sorted(unknown)}")
        if unknown := set(self.candidate_generators) - set(GENERATORS):
            raise ConcordatError(f"unknown generators: {sorted(unknown)}")
        if abs(sum(self.channel_weights.values()) - 1) > 1e-6:
            raise ConcordatError("channel_weights must sum to 1")

    @classmethod
    def names(cls) -> list[str]:
        return [f.name for f in fields(cls)]

    @classmethod
    def schema(cls) -> list[dict]:
        """Name, default and range of every parameter."""
        made = cls()
        return [{"name": n, "default": getattr(made, n), "range": cls.RANGES.get(n)} for n in cls.names()]
