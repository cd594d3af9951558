"""Samplesheet, concept pack and the seal on held-out datasets; driver side."""

from __future__ import annotations

import csv
import hashlib
import json
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path

from concordat.errors import IngestError
from concordat.storage import read_bytes

# Columns and vocabularies of the control files.
SHEET_COLUMNS = ("cohort_id", "dataset_id", "role", "path", "holdout")
ROLES = ("clinical", "treatment", "biopsy", "imaging", "other")
DOMAINS = ("person", "observation", "measurement", "condition", "drug", "procedure", "device", "derived")
TYPES = ("continuous", "nominal", "ordinal", "boolean")


@dataclass(frozen=True)
class Dataset:
    cohort_id: str
    dataset_id: str
    role: str
    path: str
    holdout: bool


@dataclass(frozen=True)
class Variable:
    name: str
    domain: str
    concept_id: int | None = None
    type: str | None = None
    domain_values: tuple[str, ...] = ()
    derivation: str | None = None
    unit: str | None = None
    plausible_range: tuple[float, float] | None = None
    outcome: bool = False


@dataclass(frozen=True)
class Pack:
    name: str
    version: str
    vocabulary: str
    variables: tuple[Variable, ...]
    sha256: str = ""

    @property
    def outcomes(self) -> tuple[str, ...]:
        return tuple(v.name for v in self.variables if v.outcome)

    def __getitem__(self, name: str) -> Variable:
        return next(v for v in self.variables if v.name == name)

    def __contains__(self, name: str) -> bool:
        return any(v.name == name for v in self.variables)


def read_sheet(path: str, base: str | None = None) -> list[Dataset]:
    """Datasets of a samplesheet; the first fault is an error that names its row (the header is row 1)."""
    with open(path, newline="", encoding="utf-8") as f:
        reader = csv.DictReader(f)
        if missing := [c for c in SHEET_COLUMNS if c not in (reader.fieldnames or [])]:
            raise IngestError(f"the samplesheet lacks columns {missing}")
        rows = list(enumerate(reader, 2))
    found = []
    for n, r in rows:
        for c in SHEET_COLUMNS:
            if not (r[c] or "").strip():
                raise IngestError(f"row {n}: {c} is missing")
        if r["role"] not in ROLES:
            raise IngestError(f"row {n}: role {r['role']!r} is not one of {ROLES}")
        if r["holdout"].lower() not in ("true", "false"):
            raise IngestError(f"row {n}: holdout must be true or false")
        where = r["path"] if "://" in r["path"] else str(Path(base or ".", r["path"]))
        if "://" not in where and not Path(where).exists():
            raise IngestError(f"row {n}: {r['path']} does not exist")
        found.append((n, Dataset(r["cohort_id"], r["dataset_id"], r["role"], where, r["holdout"].lower() == "true")))
    check_keys([(d.cohort_id, d.dataset_id) for _, d in found])
    return [d for _, d in found]


def check_keys(keys: Iterable[tuple[str, str]]) -> None:
    first: dict[tuple[str, str], int] = {}
    for n, k in enumerate(keys, 2):
        if k in first:
            raise IngestError(f"rows {first[k]} and {n}: {k[0]}/{k[1]} occurs twice")
        first[k] = n


def parse_pack(raw: bytes) -> Pack:
    """A concept pack from its bytes; its identity is their SHA-256."""
    import yaml

    doc = yaml.safe_load(raw)
    if not isinstance(doc, dict):
        raise IngestError("the pack is not a mapping")
    for k in ("pack", "version", "vocabulary", "variables"):
        if k not in doc:
            raise IngestError(f"the pack lacks {k}")
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", str(doc["pack"])) or not re.fullmatch(r"\d+\.\d+(\.\d+)?", str(doc["version"])):
        raise IngestError("the pack's name or version is not well-formed")
    out = []
    for v in doc["variables"] or []:
        name = v.get("name")
        if not name or not re.fullmatch(r"[a-z][a-z0-9_]*", name):
            raise IngestError(f"variable name {name!r}")
        if unknown := set(v) - {"name", "domain", "concept_id", "type", "domain_values", "derivation", "unit", "plausible_range", "outcome"}:
            raise IngestError(f"{name}: unknown keys {sorted(unknown)}")
        if v.get("domain") not in DOMAINS:
            raise IngestError(f"{name}: domain {v.get('domain')!r}")
        if v["domain"] == "derived":
            if not v.get("derivation"):
                raise IngestError(f"{name}: a derived variable needs a derivation")
        elif v.get("concept_id") is None or v.get("type") not in TYPES:
            raise IngestError(f"{name}: concept_id and type are needed")
        bounds = v.get("plausible_range")
        if bounds is not None and (len(bounds) != 2 or bounds[0] > bounds[1]):
            raise IngestError(f"{name}: plausible_range {bounds}")
        out.append(Variable(name, v["domain"], v.get("concept_id"), v.get("type"), tuple(map(str, v.get("domain_values") or ())), v.get("derivation"), v.get("unit"), tuple(map(float, bounds)) if bounds else None, bool(v.get("outcome"))))
    if len({v.name for v in out}) != len(out):
        raise IngestError("a variable occurs twice")
    if not any(v.outcome for v in out):
        raise IngestError("the pack flags no outcome variable")
    return Pack(doc["pack"], str(doc["version"]), doc["vocabulary"], tuple(out), hashlib.sha256(raw).hexdigest())


def load_pack(path: str) -> Pack:
    """A pack from a local file or a URL (http, https or a file system's)."""
    return parse_pack(control_file(path))


def control_file(path: str) -> bytes:
    """The bytes of a control file; they are small."""
    if re.match(r"https?://", path):
        from urllib.request import urlopen

        with urlopen(path) as f:  # noqa: S310
            return f.read()
    return read_bytes(path) if "://" in path else Path(path).read_bytes()


def params_hash(input: str, concept_pack: str, allow_single_dataset: bool) -> str:
    text = f"input={input}\nconcept_pack={concept_pack}\nallow_single_dataset={str(allow_single_dataset).lower()}"
    return hashlib.sha256(text.encode()).hexdigest()


@dataclass
class Lock:
    """What may be unsealed: asked for, and covered by a lock made for this very run."""

    requested: tuple[str, ...] = ()
    log: list[tuple[str, str, str, str]] = field(default_factory=list)


def open_lock(requested: Iterable[str], lock_path: str, hash_now: str, git_sha: str | None, log_path: str | None = None) -> Lock:
    """Check a request to unseal; each admission is logged before any byte is read."""
    asked = tuple(requested)
    if not asked:
        return Lock()
    try:
        lock = json.loads(Path(lock_path).read_text())
    except FileNotFoundError:
        raise IngestError(f"no lock at {lock_path}") from None
    except ValueError:
        raise IngestError(f"{lock_path} is not JSON") from None
    if missing := sorted(set(asked) - set(lock.get("covers", []))):
        raise IngestError(f"the lock does not cover {missing}")
    if lock.get("params_hash") != hash_now:
        raise IngestError("the lock was made for other parameters")
    if git_sha is not None and lock.get("analysis_git_sha") != git_sha:
        raise IngestError("the lock was made for another commit")
    now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    lines = [(now, d, git_sha or "unknown", hash_now) for d in asked]
    if log_path:
        with open(log_path, "a", encoding="utf-8") as f:
            f.writelines("\t".join(x) + "\n" for x in lines)
    return Lock(asked, lines)


def admits(dataset: Dataset, lock: Lock) -> bool:
    """Held-out data only if asked for; an id opens that name in every cohort."""
    return not dataset.holdout or dataset.dataset_id in lock.requested


def admitted(datasets: list[Dataset], lock: Lock, policy: Callable[[Dataset, Lock], bool] = admits) -> list[Dataset]:
    return [d for d in datasets if policy(d, lock)]


def manifest(datasets: list[Dataset]) -> list[str]:
    """One JSON line for each dataset, by cohort and name."""
    return [json.dumps({"cohort_id": d.cohort_id, "dataset_id": d.dataset_id, "role": d.role, "holdout": d.holdout}, sort_keys=True) for d in sorted(datasets, key=lambda d: (d.cohort_id, d.dataset_id))]


def seeds(spec: str | int | None) -> list[int]:
    """Permutation seeds of ``7`` or ``1..100``."""
    if spec is None:
        return []
    text = str(spec).strip()
    if re.fullmatch(r"\d+", text):
        return [int(text)]
    if m := re.fullmatch(r"(\d+)\.\.(\d+)", text):
        a, b = map(int, m.groups())
        if a <= b:
            return list(range(a, b + 1))
    raise IngestError(f"seeds {text!r}: a number or a range like 1..100")
