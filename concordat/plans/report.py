"""A page about a run, from what it published and nothing else."""

from __future__ import annotations

import json
from html import escape
from pathlib import Path

TITLES = {
    "ingest/ingest_manifest.json": "Datasets",
    "profile/profiles.json": "Columns",
    "profile/failures.json": "Columns that failed",
    "link/block_report.json": "Blocking",
    "link/link_report.json": "Linkage",
    "propose/candidates.json": "Candidates",
    "rules/ruleset.json": "Rules",
    "mapped/unit_qc.json": "Units",
    "mapped/value_qc.json": "Values",
    "invariant/report.json": "Permutations",
}
SHOWN = 50


def _rows(path: Path) -> list:
    text = path.read_text(encoding="utf-8")
    if path.name == "ingest_manifest.json":  # a line for each dataset
        return [json.loads(x) for x in text.splitlines()]
    value = json.loads(text)
    return value if isinstance(value, list) else [value]


def _table(rows: list[dict]) -> str:
    names = sorted({k for r in rows for k in r})
    cell = lambda v: escape(v if isinstance(v, str) else json.dumps(v, ensure_ascii=False))
    body = "".join("<tr>" + "".join(f"<td>{cell(r.get(n))}</td>" for n in names) + "</tr>" for r in rows[:SHOWN])
    more = f"<p>{len(rows) - SHOWN} more</p>" if len(rows) > SHOWN else ""
    return f"<table><tr>{''.join(f'<th>{escape(n)}</th>' for n in names)}</tr>{body}</table>{more}"


def write_report(out: str) -> str:
    """Write ``index.html`` into a published folder; stages that did not run have no section. Returns its path."""
    root, parts = Path(out), []
    for name, title in TITLES.items():
        if (root / name).exists():
            rows = _rows(root / name)
            parts.append(f"<h2>{title}</h2><p>{len(rows)} from {escape(name)}</p>{_table(rows) if rows else ''}")
    pictures = sorted(p.relative_to(root).as_posix() for p in root.rglob("*") if p.suffix in (".png", ".svg"))
    parts += [f'<figure><img src="{escape(p)}" alt="{escape(p)}"></figure>' for p in pictures]
    page = f'<!doctype html><html lang="en"><meta charset="utf-8"><title>Run</title><body><h1>Run</h1>{"".join(parts)}</body></html>\n'
    (root / "index.html").write_text(page, encoding="utf-8")
    return str(root / "index.html")
