"""Does any decision depend on the outcome? Permutations, digests, a verdict."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.errors import InvariantError
from concordat.functions import text as X
from concordat.operators.ranks import ranked

TABLE = ["cohort_id", "dataset_id"]
BASELINE = -1


def outcome_columns(columns: list[str], outcomes: tuple[str, ...]) -> list[str]:
    """Source columns that carry an outcome variable's name, letters and digits compared."""
    fold = lambda s: "".join(c for c in s.lower() if c.isalnum())
    banned = {fold(o) for o in outcomes}
    return [c for c in columns if fold(c) in banned]


def permute(cells: DataFrame, outcomes: tuple[str, ...], seeds: list[int]) -> DataFrame:
    """Baseline cells, and for each seed the cells with outcome columns shuffled within their table.

    Only outcome cells are shuffled: ranks by row and by a hash of (seed, table,
    column, row) are joined, both counted over ranges of rows. Other cells are repeated for each seed. A seed
    always starts from the original.
    """
    names = [X.normalised_text(o) for o in outcomes]
    is_outcome = X.canonical(F.col("column")).isin(*names) if names else F.lit(False)
    base = cells.where(F.col("replicate") == BASELINE)
    many = F.explode(F.array(*[F.lit(s) for s in seeds])).alias("replicate") if seeds else None
    if many is None:
        return base
    rest = [c for c in cells.columns if c != "replicate"]
    same = base.where(~is_outcome).select(many, *rest)
    moved = base.where(is_outcome).select(many, *rest)
    at = ["replicate", *TABLE, "column"]
    left = ranked(moved.drop("value"), at, ["row_no"])
    hashed = F.sha2(F.concat_ws("|", "replicate", *TABLE, "column", "row_no"), 256).alias("hash")
    right = ranked(moved.select(*at, "value", "row_no", hashed), at, ["hash", "row_no"]).select(*at, "value", "rank")
    shuffled = left.join(right, [*at, "rank"]).drop("rank")
    return base.unionByName(same.select(*cells.columns)).unionByName(shuffled.select(*cells.columns))


def marginals(cells: DataFrame) -> DataFrame:
    """(replicate, cohort_id, dataset_id, column, n, digest): an order-free digest of each column's values."""
    h = F.xxhash64(F.coalesce("value", F.lit("\x00")))
    return cells.groupBy("replicate", *TABLE, "column").agg(F.count("*").alias("n"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("digest"))


def encoded(df: DataFrame, digits: int = 6, keep: str | None = None) -> DataFrame:
    """One text per row: tagged values in column order; doubles with fixed decimals, times in microseconds. ``keep`` is a column left as it is."""
    parts = []
    for f in df.schema.fields:
        if f.name == keep:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            text = F.format_string(f"%.{digits}f", c.cast("double"))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            text = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            text = F.to_json(F.struct(c.alias("v")))
        else:
            text = c.cast("string")
        parts.append(F.when(c.isNull(), "N").otherwise(F.concat(F.lit("V"), text)))
    return df.select(*([keep] if keep else []), F.concat_ws("\x1f", *parts).alias("row"))


def digest(df: DataFrame, digits: int = 6) -> str:
    """SHA-256 over names, types and the sorted rows, read one partition at a time."""
    h = hashlib.sha256()
    for f in df.schema.fields:
        h.update(f"{f.name}:{f.dataType.simpleString()}\n".encode())
    for r in encoded(df, digits).orderBy("row").toLocalIterator():
        h.update(r["row"].encode() + b"\n")
    return h.hexdigest()


def multiset_digest(df: DataFrame, digits: int = 6) -> str:
    """A digest of any size of table that needs no order: sums of two hashes of each row."""
    rows = encoded(df, digits)
    r = rows.agg(F.count("*").alias("n"), *[F.sum(F.conv(F.substring(F.sha2("row", 256), 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")).alias(f"s{i}") for i in range(4)]).first()
    schema = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
    return hashlib.sha256("|".join(map(str, [schema, *r])).encode()).hexdigest()


def digests(mapped: DataFrame, unmapped: DataFrame, digits: int = 6) -> dict[int, str]:
    """A digest of each replicate's mapped and unmapped rows, whatever their order, from one job."""
    parts = [encoded(df, digits, "replicate").withColumn("artefact", F.lit(name)) for name, df in (("mapped", mapped), ("unmapped", unmapped))]
    rows = parts[0].unionByName(parts[1])
    h = F.sha2("row", 256)
    sums = [F.sum(F.conv(F.substring(h, 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")).cast("string").alias(f"s{i}") for i in range(4)]
    out: dict[int, list] = {}
    for r in rows.groupBy("replicate", "artefact").agg(F.count("*").alias("n"), *sums).collect():
        out.setdefault(r["replicate"], []).append(tuple(map(str, r))[1:])
    schemas = [f"{f.name}:{f.dataType.simpleString()}" for df in (mapped, unmapped) for f in df.schema.fields]
    return {k: hashlib.sha256(repr((schemas, sorted(v))).encode()).hexdigest() for k, v in out.items()}


def verdict(
    baseline: str | None,
    replicates: dict[int, str],
    requested: int,
    outcome_found: bool,
    marginals_kept: bool = True,
    complete: bool = True,
    moved: int | None = None,
    mapped_baseline: str | None = None,
    mapped: dict[int, str] | None = None,
    scope: str = "propose",
) -> dict:
    """The report's verdict; the first reason that applies is the answer.

    ``moved``: permutations in which some outcome cell changed its row.
    """
    join = lambda a, b: hashlib.sha256(f"ledger={a}\nmapped={b}".encode()).hexdigest()
    hashes = dict(replicates)
    if not outcome_found:
        answer = "no-outcome-column"
    elif not marginals_kept:
        answer = "marginal-moved"
    elif not complete:
        answer = "incomplete-permutation"
    elif moved == 0:
        answer = "no-op-permutation"
    elif baseline is None:
        answer = "no-ledger"
    elif scope == "map" and mapped_baseline is None:
        answer = "no-mapped-artefact"
    elif len(replicates) < requested:
        answer = "insufficient-permutations"
    else:
        if scope == "map":
            if set(mapped or {}) != set(replicates):
                raise InvariantError("a replicate lacks its mapped digest")
            hashes = {k: join(v, mapped[k]) for k, v in replicates.items()}
            baseline = join(baseline, mapped_baseline)
        answer = "proof" if set(hashes.values()) <= {baseline} else "leak"
    return {"verdict": answer, "scope": scope, "n_permutations": len(replicates), "n_distinct_hashes": len({*hashes.values(), *([baseline] if baseline else [])}), "hashes": {"null": baseline} | {str(k): v for k, v in sorted(hashes.items())}}


def verdicts(hashes: DataFrame) -> DataFrame:
    """(artefact, n, n_distinct, verdict) of a table (artefact, replicate, hash), where replicate -1 is the baseline."""
    return hashes.groupBy("artefact").agg(F.count_if(F.col("replicate") != BASELINE).alias("n"), F.countDistinct("hash").alias("n_distinct")).withColumn("verdict", F.when(F.col("n_distinct") == 1, "proof").otherwise("leak"))
