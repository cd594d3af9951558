"""Joins in which some keys may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000


def hot_keys(rows: DataFrame, key: list[str]) -> list[int]:
    """Hashes of the keys that outgrow an average partition, by a frequent-items sketch over all rows.

    Twice as many as there are partitions are looked for, so that any other key
    has less than a partition's rows. Keys with a null are none: they match nothing.
    """
    n = _partitions(rows)
    most = max(HOT_KEYS, 2 * n)
    there = " and ".join(f"{k} is not null" for k in key)
    top = rows.where(there).agg(F.count("*").alias("n"), F.expr(f"approx_top_k({_code(key)}, {most}, {8 * most})").alias("top")).first()
    return [t["item"] for t in top["top"] or [] if t["count"] > top["n"] / n] if n > 1 else []


def hot_counts(sizes: DataFrame, key: list[str]) -> list[int]:
    """The same from a stored table (key, n) of the rows of each key; no more keys than there are partitions."""
    n = _partitions(sizes)
    total = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    return [r["h"] for r in sizes.where(F.col("n") > total / n).select(F.expr(_code(key)).alias("h")).collect()] if n > 1 else []


def keyed_join(rows: DataFrame, facts: DataFrame, key: list[str], node: str, how: str = "inner", hot: list[int] | None = None) -> DataFrame:
    """``rows`` joined with ``facts`` (at most one row a key).

    Rows of the :func:`hot_keys` (of ``rows``, if ``hot`` doesn't tell them) are
    spread by the hash of ``node`` over as many salts as there are partitions,
    and their facts are repeated for each salt. With ``left``, rows with a null
    key are spread too. The sketch only routes: every row meets its fact
    whatever it names. Null keys match nothing, as in any join.
    """
    n = _partitions(rows)
    hot = hot_keys(rows, key) if hot is None else hot
    if n < 2 or (not hot and how == "inner"):
        return rows.join(facts, key, how)
    is_hot = f"{_code(key)} in ({', '.join(_literal(h) for h in hot)})" if hot else "false"
    # Null keys are one key to a shuffle.
    null = f" or {' or '.join(f'{k} is null' for k in key)}" if how == "left" else ""
    salt = "__salt"
    rows = rows.withColumn(salt, F.expr(f"if({is_hot}{null}, pmod(xxhash64({node}), {n}L), 0L)"))
    facts = facts.withColumn(salt, F.explode(F.expr(f"if({is_hot}, sequence(0L, {n - 1}L), array(0L))")) if hot else F.lit(0).cast("long"))
    return rows.join(facts, [*key, salt], how).drop(salt)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _code(key: list[str]) -> str:
    return f"xxhash64({', '.join(key)})"


def _literal(h: int) -> str:
    return f"{h}L" if h != -(1 << 63) else "(-9223372036854775807L - 1L)"
