"""Groups of any size as bounded pieces of work, and their links."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.operators.joins import keyed_join


def paired(df: DataFrame, key: list[str], node: str, limit: int, weight: Column | None = None, most: int = 0) -> DataFrame:
    """Cut each group of ``df`` into blocks of about ``limit`` nodes, and of ``most`` by ``weight`` if given, and deal out every pair of blocks.

    Adds ``lo``, ``hi`` (the pair) and ``mine`` (the row's own block). Groups of
    one row go, as they have no pairs. Each two rows of a group meet in exactly
    one piece: (b, b) for rows of one block, (lo, hi) for rows of two. Blocks
    come from the node's hash, so no group is ever sorted or counted in one task.
    """
    sizes = df.groupBy(*key).agg(F.count("*").alias("n"), *([] if weight is None else [F.sum(weight).alias("k")])).where("n > 1")
    k = F.ceil(F.col("n") / limit).cast("long")
    if weight is not None:
        k = F.greatest(k, F.ceil(F.col("k") / most).cast("long"))
    rows = keyed_join(df, sizes, key, node).withColumn("k", k).withColumn("mine", F.expr(f"pmod(xxhash64({node}), k)"))
    rows = rows.withColumn("other", F.explode(F.expr("case when k = 1 then array(0L) else sequence(0L, k - 1) end")))
    return rows.withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other")).drop("n", "k", "other")


def together(df: DataFrame, key: list[str | Column], n: int | None = None) -> DataFrame:
    """Rows of a key next to each other, for :func:`runs`."""
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *key).sortWithinPartitions(*key)


def runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal keys; keys may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in key]
        keys = list(zip(*columns, strict=True))
        start = 0
        for i, k in enumerate(keys):
            if i == start and k == last and i == 0:
                continue
            if k != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, k
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def spanning(n: int, left: np.ndarray, right: np.ndarray, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges that span the links between ``left`` and ``right`` (positions below ``n``).

    ``linked(i, others)`` says which others i links with. Pairs already in one
    component are not compared again, so a tight group costs one pass.
    """
    parent = np.arange(n)
    edges = []
    same = left is right
    for x, i in enumerate(left.tolist()):
        others = right[x + 1 :] if same else right
        others = others[parent[others] != parent[i]]
        if not len(others):
            continue
        hits = others[linked(i, others)]
        if len(hits):
            # One edge for each component that i joins, so all edges together are a forest.
            old, first = np.unique(parent[hits], return_index=True)
            edges += [(i, j) for j in hits[first].tolist()]
            parent[np.isin(parent, old)] = parent[i]
    return edges


def stars(names: list, edges: list[tuple[int, int]]) -> tuple[list, list]:
    """The same components as ``edges`` give, each as edges from its least name to all its others.

    Buckets that hold much the same group then name much the same edges.
    """
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while parent.setdefault(i, i) != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, j in edges:
        a, b = root(i), root(j)
        if a != b:
            if names[a] <= names[b]:
                parent[b] = a
            else:
                parent[a] = b
    members = [i for i in parent if root(i) != i]
    return [names[root(i)] for i in members], [names[i] for i in members]


ROW = "struct<d:bigint,x:bigint>"


def row_key(doc_id: Column, text: Column) -> Column:
    """A name for a row that any later scan gives again, whatever the order: its id and a hash of its text.

    Only rows with one id and one text share it, and they are to be treated
    alike. Positions of rows would not do, as a plan may deal rows differently
    each time that it runs.
    """
    return F.struct(F.coalesce(doc_id.cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64(text, F.isnull(text)).alias("x"))
