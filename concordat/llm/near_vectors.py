"""Near-duplicate vectors: p-stable Euclidean hashing, exact cosine checks.

Normalised vectors fall into buckets by quantised random projections, in
several tables. Inside a bucket exact cosines give edges that span the linked
vectors; components of these edges are small groups that hold every link, and
there all cosines are taken, so links are counted once and no pairs are written.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.groups import paired, runs, spanning, stars, together
from concordat.operators.components import connected_components
from concordat.operators.joins import keyed_join
from concordat.storage import bounded_batches, drop, materialize, ship

THRESHOLD = 0.95
TABLES = 64
PROJECTIONS = 10
WIDTH = 1.2
SEED = 20240117
BLOCK = 512
BUCKET_BLOCK = 2048


def projections(dim: int, tables: int, k: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, tables * k)), rng.uniform(0, width, tables * k)


def codes(unit: np.ndarray, tables: int = TABLES, k: int = PROJECTIONS, width: float = WIDTH, seed: int = SEED) -> np.ndarray:
    """One 64-bit bucket number for each row and table."""
    a, b = projections(unit.shape[1], tables, k, width, seed)
    q = np.floor((unit @ a + b) / width).astype(np.int64).astype(np.uint64).reshape(len(unit), tables, k)
    out = np.full((len(unit), tables), 0xCBF29CE484222325, dtype=np.uint64)
    for i in range(k):
        out = (out ^ q[:, :, i]) * np.uint64(0x100000001B3)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _usable(column: pa.Array) -> np.ndarray:
    """Which vectors can link: not null nor empty, every component there and finite, not all of them zero."""
    lists, flat = np.diff(np.asarray(column.offsets)), column.flatten()
    if not len(flat):
        return np.zeros(len(column), dtype=bool)
    there = ~column.is_null().to_numpy(zero_copy_only=False)
    x = flat.to_numpy(zero_copy_only=False)
    sound = np.isfinite(x) & flat.is_valid().to_numpy(zero_copy_only=False)
    # Null lists take no room in the flattened values.
    counts = np.where(there, lists, 0)
    owner = np.repeat(np.arange(len(column)), counts)
    bad = np.bincount(owner, ~sound, len(column)) > 0
    some = np.bincount(owner, sound & (x != 0), len(column)) > 0
    return there & some & ~bad


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return _unit(np.asarray(flat.flatten()).reshape(len(flat), -1))


def link(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, k: int = PROJECTIONS, width: float = WIDTH, seed: int = SEED) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding).

    Null, empty, zero and non-finite vectors, ones with null components, and
    rows with a null vec_id link with nothing; they are their own component and
    kept. Only vectors of one length are compared. Equal vectors are one class,
    never expanded to pairs. A repeated row (same id, same vector) counts once
    as a link and keeps its rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    bounded_batches(spark)

    def classed(batches):
        for batch in batches:
            ok, v = _usable(batch.column(1)), batch.column(1)
            # Null instead of a vector that can't link; negative zeros are zeros.
            v = pc.if_else(pa.array(ok), v, pa.scalar(None, v.type))
            flat = v.flatten().to_numpy(zero_copy_only=False) + 0.0
            ends = np.cumsum(np.where(ok, np.diff(np.asarray(batch.column(1).offsets)), 0))
            key = [hashlib.blake2b(flat[b:e].tobytes(), digest_size=16).digest() if e > b else None for b, e in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(flat), mask=pa.array(~ok))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key, pa.binary()), lists], names=["vec_id", "class", "v"])

    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("embedding"))
    rows = materialize(rows.mapInArrow(classed, "vec_id long, class binary, v array<double>"), "vec-rows")
    ids = rows.where("class is not null and vec_id is not null").select("vec_id", "class").distinct()
    sizes = ids.groupBy("class").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("size"))
    first = rows.where("class is not null and vec_id is not null").groupBy("class").agg(F.min_by("v", "vec_id").alias("v"))
    classes = materialize(first.join(sizes, "class"), "vec-classes")

    def hashed(batches):
        for table in (t for b in batches for t in _by_length(b)):
            c = codes(_matrix(table.column("v")), tables, k, width, seed)
            n = len(c)
            dim = len(table.column("v")[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(tables, dtype=np.int32) + dim * tables, n)), pa.array(c.reshape(-1)), table.column("class").combine_chunks().take(pa.array(np.repeat(np.arange(n), tables)))], names=["bucket", "code", "class"]
            )

    buckets = materialize(classes.select("class", "v").mapInArrow(hashed, "bucket int, code long, class binary"), "vec-buckets")
    pieces = paired(buckets, ["bucket", "code"], "class", BUCKET_BLOCK).join(classes.select("class", "v"), "class")

    def edges(batches):
        for table in runs(batches, ["bucket", "code", "lo", "hi"]):
            x = _matrix(table.column("v"))
            mine, lo, hi = (np.asarray(table.column(c)) for c in ("mine", "lo", "hi"))
            left = np.flatnonzero(mine == lo[0])
            right = left if lo[0] == hi[0] else np.flatnonzero(mine == hi[0])
            found = spanning(len(x), left, right, lambda i, o, x=x: x[o] @ x[i] >= threshold)
            if found:
                a, b = stars(table.column("class").to_pylist(), found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    found = together(pieces, ["bucket", "code", "lo", "hi"]).mapInArrow(edges, "a binary, b binary").distinct()
    members = materialize(connected_components(found), "vec-members")
    drop(spark, buckets)
    cells = paired(members.withColumnRenamed("node", "class"), ["component"], "class", BLOCK).join(classes, "class").select("component", "lo", "hi", "mine", "class", "size", "v")

    def count(batches):
        for table in runs(batches, ["component", "lo", "hi"]):
            x = _matrix(table.column("v"))
            mine, size = np.asarray(table.column("mine")), np.asarray(table.column("size"))
            lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
            ok = x @ x.T >= threshold
            np.fill_diagonal(ok, False)
            if lo != hi:
                ok &= mine[:, None] != mine[None, :]
            yield pa.RecordBatch.from_arrays([table.column("class").combine_chunks(), pa.array((ok @ size).astype(np.int64))], names=["class", "n"])

    links = together(cells, ["component", "lo", "hi"]).mapInArrow(count, "class binary, n long").groupBy("class").agg(F.sum("n").alias("links"))
    lowest = members.join(sizes.withColumnRenamed("class", "node"), "node").groupBy("component").agg(F.min("class_id").alias("component_id"))
    known = keyed_join(members, lowest, ["component"], "node").select(F.col("node").alias("class"), "component_id").join(links, "class", "left")
    known = sizes.join(known, "class", "left").select("class", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component_id", "class_id").alias("component_id"))
    out = keyed_join(rows.select("vec_id", "class"), known, ["class"], "vec_id", "left")
    linked = F.col("vec_id").isNotNull()
    return out.select(
        "vec_id",
        F.coalesce(F.when(linked, F.col("n_links")), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.when(linked, F.col("component_id")), F.col("vec_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _by_length(batch: pa.RecordBatch):
    lengths = np.diff(np.asarray(batch.column(1).offsets))
    for n in np.unique(lengths):
        yield pa.Table.from_batches([batch]).take(pa.array(np.flatnonzero(lengths == n)))
