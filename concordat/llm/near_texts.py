"""N-gram Jaccard join with Bayesian pruning of MinHash candidates.

Documents with equal shingle sets are one class. MinHash bands bring classes
together; inside a bucket signatures are compared some values at a time, and a
pair is dropped once the posterior probability that its similarity reaches the
threshold falls below a tolerance. Surviving pairs are written only as spanning
edges; their components are small cells in which all similarities are taken
exactly from the shingle sets, and no list of pairs is ever written. A link is
lost only if no chain of surviving pairs joins its two texts, that is if bands
and pruning miss it and every way around it.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.groups import ROW, paired, row_key, runs, spanning, stars, together
from concordat.llm.memory import sliced, trimmed
from concordat.llm.words import batch_hashes, rolled
from concordat.operators.components import connected_components
from concordat.operators.joins import keyed_join
from concordat.storage import bounded_batches, drop, materialize, ship

WORDS = 5
THRESHOLD = 0.8
BANDS = 24
ROWS = 4
STEP = 16
TOLERANCE = 1e-4
SEED = 7
BUCKET_BLOCK = 1024
BLOCK = 256
BLOCK_BYTES = 8 << 20
NO_ID = (1 << 63) - 1


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text.

    Words are lower-cased and cut at white space. A text of fewer words is one
    shingle of its own; one without words has none.
    """
    h, offsets = batch_hashes(texts, lower=True)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b == a:
            out.append(np.zeros(0, np.uint64))
        else:
            out.append(np.unique(rolled(h[a:b], min(words, b - a))))
    return out


@lru_cache(maxsize=4)
def permutations(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def signatures(sets: list[np.ndarray], n: int, seed: int = SEED) -> np.ndarray:
    """MinHash values, one row for each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    high = (flat >> np.uint64(32)) ^ flat
    out = np.empty((len(sets), n), dtype=np.uint64)
    for i, (a, b) in enumerate(zip(*permutations(n, seed), strict=True)):
        out[:, i] = np.minimum.reduceat(high * a + b, starts)
    return out


@lru_cache(maxsize=8)
def least_matches(n: int, step: int, threshold: float, tolerance: float, bits: int = 8) -> tuple[tuple[int, int], ...]:
    """(values compared, matches needed) after each step.

    Prior: the similarity s is uniform. Values of ``bits`` bits agree with
    probability s + (1 - s) / 2**bits. Needed is the least number of matches
    at which P(s >= threshold) is not below ``tolerance``.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    agree = s + (1 - s) / (1 << bits)
    out = []
    for k in range(step, n + 1, step):
        for m in range(k + 1):
            like = m * np.log(agree) + (k - m) * np.log1p(-agree + 1e-15)
            like = np.exp(like - like.max())
            if like[s >= threshold].sum() / like.sum() >= tolerance:
                out.append((k, m))
                break
    return tuple(out)


def survivors(short: np.ndarray, i: int, others: np.ndarray, needed) -> np.ndarray:
    """Which of ``others`` stay likely to reach the threshold with ``i``; positions in ``others``."""
    alive, matches, at = np.arange(len(others)), np.zeros(len(others), dtype=np.int64), 0
    for k, m in needed:
        same = short[others[alive], at:k] == short[i, at:k]
        matches = matches + same.sum(axis=1)
        ok = matches >= m
        alive, matches, at = alive[ok], matches[ok], k
        if not len(alive):
            break
    return alive


def intersections(flat: np.ndarray, starts: np.ndarray, size: int, rows: np.ndarray, bounds: np.ndarray):
    """Yield (row, shared elements with every set); ``flat`` numbers elements below ``size``."""
    mark = np.zeros(size, dtype=np.uint8)
    for r in rows.tolist():
        own = flat[bounds[r] : bounds[r + 1]]
        mark[own] = 1
        yield r, np.add.reduceat(mark[flat], starts, dtype=np.int64)
        mark[own] = 0


def link(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS) -> DataFrame:
    """(row, worded, doc_id, class_id, n_links, component_id, kept) of every row of ``docs`` (doc_id, text).

    ``class_id``: the least id with the same shingle set; ``n_links``: other
    rows whose similarity reaches the threshold, copies included;
    ``component_id``: the least id reachable; ``kept``: one row of each
    component. ``row`` is the row's :func:`row_key`, ``worded`` whether it has words. Texts
    without words (null, empty) link with nothing and are kept. Null ids count
    as greater than all others, and show as null. Repeated rows are copies of
    each other. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)
    n = BANDS * ROWS

    def sign(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(2), words)
            full = [i for i, s in enumerate(sets) if len(s)]
            key: list = [None] * len(sets)
            sig: list = [None] * len(sets)
            if full:
                values = signatures([sets[i] for i in full], n)
                for row, i in enumerate(full):
                    key[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    sig[i] = values[row].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(key, pa.binary()), pa.array(sig, pa.binary())], names=["row", "id", "class", "sig"])

    keyed = docs.select(row_key(docs["doc_id"], docs["text"]).alias("row"), F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("id"), docs["text"].alias("text"))
    signed = keyed.mapInArrow(sliced(2, _compact(sign)), f"row {ROW}, id long, class binary, bands array<long>, short binary")
    rows = materialize(signed.withColumn("n", F.monotonically_increasing_id()), "texts-signed")
    first = F.min(F.struct("id", "n", "row")).alias("first")
    classes = rows.where("class is not null").groupBy("class").agg(first, F.count("*").alias("size"), F.any_value("bands").alias("bands"), F.any_value("short").alias("short"))
    classes = materialize(classes, "texts-classes")
    buckets = classes.select("class", F.posexplode("bands").alias("band", "code"))
    pieces = paired(buckets, ["band", "code"], "class", BUCKET_BLOCK)
    pieces = pieces.join(classes.select("class", "short"), "class")
    needed = least_matches(n, STEP, threshold, TOLERANCE)

    def edges(batches):
        for table in runs(batches, ["band", "code", "lo", "hi"]):
            short = np.frombuffer(b"".join(table.column("short").to_pylist()), dtype=np.uint8).reshape(table.num_rows, n)
            mine, lo, hi = (np.asarray(table.column(c)) for c in ("mine", "lo", "hi"))
            left = np.flatnonzero(mine == lo[0])
            right = left if lo[0] == hi[0] else np.flatnonzero(mine == hi[0])
            found = spanning(table.num_rows, left, right, lambda i, o, short=short: survivors(short, i, o, needed))
            if found:
                a, b = stars(table.column("class").to_pylist(), found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    found = together(pieces, ["band", "code", "lo", "hi"]).mapInArrow(edges, "a binary, b binary").distinct()
    members = materialize(connected_components(found).withColumnRenamed("node", "class"), "texts-cells")

    # The exact sets of the classes in cells, from their first rows' whole texts.
    wanted = members.join(classes.select("class", "first.row", "size"), "class")
    # Repeated rows have one key; the join has put them together.
    texts = docs.select(row_key(docs["doc_id"], docs["text"]).alias("row"), docs["text"].alias("text")).join(wanted, "row").dropDuplicates(["row"])

    def sets(batches):
        for batch in batches:
            made = shingle_sets(batch.column(0), words)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array([s.tobytes() for s in made], pa.binary())], names=["class", "component", "size", "set"])

    exact = materialize(texts.select("text", "class", "component", "size").mapInArrow(sliced(0, sets), "class binary, component binary, size long, set binary"), "texts-sets")
    drop(spark, members)
    cells = paired(exact, ["component"], "class", BLOCK, F.octet_length("set"), BLOCK_BYTES)

    def verify(batches):
        for table in runs(batches, ["component", "lo", "hi"]):
            parts = [np.frombuffer(s, dtype=np.uint64) for s in table.column("set").to_pylist()]
            count = np.array([len(p) for p in parts])
            values, flat = np.unique(np.concatenate(parts), return_inverse=True)
            bounds = np.concatenate(([0], np.cumsum(count)))
            mine, size = np.asarray(table.column("mine")), np.asarray(table.column("size"))
            lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
            links = np.zeros(len(parts), dtype=np.int64)
            pairs = []
            parent = np.arange(len(parts))
            for r, shared in intersections(flat, bounds[:-1], len(values), np.flatnonzero(mine == lo), bounds):
                # Compared in whole numbers as far as they go: shared >= threshold * union.
                ok = shared >= threshold * (count + count[r] - shared) - 1e-9
                ok[r] = False
                if lo != hi:
                    ok &= mine == hi
                hits = np.flatnonzero(ok)
                links[r] += size[hits].sum()
                if lo != hi:
                    links[hits] += size[r]
                fresh = hits[parent[hits] != parent[r]]
                if len(fresh):
                    old, first = np.unique(parent[fresh], return_index=True)
                    pairs += [(r, j) for j in fresh[first].tolist()]
                    parent[np.isin(parent, old)] = parent[r]
            names = table.column("class").to_pylist()
            a, b = stars(names, pairs)
            # A row per member with its links, and one per spanning edge with a second class.
            yield pa.RecordBatch.from_arrays(
                [pa.array(names + a, pa.binary()), pa.array([None] * len(names) + b, pa.binary()), pa.array(links.tolist() + [0] * len(a), pa.int64())], names=["class", "other", "n"]
            )

    checked = materialize(together(cells, ["component", "lo", "hi"]).mapInArrow(trimmed(verify), "class binary, other binary, n long"), "texts-links")
    drop(spark, exact)
    links = checked.where("other is null").groupBy("class").agg(F.sum("n").alias("links"))
    final = connected_components(checked.where("other is not null").select(F.col("class").alias("a"), F.col("other").alias("b")))
    lowest = final.join(classes.select(F.col("class").alias("node"), "first"), "node").groupBy("component").agg(F.min("first").alias("head"))
    heads = keyed_join(final, lowest, ["component"], "node").select(F.col("node").alias("class"), "head")
    known = classes.select("class", "first", "size").join(links, "class", "left").join(heads, "class", "left")
    known = known.select("class", F.col("first.id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("head", "first").alias("head"))
    out = keyed_join(rows.select("row", "id", "n", "class"), known, ["class"], "n", "left")
    shown = lambda c: F.nullif(c, F.lit(NO_ID))
    return out.select(
        "row",
        F.col("class").isNotNull().alias("worded"),
        shown(F.col("id")).alias("doc_id"),
        shown(F.coalesce("class_id", "id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        shown(F.coalesce("head.id", "id")).alias("component_id"),
        F.coalesce(F.col("head.n") == F.col("n"), F.lit(True)).alias("kept"),
    )


def _compact(sign):
    """Signatures as band codes and one byte of each value, as that is all that later steps read."""

    def run(batches):
        for batch in sign(batches):
            bands, short = [], []
            for s in batch.column(3).to_pylist():
                if s is None:
                    bands.append(None)
                    short.append(None)
                    continue
                v = np.frombuffer(s, dtype=np.uint64)
                code = np.full(BANDS, 0x9E3779B97F4A7C15, dtype=np.uint64)
                for r in range(ROWS):
                    code = (code ^ v[r::ROWS]) * np.uint64(0xD6E8FEB86659FD93)
                    code ^= code >> np.uint64(31)
                bands.append(code.view(np.int64))
                short.append((v >> np.uint64(40)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(bands, pa.list_(pa.int64())), pa.array(short, pa.binary())], names=["row", "id", "class", "bands", "short"])

    return run


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each near-duplicate component, with its own columns; the first by id, null ids last.

    Rows without words (null, empty, blank) are no one's copies and all stay. Of
    rows with one id and text but other columns, the one with the least hash of
    all columns stays, whatever the order of the input.
    """
    mark, tie = "__near_texts_row", "__near_texts_tie"
    stay = link(docs).where("kept and worded").select(F.col("row").alias(mark), F.lit(True).alias(tie)).distinct()
    blank = ~F.coalesce(docs["text"], F.lit("")).rlike(r"[^ \t\n\x0B\f\r]")
    named = docs.withColumn(mark, row_key(docs["doc_id"], docs["text"]))
    # Of repeated rows, which have one key, one stays; the join has put them together.
    names = [F.col(f"`{c}`") for c in docs.columns]
    one = named.where(~blank).join(stay, mark).groupBy(mark).agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias(tie))
    return one.select(*[F.col(f"`{tie}`.`{c}`").alias(c) for c in docs.columns]).unionByName(named.where(blank).select(*names))
