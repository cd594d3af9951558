"""Substring dedup with compressed FM-indexes over content-defined shards.

Each window of words is named by its least k-gram (a minimiser), so equal
windows of any documents share an anchor. Runs of windows with one anchor are
segments. Only anchors that occur in two documents can hold a repeat; their
distinct segments, each with the least document that has it, go to shards by
anchor. A shard builds an FM-index over wavelet matrices and streams its
segments through it by backward search; the matching statistics, cut off at
the window's length, give each window its group of equal windows and so the
least document that has it. Documents read the answers of their segments.

An anchor with very many distinct segments (a passage in countless contexts)
is dealt out by the hash of each window instead, so no shard grows with it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.fm_index import FMIndex
from concordat.llm.groups import ROW, row_key, runs, together
from concordat.llm.memory import sliced, trimmed
from concordat.llm.words import batch_hashes, rolled
from concordat.operators.joins import keyed_join
from concordat.storage import bounded_batches, discard, materialize, ship

WINDOW = 50
GRAM = 10
SHARD_WORDS = 400_000
SPLIT_SEGMENTS = 8_000  # an anchor is dealt out by window once its segments alone are about two shards


def sliding(h: np.ndarray, w: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over each ``w`` consecutive values."""
    n, cur, size = len(h) - w + 1, h, 1
    if n <= 0:
        return h[:0]
    while 2 * size <= w:
        cur = op(cur[:-size], cur[size:])
        size *= 2
    return op(cur[:n], cur[w - size : w - size + n])


def anchors(h: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """(anchor, first window, last window, their hashes, document) of each segment of a batch.

    ``h`` are word hashes, ``offsets`` the documents' bounds in them; windows
    are named by their first word's position in ``h``.
    """
    none = np.zeros(0, np.int64)
    if len(h) < window:
        return np.zeros(0, np.uint64), none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64), none
    w = window - gram + 1
    g, whole = rolled(h, gram), rolled(h, window)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    valid = np.arange(len(whole)) + window <= ends[: len(whole)]
    least = sliding(g, w, np.minimum)
    seen = np.where(valid, least, 0)
    padded = np.concatenate((np.zeros(w - 1, np.uint64), seen, np.zeros(w - 1, np.uint64)))
    most = sliding(padded, w, np.maximum)  # of the windows that hold each k-gram
    at = np.flatnonzero((most == g) & (most > 0))
    first, last = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    step = 200_000
    for i in range(0, len(at), step):
        p = at[i : i + step]
        hit = padded[p[:, None] + np.arange(w)] == g[p][:, None]
        first[i : i + step] = p - w + 1 + hit.argmax(axis=1)
        last[i : i + step] = p - hit[:, ::-1].argmax(axis=1)
    doc = np.searchsorted(offsets, at, side="right") - 1
    return g[at], first, last, whole[first], whole[last], doc


SEGMENTS = "array<struct<h:long,s:int,n:int,k1:long,k2:long>>"


def find(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, starts): the windows of each row of ``docs`` (doc_id, text) that a smaller doc_id has too.

    ``row`` is the row's :func:`row_key`, ``starts`` the positions of the windows' first words. Rows without such
    windows are left out, and so are null ids, which are not compared; null and
    short texts have no windows; a repeated row never removes itself.
    """
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)
    plain = docs.select(row_key(docs["doc_id"], docs["text"]).alias("row"), docs["doc_id"].cast("long").alias("doc"), docs["text"].alias("text"))

    def cut(batches):
        for batch in batches:
            h, offsets = batch_hashes(batch.column(2))
            g, first, last, k1, k2, doc = anchors(h, offsets, window)
            bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            base = offsets[doc] if len(doc) else doc
            parts = [g.view(np.int64), (first - base).astype(np.int32), (last - first).astype(np.int32), k1.view(np.int64), k2.view(np.int64)]
            values = pa.StructArray.from_arrays([pa.array(x) for x in parts], names=["h", "s", "n", "k1", "k2"])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(bounds), values)], names=["row", "doc", "a"])

    made = materialize(plain.where("doc is not null").mapInArrow(sliced(2, cut), f"row {ROW}, doc long, a {SEGMENTS}"), "repeat-anchors")
    every = made.select("row", "doc", F.inline("a"))
    shared = every.groupBy("h").agg(F.min("doc").alias("x"), F.max("doc").alias("y")).where("x < y").select("h")
    hits = materialize(keyed_join(every, shared, ["h"], "row"), "repeat-hits")
    discard(spark, made)
    owners = hits.groupBy("k1", "k2", "n").agg(F.min(F.struct("doc", "row", "s", "h")).alias("o"))
    owners = materialize(owners.select("k1", "k2", "n", "o.*"), "repeat-owners")
    many = owners.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") > SPLIT_SEGMENTS).select("h", F.lit(True).alias("split"))
    asked = keyed_join(owners, many, ["h"], "k1, k2, n", "left").select("row", F.struct("k1", "k2", "n", "doc", "s", "h", F.coalesce("split", F.lit(False)).alias("split")).alias("seg"))
    asked = asked.groupBy("row").agg(F.collect_list("seg").alias("segs"))  # a document's own segments

    def words_of(batches):
        for batch in batches:
            h, offsets = batch_hashes(batch.column(0))
            rows = []
            for d, segs in enumerate(batch.column(1).to_pylist()):
                own = h[offsets[d] : offsets[d + 1]]
                for s in segs:
                    part = own[s["s"] : s["s"] + s["n"] + window]
                    each = rolled(part, window).view(np.int64).tolist() if s["split"] else None
                    rows.append((s["k1"], s["k2"], s["n"], s["doc"], s["h"], each, part.tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["k1", "k2", "n", "doc", "h", "each", "words"])

    # Repeated rows have one key; the join has put them together.
    texts = plain.select("row", "text").join(asked, "row").dropDuplicates(["row"]).select("text", "segs")
    segs = materialize(texts.mapInArrow(sliced(0, words_of), "k1 long, k2 long, n int, doc long, h long, each array<long>, words binary"), "repeat-segments")
    discard(spark, owners)

    # Split anchors: one row for each repeated window, taken from the segment of the least document.
    spread = segs.where("each is not null").select("k1", "k2", "n", "doc", F.posexplode("each").alias("i", "w"))
    again = spread.groupBy("w").agg(F.min(F.struct("doc", "k1", "k2", "n", "i")).alias("m"), F.count("*").alias("c")).where("c > 1").select("w", "m.*")
    single = again.join(segs.where("each is not null").select("k1", "k2", "n", "words"), ["k1", "k2", "n"])
    single = single.select(F.col("w").alias("route"), F.col("w").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(-1).alias("n"), "doc", F.expr(f"substring(words, i * 8 + 1, {8 * window})").alias("words"))
    whole = segs.where("each is null").select(F.col("h").alias("route"), "k1", "k2", "n", "doc", "words")
    pieces = materialize(whole.unionByName(single), "repeat-pieces")
    total = pieces.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0)).alias("t")).first()["t"] // 8
    shards = max(1, -(-total // SHARD_WORDS))

    def search(batches):
        for table in runs(batches, ["shard"]):
            parts = [np.frombuffer(b, dtype=np.uint64) for b in table.column("words").to_pylist()]
            bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            words = np.concatenate(parts)
            index = FMIndex(words, bounds, window)
            docs_of = np.asarray(table.column("doc"))
            least = index.least(docs_of)
            groups = index.groups(words, bounds)
            starts = groups >= 0
            lists = np.concatenate(([0], np.cumsum(starts)))[bounds].astype(np.int32)
            least = pa.ListArray.from_arrays(pa.array(lists), pa.array(least[groups[starts]]))
            yield pa.RecordBatch.from_arrays([*(table.column(c).combine_chunks() for c in ("k1", "k2", "n")), least], names=["k1", "k2", "n", "least"])

    dealt = pieces.withColumn("shard", F.expr(f"pmod(xxhash64(route), {shards}L)")).drop("route")
    answers = materialize(together(dealt, ["shard"]).mapInArrow(trimmed(search), "k1 long, k2 long, n int, least array<long>"), "repeat-answers")
    discard(spark, pieces)
    alone = answers.where("n = -1").select(F.col("k1").alias("w"), F.col("least")[0].alias("m"))
    rebuilt = keyed_join(spread, alone, ["w"], "k1, k2, n", "left").groupBy("k1", "k2", "n").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("m", "doc").alias("m")))).alias("l"))
    known = answers.where("n >= 0").unionByName(rebuilt.select("k1", "k2", "n", F.col("l.m").alias("least")))
    told = keyed_join(hits, known, ["k1", "k2", "n"], "row, s").select("row", F.expr("filter(transform(least, (m, i) -> if(m < doc, s + i, -1)), x -> x >= 0)").alias("x")).where("size(x) > 0")
    out = materialize(told.groupBy("row").agg(F.flatten(F.collect_list("x")).alias("starts")), "repeat-starts")
    discard(spark, hits, segs, answers)
    return out


def covered(n: int, starts: list[int] | None, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that begins at one of ``starts``."""
    change = np.zeros(n + 1, dtype=np.int64)
    if starts:
        at = np.unique(np.array(starts, dtype=np.int64))
        np.add.at(change, at, 1)
        np.add.at(change, at + window, -1)
    return np.cumsum(change[:n]) > 0


def kept_words(text: str | None, starts: list[int] | None, window: int) -> tuple[int, int, bytes]:
    """(words, words removed, the others joined by one space)."""
    words = (text or "").encode().split()
    if not starts:
        return len(words), 0, b" ".join(words)
    gone = covered(len(words), starts, window).tolist()
    left = [w for w, g in zip(words, gone, strict=True) if not g]
    return len(words), len(words) - len(left), b" ".join(left)


def digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs``."""
    starts = find(docs, window)

    def run(batches):
        for batch in batches:
            rows = [kept_words(t, s, window) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            cols = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = docs.select(row_key(docs["doc_id"], docs["text"]).alias("row"), docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    joined = rows.join(starts, "row", "left").select("doc_id", "text", "starts")
    return joined.mapInArrow(sliced(1, run), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut from the texts, and their own columns.

    A text that loses words becomes the others joined by one space (maybe
    empty), with ``n_chars`` to match if there is such a column; all other
    texts, null and empty ones too, stay as they are. Rows with null ids are not
    compared and stay whole; repeated rows stay, cut alike.
    """
    starts = find(docs, window)
    row, mark = "__substrings_row", "__substrings_starts"
    names, schema = docs.columns, docs.schema
    text = names.index("text")
    chars = names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        for batch in batches:
            cols = list(batch.columns[:-1])
            new, lengths = [], []
            old = cols[chars].to_pylist() if chars is not None else [None] * batch.num_rows
            for t, s, n in zip(cols[text].to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), old, strict=True):
                if s:
                    t = kept_words(t, s, window)[2].decode()
                    n = len(t)
                new.append(t)
                lengths.append(n)
            cols[text] = pa.array(new, cols[text].type)
            if chars is not None:
                cols[chars] = pa.array(lengths, cols[chars].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    marked = docs.withColumn(row, row_key(docs["doc_id"], docs["text"]))
    joined = marked.join(starts.withColumnsRenamed({"row": row, "starts": mark}), row, "left")
    return joined.select(*[F.col(f"`{c}`") for c in names], mark).mapInArrow(sliced(text, run), schema)
