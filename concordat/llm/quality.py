"""Compression classifier: a text is good if a dictionary of good text shrinks it more.

Two zstandard dictionaries are built, from good and from bad labelled text. A
text is compressed whole, in pieces so that the dictionaries count all along
it, with either; the difference of the two sizes over their sum, at two piece
lengths, is turned into a probability by a logistic calibration.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.memory import sliced
from concordat.storage import bounded_batches, ship

SAMPLE_PER_CLASS = 3000
SAMPLE_BYTES = 16_000_000
PIECE = 2048
LEAST_PIECES = 8  # fewer can't be trained on
DICTIONARY_BYTES = 112_640
PIECES = (512, 2048)
LEVEL = 3
THRESHOLD = 0.3


@dataclass
class Model:
    """Dictionaries (bad, good) as bytes, and the calibration's weights."""

    dictionaries: tuple[bytes, bytes]
    weights: tuple[float, ...]
    constant: float | None = None


class Sizer:
    def __init__(self, model: Model):
        self.packs = []
        for data in model.dictionaries:
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT)
            d.precompute_compress(level=LEVEL)
            self.packs.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False))

    def features(self, text: str | None) -> list[float]:
        data, out = (text or "").encode(), []
        bad, good = (p.compress for p in self.packs)
        for k in PIECES:
            a = b = 0
            for i in range(0, len(data), k):
                piece = data[i : i + k]
                a += len(bad(piece))
                b += len(good(piece))
            out.append((a - b) / (a + b) if a + b else 0.0)
        return out


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; pieces are repeated where there are fewer than training takes."""
    pieces = [d[i : i + PIECE] for t in texts for d in [t.encode()] for i in range(0, len(d), PIECE)]
    return zstandard.train_dictionary(DICTIONARY_BYTES, pieces * -(-LEAST_PIECES // len(pieces))).as_bytes()


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge * w * [0, *[1] * (len(w) - 1)]
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


SCALE = 20.0


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, most_bytes: int = SAMPLE_BYTES) -> tuple[list[list[str]], dict[int, int]]:
    """(whole texts of either class, how many training labels each class has).

    Of each class the ``per_class`` ids with the least hash, as long as their
    texts together are within ``most_bytes``; no text is cut. Of rows that
    repeat an id the text with the least hash counts. Ids with other or
    contradicting labels are not used; null labels say nothing and repeated ones
    count once. Null and
    empty texts teach nothing and are left out.
    """
    usable = labels.where("doc_id is not null and crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0")
    one = usable.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("most")).where("q = most and q in (0, 1)").select("doc_id", "q")
    counts = {r["q"]: r["n"] for r in one.groupBy("q").agg(F.count("*").alias("n")).collect()}
    picked = [one.where(F.col("q") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for q in (0, 1)]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * per_class rows
    rows = docs.select(docs["doc_id"], docs["text"]).where("text <> ''").join(ids, "doc_id").groupBy("doc_id", "q").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    by: list[list[str]] = [[], []]
    room, full = [most_bytes, most_bytes], [False, False]
    for r in rows.select("q", F.col("t.text").alias("text"), F.xxhash64("doc_id").alias("h"), "doc_id").orderBy("h", "doc_id").toLocalIterator():
        q, n = r["q"], len(r["text"].encode())
        full[q] = full[q] or n > room[q]
        if not full[q]:
            by[q].append(r["text"])
            room[q] -= n
    return by, counts


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, most_bytes: int = SAMPLE_BYTES) -> Model:
    """Learn from labelled rows whose crc32(doc_id as text) mod 5 is not 0.

    The :func:`sample` is bounded by rows and bytes. Half of it makes the
    dictionaries, the other half calibrates, weighted by how often each class
    occurs among all training labels. Without text of both classes the score is
    the share of good labels, or 0.5 without any.
    """
    by, counts = sample(docs, labels, per_class, most_bytes)
    if not all(by):
        return Model((b"", b""), (), constant=counts.get(1, 0) / sum(counts.values()) if counts else 0.5)
    made = [_dictionary(t[::2]) for t in by]
    model = Model((made[0], made[1]), ())
    sizer = Sizer(model)
    held = [t[1::2] or t for t in by]
    x = np.array([sizer.features(t) for ts in held for t in ts]) * SCALE
    y = np.array([q for q in (0, 1) for _ in held[q]], dtype=float)
    each = np.array([counts[q] / len(held[q]) for q in (0, 1) for _ in held[q]])
    model.weights = tuple(_logistic(x, y, each).tolist())
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, from its whole text.

    Null and empty texts get the calibration's score for no difference. Rows
    with null or repeated ids are scored like any other (null: not held out).
    Only doc_id and text are read, so other columns' names cannot clash.
    """
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)

    def run(batches):
        sizer = None if model.constant is not None else Sizer(model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if sizer is None:
                p = np.full(len(texts), model.constant)
            else:
                x = np.array([sizer.features(t) for t in texts]).reshape(len(texts), len(PIECES)) * SCALE
                p = 1 / (1 + np.exp(-np.clip(model.weights[0] + x @ np.array(model.weights[1:]), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(sliced(1, run), "doc_id long, score double")
    held = F.coalesce(F.expr("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the classifier does not reject, with their own columns.

    The verdict is computed on the row itself, so repeated ids need no join and
    repeated rows share a verdict. Null and empty texts get the calibration's
    score for no difference; other columns are carried along whatever their names.
    """
    model = fit(docs, labels)
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)
    at = docs.columns.index("text")

    def run(batches):
        sizer = None if model.constant is not None else Sizer(model)
        weights = np.array(model.weights[1:])
        for batch in batches:
            if sizer is None:
                good = np.full(batch.num_rows, model.constant >= THRESHOLD)
            else:
                x = np.array([sizer.features(t) for t in batch.column(at).to_pylist()]).reshape(batch.num_rows, len(PIECES)) * SCALE
                good = 1 / (1 + np.exp(-np.clip(model.weights[0] + x @ weights, -30, 30))) >= THRESHOLD
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(sliced(at, run), docs.schema)
