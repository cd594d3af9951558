"""Benchmark decontamination by canonical templates.

Words become template tokens: numbers, units after numbers and names turn into
typed placeholders, all else is lower-cased without outer punctuation. Windows
of template tokens are hashed and joined with those of the benchmark. On each
alignment of a document with an item the names must be consistent: one name of
the item always stands for one name of the document, else windows with that
name count only where they are verbatim. Equal numbers and units may be
independent quantities and may differ, and a name may have any number of words. So verbatim passages are found, and
questions with other numbers or names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.groups import ROW, row_key
from concordat.llm.memory import kept, sliced
from concordat.llm.words import KEPT, MUL, mix, rolled
from concordat.storage import bounded_batches, materialize, ship

WINDOW = 8
LEAST_ITEM = 5
LEAST_COVER = 13
LITERAL_SHARE = 0.5
FILTER_WINDOWS = 2_000_000

# Number words and unit words that become placeholders.
NUMBER_WORDS = frozenset("one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split())
UNIT_WORDS = frozenset(
    "mm cm m km in ft yd mi mg g kg t ml l s min h hr mph kph hz w kw v a c f meter meters metre metres kilometer kilometers kilometre kilometres mile miles inch inches foot feet "
    "gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degrees".split()
)

NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?")
OUTER = re.compile(r"^[^\w$€£+%-]+|[^\w%]+$")
NUM, UNIT, NAME = (np.uint64(xxhash.xxh3_64_intdigest(b"\x00" + k)) for k in (b"number", b"unit", b"name"))


def _kind(word: str) -> tuple[int, int, int, bool]:
    """(hash of the bare word, kind, 1 if it ends a sentence, empty): kind 0 literal, 1 number, 2 unit, 3 capitalised."""
    bare = word if word.isalpha() else OUTER.sub("", word)
    low = bare.lower()
    if not bare.isalnum() and not any(c.isalnum() for c in bare):
        return 0, 0, int(word[-1:] in ".!?"), True
    kind = 1 if NUMBER.fullmatch(bare) or low in NUMBER_WORDS else 2 if low in UNIT_WORDS else 3 if bare[:1].isupper() and not bare.isupper() else 0
    return xxhash.xxh3_64_intdigest(low.encode()), kind, int(word[-1:] in ".!?"), False


class Kinds(dict):
    """Kind of a word, kept for a bounded number of words."""

    def __missing__(self, word: str) -> tuple[int, int, int, bool]:
        if len(self) >= KEPT:
            self.clear()
        kind = self[word] = _kind(word)
        return kind


def templates(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(template tokens, values, slots, bounds): hashes of tokens and of the bare words, and which are placeholders."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    coded = split.flatten().dictionary_encode()
    kinds = kept(("kinds",), Kinds)
    info = [kinds[w] for w in coded.dictionary.to_pylist()]
    codes = np.asarray(coded.indices)
    bounds = np.asarray(split.offsets).astype(np.int64)
    bounds -= bounds[0]
    if not info:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool), bounds
    value = np.array([x[0] for x in info], dtype=np.uint64)[codes]
    kind = np.array([x[1] for x in info], dtype=np.int8)[codes]
    ends = np.array([x[2] for x in info], dtype=bool)[codes]
    keep = ~np.array([x[3] for x in info], dtype=bool)[codes]
    first = np.zeros(len(codes) + 1, dtype=bool)
    first[bounds[:-1]] = True
    first = first[:-1]
    opens = first | np.concatenate(([True], ends[:-1]))
    after_number = np.concatenate(([False], kind[:-1] == 1)) & ~first
    token = np.where(kind == 1, NUM, np.where((kind == 2) & after_number, UNIT, np.where((kind == 3) & ~opens, NAME, value)))
    bounds = np.concatenate(([0], np.cumsum(keep)))[bounds]
    token, value = token[keep], value[keep]
    return token, value, (token == NUM) | (token == UNIT) | (token == NAME), bounds


class Wanted:
    """Membership in a set of hashes: a table of their low bits sorts out most, a binary search decides."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.mask = np.int64((1 << max(16, (8 * len(hashes)).bit_length())) - 1)
        self.seen = np.zeros(int(self.mask) + 1, dtype=bool)
        self.seen[self.hashes & self.mask] = True

    def among(self, h: np.ndarray) -> np.ndarray:
        """Indices of the hashes in ``h`` that are in the set."""
        at = np.flatnonzero(self.seen[h & self.mask])
        i = np.searchsorted(self.hashes, h[at])
        i[i == len(self.hashes)] = 0
        return at[self.hashes[i] == h[at]] if len(self.hashes) else at


def folded(token: np.ndarray, value: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first words, values, bounds) of the tokens when each run of names is one name, whose value is that of all its words.

    A capitalised word of no name that stands before a run belongs to it, for all that can be told.
    """
    name = token == NAME
    follows = name.copy()
    follows[1:] &= name[:-1]
    follows[:1] = False
    follows[bounds[:-1][bounds[:-1] < len(token)]] = False
    first = np.flatnonzero(~follows)
    if not len(first):
        return first, value, bounds
    place = np.arange(len(token)) - np.repeat(first, np.diff(np.append(first, len(token))))
    spread = np.where(place > 0, mix(value + place.astype(np.uint64) * MUL), value)
    return first, np.add.reduceat(spread, first), np.searchsorted(first, bounds)


def windows(texts: pa.Array, sizes: list[int] | None, wanted: Wanted | None):
    """Yield (k, document, run, pos, fold, first word, end, hash, slots, same) of windows of ``k`` tokens; ``sizes`` None: of the sizes each text needs as an item.

    What stands before a window decides whether its first word is taken for a
    name or unit, so such a window is hashed with its first word as a literal
    too. Every window with slots is also hashed with all its words as literals,
    so a verbatim copy is found whatever its words are taken for. ``same`` has
    the words that are equal by the hash itself though they are slots elsewhere.
    A template with too few literal tokens names nothing in particular: such
    windows match verbatim only. A window over a run of names is also hashed
    with the run as one name, so names may have other numbers of words; ``run``
    marks those, and ``fold`` is a window's place when all runs are folded. The
    lowest bit of a slot's value tells names.
    """
    token, value, slot, bounds = templates(texts)
    n = len(token)
    first, joint, folds = folded(token, value, bounds)
    coded = (value & ~np.uint64(1)) | (token == NAME)
    unsure = slot & (token != NUM)
    place = np.searchsorted(first, np.arange(n), side="right") - 1  # of each word among the folded tokens
    width = np.diff(np.append(first, n))
    plain = (token, value, slot, coded, bounds, np.arange(n + 1), place)
    runs = (token[first], joint, slot[first], (joint & ~np.uint64(1)) | (token[first] == NAME), folds, np.append(first, n), np.arange(len(first)))
    every = np.arange(WINDOW)

    def forms(stream, k: int, run: bool):
        """(windows, first word, hash of the others, words that are equal by the hash) of a stream."""
        tok, val, hole, _, ends, _, _ = stream
        tail = rolled(tok[1:], k - 1)
        m = len(tail)
        length = np.diff(ends)
        fits = np.arange(k, m + k) <= np.repeat(ends[1:], length)[:m]
        if sizes is None:
            fits &= np.repeat(np.minimum(length, WINDOW), length)[:m] == k
        filled = np.concatenate(([0], np.cumsum(hole)))
        slots = filled[k:][:m] - filled[:m]
        few = k * (1 - LITERAL_SHARE)
        if run:
            wide = np.concatenate(([0], np.cumsum(width > 1)))
            return ((fits & (slots <= few) & (wide[k:][:m] > wide[:m]), tok, tail, every < 0),)
        return (
            (fits & (slots <= few), tok, tail, every < 0),
            (fits & (slots - 1 <= few) & unsure[:m], val, tail, every < 1),
            (fits & (slots > 0), val, rolled(val[1:], k - 1), every >= 0),
        )

    for stream, run in ((plain, False), (runs, True)):
        length = np.diff(stream[4])
        own = sorted({int(min(WINDOW, x)) for x in length if x >= LEAST_ITEM}) if sizes is None else sizes
        for k in own if not run or (width > 1).any() else []:
            for ok, head, rest, equal in forms(stream, k, run):
                at = np.flatnonzero(ok)
                h = mix(head[at] * MUL + rest[at]).view(np.int64)
                if wanted is not None:
                    hit = wanted.among(h)
                    at, h = at[hit], h[hit]
                if len(at):
                    _, _, hole, words, ends, begin, fold = stream
                    doc = np.searchsorted(ends, at, side="right") - 1
                    grid = at[:, None] + np.arange(k)
                    holes, own_words = hole[grid], words[grid]
                    a, b = begin[at] - bounds[doc], begin[at + k] - bounds[doc]
                    yield k, doc, run, at - ends[doc], fold[at] - folds[doc], a, b, h, _lists(own_words, holes & ~equal[:k]), _lists(own_words, holes & equal[:k])


def _lists(values: np.ndarray, chosen: np.ndarray) -> pa.Array:
    """The chosen values of each row, as lists."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(chosen.sum(axis=1)))).astype(np.int32)), pa.array(values[chosen].view(np.int64)))


def _passages(line: DataFrame) -> DataFrame:
    """Alignments with the windows (pos, a, b, pairs) that count.

    With consistent names all do. Else the verbatim ones and those without a
    name at odds are left, and of these the passages that are long enough each
    by itself, so that pieces between the contradictions do not add up.
    """
    k, least = F.col("k"), F.least("size", F.lit(LEAST_COVER))
    windows, names, odd, kept, pos = (F.col(c) for c in ("windows", "names", "odd", "kept", "pos"))
    line = line.withColumn("names", F.array_sort(F.transform(F.array_distinct(F.filter(F.flatten(windows["pairs"]), lambda p: p["theirs"].bitwiseAND(1) == 1)), lambda p: p["theirs"])))
    line = line.withColumn("odd", F.array_distinct(F.filter(names, lambda n, i: (i > 0) & (F.get(names, i - 1) == n))))
    line = line.withColumn("kept", F.filter(windows, lambda w: ~F.arrays_overlap(w["pairs"]["theirs"], odd) | F.forall(w["pairs"], lambda p: p["theirs"] == p["mine"])))
    line = line.withColumn("pos", F.array_sort(F.array_distinct(kept["pos"])))
    starts = F.filter(pos, lambda p, i: (i == 0) | (p > F.get(pos, i - 1) + k))
    stops = F.filter(pos, lambda p, i: (i == F.size(pos) - 1) | (F.get(pos, i + 1) > p + k))
    long = F.filter(F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda s: s["b"] + k - s["a"] >= least)
    passages = F.flatten(F.transform(long, lambda s: F.filter(kept, lambda w: w["pos"].between(s["a"], s["b"]))))
    return line.select("row", "id", "size", "run", F.when(F.size(odd) == 0, windows).otherwise(passages).alias("windows"))


FOUND = f"id {ROW}, size int, k int, run boolean, pos int, fold int, a int, b int, h long, slots array<long>, same array<long>"


def _windows_of(sizes: list[int] | None, hashes: np.ndarray | None):
    """A mapInArrow function over (id, text); ``sizes`` None: what each text itself needs as an item. ``size`` is its number of words."""

    def run(batches):
        wanted = None if hashes is None else Wanted(hashes)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            length = np.diff(templates(texts)[3]) if sizes is None else None
            for k, doc, folds, pos, fold, a, b, h, slots, same in windows(texts, sizes, wanted):
                size = np.full(len(doc), k) if length is None else length[doc]
                whole = [pa.array(np.broadcast_to(x, len(doc)).astype(np.int32)) for x in (size, k)]
                places = [pa.array(x.astype(np.int32)) for x in (pos, fold, a, b)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc)), *whole, pa.array(np.full(len(doc), folds)), *places, pa.array(h), slots, same], names=["id", "size", "k", "run", "pos", "fold", "a", "b", "h", "slots", "same"])

    return sliced(1, run)


def find(docs: DataFrame, benchmark: DataFrame, filter_windows: int = FILTER_WINDOWS) -> DataFrame:
    """(row, doc_id, item_id, n_windows, n_covered, n_words, n_slots, reworded) of each leak.

    A document leaks an item if windows with consistent names cover at least
    ``LEAST_COVER`` of the item's words, or the whole item if it is shorter; on
    an alignment where names contradict each other, its passages must do so
    each by itself (:func:`_passages`).
    ``reworded``: not all that is covered is verbatim. Items of fewer than
    ``LEAST_ITEM`` words and null texts match nothing; null ids are carried
    along; repeated items and rows are each reported. ``row`` is the row's
    :func:`row_key`.

    The benchmark's window hashes go to the executors as a filter if there are
    at most ``filter_windows`` (8 bytes each); beyond that every window of the
    documents goes into the hash join. The result is the same.
    """
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)
    items = benchmark.select(row_key(benchmark["item_id"], benchmark["text"]).alias("id"), benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].alias("text"))
    theirs = materialize(items.select("id", "text").mapInArrow(_windows_of(None, None), FOUND), "benchmark-windows")
    distinct = theirs.select("h").distinct()
    wanted = None
    if distinct.count() <= filter_windows:
        wanted = np.array([r["h"] for r in distinct.collect()], dtype=np.int64)
    sizes = sorted(r["k"] for r in theirs.select("k").distinct().collect()) or [WINDOW]
    rows = docs.select(row_key(docs["doc_id"], docs["text"]).alias("row"), docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    ours = rows.select("row", "text").mapInArrow(_windows_of(sizes, wanted), FOUND).select(F.col("id").alias("row"), "k", F.col("run").alias("our_run"), F.col("pos").alias("at"), F.col("fold").alias("our_fold"), "h", F.col("slots").alias("mine"))
    met = ours.join(theirs, ["h", "k"]).withColumn("run", F.col("run") | F.col("our_run"))
    # Where a run of names counts as one, places are told with all runs folded, on both sides.
    at, pos = F.when(F.col("run"), F.col("our_fold")).otherwise(F.col("at")), F.when(F.col("run"), F.col("fold")).otherwise(F.col("pos"))
    pairs = F.expr("concat(zip_with(slots, mine, (t, m) -> struct(t as theirs, m as mine)), transform(same, s -> struct(s as theirs, s as mine)))")
    met = met.select("row", "id", "size", "k", "run", (at - pos).alias("shift"), pos.alias("pos"), "a", "b", pairs.alias("pairs"))
    # A passage may lie on one alignment only once, so these lists are no longer than the item's hashes.
    line = met.groupBy("row", "id", "size", "k", "run", "shift").agg(F.collect_set(F.struct("pos", "a", "b", "pairs")).alias("windows"))
    steady = _passages(line).where("size(windows) > 0")
    # What is verbatim is so word by word.
    verbatim = F.filter("windows", lambda w: ~F.col("run") & F.forall(w["pairs"], lambda p: p["theirs"] == p["mine"]))
    spans = lambda windows: F.array_distinct(F.flatten(F.collect_set(F.transform(windows, lambda w: F.struct(w["a"], w["b"])))))
    whole = steady.groupBy("row", "id", "size").agg(spans(F.col("windows")).alias("spans"), spans(verbatim).alias("exact"), F.array_distinct(F.flatten(F.flatten(F.collect_set("windows.pairs")))).alias("pairs"))
    covered = lambda c: F.expr(f"size(array_distinct(flatten(transform({c}, s -> sequence(s.a, s.b - 1)))))")
    leaks = whole.withColumn("n_covered", covered("spans")).where(F.col("n_covered") >= F.least("size", F.lit(LEAST_COVER)))
    leaks = leaks.select(
        "row", "id", F.size("spans").alias("n_windows"), "n_covered", F.col("size").alias("n_words"), F.size("pairs").alias("n_slots"), (covered("exact") < F.col("n_covered")).alias("reworded")
    )
    named = leaks.join(items.select("id", "item_id"), "id").drop("id")
    return rows.select("row", "doc_id").join(named, "row").select("row", "doc_id", "item_id", "n_windows", "n_covered", "n_words", "n_slots", "reworded")


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that leak no item, with their own columns.

    Null and empty texts leak nothing and stay, null ids are like any other;
    repeated rows stay or go together. An empty benchmark removes nothing.
    """
    mark = "__decontaminate_row"
    leaking = find(docs, benchmark).select(F.col("row").alias(mark)).distinct()
    return docs.withColumn(mark, row_key(docs["doc_id"], docs["text"])).join(leaking, mark, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
