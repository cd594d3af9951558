"""The language-model operators against brute force, round trips and held-out accuracy, on small fixtures.

Each operator also meets nulls, empty and very long texts, ties, repeated rows,
an empty table and extra columns whose names clash with its own.
"""

import hashlib
import io
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from concordat.llm import decontaminate, encode, fm_index, groups, near_texts, near_vectors, pieces, quality, registry, substrings, token_index, token_scan, url_filter, warc, wavelet
from concordat.operators import joins

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, row string, n_links long, score double"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text) with copies, near copies, shared passages, nulls, empties, repeats and a very long text."""
    rng = random.Random(5)
    out = [prose(rng, rng.randrange(20, 200)) for _ in range(30)]
    out += [out[0]] * 6 + [out[1].replace("w1 ", "x1 ", 1)] + [out[1] + " tail"]
    shared = prose(rng, 70)
    out += [f"{prose(rng, 30)} {shared} {prose(rng, 25)}" for _ in range(8)]
    base = prose(rng, 150).split()
    for i in range(40):
        w = list(base)
        w[rng.randrange(len(w))] = f"n{i}"
        out.append(" ".join(w))
    out += [None, "", "  \n\t ", "one two", "one two", prose(rng, 4000), "  lead a\x1c b\x0bc\n\nd  e ", "<|endoftext|> it's\r\n漢字 🎉 'S"]
    rows = [(i, t) for i, t in enumerate(out)]
    rows += [(None, out[0]), (None, None), (3, out[3]), (3, "another text of id three entirely")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "r", 7, 0.5) for i, t in texts], DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("specials", [False, True])
def test_encoder_equals_library(texts, specials):
    e = encode.WordEncoder(encode.vocabulary_path(registry.BYTE_BPE), cache_words=500, specials=specials)
    tok = Tokenizer.from_file(encode.vocabulary_path(registry.BYTE_BPE))
    tok.encode_special_tokens = not specials
    every = [t for _, t in texts] + ["a<|endoftext|>b <|endoftext|> c", "<|endoftext|>", "x <|endoftext|><|endoftext|>y  z"]
    ids, n = e.encode(every, 9)
    at = 0
    for t, k in zip(every, n, strict=True):
        assert ids[at : at + k].tolist() == [*tok.encode(t or "", add_special_tokens=False).ids, 9]
        at += k


def test_encoder_meets_each_run_once(monkeypatch):
    """Words with other signs, digits or line breaks at their runs of letters are no new words to the library."""
    path = encode.vocabulary_path(registry.BYTE_BPE)
    met = []
    fresh = encode.WordEncoder._fresh
    monkeypatch.setattr(encode.WordEncoder, "_fresh", lambda self, words: (met.extend(words.to_pylist()), fresh(self, words))[1])
    stems = [f"{a}{b}" for a in ("thing", "größe", "ación", "Ñandú") for b in ("sch", "ing", "tion", "ères", "o")]
    ends = ["", ",", ".", "!!", "***", "42", ".\nThe", "7,"]
    text = "x " + " ".join(s + e for s in stems for e in ends)
    ids, n = encode.WordEncoder(path).encode([text], 9)
    assert ids.tolist() == [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 9] and n.tolist() == [len(ids)]
    assert len(met) <= len(stems) + 10


@pytest.mark.parametrize("specials", [False, True])
@pytest.mark.parametrize("plain", [False, True])
def test_encoder_on_mixed_runs(specials, plain):
    """Runs of every kind side by side, with and without the cut at runs, in slices of Arrow arrays."""
    path = encode.vocabulary_path(registry.BYTE_BPE)
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = not specials
    e = encode.WordEncoder(path, cache_words=300, specials=specials)
    if not plain:
        e.kinds = np.where(encode.KINDS == encode.SPACE, encode.KINDS, np.uint8(encode.ODD))
    atoms = ["a", "The", "é", "ß", "×", "÷", "ɿ", "ʀ", "\u0308", "5", "²", "Ⅷ", "'s", "'", "'ll", "_", "...", "\n", "\r\n", "\n\n", "\t", "\x85", "\u3000", "\x1c", "\x00", "中文", "😀", "<|endoftext|>", "<|endof", "text|>", "«", "ª", "\ufeff"]
    rng = random.Random(5)
    for _ in range(60):
        texts = ["".join(rng.choice(atoms) + " " * (rng.random() < 0.4) for _ in range(rng.choice((0, 1, 2, 5, 20)))) for _ in range(rng.choice((1, 30)))]
        ids, n = e.encode(pa.array(["zz yy", *texts, "q"]).slice(1, len(texts)), 9)
        want = [[*tok.encode(t, add_special_tokens=False).ids, 9] for t in texts]
        assert ids.tolist() == [i for w in want for i in w] and n.tolist() == [len(w) for w in want]


def test_wavelet_round_trip():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 300, 5000).astype(np.uint32)
    lengths = np.array([0, 1000, 3999, 1])
    w = wavelet.WaveletMatrix(io.BytesIO(wavelet.build(ids, [1, 2, None, 4], lengths, 16)))
    assert (w.decode() == ids).all() and [d for d, _ in w.documents()] == [1, 2, None, 4]
    for v in (0, 7, 299, 301):
        where = np.flatnonzero(ids == v)
        assert w.count(v) == len(where) and w.rank(v, 1234) == (where < 1234).sum()
        assert [w.select(v, k) for k in range(len(where))] == where.tolist()
    assert [w.access(i) for i in range(0, 5000, 617)] == ids[::617].tolist()
    assert w.occurrences(int(ids[4999]))[-1] == (4, 0)
    with pytest.raises(IndexError):
        w.select(7, 10**6)
    assert wavelet.WaveletMatrix(io.BytesIO(wavelet.build(ids[:0], [5], np.array([0]), 16))).decode().size == 0


def test_token_index(spark, docs, texts, empty):
    m = token_index.write_index(docs, encode.vocabulary_path(registry.BYTE_BPE), 2, shard_ids=700)
    got = token_index.read_index(m).orderBy("start").collect()
    tok = Tokenizer.from_file(encode.vocabulary_path(registry.BYTE_BPE))
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at = 0
    for r, (i, t) in zip(got, order, strict=True):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert token_index.read_index(token_index.write_index(empty, encode.vocabulary_path(registry.BYTE_BPE), 2)).count() == 0


def test_separator_scan(spark, docs, texts, empty, tmp_path):
    got = token_scan.token_counts(docs, encode.vocabulary_path(registry.BYTE_BPE), registry.END_OF_TEXT, block_ids=97).collect()
    tok = encode.WordEncoder(encode.vocabulary_path(registry.BYTE_BPE)).tok
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    want = sorted(((i, len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in texts), key=key)
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=key) == want
    assert token_scan.token_counts(empty, encode.vocabulary_path(registry.BYTE_BPE), registry.END_OF_TEXT).count() == 0
    (tmp_path / "x.tok").write_bytes(np.array([5, 9, 9, 4, 4], "<u2").tobytes())
    (tmp_path / "y.tok").write_bytes(b"")
    paths = spark.createDataFrame([(f"file://{tmp_path}/{n}.tok",) for n in "xyx"], "path string")
    for block in (1, 2, 100):
        rows = token_scan.scan_separators(spark, paths, 9, block_ids=block).orderBy("ordinal").collect()
        assert [(r["ordinal"], r["start"], r["n_tokens"]) for r in rows] == [(0, 0, 1), (1, 2, 0), (2, 3, 2)]


def test_pieces_equal_library(texts, docs, empty):
    import sentencepiece

    path = encode.vocabulary_path(registry.PIECE_MODEL)
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    forth, back = pieces.compile_model(path)
    rng = random.Random(2)
    more = ["".join(rng.choice("abcdeé ▁  the漢字\n\t\x00ñüing🎉tion 012") for _ in range(rng.randrange(40))) for _ in range(300)]
    for t in [t for _, t in texts] + more:
        ids = forth.encode(t)
        assert ids == lib.encode(t or "") and back.decode(ids) == lib.decode(ids)
    got = pieces.encode(docs, path).collect()
    assert len(got) == len(texts) and all(r["round_trip"] for r in got)
    again = pieces.decode(pieces.encode(docs, path), path)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r[0], r[1]) for r in again.collect()), key=key) == sorted(((i, t or "") for i, t in texts), key=key)
    assert pieces.encode(empty, path).count() == 0


def test_unigram_shortest_path():
    rng = random.Random(3)
    table = {"a": -2.0, "b": -2.5, "ab": -3.0, "ba": -4.0, "aba": -4.2, "bb": -4.0}
    t = pieces.Transducer({p: (i, s) for i, (p, s) in enumerate(table.items())}, None, 99, "unigram", dummy_prefix=False)

    def best(s):
        if not s:
            return 0.0
        return min((best(s[k:]) - table[s[:k]] for k in range(1, 4) if s[:k] in table), default=math.inf)

    for _ in range(50):
        s = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 10)))
        path = t.path(s)
        assert "".join(path) == s and -sum(table[p] for p in path) == pytest.approx(best(s))
    assert t.encode("azb") == [0, 99, 1]


def grams(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_near_texts(docs, texts, empty, monkeypatch):
    monkeypatch.setattr(near_texts, "BLOCK", 7)
    monkeypatch.setattr(near_texts, "BUCKET_BLOCK", 9)
    got = near_texts.link(docs).collect()
    sets = [grams(t) for _, t in texts]
    like = lambda a, b: bool(a and b) and len(a & b) / len(a | b) >= 0.8
    want = sorted((i if i is not None else -1, sum(like(s, o) for j, o in enumerate(sets) if j != k)) for k, ((i, _), s) in enumerate(zip(texts, sets, strict=True)))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_links"]) for r in got) == want
    groups_of = {}
    for k, s in enumerate(sets):
        groups_of[k] = k
    for k, s in enumerate(sets):
        for j, o in enumerate(sets):
            if like(s, o):
                a, b = groups_of[k], groups_of[j]
                groups_of = {x: (a if y == b else y) for x, y in groups_of.items()}
    assert sum(r["kept"] for r in got) == len(set(groups_of.values()))
    left = near_texts.keep_one(docs)
    assert left.columns == docs.columns and left.count() == len(set(groups_of.values()))
    assert near_texts.link(empty).count() == 0


def test_bayes_rule():
    table = near_texts.least_matches(96, 16, 0.8, 1e-4)
    assert [k for k, _ in table] == list(range(16, 97, 16)) and all(a < b for (_, a), (_, b) in zip(table, table[1:], strict=False))
    same = np.tile(np.arange(96, dtype=np.uint8), (3, 1))
    same[2] += 100
    assert near_texts.survivors(same, 0, np.array([1, 2]), table).tolist() == [0]


def test_forest_of_edges():
    x = np.arange(20)
    edges = groups.spanning(20, x[:10], x[10:], lambda i, o: np.ones(len(o), bool))
    assert len(edges) == 19
    a, b = groups.stars([chr(97 + i) for i in range(20)], edges)
    assert set(a) == {"a"} and len(b) == 19


def brute_substrings(rows, window=50):
    first, out = {}, []
    words = [(i, t.encode().split() if t else []) for i, t in rows]
    for i, w in words:
        for s in range(len(w) - window + 1 if i is not None else 0):
            k = tuple(w[s : s + window])
            first[k] = min(first.get(k, i), i)
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[s : s + window])] < i:
                gone[s : s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((-1 if i is None else i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("split", [1, 16_000])
def test_substrings(docs, texts, empty, monkeypatch, split):
    monkeypatch.setattr(substrings, "SPLIT_SEGMENTS", split)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 2000)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.digest(docs).collect())
    want = brute_substrings(texts)
    assert got == want and sum(r[2] for r in want) > 1000
    if split == 1:
        cut = substrings.remove(docs)
        assert cut.columns == docs.columns and cut.count() == len(texts)
        assert substrings.digest(empty).count() == 0


def test_fm_index():
    rng = np.random.default_rng(1)
    for window in (1, 3, 6):
        segs = [rng.integers(0, 4, rng.integers(1, 40)).astype(np.uint64) for _ in range(40)]
        bounds, num = np.cumsum([0, *map(len, segs)]), rng.integers(0, 99, 40)
        f = fm_index.FMIndex(np.concatenate(segs), bounds, window)
        least, truth = f.least(num), {}
        for s, d in zip(segs, num, strict=True):
            for i in range(len(s) - window + 1):
                k = tuple(s[i : i + window])
                truth[k] = min(truth.get(k, 99), d)
        asked = [*segs, rng.integers(0, 5, 300).astype(np.uint64)]
        at = np.cumsum([0, *map(len, asked)])
        g = f.groups(np.concatenate(asked), at)
        for j, s in enumerate(asked):
            for i in range(len(s)):
                k = tuple(s[i : i + window]) if i + window <= len(s) else None
                assert (g[at[j] + i] >= 0) == (k in truth) and (k not in truth or least[g[at[j] + i]] == truth[k])
        assert f.count(np.array([9], np.uint64)) == 0


def test_decontaminate(spark, docs, empty):
    item = "Suddenly Tom Baker bought 3 kg of fresh apples and later that day Tom Baker sold 2 kg of them to Mary for 12 dollars"
    other = item.replace("Tom", "Ann").replace("3 kg", "5 kg").replace("12 dollars", "40 dollars")
    broken = item.replace("day Tom", "day Bob").replace("bought 3", "bought 9")
    rows = [(1, f"so it was {item} and more"), (2, f"well {other} and that was it"), (3, prose(random.Random(1), 60)), (4, None), (5, f"x {broken} y"), (None, item), (1, f"so it was {item} and more")]
    d = spark.createDataFrame([(i, t, "r", 1, 0.0) for i, t in rows], DOCS)
    b = spark.createDataFrame([(10, item, 0), (11, None, 0), (12, "too short", 0), (13, "seven words that make one short item", 0)], "item_id long, text string, row int")
    for limit in (10**6, 0):
        got = sorted((str(r["doc_id"]), r["item_id"], r["reworded"]) for r in decontaminate.find(d, b, limit).collect())
        assert got == [("1", 10, False), ("1", 10, False), ("2", 10, True), ("None", 10, False)]
    left = decontaminate.remove(d, b)
    assert left.columns == d.columns and sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5]
    assert decontaminate.find(empty, b).count() == 0 and decontaminate.find(docs, b.where("false")).count() == 0


def leaks(spark, pairs):
    """(index of the pair, n_covered, n_words, reworded) of the pairs (item, document) in which the document leaks the item."""
    d = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(pairs)], "doc_id long, text string")
    b = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(pairs)], "item_id long, text string")
    return [(r["doc_id"], r["n_covered"], r["n_words"], r["reworded"]) for r in decontaminate.find(d, b).where("doc_id = item_id").orderBy("doc_id").collect()]


def test_decontaminate_first_word(spark):
    short, longer = "What is the capital of France?", "Which river flows through the old city of Vienna and then on?"
    unit = "Minutes were taken at the last meeting"
    got = leaks(spark, [(short, f"Question: {short}"), (longer, f'Heading\n"{longer}"'), (short, f"What? {short}"), (unit, f"Question 7: {unit}"), ("Name of 3 red cars there", "Question: Name of 5 red cars there"), (short, "Question: Who is the capital of France?")])
    assert got == [(0, 6, 6, False), (1, 12, 12, False), (2, 6, 6, False), (3, 7, 7, False), (4, 6, 6, True)]


def test_decontaminate_many_slots(spark):
    primes, sums = "The first primes are 2 3 5 7 11 13 17 19 23 29 31 37", "Compute 12 + 7 * 3 - 4 + 9 when x is 5 and y is 6"
    got = leaks(spark, [(primes, f"So {primes} and so on"), (sums, f"Task: {sums}"), (primes, "So The first primes are 3 3 5 7 11 13 17 19 23 29 31 37"), (primes, "The first primes are 1 4 6 8 9 10 12 14 15 16 18 20")])
    assert got == [(0, 16, 16, False), (1, 14, 14, False), (2, 16, 16, True)]


def test_decontaminate_contradictions(spark):
    part = "Every morning old Tom Baker walks along the quiet river with 3 dogs and later he feeds the birds near the wooden bridge"
    rest = "before a friend of the family called Tom arrives by train with 3 parcels from the northern coast"
    other = rest.replace("Tom", "Bob").replace("3", "5")
    both = "Please work out how much fruit is eaten when children eat 2 apples for 2 days and nothing else"
    names = "Please work out how much fruit is eaten when Tom and Tom eat apples for days and nothing else"
    got = leaks(spark, [(f"{part} {rest}", f"so {part} {rest.replace('3', '5')}"), (f"{part} {rest}", f"so {part} {other}"), (both, both.replace("2 apples", "3 apples").replace("2 days", "4 days")), (names, names.replace("Tom and Tom", "Ann and Bob"))])
    assert [(i, reworded) for i, _, _, reworded in got] == [(0, True), (1, False), (2, True)]
    assert got[0][1] == got[0][2] and 23 <= got[1][1] and got[2][1] == 19


def test_decontaminate_names_of_any_length(spark):
    item = "Suddenly Tom Baker bought 3 kg of fresh apples and later that day Tom Baker sold 2 kg of them to Mary for 12 dollars"
    texts = [item, item.lower(), item.replace("Tom Baker", "Mary Jane Baker Smith"), item.replace("Tom Baker", "Tom").replace("Mary", "Mary Ann"), item.replace("3 kg", "three kilograms"), item.replace("day Tom Baker", "day Bob Jones").replace("Mary", "Tom Baker").replace("3", "9").replace("2", "4")]
    got = leaks(spark, [(item, f"{t} then") for t in texts])
    assert [(i, n >= 13, reworded) for i, n, _, reworded in got] == [(0, True, False), (1, True, False), (2, True, True), (3, True, True), (4, True, True)]
    token, value, _, bounds = decontaminate.templates(pa.array(["see Tom Baker go", "Tom Baker", "see Ann"]))
    first, joint, ends = decontaminate.folded(token, value, bounds)
    assert first.tolist() == [0, 1, 3, 4, 5, 6, 7] and ends.tolist() == [0, 3, 5, 7] and joint[0] == value[0] and joint[1] not in value.tolist() and joint[6] == value[7]


def test_quality(spark):
    d, lab = registry.table(spark, "/root/testdata/sf0.01", "documents"), registry.table(spark, "/root/testdata/sf0.01", "labels")
    got = quality.classify(d, lab).join(lab, "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.93 and got.score.between(0, 1).all()
    odd = spark.createDataFrame([(1, None, "r", 1, 0.0), (None, "", "r", 1, 0.0), (1, "x " * 60_000, "r", 1, 0.0)], DOCS)
    model = quality.fit(d, lab)
    assert quality.score(odd, model).count() == 3 and quality.score(odd.where("false"), model).count() == 0
    kept = quality.keep(d, lab)
    assert kept.columns == d.columns and kept.count() == quality.score(d, model).where("predicted = 1").count()
    none = lab.where("false")
    assert {r["score"] for r in quality.score(odd, quality.fit(d, none)).collect()} == {0.5}
    assert quality.fit(d, lab.where("quality = 1")).constant == 1.0


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 5)
    monkeypatch.setattr(near_vectors, "BUCKET_BLOCK", 6)
    rng = np.random.default_rng(4)
    base = rng.standard_normal((30, 16))
    v = [base[i % 6] + 0.08 * rng.standard_normal(16) if i < 40 else base[i % 30] for i in range(70)]
    rows = [(i, [float(x) for x in np.float32(x)], 1, "c") for i, x in enumerate(v)]
    rows += [(100, None, 1, "c"), (101, [0.0] * 16, 1, "c"), (102, [float("nan")] * 16, 1, "c"), (103, [None] * 16, 1, "c"), (104, [1.0, 2.0], 1, "c"), (105, [2.0, 4.0], 1, "c"), (None, rows[0][1], 1, "c"), (5, rows[5][1], 1, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int, class string")
    got = near_vectors.link(df)
    x = np.array([np.float32(r[1]) for r in rows[:70]], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = {i: int(n) for i, n in enumerate((x @ x.T >= 0.95).sum(1) - 1)} | {100: 0, 101: 0, 102: 0, 103: 0, 104: 1, 105: 1, None: 0}
    found = got.collect()
    assert len(found) == len(rows) and all(r["n_links"] == want[r["vec_id"]] for r in found)
    adj, comp = x @ x.T >= 0.95, list(range(70))
    for _ in range(70):
        comp = [min(comp[j] for j in np.flatnonzero(adj[i])) for i in range(70)]
    assert all(r["component_id"] == comp[r["vec_id"]] for r in found if r["vec_id"] is not None and r["vec_id"] < 70)
    assert near_vectors.link(df.where("false")).count() == 0


def test_warc(spark):
    long, same = "ä" * 40_000, "same page " * 150
    rows = [(1, "http://a/", same), (2, "http://b/", same), (3, None, "short"), (4, "http://d/ x", "short"), (5, "http://e/", None), (6, "http://f/", long), (7, "http://g/", long), (None, "http://h/", same), (2, "http://b/", same)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, kind int")
    got = warc.read_archives(spark, warc.write_archives(pages)).collect()
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        to = {same: 2, long: 7}.get(h)
        revisit = to is not None and i != to
        want.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None, None))
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["error"]) for r in got) == sorted(want, key=lambda x: x[:4])
    assert warc.read_archives(spark, warc.write_archives(pages.where("false"))).count() == 0


def test_warc_faults(spark):
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"x" * 9000, 1000)
    part = lambda o, n, b, t=None: ("<o>" if n == 1 else f"<{n}>", "response" if n == 1 else "continuation", None if n == 1 else o, n, t, None, 1, None, "u", b, None)
    whole = [part("<o>", 1, block[:4000]), part("<o>", 2, block[4000:8000]), part("<o>", 3, block[8000:], len(block))]
    cases = {None: whole[::-1], "missing": [whole[0], whole[2]], "bytes, not": [*whole[:2], part("<o>", 3, block[8000:], 5)], "twice": [*whole, part("<o>", 2, b"other")], "origin": whole[1:]}
    for why, rows in cases.items():
        r = warc.reassemble(spark.createDataFrame(rows, warc.RECORDS)).collect()
        assert len(r) == 1 and ((r[0]["error"] is None and r[0]["payload"] == b"x" * 9000) if why is None else (r[0]["payload"] is None and (why in r[0]["error"] or why == "origin")))
    assert warc.dechunk(b"3;a=b\r\nabc\r\n0\r\nT: v\r\n\r\n") == b"abc"
    for bad in (b"3", b"5\r\nabc\r\n0\r\n\r\n", b"z\r\n"):
        with pytest.raises(ValueError):
            warc.dechunk(bad)


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("https://Blog.X.Example.ORG/es/1?q=/", "blog.x.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/19#a", "example.org", "/en/19", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
        ("http://a.com/fr/", "a.com", "/fr/", "com/fr/", "allow"),
        ("http://a.com/de/x", "a.com", "/de/x", "com/de/", "block"),
        ("http://a.org?x", "a.org", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://x.net/a?u=http://y.org/", "x.net", "/a", None, "allow"),
    ],
)
def test_url_rules(spark, url, host, path, rule, verdict):
    h, p = url_filter.host_and_path(F.col("url"))
    r = spark.createDataFrame([(url,)], "url string").select(h.alias("h"), p.alias("p")).select("h", "p", url_filter.rule_of(F.col("h"), F.col("p"), url_filter.RULES).alias("r")).first()
    assert (r["h"], r["p"]) == (host, path) and (r["r"]["rule"] if r["r"] else None) == rule and (r["r"]["verdict"] if r["r"] else "allow") == verdict


def test_url_templates(spark):
    urls = [(i, f"http://s.net/spam/{i}.html", 1) for i in range(60)] + [(100 + i, f"http://s.net/news/{i}", 0) for i in range(60)] + [(200 + i, f"http://s.net/u/user-{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}", 0) for i in range(60)]
    urls += [(900, None, None), (900, None, None), (None, "http://s.net/spam/x", None), (901, "://", None)]
    pages = spark.createDataFrame([(i, u, "h", "t") for i, u, _ in urls], "page_id long, url string, host string, template string")
    labelled = spark.createDataFrame([(u, bool(b)) for _, u, b in urls if b is not None], "url string, bad boolean")
    got = {r["page_id"]: r for r in url_filter.judge(pages, labelled, ()).collect() if r["page_id"] is not None}
    assert got[5]["verdict"] == "block" and got[5]["template"] == "/spam/{n}.html" and got[105]["verdict"] == "allow" and got[205]["template"] == "/u/*"
    assert url_filter.judge(pages, labelled, ()).count() == len(urls) and url_filter.judge(pages.where("false"), labelled).count() == 0
    assert len(url_filter.merge_similar([("a", 50, 25), ("b", 50, 26), ("c", 50, 1)])) == 2


def test_url_slugs_with_numbers(spark):
    spam = [(i, f"http://s.net/spam/{10000 + i}-title-{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}", 1 if i % 2 else None) for i in range(60)]
    news = [(100 + i, f"http://s.net/news/{i}{'.html' if i < 3 else ''}", 0) for i in range(120)]
    pages = spark.createDataFrame([(i, u) for i, u, _ in spam + news], "page_id long, url string")
    labelled = spark.createDataFrame([(u, bool(b)) for _, u, b in spam + news if b is not None], "url string, bad boolean")
    got = {r["page_id"]: (r["verdict"], r["template"]) for r in url_filter.judge(pages, labelled, ()).collect()}
    assert {got[i] for i, _, _ in spam} == {("block", "/spam/*")} and {got[i] for i, _, _ in news} == {("allow", "/news/{n}"), ("allow", "/news/{n}.html")}


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    n = registry.table(spark, SF, "documents").count()
    assert 0 < out.count() < n and out.select("doc_id").distinct().count() == out.count()
    assert len(corpus_pipeline.STAGES) == 5


def test_registry_runs(spark):
    want = {"op1_url_filter": "pages", "op2_decontaminate": None, "op3_token_counts": "documents", "op4_near_texts": "documents", "op5_quality": "documents", "op6_warc": "pages", "op7_substrings": "documents", "op8_pieces": "documents", "op9_token_index": "documents", "op10_near_vectors": "embeddings"}
    assert set(registry.QUERIES) == set(want)
    for name in ("op6_warc", "op9_token_index", "op10_near_vectors"):
        assert registry.QUERIES[name](spark, SF).count() == registry.table(spark, SF, want[name]).count()


def test_batch_hashes_match_split():
    from concordat.llm.words import batch_hashes, rolled, word_hashes

    odd = [None, "", " a  b\x0b\x0cc\r\nd ", "x y \x1c z", "é漢 🎉"]
    h, at = batch_hashes(pa.array(odd, pa.string()))
    for i, t in enumerate(odd):
        assert h[at[i] : at[i + 1]].tolist() == word_hashes(t).tolist()
    one = np.arange(30, dtype=np.uint64)
    two = np.concatenate((np.array([77], np.uint64), one))
    for k in (1, 2, 5, 8, 13):
        assert (rolled(one, k) == rolled(two, k)[1:]).all() and len(set(rolled(one, k).tolist())) == 31 - k


def test_keyed_join(spark):
    rows = [(1 if i % 3 else i, i, f"r{i}") for i in range(3000)] + [(None, 5000, "null")]
    df = spark.createDataFrame(rows, "h long, i int, row string").repartition(5)
    facts = spark.createDataFrame([(k, k * 10) for k in range(0, 3000, 2)] + [(1, 10)], "h long, f long")
    known = {h: f for h, f in facts.collect()}
    for how in ("inner", "left"):
        got = joins.keyed_join(df, facts, ["h"], "row", how)
        assert got.columns == ["h", "i", "row", "f"]
        want = sorted((i, known.get(h)) for h, i, _ in rows if how == "left" or h in known)
        assert sorted((r.i, r.f) for r in got.collect()) == want
    assert "__salt" in joins.keyed_join(df, facts, ["h"], "row")._jdf.queryExecution().optimizedPlan().toString()
    assert joins.keyed_join(df.limit(0), facts, ["h"], "row").count() == 0


def brute_tree(rows):
    """(template, purity) of each (path, labels, bad) of one host, by recursion over plain lists."""
    w, z = url_filter.PRIOR_WEIGHT, url_filter.SIMILAR_Z
    labels, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    overall = (bad + 1) / (labels + 2)
    out = {}

    def gap(x, y):
        p = (x[1] + y[1] + 1) / (x[0] + y[0] + 2)
        return abs(x[1] / x[0] - y[1] / y[0]) / math.sqrt(p * (1 - p) * (1 / x[0] + 1 / y[0]))

    def grow(members, depth, rate):
        """members: (segments, template so far, labels, bad, n) of one branch."""
        kids = {}
        for segs, own, k, b, n in members:
            if len(segs) > depth:
                kids.setdefault(segs[depth], []).append((segs, own, k, b, n))
            else:
                out["/".join(segs)] = (own, rate)
        total, crowded = sum(m[4] for ms in kids.values() for m in ms), len(kids) > url_filter.FAN_OUT
        folded = {}
        for seg, ms in kids.items():
            wild = seg in ("{n}", "{date}", "{id}")
            name = "*" if crowded and not wild and sum(m[4] for m in ms) < url_filter.FREQUENT * total else seg
            folded.setdefault(name, []).extend((segs, f"{own}/{name}", k, b, n) for segs, own, k, b, n in ms)
        sums = {name: (sum(m[2] for m in ms), sum(m[3] for m in ms)) for name, ms in folded.items()}
        groups = [[[name], *sums[name]] for name in sorted((n for n in sums if sums[n][0]), key=lambda n: ((sums[n][1] + 1) / (sums[n][0] + 2), n))]
        while len(groups) > 1:
            gaps = [gap(a[1:], b[1:]) for a, b in zip(groups, groups[1:], strict=False)]
            i = gaps.index(min(gaps))
            if gaps[i] >= z:
                break
            groups[i : i + 2] = [[groups[i][0] + groups[i + 1][0], groups[i][1] + groups[i + 1][1], groups[i][2] + groups[i + 1][2]]]
        for names, k, b in groups + [[[n], 0, 0] for n in sums if not sums[n][0]]:
            grow([m for n in names for m in folded[n]], depth + 1, (b + w * rate) / (k + w))

    grow([(segs, "", k, b, n) for segs, k, b, n in rows], 0, (bad + w * overall) / (labels + w))
    return out


def test_url_tree_brute_force(spark):
    rng = random.Random(11)
    words = ["news", "spam", "shop", "blog", "wiki", "promo"]
    urls = []
    for i in range(600):
        segs = [rng.choice(words[:3])] + [rng.choice([rng.choice(words), str(rng.randrange(99)), f"slug-{rng.choice('abcdefghijklmnopqrstuvwxyz')}-{rng.choice('abcdefgh')}", f"{rng.randrange(10**4)}-t{rng.randrange(10**4)}"]) for _ in range(rng.randrange(3))]
        urls.append((i, "/" + "/".join(segs), rng.random() < 0.6, rng.random() < (0.9 if "spam" in segs or "promo" in segs else 0.1)))
    pages = spark.createDataFrame([(i, f"http://h.net{p}") for i, p, _, _ in urls], "page_id long, url string")
    labelled = spark.createDataFrame([(f"http://h.net{p}", b) for _, p, known, b in urls if known], "url string, bad boolean")
    got = {r["page_id"]: (r["template"], r["purity"], r["verdict"]) for r in url_filter.judge(pages, labelled, ()).collect()}
    shapes = {r["page_id"]: r["s"] for r in pages.select("page_id", url_filter.typed(url_filter.host_and_path(F.col("url"))[1]).alias("s")).collect()}
    rows = {}
    for i, _, known, b in urls:
        at = rows.setdefault(tuple(shapes[i]), [0, 0, 0])
        at[0], at[1], at[2] = at[0] + known, at[1] + (known and b), at[2] + 1
    want = brute_tree([(k, *v) for k, v in rows.items()])
    for i, *_ in urls:
        template, rate = want["/".join(shapes[i])]
        assert got[i][0] == template and got[i][1] == pytest.approx(rate) and got[i][2] == ("block" if rate >= url_filter.REJECT_PURITY else "allow")
    assert len({v[2] for v in got.values()}) == 2 and any("*" in v[0] for v in got.values())


def test_url_many_siblings(spark):
    rows = spark.range(10_000).selectExpr("id as page_id", "concat('http://s.net/spam/', id, '-title-', hex(id), '.x') as url")
    labelled = rows.where("page_id % 7 = 0").selectExpr("url", "true as bad").unionByName(spark.createDataFrame([("http://s.net/ok/1", False)] * 400, "url string, bad boolean"))
    got = url_filter.judge(rows, labelled, ()).groupBy("template", "verdict").count().collect()
    # Titles of digits alone are frequent enough for a template of their own; thousands of others are one.
    assert {(r["template"], r["verdict"]) for r in got} == {("/spam/*", "block"), ("/spam/{n}-title-{n}.x", "block")} and sum(r["count"] for r in got) == 10_000
    nulls = spark.createDataFrame([(None, None, None, None), ("h", None, 1, None), ("h", "/a", None, 1)], "host string, path string, n int, bad int")
    assert {r["shape"] for r in url_filter.fit(nulls).collect()} == {"", "a"}


def test_components_of_a_hub(spark):
    from concordat.operators.components import connected_components

    edges = spark.range(1, 3000).selectExpr("0L as a", "id as b").unionByName(spark.range(5000, 5050).selectExpr("id as a", "id + 1 as b"))
    got = connected_components(edges).groupBy("component").count().collect()
    assert sorted((r["component"], r["count"]) for r in got) == [(0, 3000), (5000, 51)]


def test_warc_common_payload(spark):
    """One payload on most pages, empty ones on the rest: both are keys that hold a large part of all rows."""
    body = "x" * 2000
    pages = spark.range(3000).selectExpr("id as page_id", "concat('http://a/', id) as url", f"if(id % 3 < 2, '{body}', null) as html").repartition(7)
    got = warc.read_archives(spark, warc.write_archives(pages)).groupBy("record_type", "refers_to", "payload_bytes", "error").count().collect()
    assert sorted((tuple(r) for r in got), key=str) == [("response", None, 0, None, 1000), ("response", None, 2000, None, 1), ("revisit", 2998, 2000, None, 1999)]


@pytest.mark.parametrize("text", ["a" * 1_000_000, "word " * 200_000, " " * 50_000, "ab\n" * 100_000])
def test_very_long_texts(spark, text):
    import sentencepiece

    df = spark.createDataFrame([(1, text), (2, "short one")], "doc_id long, text string")
    tok = encode.WordEncoder(encode.vocabulary_path(registry.BYTE_BPE)).tok
    index = {r["doc_id"]: r["n_tokens"] for r in token_index.read_index(token_index.write_index(df, encode.vocabulary_path(registry.BYTE_BPE), 2)).collect()}
    assert index[1] == len(tok.encode(text, add_special_tokens=False).ids) + 1 and index[2] > 1
    if text[:2] != "aa":  # a word is one path, whose merges the library looks at differently
        got = {r["doc_id"]: (r["n_tokens"], r["round_trip"]) for r in pieces.encode(df, encode.vocabulary_path(registry.PIECE_MODEL)).collect()}
        lib = sentencepiece.SentencePieceProcessor(model_file=encode.vocabulary_path(registry.PIECE_MODEL))
        assert got[1] == (len(lib.encode(text)), True)
    kept = near_texts.keep_one(df)
    assert kept.count() == 2 and substrings.digest(df).count() == 2


def test_slices_of_bytes():
    from concordat.llm import memory

    texts = ["abc", None, "", "x" * 50, "é" * 4, "z"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["i", "t"])
    for part in (batch, batch.slice(1, 4)):
        got = list(memory.slices(iter([part]), 1, 10))
        assert sum((g.column(1).to_pylist() for g in got), []) == part.column(1).to_pylist()
        assert all(sum(len((t or "").encode()) for t in g.column(1).to_pylist()) <= 10 or g.num_rows == 1 for g in got)
    assert [g.num_rows for g in memory.slices(iter([batch.slice(0, 0)]), 1, 10)] == [0]
    assert memory.kept(("a",), list) is memory.kept(("a",), list) and memory.kept(("b",), dict) == {} and len(memory._kept) == 1


def test_quality_sample(spark):
    """Whole texts, one of each id, up to the bounds; ties and repeated ids give the same sample again."""
    rows = [(i, f"text number {i} " * 50) for i in range(40)] + [(3, "another text of three"), (None, "no id"), (5, None), (6, "")]
    d = spark.createDataFrame([(i, t, "r", 1, 0.0) for i, t in rows], DOCS)
    lab = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(7, 0), (8, None)], "doc_id long, quality int")
    by, counts = quality.sample(d, lab)
    allowed = {i for i in range(40) if zlib.crc32(str(i).encode()) % 5 and i != 7}
    assert counts == {q: len([i for i in allowed if i % 2 == q]) for q in (0, 1)}
    assert len(by[0]) + len(by[1]) == len(allowed) and all(t in {t for _, t in rows} for ts in by for t in ts)
    assert quality.sample(d.repartition(3), lab)[0] == by and len(quality.sample(d, lab, per_class=4)[0][1]) == 4
    assert all(sum(map(len, ts)) <= 3000 for ts in quality.sample(d, lab, most_bytes=3000)[0])
    few = quality.fit(d.where("doc_id in (0, 1, 2, 9, 10)"), lab)
    assert few.constant is None and quality.score(d, few).count() == len(rows)
    kept = quality.keep(spark.createDataFrame([(1, None, "r", 1, 0.0), (1, None, "r", 1, 0.0), (2, "", "r", 1, 0.0)], DOCS), lab)
    assert kept.count() in (0, 3)


def test_pipeline_edges(spark, tmp_path):
    """Null, empty and repeated rows, an empty table and an extra column pass all stages."""
    import corpus_pipeline

    rows = [(i, prose(random.Random(i), 60)) for i in range(30)] + [(1, prose(random.Random(1), 60)), (40, None), (41, ""), (None, "no id at all but some words"), (42, "w " * 3000)]
    for name, some in (("some", rows), ("none", [])):
        spark.createDataFrame([(i, t, "r", 1, 0.0) for i, t in some], DOCS).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        spark.createDataFrame([(1, prose(random.Random(2), 60))], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        docs = registry.table(spark, f"{tmp_path}/{name}", "documents")
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, f"{tmp_path}/{name}")
            assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
            out.write.parquet(f"{tmp_path}/{name}/{k}")
            docs = spark.read.parquet(f"{tmp_path}/{name}/{k}")
        assert docs.count() <= len(some) and (docs.count() > 0) == bool(some)
