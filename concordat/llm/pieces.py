"""SentencePiece encoding and decoding by a weighted finite-state transducer.

The transducer is compiled from the normaliser (a space becomes a mark), the
pieces as a trie whose ends emit an id and lead back to its root, and byte
fallback for characters that no piece has. The normaliser is composed into the
trie: its arcs read a text as it is. A text, with the dummy prefix before it,
is a linear acceptor; composed with the transducer it is a lattice, and its
encoding is the shortest path in the tropical semiring (weights add along a
path, the least path wins).

For a unigram model an arc weighs the negated score of its piece. A BPE model
has no such weights: there a state also remembers the last piece, and an arc
weighs 0 if the merges would leave that pair of pieces apart, and infinity if
not. A sequence of pieces is what the merges make of a text exactly if each
two neighbours stay apart, so the one path of finite weight is the encoding;
and since that holds for each prefix, one state a position has a finite
weight. Weights of pairs are compiled as they are met, and kept.

No piece has a space mark after another character, so paths of the words
between marks may be taken apart and kept; a model in which that is not so is
not cut.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.encode import Words
from concordat.llm.memory import kept, sliced
from concordat.storage import bounded_batches, ship

MARK = "▁"
SPACES = re.compile(f"[ {MARK}]+[^ {MARK}]*|[^ {MARK}]+")
KEPT_WORDS = 1_000_000
KEPT_BYTES = 32_000_000
KEPT_PAIRS = 400_000
UNKNOWN_COST = 1e4
INFINITE = float("inf")


def merges(text: str, rank: dict[str, float]) -> list[str]:
    """The pieces that BPE makes of a text: the best-scored pair merges first, the leftmost among equals."""
    parts = list(text)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            s = rank.get(parts[i] + parts[i + 1])
            if s is not None and (best is None or s > best):
                best, at = s, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Compiled from pieces: (text, score) of those that text can become, with their ids.

    ``arcs`` holds the trie's arcs by character, with the normaliser composed
    in; ``ends`` the piece that a node ends, which emits its id and leads back
    to the root.
    """

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int] | None, unknown_id: int, kind: str, dummy_prefix: bool = True):
        if kind not in ("bpe", "unigram"):
            raise ValueError(kind)
        self.kind, self.unknown_id, self.byte_ids, self.dummy_prefix = kind, unknown_id, byte_ids, dummy_prefix
        self.ids = {p: i for p, (i, _) in pieces.items()}
        self.score = {p: s for p, (_, s) in pieces.items()}
        self.cuts = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.pairs: dict[str, dict[str, float]] = {}
        self.n_pairs = 0
        self.least = 0.0 if kind == "bpe" else min([-s for s in self.score.values()], default=0.0)
        # Of a BPE model, pieces that the merges of their own text don't end in are never emitted.
        self._compile([p for p in pieces if kind == "unigram" or len(p) == 1 or merges(p, self.score) == [p]])

    def _compile(self, pieces: list[str]) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        for p in pieces:
            at = 0
            for c in p:
                if c not in self.arcs[at]:
                    self.arcs[at][c] = len(self.arcs)
                    self.arcs.append({})
                    self.ends.append(None)
                at = self.arcs[at][c]
            self.ends[at] = p
        for out in self.arcs:  # the normaliser's arc, composed with those that read its output
            if MARK in out:
                out[" "] = out[MARK]

    def weight(self, last: str, piece: str) -> float:
        """Of the arc that emits ``piece`` after ``last`` (empty: at the start)."""
        if self.kind == "unigram":
            return -self.score[piece] if piece in self.score else UNKNOWN_COST
        if not last:
            return 0.0
        after = self.pairs.setdefault(last, {})
        w = after.get(piece)
        if w is None:
            w = after[piece] = 0.0 if merges(last + piece, self.score) == [last, piece] else INFINITE
            self.n_pairs += 1
        return w

    def path(self, text: str) -> list[str]:
        """The shortest path through the lattice of ``text``: its pieces, or single characters for fallback."""
        if self.n_pairs > KEPT_PAIRS:
            self.pairs, self.n_pairs = {}, 0
        n = len(text)
        cost, last = [0.0] + [INFINITE] * n, [""] * (n + 1)
        arcs, ends, weight, single, least = self.arcs, self.ends, self.weight, self.score, self.least
        for i in range(n):
            d = cost[i]
            if d == INFINITE:
                continue
            a, at, j = last[i], arcs[0], i
            bound = d + least  # no arc from here weighs less
            for c in text[i:] if i else text:
                at = at.get(c)
                if at is None:
                    break
                j += 1
                if bound < cost[j]:
                    piece = ends[at]
                    if piece is not None:
                        w = d + weight(a, piece)
                        if w < cost[j]:
                            cost[j], last[j] = w, piece
                at = arcs[at]
            c = MARK if text[i] == " " else text[i]
            if c not in single and bound < cost[i + 1]:  # fallback
                w = d + weight(a, c)
                if w < cost[i + 1]:
                    cost[i + 1], last[i + 1] = w, c
        out, j = [], n
        while j:
            out.append(last[j])
            j -= len(last[j])
        return out[::-1]

    def emit(self, path: list[str]) -> list[int]:
        out: list[int] = []
        for p in path:
            if p in self.ids:
                out.append(self.ids[p])
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in p.encode()]
            else:
                out.append(self.unknown_id)
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; null counts as empty, which has none."""
        text = f" {text}" if text and self.dummy_prefix else text or ""
        return self.emit(chain.from_iterable(map(self.path, SPACES.findall(text) if self.cuts else [text])))


class PieceEncoder(Words):
    """The transducer over batches of texts, whose distinct words it meets once.

    A text is cut at its spaces, each word with the space before it. Texts with
    runs of spaces or marks of their own are encoded whole.
    """

    odd_words = f"^$|{MARK}"

    def __init__(self, made: Transducer, cache_words: int = KEPT_WORDS, cache_bytes: int = KEPT_BYTES):
        self.made = made
        if not (made.cuts and made.dummy_prefix):
            self.odd_words = "^"
        super().__init__(np.uint32, cache_words, cache_bytes)

    def _whole(self, texts: list[str]) -> list:
        return [self.made.encode(t) for t in texts]

    def _fresh(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = [self.made.emit(self.made.path(f" {w}")) for w in words.to_pylist()]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))


class Decoder:
    """Ids back to text: the inverse of the transducer, and of its normaliser."""

    def __init__(self, surface: list[bytes], dummy_prefix: bool = True):
        self.surface, self.dummy_prefix = surface, dummy_prefix

    def decode(self, ids) -> str:
        data = b"".join(map(self.surface.__getitem__, ids))
        if self.dummy_prefix and data.startswith(b" "):
            data = data[1:]
        return data.decode("utf-8", "replace")


def compile_model(path: str) -> tuple[Transducer, Decoder]:
    """Transducer and decoder of a SentencePiece model file with the identity normaliser."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    spec, trained = proto.normalizer_spec, proto.trainer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or trained.treat_whitespace_as_suffix:
        raise ValueError("only identity normalisation with space marks is compiled")
    kinds = pb.ModelProto.SentencePiece
    pieces, surface, byte_ids, unknown = {}, [], [0] * 256, 0
    for i, p in enumerate(proto.pieces):
        if p.type in (kinds.NORMAL, kinds.USER_DEFINED):
            if p.type == kinds.USER_DEFINED:
                raise ValueError("user-defined pieces are not compiled")
            pieces[p.piece] = (i, p.score)
            surface.append(p.piece.replace(MARK, " ").encode())
        elif p.type == kinds.BYTE:
            b = int(p.piece[3:5], 16)
            byte_ids[b] = i
            surface.append(bytes([b]))
        else:
            unknown = i if p.type == kinds.UNKNOWN else unknown
            surface.append(trained.unk_surface.encode() if p.type == kinds.UNKNOWN else b"")
    kind = {1: "unigram", 2: "bpe"}[trained.model_type]
    made = Transducer(pieces, byte_ids if trained.byte_fallback else None, unknown, kind, spec.add_dummy_prefix)
    return made, Decoder(surface, spec.add_dummy_prefix)


def compiled(path: str) -> tuple[PieceEncoder, Decoder]:
    """One for each worker process."""

    def make():
        forth, back = compile_model(path)
        return PieceEncoder(forth), back

    return kept(("pieces", path), make)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, decoded_sha256, round_trip, ids) of every row of ``docs``.

    ``ids_crc32`` is of the ids as little-endian unsigned 32-bit integers;
    ``round_trip`` says whether decoding gives the text again (a null text
    counts as empty; a text with a space mark of its own does not come back).
    Rows with null or repeated ids are encoded like any other; other columns
    are not read.
    """
    import hashlib

    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)

    def run(batches):
        forth, back = compiled(model)
        for batch in batches:
            ids, counts = forth.encode(batch.column(1))
            ids, ends = ids.astype("<i4"), np.cumsum(counts)
            rows = []
            for t, a, b in zip(batch.column(1), (ends - counts).tolist(), ends.tolist(), strict=True):
                text = back.decode(ids[a:b].tolist())
                rows.append((b - a, zlib.crc32(ids[a:b].tobytes()), hashlib.sha256(text.encode()).hexdigest(), text == (t.as_py() or "")))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 4, kinds, strict=True)), lists], names=["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "round_trip", "ids"])

    plain = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return plain.mapInArrow(sliced(1, run), "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of rows with (doc_id, ids); null ids give a null text."""
    spark = encoded.sparkSession
    ship(spark)
    bounded_batches(spark)

    def run(batches):
        _, back = compiled(model)
        for batch in batches:
            texts = [None if ids is None else back.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
