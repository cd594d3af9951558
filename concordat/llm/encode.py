"""Byte-level BPE encoding that sends each distinct piece of text to the library once.

The pre-tokenizer never joins what lies on both sides of a single space
between two non-space characters, nor a run of letters with what follows it, so
a text may be cut there, each piece (with the space before it) encoded on its
own and the ids concatenated. Arrow finds the distinct pieces of a batch, numpy
puts their ids together again. Texts with other runs of white space go to the
library whole.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from concordat.llm.memory import kept, offsets_of

CACHE_WORDS = 400_000
CACHE_BYTES = 16_000_000
ENCODE_BYTES = 2 << 20
STRING_WORDS = 64

LETTER, DIGIT, SIGN, SPACE, BREAK, WIDE, ODD = range(7)


def _byte_kinds() -> np.ndarray:
    """What a byte is by itself. Lead bytes 0xC3 to 0xC9 stand for U+00C0 to
    U+027F: letters all but two, in whatever version of Unicode."""
    out = np.full(256, ODD, dtype=np.uint8)
    out[33:127] = SIGN
    out[[c for c in range(128) if chr(c).isalpha()]] = LETTER
    out[48:58] = DIGIT
    out[[ord(c) for c in "\t\n\r"]] = BREAK
    out[ord("'")] = ODD
    out[32] = SPACE
    out[0xC3:0xCA] = WIDE
    return out


def _byte_characters() -> np.ndarray:
    """The character that byte-level vocabularies write for each byte."""
    shown = np.zeros(256, dtype=bool)
    shown[33:127] = shown[161:173] = shown[174:] = True
    out = np.arange(256, dtype="<u4")
    out[~shown] = 256 + np.arange(256 - shown.sum())
    return out


KINDS, DRAWN = _byte_kinds(), _byte_characters()


def _changes(kind: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each byte but the first."""
    return (kind[1:] != kind[:-1]) & (kind[:-1] != SPACE)


def _places(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other; far fewer than 2**31."""
    ends = np.cumsum(size, dtype=np.int32)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin.astype(np.int32) - (ends - size.astype(np.int32)), size) + np.arange(total, dtype=np.int32)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_lengths(tok) -> np.ndarray:
    """Bytes that each id stands for: a byte-level piece has one character a byte."""
    out = np.zeros(tok.get_vocab_size(), dtype=np.int64)
    for piece, i in tok.get_vocab().items():
        out[i] = len(piece)
    for i, added in tok.get_added_tokens_decoder().items():
        out[i] = len(added.content.encode())
    return out


class Words:
    """Ids of the words met so far, each worked out once; a base for encoders that cut texts at spaces.

    A subclass says what the ids of fresh words (meant with a space before
    them) and of whole texts are, and which words forbid a text to be cut.
    Known words are numbered by their place in an Arrow array, so they take
    little more than their bytes; their ids lie in one growing array. Beyond
    ``cache_words`` words or ``cache_bytes`` bytes it all starts anew, so memory
    is bounded.
    """

    odd_words: str
    known_type = pa.large_string()

    def __init__(self, kind, cache_words: int, cache_bytes: int):
        self.kind, self.cache_words, self.cache_bytes = kind, cache_words, cache_bytes
        self._reset()

    def _reset(self) -> None:
        self.known = pa.array([], self.known_type)
        self.flat = np.zeros(1 << 16, dtype=self.kind)
        self.begin = np.zeros(1 << 14, dtype=np.int64)
        self.used = 0

    def _whole(self, texts: list[str]) -> list:
        raise NotImplementedError

    def _fresh(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and where each word's end."""
        raise NotImplementedError

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each of these distinct words."""
        if len(self.known) > self.cache_words or self.known.nbytes > self.cache_bytes:
            self._reset()
        found = pc.index_in(words, value_set=self.known)
        if not found.null_count:
            return found.to_numpy().astype(np.int64)
        todo = np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))
        out = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        fresh = words.take(pa.array(todo))
        ids, ends = self._fresh(fresh)
        first, total = len(self.known), self.used + len(ids)
        if total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(total, self.flat.dtype)))
        if first + len(fresh) + 1 > len(self.begin):
            self.begin = np.concatenate((self.begin, np.zeros(first + len(fresh), np.int64)))
        self.flat[self.used : total] = ids
        self.begin[first + 1 : first + len(fresh) + 1] = self.used + ends
        self.used = total
        self.known = pa.concat_arrays([self.known, fresh])
        out[todo] = np.arange(first, first + len(fresh))
        return out

    def encode(self, texts: list[str | None] | pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids as one uint32 array, and the number of ids of each text."""
        n = len(texts)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()), "")
        split = pc.split_pattern(texts, " ")
        offsets = np.asarray(split.offsets).astype(np.int64)
        offsets -= offsets[0]
        coded = split.flatten().dictionary_encode()
        codes, values = np.asarray(coded.indices), coded.dictionary
        odd = np.asarray(pc.match_substring_regex(values, self.odd_words).to_numpy(zero_copy_only=False), dtype=bool)
        counts = np.diff(offsets)
        whole = np.zeros(n, dtype=bool)
        if odd.any():
            whole = np.add.reduceat(odd[codes].astype(np.int64), offsets[:-1]) > 0
        # A text's first word has no space before it; a text with other white space counts as one word.
        leads = values.take(pa.array(codes[offsets[:-1]])).to_pylist()
        alone = self._whole([texts[i].as_py() if whole[i] else w for i, w in enumerate(leads)])
        if not whole.any():
            used = np.arange(len(values))
        else:
            seen = np.zeros(len(values), dtype=bool)
            seen[codes[np.repeat(~whole, counts)]] = True
            used = np.flatnonzero(seen)
        numbers = np.zeros(len(values), dtype=np.int64)
        numbers[used] = self._numbers(values if len(used) == len(values) else values.take(pa.array(used)))
        begin, size = self.begin[numbers].astype(np.int32), np.zeros(len(values), dtype=np.int32)
        size[used] = self.begin[numbers[used] + 1] - begin[used]
        each = size[codes]
        each[np.repeat(whole, counts)] = 0
        each[offsets[:-1]] = 0
        rest = np.add.reduceat(each, offsets[:-1], dtype=np.int64)
        lead = np.fromiter(map(len, alone), np.int64, n)
        tail = int(end_id is not None)
        lengths = lead + rest + tail
        start = np.cumsum(lengths) - lengths
        out = np.empty(int(lengths.sum()), dtype=np.uint32)
        total = int(rest.sum())
        # A slice holds far fewer than 2**31 ids.
        inner = np.arange(total, dtype=np.int32)
        source = np.repeat(begin[codes] - (np.cumsum(each, dtype=np.int32) - each), each) + inner
        body = np.repeat((start + lead - (np.cumsum(rest) - rest)).astype(np.int32), rest) + inner
        out[body] = self.flat[source]
        heads = np.fromiter(chain.from_iterable(alone), np.uint32, int(lead.sum()))
        out[np.arange(len(heads)) + np.repeat(start - (np.cumsum(lead) - lead), lead)] = heads
        if tail:
            out[start + lengths - 1] = end_id
        return out, lengths


class WordEncoder(Words):
    """Encodes texts with a ``tokenizers`` file; text that looks like a special
    token is ordinary text unless ``specials`` is set, which gives it the
    token's id as the library does by itself. Null counts as empty; an empty text has no ids.

    Texts are cut into pieces, each with the space before it: words, and words
    at the ends of their runs of letters, digits, signs and line breaks, where
    GPT-2's pattern cuts too. Such a run is one piece to the library's model,
    which gets it as the pattern would hand it over. Words that hold anything
    else (an apostrophe, other characters, an added token) are pieces as they
    stand, and the library cuts them.
    """

    odd_texts = r"^W|W$|W | W".replace("W", r"[\s\x0b\x1c-\x1f\x{85}\pZ]")
    known_type = pa.large_binary()

    def __init__(self, path: str, cache_words: int = CACHE_WORDS, cache_bytes: int = CACHE_BYTES, specials: bool = False):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not specials
        added = self.tok.get_added_tokens_decoder().values()
        if any(" " in t.content or t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("an added token reaches over spaces, where texts are cut")
        self.added = [t.content.encode() for t in added if t.content and (specials or not t.special)]
        before = self.tok.pre_tokenizer
        self.kinds = KINDS
        if not (isinstance(self.tok.model, models.BPE) and isinstance(before, pre_tokenizers.ByteLevel) and before.use_regex and not before.add_prefix_space and self.tok.normalizer is None):
            self.kinds = np.where(KINDS == SPACE, KINDS, np.uint8(ODD))
        self.runs = Tokenizer(self.tok.model)
        self.runs.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.width = _byte_lengths(self.tok)
        super().__init__(np.uint16 if len(self.width) <= 1 << 16 else np.uint32, cache_words, cache_bytes)

    def _whole(self, texts: list[str]) -> list:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _kinds(self, data: np.ndarray) -> np.ndarray:
        """What each byte is; ``ODD`` in words that only the library may cut."""
        kind = self.kinds[data]
        lead = np.flatnonzero(kind == WIDE)
        if len(lead):
            after = data[lead + 1]
            sign = (data[lead] == 0xC3) & ((after == 0x97) | (after == 0xB7))
            kind[lead] = kind[lead + 1] = np.where(sign, ODD, LETTER)
        breaks = np.flatnonzero(kind == BREAK)
        kind[breaks[1:][np.diff(breaks) == 1]] = ODD
        for token in self.added:
            raw, at = data.tobytes(), -1
            while (at := raw.find(token, at + 1)) >= 0:
                kind[at] = ODD
        return kind

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """The code of every piece, the distinct pieces, and where each text's pieces end."""
        offsets = np.asarray(offsets_of(texts))
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
        bounds = offsets - offsets[0]
        kind = self._kinds(data)
        new = np.ones(len(data) + 1, dtype=bool)
        new[1:-1] = _changes(kind)
        new[bounds] = True
        odd = kind == ODD
        if odd.any():
            first = kind == SPACE
            first[bounds[bounds < len(data)]] = True
            first = np.append(np.flatnonzero(first), len(data))
            words = np.flatnonzero(np.logical_or.reduceat(odd, first[:-1]))
            inside = np.zeros(len(data) + 1, dtype=np.int8)
            inside[first[words] + 1] += 1
            inside[first[words + 1]] -= 1
            new &= np.cumsum(inside, dtype=np.int8) == 0
            new[bounds] = True
        starts = np.flatnonzero(new)
        places = pa.py_buffer(starts + offsets[0])
        coded = pa.Array.from_buffers(self.known_type, len(starts) - 1, [None, places, texts.buffers()[2]]).dictionary_encode()
        return np.asarray(coded.indices), coded.dictionary, np.searchsorted(starts, bounds[1:])

    def _fresh(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.asarray(offsets_of(words))
        data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        kind, sizes = self._kinds(data), np.diff(offsets)
        mixed = kind == ODD
        changes = _changes(kind)
        changes[offsets[1:-1] - 1] = False
        mixed[1:] |= changes
        mixed = np.logical_or.reduceat(mixed, offsets[:-1])
        led = mixed & (kind[offsets[:-1]] == SPACE)
        order = np.concatenate([np.flatnonzero(m) for m in (~mixed, led, mixed & ~led)])
        # Runs go in short strings, cut at spaces that stand between them; words with a space need no more.
        n, parts = len(words) - int(mixed.sum()), []
        plain = data[np.repeat(~mixed, sizes)] if n < len(words) else data
        ends = np.cumsum(sizes[~mixed])
        drawn = np.full(len(plain) + n, 32, dtype="<u4")
        drawn[np.arange(len(plain)) + np.repeat(np.arange(n), sizes[~mixed])] = DRAWN[plain]
        drawn, ends = drawn.tobytes().decode("utf-32-le"), ends + np.arange(n)
        for i in range(0, n, STRING_WORDS):
            parts.append(drawn[int(ends[i - 1]) + 1 if i else 0 : int(ends[min(i + STRING_WORDS, n) - 1])])
        ids = [e.ids for e in self.runs.encode_batch_fast(parts, add_special_tokens=False)]
        if n < len(words):
            rest = [w.decode() for w in words.take(pa.array(order[n:])).to_pylist()]
            some = int(led.sum())
            ids += self._whole(["".join(rest[i : min(i + STRING_WORDS, some)]) for i in range(0, some, STRING_WORDS)] + rest[some:])
        ids = np.fromiter(chain.from_iterable(ids), self.kind)
        # Pieces end where the bytes of the ids add up to theirs.
        covered, wanted = np.cumsum(self.width[ids]), np.cumsum(sizes[order])
        last = np.searchsorted(covered, wanted)
        if len(covered) != last[-1] + 1 or (covered[last] != wanted).any():
            raise ValueError("the ids do not cover the text: not a byte-level vocabulary")
        if n == len(words):
            return ids, last + 1
        begin, size = np.empty((2, len(words)), dtype=np.int64)
        size[order] = np.diff(last, prepend=-1)
        begin[order] = last + 1 - size[order]
        return ids[_places(begin, size)], np.cumsum(size)

    def encode(self, texts: list[str | None] | pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        n, tail = len(texts), int(end_id is not None)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()), "")
        whole = np.asarray(pc.match_substring_regex(texts, self.odd_texts).to_numpy(zero_copy_only=False), dtype=bool)
        alone = self._whole(texts.filter(pa.array(whole)).to_pylist()) if whole.any() else []
        codes, values, ends = self._cut(texts.filter(pa.array(~whole)) if len(alone) else texts)
        numbers = self._numbers(values) if len(values) else np.zeros(0, np.int64)
        begin = self.begin[numbers].astype(np.int32)
        each = (self.begin[numbers + 1].astype(np.int32) - begin)[codes]
        lengths = np.empty(n, dtype=np.int64)
        lengths[~whole] = np.diff(np.append(0, np.cumsum(each, dtype=np.int64))[ends], prepend=0)
        lengths[whole] = np.fromiter(map(len, alone), np.int64, len(alone))
        body = self.flat[_places(begin[codes], each)]
        stop = np.cumsum(lengths + tail)
        out = np.empty(int(stop[-1]), dtype=np.uint32)
        own = np.ones(len(out), dtype=bool)
        if tail:
            out[stop - 1] = end_id
            own[stop - 1] = False
        for i, ids in zip(np.flatnonzero(whole).tolist(), alone, strict=True):
            at = slice(int(stop[i] - tail - lengths[i]), int(stop[i] - tail))
            out[at], own[at] = ids, False
        out[own] = body
        return out, lengths + tail


def word_encoder(path: str, specials: bool = False) -> WordEncoder:
    """One encoder for each worker process."""
    return kept(("encoder", path, specials), lambda: WordEncoder(path, specials=specials))
