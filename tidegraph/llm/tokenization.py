"""Encoding with the tokenizers library, remembering pieces between white space.

Both tokenizer kinds used here never let a token cross the place before a single space between
two non-blank characters, so the ids of a text are the ids of its pieces, and a piece that was
seen before need not be encoded again. A batch is cut and its distinct pieces are found by Arrow;
those that are Latin words are merged all at once, any others are remembered. A tokenizer of another kind encodes whole texts, and so does any text that
holds a special token's string, which the library would make that token."""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from tidegraph.llm.bpe import _CUT, _plain

#: Pieces a worker remembers, as places in one array of ids; the memo is emptied when it is full.
MEMO = 500_000
#: Before a key that is a whole piece; a key that begins with it stands for the rest, whatever it is.
_MARK = "\0"
#: Latin letters below U+0250, which normalisation never composes with others (the dotted capital I
#: lower-cases to two).
_WORDS = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+$"
#: Marks that may follow a word without changing how either is split (the apostrophe is none of them),
#: and as many of them as are told apart by an integer.
_TAIL, _LONGEST = ".,;:!?*#$%&|()\"-", 8


#: Texts and characters that a batch of encoding holds; one longer text is a batch of its own.
_TEXTS, _CHARS = 4096, 6 << 20


def portions(texts: list[str]) -> Iterator[slice]:
    """Slices of a list of texts, in their order, each of bounded size."""
    begin = held = 0
    for i, text in enumerate(texts):
        if i > begin and (i - begin == _TEXTS or held + len(text) > _CHARS):
            yield slice(begin, i)
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes are themselves, the others follow from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordMerger:
    """The merges of a BPE vocabulary over many short words at once: in each round the lowest pair of
    every word that still has one becomes one id."""

    #: Widths, in bytes, that words are merged at; longer ones go to the library.
    WIDTHS = (4, 6, 8, 10, 12, 16, 24, 32)
    _NONE = np.int32(1 << 30)

    def __init__(self, model: dict):
        vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        suffix = model.get("end_of_word_suffix") or ""
        letters = [_byte_letters()[b] for b in range(256)]
        self.middle = np.array([vocab.get(x, -1) for x in letters], dtype=np.int32)
        self.last = np.array([vocab.get(x + suffix, -1) for x in letters], dtype=np.int32)
        self.result = np.array([vocab[a + b] for a, b in merges], dtype=np.int32)
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], dtype=np.int64)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.key, self.rank = np.full(1 << self.bits, -1, dtype=np.int64), np.full(1 << self.bits, self._NONE, dtype=np.int32)
        for rank, (slot, key) in enumerate(zip(self._slots(keys).tolist(), keys.tolist())):
            while self.key[slot] >= 0 and self.key[slot] != key:
                slot = (slot + 1) & (1 << self.bits) - 1
            if self.key[slot] < 0:
                self.key[slot], self.rank[slot] = key, rank

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or _NONE; a negative id is none."""
        shape, left, right = left.shape, left.ravel(), right.ravel()
        keys = left.astype(np.int64) << 20 | right
        keys[(left < 0) | (right < 0)] = -2
        slots = self._slots(keys)
        found = self.key[slots]
        out = np.where(found == keys, self.rank[slots], self._NONE)
        away = np.flatnonzero((found >= 0) & (found != keys))
        while len(away):
            slots[away] = (slots[away] + 1) & (1 << self.bits) - 1
            found = self.key[slots[away]]
            hit = found == keys[away]
            out[away[hit]] = self.rank[slots[away[hit]]]
            away = away[(found >= 0) & ~hit]
        return out.reshape(shape)

    def _merged(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ids, padded by -1, after all merges, and how many each has left."""
        out, left = ids.copy(), np.arange(len(ids))
        rank = self.ranks(ids[:, :-1], ids[:, 1:])
        while True:
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rank), dtype=np.int64)
            best = rank[np.arange(len(rank)), at] if rank.shape[1] else np.full(len(rank), self._NONE)
            on = best < self._NONE
            done = left[~on]
            out[done] = -1
            out[done, : ids.shape[1]] = ids[~on]
            if not on.any():
                return out, (out >= 0).sum(axis=1)
            ids, rank, at, best, left = ids[on], rank[on], at[on], best[on], left[on]
            rows, columns = np.arange(len(ids)), np.arange(ids.shape[1] - 1)
            merged = self.result[best]
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
            ids[rows, at] = merged
            columns = columns[:-1]
            rank = np.take_along_axis(rank, columns + (columns >= at[:, None]), axis=1)
            has = np.flatnonzero(at > 0)
            rank[has, at[has] - 1] = self.ranks(ids[has, at[has] - 1], merged[has])
            has = np.flatnonzero(at < rank.shape[1])
            rank[has, at[has]] = self.ranks(merged[has], ids[has, at[has] + 1])

    def encode(self, words: pa.LargeStringArray, lead: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words one after another, their number by word, and the words that are too long (none
        of theirs). With ``lead`` a space stands before every word."""
        if not len(words):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
        raw = np.frombuffer(words.buffers()[2], dtype=np.uint8)
        begins, lengths = offsets[:-1], np.diff(offsets)
        base = self.middle[raw]
        base[offsets[1:] - 1] = self.last[raw[offsets[1:] - 1]]
        sizes, parts, least = np.zeros(len(words), dtype=np.int64), [], 0
        for width in self.WIDTHS:
            of = np.flatnonzero((lengths > least) & (lengths <= width))
            least, columns = width, np.arange(width)
            for at in range(0, len(of), 100_000):
                rows = of[at : at + 100_000]
                ids = base[np.minimum(begins[rows, None] + columns, len(base) - 1)]
                ids[columns >= lengths[rows, None]] = -1
                if lead:
                    ids = np.concatenate([np.full((len(rows), 1), self.middle[32], dtype=np.int32), ids], axis=1)
                merged, count = self._merged(ids)
                sizes[rows] = count
                parts.append((rows, merged))
        before = np.cumsum(sizes) - sizes
        flat = np.empty(int(sizes.sum()), dtype=np.uint32)
        for rows, merged in parts:
            held = merged >= 0
            flat[(before[rows, None] + np.arange(merged.shape[1]))[held]] = merged[held]
        return flat, sizes, np.flatnonzero(lengths > least)


def _joined(store: np.ndarray, start: np.ndarray, length: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What lies at the places of a store, one after another, and how much each has."""
    sizes = length[places]
    before = np.cumsum(sizes) - sizes
    return store[np.arange(int(sizes.sum())) + np.repeat(start[places] - before, sizes)], sizes


class PieceTokenizer:
    """One tokenizer file in one worker."""

    _built: dict[tuple[str, bool], PieceTokenizer] = {}

    def __init__(self, path: str, plain_specials: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        with open(path) as file:
            spec = json.load(file)
        split = spec.get("pre_tokenizer") or {}
        steps = split.get("pretokenizers", [split])
        normalizers = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.kind = "whole"
        if steps[0].get("type") == "ByteLevel" and steps[0].get("use_regex") and not normalizers:
            self.kind = "spaced"
        elif steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and set(normalizers) <= {"NFC", "Replace", "Lowercase"}:
            self.kind = "blankless"
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.specials = [t.content for t in added if not (plain_specials and t.special)]
        if any(t.normalized for t in added):  # such a string may arise from others
            self.kind = "whole"
        model = spec["model"]
        plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback", "continuing_subword_prefix"))
        self.words = WordMerger(model) if self.kind != "whole" and plain else None
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str | None, int] = {}
        self.start, self.length = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)
        self.store, self.filled, self.tails = np.zeros(1 << 14, dtype=np.uint32), 0, {}

    def _learn(self, keys: list, ids: list[list[int]]) -> None:
        """Remember new keys' ids in the array; the arrays double when they are full. A key that is no
        piece (any hashable that is no string) only has a place."""
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        first, last, end = len(self.memo), len(self.memo) + len(keys), self.filled + int(sizes.sum())
        while last > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        while end > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.memo.update(zip(keys, range(first, last)))
        self.length[first:last] = sizes
        self.start[first:last] = self.filled + np.cumsum(sizes) - sizes
        self.store[self.filled : end] = np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=end - self.filled)
        self.filled = end

    @classmethod
    def at(cls, path: str, plain_specials: bool = False) -> PieceTokenizer:
        if (path, plain_specials) not in cls._built:
            cls._built[path, plain_specials] = cls(path, plain_specials)
        return cls._built[path, plain_specials]

    def _piece(self, key: str) -> str:
        if self.kind == "blankless" or key[:1] == "\n":
            return key
        return key[1:] if key[:1] == _MARK else " " + key

    def _spread(self, text: str) -> str | None:
        """The text with a space before each line feed, where that cuts it as the tokenizer does: a line feed
        is a pre-token of its own unless several stand at the end or more than two elsewhere. None if it doesn't."""
        if self.kind == "blankless":
            return text.replace("\n", " ")
        if _MARK in text or not _plain(text) or "\n\n\n" in text or text.endswith("\n\n"):
            return None
        return text.replace("\n", " \n")

    def _tail_places(self, tails: np.ndarray) -> np.ndarray:
        """Places of the marks after words, each up to _LONGEST marks as the bytes of an integer."""
        distinct, at = np.unique(tails, return_inverse=True)
        new = [t for t in distinct.tolist() if (t,) not in self.memo]
        texts = [t.to_bytes(_LONGEST, "big").strip(b"\0").decode() for t in new]
        self._learn([(t,) for t in new], [self.tokenizer.encode(t, add_special_tokens=False).ids if t else [] for t in texts])
        return np.array([self.memo[t,] for t in distinct.tolist()], dtype=np.int64)[at]

    def _places(self, keys: list) -> np.ndarray:
        """Places of distinct keys; those not seen before are learned."""
        places = np.fromiter(map(self.memo.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))
        where = np.flatnonzero(places < 0)
        if len(where):
            new = [keys[i] for i in where.tolist()]
            for at in range(0, len(new), 10_000):
                part = new[at : at + 10_000]
                encoded = self.tokenizer.encode_batch_fast(list(map(self._piece, part)), add_special_tokens=False)
                self._learn(part, [e.ids for e in encoded])
            places[where] = [self.memo[k] for k in new]
        return places

    def _cut(self, texts: list[str], end: int) -> list[np.ndarray]:
        """Ids of texts that single spaces cut into pieces: of each piece a word and the
        marks after it, or the whole piece."""
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        offsets = np.asarray(lists.offsets)
        coded = lists.values.dictionary_encode()
        distinct = coded.dictionary
        stems, tails = distinct, np.zeros(len(distinct), dtype=np.uint64)
        if self.words:
            bare = pc.utf8_rtrim(distinct, characters=_TAIL)
            longer = np.asarray(pc.subtract(pc.binary_length(distinct), pc.binary_length(bare)))
            fits = pc.and_(pc.match_substring_regex(bare, _WORDS), pa.array(longer <= _LONGEST))
            stems = pc.if_else(fits, bare, distinct)
            longer = np.where(np.asarray(fits), longer, 0)
            raw, stops = np.frombuffer(distinct.buffers()[2], dtype=np.uint8), np.frombuffer(distinct.buffers()[1], dtype=np.int64)
            stops = stops[distinct.offset + 1 : distinct.offset + 1 + len(distinct)]
            for back in range(int(longer.max(initial=0)), 0, -1):
                has = longer >= back
                tails[has] = tails[has] << np.uint64(8) | raw[stops[has] - back]
        stemmed = stems.dictionary_encode()
        stems = stemmed.dictionary

        # the ids of all distinct words, marks and other pieces of this batch, and where each lies
        start, length, held = np.zeros(len(stems), dtype=np.int64), np.zeros(len(stems), dtype=np.int64), []
        other = np.arange(len(stems))
        if self.words:
            word = np.asarray(pc.match_substring_regex(stems, _WORDS))
            own, other = np.flatnonzero(word), np.flatnonzero(~word)
            spelled = stems.filter(pa.array(word))
            flat, sizes, long = self.words.encode(pc.utf8_lower(spelled) if self.kind == "blankless" else spelled, self.kind == "spaced")
            other = np.concatenate([other, own[long]])
            start[own], length[own] = np.cumsum(sizes) - sizes, sizes
            held.append(flat)
        remembered = [self._places(stems.take(pa.array(other)).to_pylist()), self._tail_places(tails)]
        first = [_MARK + x for x in lists.values.take(pa.array(offsets[:-1])).to_pylist()] if self.kind == "spaced" else []
        several = list(dict.fromkeys(first))
        remembered += [self._places(several), np.array([self.memo[0,], self.memo[end, end]])]
        known, which = np.unique(np.concatenate(remembered), return_inverse=True)
        flat, sizes = _joined(self.store, self.start, self.length, known)
        held.append(flat)
        before = np.cumsum(sizes) - sizes + (len(held[0]) if len(held) > 1 else 0)
        start[other], length[other] = before[which[: len(other)]], sizes[which[: len(other)]]
        start, length = np.concatenate([start, before]), np.concatenate([length, sizes])
        which = which[len(other) :] + len(stems)

        pieces = np.stack([np.asarray(stemmed.indices), which[: len(distinct)]], axis=1)[np.asarray(coded.indices)]
        if self.kind == "spaced":  # the first piece has no space before it
            at = dict(zip(several, which[len(distinct) : -2].tolist()))
            pieces[offsets[:-1], 0] = [at[k] for k in first]
            pieces[offsets[:-1], 1] = which[-2]
        return self._split(np.concatenate(held), start, length, pieces.ravel(), 2 * np.diff(offsets), which[-1])

    @staticmethod
    def _split(store: np.ndarray, start: np.ndarray, length: np.ndarray, places: np.ndarray, count: np.ndarray, end: int) -> list[np.ndarray]:
        """Ids of each text from the places of its pieces, with the end's after them."""
        stops = np.cumsum(count)
        ids, sizes = _joined(store, start, length, np.insert(places, stops, end))
        lengths = np.add.reduceat(sizes, stops - count + np.arange(len(count)))
        return np.split(ids, np.cumsum(lengths)[:-1])

    def encode(self, texts: list[str], end: int) -> list[np.ndarray]:
        """Ids of each whole text, then ``end``, as unsigned 32-bit integers."""
        out: list[np.ndarray] = [None] * len(texts)  # type: ignore[list-item]
        whole, plain, even, rough = [], [], [], []
        for i, text in enumerate(texts):
            if self.kind == "whole" or any(s in text for s in self.specials):
                whole.append(i)
            elif (found := self._spread(text)) is not None:
                plain.append(i)
                even.append(found)
            else:
                rough.append(i)
        if len(self.memo) > MEMO:
            self._forget()
        if (end, end) not in self.memo:
            self._learn([(end, end), (0,)], [[end], []])  # the end of a text, and no marks
        if whole:
            for i, e in zip(whole, self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)):
                out[i] = np.array([*e.ids, end], dtype=np.uint32)
        if rough:
            keys = [list(map(_MARK.__add__, _CUT.findall(texts[i]))) for i in rough]
            distinct = list(dict.fromkeys(chain.from_iterable(keys)))
            known = dict(zip(distinct, self._places(distinct).tolist()))
            count = np.array([len(k) for k in keys], dtype=np.int64)
            places = np.fromiter((known[k] for key in keys for k in key), dtype=np.int64, count=int(count.sum()))
            for i, ids in zip(rough, self._split(self.store, self.start, self.length, places, count, self.memo[end, end])):
                out[i] = ids
        if plain:
            for i, ids in zip(plain, self._cut(even, end)):
                out[i] = ids
        return out
