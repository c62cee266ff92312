"""Byte-level BPE by ranks: encoding to ids and decoding back.

Tier 1: a minimal perfect hash over the vocabulary resolves a pre-token that is a whole token.
Tier 2: any other pre-token is merged with a heap of pair ranks over linked byte segments,
lowest rank first and leftmost among equals, in n log n steps however long it is.

Defined cases: a null or empty text encodes to no ids and decodes to no bytes. Lone surrogates
cannot occur in Spark strings. Special-token strings are ordinary text. Rows map one to one;
other columns pass through."""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegraph.llm.common import documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Pieces a worker remembers; the memo is emptied when it is full. Documents handled at once.
MEMO, SLICE = 500_000, 256
#: Before a key that is a whole piece; any other key stands for itself after a space.
_MARK = "\0"
#: Unicode White_Space, which is what \s means in the pattern.
_WHITE = "\t-\r \x85\xa0  -     　"


def _category_ranges(initial: str) -> str:
    """A regex class body with every code point whose general category starts with ``initial``."""
    hits = np.array([unicodedata.category(chr(i))[0] == initial for i in range(0x110000)])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hits.astype(np.int8), [0]])))
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b - 1))}" for a, b in edges.reshape(-1, 2))


def pre_token_pattern(pattern: str = public_tokenizers.PATTERN) -> re.Pattern:
    """The published split pattern with its Unicode classes spelled out for the standard module."""
    letters, numbers = _category_ranges("L"), _category_ranges("N")
    spelled = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{_WHITE}{letters}{numbers}]")
    spelled = spelled.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
    return re.compile(spelled.replace(r"\S", f"[^{_WHITE}]").replace(r"\s", f"[{_WHITE}]"))


class MinimalPerfectHash:
    """Keys to 0 .. n-1 without collisions, by hash and displace.

    Buckets are placed from the fullest to the emptiest; a bucket of several keys searches a seed
    that sends them all to free slots, a bucket of one is given a free slot outright."""

    def __init__(self, keys: list[bytes]):
        n = self.n = max(1, len(keys))
        buckets: list[list[int]] = [[] for _ in range(n)]
        for i, key in enumerate(keys):
            buckets[xxhash.xxh3_64_intdigest(key) % n].append(i)
        self.displace, self.owner = [0] * n, [-1] * n
        order = sorted((b for b in range(n) if buckets[b]), key=lambda b: -len(buckets[b]))
        free = n - 1
        for b in order:
            group = buckets[b]
            if len(group) > 1:
                seed = 1
                while True:
                    slots = [xxhash.xxh3_64_intdigest(keys[i], seed) % n for i in group]
                    if len(set(slots)) == len(slots) and all(self.owner[s] < 0 for s in slots):
                        break
                    seed += 1
                self.displace[b] = seed
                for i, s in zip(group, slots):
                    self.owner[s] = i
            else:
                while self.owner[free] >= 0:
                    free -= 1
                self.displace[b] = -free - 1
                self.owner[free] = group[0]

    def slot(self, key: bytes) -> int:
        move = self.displace[xxhash.xxh3_64_intdigest(key) % self.n]
        return -move - 1 if move < 0 else xxhash.xxh3_64_intdigest(key, move) % self.n


class PieceMemo:
    """Ids of remembered pieces as places in one array."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.start, self.length = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)
        self.store, self.filled = np.zeros(1 << 14, dtype=np.int32), 0

    def learn(self, pieces: list[str], ids: list[list[int]]) -> None:
        first, sizes = len(self.place), np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        last, end = first + len(pieces), self.filled + int(sizes.sum())
        while last > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        while end > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.place.update(zip(pieces, range(first, last)))
        self.length[first:last] = sizes
        self.start[first:last] = self.filled + np.cumsum(sizes) - sizes
        self.store[self.filled : end] = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=end - self.filled)
        self.filled = end

    def ids(self, pieces: list[str], unseen) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each piece has; ``unseen`` encodes a piece for the first time."""
        places = np.fromiter(map(self.place.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        where = np.flatnonzero(places < 0)
        if len(where):
            new = list({pieces[i] for i in where.tolist()})
            self.learn(new, list(map(unseen, new)))
            places[where] = [self.place[pieces[i]] for i in where.tolist()]
        sizes = self.length[places]
        return gather(self.store, self.start[places], sizes), sizes


def gather(store: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``store`` that begin at ``start``, joined."""
    before = np.cumsum(sizes) - sizes
    return store[np.arange(int(sizes.sum())) + np.repeat(start - before, sizes)]


class ByteDecoder:
    """Token bytes by id, joined in one array; all that decoding needs."""

    _built: dict[str, ByteDecoder] = {}

    def __init__(self, ranks_path: str):
        with open(ranks_path, "rb") as file:
            pairs = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in file if line.strip())}
        tokens = [pairs.get(i, b"") for i in range(max(pairs) + 1)]
        self.length = np.array([len(t) for t in tokens], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.store = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    @classmethod
    def at(cls, ranks_path: str) -> ByteDecoder:
        if ranks_path not in cls._built:
            cls._built[ranks_path] = cls(ranks_path)
        return cls._built[ranks_path]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Bytes of each of several id lists that lie one after another."""
        sizes = self.length[ids]
        whole = gather(self.store, self.start[ids], sizes).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)].tolist() if len(counts) else []
        return [whole[a:b] for a, b in zip([0, *ends[:-1]], ends)]


class BytePairCodec:
    """Encoder for one rank file; each worker builds its own once."""

    _built: dict[str, BytePairCodec] = {}

    def __init__(self, ranks_path: str):
        with open(ranks_path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        tokens = list(self.ranks)
        self.hash = MinimalPerfectHash(tokens)
        self.slot_token = [tokens[i] if i >= 0 else None for i in self.hash.owner]
        self.slot_rank = [self.ranks[t] if t is not None else -1 for t in self.slot_token]
        self.pattern = pre_token_pattern()
        self.memo = PieceMemo()

    @classmethod
    def at(cls, ranks_path: str) -> BytePairCodec:
        if ranks_path not in cls._built:
            cls._built[ranks_path] = cls(ranks_path)
        return cls._built[ranks_path]

    def _pre_token(self, token: bytes) -> list[int]:
        slot = self.hash.slot(token)
        return [self.slot_rank[slot]] if self.slot_token[slot] == token else self.merge(token)

    def merge(self, token: bytes) -> list[int]:
        """Merges until no adjacent pair is in the vocabulary."""
        n, ranks = len(token), self.ranks
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []  # rank, start, end of the pair
        for i in range(n - 1):
            rank = ranks.get(token[i : i + 2])
            if rank is not None:
                heappush(heap, (rank, i, i + 2))
        while heap:
            rank, i, stop = heappop(heap)
            middle = end[i]
            # stale unless segment i still exists and its right neighbour still ends where it did
            if middle <= i or middle >= n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, -1
            if stop < n:
                before[stop] = i
                rank = ranks.get(token[i : end[stop]])
                if rank is not None:
                    heappush(heap, (rank, i, end[stop]))
            left = before[i]
            if left >= 0:
                rank = ranks.get(token[left:stop])
                if rank is not None:
                    heappush(heap, (rank, left, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[token[i : end[i]]])
            i = end[i]
        return out

    def _piece(self, key: str) -> list[int]:
        piece = key[1:] if key[:1] == _MARK else " " + key
        return list(chain.from_iterable(self._pre_token(t.encode()) for t in self.pattern.findall(piece)))

    @staticmethod
    def _pieces(text: str) -> list[str]:
        """Keys of a text's pieces. It is cut before each single space between two non-blank characters;
        a pre-token never crosses such a place, so pieces can be remembered."""
        if not text:
            return []
        if _MARK not in text and _plain(text):
            pieces = text.split(" ")
            pieces[0] = _MARK + pieces[0]
            return pieces
        return list(map(_MARK.__add__, _CUT.findall(text)))

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        if len(self.memo.place) > MEMO:
            self.memo = PieceMemo()
        pieces = list(map(self._pieces, texts))
        ids, sizes = self.memo.ids(list(chain.from_iterable(pieces)), self._piece)
        upto = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, pieces)])]
        return ids, np.diff(upto)

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()


_CUT = re.compile(rf"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
_OTHER_WHITE = re.compile(f"[{_WHITE}]".replace("\t-\r ", "\t\x0b-\r")).search


def _plain(text: str) -> bool:
    """White space is line feeds and single spaces only, each space between two non-blank characters."""
    return not (
        "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or _OTHER_WHITE(text)
    )


def _added(df: DataFrame, name: str, column: Column) -> StructType:
    return df.select("*", column.alias(name)).schema


def encode(df: DataFrame, text: str = "text", to: str = "ids", ranks_path: str = RANKS) -> DataFrame:
    """``df`` with the ids of ``text`` in ``to``, replacing a column of that name; one Arrow batch at a time."""
    df = df.drop(to)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = BytePairCodec.at(ranks_path)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
                ids, counts = codec.encode_batch(texts)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, to])

    return df.mapInArrow(run, _added(df, to, F.array().cast("array<int>")))


def decode(df: DataFrame, ids: str = "ids", to: str = "decoded", ranks_path: str = RANKS) -> DataFrame:
    """``df`` with the bytes that ``ids`` stand for in ``to``, replacing a column of that name; null ids are no bytes."""
    df = df.drop(to)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = ByteDecoder.at(ranks_path)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                lists = batch.column(batch.schema.get_field_index(ids))
                counts = np.array([n or 0 for n in pc.list_value_length(lists).to_pylist()], dtype=np.int64)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                out = pa.array(decoder.decode(flat, counts), pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, to])

    return df.mapInArrow(run, _added(df, to, F.lit(b"")))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, then decoded from its ids, as digests."""
    docs = encode(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    both = decode(docs)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
