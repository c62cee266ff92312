"""Scoring with a hierarchical Pitman-Yor language model.

A restaurant for each context holds the words that follow it; all share one parent, whose base is
uniform over the training types and one unknown word. A context is the word before, whole, or the
start of the text; contexts are told apart as words are, by all 64 bits of a hash, so no two words
share a restaurant. Seating is sampled by Gibbs: in every pass all customers of each dish leave and
are seated again, at tables of the dish or at new ones, each of which sends a customer to the parent.
What is drawn is the dish's number of tables. Table counts are averaged over the passes after the
burn-in; they give the predictive probabilities that texts are scored with. Discounts and strengths
are parameters.

Everything is counted over all training documents. Words are dealt by hash to ranges, so a word's
counts in all contexts lie together and ranges are sampled in parallel. The tables of a context lie
in many ranges: after every round of passes each range sends its share to the context's group (some
neighbouring ranges of hashes), which sends the whole back to the ranges and, in the end, to the
chunks that have the context. Nothing that grows with the words comes to the driver or to every task.
Documents travel as chunks: a chunk sends the distinct (word, context) pairs of its texts with their
counts to the ranges, and gets their statistics back. A chunk has a row for each range that it has
words of, so there are never more rows than pairs. Ranges are merged slice by slice, and what has been
read is deleted, so pairs are on disk once and not twice, but for one slice.

Defined cases: a null or empty text is the end token alone. Bytes, not characters, are compared, so
any text is fine; a text of any length lies in one chunk, and one row must fit a worker. Repeated
rows count as often as they occur, and each is scored; equal ids (ties) make rows of their own. Rows
with a null id are in fold 0 of the contract and train. Without training tokens every token has
probability 1 under the base and the model alike. Other columns, whatever their names, are not
carried."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import delete, documents, fold, scratch_path

#: Discounts and strengths of contexts and parent.
DISCOUNT, STRENGTH, ROOT_DISCOUNT, ROOT_STRENGTH = 0.75, 1.0, 0.6, 1.0
#: Pairs that the tables of similar contexts count for, where a range estimates a context's tables.
PRIOR = 8.0
#: Gibbs passes, those of them that are not averaged, and passes between two seatings of the parent.
PASSES, BURN_IN, ROOT_EVERY = 24, 8, 4
#: The passes by rounds; between two rounds ranges learn the tables of their contexts elsewhere.
ROUNDS = (4, 4, 16)
#: Counts whose table numbers are drawn from the whole distribution, the count that the error of the
#: others' approximation is taken at, and slices of the others in the first pass.
EXACT, FITTED, FIRST_ROUNDS = 256, 4096, 12
#: Documents and tokens in a chunk; documents for each range of words; ranges in a group of contexts.
CHUNK_DOCS, CHUNK_TOKENS, RANGE_DOCS, GROUP = 8192, 3 << 19, 4096, 8
#: Slices that ranges are merged in at most, and ranges in a slice at least, so that its tasks run side by side.
SLICES, SLICE = 8, 8
_MEMO = 500_000


def _pack(**arrays: np.ndarray) -> bytes:
    """Arrays in little room: ascending runs as differences, and the bytes of all values plane by plane."""
    held = {}
    for name, x in arrays.items():
        if x.dtype.kind not in "iuf" or x.dtype.itemsize == 1:
            held[name] = x
            continue
        # unsigned differences wrap around, and back when they are summed
        steps = x.dtype.kind == "u" and 10 * np.count_nonzero(x[1:] < x[:-1]) <= len(x)
        y = np.diff(x, prepend=x.dtype.type(0)) if steps else x
        held[name] = (steps, x.dtype.str, np.ascontiguousarray(y.view(np.uint8).reshape(len(y), y.dtype.itemsize).T))
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(held, protocol=5))


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    found = pickle.loads(zstandard.ZstdDecompressor().decompress(blob))
    for name, x in found.items():
        if isinstance(x, tuple):
            steps, kind, planes = x
            y = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
            found[name] = np.cumsum(y, dtype=y.dtype) if steps else y
    return found


#: No word hashes to it but by chance of 2 to the -64: the end of a text, and as a context its start.
END = 0
_codes: dict[bytes, int] = {}


def tokens(text: str | None) -> list[int]:
    """Codes of the words of a text with A-Z lower-cased, then the end."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    for word in set(words).difference(_codes):
        _codes[word] = xxhash.xxh3_64_intdigest(word)
    return [*map(_codes.__getitem__, words), END]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[list[int]]]]:
    ids, trains, coded, held = [], [], [], 0
    for batch in batches:
        for doc, text, train in zip(*(c.to_pylist() for c in batch.columns)):
            if len(_codes) > _MEMO:
                _codes.clear()
            ids.append(doc)
            trains.append(train)
            coded.append(tokens(text))
            held += len(coded[-1])
            if len(ids) >= CHUNK_DOCS or held >= CHUNK_TOKENS:
                yield ids, trains, coded
                ids, trains, coded, held = [], [], [], 0
    if ids:
        yield ids, trains, coded


_ROWS = "to bigint, other bigint, blob binary, sums array<double>, kind string"


def _rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows (kind, to, other, blob, sums) in small batches."""
    types = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.float64()))
    for at in range(0, len(rows), 64):
        kind, to, other, blob, sums = (pa.array(x, t) for x, t in zip(zip(*rows[at : at + 64]), types))
        yield pa.RecordBatch.from_arrays([to, other, blob, sums, kind], names=["to", "other", "blob", "sums", "kind"])


def _pairs(at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and context of each distinct pair of a chunk, and the pair of each token; all of them, like
    ``at``, by the word's number in the chunk. The least code is the end's, so its number is 0."""
    before = np.empty_like(at)
    before[1:] = at[:-1]
    before[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = 0
    words = int(at.max()) + 1
    pairs, stream = np.unique(at * words + before, return_inverse=True)
    return pairs // words, pairs % words, stream


def _share(codes: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each code; it ascends with the codes."""
    return ((codes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _count(ranges: int):
    """Chunks as rows: the documents as streams of word numbers, and the pairs of each range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId() if TaskContext.get() else 0
        for number, (ids, trains, coded) in enumerate(_chunks(batches)):
            chunk = partition << 24 | number
            sizes = np.array([len(c) for c in coded], dtype=np.int64)
            word = np.fromiter(chain.from_iterable(coded), dtype=np.uint64, count=int(sizes.sum()))
            coded.clear()
            types, at = np.unique(word, return_inverse=True)
            owner, where, stream = _pairs(at, sizes)
            train = np.repeat(np.array(trains, dtype=bool), sizes)
            counts = np.bincount(stream[train], minlength=len(owner)).astype(np.uint32)
            several = np.bincount(owner, minlength=len(types)).astype(np.uint32)
            docs = _pack(ids=np.array(ids, dtype=object), sizes=sizes.astype(np.uint32), at=at.astype(np.uint32))
            rows = [("docs", chunk, -1, docs, None)]
            share = _share(types, ranges)
            own = np.flatnonzero(np.diff(share, prepend=-1))  # ascending, like the types
            cuts = np.searchsorted(owner, np.append(own, len(types)))
            for k, (first, last) in enumerate(zip(own.tolist(), [*own[1:].tolist(), len(types)])):
                a, b = cuts[k], cuts[k + 1]
                heads, place = np.unique(where[a:b], return_inverse=True)
                blob = _pack(
                    types=types[first:last], several=several[first:last], heads=types[heads], where=place.astype(np.uint32), counts=counts[a:b]
                )
                rows.append(("pairs", int(share[first]), chunk, blob, None))
            yield from _rows(rows)

    return run


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Rows (key, other, blob) by equal neighbouring keys."""
    key, held = None, []
    for batch in batches:
        for k, other, blob in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key and held:
                yield key, held
                held = []
            key = k
            held.append((other, blob))
    if held:
        yield key, held


def _sliced(part: int, groups: np.ndarray, cuts: np.ndarray, **values: np.ndarray) -> list[tuple]:
    """A range's values by context, a row for each group that has any of the contexts."""
    return [
        ("sent", g, part, _pack(**{k: x[a:b] for k, x in values.items()}), None) for g, a, b in zip(groups.tolist(), cuts[:-1], cuts[1:])
    ]


def _merge(ranges: int):
    """All chunks' pairs of a range as one table, where each chunk's pairs are in it, the range's share
    of its contexts for their groups, and which of its words, as contexts, each chunk will ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _segments(batches):
            parts = [(chunk, _unpack(blob)) for chunk, blob in rows]
            rows.clear()
            types, at = np.unique(np.concatenate([p["types"] for _, p in parts]), return_inverse=True)
            heads, head = np.unique(np.concatenate([p["heads"] for _, p in parts]), return_inverse=True)
            starts = np.cumsum([0, *(len(p["heads"]) for _, p in parts)])
            key = np.repeat(at, np.concatenate([p["several"] for _, p in parts])) * len(heads)
            key += head[np.concatenate([p["where"].astype(np.int64) + a for (_, p), a in zip(parts, starts)])]
            pairs, place = np.unique(key, return_inverse=True)
            del key, head
            counts = np.bincount(place, weights=np.concatenate([p["counts"] for _, p in parts]), minlength=len(pairs)).astype(np.int64)
            owner, where = pairs // len(heads), pairs % len(heads)
            group, chunks = _share(heads, ranges) // GROUP, np.array([c for c, _ in parts])
            cuts = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(heads))
            groups = group[cuts[:-1]]
            core = _pack(
                owner=owner.astype(np.uint32), where=where.astype(np.uint32), counts=counts.astype(np.uint32 if counts.max() < 1 << 32 else np.uint64),
                words=np.array([len(types)]), groups=groups, cuts=cuts,
            )
            placed = _pack(chunks=chunks, ends=np.cumsum([0, *(len(p["where"]) for _, p in parts)]), place=place.astype(np.uint32))
            asked = _pack(types=types, chunks=chunks, ends=np.cumsum([0, *(len(p["types"]) for _, p in parts)]), at=at.astype(np.uint32))
            customers = np.bincount(where, weights=counts, minlength=len(heads)).astype(np.uint64)
            tables = np.bincount(where, weights=counts > 0, minlength=len(heads)).astype(np.uint32)
            known = np.bincount(owner, weights=counts, minlength=len(types)) > 0
            yield from _rows(
                [
                    ("sums", part, 0, b"", [float(counts.sum()), float(known.sum()), float(tables.sum())]),
                    ("core", part, -2, core, None), ("place", part, -1, placed, None), ("asked", part // GROUP, part, asked, None),
                    *_sliced(part, groups, cuts, heads=heads, customers=customers, tables=tables),
                ]
            )

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A group's contexts: what all ranges have of them together, told to each of these ranges, and an
    index of the ranges' and the chunks' contexts for later rounds."""
    for group, rows in _segments(batches):
        sent, asked = [], []
        for part, blob in rows:
            found = _unpack(blob)
            (sent if "heads" in found else asked).append((part, found))
        rows.clear()
        heads, at = np.unique(np.concatenate([f["heads"] for _, f in sent]), return_inverse=True)
        customers, tables = (np.bincount(at, weights=np.concatenate([f[k] for _, f in sent]), minlength=len(heads)) for k in ("customers", "tables"))
        parts, ends = np.array([p for p, _ in sent]), np.cumsum([0, *(len(f["heads"]) for _, f in sent)])
        chunks: dict[int, list[np.ndarray]] = {}
        for _, f in asked:
            place = np.searchsorted(heads, f["types"])
            for c, a, b in zip(f["chunks"].tolist(), f["ends"][:-1], f["ends"][1:]):
                chunks.setdefault(c, []).append(place[f["at"][a:b]])
        for_chunks = [np.concatenate(x) for x in chunks.values()]
        index = _pack(
            customers=customers.astype(np.uint64), parts=parts, ends=ends, at=at.astype(np.uint32), chunks=np.array(list(chunks)),
            chunk_ends=np.cumsum([0, *map(len, for_chunks)]), chunk_at=np.concatenate([np.zeros(0), *for_chunks]).astype(np.uint32),
        )
        yield from _rows([("index", group, -1, index, None)])
        yield from _rows(_told(group, parts, ends, at, customers, tables))


def _told(group: int, parts: np.ndarray, ends: np.ndarray, at: np.ndarray, customers: np.ndarray, tables: np.ndarray) -> list[tuple]:
    customers, tables = customers.astype(np.uint64), tables.astype(np.uint64)
    return [
        ("told", p, group, _pack(customers=customers[at[a:b]], tables=tables[at[a:b]]), None) for p, a, b in zip(parts.tolist(), ends[:-1], ends[1:])
    ]


def _exchange(last: bool):
    """A group's tables by context, summed over the ranges; in the end they go to the chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in _segments(batches):
            m = _unpack(rows[0][1])
            tables, sent = np.zeros(len(m["customers"])), dict(rows[1:])
            for p, a, b in zip(m["parts"].tolist(), m["ends"][:-1], m["ends"][1:]):
                tables[m["at"][a:b]] += _unpack(sent.pop(p))["tables"]
            if last:
                found = tables.astype(np.float32)
                cuts = zip(m["chunks"].tolist(), m["chunk_ends"][:-1], m["chunk_ends"][1:])
                yield from _rows([("backs", c, group, _pack(tables=found[m["chunk_at"][a:b]]), None) for c, a, b in cuts])
            else:
                yield from _rows(_told(group, m["parts"], m["ends"], m["at"], m["customers"], tables))

    return run


@dataclass(frozen=True)
class Totals:
    """What ranges share. By context: customers in all ranges, and tables at the start of the round. Over
    all ranges: tokens, types, tables of all contexts and of the parent, both at the start of the round."""

    customers: np.ndarray
    tables: np.ndarray
    tokens: int
    types: int
    all_tables: float | None = None
    root_tables: float | None = None


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, six places further up, where it is exact to 1e-9."""
    z = x + 6.0
    return (z - 0.5) * np.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3) - np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))


@cache
def _ways() -> tuple[np.ndarray, np.ndarray]:
    """log S(c, t), the weight of all seatings of c customers at t tables, for c up to EXACT, and for c = FITTED."""
    t, row, held = np.arange(FITTED + 1), np.full(FITTED + 1, -np.inf), np.full((EXACT + 1, EXACT + 1), -np.inf)
    row[1] = 0.0
    for c in range(1, FITTED):
        if c <= EXACT:
            held[c] = row[: EXACT + 1]
        room = np.log(np.maximum(c - DISCOUNT * t, 1e-300))
        row = np.logaddexp(np.concatenate([[-np.inf], row[:-1]]), np.where(t <= c, room + row, -np.inf))
    return held, row


@cache
def _saddle() -> tuple[np.ndarray, ...]:
    """log(c / t - 1) in ascending order; the exponent for a table and log curvature there."""
    y = np.linspace(-20.0, 40.0, 60_001)
    log_u, s = -np.logaddexp(0.0, y), -np.logaddexp(0.0, -y)
    u, x = np.exp(log_u), np.exp(s)
    f = -np.expm1(DISCOUNT * log_u)
    rho = DISCOUNT * x * np.exp((DISCOUNT - 1) * log_u) / f
    bend = rho * (1 + (1 - DISCOUNT) * x / u - rho)
    return np.log(rho - 1), np.log(f) - rho * s, np.log(bend)


def _near(count: np.ndarray, t: np.ndarray) -> np.ndarray:
    """log S(count, t) by the saddle point of its generating function, without its error's correction."""
    at, power, bend = _saddle()
    place = np.log(np.maximum(count / t - 1, 1e-300))
    return _log_gamma(count + 1.0) - _log_gamma(t + 1.0) + t * (np.interp(place, at, power) - np.log(DISCOUNT)) - 0.5 * (
        np.log(2 * np.pi * t) + np.interp(place, at, bend)
    )


@cache
def _error() -> tuple[np.ndarray, np.ndarray]:
    """The saddle point's error by log(t / c ** DISCOUNT), on which alone it depends in long runs."""
    t = np.unique(np.geomspace(1, FITTED * 0.9, 400).astype(np.int64)).astype(float)
    return np.log(t / FITTED**DISCOUNT), _near(np.full(len(t), float(FITTED)), t) - _ways()[1][t.astype(np.int64)]


def log_ways(count: np.ndarray, t: np.ndarray) -> np.ndarray:
    """log S(count, t) for counts over EXACT."""
    at, error = _error()
    place = np.log(t) - DISCOUNT * np.log(count)
    fix = np.interp(place, at, error) + np.minimum(place - at[0], 0.0)
    return np.where(t >= count, 0.0, _near(count, t) - fix)


def draw_tables(
    random: np.random.Generator, count: np.ndarray, t: np.ndarray, others: np.ndarray, served: np.ndarray, root: np.ndarray, rounds: int = 1
) -> np.ndarray:
    """Tables of each pair when all its ``count`` customers are seated anew, given the other pairs.

    ``others`` are the context's other tables; after the first, a new table's base weight is
    (served + tables so far) / (root + tables so far). Counts up to EXACT are drawn from the whole
    distribution, larger ones by ``rounds`` slices from ``t``, over the whole range of tables."""
    out = t.copy()
    small = np.flatnonzero((count > 1) & (count <= EXACT))
    small = small[np.argsort(count[small], kind="stable")]
    at = 0
    while at < len(small):
        # rows of about equal counts, a bounded grid
        stop = min(len(small), at + 200_000 // EXACT)
        stop = min(len(small), max(stop, at + 200_000 // int(count[small[stop - 1]])))
        part = small[at:stop]
        while len(part) > 1 and len(part) * int(count[part[-1]]) > 400_000:
            part = part[: len(part) // 2]
        wide = int(count[part[-1]])
        j = np.arange(1.0, wide)
        o, v, r = others[part, None], served[part, None], root[part, None]
        grown = np.log((STRENGTH + DISCOUNT * (o + j)) * (v + j) / (r + j))
        weight = _ways()[0][count[part], 1 : wide + 1]
        weight[:, 1:] += np.cumsum(grown, axis=1)
        total = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
        out[part] = 1 + (total < random.random((len(part), 1)) * total[:, -1:]).sum(axis=1)
        at += len(part)
    large = np.flatnonzero(count > EXACT)
    if len(large):
        c, o, v, r = (x[large].astype(float) for x in (count, others, served, root))

        def height(y: np.ndarray, i: np.ndarray) -> np.ndarray:
            n = np.clip(np.floor(np.exp(y)), 1.0, c[i])
            base = _log_gamma(STRENGTH / DISCOUNT + o[i] + n) + n * np.log(DISCOUNT) + _log_gamma(v[i] + n) - _log_gamma(r[i] + n)
            return base + log_ways(c[i], n) + y

        now = np.log(out[large] + random.random(len(large)))
        for _ in range(rounds):
            every = np.arange(len(large))
            level = height(now, every) - random.exponential(size=len(large))
            low, high, left, fresh = np.zeros(len(large)), np.log(c + 1), every, now.copy()
            while len(left):
                y = low[left] + random.random(len(left)) * (high[left] - low[left])
                fits = (height(y, left) >= level[left]) | (high[left] - low[left] < 1e-12)
                fresh[left[fits]] = y[fits]
                left, y = left[~fits], y[~fits]
                below = y < now[left]
                low[left[below]], high[left[~below]] = y[below], y[~below]
            now = fresh
        out[large] = np.clip(np.floor(np.exp(now)), 1, c).astype(out.dtype)
    return out


class Seating:
    """The restaurants of one range of words. The number of tables of a pair is sampled; their sizes
    matter to no probability and are summed out."""

    def __init__(
        self, owner: np.ndarray, where: np.ndarray, counts: np.ndarray, words: int, totals: Totals, seed: int | list[int],
        tables: np.ndarray | None = None, root_tables: np.ndarray | None = None,
    ):
        self.owner, self.where, self.counts, self.words, self.totals = owner, where, counts, words, totals
        self.random = np.random.default_rng(seed)
        self.seated = np.flatnonzero(counts > 0)
        self.tables = np.ones(len(self.seated), dtype=np.int64) if tables is None else tables.astype(np.int64)
        #: tables at the start of the round, when the totals were taken
        self.first = np.bincount(where[self.seated], weights=self.tables, minlength=len(totals.customers))
        #: contexts of about one size have about as many tables a pair
        self.sizes = np.log2(totals.customers + 1).astype(np.int64)
        self.root_tables = np.zeros(words, dtype=np.int64) if root_tables is None else root_tables.astype(np.int64)
        self.first_root = max(1, int(self.root_tables.sum()))
        self.rounds = FIRST_ROUNDS if tables is None else 1
        if root_tables is None:
            self.seat_parent()

    @property
    def of(self) -> np.ndarray:
        """The pair of each table."""
        return np.repeat(self.seated, self.tables)

    @property
    def size(self) -> np.ndarray:
        """One way to fill the tables, not a sampled one: all but a pair's first have one customer."""
        size = np.ones(int(self.tables.sum()), dtype=np.int64)
        size[np.cumsum(self.tables) - self.tables] += self.counts[self.seated] - self.tables
        return size

    def per_pair(self) -> np.ndarray:
        found = np.zeros(len(self.owner), dtype=np.int64)
        found[self.seated] = self.tables
        return found

    def root_customers(self) -> np.ndarray:
        return np.bincount(self.owner[self.seated], weights=self.tables, minlength=self.words).astype(np.int64)

    def context_tables(self) -> np.ndarray:
        """Tables in the whole context restaurants, as this range's share says they have changed: of its
        own pairs there, and of those in contexts of the same size."""
        own = np.bincount(self.where[self.seated], weights=self.tables, minlength=len(self.first))
        alike = (np.bincount(self.sizes, weights=own) + 1e-9) / (np.bincount(self.sizes, weights=self.first) + 1e-9)
        return self.totals.tables * ((own + PRIOR * alike[self.sizes]) / (self.first + PRIOR))

    def _root(self) -> tuple[float, float]:
        """Customers and tables of the parent over all ranges, as this range's share says they have changed."""
        whole = self.totals.tables.sum() if self.totals.all_tables is None else self.totals.all_tables
        scale = whole / max(1.0, self.first.sum())
        root = scale if self.totals.root_tables is None else self.totals.root_tables / self.first_root
        return float(self.tables.sum()) * scale, float(self.root_tables.sum()) * root

    def seat_parent(self) -> None:
        """Seat the parent's customers anew, one of each word at a time; those who join are skipped over."""
        customers = self.root_customers()
        tables = np.minimum(customers, 1)
        fresh = (ROOT_STRENGTH + ROOT_DISCOUNT * max(1.0, self._root()[1])) / (self.totals.types + 1)
        left = np.flatnonzero(customers > 1)
        k = np.ones(len(left))
        while len(left):
            # customers until one opens a table: an urn's waiting time, geometric with a beta chance
            chance = np.clip(self.random.beta(fresh, k - ROOT_DISCOUNT * tables[left]), 1e-300, 1 - 1e-16)
            k = k + np.maximum(1.0, np.ceil(np.log1p(-self.random.random(len(left))) / np.log1p(-chance)))
            opens = k <= customers[left]
            left, k = left[opens], k[opens]
            tables[left] += 1
        self.root_tables = tables

    def parent(self) -> np.ndarray:
        """Probability of each word under the parent."""
        customers, tables = self._root()
        mass = (ROOT_STRENGTH + ROOT_DISCOUNT * tables) / (self.totals.types + 1)
        return (self.root_customers() - ROOT_DISCOUNT * self.root_tables + mass) / (ROOT_STRENGTH + customers)

    def sweep(self) -> None:
        """All customers of every pair leave and are seated again; pairs move side by side."""
        if not len(self.seated):
            return
        owner, own = self.owner[self.seated], self.tables
        customers, tables = self._root()
        mass = (ROOT_STRENGTH + ROOT_DISCOUNT * tables) / (self.totals.types + 1)
        whole = self.root_customers()[owner]
        rest = whole - own
        # the parent's tables of the word without this pair's customers: they grow as a power of its customers
        left = self.root_tables[owner] * (rest / np.maximum(whole, 1)) ** ROOT_DISCOUNT
        served = rest - ROOT_DISCOUNT * np.clip(left, np.minimum(rest, 1), rest) + mass
        others = np.maximum(self.context_tables()[self.where[self.seated]] - own, 0.0)
        root = ROOT_STRENGTH + np.maximum(customers - own, 0.0)
        self.tables = draw_tables(self.random, self.counts[self.seated], own, others, served, root, self.rounds)
        self.rounds = 1


def _sample(turn: int, tokens: int, types: int, all_tables: float, root_tables: float | None):
    """A round of Gibbs passes over each range; after the last, what every chunk needs to score its pairs."""
    begin, last = sum(ROUNDS[:turn]), turn == len(ROUNDS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _segments(batches):
            m, told = _unpack(rows[0][1]), [_unpack(blob) for other, blob in rows if other >= 0]
            placed = rows[1][1] if last else b""
            rows.clear()
            customers, tables = (np.concatenate([t[k] for t in told]).astype(np.int64) for k in ("customers", "tables"))
            totals = Totals(customers, tables, tokens, types, all_tables, root_tables)
            owner, where, counts, words = m["owner"].astype(np.int64), m["where"].astype(np.int64), m["counts"].astype(np.int64), int(m["words"][0])
            groups, cuts = m["groups"], m["cuts"]
            seating = Seating(owner, where, counts, words, totals, [part, turn], m.get("tables"), m.get("root"))
            tables, customers, root, kept = np.zeros(len(owner)), np.zeros(words), np.zeros(words), 0
            for done in range(begin, begin + ROUNDS[turn]):
                seating.sweep()
                if done % ROOT_EVERY == ROOT_EVERY - 1:
                    seating.seat_parent()
                if last:
                    kept += 1
                    tables += seating.per_pair()
                    customers += seating.root_customers()
                    root += np.minimum(seating.root_tables, seating.root_customers())
            if not last:
                own = np.bincount(where, weights=seating.per_pair(), minlength=len(seating.first)).astype(np.uint64)
                m |= {"tables": seating.tables.astype(np.uint64), "root": seating.root_tables.astype(np.uint64)}
                sums = [float(seating.tables.sum()), float(seating.root_tables.sum())]
                yield from _rows([("sums", part, 0, b"", sums), ("core", part, -2, _pack(**m), None), *_sliced(part, groups, cuts, tables=own)])
                continue
            tables, customers, root = tables / kept, customers / kept, root / kept
            weight = (counts - DISCOUNT * tables).astype(np.float32)
            parent = (customers - ROOT_DISCOUNT * root).astype(np.float32)
            total = np.bincount(owner, weights=counts, minlength=words).astype(np.uint64)
            own = np.bincount(where, weights=tables, minlength=len(seating.first)).astype(np.float32)
            yield from _rows([("sums", part, 0, b"", [float(customers.sum()), float(root.sum())]), *_sliced(part, groups, cuts, tables=own)])
            del seating, tables, told
            m = _unpack(placed)
            rows = []
            for c, a, b in zip(m["chunks"].tolist(), m["ends"][:-1], m["ends"][1:]):
                at = m["place"][a:b]
                own = owner[at]
                own = own[np.flatnonzero(np.diff(own, prepend=-1))]  # a chunk's words of this range, in their order
                rows.append(("stats", c, part, _pack(weight=weight[at], parent=parent[own], total=total[own]), None))
            yield from _rows(rows)

    return run


_SCORED = "n_tokens bigint, n_known bigint, base_score double, score double"


def _score(ranges: int, tokens: int, types: int, root: tuple[float, float]):
    """Texts' scores: a chunk's documents come first, then its pairs' statistics, range by range, then its
    contexts' tables, group by group. A word is followed as often as it occurs, so that its count is its
    number of customers as a context, and the end's count that of the start."""
    root_room = ROOT_STRENGTH + root[0]
    unseen = (ROOT_STRENGTH + ROOT_DISCOUNT * root[1]) / root_room / (types + 1)
    base_room = tokens + types + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _segments(batches):
            docs = _unpack(rows[0][1])
            stats = [_unpack(blob) for other, blob in rows[1:] if other < ranges]
            tables = np.concatenate([_unpack(blob)["tables"] for other, blob in rows[1:] if other >= ranges]).astype(np.float64)
            rows.clear()
            weight, parent, total = (np.concatenate([s[k] for s in stats]).astype(np.float64) for k in ("weight", "parent", "total"))
            sizes = docs["sizes"].astype(np.int64)
            owner, where, stream = _pairs(docs["at"].astype(np.int64), sizes)
            room = STRENGTH + total
            back = (STRENGTH + DISCOUNT * tables) / room
            model = np.log10(weight / room[where] + back[where] * (parent / root_room + unseen)[owner])
            base = np.log10((total + 1) / base_room)[owner]
            begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            sums = [np.add.reduceat(x[stream], begin) for x in (base, model)]
            known = np.add.reduceat((total > 0)[docs["at"]].astype(np.int64), begin)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs["ids"].tolist(), pa.int64()), pa.array(sizes), pa.array(known), *map(pa.array, sums)],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    return run


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class _Kept:
    """Rows in the shared folder, a folder for each kind, so that each kind can go once it has been read.

    Shuffle files go as soon as their rows are written; Spark alone keeps them until the driver collects
    garbage."""

    def __init__(self, rows: DataFrame):
        self.spark, self.path = rows.sparkSession, scratch_path(rows.sparkSession, "seating")
        self.add(rows)

    def add(self, rows: DataFrame) -> None:
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            rows.write.mode("append").partitionBy("kind").option("compression", "uncompressed").parquet(self.path)
        finally:
            self.spark.conf.unset(_CLEANUP) if before is None else self.spark.conf.set(_CLEANUP, before)
        self.rows = self.spark.read.schema(_ROWS).parquet(self.path)

    def of(self, *kinds: str) -> DataFrame:
        return self.rows.where(F.col("kind").isin(*kinds)).select("to", "other", "blob")

    def sums(self, many: int) -> list[float]:
        each = [F.coalesce(F.sum(F.get("sums", F.lit(i))), F.lit(0.0)) for i in range(many)]
        return list(self.rows.where("kind = 'sums'").agg(*each).first())

    def drop(self, *kinds: str) -> None:
        for kind in kinds:
            delete(self.spark, f"{self.path}/kind={kind}")


def score(df: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity of every document; the
    model learns from the rows where ``train`` holds."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(train, F.lit(True)).alias("train"))
    ranges = max(1, -(-df.count() // RANGE_DOCS))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, "to").sortWithinPartitions("to", "other")

    slices = min(SLICES, -(-ranges // SLICE))
    sliced = F.concat("kind", F.floor(F.col("to") * slices / ranges).cast("string"))
    made = _Kept(rows.mapInArrow(_count(ranges), _ROWS).withColumn("kind", F.when(F.col("kind") == "pairs", sliced).otherwise(F.col("kind"))))
    for k in range(slices):
        found = dealt(made.of(f"pairs{k}")).mapInArrow(_merge(ranges), _ROWS)
        if k:
            merged.add(found)
        else:
            merged = _Kept(found)
        made.drop(f"pairs{k}")
    tokens, types, all_tables = merged.sums(3)
    tokens, types, root_tables = int(tokens), int(types), None
    met = told = _Kept(dealt(merged.of("sent", "asked")).mapInArrow(_meet, _ROWS))
    merged.drop("sent", "asked")
    state = merged
    for turn in range(len(ROUNDS)):
        last = turn == len(ROUNDS) - 1
        seated = state.of("core").unionByName(told.of("told"))
        if last:
            seated = seated.unionByName(merged.of("place"))
        fresh = _Kept(dealt(seated).mapInArrow(_sample(turn, tokens, types, all_tables, root_tables), _ROWS))
        state.drop("core")
        told.drop("told")
        state = fresh
        all_tables, root_tables = state.sums(2)
        told = _Kept(dealt(met.of("index").unionByName(state.of("sent"))).mapInArrow(_exchange(last), _ROWS))
        state.drop("sent")
    merged.drop("place")
    met.drop("index")
    backs = told.of("backs").withColumn("other", F.col("other") + ranges)
    back = made.of("docs").unionByName(state.of("stats")).unionByName(backs)
    found = dealt(back).mapInArrow(_score(ranges, tokens, types, (all_tables, root_tables)), f"doc_id bigint, {_SCORED}")
    return found.select(
        "*", F.lit(tokens).cast("long").alias("train_tokens"), F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return score(docs, fold("doc_id", 7) != 2).select(
        "doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )
