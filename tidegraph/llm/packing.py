"""Packing token streams into sequences: first-fit decreasing over a tournament tree of bin capacities.

Documents are cut into full sequences and one remainder. A full sequence is packed as it is. The
remainders are dealt at random into groups, one a document at most, so a group's size follows from
the number of documents however long they are; each group is packed by itself, largest piece first,
into the first bin with room. The tree keeps the largest free capacity below each node, so finding
that bin takes log n steps.

Defined cases: a null or empty text is one piece that holds the end id alone. A text of any length is
cut into as many pieces as it needs; one row must fit a worker. A special token's string in a text
becomes that token, as the library has it. Repeated rows are packed as often as they occur; pieces of
equal length (ties) keep the order in which the group has them. An empty table has no pieces. Other
columns, whatever their names, are not carried."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import documents, materialise
from tidegraph.llm.tokenization import PieceTokenizer, portions

TOKENIZER, END = public_tokenizers.path("word_bpe_49k.json"), 1
#: Tokens in a sequence; remainders expected in a group. The ids of full sequences lie above FULL.
LENGTH, GROUP, FULL = 2048, 4096, 1 << 62


class TournamentTree:
    """Bins 0, 1, ... all of the same capacity; ``place`` uses the first one with room."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.free = [capacity] * (2 * self.leaves)
        self.capacity = capacity

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) of an item that fits into an empty bin."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        offset = self.capacity - free[node]
        free[node] -= size
        bin_, node = node - self.leaves, node // 2
        while node:
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
            node //= 2
        return bin_, offset


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item; ties keep their order."""
    tree = TournamentTree(max(1, len(sizes)), capacity)
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        bins[i], offsets[i] = tree.place(sizes[i])
    return bins, offsets


def pieces(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, end: int = END, length: int = LENGTH) -> DataFrame:
    """Pieces of every document: full sequences, then the remainder, with the crc of their ids."""
    rows = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    key_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceTokenizer.at(tokenizer)
        for whole in batches:
            texts = whole.column(1).to_pylist()
            for portion in portions(texts):
                row, start, size, crc, total = [], [], [], [], []
                for i, ids in enumerate(codec.encode(texts[portion], end), start=portion.start):
                    for first in range(0, len(ids), length):
                        part = ids[first : first + length]
                        row.append(i)
                        start.append(first)
                        size.append(len(part))
                        crc.append(zlib.crc32(part.astype("<u4").tobytes()))
                        total.append(len(ids))
                columns = [pa.array(x, pa.int64()) for x in (start, size, crc, total)]
                yield pa.RecordBatch.from_arrays(
                    [whole.column(0).take(pa.array(row, pa.int32())), *columns],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    return rows.mapInArrow(run, f"doc_id {key_type}, start long, length long, ids_crc32 long, doc_tokens long")


def pack(items: DataFrame, groups: int, length: int = LENGTH) -> DataFrame:
    """``items`` (with a ``length`` column) with ``sequence_id`` and ``offset``.

    An item that fills a sequence has one of its own, numbered by its place in the input, and isn't
    shuffled. The group of any other row comes from a hash of that place, so rows that are equal do
    not meet in one group. A sequence's id is its group and its bin."""
    placed = items.withColumn("__place", F.monotonically_increasing_id())
    full = placed.where(F.col("length") >= length).withColumns({"sequence_id": F.col("__place") + F.lit(FULL), "offset": F.lit(0).cast("long")})
    dealt = placed.where(F.col("length") < length).withColumn("__group", F.pmod(F.xxhash64("__place"), F.lit(groups))).drop("__place")
    schema = items.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema

    def run(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = first_fit_decreasing(rows["length"].tolist(), length)
        rows = rows.drop(columns="__group")
        return rows.assign(sequence_id=int(group[0]) * (1 << 32) + np.array(bins, dtype=np.int64), offset=np.array(offsets, dtype=np.int64))

    return dealt.groupBy("__group").applyInPandas(run, schema).unionByName(full.drop("__place"))


def pack_documents(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, end: int = END, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Every document's pieces with their places in sequences of ``length`` tokens."""
    groups = max(1, -(-df.count() // group))
    # pieces are read twice, as full ones and remainders; encoding is worth keeping
    return pack(materialise(pieces(df, key, text, tokenizer, end, length), "pieces"), groups, length)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir).select("doc_id", "text"))
