"""Sections, passages, chunks and mentions: the steps of a text that need its order."""

from __future__ import annotations

import ast
import difflib
import operator
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _mapped(df: DataFrame, text: str, made: str, rows) -> DataFrame:
    """Each row as many times as ``rows(text)`` has tuples; no shuffle, one Arrow batch at a time."""
    schema = StructType(df.schema.fields + StructType.fromDDL(made).fields)
    types = pa.schema([pa.field(f.name, {"string": pa.string(), "int": pa.int32()}[f.dataType.simpleString()]) for f in StructType.fromDDL(made)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for i, value in enumerate(batch.column(batch.schema.get_field_index(text)).to_pylist()):
                for row in rows(value or ""):
                    at.append(i)
                    found.append(row)
            columns = list(zip(*found)) or [()] * len(types)
            taken = [c.take(pa.array(at, pa.int32())) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*taken, *[pa.array(c, t.type) for c, t in zip(columns, types)]], names=schema.names)

    return df.mapInArrow(run, schema)


# Characters of the shortest paragraph, the longest passage, the overlap of chunks and the longest section.
LEAST, MOST, OVERLAP, SECTION = 80, 1800, 240, 180_000


def packed_passages(text: str, least: int = LEAST, most: int = MOST) -> list[tuple[int, str]]:
    """Paragraphs of some length, which blank lines part, cut between sentences so that a passage stays below ``most``."""
    out: list[tuple[int, str]] = []
    for paragraph in re.split(r"\n\s*\n", text):
        paragraph = " ".join(paragraph.split())
        if len(paragraph) < least:
            continue
        held = ""
        for sentence in re.split(r"(?<=[.!?]) +", paragraph):
            if held and len(held) + 1 + len(sentence) > most:
                out.append((len(out), held))
                held = sentence
            else:
                held = f"{held} {sentence}".strip()
        out.append((len(out), held))
    return out


def passages(df: DataFrame, text: str = "text", least: int = LEAST, most: int = MOST) -> DataFrame:
    return _mapped(df, text, "passage int, body string", lambda t: packed_passages(t, least, most))


def overlapping(text: str, size: int = MOST, overlap: int = OVERLAP) -> list[tuple[int, str]]:
    """Windows of ``size`` characters, each beginning ``overlap`` before the last one ended, cut at blanks where possible."""
    out, at = [], 0
    while at < len(text):
        end = min(at + size, len(text))
        if end < len(text):
            blank = text.rfind(" ", at + size // 2, end)
            end = blank if blank > 0 else end
        out.append((len(out), text[at:end]))
        if end == len(text):
            break
        at = max(end - overlap, at + 1)
    return out


def chunks(df: DataFrame, text: str = "text", size: int = MOST, overlap: int = OVERLAP) -> DataFrame:
    return _mapped(df, text, "chunk int, body string", lambda t: overlapping(t, size, overlap))


def sections(df: DataFrame, headings: dict[str, str], text: str = "text", skip: int = 0, least: int = 0, most: int | None = SECTION) -> DataFrame:
    """Named sections: each begins at its heading's first match after ``skip`` (else its first) and ends at the next one.

    A body is cut at ``most`` characters; with None it is whole."""
    patterns = {name: re.compile(p) for name, p in headings.items()}

    def split(value: str) -> list[tuple[str, int, str]]:
        starts = []
        for name, pattern in patterns.items():
            hits = [m.start() for m in pattern.finditer(value)]
            if hits:
                starts.append((next((h for h in hits if h >= skip), hits[0]), name))
        starts.sort()
        ends = [s for s, _ in starts[1:]] + [len(value)]
        return [(n, s, value[s:e][:most]) for (s, n), e in zip(starts, ends) if e - s >= least]

    return _mapped(df, text, "section string, start int, body string", split)


def greedy_spans(spans: Sequence[tuple[int, int]]) -> list[int]:
    """Indexes of the spans that are kept when each must not overlap one kept before it."""
    kept: list[int] = []
    for i, (a, b) in enumerate(spans):
        if all(b <= spans[k][0] or a >= spans[k][1] for k in kept):
            kept.append(i)
    return kept


def sequence_ratio(a: Column, b: Column) -> Column:
    """Similarity of two strings by their longest matching blocks, 0 to 1."""

    @F.pandas_udf("double")
    def ratio(x, y):
        return x.combine(y, lambda p, q: difflib.SequenceMatcher(None, p or "", q or "").ratio())

    return ratio(a, b)


_OPERATORS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv}


def evaluate(expression: str | None) -> float | None:
    """Value of an arithmetic expression of numbers, signs, + - * / and small powers; None for anything else."""

    def value(node: ast.AST) -> float:
        if isinstance(node, ast.Expression):
            return value(node.body)
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)) and not isinstance(node.value, bool):
            return float(node.value)
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.UAdd, ast.USub)):
            return value(node.operand) * (-1 if isinstance(node.op, ast.USub) else 1)
        if isinstance(node, ast.BinOp):
            a, b = value(node.left), value(node.right)
            if isinstance(node.op, ast.Pow) and abs(b) <= 12:
                return a**b
            return _OPERATORS[type(node.op)](a, b)
        raise ValueError

    try:
        out = value(ast.parse((expression or "").replace("^", "**"), mode="eval"))
        return out if isinstance(out, float) else None
    except (ValueError, KeyError, SyntaxError, ZeroDivisionError, OverflowError, RecursionError, MemoryError):
        return None


def evaluated(c: Column) -> Column:
    @F.pandas_udf("double")
    def run(x):
        return x.map(evaluate).astype("float64")

    return run(c)
