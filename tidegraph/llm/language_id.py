"""Language identification by cross-parsing entropy.

Each language keeps a suffix automaton of a labelled sample. A text is parsed greedily into the
longest phrases that occur in that sample; a language whose sample explains the text needs few
phrases. The language with the fewest phrases per character wins. Texts are read as the UTF-8 bytes
of their lower-cased letters, so any script has its whole alphabet; a byte that a sample doesn't hold
is a phrase of its own.

Bounds, which concern the labelled sample alone: SAMPLE_DOCS documents a language, of each a window
of WINDOW characters at a place that its id's hash chooses, and of these SAMPLE_BYTES bytes a
language, or an equal share of TOTAL_BYTES with more than ten languages.

Defined cases: a null text, or one without a letter, is ``und`` with score 0. A text of any length is
parsed whole. Ties go to the language that sorts first. Without any labelled text every document is
``und``. Repeated rows are predicted alike; other columns pass through untouched, and columns of the
names that are made here are replaced."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm.common import documents, fold

UNDETERMINED = "und"
#: Documents sampled per language, characters of each, bytes of all per language and in all languages.
SAMPLE_DOCS, WINDOW, SAMPLE_BYTES, TOTAL_BYTES = 128, 8000, 40_000, 400_000
#: A parse restarts every BLOCK bytes, so that long texts run in parallel lanes.
BLOCK, LANES = 2048, 4096
_PAD, _UNSEEN, _SPACE = 0, 1, 32


@dataclass(frozen=True)
class PhraseModel:
    """Automata of all languages in one transition table.

    ``table[state + code]`` is the next state, where a state is the place of its row. A negative entry
    is minus the state in which the next phrase begins, so each negative step counts one phrase."""

    languages: tuple[str, ...]
    table: np.ndarray
    starts: np.ndarray
    codes: np.ndarray  # by language, the code of each byte; 0 is beyond a text's end


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts all substrings; state 0 is the root."""
    step, link, length, last = [{}], [-1], [0], 0
    for symbol in symbols:
        current = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and symbol not in step[at]:
            step[at][symbol] = current
            at = link[at]
        if at >= 0:
            seen = step[at][symbol]
            if length[seen] == length[at] + 1:
                link[current] = seen
            else:
                clone = len(step)
                step.append(dict(step[seen]))
                link.append(link[seen])
                length.append(length[at] + 1)
                while at >= 0 and step[at].get(symbol) == seen:
                    step[at][symbol] = clone
                    at = link[at]
                link[seen] = link[current] = clone
        last = current
    return step


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    found = np.zeros(0x110000, dtype=bool)
    found[[i for i in range(0x110000) if chr(i).isalpha()]] = True
    return found


_LETTER: list[np.ndarray] = []
_ASCII = bytes(b if chr(b).isalpha() and b < 128 else _SPACE for b in range(256))


def _symbols(text: str) -> np.ndarray:
    """UTF-8 bytes of the text's lower-case letters, all else one space, runs of spaces merged."""
    lower = text.lower()
    if lower.isascii():
        points = np.frombuffer(lower.encode().translate(_ASCII), dtype=np.uint8)
    else:
        if not _LETTER:
            _LETTER.append(_letters())
        points = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        points = np.where(_LETTER[0][points], points, np.uint32(_SPACE))
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = (points[1:] != _SPACE) | (points[:-1] != _SPACE)
    points = points[keep]
    if points.dtype == np.uint8:
        return points
    return np.frombuffer(points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def build_model(samples: dict[str, list[str]]) -> PhraseModel | None:
    """Automata from labelled texts, in the driver: its size is bounded by TOTAL_BYTES."""
    samples = {k: [t for t in v if t] for k, v in samples.items()}
    languages = tuple(sorted(k for k, v in samples.items() if v))
    if not languages:
        return None
    budget = max(500, min(SAMPLE_BYTES, TOTAL_BYTES // len(languages)))
    blocks, starts, codes, base = [np.zeros(1, dtype=np.int64)], [], [], 1
    for language in languages:
        share = max(200, 2 * budget // len(samples[language]))
        joined: list[np.ndarray] = []
        for text in samples[language]:
            if sum(map(len, joined)) < budget:
                joined.append(_symbols(text)[:share])
        data = np.concatenate(joined)[:budget]
        seen = np.unique(data)
        code = np.full(256, _UNSEEN, dtype=np.uint8)
        code[seen] = np.arange(2, 2 + len(seen))
        code[_PAD] = _PAD
        width = 2 + len(seen)
        step = suffix_automaton(code[data].tolist())
        dead, root = base, base + width  # dead: no phrase is open
        begin = np.full(width, dead, dtype=np.int64)
        for symbol, target in step[0].items():
            begin[symbol] = root + target * width
        rows = np.tile(-begin, (len(step) + 1, 1))
        for state, moves in enumerate(step):
            for symbol, target in moves.items():
                rows[state + 1, symbol] = root + target * width
        rows[:, _PAD] = dead
        blocks.append(rows.ravel())
        starts.append(dead)
        codes.append(code)
        base += rows.size
    return PhraseModel(languages, np.concatenate(blocks).astype(np.int32), np.array(starts, dtype=np.int32), np.array(codes))


def count_phrases(model: PhraseModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases by text and language, and the number of bytes parsed (0: no letter)."""
    lanes, owner, parsed = [], [], np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        coded = _symbols(text)
        if (coded != _SPACE).any():
            parsed[i] = len(coded)
            for at in range(0, len(coded), BLOCK):
                lanes.append(coded[at : at + BLOCK])
                owner.append(i)
    phrases = np.zeros((len(texts), len(model.languages)), dtype=np.int64)
    order = sorted(range(len(lanes)), key=lambda i: len(lanes[i]))
    group = max(16, LANES * 4 // len(model.languages))
    for at in range(0, len(order), group):
        part = order[at : at + group]
        longest = len(lanes[part[-1]])
        grid = np.zeros((len(part), longest), dtype=np.uint8)
        for row, i in enumerate(part):
            grid[row, : len(lanes[i])] = lanes[i]
        grid = np.ascontiguousarray(grid.T)
        state = np.repeat(model.starts[:, None], len(part), axis=1)
        found = np.zeros(state.shape, dtype=np.int32)
        for column in grid:
            state = model.table[state + model.codes[:, column]]
            found -= state >> 31
            np.abs(state, out=state)
        np.add.at(phrases, np.array([owner[i] for i in part]), found.T)
    return phrases, parsed


def predict(df: DataFrame, model: PhraseModel | None, text: str = "text", lang_to: str = "lang_pred", score_to: str = "score") -> DataFrame:
    """``df`` with the predicted language, its probability-like score (0 to 1) and phrases per character.

    Columns of these names are replaced."""
    rate_to = f"{score_to}_phrase_rate"
    df = df.drop(lang_to, score_to, rate_to)
    if model is None:
        return df.withColumns({lang_to: F.lit(UNDETERMINED), score_to: F.lit(0.0), rate_to: F.lit(None).cast("double")})
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = df.select(
        "*", F.lit("").cast("string").alias(lang_to), F.lit(0.0).alias(score_to), F.lit(None).cast("double").alias(rate_to)
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            phrases, parsed = count_phrases(m, texts)
            best = phrases.argmin(axis=1) if len(texts) else np.zeros(0, dtype=int)
            gap = phrases - phrases.min(axis=1, keepdims=True) if len(texts) else phrases
            score = 1.0 / np.exp(-gap.astype(float)).sum(axis=1)
            known = parsed > 0
            lang = [m.languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
            rate = np.where(known, phrases.min(axis=1, initial=1 << 40) / np.maximum(parsed, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(rate, mask=~known)],
                names=[*batch.schema.names, lang_to, score_to, rate_to],
            )

    return df.mapInArrow(run, schema)


def labelled_sample(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", docs: int = SAMPLE_DOCS) -> dict[str, list[str]]:
    """At most ``docs`` texts for each language, spread over the table by a hash of the id.

    One id with the smallest hash in each of ``docs`` hash buckets is taken, so the sample is
    bounded, deterministic and needs no sort of a language's rows."""
    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    picked = (
        rows.groupBy(F.col(lang).alias("__l"), F.pmod(F.xxhash64(key), F.lit(docs)).alias("__b"))
        .agg(F.min(F.struct(F.xxhash64(F.col(key), F.lit(1)).alias("h"), F.col(key).alias("k"))).alias("__m"))
        .select("__l", F.col("__m.k").alias("__k"), F.col("__m.h").alias("__h"))
    )
    # at most docs rows for each language, whatever the input's size
    texts = rows.join(F.broadcast(picked), (F.col(lang) == F.col("__l")) & (F.col(key) == F.col("__k")))
    first = F.pmod(F.xxhash64(F.col("__k"), F.lit(2)), F.greatest(F.length(text) - F.lit(WINDOW - 1), F.lit(1)))
    window = F.substring(F.col(text), (first + 1).cast("int"), F.lit(WINDOW))
    texts = texts.groupBy("__l", "__k", "__h").agg(F.min(window).alias("t"))
    out: dict[str, list[tuple[int, str]]] = {}
    for row in texts.collect():
        out.setdefault(row["__l"], []).append((row["__h"], row["t"]))
    return {k: [t for _, t in sorted(v)] for k, v in out.items()}


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> PhraseModel | None:
    return build_model(labelled_sample(df, key, text, lang))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the folds that the contract leaves for training."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = fit(docs.where(fold("doc_id", 4) != 2))
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", F.col("score_phrase_rate").alias("phrase_rate"))
