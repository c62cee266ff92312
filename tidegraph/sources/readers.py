"""Sources: delimited, JSON, XML, index, zip, mail and paged-text inputs as DataFrames."""

from __future__ import annotations

import csv
import email
import email.policy
import hashlib
import io
import json
import zipfile
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Encodings tried in turn. Fixed values.
ENCODINGS = ("utf-8-sig", "gb18030", "cp949", "shift_jis", "latin-1")


def universe_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ticker list: header-driven, upper-case tickers, priority 3 where it is missing."""
    rows = spark.read.csv(path, header=True)
    for c in ("ticker", "company_name", "role", "priority", "notes"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    priority = F.coalesce(F.expr("try_cast(priority AS INT)"), F.lit(3))
    return rows.select(F.upper(F.trim("ticker")).alias("ticker"), "company_name", "role", priority.alias("priority"), "notes").where(F.length("ticker") > 0)


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines under an explicit schema; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def aliased(df: DataFrame, aliases: dict[str, Sequence[str]]) -> DataFrame:
    """Columns under canonical names: the first header of each alias list that is present and not empty."""
    normal = {_header(c): c for c in df.columns}
    picks = []
    for name, options in aliases.items():
        found = [F.nullif(F.trim(F.col(f"`{normal[_header(o)]}`")), F.lit("")) for o in options if _header(o) in normal]
        picks.append((F.coalesce(*found) if found else F.lit(None).cast("string")).alias(name))
    return df.select(*picks)


def _header(name: str) -> str:
    return " ".join("".join(ch if ch.isalnum() else " " for ch in name.casefold()).split())


def sniffed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Files of unknown kind, encoding and delimiter, as string columns found by header: a JSON array of objects,
    the largest table of an HTML page, or delimited text.

    Each file is read by the task that has it; rows stream out in batches."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    wanted = [_header(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = next(t for t in map(lambda e: _decoded(content, e), ENCODINGS) if t is not None)
                lines = _lines(text)
                header, rows = None, []
                for i, line in enumerate(lines):
                    keys = [_header(x) for x in line]
                    if header is None:
                        if sum(w in keys for w in wanted) >= max(1, len(wanted) // 2):
                            header = [keys.index(w) if w in keys else None for w in wanted]
                        elif i >= 30:
                            break
                    elif any(line):
                        rows.append([line[at] if at is not None and at < len(line) else None for at in header])
                cols = list(zip(*rows)) or [() for _ in wanted]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), *[pa.array(c, pa.string()) for c in cols]], names=["path", *columns])

    return files.mapInArrow(run, ", ".join(["path string", *[f"`{c}` string" for c in columns]]))


class _Tables(HTMLParser):
    """Rows of every table of a page."""

    def __init__(self) -> None:
        super().__init__()
        self.tables: list[list[list[str]]] = []
        self.inside = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]:
            self.tables[-1][-1].append("")
            self.inside = True

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th"):
            self.inside = False

    def handle_data(self, data: str) -> None:
        if self.inside:
            self.tables[-1][-1][-1] += data.strip()


def _lines(text: str) -> Iterator[list[str]]:
    """Rows of a file by what it looks like; the first has the headers."""
    head = text[:4096].lstrip("\ufeff \r\n\t")
    if head[:1] in "[{":
        try:
            rows = json.loads(text.strip("\ufeff \r\n\t"))
        except ValueError:
            rows = None
        rows = rows if isinstance(rows, list) else next((v for v in rows.values() if isinstance(v, list)), []) if isinstance(rows, dict) else None
        if rows is not None:
            objects = [r for r in rows if isinstance(r, dict)]
            keys = list(dict.fromkeys(k for r in objects for k in r))
            return iter([keys, *[["" if r.get(k) is None else str(r[k]) for k in keys] for r in objects]])
    if "<table" in text.lower():
        page = _Tables()
        page.feed(text)
        return iter(max(page.tables, key=len, default=[]))
    return csv.reader(io.StringIO(text), delimiter=max(",;\t|", key=head.count))


def _decoded(content: bytes, encoding: str) -> str | None:
    try:
        return content.decode(encoding)
    except UnicodeDecodeError:
        return None


def xml_records(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """Repeated XML elements as rows, found by their tag in a stream, below a root or without one."""
    return spark.read.format("xml").option("useLegacyXMLParser", "true").option("rowTag", tag).schema(schema).load(path)


def pipe_index(spark: SparkSession, path: str) -> DataFrame:
    """Form index: cik|name|form|date|file rows below a header of any length; the accession is the file's stem."""
    rows = spark.read.text(path).where(F.rlike("value", F.lit(r"^\d+\|")))
    part = F.split("value", r"\|")
    return rows.select(
        part[0].alias("cik"), part[1].alias("company_name"), part[2].alias("form"), F.try_to_timestamp(part[3], F.lit("yyyy-MM-dd")).cast("date").alias("filing_date"),
        part[4].alias("file"), F.regexp_extract(part[4], r"([^/]+)\.[^./]+$", 1).alias("accession"))


def columnar_json(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Parallel arrays as rows; arrays of unequal length are an error."""
    same = F.lit(True)
    for n in names[1:]:
        same = same & (F.size(n) == F.size(names[0]))
    checked = df.where(F.coalesce(F.assert_true(same, F.lit("arrays of unequal length")).isNull(), F.lit(True)))
    return checked.select(F.inline(F.arrays_zip(*names)))


def zipped_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV members of zip files, with the member's sha-256; columns match by header, then by suffix."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for member in (m for m in z.namelist() if m.lower().endswith(".csv")):
                        data = z.read(member)
                        rows = list(csv.reader(io.StringIO(data.decode("utf-8-sig"))))
                        keys = [_header(x) for x in rows[0]] if rows else []
                        at = [next((i for i, k in enumerate(keys) if k == _header(c)), next((i for i, k in enumerate(keys) if k.endswith(_header(c))), None)) for c in columns]
                        body = [[r[i] if i is not None and i < len(r) else None for i in at] for r in rows[1:]]
                        cols = list(zip(*body)) or [() for _ in columns]
                        digest = [hashlib.sha256(data).hexdigest()] * len(body)
                        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in cols], pa.array(digest, pa.string())], names=[*columns, "sha256"])

    return files.mapInArrow(run, ", ".join([*[f"`{c}` string" for c in columns], "sha256 string"]))


def mail_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Messages as events: subject, sender, date, body and the first link."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                m = email.message_from_bytes(content, policy=email.policy.default)
                body = m.get_body(preferencelist=("plain", "html"))
                rows.append((name, str(m["subject"] or ""), str(m["from"] or ""), str(m["date"] or ""), body.get_content() if body else ""))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["path", "subject", "sender", "sent", "body"])

    rows = files.mapInArrow(run, "path string, subject string, sender string, sent string, body string")
    return rows.withColumn("url", F.nullif(F.regexp_extract("body", r"(https?://[^\s<>\"]+)", 1), F.lit("")))


def pages_of(text: Column) -> Column:
    """Pages of form-feed separated text; blank pages stay."""
    return F.split(text, "\f", -1)


def bulk_links(html: Column, pattern: str) -> Column:
    """Targets of anchors that match a pattern, in order."""
    return F.filter(F.regexp_extract_all(html, F.lit(r"href=[\"']([^\"']+)[\"']"), F.lit(1)), lambda x: F.rlike(x, F.lit(pattern)))
