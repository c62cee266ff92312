"""String functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Legal forms that a company's key leaves out. Fixed values.
LEGAL_FORMS = ("incorporated", "inc", "corporation", "corp", "company", "co", "limited", "ltd", "llc", "plc", "ag", "sa", "nv")
#: Query parameters that only track visits. Fixed values.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid")


def normalize_text(c: Column) -> Column:
    """No-break spaces to spaces, blanks squeezed, at most two line feeds together, trimmed."""
    spaced = F.regexp_replace(F.regexp_replace(c, " ", " "), r"[ \t\r\f]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(spaced, r" *\n *", "\n"), r"\n{3,}", "\n\n"))


def object_key(c: Column) -> Column:
    """Key under which spellings of one name meet: lower case, "and" for &, no legal form or article."""
    flat = F.regexp_replace(F.regexp_replace(F.lower(c), "&", " and "), r"[^a-z0-9]+", " ")
    bare = F.regexp_replace(F.concat(F.lit(" "), F.trim(flat), F.lit(" ")), f" (?:{'|'.join(LEGAL_FORMS)}) ", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(bare), r"^(?:the|a|an) ", ""), r" +", " "))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def stable_id(prefix: str, length: int, *columns: Column) -> Column:
    """Prefix of the sha-256 of the fields joined by a bar."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *[c.cast("string") for c in columns]), 256), 1, length))


def url_canonical(c: Column) -> Column:
    """Lower-case host without www. or m., path without its last slash, tracking parameters gone, the rest sorted."""
    host = F.regexp_replace(F.lower(F.regexp_extract(c, r"^[a-zA-Z]+://([^/?#]*)", 1)), r"^(?:www\.|m\.)", "")
    path = F.regexp_replace(F.regexp_extract(c, r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1), r"/+$", "")
    pairs = F.array_sort(
        F.filter(
            F.split(F.regexp_extract(c, r"\?([^#]*)", 1), "&"),
            lambda p: (p != "") & ~F.split(p, "=")[0].isin(*TRACKING),
        )
    )
    return F.concat(host, path, F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(pairs, "&"))).otherwise(F.lit("")))


def tokens(c: Column) -> Column:
    """Lower-case words and numbers."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[a-z0-9]+"), F.lit(0))


def html_text(c: Column) -> Column:
    """Visible text: scripts, styles, headers and footers dropped, tags to line feeds, white space normalised."""
    body = c
    for tag in ("script", "style", "head", "header", "footer", "nav"):
        body = F.regexp_replace(body, f"(?is)<{tag}[ >].*?</{tag}>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(body, "(?s)<[^>]*>", " "), r"\s+", " "))


def html_links(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit('href="([^"]*)"'), F.lit(1))


def script_share(c: Column, inside: str) -> Column:
    """Share of letters that lie in a character class."""
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    own = F.length(F.regexp_replace(c, f"[^{inside}]", ""))
    return F.when(letters > 0, own / letters).otherwise(F.lit(0.0))


def initials(c: Column) -> Column:
    """First letters of the words of a name, for acronym tests."""
    return F.array_join(F.transform(F.filter(F.split(F.lower(c), r"[^a-z0-9]+"), lambda w: w != ""), lambda w: F.substring(w, 1, 1)), "")


def parse_number(c: Column) -> Column:
    """Commas, currency and percent signs dropped; parentheses mean negative."""
    bare = F.regexp_replace(c, r"[,$% ]", "")
    return F.regexp_replace(bare, r"^\((.*)\)$", "-$1").try_cast("decimal(38,10)")


def parse_date(c: Column, formats: tuple[str, ...] = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "dd.MM.yyyy")) -> Column:
    """First format that fits; else null."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("date") for f in formats])


def roc_date(c: Column) -> Column:
    """A date with the years of the Republic of China, such as 113/05/01; else null."""
    part = lambda i: F.regexp_extract(c, r"^([0-9]{2,3})[/.]([0-9]{2})[/.]([0-9]{2})$", i)
    return F.when(part(1) != "", F.try_to_timestamp(F.concat_ws("-", (part(1).cast("int") + 1911).cast("string"), part(2), part(3)), F.lit("yyyy-MM-dd")).cast("date"))


def excerpt(c: Column, anchor: Column, width: int) -> Column:
    """Text around the anchor, with dots where it is cut."""
    at = F.greatest(F.instr(c, anchor) - F.lit(width), F.lit(1))
    part = F.substring(c, at, F.length(anchor) + 2 * width)
    return F.concat(
        F.when(at > 1, "...").otherwise(""), part, F.when(at + F.length(anchor) + 2 * width <= F.length(c), "...").otherwise("")
    )


def table_rows(html: Column, least_cells: int = 2, least_chars: int = 20) -> Column:
    """Rows of HTML tables as text: cells joined by bars, short rows and rows of one cell left out."""
    bare = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "(?s)<[^>]*>", " "), r"\s+", " "))
    cells = lambda row: F.filter(F.transform(F.regexp_extract_all(row, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1)), bare), lambda x: x != "")
    rows = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1)), cells)
    shown = F.transform(F.filter(rows, lambda r: F.size(r) >= least_cells), lambda r: F.array_join(r, " | "))
    return F.filter(shown, lambda r: F.length(r) >= least_chars)
