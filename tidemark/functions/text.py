"""String columns for landing, naming, hashing and link extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The run timestamp format (UTC, second resolution, e.g.
# 20260909T163000Z) and the separator between a file name and that stamp.
INGEST_TS_PATTERN = "yyyyMMdd'T'HHmmss'Z'"
INGEST_TS_SUFFIX_SEP = "__"
# Pattern of the run stamp at the end of a landed path; a snapshot written by
# Spark is a directory of part files, so the stamp may end the parent segment.
INGEST_TS_SUFFIX_REGEX = r"__([0-9]{8}T[0-9]{6}Z)(/[^/]*)?$"
# Markup as a parser reads it: comments and script or style elements first (tags inside them are text), then start tags, in which
# ">" inside a quoted value does not end the tag and a quote counts only where a value begins.
_NAME = r"""[^\s/>=]++"""
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)"""
_ATTRIBUTES = rf"""(?:[\s/]++|{_NAME}(?:\s*+=\s*+{_VALUE})?+|=)*+"""
MARKUP_REGEX = (
    rf"""(?is)<!--.*?(?:-->|\z)|<(script|style)(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1(?=[\s/>])|\z)|<[a-z][^\s/>]*+{_ATTRIBUTES}>"""
)
ATTRIBUTE_REGEX = rf"""(?is)({_NAME})(?:\s*+=\s*+({_VALUE}))?+"""
# The character references that are decoded by name; "&" itself comes last.
NAMED_REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\u00a0"}
AMPERSANDS = ("&amp;", "&#38;", "&#x26;", "&#X26;")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ingest_ts(ts: Column | str) -> Column:
    """UTC timestamp → run stamp like ``20260909T163000Z`` (session zone must be UTC)."""
    return F.date_format(_c(ts), INGEST_TS_PATTERN)


def ingest_ts_from_path(path: Column | str) -> Column:
    """The run stamp suffix of a landed path, or NULL when the path has none."""
    stamp = F.regexp_extract(_c(path), INGEST_TS_SUFFIX_REGEX, 1)
    return F.when(stamp != "", stamp)


def landing_path(base: str, source: Column | str, dataset: Column | str, filename: Column | str, stamp: Column | str) -> Column:
    """``<base>/<source>/<dataset>/<filename>__<stamp>`` — one immutable path per run."""
    return F.concat(
        F.lit(base.rstrip("/") + "/"), _c(source), F.lit("/"), _c(dataset), F.lit("/"),
        _c(filename), F.lit(INGEST_TS_SUFFIX_SEP), _c(stamp),
    )


def table_name_from_dataset(dataset: Column | str) -> Column:
    """Dataset name → legal table identifier: lower case, dots become underscores."""
    return F.translate(F.lower(_c(dataset)), ".", "_")


def content_fingerprint(text: Column | str) -> tuple[Column, Column]:
    """(sha-256 hex of the UTF-8 bytes, byte length) of a text or binary column."""
    c = _c(text)
    return F.sha2(c, 256), F.octet_length(c)


def _one_reference(text: Column, reference: Column) -> Column:
    """``text`` with one numeric character reference decoded; what is no character becomes U+FFFD."""
    digits = F.regexp_extract(reference, "([0-9a-fA-F]+);$", 1)
    hexadecimal = F.lower(F.substring(reference, 3, 1)) == "x"
    number = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("long")
    fine = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    character = F.when(fine, F.decode(F.unhex(F.lpad(F.hex(F.when(fine, number).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
    return F.replace(text, reference, character)


def unescaped(text: Column) -> Column:
    """Character references decoded: numeric ones and those of ``NAMED_REFERENCES``, with their semicolon; others stay as written."""
    numeric = F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit("&#(?:[xX][0-9a-fA-F]{1,6}|[0-9]{1,7});"), 0)), lambda r: ~r.isin(*AMPERSANDS))
    out = F.aggregate(numeric, text, _one_reference)
    for name, character in NAMED_REFERENCES.items():
        out = F.replace(out, F.lit(name), F.lit(character))
    for name in AMPERSANDS:
        out = F.replace(out, F.lit(name), F.lit("&"))
    return out


def _href(tag: Column) -> Column:
    """The last href of an ``<a ...>`` tag, decoded; empty if it has none."""
    inside = F.substring(tag, F.lit(3), F.length(tag) - 3)
    pairs = F.arrays_zip(
        F.regexp_extract_all(inside, F.lit(ATTRIBUTE_REGEX), 1).alias("name"), F.regexp_extract_all(inside, F.lit(ATTRIBUTE_REGEX), 2).alias("value"))
    raw = F.coalesce(F.try_element_at(F.filter(pairs, lambda x: F.lower(x["name"]) == "href"), F.lit(-1))["value"], F.lit(""))
    quoted = raw.startswith('"') | raw.startswith("'")
    return unescaped(F.when(quoted, F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw))


def listing_links(df: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per file link of a directory-listing page, in page order.

    Links are those of ``<a>`` start tags as markup has them: either case, double, single or no quotes, line breaks inside
    the tag, the last ``href`` if repeated (never ``data-href``), references decoded, nothing in comments, scripts
    or styles. Keeps targets that are non-empty, don't start with '?'
    (sort links) and don't end with '/' (parent or sub-directories), and
    reduces each to its basename, so absolute and relative links agree.
    Works page-parallel: each page is exploded inside its own task.
    """
    anchors = F.filter(F.regexp_extract_all(F.col(html_col), F.lit(MARKUP_REGEX), 0), lambda t: t.rlike(r"^<[aA][\s/]"))
    hrefs = df.select(*keep, F.explode(F.transform(anchors, _href)).alias("href"))
    return hrefs.filter(
        (F.col("href") != "") & ~F.col("href").startswith("?") & ~F.col("href").endswith("/")
    ).select(*keep, F.element_at(F.split(F.col("href"), "/"), -1).alias("file_name"))
