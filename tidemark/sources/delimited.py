"""Drift-tolerant reading of delimited snapshot files (tab-separated, header row).

Files of one dataset may carry different headers over time (a column added in
the middle, padding changed). Spark's CSV reader applies one schema *by
position* to every file, which silently shifts values when headers differ.
Here each line is mapped to the header of *its own* file, by name:

1. lines are read with the text source, keeping ``_metadata.file_path`` and
   ``_metadata.file_block_start``;
2. each file's header is the first line of its first split: rows of a split
   are read in order, so ``min_by(line, monotonically_increasing_id())`` over
   the rows with block start 0 is the header; that is a partial aggregate with
   one output row per file;
3. the header table (one row per file; the stream bounds the files per
   micro-batch) is collected once and broadcast back to the lines; each
   line is split on the separator and zipped with its file's header names;
4. the output has one column per header name seen in the batch (all STRING,
   names kept verbatim, padding included), NULL where a file lacks a column;
   values beyond the header width, and values under a blank or repeated
   header name, go to ``_rescued_data`` as JSON.

Everything runs in tasks; the driver only sees one header row per file
(bounded per micro-batch) to build the projection and the broadcast side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import ingest_ts_from_path

RESCUED = "_rescued_data"
SOURCE_FILE = "_source_file"
INGEST_TS = "_ingest_ts"
INGESTED_AT = "_ingested_at"


def lines_with_position(lines: DataFrame) -> DataFrame:
    """Text lines → (path, block_start, pos, line) with a per-partition ordered position.

    ``lines`` must carry ``value`` and the ``_metadata`` struct (text source).
    """
    return lines.select(
        F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__pos"),
        F.regexp_replace(F.col("value"), "\r$", "").alias("__line"),
    )


def file_headers(positioned: DataFrame, sep: str = "\t") -> DataFrame:
    """(path, header_pos, header ARRAY<STRING>) — one row per file."""
    first = positioned.filter(F.col("__block") == 0).groupBy("__path").agg(
        F.min_by(F.struct("__pos", "__line"), F.col("__pos")).alias("__h")
    )
    return first.select(
        "__path",
        F.col("__h.__pos").alias("__header_pos"),
        F.split(F.col("__h.__line"), _regex_quote(sep), -1).alias("__header"),
    )


def _regex_quote(sep: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in sep)


HEADER_SCHEMA = "__path string, __header_pos bigint, __header array<string>"


def map_lines_to_headers(positioned: DataFrame, headers: DataFrame, sep: str = "\t") -> DataFrame:
    """Data lines (header lines removed) with ``__fields`` MAP<name, value> and rescued extras.

    ``headers`` has one row per file and is broadcast (its size is the number
    of files in the batch, which the caller bounds).
    """
    # A field is named by the first header that has its name; fields under blank and repeated names are rescued.
    # Spellings that the session takes for one column are one name.
    fold = (lambda h: h) if case_sensitive(positioned.sparkSession) else F.lower
    folded = F.transform("__header", fold)
    named = F.transform("__header", lambda h, i: h.rlike(r"\S") & (F.array_position(folded, fold(h)) == i + 1))
    joined = positioned.join(F.broadcast(headers.withColumn("__named", named)), "__path", "inner").filter(
        (F.col("__pos") != F.col("__header_pos")) & (F.col("__line") != "")
    )
    fields = F.split(F.col("__line"), _regex_quote(sep), -1)
    columns = F.filter("__header", lambda _h, i: F.get("__named", i))
    aligned = F.filter(F.transform("__header", lambda _h, i: F.struct(F.get("__named", i).alias("named"), F.get(fields, i).alias("value"))), lambda x: x["named"])
    unnamed = F.filter(fields, lambda value, i: ~F.coalesce(F.get("__named", i), F.lit(True)) & (value != ""))
    extra = F.slice(fields, F.size(F.col("__header")) + 1, F.greatest(F.size(fields) - F.size(F.col("__header")), F.lit(0)))
    rescued = F.when(
        (F.size(fields) > F.size(F.col("__header"))) | (F.size(unnamed) > 0),
        F.to_json(F.struct(F.concat(unnamed, extra).alias("_extra_values"), F.col("__path").alias("_file_path"))),
    )
    return joined.select(
        "__path",
        F.map_from_arrays(columns, aligned["value"]).alias("__fields"),
        rescued.alias(RESCUED),
    )


def case_sensitive(spark) -> bool:
    return spark.conf.get("spark.sql.caseSensitive", "false") == "true"


def header_union(header_rows: list, existing: list[str] | None = None, sensitive: bool = True) -> dict[str, list[str]]:
    """Ordered union of column names with the spellings each has: existing table columns first, then new ones
    in first-seen order (additive evolution). Blank names get no column: their values are rescued."""
    names = {n: [n] for n in existing or []}
    first = {n if sensitive else n.lower(): n for n in names}
    for header in sorted({tuple(r["__header"]) for r in header_rows}):
        for n in header:
            if n.strip() != "":
                spellings = names.setdefault(first.setdefault(n if sensitive else n.lower(), n), [])
                if n not in spellings:
                    spellings.append(n)
    return names


def read_delimited_lines(lines: DataFrame, sep: str = "\t", existing_columns: list[str] | None = None) -> DataFrame:
    """Raw text lines of one dataset's files → all-STRING rows with provenance.

    Output: one column per header name (verbatim), ``_rescued_data``,
    ``_source_file`` and ``_ingest_ts`` (run stamp parsed from the path suffix).
    The per-file header table is computed once (one row per file, collected:
    the number of files per micro-batch is bounded by the stream) and
    broadcast back from those rows.
    """
    positioned = lines_with_position(lines)
    header_rows = file_headers(positioned, sep).collect()
    names = header_union(header_rows, existing_columns, case_sensitive(lines.sparkSession))
    headers = lines.sparkSession.createDataFrame(header_rows, HEADER_SCHEMA)
    mapped = map_lines_to_headers(positioned, headers, sep)
    return mapped.select(
        *[F.coalesce(*[F.col("__fields")[s] for s in spellings]).alias(n) for n, spellings in names.items()],
        RESCUED,
        F.col("__path").alias(SOURCE_FILE),
        ingest_ts_from_path(F.col("__path")).alias(INGEST_TS),
    )


def read_delimited(spark, paths: list[str] | str, sep: str = "\t") -> DataFrame:
    """Batch read of delimited files (any mix of headers) with provenance columns."""
    lines = spark.read.text(paths).select("value", "_metadata")
    return read_delimited_lines(lines, sep).withColumn(INGESTED_AT, F.current_timestamp())
