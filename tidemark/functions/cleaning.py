"""Column cleaning: header strip, trim, sentinel handling, flag decode, typed casts.

Every cast here is a ``try_cast``: under ANSI mode a plain cast of malformed
text fails the whole job before a quality rule could drop or quarantine the row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text that means "no value" in the delimited sources
# (a dash, or nothing at all after trimming).
SENTINELS = ("-", "")
# Flag letters and what they decode to; anything else is NULL.
FLAG_TRUE = "T"
FLAG_FALSE = "F"


def strip_column_names(df: DataFrame, lower: bool = False) -> DataFrame:
    """Remove whitespace padding from every column name (one projection).

    Raises if two names become equal after stripping, rather than silently
    keeping one of them.
    """
    new_names = [c.strip().lower() if lower else c.strip() for c in df.columns]
    if len(set(new_names)) != len(new_names):
        raise ValueError(f"column names collide after stripping: {new_names}")
    return df.toDF(*new_names)


def trim_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Trim leading/trailing spaces of the given (default: all string) columns."""
    targets = columns if columns is not None else [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: F.trim(F.col(c)) for c in targets})


def sentinel_to_null(col: Column | str, type_name: str = "double", sentinels: tuple[str, ...] = SENTINELS) -> Column:
    """Trimmed text → typed value; a sentinel becomes NULL, never 0."""
    trimmed = F.trim(F.col(col) if isinstance(col, str) else col)
    return F.when(trimmed.isin(*sentinels), F.lit(None).cast(type_name)).otherwise(trimmed.try_cast(type_name))


def decode_flag(col: Column | str) -> Column:
    """'T' → true, 'F' → false, anything else (including NULL) → NULL."""
    c = F.trim(F.col(col) if isinstance(col, str) else col)
    return F.when(c == FLAG_TRUE, F.lit(True)).when(c == FLAG_FALSE, F.lit(False))


def typed(col: Column | str, type_name: str) -> Column:
    """Trim then ``try_cast``; strings (identifier codes) are only trimmed."""
    c = F.trim(F.col(col) if isinstance(col, str) else col)
    if type_name == "string":
        return c
    return c.try_cast(type_name)


@dataclass(frozen=True)
class ColumnSpec:
    """How one silver column is derived from one raw (bronze) column.

    kind: 'plain' (trim + try_cast), 'sentinel' (sentinel → NULL, then cast),
    'flag' (T/F decode). ``raw`` defaults to ``name``; matching is done on the
    stripped, case-folded raw header, so padded or capitalised headers resolve.
    """

    name: str
    type_name: str = "string"
    kind: str = "plain"
    raw: str | None = None


@dataclass(frozen=True)
class TableSpec:
    """A silver table: its column specs, CDC keys and quality rules.

    ``variant_path`` marks a table whose raw rows are VARIANT documents: the
    array at that path is exploded and each ``ColumnSpec.raw`` names a field
    of the array elements.
    """

    name: str
    columns: tuple[ColumnSpec, ...]
    keys: tuple[str, ...]
    rules: tuple = field(default_factory=tuple)
    variant_path: str | None = None


def project_spec(df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed projection of a raw frame by a spec, resolving padded/capitalised headers.

    Columns named in ``keep`` (provenance, sequence) pass through unchanged.
    A spec column with no raw counterpart becomes a typed NULL, so an older
    snapshot without a newer column still projects.
    """
    by_folded = {}
    for c in df.columns:
        by_folded.setdefault(c.strip().lower(), c)
    out = []
    for cs in spec.columns:
        raw_name = by_folded.get((cs.raw or cs.name).strip().lower())
        if raw_name is None:
            out.append(F.lit(None).cast("boolean" if cs.kind == "flag" else cs.type_name).alias(cs.name))
            continue
        src = F.col(f"`{raw_name}`")
        if cs.kind == "sentinel":
            expr = sentinel_to_null(src, cs.type_name)
        elif cs.kind == "flag":
            expr = decode_flag(src)
        else:
            expr = typed(src, cs.type_name)
        out.append(expr.alias(cs.name))
    return df.select(*out, *[F.col(f"`{k}`") for k in keep])
