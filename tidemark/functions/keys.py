"""Key and audit columns (pure Column logic, no session needed)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The part separator and the placeholder for a NULL part.
# Both must stay as they are, or previously issued keys change.
KEY_SEPARATOR = "‖"
NULL_PART = ""


def _key_digest(columns: tuple[str, ...], encode: Callable[[Column], Column]) -> Column:
    """SHA-256 hex digest of the separated parts, each as ``encode`` writes its text."""
    if not columns:
        raise ValueError("a key needs at least one column")
    return F.sha2(F.array_join(F.array(*(encode(F.col(c).cast("string")) for c in columns)), KEY_SEPARATOR), 256)


def surrogate_key(*columns: str) -> Column:
    """Key of the business key columns, in the given order.

    NULL and '' give the same key (kept for compatibility); use
    :func:`null_safe_surrogate_key` where that collision matters.
    """
    return _key_digest(columns, lambda text: F.nvl(text, F.lit(NULL_PART)))


def null_safe_surrogate_key(*columns: str) -> Column:
    """Like :func:`surrogate_key`, but NULL ('n') and '' ('v:') give different keys."""
    return _key_digest(columns, lambda text: F.nvl(F.concat(F.lit("v:"), text), F.lit("n")))


def with_audit_columns(df: DataFrame, source: str) -> DataFrame:
    """Stamp rows with ``_insert_update_ts`` (now) and ``_source``."""
    return df.withColumns({"_insert_update_ts": F.current_timestamp(), "_source": F.lit(source)})
