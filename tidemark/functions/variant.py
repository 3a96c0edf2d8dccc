"""VARIANT helpers: safe path extraction and array explosion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_for(field: str) -> str:
    """JSON path for a top-level field; bracket form when the name has a space or dot."""
    if any(ch in field for ch in ' ."[]$'):
        return '$["' + field.replace('"', '\\"') + '"]'
    return "$." + field


def variant_field(v: Column | str, field: str, type_name: str) -> Column:
    """Typed field of a VARIANT; NULL (not an error) when absent or not castable."""
    c = F.col(v) if isinstance(v, str) else v
    return F.try_variant_get(c, path_for(field), type_name)


def variant_array(v: Column | str, path: str = "$.data") -> Column:
    """The array at ``path`` as ARRAY<VARIANT> (NULL when not an array)."""
    c = F.col(v) if isinstance(v, str) else v
    return F.try_variant_get(c, path, "array<variant>")
