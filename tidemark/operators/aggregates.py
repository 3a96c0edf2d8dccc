"""Aggregations: exact rounded sums, summary statistics, run roll-ups, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Exact sums are taken over DECIMAL values: independent of row order, and wide
# enough (24 digits before the point for a value, 32 for a sum) that no real
# total overflows. Spark combines them map-side like any other sum.
SUM_SCALE = 6
EXACT_SUM_TYPE = DecimalType(30, SUM_SCALE)


def exact_rounded_sum(df: DataFrame, col: str, digits: int = 1) -> Column:
    """``round(sum(col), digits)`` of amounts with at most six digits after the point, returned as DOUBLE.

    One aggregate column for amounts. Doubles of any magnitude, NaN and infinities are summed by :func:`exact_sums.exact_sums`,
    which the reports use; this column takes six digits of a value, and no NaN or infinity.
    Rounding happens before any ranking on the result, so rounding ties are
    visible to it (the earliest year wins).
    """
    del df  # same plan for DOUBLE and DECIMAL inputs
    return F.round(F.sum(F.col(col).cast(EXACT_SUM_TYPE)), digits).cast("double")


def summary_stats(df: DataFrame, value: str, key: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """One row: count of ``key``, mean, sample and population stddev of ``value``.

    Optional inclusive range on ``key``. A single global aggregate (partial
    per task, one final merge), so it scales with any input size.
    """
    if lo is not None and hi is not None:
        df = df.filter(F.col(key).between(lo, hi))
    return df.agg(
        F.count(key).alias(f"{key}_count"),
        F.mean(value).alias(f"{value}_mean"),
        F.stddev_samp(value).alias(f"{value}_stddev_samp"),
        F.stddev_pop(value).alias(f"{value}_stddev_pop"),
    )


def run_summary(df: DataFrame, run_key: str, status: str, error_value: str = "ERROR", counted: tuple[str, ...] = ()) -> DataFrame:
    """Per run: did any item fail, items in total, and items per listed status."""
    aggs = [
        F.bool_or(F.col(status) == error_value).alias("had_error"),
        F.count(F.lit(1)).alias("n"),
    ]
    aggs += [F.count_if(F.col(status) == s).alias(f"n_{s.lower()}") for s in counted]
    return df.groupBy(run_key).agg(*aggs)


def freshness(df: DataFrame, group: str, ts: str, cutoff: str) -> DataFrame:
    """Per group: latest timestamp and whether it is older than ``cutoff`` (stale)."""
    latest = F.max(F.col(ts))
    return df.groupBy(group).agg(
        latest.alias("latest_ts"),
        (latest < F.lit(cutoff).cast(df.schema[ts].dataType)).alias("is_stale"),
    )
