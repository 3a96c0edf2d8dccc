"""Snapshot change detection and duplicate-content collapse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Change statuses of an item between two snapshots.
ADDED, CHANGED, UNCHANGED, REMOVED = "ADDED", "CHANGED", "UNCHANGED", "REMOVED"


def classify_changes(current: DataFrame, previous: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """Full outer join of two snapshots on ``key`` → one status per item.

    No previous row → ADDED; no current row → REMOVED; equal fingerprint →
    UNCHANGED; otherwise CHANGED. Output: key, status, previous and current
    fingerprint. Both sides are shuffled once on the key (sort-merge join);
    a snapshot is unique on its key, so no key is hot.
    """
    cur = current.select(F.col(key).alias("__k"), F.col(fingerprint).alias("current_fingerprint"), F.lit(True).alias("__cur"))
    prev = previous.select(F.col(key).alias("__k"), F.col(fingerprint).alias("previous_fingerprint"), F.lit(True).alias("__prev"))
    j = cur.join(prev, "__k", "full_outer")
    status = (
        F.when(F.col("__prev").isNull(), F.lit(ADDED))
        .when(F.col("__cur").isNull(), F.lit(REMOVED))
        .when(F.col("current_fingerprint").eqNullSafe(F.col("previous_fingerprint")), F.lit(UNCHANGED))
        .otherwise(F.lit(CHANGED))
    )
    return j.select(F.col("__k").alias(key), status.alias("status"), "previous_fingerprint", "current_fingerprint")


def duplicate_content(df: DataFrame, key: str, text: str) -> DataFrame:
    """Contents landed more than once: (content_sha256, first key, copies).

    Groups by the SHA-256 of the whole text. ``min`` and ``count`` combine
    map-side, so one text copied into a third of all rows is still reduced
    per task before the shuffle.
    """
    return (
        df.groupBy(F.sha2(F.col(text), 256).alias("content_sha256"))
        .agg(F.min(key).alias(f"first_{key}"), F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def collapse_duplicates(df: DataFrame, key: str, text: str) -> DataFrame:
    """Keep one row per distinct content: the one with the smallest ``key``.

    ``min(struct(key, ...))`` per content hash: partial-aggregated, so a
    heavily copied text never lands whole in one task.
    """
    cols = [key, *[c for c in df.columns if c != key]]
    return (
        df.groupBy(F.sha2(F.col(text), 256).alias("__h"))
        .agg(F.min(F.struct(*[F.col(c) for c in cols])).alias("__w"))
        .select(*[F.col(f"__w.{c}").alias(c) for c in df.columns])
    )
