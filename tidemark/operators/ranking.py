"""Best-row flags and top-1-per-group selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flag_best(df: DataFrame, partition_by: list[str], order_by: list[Column], flag: str) -> DataFrame:
    """Keep every row; ``flag`` is true on exactly one row per group.

    ``order_by`` must end in a column that makes the order total (e.g. year
    ascending), so the flagged row is deterministic.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(flag, F.row_number().over(w) == 1)


def top_row_per_group(df: DataFrame, partition_by: list[str], order_desc: list[str], payload: list[str]) -> DataFrame:
    """One row per group: the row with the largest ``order_desc`` tuple.

    Computed as ``max(struct(order..., payload...))`` per group: an aggregate
    with map-side partial combine, so a group holding a large share of all
    rows is reduced inside each input task before the shuffle and never lands
    whole in one task. Ties on the order columns are broken by the payload,
    which makes the answer deterministic. NULL order values rank lowest.
    """
    fields = list(dict.fromkeys([*order_desc, *payload]))
    best = F.max(F.struct(*[F.col(c) for c in fields])).alias("__best")
    return df.groupBy(*partition_by).agg(best).select(
        *partition_by, *[F.col(f"__best.{c}").alias(c) for c in payload if c not in partition_by]
    )


def top_row_per_group_window(df: DataFrame, partition_by: list[str], order_by: list[Column]) -> DataFrame:
    """Window form of top-1 (``row_number() = 1``); Spark plans a WindowGroupLimit.

    Use for mixed sort directions; prefer :func:`top_row_per_group` otherwise.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
