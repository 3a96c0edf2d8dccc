"""Dimension joins: size-checked broadcast and key-uniqueness guard.

Broadcast policy. No join here carries an unconditional broadcast hint.
Spark itself checks the size before broadcasting a side:

* at planning time, from file/statistics estimates, against
  ``spark.sql.autoBroadcastJoinThreshold``;
* at run time (AQE), from the *measured* shuffle output of the side,
  against ``spark.sql.adaptive.autoBroadcastJoinThreshold``.

Above the threshold the join stays a sort-merge (or shuffled-hash) join,
with AQE's skew-join splitting for hot keys. ``policy="counted"`` adds an
explicit hint only after a distributed ``count()`` proves the side small
(for inputs without usable statistics); it costs one scan of that side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root

# A side above this many rows or bytes is never hinted for broadcast.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def row_bytes(df: DataFrame) -> Column:
    """Bytes that a row takes in memory, about: 16 for each column and the length of what is not of fixed size."""
    size = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif kind in ("array", "map", "struct"):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0))
    return size


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when a count of its rows and bytes proves it small, else ``df`` unchanged."""
    r = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes")).first()
    return F.broadcast(df) if r["rows"] <= max_rows and (r["bytes"] or 0) <= max_bytes else df


def assert_unique(df: DataFrame, keys: list[str], what: str = "dimension") -> DataFrame:
    """Fail fast when ``keys`` repeat in ``df``: a join on them would fan out rows.

    One partial+final aggregation over ``df``; only key values occurring
    twice or more reach the driver, and at most one of them.
    """
    dupes = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dupes:
        raise ValueError(f"{what} key {keys} is not unique, e.g. {dupes[0].asDict()}")
    return df


def checked_dimension(df: DataFrame, keys: list[str] | None = None, max_rows: int = DEFAULT_BROADCAST_ROWS, what: str = "dimension",
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Materialise a dimension once, prove its size (and key uniqueness), hint broadcast only below the bound.

    For dimensions derived by joins or aggregates Spark has no usable static
    size estimate (it multiplies the sizes of join inputs), so it would plan
    a shuffle of the fact side that AQE can only undo after that shuffle has
    run. The dimension is written once with ``checkpoint()`` into the shared
    checkpoint folder (one job; lineage cut, survives executor loss); the
    check then reads the materialised rows: with ``keys`` one aggregation
    gives rows, bytes and the largest key multiplicity (a repeated key raises,
    as the join would fan out fact rows), without keys rows and bytes. Above
    ``max_rows`` or ``max_bytes`` the side is returned unhinted and the join stays a shuffle
    join. Callers (SQL views or DataFrames) reuse the checkpointed rows.
    """
    checkpoint_root(df.sparkSession)
    stored = df.checkpoint(eager=True)
    count, size = F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(stored)).alias("bytes")
    if keys:
        r = stored.groupBy(*keys).agg(count, size).agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.max("rows").alias("dup")).first()
        if (r["dup"] or 0) > 1:
            raise ValueError(f"{what} key {keys} is not unique (a key occurs {r['dup']} times)")
    else:
        r = stored.agg(count, size).first()
    return F.broadcast(stored) if (r["rows"] or 0) <= max_rows and (r["bytes"] or 0) <= max_bytes else stored


def prepare_side(df: DataFrame, policy: str = "auto", max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Apply the broadcast policy to a join side ('auto' = Spark's own size checks)."""
    if policy == "auto":
        return df
    if policy == "counted":
        return sized_broadcast(df, max_rows)
    raise ValueError(f"unknown broadcast policy {policy}")


@dataclass(frozen=True)
class Dim:
    """One label dimension of a star: ``table`` joined on ``left_key == right_key``.

    Only ``columns`` (plus the key) are read from the dimension, so the scan
    is pruned to them. ``condition`` filters the dimension before the join.
    """

    table: DataFrame
    left_key: str
    right_key: str
    columns: tuple[str, ...]
    condition: Column | None = None


def star_join(
    facts: DataFrame,
    dims: list[Dim],
    how: str = "left",
    policy: str = "auto",
    check_unique: bool = False,
) -> DataFrame:
    """Left-join each dimension in order (a later dim may key off an earlier one).

    Keys may be named differently on the two sides; the dimension key column
    is dropped after the join. A dimension must be unique on its key or fact
    rows multiply: SCD1 tables are unique by construction; pass
    ``check_unique=True`` to assert it for other inputs (one aggregation each).
    """
    out = facts
    for d in dims:
        right = d.table if d.condition is None else d.table.filter(d.condition)
        right = right.select(F.col(d.right_key).alias("__dim_key"), *d.columns)
        if check_unique:
            assert_unique(right, ["__dim_key"], what=f"dimension on {d.right_key}")
        right = prepare_side(right, policy)
        out = out.join(right, out[d.left_key] == right["__dim_key"], how).drop("__dim_key")
    return out


def sparse_dim_join(facts: DataFrame, dim: DataFrame, keys: list[str], policy: str = "auto") -> DataFrame:
    """Left join to a dimension that covers only some key values (misses stay NULL).

    The dimension must be unique on ``keys`` (asserted) so no fact row is duplicated.
    """
    assert_unique(dim, keys, what="sparse dimension")
    return facts.join(prepare_side(dim, policy), keys, "left")
