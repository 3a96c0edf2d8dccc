"""SCD type 1: the latest version of every key wins.

``latest_per_key`` is a grouped ``max(struct(sequence..., payload...))``:

* an aggregate with map-side partial combine, so a key (or a few keys)
  holding a large share of all rows is reduced inside each input task and
  never lands whole in one reducer;
* a maximum is commutative, associative and idempotent, so any split of the
  input into micro-batches, in any order, replayed any number of times,
  converges to the same table;
* the payload in the struct breaks ties on the sequence (same file, same
  timestamp), which makes the answer deterministic; NULL payload columns
  survive inside the struct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def _orderable(dt: DataType) -> bool:
    """Whether values of this type can be compared (MAP and VARIANT cannot)."""
    if isinstance(dt, (MapType, VariantType)):
        return False
    if isinstance(dt, StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, ArrayType):
        return _orderable(dt.elementType)
    return True


def latest_per_key(
    df: DataFrame,
    keys: list[str],
    sequence: list[str],
    payload: list[str] | None = None,
    keep_sequence: bool = False,
) -> DataFrame:
    """One row per key: the row with the greatest (sequence, payload) tuple.

    ``keep_sequence`` keeps the sequence columns (state for later merges);
    the published table drops them. Payload columns that cannot be compared
    (MAP, VARIANT) ride along via ``max_by`` and are left out of the tie-break.
    """
    if payload is None:
        payload = [c for c in df.columns if c not in keys and c not in sequence]
    extra = [c for c in payload if c not in sequence]
    types = {f.name: f.dataType for f in df.schema.fields}
    out_fields = [*(sequence if keep_sequence else []), *payload]
    if all(_orderable(types[c]) for c in extra):
        winner = F.max(F.struct(*[F.col(c) for c in [*sequence, *extra]])).alias("__w")
    else:
        ordering = F.struct(*[F.col(c) for c in [*sequence, *[c for c in extra if _orderable(types[c])]]])
        winner = F.max_by(F.struct(*[F.col(c) for c in [*sequence, *extra]]), ordering).alias("__w")
    return df.groupBy(*keys).agg(winner).select(*keys, *[F.col(f"__w.{c}").alias(c) for c in out_fields])


def scd1_merge(
    current: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    sequence: list[str],
    payload: list[str] | None = None,
) -> DataFrame:
    """New state = latest per key over (current state ∪ changes); sequence kept.

    No deletes: a key absent from ``changes`` keeps its current row.
    """
    if payload is None:
        payload = [c for c in changes.columns if c not in keys and c not in sequence]
    cols = [*keys, *sequence, *payload]
    merged = changes.select(*cols) if current is None else current.select(*cols).unionByName(changes.select(*cols))
    return latest_per_key(merged, keys, sequence, payload, keep_sequence=True)


def publish(state: DataFrame, sequence: list[str]) -> DataFrame:
    """The published SCD1 view: state without the sequence columns."""
    return state.drop(*sequence)


def scd1_merge_join(
    current: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    sequence: list[str],
    payload: list[str] | None = None,
) -> DataFrame:
    """SCD1 merge as a full outer join of the current state with the batch's latest rows.

    Same result as :func:`scd1_merge` (the greater (sequence, payload) tuple
    wins per key; keys missing from the batch keep their row). When
    ``current`` is read from a table bucketed on ``keys``, Spark joins
    without an exchange on the state side: only the batch is shuffled, so a
    refresh costs a scan of the state, not a shuffle of it. Payloads must be
    orderable (no MAP/VARIANT).
    """
    if payload is None:
        payload = [c for c in changes.columns if c not in keys and c not in sequence]
    fields = [*sequence, *[c for c in payload if c not in sequence]]
    latest = latest_per_key(changes, keys, sequence, payload, keep_sequence=True)
    if current is None:
        return latest
    cur = current.select(*keys, F.struct(*[F.col(c) for c in fields]).alias("__s"))
    new = latest.select(*keys, F.struct(*[F.col(c) for c in fields]).alias("__b"))
    joined = cur.join(new, keys, "full_outer")
    winner = F.when(F.col("__s").isNull() | (F.col("__b") > F.col("__s")), F.col("__b")).otherwise(F.col("__s"))
    return joined.select(*keys, winner.alias("__w")).select(*keys, *[F.col(f"__w.{c}").alias(c) for c in fields])
