"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies, target /
source size; its whole part is certain, and the rest is a copy probability.
Probabilities are paired: mass (probability times words) moves from one
document to the other until one of the two is 0 or 1, with the direction drawn
so that both keep their expectation. The words of a pair never change, so
rounding a whole source leaves one open document.

Documents are dealt to buckets of about ``BUCKET`` by a hash of their id, so
that a source of any size is rounded in many tasks; a bucket leaves at most
one open document, and a tree of group-bys rounds those, ``FAN_IN`` buckets at
a time, until one is left for a source, which is drawn. A source therefore
misses its target by less than one document. Draws are seeded by source,
bucket and level, and each bucket is sorted first, so reruns agree however the
input is partitioned.

Defined cases: null text has size 0 and is taken 0 times; the null source is a
source of its own, last in order; repeated rows are rounded one by one; an
empty table gives an empty result; columns besides id, text and source are not
looked at by the rounding, and ``mix_documents`` returns them unchanged.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_name, stored, table, word_count

BUCKET = 4096
FAN_IN = 64
EPS = 1e-9
ROUNDED = "source string, bucket long, doc_id long, size long, extra long, open double"


def source_targets(units: DataFrame, weights: Column, cap: float = 3.0) -> DataFrame:
    """source, source_size, n_docs, weight, target: shares of all sizes by weight, each at most ``cap`` times its source.

    ``weights`` is an expression of ``place``, a source's place from 0 by code point, null last. What a cap cuts
    off is shared again by weight among the others until none is above; each round is one small aggregate.
    """
    sums = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    state = stored(sums.withColumn("place", F.row_number().over(order) - 1).withColumn("weight", weights.cast("double")).drop("place"), "mix-sources")
    total = state.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * F.lit(float(cap))
    level = 0.0
    while True:
        capped = F.col("weight") * F.lit(level) > limit
        used, free = state.agg(F.sum(F.when(capped, limit).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        higher = (total - (used or 0.0)) / free if free else level
        if higher <= level * (1 + 1e-15):
            break
        level = higher
    return state.withColumn("target", F.least(F.col("weight") * F.lit(level), limit))


def _pair(first: list, second: list, draw: float) -> None:
    """Move mass between two open documents ``[probability, size]`` until one is whole."""
    (p, a), (q, b) = first, second
    up, down = min(1 - p, q * b / a), min(p, (1 - q) * b / a)
    if draw * (up + down) < down:
        p, q = p + up, q - up * a / b
    else:
        p, q = p - down, q + down * a / b
    for unit, value in ((first, p), (second, q)):
        unit[0] = 0.0 if value < EPS else 1.0 if value > 1 - EPS else value


def _round(p: np.ndarray, sizes: np.ndarray, seed: str) -> tuple[np.ndarray, int]:
    """Whole probabilities but for one open place (-1: none)."""
    draws = np.random.Generator(np.random.PCG64(int.from_bytes(hashlib.sha256(seed.encode()).digest()[:8], "big"))).random(len(p))
    out, held, at = p.copy(), None, -1
    for i in range(len(p)):
        unit = [float(p[i]), float(sizes[i])]
        if unit[0] < EPS or unit[0] > 1 - EPS:
            out[i] = round(unit[0])
        elif held is None:
            held, at = unit, i
        else:
            _pair(held, unit, draws[i])
            out[at], out[i] = held[0], unit[0]
            if not EPS < held[0] < 1 - EPS:
                held, at = (unit, i) if EPS < unit[0] < 1 - EPS else (None, -1)
    return out, at


def _bucket(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["size", "doc_id"], kind="stable", na_position="first")
    p, at = _round(group["open"].to_numpy(float), group["size"].to_numpy(float), f"{key[0]!r} {key[1]} 0")
    group["extra"] = np.floor(p + EPS).astype(np.int64)
    group["open"] = np.nan
    if at >= 0:
        group.iloc[at, group.columns.get_loc("extra")] = 0
        group.iloc[at, group.columns.get_loc("open")] = p[at]
    return group[["source", "bucket", "doc_id", "size", "extra", "open"]]


def _combine(level: int, last: bool):
    def combine(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["bucket"])
        seed = f"{key[0]!r} {key[1]} {level}"
        p, at = _round(group["open"].to_numpy(float), group["size"].to_numpy(float), seed)
        if last and at >= 0:
            draw = int.from_bytes(hashlib.sha256(f"{seed} last".encode()).digest()[:8], "big") / 2**64
            p[at], at = float(draw < p[at]), -1
        group["extra"] = np.floor(p + EPS).astype(np.int64)
        group["open"] = np.nan
        if at >= 0:
            group.iloc[at, group.columns.get_loc("extra")] = 0
            group.iloc[at, group.columns.get_loc("open")] = p[at]
        return group[["source", "bucket", "doc_id", "size", "extra", "open"]]

    return combine


def pivotal_copies(units: DataFrame, targets: DataFrame) -> DataFrame:
    """source, doc_id, size, source_size, target, copies for every row of ``units`` (doc_id, source, size)."""
    buckets = (F.col("n_docs") / BUCKET).cast("long") + 1
    spread = F.pmod(F.xxhash64("doc_id", "size"), buckets)
    keyed = units.alias("u").join(targets.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source"))).select(
        F.col("u.source").alias("source"), "doc_id", "size", "source_size", "target", "n_docs")
    ratio = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    split = keyed.select("source", "doc_id", "size", spread.alias("bucket"), F.lit(0).cast("long").alias("extra"), (ratio - F.floor(ratio + EPS)).alias("open"))
    done = stored(split.groupBy("source", "bucket").applyInPandas(_bucket, ROUNDED), "mix-rounded")
    most = targets.agg(F.max(buckets)).first()[0] or 1
    open_rows, settled, level = done.where("open is not null and not isnan(open)"), [], 0
    while True:
        level += 1
        up = F.expr(f"bucket div {FAN_IN ** level}").alias("up")
        most = -(-most // FAN_IN)
        out = stored(open_rows.groupBy("source", up).applyInPandas(_combine(level, most == 1), ROUNDED), "mix-combined")
        settled.append(out.where("open is null or isnan(open)"))
        if most == 1:
            break
        open_rows = out.where("open is not null and not isnan(open)")
    rounded = done.where("open is null or isnan(open)")
    for part in settled:
        rounded = rounded.unionByName(part)
    whole = F.floor(F.col("target") / F.col("source_size") + EPS)
    copies = F.when(F.col("size") > 0, whole + F.col("extra")).otherwise(0).cast("long")
    return rounded.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        F.col("r.source").alias("source"), "doc_id", "size", "source_size", "target", copies.alias("copies"))


def cyclic_weights(place: str = "place") -> Column:
    """1, 2, 3, repeating."""
    return F.col(place) % 3 + 1


def document_units(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count("text").alias("size"))


def mix(docs: DataFrame, weights: Column | None = None, cap: float = 3.0) -> DataFrame:
    """Copies of every document (see ``pivotal_copies``); columns doc_id, text and source are used."""
    units = stored(document_units(docs), "mix-units")
    return pivotal_copies(units, source_targets(units, cyclic_weights() if weights is None else weights, cap))


def mix_documents(docs: DataFrame, weights: Column | None = None, cap: float = 3.0) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, all columns.

    Rows are matched by id, source and size. Repeated rows that round differently share their copies out, which
    needs their order only among themselves.
    """
    columns = docs.columns
    plan = mix(docs, weights, cap).groupBy("source", "doc_id", "size").agg(F.sum("copies").alias("copies"), F.count("*").alias("alike"))
    plan = stored(plan, "mix-plan")
    key = {c: fresh_name(docs, f"mix_{c}") for c in ("source", "doc_id", "size")}
    copies, alike = fresh_name(docs, "mix_copies"), fresh_name(docs, "mix_alike")
    keyed = docs.withColumns({key["source"]: F.col("source").cast("string"), key["doc_id"]: F.col("doc_id").cast("long"), key["size"]: word_count("text")})
    plan = plan.select(*(F.col(c).alias("plan_" + key[c]) for c in key), F.col("copies").alias(copies), F.col("alike").alias(alike)).where(F.col(copies) > 0)
    same = [keyed[key[c]].eqNullSafe(plan["plan_" + key[c]]) for c in key]
    met = keyed.join(plan, same[0] & same[1] & same[2])
    once = met.where(F.col(alike) == 1).select(*columns, F.col(copies).alias(copies))
    # Rows alike in id, source and size: the first ones take one copy more.
    turn = Window.partitionBy(*key.values()).orderBy(F.xxhash64("text"))
    share = F.floor((F.col(copies) + F.col(alike) - F.row_number().over(turn)) / F.col(alike))
    more = met.where(F.col(alike) > 1).select(*columns, share.cast("long").alias(copies))
    return _repeat(once.unionByName(more), copies, columns)


def _repeat(rows: DataFrame, copies: str, columns: list[str]) -> DataFrame:
    times = F.when(F.col(copies) > 0, F.sequence(F.lit(1).cast("long"), F.col(copies))).otherwise(F.array().cast("array<bigint>"))
    return rows.withColumn(copies, F.explode(times)).select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken; then source and copies."""
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")
