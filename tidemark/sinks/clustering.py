"""Clustering on several keys at once, chosen from column statistics.

Rows are laid along a Z-order curve: each key's value becomes its bucket among equal-depth buckets, and the bits of the buckets are interleaved. Files are ranges of
the curve, so each file is narrow in every key and a filter on any of them, or on several, skips most files by their minima and maxima. An
order by one key after the other would serve the first only.

*Keys* are chosen by :func:`choose_keys` unless given: columns that can be ordered and have values to tell files apart, numbers and times before short strings; of two that
rise together (correlation beyond ``SAME``) one is enough.

*Buckets* come from quantiles of the keys' ordinals over all rows, two levels of at most 32 bounds each, so a row is placed with 64 comparisons a key in built-in functions.

*Hot values.* A value that many rows share fills one bucket; the curve is split further by the row's place in the input, so such rows spread over files. Only the order of rows depends on
any of this, never which rows there are.

Defined cases: null keys count as ordinal 0; a table without a usable key is only packed to size; an empty table gets an empty version.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, FractionalType, NumericType, StringType, TimestampNTZType, TimestampType

from tidemark.sinks.keyed import KeyedTable, ordinal
from tidemark.sinks.maintenance import DEFAULT_TARGET_FILE_BYTES
from tidemark.sinks.packing import file_listing
from tidemark.sinks.tables import BucketedVersionedTable, VersionedTable

MAX_KEYS = 3
CUTS = 8
COMPARED = 8  # columns whose correlations are measured
SAME = 0.95
LONG_TEXT = 64  # strings longer than this on average are contents, not keys
LEVEL_BITS = 5
_PLACE = "__place"


def _rank(kind: DataType) -> int | None:
    """0 for numbers and times, 1 for strings, None for what has no order of use here."""
    if isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        return 0
    return 1 if isinstance(kind, StringType) else None


def _ordinal(name: str, kind: DataType, prefix: str = "") -> Column:
    if isinstance(kind, TimestampNTZType):
        return F.coalesce(F.unix_micros(F.col(f"`{name}`").cast("timestamp")), F.lit(0).cast("long"))
    if isinstance(kind, (FractionalType, DecimalType)):
        # Logarithms keep the order and tell small values apart as well as large ones.
        value = F.col(f"`{name}`").cast("double")
        scaled = F.signum(value) * F.log1p(F.abs(value)) * F.lit(1e12)
        return F.coalesce(F.when(~F.isnan(scaled), scaled).cast("decimal(38,0)").try_cast("long"), F.lit(0).cast("long"))
    return ordinal(name, kind, prefix)


def choose_keys(df: DataFrame, max_keys: int = MAX_KEYS) -> list[str]:
    """The columns to cluster on, best first: two passes of aggregates, one row each."""
    known = [(f.name, _rank(f.dataType), f.dataType) for f in df.schema.fields if _rank(f.dataType) is not None]
    if not known:
        return []
    aggs = [F.approx_count_distinct(F.col(f"`{n}`")).alias(f"d{i}") for i, (n, _, _) in enumerate(known)]
    aggs += [F.avg(F.length(F.col(f"`{n}`"))).alias(f"l{i}") for i, (n, r, _) in enumerate(known) if r == 1]
    row = df.agg(*aggs).first().asDict()
    able = [(r, -row[f"d{i}"], n, kind) for i, (n, r, kind) in enumerate(known) if row[f"d{i}"] > 1 and (row.get(f"l{i}") or 0) <= LONG_TEXT]
    able.sort(key=lambda t: t[:3])
    able = able[:COMPARED]
    pairs = list(combinations(range(len(able)), 2))
    if not pairs:
        return [t[2] for t in able[:max_keys]]
    places = df.select(*[_ordinal(n, kind).cast("double").alias(f"o{i}") for i, (_, _, n, kind) in enumerate(able)])
    corr = places.agg(*[F.corr(f"o{a}", f"o{b}").alias(f"c{a}_{b}") for a, b in pairs]).first()
    chosen: list[int] = []
    for i in range(len(able)):
        if all(abs(corr[f"c{a}_{i}"] or 0.0) <= SAME for a in chosen):
            chosen.append(i)
    return [able[i][2] for i in chosen[:max_keys]]


def _bucket(place: Column, cuts: list[int], bits: int) -> Column:
    """The bucket of an ordinal among ``2**bits`` whose inner bounds are ``cuts``, in two levels."""
    low = bits // 2 if bits > LEVEL_BITS else 0
    step = 1 << low

    def longs(values: list[int]) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in values]) if values else F.array().cast("array<bigint>")

    def reached(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda b: b <= place))

    coarse = reached(longs(cuts[step - 1 :: step]))
    if not low:
        return coarse
    fine = F.array(*[longs(cuts[g * step : g * step + step - 1]) for g in range(1 << (bits - low))])
    return coarse * step + reached(F.get(fine, coarse))


def curve(df: DataFrame, keys: list[str], n_files: int) -> DataFrame:
    """``df`` with ``__place``, the rows' place on the Z-order curve over ``keys``; cells are finer than files."""
    bits = min(2 * LEVEL_BITS, max(1, math.ceil(math.log2(max(2, n_files)) / len(keys)) + 2), 60 // len(keys))
    kinds = {k: df.schema[k].dataType for k in keys}
    at = [k / (1 << bits) for k in range(1, 1 << bits)]
    # One prefix per string key, so that its ordinal uses the bytes that differ.
    ends = df.agg(F.lit(0).alias("_"), *[f(f"`{k}`").alias(f"{n}{i}") for i, k in enumerate(keys) if isinstance(kinds[k], StringType) for n, f in (("low", F.min), ("high", F.max))]).first()
    prefix = {}
    for i, k in enumerate(keys):
        low, high = (ends[f"low{i}"] or "", ends[f"high{i}"] or "") if isinstance(kinds[k], StringType) else ("", "")
        prefix[k] = low[: next((j for j, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))]
    places = [_ordinal(k, kinds[k], prefix[k]) for k in keys]
    cuts = df.agg(*[F.percentile_approx(p, at, 10_000).alias(f"q{i}") for i, p in enumerate(places)]).first()
    code = F.lit(0).cast("long")
    for i, place in enumerate(places):
        bucket = _bucket(place, list(cuts[f"q{i}"] or []), bits).cast("long")
        df = df.withColumn(f"__b{i}", bucket)
    for bit in range(bits):
        for i in range(len(keys)):
            one = F.shiftright(F.col(f"__b{i}"), bit).bitwiseAND(F.lit(1).cast("long"))
            code = code.bitwiseOR(F.shiftleft(one, bit * len(keys) + len(keys) - 1 - i))
    return df.withColumn(_PLACE, code).drop(*[f"__b{i}" for i in range(len(keys))])


def clustered(df: DataFrame, keys: list[str], n_files: int) -> DataFrame:
    """``df`` in ``n_files`` ranges of the curve, each sorted along it."""
    placed = curve(df, keys, n_files).withColumn("__row", F.monotonically_increasing_id())
    return placed.repartitionByRange(n_files, _PLACE, "__row").sortWithinPartitions(_PLACE, *[F.col(f"`{k}`") for k in keys]).drop(_PLACE, "__row")


def cluster(table: VersionedTable, keys: list[str] | None = None, target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES) -> tuple[int, list[str]]:
    """Commit a version of the same rows clustered on ``keys`` (chosen from the rows unless given); returns (version, keys).

    A commit made meanwhile wins (``CommitConflict``). Keyed and bucketed tables have an order of their own and are refused.
    """
    if isinstance(table, (KeyedTable, BucketedVersionedTable)):
        raise ValueError(f"{table.path} keeps its own order")
    version = table.current_version()
    if version is None:
        raise ValueError(f"{table.path} has no committed version")
    current = table.read(version)
    size = file_listing(table.spark, [table.version_path(version)]).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    n_files = max(1, math.ceil(size / target_file_bytes))
    if keys is None:
        # A curve over more keys than the files can tell apart serves none of them: each is to be cut in CUTS at least.
        keys = choose_keys(current, max(1, min(MAX_KEYS, int(math.log(max(2, n_files), CUTS) + 1e-9))))
    else:
        keys = list(keys)
    out = clustered(current, keys, n_files) if keys and n_files > 1 else current.repartition(n_files)
    return table.commit(out, note=f"cluster by {', '.join(keys)}" if keys else "compact", current=version), keys


def file_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """file, rows, and low and high of each column: what a scan's statistics tell of the files behind ``df``."""
    ends = [f(f"`{c}`").alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)


def files_read(ranges: DataFrame, **between: tuple) -> float:
    """The share of files that a filter ``low <= column <= high`` on all given columns cannot skip."""
    may = F.lit(True)
    for c, (low, high) in between.items():
        may = may & (F.col(f"high_{c}") >= F.lit(low)) & (F.col(f"low_{c}") <= F.lit(high))
    return float(ranges.agg(F.avg(F.coalesce(may, F.lit(False)).cast("double")).alias("share")).first()["share"] or 0.0)
