"""Sums of doubles without rounding on the way, by built-in functions only.

A double is a whole number of at most 62 bits times a power of two. Values are split by their exponent into bins of
``BIN_BITS`` bits; within a bin all values are whole multiples of one power of two, so their sum, taken as DECIMAL, is exact and
merges in any order: per task, per (keys, bin), then per key over the at most 270 bins. There the bins are
added as base-256 digits with carry, and the digits are rounded once, to the nearest double (ties to even). The result
therefore does not depend on the order, the split or the magnitudes of the values, and cancelling values leave no rest.

Defined cases: NULL values are left out, and a group of NULLs sums to NULL; any NaN, or infinities of both signs, give NaN; infinities of
one sign give that infinity; a sum beyond the largest double is infinite; a sum of zeros is 0.0. DECIMAL and whole-number columns need no bins: they
are summed as they are. A key may hold 2e13 values of one bin; beyond that the DECIMAL overflows and the job fails rather than give a wrong sum.

Rounding to digits is half up, with a tolerance of four units in the last place: doubles of decimal amounts (0.15, 1234567.85)
lie just beside the half and round as the amounts do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

BIN_BITS = 8
_TOP = 54  # a value of bin b is below 2**(BIN_BITS * b + BIN_BITS) and scaled by 2**(_TOP - BIN_BITS * b)
_CARRY = 14  # further base-256 digits that a bin's sum can fill
_NAN, _PLUS, _MINUS = 4001, 4002, 4003
_WIDE = "DECIMAL(38, 0)"


def _power(exponent: str) -> str:
    """2**exponent as two exact factors, since one may be beyond the doubles."""
    return f"pow(2D, ({exponent}) div 2) * pow(2D, ({exponent}) - ({exponent}) div 2)"


def bin_sql(value: str) -> str:
    """The bin of a double: INT, NULL for NULL."""
    v = f"double({value})"
    return (
        f"CASE WHEN {value} IS NULL THEN NULL WHEN isnan({v}) THEN {_NAN} WHEN {v} = double('Infinity') THEN {_PLUS} WHEN {v} = double('-Infinity') THEN {_MINUS} "
        f"WHEN {v} = 0 THEN 0 ELSE int(floor(log2(abs({v})) / {BIN_BITS})) END"
    )


def part_sql(value: str, bin_name: str) -> str:
    """The whole number that a double adds to its bin; aggregates as an exact sum."""
    v = f"double({value})"
    scaled = f"{v} * {_power(f'{_TOP} - {BIN_BITS} * {bin_name}')}"
    return f"SUM(CASE WHEN {bin_name} < {_NAN} THEN CAST(CAST({scaled} AS BIGINT) AS DECIMAL(28, 0)) WHEN {bin_name} IS NOT NULL THEN CAST(0 AS DECIMAL(28, 0)) END)"


def bins_sql(bin_name: str, part_name: str) -> str:
    """The bins of a group as a map, at most 270 entries."""
    return f"map_from_entries(collect_list(struct({bin_name}, {part_name})) FILTER (WHERE {bin_name} IS NOT NULL))"


def _let(name: str, bound: str, body: str) -> str:
    return f"transform(array({bound}), {name} -> {body})[0]"


def _digits(sign: str) -> str:
    """carry and base-256 digits, lowest first, of the sum of the finite bins ``f``, times ``sign``."""
    step = _let(
        "a", f"CAST(s.carry + coalesce(try_element_at(f, b), 0) * {sign} AS {_WIDE})",
        f"named_struct('carry', CAST((a - pmod(a, CAST(256 AS {_WIDE}))) / 256 AS {_WIDE}), 'digits', concat(s.digits, array(CAST(pmod(a, CAST(256 AS {_WIDE})) AS BIGINT))))",
    )
    return (
        f"aggregate(sequence(array_min(map_keys(f)), array_max(map_keys(f)) + {_CARRY}), "
        f"named_struct('carry', CAST(0 AS {_WIDE}), 'digits', CAST(array() AS ARRAY<BIGINT>)), (s, b) -> {step})"
    )


def total_sql(bins: str) -> str:
    """The nearest double of the sum of the bins."""
    # The eight highest digits from the first that is not 0, made odd where lower digits are not 0, round like the whole sum.
    value = (
        "aggregate(sequence(hi, greatest(hi - 7, 1), -1), CAST(0 AS DECIMAL(20, 0)), (x, i) -> CAST(x * 256 + d[int(i) - 1] AS DECIMAL(20, 0)))"
    )
    sticky = "hi > 8 AND exists(slice(d, 1, greatest(hi - 8, 1)), x -> x <> 0)"
    exponent = f"{BIN_BITS} * (array_min(map_keys(f)) + greatest(hi - 7, 1) - 1) - {_TOP}"
    number = _let("w", value, f"double(w + CASE WHEN {sticky} AND w % 2 = 0 THEN 1 ELSE 0 END) * {_power(exponent)}")
    highest = "aggregate(sequence(1, size(d)), 0, (m, i) -> CASE WHEN d[i - 1] <> 0 THEN i ELSE m END)"
    finite = _let(
        "up", _digits("1"),
        "CASE WHEN up.carry < 0 THEN -" + _let("d", f"{_digits('-1')}.digits", _let("hi", highest, number))
        + " ELSE " + _let("d", "up.digits", _let("hi", highest, f"CASE WHEN hi = 0 THEN 0D ELSE {number} END")) + " END",
    )
    has = lambda k: f"map_contains_key({bins}, {k})"
    return (
        f"CASE WHEN {bins} IS NULL OR size({bins}) < 1 THEN NULL WHEN {has(_NAN)} OR ({has(_PLUS)} AND {has(_MINUS)}) THEN double('NaN') "
        f"WHEN {has(_PLUS)} THEN double('Infinity') WHEN {has(_MINUS)} THEN double('-Infinity') "
        f"ELSE {_let('f', f'map_filter({bins}, (k, x) -> k < {_NAN})', finite)} END"
    )


def rounded_sql(value: str, digits: int) -> str:
    """A double rounded half up at ``digits``; up to four units in its last place below a half count as the half."""
    return f"CASE WHEN abs({value}) < 1e300D THEN round({value} * (1D + pow(2D, -51D)), {int(digits)}) ELSE {value} END"


def is_binary(kind: DataType) -> bool:
    return isinstance(kind, (DoubleType, FloatType))


def exact_sums_sql(kind: DataType, value: str, name: str, keys: list[str], digits: int | None = None) -> str:
    """Pipe steps (after ``FROM ... |>``) that give ``keys`` and the exact sum ``name``."""
    by = ", ".join(keys)
    if not is_binary(kind):
        total = f"SUM({value})" if digits is None else f"round(SUM({value}), {int(digits)})"
        return f"AGGREGATE double({total}) AS {name} GROUP BY {by}"
    final = total_sql("exact_bins")
    shown = "exact_total" if digits is None else rounded_sql("exact_total", digits)
    return f"""EXTEND {bin_sql(value)} AS exact_bin
    |> AGGREGATE {part_sql(value, "exact_bin")} AS exact_part GROUP BY {by}, exact_bin
    |> AGGREGATE {bins_sql("exact_bin", "exact_part")} AS exact_bins GROUP BY {by}
    |> EXTEND {final} AS exact_total
    |> SELECT {by}, {shown} AS {name}"""


def exact_sums(df: DataFrame, keys: list[str], value: str, name: str, digits: int | None = None) -> DataFrame:
    """``keys`` and ``name``: the exact sum of ``value`` as a DOUBLE, rounded half up at ``digits`` if given.

    Two partial aggregates: rows by (keys, bin) inside their tasks, then a few bins per key. A hot key is added up in every task.
    """
    if not is_binary(df.schema[value].dataType):
        total = F.sum(value)
        return df.groupBy(*keys).agg((total if digits is None else F.round(total, digits)).cast("double").alias(name))
    slim = df.select(*keys, F.col(value).alias("exact_value")).withColumn("exact_bin", F.expr(bin_sql("exact_value")))
    parts = slim.groupBy(*keys, "exact_bin").agg(F.expr(part_sql("exact_value", "exact_bin")).alias("exact_part"))
    bins = parts.groupBy(*keys).agg(F.expr(bins_sql("exact_bin", "exact_part")).alias("exact_bins"))
    totals = bins.withColumn("exact_total", F.expr(total_sql("exact_bins")))
    return totals.select(*keys, F.expr("exact_total" if digits is None else rounded_sql("exact_total", digits)).alias(name))
