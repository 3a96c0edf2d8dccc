"""Gold analyses over silver-shaped inputs, each as SQL (primary) and DataFrame twin.

Inputs (any DataFrames with these columns):

* ``facts``      series_id, year, period, value — one row per key, ``Q05`` = annual average
* ``labels``     series_id, sector_name, measure_text, class_text, duration_text, seasonal_text
* ``population`` year, population — sparse (covers some years only), unique on year

Plan shape of ``agg_value_per_year`` (see ``.explain``): scan with the Q05
filter pushed into parquet → partial hash aggregate → exchange on
(series_id, year) → final aggregate → exchange on series_id (over the
aggregated rows only) → window → broadcast left joins to the label and
population dimensions, each hinted only after a count proved it small. Shuffling raw fact
rows by series_id to save the second exchange would send every row of a hot
series to one task; aggregating first keeps that exchange tiny.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import LABEL_SQL, LABEL_TEXT_COLUMNS, compose_label
from tidemark.operators.exact_sums import exact_sums, exact_sums_sql
from tidemark.operators.joins import checked_dimension
from tidemark.operators.parity import multiset_difference
from tidemark.operators.ranking import flag_best

# The period code of the annual average, excluded from sums.
ANNUAL_PERIOD = "Q05"

AGG_VALUE_PER_YEAR_COLUMNS = (
    "series_id", *LABEL_TEXT_COLUMNS, "label", "year", "summed_value", "is_best_year", "population",
)
VALUE_PER_QUARTER_COLUMNS = (
    "series_id", *LABEL_TEXT_COLUMNS, "label", "year", "period", "value", "best_year_per_quarter", "population",
)


@dataclass(frozen=True)
class GoldInputs:
    facts: DataFrame
    labels: DataFrame
    population: DataFrame

    check_labels: bool = False

    def checked(self) -> "GoldInputs":
        """Guard the joins against fan-out and size-check the broadcast sides (two small jobs).

        Population is keyed by (nation, year) upstream but joined on year
        alone, so a second nation would duplicate every fact row: asserted.
        Labels are unique by construction when built from SCD1 tables;
        ``check_labels`` asserts it for other inputs. Each side is broadcast
        only when its counted size is below the bound.
        """
        # The two checks are independent Spark jobs: submit them together so
        # the (possibly large) scans behind each dimension overlap.
        with ThreadPoolExecutor(max_workers=2) as pool:
            population = pool.submit(
                checked_dimension, self.population.select("year", "population"), ["year"], what="population"
            )
            labels = pool.submit(
                checked_dimension, self.labels, ["series_id"] if self.check_labels else None, what="labels"
            )
            return GoldInputs(self.facts, labels.result(), population.result())


def sql_over(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL over DataFrames bound as uniquely named temporary views.

    The SQL names each input as ``IDENTIFIER(:<name>)``; view names are bound
    parameters, never interpolated. Views (unlike DataFrame arguments to
    ``spark.sql``) let the optimizer substitute cached inputs. The plan is
    resolved when ``spark.sql`` returns, so the views are dropped right away.
    """
    tag = uuid.uuid4().hex[:12]
    names = {k: f"tidemark_{k}_{tag}" for k in frames}
    for k, df in frames.items():
        df.createOrReplaceTempView(names[k])
    try:
        return spark.sql(text, args={**(args or {}), **names})
    finally:
        for n in names.values():
            spark.catalog.dropTempView(n)


def _label_columns(labelled: DataFrame) -> DataFrame:
    return labelled.withColumn("label", compose_label())


def _with_labels(df: DataFrame, labels: DataFrame, with_labels: bool) -> DataFrame:
    """Left-join the labels, or (for reports that ignore them) add typed NULL label columns.

    Catalyst cannot drop an unused outer join by itself (it does not know the
    dimension is unique on its key), so skipping it is a caller's choice.
    """
    if with_labels:
        return _label_columns(df.join(labels, "series_id", "left"))
    nulls = {c: F.lit(None).cast("string") for c in (*LABEL_TEXT_COLUMNS, "label")}
    return df.withColumns(nulls)


def _report(df: DataFrame, inp: GoldInputs, columns: tuple[str, ...], with_labels: bool = True) -> DataFrame:
    """The last steps of every report: labels, population of the year, column order."""
    return _with_labels(df, inp.labels, with_labels).join(inp.population, "year", "left").select(*columns)


def _quarters(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("period") != ANNUAL_PERIOD)


def _yearly(facts: DataFrame) -> DataFrame:
    """Rounded exact sums of the quarters by series and year."""
    return exact_sums(_quarters(facts), ["series_id", "year"], "value", "summed_value", 1)


def _report_sql(measures: str, value: str, slot: str, flag: str, columns: tuple[str, ...]) -> str:
    """Pipe-syntax query of a report: quarters, their ``measures``, the best year of each ``slot``, labels, population.

    The best year is an ordered aggregate, the year of the largest (value, earliest year); facts are unique on their key.
    """
    return f"""
    FROM IDENTIFIER(:facts)
    |> WHERE period <> :annual
    |> {measures}
    |> EXTEND year <=> max_by(year, struct({value}, -year)) OVER (PARTITION BY {slot}) AS {flag}
    |> LEFT JOIN IDENTIFIER(:labels) USING (series_id)
    |> LEFT JOIN IDENTIFIER(:population) USING (year)
    |> EXTEND {LABEL_SQL} AS label
    |> SELECT {", ".join(columns)}
    """


def _run_report(spark: SparkSession, text: str, inp: GoldInputs) -> DataFrame:
    inp = inp.checked()
    return sql_over(spark, text, {"annual": ANNUAL_PERIOD}, facts=inp.facts, labels=inp.labels, population=inp.population)


# ---------------------------------------------------------------- agg_value_per_year

def agg_value_per_year_text(facts: DataFrame) -> str:
    """The report as SQL; how values are summed exactly depends on their type."""
    sums = exact_sums_sql(facts.schema["value"].dataType, "value", "summed_value", ["series_id", "year"], 1)
    return _report_sql(sums, "summed_value", "series_id", "is_best_year", AGG_VALUE_PER_YEAR_COLUMNS)


def agg_value_per_year_df(inp: GoldInputs, with_labels: bool = True) -> DataFrame:
    """Per (series, year): rounded sum without Q05, best year flagged, label, population."""
    inp = inp.checked()
    order = [F.col("summed_value").desc(), F.col("year").asc()]
    return _report(flag_best(_yearly(inp.facts), ["series_id"], order, "is_best_year"), inp, AGG_VALUE_PER_YEAR_COLUMNS, with_labels)


def agg_value_per_year_sql(spark: SparkSession, inp: GoldInputs) -> DataFrame:
    return _run_report(spark, agg_value_per_year_text(inp.facts), inp)


# ---------------------------------------------------------------- value_per_quarter

VALUE_PER_QUARTER_SQL = _report_sql(
    "SELECT series_id, year, period, double(value) AS value",
    "value", "series_id, period", "best_year_per_quarter", VALUE_PER_QUARTER_COLUMNS,
)


def value_per_quarter_df(inp: GoldInputs, with_labels: bool = True) -> DataFrame:
    """Per (series, year, period): raw value, best year per (series, period) slot, label, population."""
    inp = inp.checked()
    facts = _quarters(inp.facts).withColumn("value", F.col("value").cast("double"))
    order = [F.col("value").desc(), F.col("year").asc()]
    return _report(flag_best(facts, ["series_id", "period"], order, "best_year_per_quarter"), inp, VALUE_PER_QUARTER_COLUMNS, with_labels)


def value_per_quarter_sql(spark: SparkSession, inp: GoldInputs) -> DataFrame:
    return _run_report(spark, VALUE_PER_QUARTER_SQL, inp)


# ---------------------------------------------------------------- population_stats

# Result column -> aggregate over the years of the window, for both twins.
POPULATION_MEASURES = {
    "year_count": "count(year)",
    "population_mean": "avg(population)",
    "population_stddev_samp": "stddev_samp(population)",
    "population_stddev_pop": "stddev_pop(population)",
}
POPULATION_STATS_SQL = f"""
    FROM IDENTIFIER(:population)
    |> WHERE year >= :start_year AND year <= :end_year
    |> AGGREGATE {", ".join(f"{formula} AS {name}" for name, formula in POPULATION_MEASURES.items())}
"""


def population_stats_df(population: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """One row over an inclusive year window: year_count, mean, sample and population stddev."""
    window = population.filter(F.col("year").between(start_year, end_year))
    return window.agg(*(F.expr(formula).alias(name) for name, formula in POPULATION_MEASURES.items()))


def population_stats_sql(spark: SparkSession, population: DataFrame, start_year: int, end_year: int) -> DataFrame:
    return sql_over(spark, POPULATION_STATS_SQL, {"start_year": start_year, "end_year": end_year}, population=population)


# ---------------------------------------------------------------- reports on top

def best_year_report(inp: GoldInputs) -> DataFrame:
    """One row per series: its best year (filter right after the window → WindowGroupLimit)."""
    inp = inp.checked()
    order = [F.col("summed_value").desc(), F.col("year").asc()]
    best = flag_best(_yearly(inp.facts), ["series_id"], order, "is_best_year").filter("is_best_year")
    return _report(best, inp, AGG_VALUE_PER_YEAR_COLUMNS)


def series_vs_population(inp: GoldInputs, period: str, series_id=None) -> DataFrame:
    """Each series' values of one quarter next to that year's population.

    ``series_id`` narrows to one series for a chart; without it every series is kept.
    """
    out = value_per_quarter_df(inp).filter(F.col("period") == period)
    if series_id is not None:
        out = out.filter(F.col("series_id") == series_id)
    return out.select("series_id", "label", "year", "period", "value", "population")


def twin_difference(a: DataFrame, b: DataFrame) -> tuple[int, int]:
    """(rows in a not in b, rows in b not in a), multiset semantics; schemas must match.

    Equal twins are told by fingerprints of their rows; only buckets that differ are compared row by row.
    """
    if a.schema.simpleString() != b.schema.simpleString():
        raise ValueError(f"twin schemas differ: {a.schema.simpleString()} vs {b.schema.simpleString()}")
    found = multiset_difference(a, b)
    return (0, 0) if found is None else (found[0].count(), found[1].count())
