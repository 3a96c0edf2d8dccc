"""The data product end to end: landing → bronze → silver → gold.

Refreshes are decoupled: bronze ingests whatever has landed, silver upserts
whatever bronze holds, gold recomputes from current silver. Each step is a
function of table state only, so any step can be rerun after a failure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.joins import Dim, star_join
from tidemark.plans import gold
from tidemark.plans.series_specs import BRONZE_SOURCES, SILVER_FROM_BRONZE, silver_specs
from tidemark.session import path_exists, scratch_path
from tidemark.sinks.tables import VersionedTable, materialize
from tidemark.streaming.bronze import Layout, SourceSpec, await_all, start_bronze
from tidemark.streaming.silver import read_silver, start_silver

# The two landing sources of the product.
SERIES_SOURCE = "bls_pr"
POPULATION_SOURCE = "datausa_population"


@dataclass(frozen=True)
class Namespace:
    """Environment-parameterised names: ``<prefix>_<env>`` roots for every layer."""

    prefix: str
    env: str
    root: str

    @property
    def layout(self) -> Layout:
        base = f"{self.root.rstrip('/')}/{self.prefix}_{self.env}"
        return Layout(landing=f"{base}/landing", tables=f"{base}/tables", checkpoints=f"{base}/_checkpoints", source=SERIES_SOURCE)

    def database(self, layer: str) -> str:
        return f"{self.prefix}_{self.env}_{layer}"

    @classmethod
    def from_session(cls, spark: SparkSession, root: str | None = None) -> "Namespace":
        """Names from session configuration: ``tidemark.prefix``, ``tidemark.env`` and ``tidemark.root``.

        The root is where the product lives from run to run. Only a local session may leave it out: it gets a fresh one.
        """
        prefix = spark.conf.get("tidemark.prefix", "tidemark")
        env = spark.conf.get("tidemark.env", "dev")
        root = root or spark.conf.get("tidemark.root", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("tidemark.root must name the product's folder on shared storage")
            root = scratch_path(spark, "medallion")
        return cls(prefix, env, root)


def layout_for(layout: Layout, spec: SourceSpec) -> Layout:
    """The population document lands under its own source directory."""
    if spec.fmt == "json":
        return Layout(layout.landing, layout.tables, layout.checkpoints, POPULATION_SOURCE)
    return layout


def refresh_all_bronze(spark: SparkSession, layout: Layout, specs: list[SourceSpec] = BRONZE_SOURCES, only: set[str] | None = None) -> None:
    """Refresh every bronze table that has landed files; the streams run concurrently."""
    started = []
    for spec in specs:
        lay = layout_for(layout, spec)
        if (only is None or spec.table in only) and path_exists(spark, lay.landing_dir(spec)):
            started.append(start_bronze(spark, spec, lay)[0])
    await_all(started)


def refresh_all_silver(spark: SparkSession, layout: Layout, max_year: int | None = None, only: set[str] | None = None) -> dict[str, VersionedTable]:
    """Refresh every silver table whose bronze table exists; the streams run concurrently."""
    started = {}
    for name, spec in silver_specs(max_year).items():
        bronze = SILVER_FROM_BRONZE[name]
        if (only is None or name in only) and path_exists(spark, layout.table_path("bronze", bronze)):
            started[name] = start_silver(spark, spec, layout, bronze)
    await_all([q for q, _ in started.values()])
    return {name: table for name, (_, table) in started.items()}


def silver(spark: SparkSession, layout: Layout, name: str) -> DataFrame | None:
    return read_silver(VersionedTable(spark, layout.table_path("silver", name)))


def gold_table(spark: SparkSession, layout: Layout, name: str) -> DataFrame | None:
    """The current version of a gold table."""
    return VersionedTable(spark, layout.table_path("gold", name)).read()


def _or_empty(spark: SparkSession, df: DataFrame | None, schema: str) -> DataFrame:
    return df if df is not None else spark.createDataFrame([], schema)


def gold_inputs_from_silver(spark: SparkSession, layout: Layout) -> gold.GoldInputs:
    """Facts, star labels (4 same-named keys + the renamed seasonal key) and population."""
    facts = silver(spark, layout, "pr_data").select("series_id", "year", "period", "value")

    def dim(name: str, code: str, text: str) -> DataFrame:
        return _or_empty(spark, silver(spark, layout, name), f"{code} string, {text} string")

    series = silver(spark, layout, "pr_series").select(
        "series_id", "sector_code", "class_code", "measure_code", "duration_code", "seasonal"
    )
    labelled = star_join(
        series,
        [
            Dim(dim("pr_sector", "sector_code", "sector_name"), "sector_code", "sector_code", ("sector_name",)),
            Dim(dim("pr_measure", "measure_code", "measure_text"), "measure_code", "measure_code", ("measure_text",)),
            Dim(dim("pr_class", "class_code", "class_text"), "class_code", "class_code", ("class_text",)),
            Dim(dim("pr_duration", "duration_code", "duration_text"), "duration_code", "duration_code", ("duration_text",)),
            Dim(dim("pr_seasonal", "seasonal_code", "seasonal_text"), "seasonal", "seasonal_code", ("seasonal_text",)),
        ],
    ).select("series_id", "sector_name", "measure_text", "class_text", "duration_text", "seasonal_text")
    population = _or_empty(spark, silver(spark, layout, "population"), "nation_id string, nation string, year int, population bigint")
    return gold.GoldInputs(facts, labelled, population.select("year", "population"))


# Gold window of the population statistics (inclusive).
POPULATION_STATS_YEARS = (2013, 2018)


def refresh_gold(spark: SparkSession, layout: Layout, stats_years: tuple[int, int] = POPULATION_STATS_YEARS) -> dict[str, DataFrame]:
    """Recompute the gold tables from current silver; each is swapped to its new version when that is written whole."""
    inp = gold_inputs_from_silver(spark, layout)
    lo, hi = stats_years
    return {
        "agg_value_per_year": materialize(gold.agg_value_per_year_sql(spark, inp), layout.table_path("gold", "agg_value_per_year")),
        "value_per_quarter": materialize(gold.value_per_quarter_sql(spark, inp), layout.table_path("gold", "value_per_quarter")),
        "population_stats": materialize(
            gold.population_stats_sql(spark, inp.population, lo, hi), layout.table_path("gold", "population_stats")
        ),
    }


def refresh_everything(
    spark: SparkSession, layout: Layout, max_year: int | None = None, stats_years: tuple[int, int] = POPULATION_STATS_YEARS
) -> dict[str, DataFrame]:
    refresh_all_bronze(spark, layout)
    refresh_all_silver(spark, layout, max_year)
    return refresh_gold(spark, layout, stats_years)
