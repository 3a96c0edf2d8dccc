"""Dataset specs of the productivity-series data product (bronze sources and silver tables).

Fixed values: dataset names, table names, column names, CDC keys and the
quality rules of each silver table, as the source data defines them.
"""

from __future__ import annotations

from tidemark.functions.cleaning import ColumnSpec, TableSpec
from tidemark.operators.quality import Rule
from tidemark.streaming.bronze import SourceSpec

# Landed dataset → bronze table (dots become underscores).
BRONZE_SOURCES = [
    SourceSpec("pr.data.0.Current", "pr_data_0_current", comment="current-window series values"),
    SourceSpec("pr.data.1.AllData", "pr_data_1_alldata", comment="full-history series values"),
    SourceSpec("pr.series", "pr_series", comment="series metadata, one row per series_id"),
    SourceSpec("pr.sector", "pr_sector", comment="sector code dimension"),
    SourceSpec("pr.measure", "pr_measure", comment="measure code dimension"),
    SourceSpec("pr.class", "pr_class", comment="class code dimension"),
    SourceSpec("pr.duration", "pr_duration", comment="duration code dimension"),
    SourceSpec("pr.seasonal", "pr_seasonal", comment="seasonal-adjustment code dimension"),
    SourceSpec("pr.period", "pr_period", comment="period code dimension"),
    SourceSpec("pr.footnote", "pr_footnote", comment="footnote code dimension"),
    SourceSpec("population", "population", fmt="json", comment="population document, one VARIANT per file"),
]

# The last plausible year is the current one; a replay of an earlier run passes that run's year.
CURRENT_YEAR = "year(current_date())"


def _code_dim(name: str, code: str, text: str) -> TableSpec:
    return TableSpec(
        name,
        (
            ColumnSpec(code),
            ColumnSpec(text),
            ColumnSpec("display_level", "int"),
            ColumnSpec("selectable", kind="flag"),
            ColumnSpec("sort_sequence", "int"),
        ),
        keys=(code,),
        rules=(Rule(f"valid_{code}", f"{code} IS NOT NULL"),),
    )


def pr_data(max_year: int | None = None) -> TableSpec:
    return TableSpec(
        "pr_data",
        (
            ColumnSpec("series_id"),
            ColumnSpec("year", "int"),
            ColumnSpec("period"),
            ColumnSpec("value", "double", "sentinel"),
            ColumnSpec("footnote_codes"),
        ),
        keys=("series_id", "year", "period"),
        rules=(
            Rule("valid_series_id", "series_id IS NOT NULL"),
            Rule("valid_year", "year IS NOT NULL"),
            Rule("plausible_year", f"year BETWEEN 1900 AND {CURRENT_YEAR if max_year is None else int(max_year)}"),
            Rule("valid_period", "period RLIKE '^Q0[1-5]$'"),
            Rule("valid_value", "value IS NOT NULL"),
        ),
    )


PR_SERIES = TableSpec(
    "pr_series",
    (
        ColumnSpec("series_id"),
        ColumnSpec("sector_code"),
        ColumnSpec("class_code"),
        ColumnSpec("measure_code"),
        ColumnSpec("duration_code"),
        ColumnSpec("seasonal"),
        ColumnSpec("base_year", "int", "sentinel"),
        ColumnSpec("footnote_codes"),
        ColumnSpec("begin_year", "int"),
        ColumnSpec("begin_period"),
        ColumnSpec("end_year", "int"),
        ColumnSpec("end_period"),
    ),
    keys=("series_id",),
    rules=(Rule("valid_series_id", "series_id IS NOT NULL"),),
)

PR_SECTOR = _code_dim("pr_sector", "sector_code", "sector_name")
PR_MEASURE = _code_dim("pr_measure", "measure_code", "measure_text")
PR_CLASS = _code_dim("pr_class", "class_code", "class_text")
PR_DURATION = _code_dim("pr_duration", "duration_code", "duration_text")

PR_SEASONAL = TableSpec(
    "pr_seasonal",
    (ColumnSpec("seasonal_code", raw="Seasonal_code"), ColumnSpec("seasonal_text", raw="Seasonal_text")),
    keys=("seasonal_code",),
    rules=(Rule("valid_seasonal_code", "seasonal_code IS NOT NULL"),),
)
PR_PERIOD = TableSpec(
    "pr_period",
    (ColumnSpec("period"), ColumnSpec("period_abbr"), ColumnSpec("period_name")),
    keys=("period",),
    rules=(Rule("valid_period", "period IS NOT NULL"),),
)
PR_FOOTNOTE = TableSpec(
    "pr_footnote",
    (ColumnSpec("footnote_code"), ColumnSpec("footnote_text")),
    keys=("footnote_code",),
    rules=(Rule("valid_footnote_code", "footnote_code IS NOT NULL"),),
)

POPULATION = TableSpec(
    "population",
    (
        ColumnSpec("nation_id", raw="Nation ID"),
        ColumnSpec("nation", raw="Nation"),
        ColumnSpec("year", "int", raw="Year"),
        ColumnSpec("population", "bigint", raw="Population"),
    ),
    keys=("nation_id", "year"),
    rules=(Rule("valid_nation_id", "nation_id IS NOT NULL"), Rule("valid_year", "year IS NOT NULL")),
    variant_path="$.data",
)

# Silver table → bronze table it is refreshed from.
SILVER_FROM_BRONZE = {
    "pr_data": "pr_data_1_alldata",
    "pr_series": "pr_series",
    "pr_sector": "pr_sector",
    "pr_measure": "pr_measure",
    "pr_class": "pr_class",
    "pr_duration": "pr_duration",
    "pr_seasonal": "pr_seasonal",
    "pr_period": "pr_period",
    "pr_footnote": "pr_footnote",
    "population": "population",
}


def silver_specs(max_year: int | None = None) -> dict[str, TableSpec]:
    return {
        "pr_data": pr_data(max_year),
        "pr_series": PR_SERIES,
        "pr_sector": PR_SECTOR,
        "pr_measure": PR_MEASURE,
        "pr_class": PR_CLASS,
        "pr_duration": PR_DURATION,
        "pr_seasonal": PR_SEASONAL,
        "pr_period": PR_PERIOD,
        "pr_footnote": PR_FOOTNOTE,
        "population": POPULATION,
    }
