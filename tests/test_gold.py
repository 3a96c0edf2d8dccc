"""Gold analyses on small silver-shaped fixtures; SQL and DataFrame twins must agree."""

import pytest

from tidemark.plans import gold


@pytest.fixture()
def inputs(spark):
    facts = spark.createDataFrame(
        [("PRS30006011", 1995, p, v) for p, v in [("Q01", 2.6), ("Q02", 2.1), ("Q03", 0.9), ("Q04", 0.1), ("Q05", 1.4)]]
        + [("PRS30006011", 1996, "Q01", 5.7)]          # ties 1995 after rounding -> 1995 wins
        + [("PRS30006011", 2019, "Q01", 1.0)]
        + [("PRS2", 2019, "Q01", 3.0), ("PRS2", 2019, None, 100.0)],  # NULL period dropped (T6)
        "series_id string, year int, period string, value double",
    )
    labels = spark.createDataFrame(
        [("PRS30006011", "Business", "Labor productivity", "All workers", "Index", None), ("PRS2", None, None, None, None, None)],
        "series_id string, sector_name string, measure_text string, class_text string, duration_text string, seasonal_text string",
    )
    population = spark.createDataFrame([(2019, 328239523), (2021, 331893745)], "year int, population bigint")
    return gold.GoldInputs(facts, labels, population)


def test_agg_value_per_year(spark, inputs):
    rows = {(r.series_id, r.year): r for r in gold.agg_value_per_year_df(inputs).collect()}
    assert rows[("PRS30006011", 1995)].summed_value == 5.7
    assert rows[("PRS30006011", 1995)].is_best_year and not rows[("PRS30006011", 1996)].is_best_year
    assert rows[("PRS30006011", 1995)].population is None and rows[("PRS30006011", 2019)].population == 328239523
    assert rows[("PRS30006011", 1995)].label == "Business, Labor productivity (Index), All workers"
    assert rows[("PRS2", 2019)].summed_value == 3.0 and rows[("PRS2", 2019)].label == ""
    assert list(gold.agg_value_per_year_df(inputs).columns) == list(gold.AGG_VALUE_PER_YEAR_COLUMNS)


@pytest.mark.parametrize("name", ["agg_value_per_year", "value_per_quarter"])
def test_twins_agree(spark, inputs, name):
    sql = getattr(gold, f"{name}_sql")(spark, inputs)
    df = getattr(gold, f"{name}_df")(inputs)
    assert gold.twin_difference(sql, df) == (0, 0)


def test_population_stats_twins(spark, inputs):
    s = gold.population_stats_sql(spark, inputs.population, 2013, 2024)
    d = gold.population_stats_df(inputs.population, 2013, 2024)
    assert gold.twin_difference(s, d) == (0, 0)
    r = d.first()
    assert r.year_count == 2 and r.population_stddev_pop == pytest.approx(1827111.0)


def test_value_per_quarter_best_per_slot(spark, inputs):
    rows = gold.value_per_quarter_df(inputs).collect()
    best = {(r.series_id, r.period): r.year for r in rows if r.best_year_per_quarter}
    assert best[("PRS30006011", "Q01")] == 1996
    assert all(r.period != "Q05" and r.period is not None for r in rows)


def test_best_year_report_one_row_per_series(spark, inputs):
    rep = gold.best_year_report(inputs)
    assert rep.count() == 2
    assert {(r.series_id, r.year) for r in rep.collect()} == {("PRS30006011", 1995), ("PRS2", 2019)}


def test_population_must_be_unique_on_year(spark, inputs):
    dup = spark.createDataFrame([(2019, 1), (2019, 2)], "year int, population bigint")
    with pytest.raises(ValueError):
        gold.agg_value_per_year_df(gold.GoldInputs(inputs.facts, inputs.labels, dup))


def test_series_vs_population(spark, inputs):
    got = gold.series_vs_population(inputs, "Q01", "PRS30006011").collect()
    assert sorted((r.year, r.population) for r in got) == [(1995, None), (1996, None), (2019, 328239523)]


def test_without_labels_skips_the_join(spark, inputs):
    df = gold.agg_value_per_year_df(inputs, with_labels=False)
    assert df.columns == list(gold.AGG_VALUE_PER_YEAR_COLUMNS)
    assert df.filter("label IS NOT NULL").count() == 0
    with_l = gold.agg_value_per_year_df(inputs)
    assert gold.twin_difference(df.drop(*gold.LABEL_TEXT_COLUMNS, "label"), with_l.drop(*gold.LABEL_TEXT_COLUMNS, "label")) == (0, 0)
    def joins(d):
        return d._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")

    assert (joins(df), joins(with_l)) == (1, 2)  # population only vs labels + population
