"""FIXTURES-shaped product run: restated snapshots → bronze → silver → gold, against hand-computed answers."""

import json
import statistics

import pytest

from tidemark.plans.medallion import POPULATION_SOURCE, SERIES_SOURCE, refresh_everything
from tidemark.sinks.tables import write_landing_snapshot, write_landing_text
from tidemark.streaming.bronze import Layout

SID, VAL = "series_id".ljust(17), "value".rjust(12)
S1, S2 = "20260101T000000Z", "20260909T163000Z"
POP = {2013: 311536594, 2014: 314107084, 2015: 316515021, 2016: 318558162, 2017: 321004407,
       2018: 322903030, 2019: 324697795, 2021: 329725481, 2022: 331097593, 2023: 332387540, 2024: 334914895}


def land(spark, layout, dataset, header, rows, stamp=S2):
    df = spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in header))
    write_landing_snapshot(df, layout.landing, SERIES_SOURCE, dataset, stamp)


@pytest.fixture(scope="module")
def gold_tables(spark, tmp_path_factory):
    from tidemark.session import scratch_path

    root = scratch_path(spark, "e2e")
    layout = Layout(f"{root}/landing", f"{root}/tables", f"{root}/_ck", SERIES_SOURCE)
    data_header = (SID, "year", "period", VAL, "footnote_codes")
    land(spark, layout, "pr.data.1.AllData", data_header, [
        ("PRS30006011", "1995", "Q01", "2.6", ""), ("PRS30006011", "1995", "Q02", "2.1", ""),
        ("PRS30006011", "1995", "Q03", "0.9", ""), ("PRS30006011", "1995", "Q04", "0.1", ""),
        ("PRS30006011", "1995", "Q05", "1.4", ""), ("PRS30006011", "1996", "Q01", "6.7", ""),
        ("PRS30006012", "2019", "Q01", "1.5", ""), ("PRS30006013", "2021", "Q02", "-0.5", ""),
    ], S1)
    land(spark, layout, "pr.data.1.AllData", data_header, [
        ("PRS30006011", "1995", "Q01", "3.6", "P"),   # restated: 1995 now sums to 6.7, tying 1996
        ("PRS30006012", "2019", "Q01", "-", ""),      # withdrawn: quarantined, 1.5 stays current
        ("PRS30006012", "2019", "Q06", "9.9", ""),    # bad period
    ])
    land(spark, layout, "pr.series", (SID, "sector_code", "class_code", "measure_code", "duration_code", "seasonal",
                                      "base_year", "footnote_codes", "begin_year", "begin_period", "end_year", "end_period"), [
        ("PRS30006011", "3000", "6", "01", "1", "S", "-", "", "1947", "Q01", "2024", "Q04"),
        ("PRS30006012", "9999", "6", "01", "3", "U", "2017", "", "1947", "Q01", "2024", "Q04"),
    ])
    land(spark, layout, "pr.sector", ("sector_code", "sector_name", "display_level", "selectable", "sort_sequence"),
         [("3000", "Business sector", "0", "T", "1")])
    land(spark, layout, "pr.measure", ("measure_code", "measure_text", "display_level", "selectable", "sort_sequence"),
         [("01", "Labor productivity", "0", "T", "1")])
    land(spark, layout, "pr.class", ("class_code", "class_text", "display_level", "selectable", "sort_sequence"),
         [("6", "All workers", "0", "F", "1")])
    land(spark, layout, "pr.duration", ("duration_code", "duration_text", "display_level", "selectable", "sort_sequence"),
         [("1", "Index", "0", "X", "1"), ("3", "% change", "0", "T", "2")])
    land(spark, layout, "pr.seasonal", ("Seasonal_code", "Seasonal_text"), [("S", "Seasonally adjusted"), ("U", "Not adjusted")])
    land(spark, layout, "pr.period", ("period", "period_abbr", "period_name"), [("Q01", "QTR1", "1st Quarter")])
    land(spark, layout, "pr.footnote", ("footnote_code", "footnote_text"), [("P", "Preliminary")])
    doc = {"data": [{"Nation ID": "01000US", "Nation": "United States", "Year": y, "Population": p} for y, p in POP.items()]}
    write_landing_text(spark.createDataFrame([(json.dumps(doc),)], "value string"), layout.landing, POPULATION_SOURCE,
                       "population", S2, "population.json")
    return refresh_everything(spark, layout, max_year=2100, stats_years=(2013, 2018))


def test_agg_value_per_year_end_to_end(gold_tables):
    rows = {(r.series_id, r.year): r for r in gold_tables["agg_value_per_year"].collect()}
    assert set(rows) == {("PRS30006011", 1995), ("PRS30006011", 1996), ("PRS30006012", 2019), ("PRS30006013", 2021)}
    a, b = rows[("PRS30006011", 1995)], rows[("PRS30006011", 1996)]
    assert (a.summed_value, b.summed_value) == (6.7, 6.7)
    assert a.is_best_year and not b.is_best_year          # tie → earliest year
    assert a.label == "Business sector, Labor productivity (Index), All workers, Seasonally adjusted"
    c = rows[("PRS30006012", 2019)]
    assert c.summed_value == 1.5 and c.population == POP[2019]
    assert c.label == "Labor productivity (% change), All workers, Not adjusted"   # unknown sector dropped
    d = rows[("PRS30006013", 2021)]
    assert d.label == "" and d.population == POP[2021] and d.summed_value == -0.5


def test_value_per_quarter_end_to_end(gold_tables):
    rows = {(r.series_id, r.year, r.period): r for r in gold_tables["value_per_quarter"].collect()}
    assert rows[("PRS30006011", 1995, "Q01")].value == 3.6
    assert rows[("PRS30006011", 1996, "Q01")].best_year_per_quarter
    assert not any(p == "Q05" for _, _, p in rows)


def test_population_stats_end_to_end(gold_tables):
    r = gold_tables["population_stats"].first()
    window = [POP[y] for y in range(2013, 2019)]
    assert r.year_count == 6
    assert r.population_mean == pytest.approx(statistics.fmean(window))
    assert r.population_stddev_pop == pytest.approx(statistics.pstdev(window))
    assert r.population_stddev_samp == pytest.approx(statistics.stdev(window))
