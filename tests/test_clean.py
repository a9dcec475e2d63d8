from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from tickfold.functions.checks import key_violations, require_unique
from tickfold.functions.columns import nan_to_null
from tickfold.operators import clean
from tickfold.sources import files, jdbc

DAY = dt.date(2020, 1, 2)


def test_size_classes_at_their_floors(spark):
    cases = {
        2e11: "mega", 2e11 - 1: "large", 1e10: "large", 1e10 - 1: "mid", 2e9: "mid", 2e9 - 1: "small", 3e8: "small",
        3e8 - 1: "micro", 5e7: "micro", 5e7 - 1: "penny", -1.0: "penny",
    }
    rows = [(v,) for v in cases] + [(None,), (float("nan"),)]
    df = clean.market_cap(nan_to_null(spark.createDataFrame(rows, "market_cap double")))
    got = [r.market_cap_cat for r in df.collect()]
    assert got == [*cases.values(), "other", "other"]


def test_filter_data_drops_missing_and_small(spark):
    rows = [("A", "mid", 1.0), ("B", "penny", 1.0), ("C", "other", 1.0), ("D", "mid", None)]
    df = clean.filter_data(spark.createDataFrame(rows, "ticker string, market_cap_cat string, x double"))
    assert [r.ticker for r in df.collect()] == ["A"]


def test_filter_dates_includes_both_ends(spark):
    rows = [(dt.date(2020, 1, d),) for d in range(1, 6)]
    df = clean.filter_dates(spark.createDataFrame(rows, "date date"), "2020-01-02", "2020-01-04")
    assert sorted(r.date.day for r in df.collect()) == [2, 3, 4]


def _inputs(spark, prices=None, ratios=None):
    prices = prices or [(1, "A", DAY, 10.0, 11.0, 100.0), (2, "B", DAY, 20.0, float("nan"), 200.0)]
    ratios = ratios or [(1, "A", DAY, 1e9, 1.0, 2.0, 3.0)]
    return {
        "companies": spark.createDataFrame([(1, "A", "Aco", 7), (2, "B", "Bco", 9)], files.COMPANIES),
        "industries": spark.createDataFrame([(7, "Tech", "Chips")], files.INDUSTRIES),
        "prices": spark.createDataFrame(prices, files.PRICES),
        "ratios": spark.createDataFrame(ratios, files.RATIOS),
    }


def test_join_keeps_unmatched_prices(spark):
    rows = {r.ticker: r for r in clean.intro_clean_data(clean.join_data(**_inputs(spark))).collect()}
    assert rows["A"].sector == "Tech" and rows["A"].market_cap == 1e9
    assert rows["B"].comp_name == "Bco" and rows["B"].sector is None and rows["B"].p_b is None
    assert rows["B"].adj_close is None  # NaN becomes NULL


@pytest.mark.parametrize("side", ["prices", "ratios"])
def test_join_fails_on_repeated_keys(spark, side):
    double = {
        "prices": [(1, "A", DAY, 10.0, 11.0, 100.0)] * 2,
        "ratios": [(1, "A", DAY, 1e9, 1.0, 2.0, 3.0)] * 2,
    }[side]
    with pytest.raises(PySparkException, match="duplicate key"):
        clean.join_data(**_inputs(spark, **{side: double})).collect()
    assert clean.join_data(**_inputs(spark, **{side: double}), validate=False).count() >= 2


def test_join_fails_on_two_companies_under_one_ticker(spark):
    prices = [(1, "A", DAY, 10.0, 11.0, 100.0), (2, "A", DAY, 20.0, 21.0, 200.0)]
    with pytest.raises(PySparkException, match="prices: duplicate key"):
        clean.join_data(**_inputs(spark, prices)).collect()
    changed = [(1, "A", DAY, 10.0, 11.0, 100.0), (2, "A", dt.date(2020, 1, 3), 20.0, 21.0, 200.0)]
    assert clean.join_data(**_inputs(spark, changed)).count() == 2


def test_rows_without_ticker(spark):
    with pytest.raises(PySparkException, match="prices: a row without Ticker"):
        clean.join_data(**_inputs(spark, prices=[(1, None, DAY, 1.0, 1.0, 1.0)])).collect()
    assert clean.join_data(**_inputs(spark, ratios=[(1, None, DAY, 1.0, 1.0, 1.0, 1.0)] * 2)).count() == 2


def test_unique_checks(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (1, "x")], "a int, b string")
    assert [(r.a, r.b, r.n_rows) for r in key_violations(df, ["a", "b"]).collect()] == [(1, "x", 2)]
    with pytest.raises(PySparkException, match="things: duplicate key"):
        require_unique(df, ["a", "b"], "things").collect()
    with pytest.raises(PySparkException, match="duplicate key"):
        require_unique(df.select("a"), ["a"], "things").collect()
    assert require_unique(df.dropDuplicates(), ["a", "b"], "things").count() == 3


def test_csv_and_panel_files(spark, tmp_path):
    inputs = _inputs(spark)
    files.write_csv(inputs["prices"], str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), files.PRICES)
    assert back.dtypes == inputs["prices"].dtypes and back.count() == 2
    files.write_panel(clean.intro_clean_data(clean.join_data(**inputs)), str(tmp_path / "panel"))
    assert files.read_panel(spark, str(tmp_path / "panel"), "2020-01-01", "2020-12-31").count() == 2
    later = files.read_panel(spark, str(tmp_path / "panel"), "2021-01-01")
    assert later.count() == 0
    assert "PartitionFilters: [isnotnull(panel_year" in later._jdf.queryExecution().executedPlan().toString()


def test_jdbc_options():
    options = jdbc.table_options("t", "jdbc:x", '"Date"', "2007-01-01", "2021-12-31", 8, user="u")
    assert options["numPartitions"] == "8" and options["user"] == "u" and options["partitionColumn"] == '"Date"'
    assert jdbc.query_options("select 1", "jdbc:x") == {"url": "jdbc:x", "query": "select 1"}
