"""What a step costs a row: no frame folded anew for every row, no method the JVM leaves interpreted."""

import math

import pytest

from tickfold.functions.checks import require_unique
from tickfold.functions.columns import with_rolling
from tickfold.session import configure

VALUES = [3.0, None, 1.0, 1.0, math.inf, 2.5, None, -4.0, 0.0, 7.0, math.nan, 2.0, None, 5.0]
OUTPUTS = {
    "s": ("sum", "x", 4, 3), "a": ("avg", "x", 4, 3), "m": ("median", "x", 5, 2), "one": ("median", "y", 1, 1), "i": ("sum", "y", 2, 2),
}


def _rows(spark):
    rows = [(t, 1, 1, d, d, x, d) for t in ("A", "B") for d, x in enumerate(VALUES if t == "A" else VALUES[:3])]
    return spark.createDataFrame(rows, "ticker string, year int, month int, date int, simfinid long, x double, y long")


def test_rolling_values_equal_sliding_frames(spark):
    frame = "(PARTITION BY ticker ORDER BY year, month, date, simfinid ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
    expected = _rows(spark).selectExpr(
        "ticker", "date",
        f"CASE WHEN count(x) OVER {frame.format(3)} >= 3 THEN sum(x) OVER {frame.format(3)} END AS s",
        f"CASE WHEN count(x) OVER {frame.format(3)} >= 3 THEN sum(x) OVER {frame.format(3)} / count(x) OVER {frame.format(3)} END AS a",
        f"CASE WHEN count(x) OVER {frame.format(4)} >= 2 THEN percentile(x, 0.5D) OVER {frame.format(4)} END AS m",
        "CAST(y AS DOUBLE) AS one",
        f"CASE WHEN count(y) OVER {frame.format(1)} >= 2 THEN sum(y) OVER {frame.format(1)} END AS i",
    )
    found = with_rolling(_rows(spark), OUTPUTS).select(expected.columns)
    assert found.dtypes == expected.dtypes
    assert [str(r) for r in found.sort("ticker", "date").collect()] == [str(r) for r in expected.sort("ticker", "date").collect()]


def test_rolling_values_fold_no_sliding_frame(spark):
    plan = with_rolling(_rows(spark), OUTPUTS)._jdf.queryExecution().optimizedPlan().toString()
    assert "lag(x" in plan and "currentrow" not in plan


def test_wide_steps_are_compiled(spark):
    assert configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_shares_of_the_panel_fit_a_task(spark):
    assert configure(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "24m"


def test_uniqueness_reads_no_text_of_the_row_before(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), (None, 1), (None, 1)], "t string, d int")
    kept = require_unique(df, ["t", "d"], "rows")
    assert "lag(t" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.count() == 4  # a missing key equals none
    for keys, rows in ((["t", "d"], [("A", 1), ("A", 1)]), (["t"], [("A", 1), ("A", 2)])):
        with pytest.raises(Exception, match="duplicate key"):
            require_unique(spark.createDataFrame(rows, "t string, d int"), keys, "rows").collect()
