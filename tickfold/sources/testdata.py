"""Company, industry, price and ratio tables derived from the TPC-H-shaped test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared, so building a plan runs no footer-reading job per table.
SCHEMAS = {
    "supplier": "s_suppkey long, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey long, p_retailprice double",
    "lineitem": "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS SimFinId",
        "concat('S', s_suppkey) AS Ticker",
        "s_name AS `Company Name`",
        "CAST(s_nationkey AS BIGINT) AS IndustryId",
    )


def industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "CAST(n_nationkey AS BIGINT) AS IndustryId", "r_name AS Sector", "n_name AS Industry"
    )


def session_day(column: str) -> str:
    """SQL: the day itself, or the Monday after a weekend."""
    day = f"CAST({column} AS DATE)"
    return f"date_add({day}, CASE weekday({day}) WHEN 5 THEN 2 WHEN 6 THEN 1 ELSE 0 END)"


def calendar_days(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last session of the data; one row is read."""
    found = data_span(spark, sf_dir).selectExpr(f"{session_day('start')} AS s", f"{session_day('end')} AS e").first()
    return str(found["s"]), str(found["e"])


def _observations(spark: SparkSession, sf_dir: str, start: str) -> DataFrame:
    """One row per supplier and session, from all lines, plus one empty row per supplier on the first session."""
    part = table(spark, sf_dir, "part")
    shipped = table(spark, sf_dir, "lineitem")
    # A hot part is split by the adaptive skew join, a hot supplier is folded per task before its rows move.
    sales = shipped.join(part, shipped.l_partkey == part.p_partkey).selectExpr(
        "l_suppkey AS SimFinId",
        f"{session_day('l_shipdate')} AS Date",
        "l_extendedprice AS price",
        "l_quantity AS quantity",
        "p_retailprice AS book",
        "CAST(NULL AS BOOLEAN) AS listed",
    )
    listed = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS SimFinId",
        f"DATE'{start}' AS Date",
        "CAST(NULL AS DOUBLE) AS price",
        "CAST(NULL AS DOUBLE) AS quantity",
        "CAST(NULL AS DOUBLE) AS book",
        "true AS listed",
    )
    folded = (
        sales.unionByName(listed)
        .groupBy("SimFinId", F.expr("concat('S', SimFinId) AS Ticker"), "Date")
        .agg(
            F.max("price").alias("px"),
            F.min("price").alias("op"),
            F.sum("quantity").alias("q"),
            F.max("book").alias("bv"),
            F.max("listed").alias("listed"),
        )
    )
    # One array, so that prices and ratios, which read different values, still share one scan and one shuffle.
    values = "CASE WHEN px IS NOT NULL THEN array(px, op, q, bv) END AS values"
    return folded.selectExpr("SimFinId", "Ticker", "Date", values, "listed")


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations carried forward over the weekday calendar of the data.

    Values are filled and spread between observations *after* the shuffle by ticker, so only the sparse observations
    move, and the dense panel leaves already partitioned by ticker. Days are counted in whole numbers: a sequence of
    dates would go through calendar arithmetic for every element. Two rules remove rows, and nothing else does: they
    stand for gaps in a month and for delisted names.
    """
    start, end = calendar_days(spark, sf_dir)
    order = "PARTITION BY Ticker ORDER BY Date"
    so_far = f"({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    steps = _observations(spark, sf_dir, start).selectExpr(
        "SimFinId",
        "Ticker",
        "Date",
        f"last(values, true) OVER {so_far} AS values",
        f"first(listed) OVER {so_far} AS listed",
        f"datediff(coalesce(lead(Date) OVER ({order}), DATE'{end}' + 1), Date) AS days",
    )
    return (
        steps.filter("listed")
        .selectExpr("SimFinId", "Ticker", "Date", "values", "explode(sequence(0, days - 1)) AS step")
        .selectExpr(
            "SimFinId", "Ticker", "date_add(Date, step) AS Date", "values[0] AS px", "values[1] AS op", "values[2] AS q", "values[3] AS bv"
        )
        .filter("weekday(Date) < 5")
        # said here, or only the right side of the join would learn it, and the two sides would no longer share a scan
        .filter("SimFinId IS NOT NULL AND Ticker IS NOT NULL AND Date IS NOT NULL")
        # incomplete months
        .filter("NOT ((SimFinId * 31 + year(Date) * 12 + month(Date)) % 17 = 0 AND day(Date) = 15)")
        # delisted names
        .filter("NOT (SimFinId % 10 = 9 AND Date >= DATE'2001-06-01')")
    )


def _prices(days: DataFrame) -> DataFrame:
    return days.selectExpr(
        "SimFinId", "Ticker", "Date", "op AS Open", "px AS `Adj. Close`", "q * 1000 AS Volume"
    )


def _ratios(days: DataFrame) -> DataFrame:
    return days.selectExpr(
        "SimFinId",
        "Ticker",
        "Date",
        "px * q * 20000 AS `Market-Cap`",
        "try_divide(px, bv) AS `Price to Book Value`",
        "try_divide(px, bv * 4) AS `Price to Free Cash Flow (quarterly)`",
        "try_divide(op, bv) AS `Price to Free Cash Flow (ttm)`",
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prices(filled(spark, sf_dir))


def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratios(filled(spark, sf_dir))


def inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    days = filled(spark, sf_dir)
    return {
        "companies": companies(spark, sf_dir),
        "industries": industries(spark, sf_dir),
        "prices": _prices(days),
        "ratios": _ratios(days),
    }


def data_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last ship date: one row (start, end)."""
    return table(spark, sf_dir, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("start"), F.max("l_shipdate").cast("date").alias("end")
    )
