"""Parquet and CSV tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Input schemas (column names of the vendor files).
COMPANIES = "SimFinId long, Ticker string, `Company Name` string, IndustryId long"
INDUSTRIES = "IndustryId long, Sector string, Industry string"
PRICES = "SimFinId long, Ticker string, Date date, Open double, `Adj. Close` double, Volume double"
RATIOS = (
    "SimFinId long, Ticker string, Date date, `Market-Cap` double, `Price to Book Value` double, "
    "`Price to Free Cash Flow (quarterly)` double, `Price to Free Cash Flow (ttm)` double"
)
CLEAN_PANEL = (
    "ticker string, simfinid long, comp_name string, sector string, industry string, date date, open double, "
    "adj_close double, volume double, market_cap double, p_b double, p_fcf_quart double, p_fcf_ttm double"
)
INPUT_SCHEMAS = {"companies": COMPANIES, "industries": INDUSTRIES, "prices": PRICES, "ratios": RATIOS}


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """CSV with header and a declared schema: no inference pass over the data."""
    return spark.read.schema(schema).csv(path, header=True, sep=sep, dateFormat="yyyy-MM-dd")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("dateFormat", "yyyy-MM-dd").csv(path, header=True)


def read_parquet(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_panel(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Daily panel partitioned by year, so a date range reads only its years.

    Rows are rebalanced by year first: each task writes to few folders, small years share a task, and a year larger than
    the advisory partition size is split over as many tasks as it needs.
    """
    yearly = df.withColumn("panel_year", F.year("date")).hint("rebalance", "panel_year")
    yearly.write.mode(mode).partitionBy("panel_year").parquet(path)


def write_clustered(df: DataFrame, name: str, path: str, key: str, order: tuple[str, ...] = (), buckets: int | None = None) -> None:
    """Table ``name`` of the session catalog, its files below ``path``: dealt into buckets by ``key`` and sorted in them.

    Joins and windows by ``key`` over such tables start without moving a row, as long as they have the same number of
    buckets. Rows are dealt by the same hash before they are written, so a bucket is one file, sorted throughout. ``buckets``
    is the number of shuffle partitions by default; take it so that a bucket fits a task. A key is never split over buckets:
    use it for keys whose rows are bounded, as a ticker's are by the calendar.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(buckets, F.col(f"`{key}`"))
    dealt.write.option("path", path).bucketBy(buckets, key).sortBy(key, *order).saveAsTable(name)


def read_clustered(spark: SparkSession, name: str) -> DataFrame:
    """A table of :func:`write_clustered`, partitioned by its key."""
    return spark.table(name)


def read_panel(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Panel between two dates (inclusive); only the partitions of those years are listed."""
    df = spark.read.schema(CLEAN_PANEL + ", panel_year int").parquet(path)
    if start is not None:
        df = df.filter((F.col("date") >= F.lit(start).cast("date")) & (F.col("panel_year") >= int(start[:4])))
    if end is not None:
        df = df.filter((F.col("date") <= F.lit(end).cast("date")) & (F.col("panel_year") <= int(end[:4])))
    return df.drop("panel_year")
