"""The four input tables from a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

def query_options(sql: str, url: str, **connection: str) -> dict[str, str]:
    """Options of a whole-query read; the database sends the result over one connection."""
    return {"url": url, "query": sql, **connection}


def table_options(
    table: str, url: str, column: str, lower: str, upper: str, partitions: int, fetch_size: int = 10_000, **connection: str
) -> dict[str, str]:
    """Options of a split read: ``partitions`` ranges of ``column``, one connection each.

    Rows outside [lower, upper] are still read (by the first and last range); the bounds only place the cuts.
    """
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        **connection,
    }


def read_query(spark: SparkSession, sql: str, url: str, **connection: str) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(sql, url, **connection)).load()


def read_table(spark: SparkSession, table: str, url: str, column: str, lower, upper, partitions: int, **connection: str):
    options = table_options(table, url, column, lower, upper, partitions, **connection)
    return spark.read.format("jdbc").options(**options).load()


def read_inputs(
    spark: SparkSession, url: str, tables: Mapping[str, str], first_date: str, last_date: str, partitions: int = 64,
    **connection: str,
) -> dict[str, DataFrame]:
    """All four inputs: the dimensions by plain query, the two daily tables split by date.

    ``tables`` names the table of each of companies, industries, prices and ratios, as the database writes it.
    """
    inputs = {name: read_query(spark, f"select * from {tables[name]}", url, **connection) for name in ("companies", "industries")}
    for name in ("prices", "ratios"):
        inputs[name] = read_table(spark, tables[name], url, '"Date"', first_date, last_date, partitions, **connection)
    return inputs
