"""Joining the four inputs into one daily panel, and cleaning it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.config import CAP_EXCLUDED, CAP_FLOORS
from tickfold.functions.checks import require_present, require_unique
from tickfold.functions.columns import nan_to_null

# Source name -> panel name, in panel order.
PANEL_COLUMNS = {
    "Ticker": "ticker",
    "SimFinId": "simfinid",
    "Company Name": "comp_name",
    "Sector": "sector",
    "Industry": "industry",
    "Date": "date",
    "Open": "open",
    "Adj. Close": "adj_close",
    "Volume": "volume",
    "Market-Cap": "market_cap",
    "Price to Book Value": "p_b",
    "Price to Free Cash Flow (quarterly)": "p_fcf_quart",
    "Price to Free Cash Flow (ttm)": "p_fcf_ttm",
}


def join_company_industry(companies: DataFrame, industries: DataFrame, validate: bool = True) -> DataFrame:
    """Companies with their sector and industry (left, many to one).

    No broadcast hint: the optimizer broadcasts the dimension when its measured size allows, and otherwise splits a
    hot industry as a skewed join.
    """
    left = companies.withColumn("IndustryId", F.col("IndustryId").cast("long"))
    right = industries.withColumn("IndustryId", F.col("IndustryId").cast("long"))
    if validate:
        right = require_unique(right, ["IndustryId"], "industries")
    return left.join(right, "IndustryId", "left")


def join_price_company(prices: DataFrame, company_industry: DataFrame, validate: bool = True) -> DataFrame:
    """Daily prices with company data (left, many to one)."""
    right = company_industry
    if validate:
        right = require_unique(right, ["Ticker", "SimFinId"], "companies")
    return prices.join(right, ["Ticker", "SimFinId"], "left")


def join_price_ratio(prices: DataFrame, ratios: DataFrame, validate: bool = True) -> DataFrame:
    """Daily prices with daily ratios (left, one to one).

    A ticker may have one price a day, whichever company it stands for: every window after this goes by ticker and date.
    One sort by (ticker, date, id) serves both checks and the join.
    """
    keys = ["Ticker", "Date", "SimFinId"]
    left, right = prices, ratios
    if validate:
        left = require_unique(prices, keys[:2], "prices", then=("SimFinId",))
        right = require_unique(ratios, keys, "ratios")
    return left.join(right, keys, "left")


def join_data(
    companies: DataFrame,
    industries: DataFrame,
    prices: DataFrame,
    ratios: DataFrame,
    validate: bool = True,
    clustered: bool = False,
) -> DataFrame:
    """Daily panel of prices, company data and ratios.

    Both daily tables are partitioned by ticker before they meet; the uniqueness checks, both joins and every later
    per-ticker window use that one partitioning. ``clustered`` says they already arrive so. A price without a ticker belongs
    to no company and would meet all others like it in one task: it is an error, raised before rows move. Ratios without one
    can match nothing and stay behind.
    """
    if validate:
        prices = require_present(prices, "Ticker", "prices")
    ratios = ratios.filter(F.col("Ticker").isNotNull())
    if not clustered:
        prices, ratios = prices.repartition("Ticker"), ratios.repartition("Ticker")
    daily = join_price_ratio(prices, ratios, validate)
    return join_price_company(daily, join_company_industry(companies, industries, validate), validate)


def intro_clean_data(raw: DataFrame) -> DataFrame:
    """The 13 panel columns under their short names, dates as DATE, NaN as NULL."""
    renamed = raw.select(*[F.col(f"`{source}`").alias(name) for source, name in PANEL_COLUMNS.items()])
    return nan_to_null(
        renamed.withColumns({"date": F.to_date("date"), "simfinid": F.col("simfinid").cast("long")})
    )


def market_cap(panel: DataFrame, floors=CAP_FLOORS) -> DataFrame:
    """Adds the size class ``market_cap_cat``."""
    cap = F.col("market_cap")
    label = None
    for name, floor in floors:
        label = F.when(cap >= floor, name) if label is None else label.when(cap >= floor, name)
    label = label.when(cap < floors[-1][1], "penny").otherwise("other")
    return panel.withColumn("market_cap_cat", label)


def filter_data(panel: DataFrame, excluded=CAP_EXCLUDED) -> DataFrame:
    """Drops the smallest and unknown size classes, then every row with a missing value."""
    return panel.filter(~F.col("market_cap_cat").isin(*excluded)).na.drop("any")


def filter_dates(panel: DataFrame, start_date: str, current_date: str) -> DataFrame:
    """Rows from ``start_date`` to ``current_date``, both included."""
    return panel.filter(F.col("date").between(F.lit(start_date).cast("date"), F.lit(current_date).cast("date")))
