"""Trading calendar, month lengths and rebalancing periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# One-off closures of the New York exchange.
CLOSURES = (
    "1994-04-27",
    "2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14",
    "2004-06-11",
    "2007-01-02",
    "2012-10-29", "2012-10-30",
    "2018-12-05",
    "2025-01-09",
)


def _easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar (the anonymous computus)."""
    century = F.floor(year / 100)
    golden = year % 19
    moon = (
        19 * golden + century - F.floor(century / 4) - F.floor((century - F.floor((century + 8) / 25) + 1) / 3) + 15
    ) % 30
    weekday = (32 + 2 * (century % 4) + 2 * F.floor((year % 100) / 4) - moon - year % 4) % 7
    shift = F.floor((golden + 11 * moon + 22 * weekday) / 451)
    serial = moon + weekday - 7 * shift + 114
    return F.make_date(year, F.floor(serial / 31).cast("int"), (serial % 31 + 1).cast("int"))


def is_holiday(day: Column, closures: tuple[str, ...] = CLOSURES) -> Column:
    """Weekday closures of the New York exchange."""
    year, month, dom = F.year(day), F.month(day), F.dayofmonth(day)
    weekday = F.weekday(day)  # Monday is 0
    monday, friday = weekday == 0, weekday == 4

    def on_or_moved(m: int, d: int) -> Column:
        """The date itself, the Friday before a Saturday, or the Monday after a Sunday."""
        return (month == m) & ((dom == d) | ((dom == d - 1) & friday) | ((dom == d + 1) & monday))

    rules = [
        # a New Year's Day on Saturday is not moved
        (month == 1) & ((dom == 1) | ((dom == 2) & monday)),
        (month == 1) & monday & dom.between(15, 21) & (year >= 1998),
        (month == 2) & monday & dom.between(15, 21),
        day == F.date_sub(_easter(year), 2),
        (month == 5) & monday & (dom >= 25),
        on_or_moved(6, 19) & (year >= 2022),
        on_or_moved(7, 4),
        (month == 9) & monday & (dom <= 7),
        (month == 11) & (weekday == 3) & dom.between(22, 28),
        on_or_moved(12, 25),
    ]
    closed = day.isin(*[F.lit(d).cast("date") for d in closures])
    for rule in rules:
        closed = closed | rule
    return closed


def span(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row (start, end) from two literals."""
    return spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))


def clip_span(bounds: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """The part of a (start, end) row inside two literals."""
    low = F.greatest("start", F.lit(start).cast("date"))
    high = F.least("end", F.lit(end).cast("date"))
    return bounds.select(low.alias("start"), high.alias("end"))


def trading_calendar(bounds: DataFrame, holidays: bool = True, closures: tuple[str, ...] = CLOSURES) -> DataFrame:
    """Sessions between ``start`` and ``end`` of the one-row ``bounds``, both included."""
    days = bounds.select(F.explode(F.sequence("start", "end")).alias("date")).filter(F.weekday("date") < 5)
    return days.filter(~is_holiday(F.col("date"), closures)) if holidays else days


def market_schedule(sessions: DataFrame) -> DataFrame:
    """Sessions per month: (year, month, cal_days_in_month)."""
    return sessions.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(
        F.count(F.lit(1)).alias("cal_days_in_month")
    )


def market_dates(sessions: DataFrame, last_prediction: str) -> DataFrame:
    """First and last session per month with the period that follows: from the first session of the next month to the
    first session of the month after.

    The unpartitioned window sees one row per month.
    """
    months = sessions.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(
        F.min("date").alias("month_start_date"), F.max("date").alias("month_end_date")
    )
    order = Window.orderBy("month_start_date")
    return months.select(
        "month_start_date",
        "month_end_date",
        F.lead("month_start_date", 1).over(order).alias("period_start_date"),
        F.lead("month_start_date", 2).over(order).alias("period_end_date"),
    ).filter(F.col("month_end_date") <= F.lit(last_prediction).cast("date"))


def month_count(start: str, end: str) -> int:
    """Calendar months touched by two dates: the bound on rebalancing dates between them."""
    return (int(end[:4]) - int(start[:4])) * 12 + int(end[5:7]) - int(start[5:7]) + 1
