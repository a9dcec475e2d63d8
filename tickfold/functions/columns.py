"""Column helpers shared by the operators. Everything stays a built-in expression."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing in the source data; in Spark it would sort first and compare greater than any number."""
    nan = F.lit(float("nan"))
    return df.select(
        *[
            F.nullif(F.col(f"`{f.name}`"), nan).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


# Row order of the daily panel. Year and month lead the sort order although the date implies them: the per-month count
# can then use the same sorted partitions as all rolling and lag windows, so the panel is sorted once.
PANEL_ORDER = "PARTITION BY ticker ORDER BY year, month, date, simfinid"
# The same order for tables without missing dates, and the one that the panel's join leaves behind.
DAY_ORDER = "PARTITION BY ticker ORDER BY date, simfinid"
# Row order of month-end tables, unique per ticker and date.
MONTH_ORDER = "PARTITION BY ticker ORDER BY date"


def with_date_parts(df: DataFrame) -> DataFrame:
    if {"year", "month", "day"} <= set(df.columns):
        return df
    return df.withColumns({"year": F.year("date"), "month": F.month("date"), "day": F.dayofmonth("date")})


# Window columns are written as SQL text: a wide table needs hundreds of them, and text is one call each.


def first_value_index(column: str, order: str = PANEL_ORDER) -> Column:
    """Value relative to the first non-missing value of the group; a zero first value gives NULL.

    The running frame is enough: up to the first non-missing row the quotient is NULL either way, and it lets Spark
    stream the group instead of buffering it.
    """
    frame = f"({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return F.expr(f"try_divide({column}, first({column}, true) OVER {frame})")


# output -> (kind, column, rows, least non-missing values), kind one of sum, avg, median
Rolled = dict[str, tuple[str, str, int, int]]


def _rolled_text(cells: list[str], kind: str, least: int, type_: str, count: str, value: str) -> tuple[dict[str, str], str]:
    """(helper columns, result) of one rolling value over ``cells``, oldest first."""
    helpers = {count: " + ".join(f"CAST({c} IS NOT NULL AS BIGINT)" for c in cells)}
    if kind == "median":
        # what is missing counts as NaN, which is sorted last
        helpers[value] = f"sort_array(array({', '.join(f'coalesce(CAST({c} AS DOUBLE), DOUBLE(\'NaN\'))' for c in cells)}))"
        low, high = f"{value}[CAST(({count} - 1) DIV 2 AS INT)]", f"{value}[CAST({count} DIV 2 AS INT)]"
        middle = f"CASE WHEN {count} % 2 = 1 OR {low} = {high} THEN {low} ELSE 0.5D * {low} + 0.5D * {high} END"
        return helpers, f"CASE WHEN {count} >= {max(least, 1)} THEN {middle} END"
    helpers[value] = " + ".join(f"coalesce(CAST({c} AS {type_}), 0)" for c in cells)
    return helpers, f"CASE WHEN {count} >= {max(least, 1)} THEN {value}{f' / {count}' if kind == 'avg' else ''} END"


def _summed_types(df: DataFrame) -> dict[str, str]:
    """Column -> type in which its values are added, as sum() does."""
    wider = {"float": "DOUBLE", "tinyint": "BIGINT", "smallint": "BIGINT", "int": "BIGINT"}
    return {c: wider.get(kind, kind) for c, kind in df.dtypes}


@dataclass(frozen=True)
class MonthEnds:
    """A daily panel of which only the last row of each ticker and month is wanted.

    The daily operators take it in place of a table and note what they would add; :meth:`rows` then computes that for the
    month ends alone, from the ticker's rows as one array, whereas windows would compute it for every day. Dates are not
    missing, and (ticker, date, simfinid) is unique.
    """

    #: rows with ticker, date, simfinid, year and month
    daily: DataFrame
    rolled: Rolled = field(default_factory=dict)
    #: output -> (rolled output, offset, known offsets, further lags that the offset uses)
    lags: dict[str, tuple[str, str, tuple[int, ...], dict[str, tuple[str, int]]]] = field(default_factory=dict)
    #: months whose number of rows is not in ``cal_days_in_month`` are left out, and lags count the other rows
    complete: bool = False

    def rows(self) -> DataFrame:
        """The month ends as a table: daily columns, ``days_in_month``, rolling values and lags."""
        keys = ["ticker", "date", "simfinid"]
        others = [c for c in self.daily.columns if c not in keys]
        cell = ", ".join([*(f"`{c}`" for c in [*keys[1:], *others]), "year * 12 + month AS _month"])
        series = list(dict.fromkeys(column for _, column, _, _ in self.rolled.values()))
        months = (
            # sorted once more in the array: its order is not left to the aggregate
            self.daily.groupBy("ticker")
            .agg(F.expr(f"sort_array(collect_list(struct({cell})))").alias("_days"))
            .selectExpr(
                "ticker",
                "_days",
                *[f"_days.`{c}` AS _all_{c}" for c in series],
                "filter(sequence(0, size(_days) - 1), _i -> NOT (get(_days, _i + 1)._month <=> get(_days, _i)._month)) AS _ends",
            )
            .withColumn("_months", F.expr("transform(_ends, (_e, _j) -> struct(_e AS at, _e - coalesce(get(_ends, _j - 1), -1) AS n))"))
        )
        if self.complete:
            months = months.withColumn("_months", F.expr("filter(_months, _m -> get(_days, _m.at).cal_days_in_month = _m.n)"))
        # positions of the rows that lags count, and the length of each one's month
        months = months.selectExpr(
            "*",
            "flatten(transform(_months, _m -> sequence(_m.at - _m.n + 1, _m.at))) AS _kept",
            "flatten(transform(_months, _m -> array_repeat(CAST(_m.n AS BIGINT), _m.n))) AS _lengths",
        ).withColumn(
            "_months",
            F.expr("transform(_months, _m -> struct(_m.at AS at, CAST(_m.n AS BIGINT) AS days_in_month, CAST(array_position(_kept, _m.at) - 1 AS INT) AS rank))"),
        )
        offsets = {lag[1:3]: lag[3] for lag in self.lags.values()}
        further = {name: rows for windows in offsets.values() for name, (_, rows) in windows.items()}
        lengths = [f"_m.{name} AS {name}" for name in ("at", "days_in_month", "rank")]
        lengths += [f"get(_lengths, _m.rank - {rows}) AS {name}" for name, rows in further.items()]
        months = months.withColumn("_months", F.expr(f"transform(_months, _m -> struct({', '.join(lengths)}))"))
        fields = ["get(_days, _m.at) AS _row", "_m.days_in_month AS days_in_month", "_m.at AS _at"]
        places = {"_at": "_m.at"}
        names = {}
        for i, (offset, known) in enumerate(offsets):
            back = re.sub(rf"\b({'|'.join(['days_in_month', *further])})\b", r"_m.\1", offset)
            names[offset, known] = f"_at_{i}"
            places[f"_at_{i}"] = f"CASE WHEN {back} IN ({', '.join(map(str, known))}) THEN get(_kept, _m.rank - CAST({back} AS INT)) END"
            fields.append(f"{places[f'_at_{i}']} AS _at_{i}")
        wanted = {out: (recipe, "_at") for out, recipe in self.rolled.items()}
        wanted |= {out: (self.rolled[column], names[offset, known]) for out, (column, offset, known, _) in self.lags.items()}
        types = _summed_types(self.daily)
        cells, helpers, results = {}, {}, []
        for out, ((kind, column, rows, least), at) in wanted.items():
            back = range(rows - 1, -1, -1)
            count, value = f"_count_{rows}_{column}{at}", f"_{kind if kind == 'median' else 'sum'}_{rows}_{column}{at}"
            more, result = _rolled_text([f"_{column}{at}_{k}" for k in back], kind, least, types[column], count, value)
            if kind == "median":
                # an array as it is; cell by cell the optimizer would spell it out in every filter on the median
                days = f"transform(sequence({places[at]} - {rows - 1}, {places[at]}), _i -> CAST(get(_all_{column}, _i) AS DOUBLE))"
                fields.append(f"CAST(size(filter({days}, _x -> _x IS NOT NULL)) AS BIGINT) AS {count}")
                fields.append(f"sort_array(transform({days}, _x -> coalesce(_x, DOUBLE('NaN')))) AS {value}")
                more = {count: count, value: value}
            else:
                cells |= {f"_{column}{at}_{k}": f"CASE WHEN {at} >= {k} THEN get(_all_{column}, {at} - {k}) END" for k in back}
            helpers |= more
            results.append(f"{result} AS {out}")
        # the rest is compiled, with the arrays beside each month end
        ends = months.selectExpr("ticker", *[f"_all_{c}" for c in series], f"inline(transform(_months, _m -> struct({', '.join(fields)})))")
        ready = [name for name, text in helpers.items() if name == text]
        rows = ["ticker" if c == "ticker" else f"_row.`{c}` AS `{c}`" for c in self.daily.columns] + ["days_in_month"]
        kept = [f"`{c}`" for c in [*self.daily.columns, "days_in_month"]]
        wide = ends.selectExpr(*rows, *ready, *[f"{text} AS {name}" for name, text in cells.items()])
        return wide.selectExpr(*kept, *[f"{text} AS {name}" for name, text in helpers.items()]).selectExpr(*kept, *results)


Daily = DataFrame | MonthEnds


def with_rolling(df: Daily, outputs: Rolled, order: str = PANEL_ORDER) -> Daily:
    """Adds rolling values; NULL with fewer values than the least.

    A sliding frame would be folded anew for every row and output; the rows before are read as lags instead, once for all
    values of a column. Sums start with the oldest row, as a frame's do, so every digit is the same.
    """
    if isinstance(df, MonthEnds):
        return replace(df, rolled={**df.rolled, **outputs})
    oldest: dict[str, int] = {}
    for _, column, rows, _ in outputs.values():
        oldest[column] = max(oldest.get(column, 1), rows)
    lags = [f"lag({c}, {k}) OVER ({order}) AS _{c}_{k}" for c, rows in oldest.items() for k in range(1, rows)]
    types = _summed_types(df)
    helpers, results = {}, []
    for out, (kind, column, rows, least) in outputs.items():
        cells = [f"_{column}_{k}" for k in range(rows - 1, 0, -1)] + [column]
        count, value = f"_count_{rows}_{column}", f"_{kind if kind == 'median' else 'sum'}_{rows}_{column}"
        more, result = _rolled_text(cells, kind, least, types[column], count, value)
        helpers |= more
        results.append(f"{result} AS {out}")
    wide = df.selectExpr("*", *lags).selectExpr(*[f"`{c}`" for c in df.columns], *[f"{text} AS {name}" for name, text in helpers.items()])
    return wide.selectExpr(*[f"`{c}`" for c in df.columns], *results)


def lag_column(column: str, rows: int, order: str = PANEL_ORDER) -> Column:
    return F.expr(f"lag({column}, {rows}) OVER ({order})")


def with_lags_by(
    df: Daily, outputs: dict[str, str], offset: str, offsets: Iterable[int], order: str = PANEL_ORDER, **windows: tuple[str, int]
) -> Daily:
    """Adds lags whose offset differs by row: output -> column. NULL where ``offset`` is not one of ``offsets``.

    ``windows`` are further lags (name -> column and rows) that ``offset`` may use. Each lag is computed once, then the
    offset picks among them. Only one projection follows, so that the optimizer can merge neighbouring lag steps into one
    window operator. Of month ends only lags of rolling values are known, by offsets that go by ``days_in_month``.
    """
    offsets = list(offsets)
    if isinstance(df, MonthEnds):
        return replace(df, lags={**df.lags, **{out: (c, offset, tuple(offsets), windows) for out, c in outputs.items()}})
    lags = [f"lag({c}, {k}) OVER ({order}) AS _{c}_{k}" for c in outputs.values() for k in offsets]
    others = [f"lag({c}, {k}) OVER ({order}) AS {name}" for name, (c, k) in windows.items()]
    wide = df.selectExpr("*", *others, *lags)
    picks = [
        f"CASE {offset} {' '.join(f'WHEN {k} THEN _{c}_{k}' for k in offsets)} END AS {out}" for out, c in outputs.items()
    ]
    return wide.selectExpr(*[f"`{c}`" for c in df.columns], *picks)


def running_product(column: str | Column, window: WindowSpec, last: int = 0) -> Column:
    """Product of all rows up to ``last`` rows after the current one; missing values are skipped."""
    return F.product(column).over(window.rowsBetween(Window.unboundedPreceding, last))
