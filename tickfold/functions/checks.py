"""Join-cardinality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand on more than one row, with their row count. Pre-aggregated before the shuffle."""
    columns = [F.col(f"`{k}`") for k in keys]
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_present(df: DataFrame, column: str, what: str) -> DataFrame:
    """``df`` itself, failing at run time when ``column`` is missing in a row."""
    return df.filter(f"CASE WHEN `{column}` IS NULL THEN CAST(raise_error('{what}: a row without {column}') AS BOOLEAN) ELSE true END")


def require_unique(df: DataFrame, keys: list[str], what: str, then: tuple[str, ...] = ()) -> DataFrame:
    """``df`` itself, failing at run time when a key repeats. ``then`` are further columns the caller sorts by.

    The check rides in the plan: rows clustered by the first key and sorted by the others, as the join and the windows
    want them anyway, are compared with the row before. It costs no action and no further shuffle or sort. Rows a later
    filter on the keys removes before the join are not checked.
    """
    columns = [f"`{k}`" for k in keys]
    order = f"(PARTITION BY {columns[0]} ORDER BY {', '.join([*(columns[1:] or columns), *(f'`{c}`' for c in then)])})"
    # rows of a partition share the first key, so with further keys only these are read from the row before
    lagged = [c for i, c in enumerate(columns) if i or len(columns) == 1]
    same = " AND ".join([f"{columns[0]} IS NOT NULL", *(f"_before_{i} = {c}" for i, c in enumerate(lagged))])
    message = f"concat('{what}: duplicate key ', to_json(struct({', '.join(columns)})))"
    return (
        df.selectExpr("*", *[f"lag({c}) OVER {order} AS _before_{i}" for i, c in enumerate(lagged)])
        .filter(f"CASE WHEN {same} THEN CAST(raise_error({message}) AS BOOLEAN) ELSE true END")
        .drop(*[f"_before_{i}" for i in range(len(lagged))])
    )
