"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickfold.session import stage

#: Broadcasting row ids is allowed up to this many of them (16 MB); beyond it the same join shuffles.
BROADCAST_IDS = 1_000_000

#: Text bytes that one step inside a task holds at once (a longer document is a step of its own).
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (column names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def staged_rows(df: DataFrame, row: str, name: str) -> DataFrame:
    """``df`` with a row number in ``row``, written to the shared folder.

    The numbers are unique and, since they are read back from the written table, the same in every later pass, also
    when ids repeat or are null and when an executor is lost.
    """
    return stage(df.withColumn(row, F.monotonically_increasing_id()), name)


def narrow_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str, rows: int) -> DataFrame:
    """Join with a narrow right side of ``rows`` rows: broadcast up to ``BROADCAST_IDS`` of them, else shuffled."""
    return left.join(F.broadcast(right) if rows <= BROADCAST_IDS else right, on, how)


def hot_keys(left: DataFrame, key: str, per_task: int) -> DataFrame:
    """(key, salts) of the keys with more than ``per_task`` rows, written; rows are folded per task before they are counted.

    There are fewer than rows / ``per_task`` of them, and ``per_task`` is raised until they can be broadcast.
    """
    counts = left.groupBy(key).agg(F.count("*").alias("held")).filter(F.col("held") > per_task)
    hot = stage(counts, "hot-keys")
    while hot.count() > BROADCAST_IDS:
        per_task *= 2
        hot = hot.filter(F.col("held") > per_task)
    return hot.select(key, F.ceil(F.col("held") / per_task).cast("int").alias("salts"))


def salted(left: DataFrame, key: str, per_task: int = 2000) -> tuple[DataFrame, DataFrame]:
    """(``left`` with a column ``salt``, the hot keys): a key with more than ``per_task`` rows is dealt over salts.

    The hot keys are broadcast, so the salt is there before any row is dealt by its key. It is a hash of the row: a task
    that runs again deals it alike.
    """
    hot = hot_keys(left, key, per_task)
    dealt = left.join(F.broadcast(hot), key, "left")
    salt = F.pmod(F.xxhash64(*left.columns), F.coalesce("salts", F.lit(1))).cast("int")
    return dealt.withColumn("salt", salt).drop("salts"), hot


def spread(right: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """``right``, a few rows per key, repeated for every salt of its key."""
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    return right.join(F.broadcast(hot), key, "left").withColumn("salt", salts).drop("salts")


def salted_join(left: DataFrame, right: DataFrame, key: str, per_task: int = 2000) -> DataFrame:
    """Inner equi-join of many ``left`` rows with one ``right`` row per key, without a hot key in one task."""
    dealt, hot = salted(left, key, per_task)
    return dealt.join(spread(right, hot, key), [key, "salt"]).drop("salt")


def keyed_join(left: DataFrame, right: DataFrame, key: str, rows: int) -> DataFrame:
    """Inner join with one ``right`` row per key: broadcast up to ``BROADCAST_IDS`` rows, else without a hot key in one task."""
    return left.join(F.broadcast(right), key) if rows <= BROADCAST_IDS else salted_join(left, right, key)


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cuts Arrow batches into runs of rows with at most ``limit`` bytes of text (one row at least); null is empty."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0))
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield _cut(batch, column, start, i)
                start, held = i, 0
            held += int(n) + 1
        if start < len(sizes):
            yield _cut(batch, column, start, len(sizes))


def _cut(batch: pa.RecordBatch, column: pa.Array, start: int, end: int) -> tuple[pa.RecordBatch, list[str]]:
    return batch.slice(start, end - start), [x or "" for x in column.slice(start, end - start).to_pylist()]


def extended(batch: pa.RecordBatch, keep: list[str], more: dict[str, pa.Array]) -> pa.RecordBatch:
    """The columns ``keep`` of a batch and new ones behind them."""
    arrays = [batch.column(batch.schema.get_field_index(name)) for name in keep]
    return pa.RecordBatch.from_arrays([*arrays, *more.values()], names=[*keep, *more])


def schema_of(df: DataFrame, columns: list[str], more: str) -> str:
    """DDL of some columns of ``df`` and of new ones."""
    kinds = dict(df.dtypes)
    return ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), more])


