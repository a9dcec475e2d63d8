"""Session settings the plans rely on, and stage tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Panel stages do much work per byte (dozens of windows per row): merge small shuffle partitions only down to the
    # number of cores, not to 1 MB.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    # Shuffles carry sparse observations, and a task spreads its share into a dense, wide panel that it sorts three times: at
    # the default 64 MB a share came to 1.9 GB in memory and spilled, at this size to 0.7 GB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "24m",
    # Let a join on (ticker, date, ...) use tables already hash-partitioned by ticker alone. The panel is then
    # shuffled once, for the join and for every window after it. Safe because the panel's checks raise when a ticker has
    # two prices on a day or a row has no ticker: a ticker has at most one row per session, so none can outgrow a task.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows sorted by their group's key are aggregated as they come, without a table of groups and a second sort.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # The JVM never compiles a method of more than 8,000 bytes: wide projections and aggregates would run interpreted, row
    # by row. Beyond that size Spark evaluates such a step in methods of a fair size instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "tickfold", cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and laptops; clusters bring their own and call :func:`configure`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # no call-site lookup for every column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_ROOTS: dict[str, str] = {}


def stage_root(spark: SparkSession) -> str:
    """The shared folder for stage tables: ``spark.checkpoint.dir``, else the context's checkpoint directory.

    Only a local master may fall back to a temporary folder, one for each application; on a cluster a missing setting is
    an error. The caller's settings stay as they are.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[key] = tempfile.mkdtemp(prefix="tickfold-")
    return _LOCAL_ROOTS[key]


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet stage table and read it back.

    Used where a result feeds many jobs (model fits): a written table survives lost executors, cuts the lineage and
    keeps column pruning and push-down, which an in-memory block or an RDD checkpoint would not. ``codec`` is a Parquet
    compression other than the session's.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
