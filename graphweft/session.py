"""Session helpers: builder, shared scratch space, lineage cutting and size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: int | str = "*", shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("graphweft")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="graphweft-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Where no folder is named, one below the session's warehouse, which executors share too.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = f"{warehouse.rstrip('/')}/_checkpoints"
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and forget how it was computed.

    Loops call this once per round, so that the plan stays short and a lost
    executor costs a re-read instead of a replay of every earlier round.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settle(df: DataFrame) -> DataFrame:
    """Like ``cut``, as a written table that is read again.

    A checkpoint keeps what the optimizer has inferred about its columns. In loops that join a frame with itself, as pointer jumping
    does, these constraints multiply with every round; a table begins without any.
    """
    folder = new_folder(df.sparkSession, "settled")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fits(df: DataFrame, max_rows: int) -> bool:
    """Does ``df`` hold at most ``max_rows`` rows? Reads no more than it must."""
    return df.limit(max_rows + 1).count() <= max_rows


def cut_placed(df: DataFrame, partitions: int, keys: list[str]) -> DataFrame:
    """Like ``cut``, hash-placed and sorted by ``keys`` so that later joins on them need no shuffle.

    Spark remembers the placement of a checkpoint only if the plan was not adaptive,
    so adaptive execution is off for this one step. Pass an already materialised
    frame: then the step is a single shuffle with nothing to adapt.
    """
    spark = df.sparkSession
    shared_dir(spark)
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        return df.repartition(partitions, *keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    finally:
        spark.conf.set(name, before)
