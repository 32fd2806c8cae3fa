"""Streaming forms: change feed to table, vector ingest, edge merge (K).

Results live as written tables in the shared folder. Every batch writes a folder
named by its batch id and overwrites it when repeated, so a restart after a
failure neither loses nor doubles rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.ivf import assign
from ..operators.sync import DELETE


def run_available(df: DataFrame, apply, checkpoint: str) -> None:
    """Process everything that has arrived, batch by batch, then stop."""
    query = df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def _children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system that Spark reaches; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(path)] if files.exists(path) else []


class FeedTable:
    """A table kept current from a feed of ``op, seq, <columns>`` (K1).

    The change with the highest ``seq`` per key wins, within a batch and across
    batches. A batch only writes its own newest changes; reading merges them with the
    base, and ``compact`` folds them in. Deletions stay as markers, so a late older
    change cannot revive a row.
    """

    def __init__(self, spark: SparkSession, folder: str, pk: list[str], start: DataFrame):
        self.spark, self.folder, self.pk = spark, folder, pk
        self.columns = start.columns
        self.rest = [c for c in self.columns if c not in pk]
        # a generation counts once its base is complete; after a restart the newest goes on
        done = [int(name) for name in _children(spark, folder) if name.isdigit() and "_SUCCESS" in _children(spark, f"{folder}/{name}/part=base")]
        self.generation = max(done, default=0)
        if not done:
            start.withColumns({"_seq": F.lit(-1).cast("long"), "_gone": F.lit(False)}).write.mode("overwrite").parquet(self._part("base"))

    def _part(self, name: str) -> str:
        return f"{self.folder}/{self.generation}/part={name}"

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        newest = batch.groupBy(*self.pk).agg(F.max_by(F.struct("op", *self.rest), "seq").alias("_r"), F.max("seq").alias("_seq"))
        values = [F.col(f"_r.{c}").alias(c) for c in self.rest]
        newest.select(*self.pk, *values, "_seq", (F.col("_r.op") == DELETE).alias("_gone")).write.mode("overwrite").parquet(self._part(f"batch{batch_id}"))

    def _merged(self) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.folder}/{self.generation}")
        newest = stored.groupBy(*self.pk).agg(F.max_by(F.struct(*self.rest, "_gone"), "_seq").alias("_r"), F.max("_seq").alias("_seq"))
        return newest.select(*self.pk, *[F.col(f"_r.{c}").alias(c) for c in self.rest], "_seq", F.col("_r._gone").alias("_gone"))

    def compact(self) -> None:
        """Write base and changes as one new base; call between runs of the feed."""
        merged = self._merged()
        # not the current generation until the write is complete
        merged.write.mode("overwrite").parquet(f"{self.folder}/{self.generation + 1}/part=base")
        self.generation += 1

    def table(self) -> DataFrame:
        return self._merged().where(~F.col("_gone")).select(*self.columns)


def ingest_vectors(stream: DataFrame, centroids: np.ndarray, folder: str, checkpoint: str, vector: str = "embedding") -> None:
    """Append arriving vectors to the cell of their nearest centroid (K2).

    A batch is brought together by cell first, so that a cell gets few files; Spark splits a cell that
    holds much of a batch. The table has a folder per batch, and in it one per cell.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        placed = assign(batch, centroids, vector=vector).hint("rebalance", F.col("cell"))
        placed.write.mode("overwrite").partitionBy("cell").parquet(f"{folder}/batch={batch_id}")

    run_available(stream, write, checkpoint)


class EdgeMerger:
    """Arriving edges merged into a stored edge table, with degrees kept current (K3).

    The store has a folder per hash of the source, and a batch reads only those it touches. It
    contributes the pairs not stored yet and one degree change per touched node. No watermark is used: it would drop late rows, and the stored pairs already
    settle what is a repeat.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder, self.buckets = spark, folder, buckets

    def _read(self, kind: str, before: int | None = None) -> DataFrame:
        schema = "src long, dst long, bucket int" if kind == "edges" else "id long, d long"
        df = self.spark.read.schema(f"{schema}, batch long").parquet(f"{self.folder}/{kind}")
        return df if before is None else df.where(F.col("batch") < before)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        bucket = F.pmod(F.xxhash64("src"), F.lit(self.buckets)).cast("int")
        arrived = batch.select("src", "dst").distinct().withColumn("bucket", bucket)
        if batch_id > 0:
            touched = [r["bucket"] for r in arrived.select("bucket").distinct().collect()]  # one row per bucket
            stored = self._read("edges", batch_id).where(F.col("bucket").isin(touched))
            arrived = arrived.join(stored.select("src", "dst"), ["src", "dst"], "left_anti").select("src", "dst", "bucket")
        target = f"{self.folder}/edges/batch={batch_id}"
        arrived.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(target)
        new = self.spark.read.schema("src long, dst long, bucket int").parquet(target).drop("bucket")
        ends = new.select(F.col("src").alias("id")).unionAll(new.select("dst"))
        ends.groupBy("id").agg(F.count("*").alias("d")).write.mode("overwrite").parquet(f"{self.folder}/degrees/batch={batch_id}")

    def edges(self) -> DataFrame:
        return self._read("edges").select("src", "dst")

    def degrees(self) -> DataFrame:
        return self._read("degrees").groupBy("id").agg(F.sum("d").alias("degree"))
