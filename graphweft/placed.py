"""A growing set of rows that is placed by key once and read without being moved."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from .session import new_folder

FOLD_EVERY = 16  # additions after which the files of a bucket become one again


class PlacedTable:
    """Rows bucketed by ``keys`` in the shared folder, for loops that ask which keys they have met.

    ``add`` writes only the new rows, each to the bucket of its key; ``missing`` joins candidates to the table, where only
    the candidates are shuffled: the buckets are read in place. The plan of either is the same in the first round
    and in the thousandth. Now and then the small files of the additions are folded into one file a bucket.
    """

    def __init__(self, first: DataFrame, keys: list[str], buckets: int | None = None):
        self.spark, self.keys, self.columns = first.sparkSession, keys, first.columns
        self.buckets = buckets or max(2, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        self.additions = 0
        self.name = self._written(first)

    def _written(self, rows: DataFrame) -> str:
        name = f"placed_{uuid.uuid4().hex}"
        self._save(rows, name, "errorifexists", new_folder(self.spark, name))
        return name

    def _save(self, rows: DataFrame, name: str, mode: str, path: str | None = None) -> None:
        # a task has the rows of one bucket, so an addition leaves one small file a bucket at most
        writer = rows.select(*self.columns).repartition(self.buckets, *self.keys).write.mode(mode).format("parquet").bucketBy(self.buckets, *self.keys)
        (writer.option("path", path) if path else writer).saveAsTable(name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def missing(self, candidates: DataFrame) -> DataFrame:
        """The candidates whose keys are not in the table."""
        return candidates.join(self.rows().select(*self.keys), self.keys, "left_anti")

    def add(self, rows: DataFrame) -> None:
        self._save(rows, self.name, "append")
        self.additions += 1
        if self.additions % FOLD_EVERY == 0:
            old, self.name = self.name, self._written(self.rows())
            self.spark.sql(f"DROP TABLE {old}")


def levels(table: PlacedTable, depth: int, column: str = "depth") -> DataFrame:
    """The rows that were added for one depth; other files are skipped by their statistics."""
    return table.rows().where(F.col(column) == depth)
