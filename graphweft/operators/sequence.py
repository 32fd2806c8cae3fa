"""Named sequences: dense keys handed out in bulk (J)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..ordered import dense_number
from ..session import cut
from ..versions import Versions

MARKS = "name string, seq long"


def new_marks(spark: SparkSession, start: dict[str, int] | None = None) -> DataFrame:
    """The high-water marks: one row per sequence name."""
    return spark.createDataFrame(list((start or {}).items()), MARKS)


def curval(marks: DataFrame, name: str) -> int | None:
    """The last value given out, without advancing."""
    row = marks.where(F.col("name") == name).first()
    return None if row is None else row.seq


def nextval(rows: DataFrame, marks: DataFrame, name: str, order: list[Column | str], out: str = "id") -> tuple[DataFrame, DataFrame]:
    """Number ``rows`` after the stored value of ``name`` and advance it.

    Returns the numbered rows and the new marks. Ids are consecutive in ``order``;
    rows are numbered range by range, never in one task.
    """
    last = curval(marks, name) or 0
    numbered = cut(dense_number(rows, order, out, start=last + 1))
    highest = numbered.agg(F.coalesce(F.max(out), F.lit(last)).alias("m")).first().m
    rest = marks.where(F.col("name") != name)
    return numbered, cut(rest.unionByName(marks.sparkSession.createDataFrame([(name, highest)], MARKS)))


def advance(marks: DataFrame, requests: DataFrame) -> DataFrame:
    """Many sequences at once: ``requests(name, n)`` moves each mark by n in one pass."""
    moved = marks.select("name", F.col("seq").alias("v")).unionByName(requests.select("name", F.col("n").cast("long").alias("v")))
    return moved.groupBy("name").agg(F.sum("v").alias("seq"))


class StoredMarks:
    """The marks of all sequences as a stored text in a shared folder, safe against other writers.

    A writer takes a whole range before it uses a number of it, so two never share one. A writer that dies leaves a gap at most; its
    numbers are not given out again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._versions = Versions(spark, folder)

    def curval(self, name: str) -> int | None:
        """The last value given out, without advancing; None for a sequence never used."""
        return json.loads(self._versions.latest()[1] or "{}").get(name)

    def take(self, name: str, n: int) -> int:
        """Take ``n`` consecutive numbers; the first of them."""
        if n < 0:
            raise ValueError("n must not be negative")
        first = 0

        def step(text: str | None) -> str:
            nonlocal first
            marks = json.loads(text or "{}")
            first = marks.get(name, 0) + 1
            return json.dumps(marks | {name: first - 1 + n}, sort_keys=True)

        self._versions.change(step)
        return first

    def at_least(self, name: str, value: int) -> None:
        """Raise the mark to ``value`` where it is below, as before numbering beside ids that exist already."""
        if (self.curval(name) or 0) < value:

            def step(text: str | None) -> str:
                marks = json.loads(text or "{}")
                return json.dumps(marks | {name: max(marks.get(name, 0), value)}, sort_keys=True)

            self._versions.change(step)

    def nextval(self, rows: DataFrame, name: str, order: list[Column | str], out: str = "id") -> DataFrame:
        """``rows`` numbered in ``order`` with numbers that nobody else gets."""
        numbered = cut(dense_number(rows, order, "_n", start=0))
        first = self.take(name, numbered.count())
        return numbered.select(*rows.columns, (F.col("_n") + first).alias(out))
