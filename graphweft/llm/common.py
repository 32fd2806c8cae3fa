"""What several of these operators share."""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD = r"[^\x20\x09-\x0D]+"
WORTH_GIVING = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def count_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def groups_for(rows: int, per_group: int) -> int:
    """How many groups of about ``per_group`` rows hold ``rows`` rows."""
    return max(1, math.ceil(rows / per_group))


def parts_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes, by the mean size of a batch's rows; a row is never cut.

    Behind the last one the task gives back what it no longer uses, since its worker stays for the tasks to come; a task of
    less than ``WORTH_GIVING`` bytes has little to give.
    """
    seen = 0
    for batch in batches:
        seen += batch.nbytes
        step = max(1, size // max(1, batch.nbytes // max(1, batch.num_rows)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
    if seen >= WORTH_GIVING:
        give_back()


def give_back() -> None:
    """Free memory goes back to the system, where the C library can do so."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
