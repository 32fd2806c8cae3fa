"""Vector tables: reading packed and JSON vectors, partitioned writes, row changes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import bits
from ..skew import MAX_HOT_KEYS

MAX_DIMENSIONS = 8_192  # fixed value
ROWS_PER_FILE = 1_000_000
_DTYPES = {"float32": "<f4", "int8": "i1"}
_KINDS = {"float32": ("array<float>", 4, pa.float32()), "int8": ("array<tinyint>", 1, pa.int8())}


def _sized(vector: Column, dims: int) -> Column:
    wrong = F.raise_error(F.concat(F.lit(f"expected {dims} dimensions, got "), F.size(vector)))
    return F.when(vector.isNull() | (F.size(vector) == dims), vector).otherwise(wrong)


def from_json_text(text: Column, dims: int, kind: str = "float32") -> Column:
    """``'[1, 2.5, …]'`` to a vector of checked size; empty vectors are an error."""
    if not 1 <= dims <= MAX_DIMENSIONS:
        raise ValueError(f"dimensions must be between 1 and {MAX_DIMENSIONS}")
    if kind == "bit":
        return _sized_bits(bits.vec_bit(text, parse=True), dims)
    return _sized(F.from_json(text, _KINDS[kind][0]), dims)


def _sized_bits(vector: Column, dims: int) -> Column:
    wrong = F.raise_error(F.concat(F.lit(f"expected {dims} dimensions, got "), bits.length(vector)))
    return F.when(vector.isNull() | (bits.length(vector) == dims), vector).otherwise(wrong)


def from_blob(blob: Column, dims: int, kind: str = "float32") -> Column:
    """Little-endian packed numbers to a vector; the blob must hold exactly ``dims`` of them. A blob of bits is the vector."""
    if kind == "bit":
        return _sized_bits(bits.vec_bit(blob), dims)
    spark_type, width, arrow_type = _KINDS[kind]
    if not 1 <= dims <= MAX_DIMENSIONS:
        raise ValueError(f"dimensions must be between 1 and {MAX_DIMENSIONS}")

    dtype = _DTYPES[kind]

    @F.arrow_udf(spark_type)
    def unpack(column: pa.Array) -> pa.Array:
        # all blobs have the checked size, so their bytes in a row are the vectors in a row
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        blobs = column.drop_null()
        _, offsets, data = blobs.buffers()
        ends = np.frombuffer(offsets, "<i4")[blobs.offset : blobs.offset + len(blobs) + 1]
        raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and len(blobs) else np.zeros(0, np.uint8)
        places = np.concatenate([[0], np.cumsum(np.where(valid, dims, 0))]).astype("int32")
        return pa.ListArray.from_arrays(pa.array(places), pa.array(raw.view(dtype), arrow_type), mask=pa.array(~valid))

    wrong = F.raise_error(F.concat(F.lit(f"expected {dims * width} bytes, got "), F.octet_length(blob)))
    return unpack(F.when(blob.isNull() | (F.octet_length(blob) == dims * width), blob).otherwise(wrong))


def to_blob(vector: Column, kind: str = "float32") -> Column:
    """The packed form of a vector."""
    if kind == "bit":
        return bits.vec_bit(vector)
    dtype = np.dtype(_DTYPES[kind])

    @F.arrow_udf("binary")
    def pack(column: pa.Array) -> pa.Array:
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        sizes = np.where(valid, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0) * dtype.itemsize
        raw = np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).astype(dtype))
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype("int32")
        mask = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
        return pa.Array.from_buffers(pa.binary(), len(column), [mask, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])

    return pack(vector)


def write_table(df: DataFrame, path: str, partition_by: list[str], id_col: str = "id", mode: str = "error", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Partition keys become folders; metadata and payload columns stay in the files.

    Rows are first brought together by key, so a key is not scattered over a small
    file per task; a key with very many rows is split over several tasks by id.
    """
    counts = df.groupBy(*partition_by).agg(F.count("*").alias("_n"))
    total = df.count()
    rows_per_file = max(rows_per_file, -(-total // MAX_HOT_KEYS))
    # at most total / rows_per_file keys, so small enough to broadcast
    large = counts.where(F.col("_n") > rows_per_file).select(*partition_by, F.ceil(F.col("_n") / rows_per_file).cast("int").alias("_files"))
    spread = df.join(F.broadcast(large), partition_by, "left").withColumn(
        "_file", F.pmod(F.xxhash64(id_col), F.coalesce("_files", F.lit(1)))
    )
    placed = spread.repartition(*partition_by, "_file").select(*df.columns)
    placed.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def point_lookup(df: DataFrame, id_col: str, value) -> DataFrame:
    return df.where(F.col(id_col) == F.lit(value))


def insert(df: DataFrame, rows: DataFrame, id_col: str = "id") -> DataFrame:
    """Append rows; an id that already exists is an error when the result is read."""
    clash = df.select(id_col).withColumn("_old", F.lit(True))
    checked = rows.join(clash, id_col, "left").withColumn(
        id_col, F.when(F.col("_old"), F.raise_error(F.concat(F.lit("id exists: "), F.col(id_col)))).otherwise(F.col(id_col))
    )
    return df.unionByName(checked.select(*df.columns))


def update(df: DataFrame, changes: DataFrame, id_col: str = "id", partition_keys: tuple[str, ...] = ()) -> DataFrame:
    """Replace the given columns of matching ids; partition keys cannot change."""
    fixed = set(changes.columns) & set(partition_keys)
    if fixed:
        raise ValueError(f"partition keys cannot be updated: {sorted(fixed)}")
    new = [c for c in changes.columns if c != id_col]
    renamed = changes.select(id_col, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in new])
    joined = df.join(renamed, id_col, "left")
    return joined.select(*[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in df.columns])


def delete(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    return df.join(ids.select(F.col(ids.columns[0]).alias(id_col)), id_col, "left_anti")


def touched_partitions(df: DataFrame, ids: DataFrame, partition_by: list[str], id_col: str = "id") -> DataFrame:
    """The partitions a change has to rewrite."""
    return df.join(ids.select(id_col), id_col, "left_semi").select(*partition_by).distinct()


__all__ = [
    "delete", "from_blob", "from_json_text", "insert", "point_lookup", "read_table", "to_blob", "touched_partitions", "update", "write_table",
]
