"""CSV, changesets, entity-attribute-value tables and JSON rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..graph import Graph


# -- CSV (A2) ---------------------------------------------------------------------------------
def load_csv(spark: SparkSession, path: str, headers: bool = True, separator: str = ",") -> DataFrame:
    """``row``: a map of header to text, or a list of texts without headers."""
    df = spark.read.csv(path, header=headers, sep=separator)
    if headers:
        pairs = [x for name in df.columns for x in (F.lit(name), F.col(f"`{name}`"))]
        return df.select(F.create_map(*pairs).alias("row"))
    return df.select(F.array(*[F.col(f"`{name}`") for name in df.columns]).alias("row"))


# -- changesets (A4) --------------------------------------------------------------------------
def write_changes(changes: dict[str, DataFrame], path: str, mode: str = "error") -> None:
    """One folder per table; the schema travels with the files."""
    for name, df in changes.items():
        df.write.mode(mode).parquet(f"{path}/table={name}")


def read_changes(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/table={name}")


# -- entity / attribute / value (A6) ----------------------------------------------------------
VALUE_COLUMNS = {"text": "string", "int": "bigint", "real": "double", "bool": "boolean"}


def _slot(spark_type: str) -> str:
    if spark_type in ("tinyint", "smallint", "int", "bigint"):
        return "int"
    if spark_type in ("float", "double") or spark_type.startswith("decimal"):
        return "real"
    return "bool" if spark_type == "boolean" else "text"


def to_eav(df: DataFrame, id_col: str = "id", props: list[str] | None = None) -> DataFrame:
    """``entity, key`` and one typed value column; absent properties give no row."""
    types = dict(df.dtypes)
    entries = []
    for p in props or [c for c in df.columns if c not in (id_col, "labels")]:
        slot = _slot(types[p])
        values = [
            (F.col(p).cast(t) if name == slot else F.lit(None).cast(t)).alias(name) for name, t in VALUE_COLUMNS.items()
        ]
        entries.append(F.struct(F.lit(p).alias("key"), F.col(p).isNotNull().alias("_set"), *values))
    rows = df.select(F.col(id_col).alias("entity"), F.explode(F.array(*entries)).alias("e"))
    return rows.where("e._set").select("entity", "e.key", *[f"e.{v}" for v in VALUE_COLUMNS])


def from_eav(eav: DataFrame, keys: dict[str, str]) -> DataFrame:
    """One row per entity; ``keys`` maps property to type. The key list is given, so there is no extra pass."""
    cols = []
    for key, kind in keys.items():
        picked: Column = F.max(F.when(F.col("key") == key, F.col(_slot(kind))))
        cols.append(picked.cast(kind).alias(key))
    return eav.groupBy("entity").agg(*cols)


# -- rows as JSON (A8) ------------------------------------------------------------------------
def rows_to_json(df: DataFrame, out: str = "json") -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias(out))


def nodes_to_json(graph: Graph) -> DataFrame:
    """``{id, labels, properties}`` per node; absent properties are left out."""
    body = F.struct("id", "labels", F.struct(*graph.node_props).alias("properties"))
    return graph.nodes.select("id", F.to_json(body).alias("json"))


def edges_to_json(graph: Graph) -> DataFrame:
    """``{id, type, start, end, properties}`` per edge."""
    props = [F.struct(*graph.edge_props).alias("properties")] if graph.edge_props else []
    body = F.struct("id", "type", F.col("src").alias("start"), F.col("dst").alias("end"), *props)
    return graph.edges.select("id", F.to_json(body).alias("json"))
