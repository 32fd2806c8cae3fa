"""Table diff and patch by primary key (I)."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..versions import Versions

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"


def _values(df: DataFrame, pk: list[str]) -> list[str]:
    return [c for c in df.columns if c not in pk]


def check_schema(a: DataFrame, b: DataFrame, pk: list[str], name: str = "table") -> None:
    """Both sides must have the same columns and types, and the key must exist."""
    left, right = [(f.name, f.dataType) for f in a.schema], [(f.name, f.dataType) for f in b.schema]
    if left != right:
        raise ValueError(f"{name}: schemas differ: {left} and {right}")
    if not pk:
        raise ValueError(f"{name}: a primary key is needed")
    missing = set(pk) - set(a.columns)
    if missing:
        raise ValueError(f"{name}: key columns {sorted(missing)} do not exist")


def diff(a: DataFrame, b: DataFrame, pk: list[str]) -> DataFrame:
    """Changes that turn ``a`` into ``b``: ``op, <pk>, old, new, changed``.

    One full join on the key. ``old`` and ``new`` are structs of the other columns,
    ``changed`` lists those that differ, NULLs compared as values.
    """
    check_schema(a, b, pk)
    values = _values(a, pk)
    left = a.select(*[F.col(c).alias(f"_a_{c}") for c in pk], F.struct(F.lit(True).alias("_in"), *values).alias("_old"))
    right = b.select(*[F.col(c).alias(f"_b_{c}") for c in pk], F.struct(F.lit(True).alias("_in"), *values).alias("_new"))
    on = F.lit(True)
    for c in pk:
        on = on & (F.col(f"_a_{c}") == F.col(f"_b_{c}"))
    joined = left.join(right, on, "full")
    flags = [F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c)) for c in values]
    gone, fresh = F.col("_new").isNull(), F.col("_old").isNull()
    changed = F.when(gone | fresh, F.array().cast("array<string>")).otherwise(
        F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
    )
    op = F.when(gone, DELETE).when(fresh, INSERT).when(F.size("changed") > 0, UPDATE)

    def plain(side: str):
        return F.when(F.col(side).isNotNull(), F.struct(*[F.col(f"{side}.{c}").alias(c) for c in values])) if values else F.lit(None).cast("struct<>")

    return (
        joined.withColumn("changed", changed)
        .withColumn("op", op)
        .where(F.col("op").isNotNull())
        .select(
            "op",
            *[F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in pk],
            plain("_old").alias("old"),
            plain("_new").alias("new"),
            "changed",
        )
    )


def diff_tables(a: dict[str, DataFrame], b: dict[str, DataFrame], keys: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Diff of every table of both sides; a table on one side only or without a key is an error."""
    if set(a) != set(b):
        raise ValueError(f"tables on one side only: {sorted(set(a) ^ set(b))}")
    for name in a:
        check_schema(a[name], b[name], keys.get(name, []), name)
    return {name: diff(a[name], b[name], keys[name]) for name in a}


@dataclass(frozen=True)
class Patched:
    table: DataFrame
    conflicts: DataFrame


def patch(a: DataFrame, changes: DataFrame, pk: list[str]) -> Patched:
    """Apply ``changes`` to ``a`` (I4).

    UPDATE and DELETE apply only where the current row has the old values (for an
    update, of the changed columns); INSERT only where the key is free. What does not
    fit is returned in ``conflicts``; ``apply_all`` refuses the whole patch instead.
    """
    values = _values(a, pk)
    marked = changes.select(
        *[F.col(c).alias(f"_k_{c}") for c in pk], F.col("op").alias("_op"), F.col("old").alias("_old"), F.col("new").alias("_new"),
        F.col("changed").alias("_changed"),
    )
    on = F.lit(True)
    for c in pk:
        on = on & (F.col(c) == F.col(f"_k_{c}"))
    current = a.withColumn("_here", F.lit(True))
    joined = current.join(marked, on, "full")

    def agrees(only_changed: bool):
        ok = F.lit(True)
        for c in values:
            same = F.col(c).eqNullSafe(F.col(f"_old.{c}"))
            ok = ok & ((same | ~F.array_contains("_changed", c)) if only_changed else same)
        return ok

    here = F.col("_here").isNotNull()
    fits = (
        F.when(F.col("_op") == INSERT, ~here)
        .when(F.col("_op") == UPDATE, here & agrees(True))
        .when(F.col("_op") == DELETE, here & agrees(False))
    )
    joined = joined.withColumn("_fits", F.coalesce(fits, F.lit(False)))
    applied = F.col("_fits")

    def value(c: str):
        take = applied & ((F.col("_op") == INSERT) | ((F.col("_op") == UPDATE) & F.array_contains("_changed", c)))
        return F.when(take, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)

    keep = (here & ~(applied & (F.col("_op") == DELETE)).eqNullSafe(True)) | (applied & (F.col("_op") == INSERT)).eqNullSafe(True)
    columns = {c: F.coalesce(c, f"_k_{c}").alias(c) for c in pk}
    table = joined.where(keep).select(*[columns.get(c, value(c)) if c in columns else value(c) for c in a.columns])
    conflicts = joined.where(F.col("_op").isNotNull() & ~applied).select(
        F.col("_op").alias("op"), *[F.col(f"_k_{c}").alias(c) for c in pk], F.col("_old").alias("old"), F.col("_new").alias("new"), F.col("_changed").alias("changed")
    )
    return Patched(table, conflicts)


def apply_all(a: DataFrame, changes: DataFrame, pk: list[str]) -> DataFrame:
    """All or nothing: an error if any change does not fit."""
    result = patch(a, changes, pk)
    if not result.conflicts.isEmpty():
        raise ValueError("the patch does not fit the table; see patch(...).conflicts")
    return result.table


def summary(changes: DataFrame) -> DataFrame:
    """``op, column, n``: rows per operation, and per changed column for updates."""
    ops = changes.groupBy("op").agg(F.count("*").alias("n")).select("op", F.lit(None).cast("string").alias("column"), "n")
    cols = changes.where(F.col("op") == UPDATE).select("op", F.explode("changed").alias("column")).groupBy("op", "column").agg(F.count("*").alias("n"))
    return ops.unionByName(cols)


class PatchConflict(ValueError):
    """Changes that do not fit; ``conflicts`` has them for each table."""

    def __init__(self, conflicts: dict[str, DataFrame]):
        super().__init__(f"the patch does not fit the tables {sorted(conflicts)}; see conflicts")
        self.conflicts = conflicts


class TableSet:
    """Several Parquet tables below one shared folder that change together or not at all.

    Tables are written beside the present ones; a manifest, published last, names the folder of each. Readers take all tables from one
    manifest. A run that dies before that leaves the tables as they were, and its folders unnamed.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._versions = Versions(spark, f"{self._folder}/_manifests")

    def read(self) -> dict[str, DataFrame]:
        """All tables of the newest manifest."""
        return self._open(json.loads(self._versions.latest()[1] or "{}"))

    def _open(self, manifest: dict[str, str]) -> dict[str, DataFrame]:
        return {name: self._spark.read.parquet(f"{self._folder}/{sub}") for name, sub in manifest.items()}

    def _stage(self, tables: dict[str, DataFrame]) -> dict[str, str]:
        run = f"data/{uuid.uuid4().hex}"
        placed = {name: f"{run}/table-{i}" for i, name in enumerate(tables)}
        for name, df in tables.items():
            df.write.parquet(f"{self._folder}/{placed[name]}")
        return placed

    def write(self, tables: dict[str, DataFrame]) -> None:
        """Add or replace whole tables, all in one step."""
        staged = self._stage(tables)
        self._versions.change(lambda text: json.dumps(json.loads(text or "{}") | staged, sort_keys=True))

    def patch(self, changes: dict[str, DataFrame], keys: dict[str, list[str]]) -> None:
        """Apply the changes of all tables, or of none: a conflict in one raises ``PatchConflict`` and leaves every table as it is.

        If another writer publishes in the meantime, the changes are checked and applied anew to what it has published.
        """
        while True:
            number, text = self._versions.latest()
            manifest = json.loads(text or "{}")
            unknown = set(changes) - set(manifest)
            if unknown:
                raise ValueError(f"no such tables: {sorted(unknown)}")
            tables = self._open({name: manifest[name] for name in changes})
            patched = {name: patch(tables[name], change, keys[name]) for name, change in changes.items()}
            wrong = {name: p.conflicts for name, p in patched.items() if not p.conflicts.isEmpty()}
            if wrong:
                raise PatchConflict(wrong)
            staged = self._stage({name: p.table for name, p in patched.items()})
            if self._versions.publish(number + 1, json.dumps(manifest | staged, sort_keys=True)):
                return
