"""URL filters: a sort-merge range join of addresses with prefix rules.

A host is turned round label by label (``www.example.com`` → ``com/example/www/``), so
that a host and its subdomains are one interval of the sorted keys and a rule is the
point where its interval begins. Rules and addresses are sorted together; the sweep
keeps a stack of the rules whose interval is still open, innermost on top, and an
address asks them from the top for one whose path fits. Rules that opened in an
earlier partition are looked up for the first key of each partition: only its own
leading labels can name them.

The rule with the longest host wins, then the longest path, then block before allow.
Addresses that no rule fits get ``default``. A null address, or one without ``://``, has
an empty host and path. Rows with the same address, also a third of all rows, are
spread by their id. Other columns are kept. No rules, or no rows, give no special case.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each ended by a slash, which no host holds; empty for an empty host."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "/"), F.lit("/")))


def _ancestors(key: Column) -> Column:
    """The leading labels of a key, from none to all."""
    labels = F.split(key, "/")
    return F.transform(F.sequence(F.lit(0), F.size(labels) - 1), lambda n: F.when(n == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(labels, 1, n), "/"), F.lit("/"))))


def judge(urls: DataFrame, rules: DataFrame, id_col: str, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with ``host, path, rule, verdict``; ``rules`` has ``host, path, verdict``.

    Columns of these names in ``urls`` are replaced. ``rule`` is the winning rule's host and path.
    """
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    row = urls.select(
        F.struct(*kept).alias("_row"), host_of(F.col(url_col)).alias("_host"), path_of(F.col(url_col)).alias("_path"),
        F.xxhash64(F.col(id_col)).alias("_salt"),
    ).withColumn("_key", host_key(F.col("_host")))
    rule = rules.select(F.lower("host").alias("_host"), F.coalesce("path", F.lit("")).alias("_path"), "verdict").where("_host is not null and not contains(_host, '/')").distinct().withColumn("_key", host_key(F.col("_host")))
    kind = urls.select(*kept).schema
    both = row.select("_key", F.lit(1).alias("_kind"), "_path", "_salt", "_host", F.lit(None).cast("string").alias("_verdict"), "_row").unionByName(
        rule.select("_key", F.lit(0).alias("_kind"), "_path", F.lit(0).cast("long").alias("_salt"), "_host", F.col("verdict").alias("_verdict"), F.lit(None).cast(kind).alias("_row"))
    )
    order = ["_key", "_kind", "_path", "_salt"]
    sorted_rows = cut(both.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_part")))
    # What is open where a partition begins: a few labels of one key each.
    heads = sorted_rows.groupBy("_part").agg(F.min("_key").alias("_head"))
    open_there = heads.select("_part", F.explode(_ancestors(F.col("_head"))).alias("_key")).join(
        rule.select("_key", "_host", "_path", "verdict"), "_key"
    )
    start: dict[int, list[tuple[str, str, str, str]]] = {}
    for r in open_there.collect():
        start.setdefault(r["_part"], []).append((r["_key"], r["_host"], r["_path"], r["verdict"]))
    opened = urls.sparkSession.sparkContext.broadcast(start)  # a key's labels times the partitions

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, list[tuple[str, str, str]]]] = []  # key, its rules as (path, host, verdict)

        def push(key: str, host: str, path: str, verdict: str) -> None:
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not stack or stack[-1][0] != key:
                stack.append((key, []))
            if (path, host, verdict) not in stack[-1][1]:
                stack[-1][1].append((path, host, verdict))
                stack[-1][1].sort(key=lambda r: (-len(r[0]), r[0], r[2] != "block"))

        for key, host, path, verdict in sorted(opened.value.get(TaskContext.get().partitionId(), [])):
            push(key, host, path, verdict)
        for batch in batches:
            key, kind, path, host, verdict = (batch.column(n).to_pylist() for n in ("_key", "_kind", "_path", "_host", "_verdict"))
            at, found_rule, found = [], [], []
            for i in range(batch.num_rows):
                if not kind[i]:
                    push(key[i], host[i], path[i], verdict[i])
                    continue
                while stack and not key[i].startswith(stack[-1][0]):
                    stack.pop()
                hit = next((r for _, inner in reversed(stack) for r in inner if path[i].startswith(r[0])), None)
                at.append(i)
                found_rule.append(hit and hit[1] + hit[0])
                found.append(hit[2] if hit else default)
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("_row"), rows.column("_host"), rows.column("_path"), pa.array(found_rule, pa.string()), pa.array(found, pa.string())],
                ["_row", "host", "path", "rule", "verdict"],
            )

    judged = sorted_rows.drop("_part").mapInArrow(sweep, T.StructType().add("_row", kind).add("host", "string").add("path", "string").add("rule", "string").add("verdict", "string"))
    return judged.select("_row.*", "host", "path", "rule", "verdict")


#: The rules of the registered query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

SQL = r"""
WITH parts AS (
  SELECT page_id, coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '') AS raw,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts),
rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
hit AS (
  SELECT p.*, rule_host || rule_path AS rule, rule_verdict
  FROM p LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
best AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(rule_verdict, length(rule)) AS v FROM hit GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM best
"""
