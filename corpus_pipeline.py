"""The corpus pipeline: quality, near-duplicates, repeated passages, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the
last return the columns of documents, with ``n_chars`` after the changes to the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from graphweft.llm import dartminhash, mixing, pieces, quality, suffixes
from graphweft.session import new_folder


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns ``c_0, c_1, ...``, which no operator uses, and the new name of each."""
    names = {c: f"c_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go, null, empty and blank texts among them; repeated rows share their fate."""
    rows, names = _numbered(docs)
    return quality.classify(rows, names["text"]).where("keep").select(*names.values()).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id stays, once; an id is told from its repetitions by its text."""
    return dartminhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that a string of 100 bytes from an earlier place covers go; documents of which nothing is left go too, as do null and empty texts."""
    return _counted(suffixes.remove(docs)).where("n_chars > 0").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a row per whole pass and one for the words begun.

    A null source is a source, null ids are kept, texts without words are never taken and repeated rows are taken each by itself.
    """
    rows, names = _numbered(docs)
    own = {names["doc_id"]: F.col("doc_id"), names["source"]: F.col("source")}
    others = [n for n in names.values() if n not in own]
    taken = mixing.mix(rows, names["doc_id"], names["source"], names["text"], keep=tuple(others)).where("taken > 0")
    passes = F.concat(F.array_repeat("size", F.expr("cast(taken div size as int)")), F.when(F.expr("taken % size > 0"), F.array(F.expr("taken % size"))).otherwise(F.array().cast("array<bigint>")))
    parts = taken.withColumn("words", F.explode(passes))
    text = mixing.first_words(F.col(names["text"]), F.col("words"), F.col("size"))
    back = parts.withColumn(names["text"], text).select(*[own.get(n, F.col(n)).alias(c) for c, n in names.items()])
    return _counted(back).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, counted and digested, with the digest of what they decode to; null texts have none, repeated rows repeat."""
    return pieces.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", keep_good),
    ("near_dedup", drop_near_copies),
    ("repeated_bytes", cut_repeats),
    ("mix", mix),
    ("encode", encode),
]

#: The first stage fits a model, which SQL cannot; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
