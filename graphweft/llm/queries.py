"""The registered queries of this subpackage, with SQL where plain SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_folder
from . import audit, dartminhash, fingerprint, inner, language, licences, mixing, pieces, quality, spelling, suffixes, urlrules, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op1_warc_salvage", warc.SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back; payload size and digest are taken from the payload wherever a record holds one."""
    path = new_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path, "page_id", F.col("html"), "url")
    found = warc.read_archives(spark, path).where("problem is null")
    revisit = F.col("type") == "revisit"
    return found.select(
        warc.row_id(F.col("id")).cast("long").alias("page_id"),
        F.when(revisit, F.col("payload_bytes")).otherwise(F.length("payload")).cast("long").alias("payload_bytes"),
        F.when(revisit, F.substring_index("digest", ":", -1)).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        F.col("type").alias("record_type"),
        warc.row_id(F.col("refers_to")).cast("long").alias("refers_to"),
    )


@query("op2_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = fingerprint.with_next(docs, "doc_id", "text", lambda d: d.withColumn("sketch", fingerprint.sketch(F.col("text"))), ["text", "sketch"])
    rows = rows.withColumn("n_chars", F.length("text")).withColumn(
        "edited", F.expr("concat(substring(text, 1, n_chars - n_chars div 2), substring(next_text, 1, cast(n_chars div 2 as int)))")
    )
    rows = rows.withColumn("edited_sketch", fingerprint.sketch(F.col("edited")))
    return rows.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.to_text(F.col("sketch")).alias("fingerprint"), fingerprint.to_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprint.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprint.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


@query("op3_top_inner_products", inner.SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", inner.whole_numbers(F.col("embedding"), 256.0).alias("vec"))
    return inner.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5, "vec_id")


@query("op4_url_rules", urlrules.SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(urlrules.RULES, "host string, path string, verdict string")
    return urlrules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules, "page_id").drop("url")


@query("op5_near_classes")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_classes(table(spark, sf_dir, "documents"))


@query("op6_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query("op7_mix_sources", mixing.SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_repeated_bytes")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents"))


@query("op9_licences")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op10_piece_round_trip")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_language")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from three quarters of the documents; ``accepted`` is false where the margin is narrow."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    languages = language.learn(docs.where(~held_out))
    return language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), languages).drop("text")


@query("op12_filter_audit", audit.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(audit.masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@query("op13_spelling_variants", spelling.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.count_words(table(spark, sf_dir, "documents"), slips=spelling.SLIP))
