"""Thin ``opN_<name>`` queries over the whole tables; each derives its digest columns from its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgegraph.llm import (byte_bpe, decontam, kneser_ney, langid, license_scan, line_dedup, mixing, neardup, ns_clusters,
                            quality, url_filter, vector_codes, warc)
from edgegraph.llm.oracles import oracle_sql  # noqa: F401
from edgegraph.sources.tables import load_table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality.judge(load_table(spark, sf_dir, "documents"), ["doc_id"])
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _remainder(by: int):
    """crc32 of the doc_id as text, modulo ``by``; a null doc_id has none and gets -1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % by, F.lit(-1))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").withColumn("held_out", _remainder(3) == 1)
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.identify(docs, model, ["doc_id", "held_out"]).select(
        "doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(load_table(spark, sf_dir, "documents"), ["doc_id"])
    return license_scan.summarise(found, ["doc_id"])


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_index(load_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"),
                               short=True)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(load_table(spark, sf_dir, "pages"), url_filter.build(url_filter.entries(spark)), ["page_id"])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = line_dedup.annotate(load_table(spark, sf_dir, "documents"), ["doc_id"])
    return d.select("doc_id", "n_lines", "n_removed", F.array_join(F.col("removed_lines").cast("array<string>"), ",")
                    .alias("removed_lines"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").withColumn("held_out", _remainder(7) == 2)
    return kneser_ney.train_and_score(docs, ["doc_id", "held_out"], ~F.col("held_out")).drop("perplexity")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = mixing.document_shards(load_table(spark, sf_dir, "documents"), ["doc_id"])
    return d.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"))


def op10_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.components(load_table(spark, sf_dir, "documents"), percent=85).drop("t")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = byte_bpe.encode(load_table(spark, sf_dir, "documents"), path, ["doc_id"])
    return byte_bpe.decode(ids, path, ["doc_id", "ids"]).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = vector_codes.compress(load_table(spark, sf_dir, "embeddings"), ["vec_id", "label"])
    return vector_codes.label_errors(rows).select("vec_id", "code", "error", "label_error",
                                                  F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids = ns_clusters.cluster(load_table(spark, sf_dir, "embeddings"), ["vec_id"])
    return ns_clusters.with_inertia(rows, centroids).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (
        op1_language_id, op2_license_scans, op3_quality_rules, op4_warc, op5_decontamination, op6_url_filters,
        op7_line_dedup, op8_lm_scoring, op9_mixing, op10_minhash_neardup, op11_byte_bpe, op12_vector_codes, op13_centroid_clusters)}
