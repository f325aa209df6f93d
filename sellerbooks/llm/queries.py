"""The corpus queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from sellerbooks.llm import (
    ann,
    centroids,
    licenses,
    lines,
    mixing,
    packing,
    pieces,
    quality,
    repeats,
    search,
    simhash,
    spelling,
    warc,
)
from sellerbooks.llm.common import read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.label_documents(read_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(read_table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return kept.select(
        "doc_id", "n_lines", "n_removed", F.length(text).cast("long").alias("kept_chars"), F.md5(text).alias("kept_md5")
    )


def op3_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(read_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read_table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(read_table(spark, sf_dir, "pages")).filter("kind = 'record'")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(read_table(spark, sf_dir, "documents"))
    spans = F.size("removed").cast("long").alias("n_spans")
    # After the contract's columns: what is left of the text.
    kept = (F.col("n_bytes") - F.col("n_removed")).alias("kept_bytes")
    return found.select("doc_id", "n_bytes", "n_removed", spans, "kept_sha256", kept)


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    done = pieces.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return done.select(
        "doc.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(read_table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(read_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
    return found.withColumn("centroid_sha256", centroids.centroid_digest(F.col("centroid"))).drop("centroid")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and name[2:3].isdigit()}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": licenses.CHECK_SQL,
        "op2_line_dedup": lines.CHECK_SQL,
        "op3_block_max_search": search.CHECK_SQL,
        "op7_warc": warc.CHECK_SQL,
        "op12_spelling_variants": spelling.CHECK_SQL,
        "op13_centroid_clusters": centroids.CHECK_SQL,
    }
