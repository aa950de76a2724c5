"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrail.llm.clusters import centroid_clusters
from vetrail.llm.codes import vector_codes
from vetrail.llm.common import table
from vetrail.llm.fingerprint import fingerprints
from vetrail.llm.jaccard import jaccard_components
from vetrail.llm.langid import fit_languages, identify_languages
from vetrail.llm.licenses import license_templates, scan_templates
from vetrail.llm.materialise import training_order, written_shards
from vetrail.llm.mixing import mix_sources
from vetrail.llm.oracle import ORACLE
from vetrail.llm.packing import pack_documents
from vetrail.llm.quality import fit_quality, score_quality
from vetrail.llm.suffix import cut_repeats
from vetrail.llm.urls import build_digest_array, filter_urls, rules_table
from vetrail.llm.vectors import near_duplicate_vectors
from vetrail.session import fresh_folder

TOKENIZER = "word_bpe_49k.json"

__all__ = ["ORACLE", "QUERIES"]


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License texts and notices, and the protected passages of the benchmark, found in all documents."""
    passages = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("passage-"), F.col("item_id").cast("string")).alias("template_id"), F.col("text").alias("template")
    )
    found = scan_templates(table(spark, sf_dir, "documents"), license_templates(spark).unionByName(passages))
    name = F.when(F.contains("template_id", F.lit("/")), F.substring_index("template_id", "/", 1))
    return found.withColumn("license", name)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def fold(column: str, folds: int) -> Column:
    """crc32 of a column as text, modulo the number of folds."""
    return F.crc32(F.col(column).cast("string")) % folds


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    model = fit_languages(documents.filter(~held_out))
    rows = documents.select("doc_id", "text", held_out.alias("held_out"))
    return identify_languages(rows, model).drop("text")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence with its slot and shard; the tasks write the shards into a new shared folder."""
    folder = fresh_folder(spark)
    ordered = training_order(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), folder)
    return written_shards(ordered, folder)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = fit_quality(documents, labels.filter(~held_out))
    rows = documents.select("doc_id", "text", held_out.alias("held_out"))
    return score_quality(rows, model).drop("text")


#: (host, path, verdict) as the query's contract states them.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, build_digest_array(rules_table(spark, URL_RULES)))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_ngram_jaccard_join,
        op3_license_scans,
        op4_best_fit_packing,
        op5_fingerprints,
        op6_embedding_near_dedup,
        op7_language_id,
        op8_mixing,
        op9_token_output,
        op10_quality,
        op11_url_filters,
        op12_vector_codes,
        op13_centroid_clusters,
    )
}
