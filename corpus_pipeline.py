"""The corpus pipeline: language ID, near-duplicate removal, repeat removal, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrail.llm.common import broadcast_ids, table, written
from vetrail.llm.jaccard import jaccard_components
from vetrail.llm.langid import UNKNOWN, fit_languages, identify_languages
from vetrail.llm.mixing import mix_sources
from vetrail.llm.packing import pack_documents
from vetrail.llm.suffix import cut_repeats
from vetrail.session import materialized, with_package

TOKENIZER = "word_bpe_49k.json"
#: Texts whose two likeliest languages are closer than this go: far less than what the operator flags by
#: default, so that short clean texts stay.
AMBIGUOUS = 0.01


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def _row_keys(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows and the column that tells them apart: ``doc_id``, or where ids repeat or are null a written row
    number that follows the ids, null last."""
    odd = docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null").limit(1).count()
    if not odd:
        return docs, "doc_id"
    key = _free(docs, "_row")
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return written(rows.withColumn(key, F.monotonically_increasing_id())), key


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language (no letter) or with an ambiguous one go."""
    taken = {c: f"_{c}_of_docs" for c in ("lang_pred", "score", "ambiguous", "_letters") if c in docs.columns}
    rows = identify_languages(docs.withColumnsRenamed(taken), fit_languages(docs), ambiguous=AMBIGUOUS)
    kept = rows.filter((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous"))
    return kept.select(*[F.col(taken.get(c, c)).alias(c) for c in docs.columns])


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row of the smallest id stays, null ids last.

    Rows are told apart by themselves: rows of one id stay unless their texts are near-duplicates.
    """
    rows, key = _row_keys(docs)
    classes = jaccard_components(rows, id_column=key)
    gone = materialized(classes.filter(F.col(key) != F.col("component_id")).select(key))
    return rows.join(broadcast_ids(gone), key, "left_anti").select(docs.columns)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that repeat earlier ones are cut out; characters cut through are dropped.

    Rows that share an id or have none are documents of their own here, null ids last.
    """
    rows, key = _row_keys(docs)
    others = [c for c in docs.columns if c not in (key, "text", "n_chars")]
    # A column that has the name of the result is carried under another.
    aside = _free(docs, "_kept_text")
    rows = rows.withColumnRenamed("kept_text", aside)
    cut = cut_repeats(rows, id_column=key, keep=[aside if c == "kept_text" else c for c in others])
    cut = cut.withColumnsRenamed({"kept_text": "text", aside: "kept_text"})
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, whether or not it has an id of its own."""
    rows, key = _row_keys(docs)
    copies, copy = _free(docs, "_copies"), _free(docs, "_copy")
    mixed = mix_sources(rows, id_column=key).filter("copies > 0").select(key, F.col("copies").alias(copies))
    rows = rows.join(broadcast_ids(materialized(mixed)), key)
    return rows.withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col(copies)))).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of all documents."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", jaccard_join),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing", mixing),
    ("best-fit packing", best_fit_packing),
]

#: SQL cannot express the classifier, the hashed rounding or the tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole ``documents`` table; each result is written and read again."""
    docs = table(with_package(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
