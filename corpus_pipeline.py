"""Corpus preparation: filter by quality and language, deduplicate twice, pack.

Every stage takes the documents that the one before kept and returns whole rows
with the columns of documents; the last one returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.catalog import VOCABULARY
from tallyloom.llm.importance import sampled_rows
from tallyloom.llm.jaccard_join import jaccard_components
from tallyloom.llm.language import identify, train_languages
from tallyloom.llm.packing import pack_documents
from tallyloom.llm.shared import bounded_batches, named_again, plain_columns, written
from tallyloom.llm.suffix_dedup import remove_repeats


# Bytes of a repeated string; 99 in 100 passages of 51 words in the sample tables are longer.
REPEATED_BYTES = 200
# Near copies: shingles of five words, of which four in five are common.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws; null texts have weight 0."""
    bounded_batches(spark)
    return sampled_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones teach; texts without letters go."""
    bounded_batches(spark)
    models = train_languages(docs)
    plain, (text,) = plain_columns(docs, "text")
    return named_again(identify(plain, models, text=text).where("not rejected"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every group, once.

    Rows that repeat both id and text count once; a null id is a group of its
    own unless its text links to another row.
    """
    bounded_batches(spark)
    found = jaccard_components(docs, shingle_words=NEAR_WORDS, percent=NEAR_PERCENT)
    found = found.where("doc_id <=> component_id")
    stay = found.groupBy(F.col("doc_id").alias("stay_id")).agg(F.count("*").alias("copies"))
    plain, (doc_id, text) = plain_columns(docs, "doc_id", "text")
    kept = plain.join(stay, plain[doc_id].eqNullSafe(stay["stay_id"]))
    # Only rows whose id repeats are compared; the others are not shuffled again.
    same = Window.partitionBy(doc_id, F.xxhash64(text)).orderBy(F.lit(0))
    repeated = kept.where("copies > 1").withColumn("turn", F.row_number().over(same))
    once = kept.where("copies = 1").withColumn("turn", F.lit(1)).union(repeated)
    return named_again(once.where("turn = 1"), docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the strings of REPEATED_BYTES bytes that repeat; n_chars follows the text.

    A cut inside a character leaves a replacement character.  A null text stays null.
    """
    bounded_batches(spark)
    plain, (doc_id, text, n_chars) = plain_columns(docs, "doc_id", "text", "n_chars")
    cut = remove_repeats(plain, length=REPEATED_BYTES, doc_id=doc_id, text=text)
    left = F.make_valid_utf8(F.col("kept").cast("string"))
    changed = F.col("n_removed") > 0
    cut = cut.withColumn(text, F.when(changed, left).otherwise(F.col(text)))
    length = F.length(text).cast(docs.schema["n_chars"].dataType)
    return named_again(cut.withColumn(n_chars, F.when(changed, length).otherwise(F.col(n_chars))), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens and their places in sequences."""
    bounded_batches(spark)
    return pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("packing", packing),
]
# Models, components and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
