"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.adaptive_scan import nearest
from tallyloom.llm.bpe import round_trip_digests
from tallyloom.llm.cover_tree import exact_top_k
from tallyloom.llm.importance import importance_sample
from tallyloom.llm.jaccard_join import jaccard_components
from tallyloom.llm.kneser_ney import score, train
from tallyloom.llm import lexical
from tallyloom.llm.language import identify, train_languages
from tallyloom.llm.licenses import SPEAKS_OF_LICENCE, oracle, scan_licenses
from tallyloom.llm.packing import pack_documents
from tallyloom.llm.shared import bounded_batches
from tallyloom.llm.suffix_dedup import remove_repeats
from tallyloom.llm.toxicity import score_toxicity, train_toxicity
from tallyloom.llm.variants import group_variants

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score(docs, train(docs))


def op2_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return exact_top_k(rows, rows.where("vec_id % 20 = 0"))


def op3_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (table(spark, folder, name) for name in ("documents", "labels"))
    return importance_sample(docs, labels).where("kept").drop("kept")


def held_out_by_crc(modulus: int, remainder: int):
    return F.crc32(F.col("doc_id").cast("string")) % modulus == remainder


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(held_out_by_crc(5, 0), F.lit(False))
    models = train_languages(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return identify(rows, models).drop("text")


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # Passages shorter than the 400 bytes that go are told by n_shared.
    return remove_repeats(docs, shared=240).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_shared"
    )


def op7_adaptive_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return nearest(rows, rows.where("vec_id % 20 = 0"))


def as_files(docs: DataFrame) -> DataFrame:
    """Documents with a path below their source; every second one with a licence is a licence file."""
    stated = F.col("text").rlike(SPEAKS_OF_LICENCE) & (F.col("doc_id") % 2 == 0)
    name = F.concat(F.when(stated, "LICENSE-").otherwise("doc-"), F.col("doc_id"))
    depth = (F.col("doc_id") % 3 + 1).cast("int")
    folders = F.array(
        F.col("source"), (F.col("doc_id") % 11).cast("string"), (F.col("doc_id") % 97).cast("string")
    )
    path = F.concat_ws("/", F.array_join(F.slice(folders, 1, depth), "/"), name)
    return docs.select("doc_id", path.alias("path"), "text")


FILES_SQL = f"""
  SELECT doc_id, array_to_string([source, (doc_id % 11)::VARCHAR, (doc_id % 97)::VARCHAR][1:doc_id % 3 + 1], '/')
    || '/' || CASE WHEN regexp_matches(text, '{SPEAKS_OF_LICENCE.removeprefix("(?i)")}', 'i') AND doc_id % 2 = 0
    THEN 'LICENSE-' ELSE 'doc-' END || doc_id AS path, text
  FROM documents
"""


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(as_files(table(spark, folder, "documents")))


def op9_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip_digests(
        table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY)
    )


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of documents with its form and root; nulls, ties and repeats as in group_variants."""
    return group_variants(table(spark, folder, "documents"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item; nulls, ties and repeats as in rank_documents."""
    return lexical.rank_documents(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document; nulls, ties and repeats as in score_toxicity."""
    docs, labels = (table(spark, folder, name) for name in ("documents", "labels"))
    held_out = F.coalesce(held_out_by_crc(3, 1), F.lit(False))
    model = train_toxicity(docs, labels.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    scored = score_toxicity(rows, model, carry=("held_out",))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_kneser_ney,
        op2_exact_top_k,
        op3_importance_resampling,
        op4_language_id,
        op5_best_fit_packing,
        op6_suffix_dedup,
        op7_adaptive_scan,
        op8_license_scan,
        op9_bpe_round_trip,
        op10_jaccard_join,
        op11_spelling_variants,
        op12_lexical_search,
        op13_toxicity,
    )
    return {f.__name__: f for f in found}


def llm_oracles() -> dict[str, str]:
    return {"op8_license_scan": oracle(FILES_SQL), "op12_lexical_search": lexical.oracle()}
