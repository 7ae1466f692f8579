"""The numbered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import sql
from quire.llm.common import read_table
from quire.llm.decontaminate import contaminated
from quire.llm.fingerprints import fingerprints
from quire.llm.html_extract import extract_text
from quire.llm.importance import importance_scores
from quire.llm.line_dedup import drop_shared_lines
from quire.llm.minhash_dedup import near_duplicates
from quire.llm.mixing import mix
from quire.llm.nra_search import rank_documents
from quire.llm.pii import personal_data
from quire.llm.pivot_search import exact_top_k
from quire.llm.substring_dedup import remove_repeated_spans
from quire.llm.token_output import write_training_order
from quire.llm.toxicity import HELD_OUT, fit, fold_of, score


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold_of("doc_id") == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))


def op4_mixing_to_target_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_shared_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_spans(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = personal_data(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_training_order(read_table(spark, sf_dir, "documents"))


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for each benchmark item; nulls, ties and repeated rows as in :mod:`quire.llm.nra_search`."""
    return rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).select("item_id", "rank", "doc_id", "score")


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best vectors for each vector with an id divisible by 100; odd rows as in :mod:`quire.llm.pivot_search`."""
    return exact_top_k(read_table(spark, sf_dir, "embeddings")).select("query_id", "rank", "vec_id", "score")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance for the benchmark and its rank in the draw; odd rows as in :mod:`quire.llm.importance`."""
    scored = importance_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return scored.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_toxicity, op3_document_fingerprints, op4_mixing_to_target_weights, op5_html_extraction, op6_line_dedup,
    op7_substring_dedup, op8_pii, op9_benchmark_decontamination, op10_token_output, op11_ranked_lexical_search, op12_exact_top_k,
    op13_importance_resampling)}
ORACLES = dict(sql.ORACLES)
