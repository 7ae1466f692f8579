"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import bound_batches, materialise, read_table, release
from quire.llm.decontaminate import drop_contaminated
from quire.llm.minhash_dedup import drop_near_duplicates
from quire.llm.mixing import take_mix
from quire.llm.token_output import write_training_order
from quire.llm.toxicity import drop_toxic, fit


def _stage(name: str, apply: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """The stage ``name``; what earlier stages have broadcast is freed first, since their rows are written by then."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release()
        bound_batches(spark)
        return apply(spark, docs, sf_dir)
    return name, run


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones, does not call toxic."""
    return drop_toxic(docs, fit(docs, read_table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least id."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return take_mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of token ids in training order; one row per sequence."""
    return write_training_order(docs)


STAGES = [_stage("toxicity", toxicity), _stage("near_dedup", near_dedup), _stage("decontamination", decontamination),
          _stage("mixing", mixing), _stage("token_output", token_output)]

#: a trained model and a tokenizer have no SQL; the tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
