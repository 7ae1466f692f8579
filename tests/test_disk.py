"""What queries leave on disk and deal out by (the findings of round 3 on disk and on large tasks)."""

import time

from conftest import SF_SMALL
from pyspark.sql import functions as F

from quire import session
from quire.plans import q_features, q_lm
from quire.plans.q_generate import SPOKEN


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_freed_while_the_table_is_written(spark, monkeypatch):
    seen = []
    writer = type(spark.range(1).write)
    parquet = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda self, *a, **b: (seen.append(spark.conf.get(session.FREE_SHUFFLES)), parquet(self, *a, **b))[1])
    before, setting = _shuffle_files(spark), spark.conf.get(session.FREE_SHUFFLES)
    session.written(spark.range(2000).repartition(5, "id"))
    assert seen == ["true"] and spark.conf.get(session.FREE_SHUFFLES) == setting
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before


def test_next_token_queries_write_what_they_read(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(q_lm, "written", lambda df: (seen.append(df.columns), df)[1])
    q_lm.lm_counts(spark, SF_SMALL)
    q_lm.lm_model(spark, SF_SMALL, SPOKEN)
    counts = ["corpus", "n", "gram", "cnt"]
    assert seen == [counts, list(SPOKEN), counts]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_categories_are_sent_to_the_sentences(spark):
    """Dealt out by language or source, a few of them are a few tasks.  A null language has a code, but meets none."""
    d = spark.createDataFrame([(f"1-0-{i}", f"s{i % 3}", f"l{i % 2}", 1, i, "one two three four") for i in range(9)] + [("2-0-0", None, None, 2, 0, "a b")],
                              "id string, source string, lang string, doc_id long, para_no int, sentence_text string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f, c = q_features.custom_features(spark, None, d), q_features.doc_classes(d)
        assert "BroadcastHashJoin" in _plan(f) and "SortMergeJoin" not in _plan(f)
        assert _plan(c).count("hashpartitioning(source") == 0
        assert {r["id"]: r["protocol_type"] for r in f.collect()} == {f"1-0-{i}": float(i % 2 + 1) for i in range(9)}
        assert {r["id"]: r["class"] for r in c.collect()}["1-0-0"] == "first"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
