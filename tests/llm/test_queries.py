"""The registered queries against their SQL, and the pipeline's stages against their operators' rules."""

from collections import Counter

import duckdb
import pytest

from llm_tables import SMALL

from quire.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SMALL)
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == Counter(map(tuple, cur.fetchall()))


def test_one_query_each():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    import corpus_pipeline as P
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_output"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r["doc_id"] for r in docs.select("doc_id").collect()}
    stages = dict(P.STAGES)
    for name in ("toxicity", "near_dedup", "decontamination", "mixing"):
        out = stages[name](spark, docs, SMALL)
        assert out.columns == docs.columns
        assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} <= before
    rows = P.run(spark, SMALL).collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
