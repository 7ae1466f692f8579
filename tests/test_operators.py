"""Ranking, sampling, neighbours, metrics and model invariants."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions.keys import hash_key
from quire.operators import metrics as E
from quire.operators import models as MD
from quire.operators.neighbors import knn_vote, topk_similar
from quire.operators.ranking import bucketed_rank, ntile_of_rank
from quire.operators.sampling import batch_numbers, random_split, stratified_folds

SF = "/root/testdata/sf0.001"


def test_bucketed_rank_equals_row_number(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 3).withColumn("k", hash_key(7, "id"))
    exp = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("k")))
    got = bucketed_rank(df, "k", ["g"], digits=2, rank_col="r", size_col="n")
    a = sorted((r["id"], r["r"]) for r in exp.collect())
    b = sorted((r["id"], r["r"]) for r in got.collect())
    assert a == b
    assert {r["n"] for r in got.filter("g = 0").collect()} == {1667}


@pytest.mark.parametrize("n,tiles", [(10, 5), (11, 5), (13, 4), (3, 5)])
def test_ntile_of_rank(spark, n, tiles):
    df = spark.range(1, n + 1).select(F.col("id").alias("r"))
    exp = df.select("r", (F.ntile(tiles).over(Window.orderBy("r")) - 1).alias("t"))
    got = df.select("r", ntile_of_rank(F.col("r"), F.lit(n), tiles).alias("t"))
    assert sorted(map(tuple, exp.collect())) == sorted(map(tuple, got.collect()))


def test_sampling_is_partition_independent(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    outs = []
    for parts in (1, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        b = batch_numbers(li.repartition(parts), 64, ["l_orderkey", "l_linenumber"])
        s = random_split(li.repartition(parts), ["l_orderkey", "l_linenumber"])
        outs.append((sorted(map(tuple, b.collect())), sorted(map(tuple, s.collect()))))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert outs[0] == outs[1]
    split = [r[2] for r in outs[0][1]]
    assert sum(1 for v in split if v == "train") == int(0.8 * len(split))


def test_folds_are_stratified(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    f = stratified_folds(e, "label", ["vec_id"], 5)
    per = f.groupBy("label", "fold").count().collect()
    by_label = {}
    for r in per:
        by_label.setdefault(r["label"], []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in by_label.values())


@pytest.mark.parametrize("metric", ["cosine", "euclidean", "manhattan", "dot"])
def test_topk_similar_matches_brute_force(spark, metric):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(60, 5)).round(2)
    X[3] = X[7]                                          # a duplicate (zero distance, ties)
    rows = [(i, X[i].tolist(), i % 3) for i in range(len(X))]
    df = spark.createDataFrame(rows, "id long, vec array<double>, g long")
    got = topk_similar(df, df, 4, metric, exclude_self=True, q_group="g", c_group="g", block_rows=16)
    got = {(r["qid"], r["rank"]): r["cid"] for r in got.collect()}

    def score(a, b):
        if metric == "cosine":
            return a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
        if metric == "dot":
            return a @ b
        if metric == "euclidean":
            return -np.linalg.norm(a - b)
        return -np.abs(a - b).sum()
    for q in range(len(X)):
        c = [j for j in range(len(X)) if j != q and j % 3 != q % 3]
        best = sorted(c, key=lambda j: (-score(X[q], X[j]), j))[:4]
        assert [got[(q, r + 1)] for r in range(4)] == best


def test_knn_vote_distance_zero_wins(spark):
    neigh = spark.createDataFrame([(1, 10, 0.0), (1, 11, -1.0), (1, 12, -1.0)], "qid long, cid long, score double")
    labels = spark.createDataFrame([(10, 5), (11, 2), (12, 2)], "cid long, label int")
    assert knn_vote(neigh, labels, "distance", "euclidean").first()["prediction"] == 5
    assert knn_vote(neigh, labels, "uniform", "euclidean").first()["prediction"] == 2


def test_knn_vote_duplicate_vectors_cosine(spark):
    v = [0.1, 0.2, 0.3]
    rows = [("q", v), ("same", [3 * x for x in v]), ("near", [0.1, 0.2, 0.31]), ("near2", [0.1, 0.21, 0.3])]
    df = spark.createDataFrame(rows, "id string, vec array<double>")
    neigh = topk_similar(df.filter("id = 'q'"), df, 3, "cosine", exclude_self=True)
    got = [(r["qid"], r["cid"]) for r in neigh.orderBy("rank").collect()]
    assert [c for _, c in got][0] == "same" and len(got) == 3          # string ids stay strings
    labels = spark.createDataFrame([("same", 1), ("near", 0), ("near2", 0)], "cid string, label int")
    assert knn_vote(neigh, labels, "distance", "cosine").first()["prediction"] == 1
    over = spark.createDataFrame([(1, 10, 1.0 + 2e-16), (1, 11, 0.5)], "qid long, cid long, score double")
    assert knn_vote(over, spark.createDataFrame([(10, 7), (11, 3)], "cid long, label int"), "distance",
                    "cosine").first()["prediction"] == 7


def test_predictor_is_built_once_per_worker(spark, tmpdir_path):
    import os

    def make():
        import os
        import uuid
        open(os.path.join(tmpdir_path, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return lambda b: b["id"].astype(str)
    out = MD.score_table(spark.range(200).repartition(40), make)
    assert out.collect() and out.count() == 200                       # two jobs of 40 tasks
    built = [f.split("-")[0] for f in os.listdir(tmpdir_path)]
    assert built and len(built) == len(set(built))


def test_report_and_confusion(spark):
    p = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 1)], "label int, prediction int")
    rep = {r["name"]: r for r in E.classification_report(p).collect()}
    assert rep["1"]["precision"] == pytest.approx(0.5) and rep["1"]["recall"] == pytest.approx(1.0)
    assert rep["2"]["precision"] == 0.0 and rep["2"]["support"] == 1      # 0/0 -> 0
    assert rep["accuracy"]["f1"] == pytest.approx(0.6)
    cm = {(r["label"], r["prediction"]): r["count"] for r in E.confusion_matrix(p).collect()}
    assert len(cm) == 9 and cm[(2, 2)] == 0 and cm[(1, 1)] == 2


def test_smoothed_loss_checks_target(spark):
    df = spark.createDataFrame([([0.1, 0.2, 0.3, 0.4], 7)], "z array<double>, label int")
    with pytest.raises(Exception, match="Target out of range"):
        E.smoothed_weighted_loss(df, "z", "label", 4, 0.1, [1.0, 1.5, 1.2, 1.3]).collect()


def test_cross_entropy_value(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], 2), ([0.0, 0.0, 0.0], 0)], "z array<double>, label int")
    z = np.array([1.0, 2.0, 3.0])
    exp = ((np.log(np.exp(z).sum()) - 3.0) + np.log(3.0)) / 2
    assert E.cross_entropy(df, "z", "label").first()["loss"] == pytest.approx(exp, abs=1e-6)
    assert E.cross_entropy(df, "z", "label", ignore_label=0).first()["loss"] == \
        pytest.approx(np.log(np.exp(z).sum()) - 3.0, abs=1e-6)


def test_models_learn_better_than_chance(spark):
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(0)
    X = np.vstack([rng.normal(loc=c * 3.0, size=(40, 4)) for c in range(3)])
    y = np.repeat([0.0, 1.0, 2.0], 40)
    df = spark.createDataFrame([(X[i].tolist(), float(y[i])) for i in range(len(y))], "f array<double>, label double")
    df = df.select(array_to_vector("f").alias("features"), "label")
    for m in (MD.logistic_regression(df, C=10.0, one_vs_rest=True), MD.softmax_regression(df),
              MD.mlp_classify(df, 4, 3, max_iter=200)):
        acc = m.transform(df).select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
        assert acc > 0.8


def test_score_table_and_pca(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "n_chars")

    def make():
        return lambda b: (b["n_chars"] > 100).map({True: "big", False: "small"})
    out = MD.score_table(d, make)
    assert out.count() == d.count() and set(out.columns) == {"doc_id", "n_chars", "prediction"}
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    p = MD.project_2d(e)
    assert p.count() == e.count() and {"x", "y"} <= set(p.columns)


def test_word_vectors_vocabulary(spark):
    s = spark.createDataFrame([(["a", "b", "c", "a"],), (["b", "c", "d"],)], "tokens array<string>")
    v = MD.train_word_vectors(s, dim=8, min_count=1)
    assert v.count() == 4 and len(v.first()["vector"]) == 8
    assert {r["word"] for r in MD.train_word_vectors(s, dim=8, min_count=2).collect()} == {"a", "b", "c"}


def test_latent_grid(spark):
    from quire.operators.matrix import latent_grid
    g = latent_grid(spark.range(1), 3, -1.0, 1.0).orderBy("row", "col").collect()
    assert [(r["x"], r["y"]) for r in g[:3]] == [(-1.0, 1.0), (0.0, 1.0), (1.0, 1.0)]
    assert g[-1]["y"] == -1.0 and len(g) == 9
