"""Results must not depend on how the rows are partitioned."""

import pytest

from quire.plans.catalog import QUERIES

from conftest import SF_SMALL


@pytest.mark.parametrize("partitions,adaptive", [(3, "true"), (8, "false"), (64, "true"), (64, "false")])
def test_tfidf_collocations_are_the_same(spark, partitions, adaptive):
    want = QUERIES["collocations_by_tfidf"](spark, SF_SMALL).collect()
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        got = QUERIES["collocations_by_tfidf"](spark, SF_SMALL).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_cross_entropy_counts_certain_mistakes(spark):
    from quire.operators.metrics import binary_cross_entropy
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0)], "p double, y double")
    assert binary_cross_entropy(df, "p", "y").first()[0] == 50.0


def test_half_written_subset_is_built_again(spark, tmpdir_path):
    import os

    from quire.sources.files import cached_subset
    path = os.path.join(tmpdir_path, "subset")
    os.makedirs(path)
    got = cached_subset(spark, path, lambda: spark.range(3).toDF("x"))
    assert got.count() == 3
