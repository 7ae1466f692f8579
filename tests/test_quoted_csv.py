"""Quoted CSV in splits against Spark's reader with one task per file."""

import csv
import os
import random

import pytest

from quire.sources.files import read_header_csv


def _value(rng):
    words = ["la", "je t'aime", 'say "hi"', "a,b", "line\nbreak", "\n\nverse\n", "", "é漢", "x" * 300]
    return " ".join(rng.choice(words) for _ in range(rng.randrange(1, 6)))


def _write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["Artist", "Song", "Lyrics"])
        w.writerows(rows)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_many_splits_equal_one_task(small_splits, tmpdir_path, end):
    spark, rng = small_splits, random.Random(3)
    for n in range(2):
        _write(os.path.join(tmpdir_path, f"{n}.csv"), [(f"artist {n} {i}", _value(rng), _value(rng)) for i in range(150)], end)
    got = read_header_csv(spark, tmpdir_path)
    whole = read_header_csv(spark, tmpdir_path, splittable=False)
    assert got.columns == whole.columns == ["Artist", "Song", "Lyrics"]
    assert _rows(got) == _rows(whole) and got.count() == 300
    assert spark.read.option("lineSep", "\n").text(tmpdir_path).rdd.getNumPartitions() > 20


def test_a_record_over_many_splits(small_splits, tmpdir_path):
    """One field of 9,000 bytes without an end of record, then records that begin and end inside single splits."""
    path = os.path.join(tmpdir_path, "long.csv")
    _write(path, [("a", "b", "verse, \"one\"\n" * 750), ("c", "d", "e"), ("f", "", "g\nh" * 400), ("i", "j", "k")])
    assert _rows(read_header_csv(small_splits, path)) == _rows(read_header_csv(small_splits, path, splittable=False))


def test_odd_files(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "odd.csv")
    with open(path, "w", newline="") as f:
        f.write('\na,"b\nb"\n\n1\n2,3,4\n\n"",\n"x\ny",z')                 # a broken header, blank lines, short and long rows, no last end
    got = read_header_csv(spark, path)
    assert _rows(got) == _rows(read_header_csv(spark, path, splittable=False)) and got.count() == 4
    with open(path, "w") as f:
        f.write("a,b\n")
    assert read_header_csv(spark, path).collect() == []


@pytest.mark.parametrize("text", ['a,b\n5" pipe,1\n6" pipe,2\n', 'a,b\n1,"never closed\n2,3\n'])
def test_stray_quotes_raise(spark, tmpdir_path, text):
    path = os.path.join(tmpdir_path, "stray.csv")
    with open(path, "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="quote inside an unquoted field"):
        read_header_csv(spark, path).collect()
