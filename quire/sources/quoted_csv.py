"""Quoted CSV read in byte ranges (S5): record starts inside a file are found by the parity of quotes.

A line of a file with quoted line breaks begins a record exactly when an even number of quotes
precedes it.  The file is scanned twice as lines in Spark's own splits.  The first scan gives one
row per split, the parity of its quotes; the running parity over a file's splits says which of them
begin inside quotes.  The second scan walks the lines of each split from that state and closes
records; only the pieces of the records that cross a border between splits are shuffled, to be put
together.  Fields are then parsed by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: what a record with quotes must look like: quotes stand around whole fields, and double inside them
FIELD = r'(?:"(?:[^"]|"")*+"|[^",]*+)'
RECORD = re.compile(rf"{FIELD}(?:,{FIELD})*+", re.DOTALL)

#: a whole record; the end of one begun in an earlier split; the begin of one that its split does not end
WHOLE, END, BEGIN = 0, 1, 2
PIECES = "file bigint, start bigint, kind int, header boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, line)``: lines in file order within a split, which is named by its file's hash and first byte."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                        F.col("value").alias("line"))


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _split_states(lines: DataFrame) -> DataFrame:
    """``(file, start, inside)``: does the split begin inside quotes?  One row per split."""
    odd = lines.groupBy("file", "start").agg((F.sum(_quotes(F.col("line"))) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return odd.select("file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


class _Split:
    """The walk through one split: ``pieces`` is the record that is open."""

    def __init__(self, file: int, start: int, inside: bool):
        self.file, self.start, self.inside = file, start, inside
        self.pieces: list[str] = []
        self.kind, self.first = (END if inside else WHOLE), start == 0 and not inside

    def rows(self, lines: pa.Array) -> Iterator[tuple]:
        after = (np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)) + self.inside) % 2 == 1
        begin = 0
        for end in np.flatnonzero(~after):                          # lines that leave no quote open end a record
            yield self._close(self.pieces + lines[begin:end + 1].to_pylist())
            self.pieces, begin = [], end + 1
        self.pieces += lines[begin:].to_pylist()
        self.inside = bool(after[-1]) if len(after) else self.inside

    def _close(self, pieces: list[str], kind: int | None = None) -> tuple:
        row = (self.file, self.start, self.kind if kind is None else kind, self.first, "\n".join(pieces))
        self.kind, self.first = WHOLE, self.first and row[4] in ("", "\r")      # empty lines may precede the header
        return row

    def end(self) -> Iterator[tuple]:
        if self.pieces:                                             # no record of this split ends here
            yield self._close(self.pieces, END if self.kind == END else BEGIN)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        names = ["file", "start", "kind", "header", "record"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    split = None
    for batch in batches:
        file, start = (batch.column(k).to_numpy() for k in (0, 1))
        borders = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        out = []
        for lo, hi in zip([0, *borders], [*borders, batch.num_rows]):
            if lo == hi:
                continue
            key = (int(file[lo]), int(start[lo]))
            if split is None or (split.file, split.start) != key:
                out += split.end() if split else ()
                split = _Split(*key, batch.column(3)[int(lo)].as_py())
            out += split.rows(batch.column(2)[int(lo):int(hi)])
        if out:
            yield batch_of(out)
    if split and (out := list(split.end())):
        yield batch_of(out)


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that cross borders, from their pieces in file order: a begin and all ends up to the next begin."""
    order = Window.partitionBy("file").orderBy("start", "kind")
    numbered = pieces.withColumn("nth", F.sum((F.col("kind") == BEGIN).cast("bigint")).over(order))
    parts = numbered.groupBy("file", "nth").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "record"))).alias("p"), F.bool_or("header").alias("header"))
    return parts.select("header", F.array_join("p.record", "\n").alias("record"))


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        records = batch.column(0)
        for record in records.filter(pc.match_substring(records, '"')).to_pylist():
            if not RECORD.fullmatch(record):
                raise ValueError(f"a quote inside an unquoted field, or one never closed, near {record[:80]!r}; "
                                 "such a file has no record borders that a split could find (splittable=False reads it)")
        yield batch


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header whose quoted fields may hold line breaks, by as many tasks as the files have splits.

    All columns are strings, named by the first file's header; every file's first record is its
    header.  Quotes must stand around whole fields and be doubled inside (a file that breaks this
    raises an error instead of giving other records).  Line breaks inside quotes become ``\\n``,
    empty lines between records are skipped, an empty unquoted field is null, missing fields are
    null, and fields beyond the header's are dropped, all as in Spark's own reader.  A header without
    records gives no row.

    The table of split states is sent to the tasks: 17 bytes for each split of
    ``spark.sql.files.maxPartitionBytes``.  Were the files cut otherwise in the second scan, a split
    without a state would end the query with an error.
    """
    names = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path).columns
    lines = _lines(spark, path)
    known = lines.join(F.broadcast(_split_states(_lines(spark, path))), ["file", "start"], "left")
    inside = F.coalesce("inside", F.raise_error(F.lit("the files were split differently in the two scans")).cast("boolean"))
    pieces = known.select("file", "start", "line", inside.alias("inside")).mapInArrow(_walk, PIECES)
    whole = pieces.filter(F.col("kind") == WHOLE).select("header", "record")
    records = whole.unionByName(_joined(pieces.filter(F.col("kind") != WHOLE)))
    text = F.regexp_replace(F.regexp_replace("record", "\r\n", "\n"), "\r$", "")
    kept = records.filter(~F.col("header")).select(text.alias("record")).filter(F.col("record") != "")
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    fields = kept.mapInArrow(_checked, "record string").select(F.from_csv("record", schema, {"escape": '"'}).alias("f"))
    return fields.select("f.*")
