"""File sources and sinks.

All readers are Spark readers with declared schemas; the only Python in the
read path is the ``.docx`` unpacker (S3), which runs per file inside
``mapInPandas`` with the standard library (``zipfile`` + ``ElementTree``).
"""

from __future__ import annotations

import io
import warnings
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator, Mapping, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import file_knesset_number, file_protocol_type
from quire.sources.quoted_csv import read_quoted_csv

# --- fixed values that must equal the reference ---------------------------
CORPUS_FIELDS = ["protocol_name", "knesset_number", "protocol_type", "protocol_number",
                 "speaker_name", "sentence_text"]
CENSUS_COLUMNS = ["age", "workclass", "fnlwgt", "education", "education-num", "marital-status",
                  "occupation", "relationship", "race", "gender", "capital-gain", "capital-loss",
                  "hours-per-week", "native-country", "income"]
WEATHER_CLASSES = ["Cloudy", "Sunrise", "Shine", "Rain"]
# ---------------------------------------------------------------------------

CORPUS_SCHEMA = T.StructType([
    T.StructField("protocol_name", T.StringType()),
    T.StructField("knesset_number", T.LongType()),
    T.StructField("protocol_type", T.StringType()),
    T.StructField("protocol_number", T.LongType()),
    T.StructField("speaker_name", T.StringType()),
    T.StructField("sentence_text", T.StringType()),
])


# ------------------------------------------------------------------ S1 / S2
def read_corpus_jsonl(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Sentence records from JSON lines with a declared schema (no
    inference pass); missing string fields become '' and the type is
    lower-cased; only ``columns`` are kept (pruned at the reader)."""
    df = spark.read.schema(CORPUS_SCHEMA).json(path)
    cols = list(columns) if columns else CORPUS_FIELDS
    out = []
    for c in cols:
        f = CORPUS_SCHEMA[c]
        v = F.col(c)
        if isinstance(f.dataType, T.StringType):
            v = F.coalesce(v, F.lit(""))
            if c == "protocol_type":
                v = F.lower(v)
        out.append(v.alias(c))
    return df.select(*out)


def write_corpus_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """UTF-8 JSON lines (non-ASCII written as is)."""
    df.write.mode(mode).option("encoding", "UTF-8").json(path)


# ------------------------------------------------------------------ S3
DOCX_SCHEMA = "file_name string, para_no int, text string, error string"


#: paragraphs handed on at a time
FRAME_PARAGRAPHS = 1000


def _docx_paragraphs(content: bytes) -> Iterator[str]:
    """Text of the paragraphs that stand in the body itself: those of tables
    and text boxes are left out.  Tabs and line breaks of a run are kept.  The
    document is read as a stream; a finished part of the body is forgotten."""
    ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    runs = (f"{ns}r", f"{ns}hyperlink/{ns}r")

    def piece(node) -> str:
        if node.tag == f"{ns}t":
            return node.text or ""
        if node.tag == f"{ns}br":
            return "\n" if node.get(f"{ns}type", "textWrapping") == "textWrapping" else ""
        return {f"{ns}tab": "\t", f"{ns}cr": "\n", f"{ns}noBreakHyphen": "-"}.get(node.tag, "")

    with zipfile.ZipFile(io.BytesIO(content)) as z, z.open("word/document.xml") as xml:
        open_: list[ET.Element] = []
        for event, node in ET.iterparse(xml, events=("start", "end")):
            if event == "start":
                open_.append(node)
                continue
            open_.pop()
            if len(open_) == 2 and open_[1].tag == f"{ns}body":
                if node.tag == f"{ns}p":
                    inside = {r for path in runs for r in node.findall(path)}
                    yield "".join(piece(x) for r in node.iter(f"{ns}r") if r in inside for x in r)
                open_[1].remove(node)


def _unpack_docx(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["file_name", "para_no", "text", "error"]
    for b in batches:
        for path, content in zip(b["path"], b["content"]):
            name = path.rstrip("/").rsplit("/", 1)[-1]
            try:
                for _ in _docx_paragraphs(bytes(content)):       # a file with a fault anywhere has no paragraphs
                    pass
            except Exception as e:  # noqa: BLE001 - a bad file is reported, not fatal
                yield pd.DataFrame([(name, -1, None, f"{type(e).__name__}: {e}")], columns=columns)
                continue
            rows = ((name, i, t, None) for i, t in enumerate(_docx_paragraphs(bytes(content))))
            while frame := list(islice(rows, FRAME_PARAGRAPHS)):
                yield pd.DataFrame(frame, columns=columns)


def read_document_folder(spark: SparkSession, folder: str) -> DataFrame:
    """S3: ``.docx`` files of a folder -> ordered paragraphs
    ``(file_name, para_no, text, error)``; a file that cannot be read gives
    one row with ``error`` set and no paragraphs."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.docx")
             .option("recursiveFileLookup", "false").load(folder).select("path", "content"))
    return files.mapInPandas(_unpack_docx, DOCX_SCHEMA)


def protocol_metadata(file_name: Column) -> list[Column]:
    """P12 fields of a protocol file name."""
    return [file_knesset_number(file_name).alias("knesset_number"),
            file_protocol_type(file_name).alias("protocol_type")]


# ------------------------------------------------------------------ S4-S6
def read_headerless_csv(spark: SparkSession, path: str, names: Sequence[str] = CENSUS_COLUMNS) -> DataFrame:
    """CSV without header; names assigned afterwards (all strings, so no
    inference pass; cast downstream)."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("header", "false").option("ignoreLeadingWhiteSpace", "false").csv(path)


def read_header_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                    splittable: bool = True) -> DataFrame:
    """CSV with header; quoted fields may hold newlines.

    Files are read in splits (:func:`quire.sources.quoted_csv.read_quoted_csv`); ``splittable=False``
    reads each by one task, for files with stray quotes inside unquoted fields."""
    if splittable:
        df = read_quoted_csv(spark, path)
    else:
        df = (spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
              .csv(path))
    return df.select(*columns) if columns else df


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One sentence per line, with its line number (file order)."""
    lines = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id())
    return lines.select(F.col("value").alias("text"), "line_no")


# ------------------------------------------------------------------ S7
def report_lines(df: DataFrame, section_cols: Sequence[str], line_col: str, order_cols: Sequence[str],
                 titles: Mapping[str, Mapping] | None = None) -> DataFrame:
    """One ``line`` per row plus a header line whenever a section value
    starts, ordered by ``section_cols`` then ``order_cols``.

    Headers are ``"<title>:"`` lines; rows keep their order inside a
    section.  Sections are ordered by their values (the gram size 2, 3, 4),
    and ``titles[column][value]`` gives the text of the header where it
    differs from the value ("Two", "Three", "Four").  The result is ordered
    by (sort keys, kind) and can be written with ``write.text`` after
    ``coalesce(1)``/``orderBy`` by the caller."""
    out = None
    for depth, c in enumerate(section_cols):
        keys = list(section_cols[:depth + 1])
        title = F.col(c).cast("string")
        named = (titles or {}).get(c)
        if named:
            title = F.coalesce(F.create_map(*[F.lit(str(x)) for kv in named.items() for x in kv])[title], title)
        h = df.select(*keys).distinct().select(
            *keys, *[F.lit(None).cast(df.schema[k].dataType).alias(k) for k in section_cols[depth + 1:]],
            *[F.lit(None).alias(o) for o in order_cols],
            F.lit(depth).alias("__kind"), F.concat(title, F.lit(":")).alias("line"))
        out = h if out is None else out.unionByName(h, allowMissingColumns=True)
    body = df.select(*section_cols, *order_cols, F.lit(len(section_cols)).alias("__kind"),
                     F.col(line_col).cast("string").alias("line"))
    out = out.unionByName(body, allowMissingColumns=True) if out is not None else body
    return out


def write_report(df: DataFrame, path: str, section_cols: Sequence[str], line_col: str, order_cols: Sequence[str],
                 titles: Mapping[str, Mapping] | None = None) -> None:
    """Sectioned text report; its parts, in the order of their names, are the report.

    The lines are cut into even ranges of the report's order by Spark's range
    partitioner, a section's header being its first line, so a header may end one
    part and its lines begin the next; no task sorts or writes the whole.
    """
    r = report_lines(df, section_cols, line_col, order_cols, titles)
    sort = []
    for c in section_cols:
        sort += [F.col(c).asc_nulls_first()]
    sort += [F.col("__kind")] + [F.col(o).asc_nulls_first() for o in order_cols]
    r.orderBy(*sort).select("line").write.mode("overwrite").text(path)


# ------------------------------------------------------------------ S8
def _exists(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def cached_subset(spark: SparkSession, path: str, build) -> DataFrame:
    """Read the saved subset at ``path`` if it is there in full (its
    ``_SUCCESS`` mark), else build it (``build()`` -> DataFrame), save it as
    Parquet and read it back."""
    if not _exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# ------------------------------------------------------------------ S9
def read_labelled_tree(spark: SparkSession, root: str, by: str = "folder",
                       classes: Sequence[str] = WEATHER_CLASSES) -> DataFrame:
    """Image files -> (path, label) (the binary reader skips empty files).

    ``by='folder'``: the label is the parent folder (one of ``classes``;
    a missing class folder gives a warning and no rows).  ``by='prefix'``: the label is
    the class whose lower-cased name prefixes the lower-cased file name; an
    unknown prefix raises.  ``.jpg`` in any case is kept."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(root).select("path"))
    files = files.filter(F.lower(F.col("path")).endswith(".jpg"))
    name = F.element_at(F.split("path", "/"), -1)
    if by == "folder":
        for c in classes:
            if not _exists(spark, f"{root.rstrip('/')}/{c}"):
                warnings.warn(f"no folder of class {c!r} below {root}", stacklevel=2)
        parent = F.element_at(F.split("path", "/"), -2)
        idx = F.array_position(F.array(*[F.lit(c) for c in classes]), parent) - 1
        return files.select("path", idx.cast("int").alias("label")).filter(F.col("label") >= 0)
    if by == "prefix":
        lab = F.lit(None).cast("int")
        for i, c in reversed(list(enumerate(classes))):
            lab = F.when(F.lower(name).startswith(c.lower()), F.lit(i)).otherwise(lab)
        lab = F.coalesce(lab, F.raise_error(F.concat(F.lit("Unknown label in filename: "), name)).cast("int"))
        return files.select("path", lab.alias("label"))
    raise ValueError(f"unknown labelling {by!r}")


# ------------------------------------------------------------------ S10
def save_table(df: DataFrame, path: str) -> None:
    """Persist a fitted table model (counts, vocabulary, vectors)."""
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ------------------------------------------------------------------ S11
def read_vector_table(spark: SparkSession, path: str, id_col: str = "vec_id", vec_col: str = "embedding",
                      label_col: str = "label") -> DataFrame:
    """Labelled numeric vectors ``(id, features array<double>, label)``."""
    df = spark.read.parquet(path)
    return df.select(F.col(id_col).alias("id"),
                     F.transform(vec_col, lambda x: x.cast("double")).alias("features"),
                     F.col(label_col).alias("label"))
