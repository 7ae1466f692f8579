"""Round trips through the file sources and sinks.

Each query writes a whole table in the format of its source into the shared
folder of the session and reads it with the operator, so its rows must be those
of the table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import ngrams as N
from quire.operators.ranking import range_rank
from quire.operators.sampling import sample_n
from quire.plans import q_tables  # noqa: F401 - registers shuffle_take
from quire.plans.q_lm import lm_sentences
from quire.plans.q_ngrams import SIZES, _sql_colloc, collocation_table
from quire.plans.registry import ORACLES, query
from quire.session import ensure_checkpoint_dir
from quire.sources import files as S
from quire.sources.tables import table

SEED = 42
CUSTOMER = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}
TITLES = {2: "Two", 3: "Three", 4: "Four"}


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("read_headerless_csv", f"SELECT {', '.join(CUSTOMER)} FROM customer")
def q_read_headerless_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 (with P9): customers as CSV without a header, read with names given afterwards and cast."""
    path = _folder(spark, "customer-csv")
    table(spark, sf_dir, "customer").select(*CUSTOMER).write.option("header", "false").csv(path)
    rows = S.read_headerless_csv(spark, path, list(CUSTOMER))
    return rows.select(*(F.col(c).cast(t).alias(c) for c, t in CUSTOMER.items()))


@query("read_header_csv", "SELECT doc_id, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents")
def q_read_header_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as CSV with a header; texts hold commas, quotes and line breaks, and are read in splits."""
    path = _folder(spark, "documents-csv")
    filled = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")]
    (table(spark, sf_dir, "documents").select("doc_id", *filled).write.option("header", "true").option("quoteAll", "true")
     .option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    rows = S.read_header_csv(spark, path, ["doc_id", "source", "text"])
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("source", "text")))


@query("read_text_lines", """
SELECT u.line AS text, count(*) AS n_lines FROM documents, unnest(string_split(text, chr(10))) AS u(line) GROUP BY u.line
""")
def q_read_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 (with A1): every line of every document in text files; how often each line was read."""
    path = _folder(spark, "lines")
    table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n", -1)).alias("value")).write.text(path)
    return S.read_text_lines(spark, path).groupBy("text").agg(F.count(F.lit(1)).alias("n_lines"))


@query("write_report", f"""
WITH top AS ({_sql_colloc('frequency')}),
lines AS (
  SELECT DISTINCT n, NULL AS lang, 0 AS kind, 0 AS rank, CASE n {' '.join(f"WHEN {n} THEN '{t}:'" for n, t in TITLES.items())} END AS line FROM top
  UNION ALL SELECT DISTINCT n, lang, 1, 0, lang || ':' FROM top
  UNION ALL SELECT n, lang, 2, rank, gram FROM top
)
SELECT CAST(row_number() OVER (ORDER BY n, lang NULLS FIRST, kind, rank) AS BIGINT) AS line_no, line FROM lines
""")
def q_write_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collocations as a report of sections (gram size, corpus), read again in the order of its files and lines."""
    path = _folder(spark, "report")
    S.write_report(collocation_table(spark, sf_dir, "frequency", SIZES), path, ["n", "lang"], "gram", ["rank"], {"n": TITLES})
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"),
                                         F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    return range_rank(lines, [F.col("file"), F.col("start"), F.col("at")], rank_col="line_no").select("line_no", "line")


@query("cached_subset", ORACLES["shuffle_take"])
def q_cached_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 (with R2): a subset of 500 that the first call builds and saves, and the second reads."""
    path = _folder(spark, "subset")
    S.cached_subset(spark, path, lambda: sample_n(table(spark, sf_dir, "documents").select("doc_id"), 500, ["doc_id"], SEED))

    def rebuild() -> DataFrame:
        raise RuntimeError("the saved subset was not found")
    return S.cached_subset(spark, path, rebuild)


@query("save_load_model", ORACLES["ngram_counts"])
def q_save_load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The n-gram model of every corpus (N3), saved and loaded."""
    path = _folder(spark, "model")
    S.save_table(N.ngram_counts(lm_sentences(spark, sf_dir)), path)
    return S.load_table(spark, path).select(F.col("corpus").alias("lang"), F.col("n").cast("bigint").alias("n"), "gram", "cnt")
