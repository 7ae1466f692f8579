"""Derived inputs shared by several query families (all lazy DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import corpus as C
from quire.sources.tables import table

LATIN = r"\p{L}"          # script class for the Latin-alphabet test corpora

# SQL fragments mirroring the Spark expressions (DuckDB / RE2 dialect)
SQL_SENTENCE_RE = r"\s*\S[\s\S]*?[.!?:]|\s*\S[\s\S]*$"
SQL_TOKEN_RE = (r"([\p{L}]+|[^\p{L}\p{N}_\p{L}\s]|[$₪€£]?\p{Nd}+(?:\.\p{Nd}+)?%?|https?://\S+|www\.\S+"
                r"|[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_]+\.[\p{L}\p{N}_]+|\([^()]*\)|[\p{L}]+(?:-[\p{L}]+)*"
                r"|\b(?:[\p{L}]\.){2,})")
SQL_STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def sql_strip(x: str) -> str:
    return SQL_STRIP.format(x=x)


def doc_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> lines -> sentences -> tokens (>= 4), Latin script.

    Columns: doc_id, lang, source, para_no, sent_no, sentence_text, tokens.
    """
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", "lang", "source", "text")
    paras = C.paragraphs_from_text(docs, keep=("lang", "source"))
    s = C.sentences_of(paras, "text", LATIN)
    return s.select("doc_id", "lang", "source", "para_no", "sent_no", "sentence_text", "tokens")


# DuckDB twin of doc_sentences (one row per kept sentence)
SQL_DOC_SENTENCES = f"""
doc_lines AS (
  SELECT doc_id, lang, source, u.line, u.i - 1 AS para_no
  FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(line, i)
),
doc_sents AS (
  SELECT doc_id, lang, source, para_no, u.i - 1 AS sent_no, {sql_strip('u.sentence')} AS sentence
  FROM doc_lines, unnest(regexp_extract_all(line, '{SQL_SENTENCE_RE}', 0)) WITH ORDINALITY AS u(sentence, i)
),
doc_tok AS (
  SELECT doc_id, lang, source, para_no, sent_no,
         regexp_extract_all(sentence, '{SQL_TOKEN_RE}', 0) AS tokens
  FROM doc_sents
  WHERE regexp_matches(sentence, '[\\p{{L}}]')
    AND NOT (regexp_matches(sentence, '\\S') AND NOT regexp_matches(sentence, '[\\p{{L}}\\p{{N}}_\\p{{L}}]'))
    AND NOT contains(sentence, '...') AND NOT contains(sentence, '---')
),
sentences AS (
  SELECT doc_id, lang, source, para_no, sent_no, tokens, array_to_string(tokens, ' ') AS sentence_text
  FROM doc_tok WHERE len(tokens) >= 4
)"""
