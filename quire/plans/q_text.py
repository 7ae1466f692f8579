"""Text and corpus-ETL queries.

Fixtures: ``documents`` lines stand in for protocol paragraphs (Latin
script), ``conversations`` (role used as the speaker prefix) for speaker
turns, ``labels`` joined to ``documents`` for labelled reviews.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import corpus as C
from quire.operators import ngrams as N
from quire.operators.replace import replace_words
from quire.plans.common import (LATIN, SQL_DOC_SENTENCES, SQL_SENTENCE_RE, SQL_TOKEN_RE,
                                doc_sentences, sql_strip)
from quire.plans.registry import query
from quire.session import ensure_checkpoint_dir
from quire.sources.files import CORPUS_FIELDS, read_corpus_jsonl, write_corpus_jsonl
from quire.session import written
from quire.sources.tables import table

SEED = 42
# English stand-in for the number-word dictionary (the fixture has no numerals)
NUMBER_WORDS_EN = {"the": 1, "and": 2, "of": 30}
# word -> replacement pairs for the replacement query, in list order
REPLACEMENTS = [("the", "THE"), ("and", "AND"), ("of", "OF"), ("ing", "ING")]
# speaker aliases on documents.source
ALIASES = {"src1": "src0", "src2": "src0", "src0": "src0", "src4": "src3"}

# --- fixed values that must equal the reference: prompt templates ---------
PROMPT_TEMPLATES = [
    ("zero_shot", "Classify the sentiment of the following movie review as positive or negative: {review}"),
    ("few_shot", """
    Classify the sentiment of the following movie reviews as positive or negative:
    Review 1 (Positive): 'I absolutely loved this movie! It was heartwarming and thrilling.'
    Review 2 (Negative): 'This was a terrible movie. It was boring and too long.'
    Now classify the sentiment of this new review: {review}
    """),
    ("instruction", """
    You are a sentiment analysis model. Your task is to determine whether a given movie review expresses a positive or negative sentiment.
    Please read the following review and classify its sentiment as either 'positive' or 'negative': {review}
    """),
]
# ---------------------------------------------------------------------------


def _q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _docs(spark, sf_dir, spread=True) -> DataFrame:
    return table(spark, sf_dir, "documents", spread=spread)


def _doc_lines(spark, sf_dir) -> DataFrame:
    return C.paragraphs_from_text(_docs(spark, sf_dir).select("doc_id", "text"))


SQL_LINES = """
doc_lines AS (
  SELECT doc_id, u.line, u.i - 1 AS para_no
  FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(line, i)
)"""


def _sql_sid(prefix: str = "") -> str:
    return f"concat_ws('-', {prefix}doc_id, {prefix}para_no, {prefix}sent_no)"


# ----------------------------------------------------------- T1 / T2 / T3
@query("split_sentences", f"""
WITH {SQL_LINES}
SELECT doc_id, CAST(para_no AS BIGINT) AS para_no, CAST(u.i - 1 AS BIGINT) AS sent_no,
       {sql_strip('u.s')} AS sentence
FROM doc_lines, unnest(regexp_extract_all(line, '{SQL_SENTENCE_RE}', 0)) WITH ORDINALITY AS u(s, i)
""")
def q_split_sentences(spark, sf_dir):
    """Every line of every document cut into sentences."""
    lines = _doc_lines(spark, sf_dir)
    return lines.select("doc_id", F.col("para_no").cast("bigint").alias("para_no"),
                        F.posexplode(T.split_sentences("text")).alias("sent_no", "sentence")) \
        .select("doc_id", "para_no", F.col("sent_no").cast("bigint").alias("sent_no"), "sentence")


@query("valid_sentences", f"""
WITH {SQL_LINES},
s AS (SELECT doc_id, para_no, u.i - 1 AS sent_no, {sql_strip('u.s')} AS sentence
      FROM doc_lines, unnest(regexp_extract_all(line, '{SQL_SENTENCE_RE}', 0)) WITH ORDINALITY AS u(s, i))
SELECT doc_id, CAST(para_no AS BIGINT) AS para_no, CAST(sent_no AS BIGINT) AS sent_no FROM s
WHERE regexp_matches(sentence, '[\\p{{L}}]')
  AND NOT (regexp_matches(sentence, '\\S') AND NOT regexp_matches(sentence, '[\\p{{L}}\\p{{N}}_\\p{{L}}]'))
  AND NOT contains(sentence, '...') AND NOT contains(sentence, '---')
""")
def q_valid_sentences(spark, sf_dir):
    """Keys of the sentences that pass the validity rules (Latin script)."""
    s = q_split_sentences(spark, sf_dir)
    return s.filter(T.valid_sentence("sentence", LATIN)).select("doc_id", "para_no", "sent_no")


@query("tokenize", f"""
WITH {SQL_DOC_SENTENCES}
SELECT {_sql_sid()} AS sid, CAST(len(tokens) AS BIGINT) AS n_tokens, sentence_text FROM sentences
""")
def q_tokenize(spark, sf_dir):
    """T3 (+ P11 >= 4 tokens): regex tokens of every valid sentence."""
    s = doc_sentences(spark, sf_dir)
    return s.select(F.concat_ws("-", "doc_id", "para_no", "sent_no").alias("sid"),
                    F.size("tokens").cast("bigint").alias("n_tokens"), "sentence_text")


@query("min_token_filter", f"""
WITH {SQL_DOC_SENTENCES}
SELECT {_sql_sid()} AS sid FROM sentences
WHERE len(list_filter(string_split_regex(sentence_text, '\\s+'), lambda t: t <> '')) >= 5
""")
def q_min_token_filter(spark, sf_dir):
    """Sentences with at least 5 blank-separated tokens."""
    s = doc_sentences(spark, sf_dir)
    return s.filter(T.whitespace_token_count("sentence_text") >= 5) \
        .select(F.concat_ws("-", "doc_id", "para_no", "sent_no").alias("sid"))


@query("tokenize_words", f"""
WITH {SQL_DOC_SENTENCES},
w AS (SELECT {_sql_sid()} AS sid,
             list_filter(list_transform(
               regexp_extract_all(sentence_text, '"[^"]+"|[\\p{{L}}]+"[\\p{{L}}]+|[\\p{{L}}]+''[\\p{{L}}]+|[\\p{{L}}]+', 0),
               lambda t: regexp_replace(t, '^"+|"+$', '', 'g')), lambda t: length(t) > 1) AS words
      FROM sentences)
SELECT sid, CAST(len(words) AS BIGINT) AS n_words, array_to_string(words, ' ') AS words FROM w
""")
def q_tokenize_words(spark, sf_dir):
    """T4: word tokens (quoted spans, inner quotes) of every sentence."""
    s = doc_sentences(spark, sf_dir)
    w = T.tokenize_words("sentence_text", LATIN)
    return s.select(F.concat_ws("-", "doc_id", "para_no", "sent_no").alias("sid"),
                    F.size(w).cast("bigint").alias("n_words"), F.array_join(w, " ").alias("words"))


@query("tokenize_script_only", f"""
WITH {SQL_DOC_SENTENCES},
w AS (SELECT {_sql_sid()} AS sid,
             list_filter(list_transform(list_filter(string_split_regex(sentence_text, '\\s+'), lambda t: t <> ''),
                         lambda t: regexp_replace(t, '[^\\p{{L}}]', '', 'g')), lambda t: length(t) > 1) AS words
      FROM sentences)
SELECT sid, array_to_string(words, ' ') AS words FROM w WHERE len(words) > 0
""")
def q_tokenize_script_only(spark, sf_dir):
    """T5: blank tokens reduced to script letters, length > 1; empty sentences dropped."""
    s = doc_sentences(spark, sf_dir)
    w = T.tokenize_script_only("sentence_text", LATIN)
    return s.select(F.concat_ws("-", "doc_id", "para_no", "sent_no").alias("sid"), w.alias("w")) \
        .filter(F.size("w") > 0).select("sid", F.array_join("w", " ").alias("words"))


# ------------------------------------------------------ speakers
def _sql_speaker(t: str) -> str:
    raw = f"regexp_extract({t}, '^([\\p{{L}}\\s()\"''`]+):', 1)"
    clean = (f"regexp_replace(regexp_replace({sql_strip(raw)}, '\\s*\\(.*?\\)', '', 'g'), "
             "'[\"'']', '', 'g')")
    kw = " OR ".join(f"contains({clean}, {_q(k)})" for k in T.TITLE_KEYWORDS)
    return (f"CASE WHEN {raw} <> '' AND (({kw}) OR regexp_full_match({clean}, '[\\p{{L}}\\s]+')) "
            f"THEN {clean} ELSE 'Unknown Speaker' END")


def _sql_spoken(t: str) -> str:
    return sql_strip(f"substr({t}, length(regexp_extract({t}, '^[\\p{{L}}\\s()\"''`]+:', 0)) + 1)")


def _conv(spark, sf_dir, every: int | None) -> DataFrame:
    c = table(spark, sf_dir, "conversations", spread=True)
    pref = F.concat(F.col("role"), F.lit(": "), F.col("text"))
    txt = pref if every is None else F.when(F.col("turn") % every == 0, pref).otherwise(F.col("text"))
    return c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("para_no"), txt.alias("text"))


@query("extract_speaker", f"""
SELECT conv_id, turn, {_sql_speaker("(role || ': ' || text)")} AS speaker FROM conversations
""")
def q_extract_speaker(spark, sf_dir):
    """Speaker name from a 'Name:' prefix (role used as the prefix)."""
    c = _conv(spark, sf_dir, None)
    return c.select(F.col("doc_id").alias("conv_id"), F.col("para_no").alias("turn"),
                    T.extract_speaker("text", LATIN).alias("speaker"))


@query("spoken_text", f"""
SELECT conv_id, turn, {_sql_spoken("(role || ': ' || text)")} AS spoken FROM conversations
WHERE {_sql_speaker("(role || ': ' || text)")} <> 'Unknown Speaker'
""")
def q_spoken_text(spark, sf_dir):
    """The text after a valid speaker prefix."""
    c = _conv(spark, sf_dir, None)
    spk = T.extract_speaker("text", LATIN)
    return c.filter(spk != "Unknown Speaker").select(
        F.col("doc_id").alias("conv_id"), F.col("para_no").alias("turn"),
        T.spoken_text("text", spk, LATIN).alias("spoken"))


SQL_CONV3 = f"""
conv3 AS (
  SELECT conv_id, turn, {sql_strip("CASE WHEN turn % 3 = 0 THEN role || ': ' || text ELSE text END")} AS t
  FROM conversations
),
own AS (
  SELECT conv_id, turn, t, CASE WHEN {_sql_speaker('t')} <> 'Unknown Speaker' THEN {_sql_speaker('t')} END AS own
  FROM conv3 WHERE t <> ''
),
carried AS (
  SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS speaker_name
  FROM own
)"""


@query("carry_speaker_forward", f"""
WITH {SQL_CONV3}
SELECT conv_id, turn, speaker_name FROM carried WHERE speaker_name IS NOT NULL
""")
def q_carry_speaker_forward(spark, sf_dir):
    """Unprefixed turns belong to the last speaker; turns before the first are dropped."""
    c = _conv(spark, sf_dir, 3).withColumn("text", T.strip("text")).filter(F.col("text") != "")
    spk = T.extract_speaker("text", LATIN)
    c = c.withColumn("own", F.when(spk != "Unknown Speaker", spk))
    r = C.carry_forward(c, "doc_id", "para_no", "own", "speaker_name")
    return r.filter(F.col("speaker_name").isNotNull()).select(
        F.col("doc_id").alias("conv_id"), F.col("para_no").alias("turn"), "speaker_name")


SQL_CORPUS = f"""
{SQL_CONV3},
body AS (
  SELECT conv_id, turn, speaker_name, CASE WHEN own IS NOT NULL THEN {_sql_spoken('t')} ELSE t END AS body
  FROM carried WHERE speaker_name IS NOT NULL
),
bs AS (
  SELECT conv_id, turn, speaker_name, u.i - 1 AS sent_no, {sql_strip('u.s')} AS sentence
  FROM body, unnest(regexp_extract_all(body, '{SQL_SENTENCE_RE}', 0)) WITH ORDINALITY AS u(s, i)
),
bt AS (
  SELECT conv_id, turn, speaker_name, sent_no,
         regexp_extract_all(sentence, '{SQL_TOKEN_RE}', 0) AS tokens
  FROM bs
  WHERE regexp_matches(sentence, '[\\p{{L}}]')
    AND NOT (regexp_matches(sentence, '\\S') AND NOT regexp_matches(sentence, '[\\p{{L}}\\p{{N}}_\\p{{L}}]'))
    AND NOT contains(sentence, '...') AND NOT contains(sentence, '---')
),
corpus AS (
  SELECT conv_id, turn, sent_no, speaker_name, array_to_string(tokens, ' ') AS sentence_text,
         len(tokens) AS n_tokens
  FROM bt WHERE len(tokens) >= 4
)"""


def corpus_from_conversations(spark, sf_dir) -> DataFrame:
    paras = _conv(spark, sf_dir, 3)
    return C.build_corpus(paras, LATIN)


@query("build_corpus", f"""
WITH {SQL_CORPUS}
SELECT conv_id, turn, CAST(sent_no AS BIGINT) AS sent_no, speaker_name, sentence_text FROM corpus
""")
def q_build_corpus(spark, sf_dir):
    """Turns -> speakers (carried forward) -> sentences -> tokens (>= 4)."""
    c = corpus_from_conversations(spark, sf_dir)
    return c.select(F.col("doc_id").alias("conv_id"), F.col("para_no").alias("turn"),
                    F.col("sent_no").cast("bigint").alias("sent_no"), "speaker_name", "sentence_text")


@query("corpus_token_count", f"""
WITH {SQL_CORPUS}
SELECT CAST(coalesce(sum(n_tokens), 0) AS BIGINT) AS tokens_count FROM corpus
""")
def q_corpus_token_count(spark, sf_dir):
    """Total tokens kept by the corpus build."""
    return C.corpus_token_count(corpus_from_conversations(spark, sf_dir))


def _protocol_paragraphs(spark, sf_dir) -> DataFrame:
    """Conversations as protocol files: names with varying numbers and types, a heading (a number, a number in words, words
    that are no number, or none), the turns, and a closing line with another number."""
    c = table(spark, sf_dir, "conversations", spread=True).select("conv_id", "turn", "role", "text")
    kind = F.when(F.col("conv_id") % 3 == 0, "_ptm_").when(F.col("conv_id") % 3 == 1, "_ptv_").otherwise("_x_")
    name = F.concat((F.col("conv_id") % 25).cast("string"), kind, F.col("conv_id").cast("string"), F.lit(".docx"))
    turns = c.select(name.alias("file_name"), (F.col("turn") + 1).cast("int").alias("para_no"),
                     F.when(F.col("turn") % 3 == 0, F.concat("role", F.lit(": "), "text")).otherwise(F.col("text")).alias("text"))
    heading = (F.when(F.col("conv_id") % 4 == 0, F.concat(F.lit("פרוטוקול מס' "), (F.col("conv_id") * 3).cast("string")))
               .when(F.col("conv_id") % 4 == 1, "הישיבה עשרים").when(F.col("conv_id") % 4 == 2, "הישיבה של היום").otherwise(""))
    edges = F.array(F.struct(F.lit(0).alias("para_no"), heading.alias("text")), F.struct(F.lit(100000).alias("para_no"), F.lit("פרוטוקול מס' 999").alias("text")))
    files = c.select("conv_id").distinct().select(name.alias("file_name"), F.explode(edges).alias("e")).select("file_name", "e.para_no", "e.text")
    return turns.unionByName(files)


SQL_RECORDS = f"""
named AS (
  SELECT *, (conv_id % 25) || CASE conv_id % 3 WHEN 0 THEN '_ptm_' WHEN 1 THEN '_ptv_' ELSE '_x_' END || conv_id || '.docx' AS file_name
  FROM conversations
),
paras AS (
  SELECT file_name, turn + 1 AS para_no, CASE WHEN turn % 3 = 0 THEN role || ': ' || text ELSE text END AS text FROM named
  UNION ALL SELECT file_name, 0, CASE conv_id % 4 WHEN 0 THEN 'פרוטוקול מס'' ' || conv_id * 3 WHEN 1 THEN 'הישיבה עשרים' WHEN 2 THEN 'הישיבה של היום' ELSE '' END
  FROM (SELECT DISTINCT file_name, conv_id FROM named)
  UNION ALL SELECT DISTINCT file_name, 100000, 'פרוטוקול מס'' 999' FROM named
),
numbered AS (
  SELECT file_name, para_no, CASE WHEN regexp_matches(text, 'פרוטוקול מס''? (\\d+)') THEN CAST(regexp_extract(text, 'פרוטוקול מס''? (\\d+)', 1) AS BIGINT)
         WHEN regexp_extract(text, 'הישיבה\\s([\\x{{0590}}-\\x{{05FF}}\\-]+)', 1) <> ''
         THEN CASE regexp_extract(text, 'הישיבה\\s([\\x{{0590}}-\\x{{05FF}}\\-]+)', 1) WHEN 'עשרים' THEN 20 ELSE 0 END END AS v FROM paras
),
numbers AS (SELECT file_name, coalesce(nullif(arg_min(v, para_no), 0), -1) AS protocol_number FROM numbered GROUP BY file_name),
{SQL_CORPUS.replace(SQL_CONV3[:SQL_CONV3.index("own AS (")], f"conv3 AS (SELECT file_name, para_no, {sql_strip('text')} AS t FROM paras)," + chr(10))
 .replace("conv_id", "file_name").replace("turn", "para_no")}"""


@query("corpus_records", f"""
WITH {SQL_RECORDS}
SELECT file_name AS protocol_name, CASE WHEN regexp_matches(file_name, '\\d+_pt') THEN CAST(regexp_extract(file_name, '(\\d+)_pt', 1) AS BIGINT) ELSE -1 END AS knesset_number,
       CASE WHEN contains(file_name, 'ptm') THEN 'plenary' WHEN contains(file_name, 'ptv') THEN 'committee' ELSE 'undefined' END AS protocol_type,
       CAST(protocol_number AS BIGINT) AS protocol_number, speaker_name, sentence_text
FROM corpus JOIN numbers USING (file_name)
""")
def q_corpus_records(spark, sf_dir):
    """T11 with P12, T9, S2 and S1: protocol files to six-field records, written as JSON lines and read again."""
    records = C.build_records(_protocol_paragraphs(spark, sf_dir), LATIN)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/records-{uuid.uuid4().hex}"
    write_corpus_jsonl(records.select(*CORPUS_FIELDS), path)
    return read_corpus_jsonl(spark, path)


# ------------------------------------------------------------- T9 / T10
@query("first_protocol_number", f"""
WITH {SQL_LINES},
m AS (SELECT doc_id, para_no, TRY_CAST(regexp_extract(line, '(\\d+)', 1) AS BIGINT) AS v
      FROM doc_lines WHERE regexp_matches(line, '(\\d+)')),
f AS (SELECT doc_id, arg_min(v, para_no) AS v FROM m WHERE v IS NOT NULL GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(nullif(f.v, 0), -1) AS BIGINT) AS protocol_number
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN f USING (doc_id)
""")
def q_first_protocol_number(spark, sf_dir):
    """The first line holding a number gives the document number; none or 0 -> -1."""
    lines = _doc_lines(spark, sf_dir)
    v = F.regexp_extract("text", r"(\d+)", 1)
    p = lines.withColumn("pnum", F.when(F.col("text").rlike(r"(\d+)"), v.try_cast("bigint")))
    return C.first_protocol_number(p)


@query("number_words_to_int", f"""
WITH {SQL_LINES},
w AS (SELECT doc_id, para_no, string_split_regex({sql_strip('line')}, '[-\\s]') AS ws FROM doc_lines)
SELECT doc_id, CAST(para_no AS BIGINT) AS para_no,
       CAST(list_sum(list_transform(ws, lambda x: CASE x {' '.join(f"WHEN {_q(k)} THEN {v}" for k, v in NUMBER_WORDS_EN.items())} ELSE 0 END)) AS BIGINT) AS value,
       CAST(len(list_filter(ws, lambda x: x <> '' AND x NOT IN ({', '.join(_q(k) for k in NUMBER_WORDS_EN)}))) AS BIGINT) AS n_unknown
FROM w
""")
def q_number_words_to_int(spark, sf_dir):
    """Number phrase -> sum of word values (English stand-in dictionary), plus unknown words."""
    lines = _doc_lines(spark, sf_dir)
    return lines.select("doc_id", F.col("para_no").cast("bigint").alias("para_no"),
                        C.number_words_value("text", NUMBER_WORDS_EN, None, None).alias("value"),
                        F.size(C.number_words_unknown("text", NUMBER_WORDS_EN, None, None))
                        .cast("bigint").alias("n_unknown"))


# --------------------------------------------------------- lyrics
def _sql_clean(t: str) -> str:
    x = f"lower({t})"
    for a in T.LYRIC_ARTEFACTS:
        x = f"replace({x}, {_q(a)}, '')"
    x = f"regexp_replace({x}, '[^a-z\\s]', '', 'g')"
    return sql_strip(f"regexp_replace({x}, '\\s+', ' ', 'g')")


@query("clean_text", f"""
SELECT doc_id, {_sql_clean('text')} AS cleaned FROM documents
""")
def q_clean_text(spark, sf_dir):
    """Lower-case, drop artefacts, keep a-z and blanks, squeeze blanks."""
    return _docs(spark, sf_dir).select("doc_id", T.clean_lyrics("text").alias("cleaned"))


SQL_VOCAB = f"""
cleaned AS (SELECT doc_id, {_sql_clean('text')} AS c FROM documents),
chars AS (SELECT DISTINCT u.ch FROM cleaned, unnest(list_distinct(string_split(c, ''))) AS u(ch) WHERE u.ch <> ''),
vocab AS (SELECT ch, row_number() OVER (ORDER BY ch) AS idx FROM chars),
vlist AS (SELECT list(ch ORDER BY ch) AS l FROM chars),
codes AS (
  SELECT doc_id, list_filter(list_transform(string_split(c, ''), lambda x: list_position(vlist.l, x)),
                             lambda x: x IS NOT NULL) AS codes
  FROM cleaned, vlist
)"""


def char_vocabulary(cleaned: DataFrame) -> DataFrame:
    """Sorted distinct characters, index from 1 (0 is padding).

    The set of distinct characters is tiny, so the unpartitioned window
    runs over a bounded table."""
    chars = (cleaned.select(F.explode(F.array_distinct(F.split("cleaned", ""))).alias("ch"))
             .filter(F.col("ch") != "").distinct())
    return chars.select("ch", F.row_number().over(Window.orderBy("ch")).cast("bigint").alias("idx"))


def encode_text(cleaned: DataFrame, vocab: DataFrame, unknown_as_zero: bool = False) -> DataFrame:
    """Characters -> vocabulary indexes.

    A character vocabulary is bounded by the character set (27 entries after
    cleaning); it is one map from a scalar subquery, so the text is encoded
    in place without exploding it into one row per character, and nothing
    passes through the driver while the query is planned."""
    m = vocab.select(F.map_from_entries(F.collect_list(F.struct("ch", "idx")))).scalar()
    rows = cleaned.select("doc_id", "cleaned", m.alias("__codes"))
    codes = F.transform(F.split("cleaned", ""), lambda c: F.col("__codes")[c])
    codes = F.transform(codes, lambda x: F.coalesce(x, F.lit(0))) if unknown_as_zero \
        else F.filter(codes, lambda x: x.isNotNull())
    return rows.select("doc_id", codes.alias("codes"))


def _codes(spark, sf_dir) -> DataFrame:
    cleaned = _docs(spark, sf_dir).select("doc_id", T.clean_lyrics("text").alias("cleaned"))
    return encode_text(cleaned, char_vocabulary(cleaned))


@query("char_vocabulary", f"""
WITH {SQL_VOCAB}
SELECT ch, CAST(idx AS BIGINT) AS idx FROM vocab
""")
def q_char_vocabulary(spark, sf_dir):
    """Character vocabulary of the cleaned corpus."""
    cleaned = _docs(spark, sf_dir).select("doc_id", T.clean_lyrics("text").alias("cleaned"))
    return char_vocabulary(cleaned)


@query("encode_text", f"""
WITH {SQL_VOCAB}
SELECT doc_id, CAST(len(codes) AS BIGINT) AS n_codes, array_to_string(codes, ',') AS codes FROM codes
""")
def q_encode_text(spark, sf_dir):
    """Every cleaned text as vocabulary indexes."""
    c = _codes(spark, sf_dir)
    return c.select("doc_id", F.size("codes").cast("bigint").alias("n_codes"),
                    F.array_join("codes", ",").alias("codes"))


@query("shift_pairs", f"""
WITH {SQL_VOCAB}
SELECT doc_id, array_to_string(codes[1:len(codes) - 1], ',') AS input_seq,
       array_to_string(codes[2:len(codes)], ',') AS target_seq
FROM codes WHERE len(codes) >= 2
""")
def q_shift_pairs(spark, sf_dir):
    """(all but last, all but first) of every sequence of length >= 2."""
    c = _codes(spark, sf_dir).filter(F.size("codes") >= 2)
    n = F.size("codes")
    return c.select("doc_id", F.array_join(F.slice("codes", 1, n - 1), ",").alias("input_seq"),
                    F.array_join(F.slice("codes", 2, n - 1), ",").alias("target_seq"))


@query("pad_to_longest", f"""
WITH {SQL_VOCAB},
p AS (SELECT doc_id, codes[1:len(codes) - 1] AS x FROM codes WHERE len(codes) >= 2)
SELECT doc_id, CAST((SELECT max(len(x)) FROM p) AS BIGINT) AS padded_len,
       CAST((SELECT max(len(x)) FROM p) - len(x) AS BIGINT) AS pad_count FROM p
""")
def q_pad_to_longest(spark, sf_dir):
    """Right-pad the input and target sequences with 0 to the longest (length as a scalar subquery); the lengths are those of
    the padded table."""
    padded = pad_to_longest(_codes(spark, sf_dir).filter(F.size("codes") >= 2))
    return padded.select("doc_id", "padded_len", "pad_count")


def pad_to_longest(encoded: DataFrame) -> DataFrame:
    """T23 operator: ``encoded(doc_id, codes)`` -> (doc_id, padded_len, pad_count, input_seq, target_seq), all input and target
    sequences of one length, written as a table.

    The zeros are appended as text, so no array of the longest length is built per row; Zstandard leaves next to nothing of them."""
    # written once: the longest and each use of a sequence would else clean and encode its text anew
    c = written(encoded)
    n = F.size("codes") - 1
    longest = c.select(F.max(n)).scalar()
    sequence = lambda first: F.array_join(F.slice("codes", first, n), ",")
    c = c.select("doc_id", n.alias("n"), sequence(1).alias("x"), sequence(2).alias("y"), F.repeat(F.lit(",0"), longest - n).alias("zeros"))
    c = c.select("doc_id", "n", F.octet_length("zeros").alias("more"), F.concat("x", "zeros").alias("input_seq"), F.concat("y", "zeros").alias("target_seq"))
    count = (F.col("more") / 2).cast("bigint")
    return written(c.select("doc_id", (F.col("n") + count).alias("padded_len"), count.alias("pad_count"), "input_seq", "target_seq"))


# ------------------------------------------------------------ T14-T19, T25
SQL_MASKED = f"""
{SQL_DOC_SENTENCES},
m AS (
  SELECT {_sql_sid()} AS sid, tokens,
         greatest(1, CAST(floor(len(tokens) * 10 / 100) AS INTEGER)) AS k
  FROM sentences WHERE len(tokens) >= 5
),
h AS (SELECT sid, tokens, k,
             list_transform(tokens, lambda t, i: md5('{SEED}-' || sid || '-' || CAST(i - 1 AS VARCHAR))) AS hs
      FROM m),
masked AS (
  SELECT sid, tokens, list_transform(list_zip(tokens, hs),
           lambda z: CASE WHEN z[2] <= list_sort(hs)[k] THEN '[*]' ELSE z[1] END) AS mt
  FROM h
)"""


def _masked(spark, sf_dir) -> DataFrame:
    s = doc_sentences(spark, sf_dir).filter(F.size("tokens") >= 5)
    s = s.select(F.concat_ws("-", "doc_id", "para_no", "sent_no").alias("sid"), "tokens")
    return N.mask_sentences(s, "tokens", "sid", SEED, 10, out_col="mt")


@query("mask_marker_rewrite", f"""
WITH {SQL_MASKED}
SELECT sid, replace(array_to_string(mt, ' '), '[*]', '[MASK]') AS rewritten FROM masked
""")
def q_mask_marker_rewrite(spark, sf_dir):
    """Change the mask marker of every masked sentence."""
    m = _masked(spark, sf_dir)
    return m.select("sid", T.rewrite_marker(F.array_join("mt", " "), "[*]", "[MASK]").alias("rewritten"))


@query("fill_markers", f"""
WITH {SQL_MASKED}
SELECT sid, array_to_string(tokens, ' ') AS filled FROM masked
""")
def q_fill_markers(spark, sf_dir):
    """Fill the markers left to right with the masked-out tokens (round trip)."""
    m = _masked(spark, sf_dir)
    preds = F.filter(F.transform(F.arrays_zip(F.col("mt").alias("m"), F.col("tokens").alias("t")),
                                 lambda z: F.when(z["m"] == "[*]", z["t"])), lambda x: x.isNotNull())
    return m.select("sid", T.fill_markers(F.array_join("mt", " "), preds).alias("filled"))


def _sql_replace(t: str) -> tuple[str, str]:
    run = t
    pairs = []
    for w, new in REPLACEMENTS:
        run = f"CASE WHEN contains({t}, {_q(w)}) THEN replace({run}, {_q(w)}, {_q(new)}) ELSE {run} END"
        pairs.append(f"CASE WHEN contains({t}, {_q(w)}) THEN {_q(f'({w}:{new})')} END")
    return run, f"concat_ws(', ', {', '.join(pairs)})"


@query("replace_words", f"""
WITH {SQL_DOC_SENTENCES}
SELECT {_sql_sid()} AS sid, {_sql_replace('sentence_text')[0]} AS replaced,
       {_sql_replace('sentence_text')[1]} AS pairs
FROM sentences
""")
def q_replace_words(spark, sf_dir):
    """Listed words found as substrings are replaced in list order; pairs reported."""
    s = doc_sentences(spark, sf_dir).select(F.concat_ws("-", "doc_id", "para_no", "sent_no").alias("sid"), "sentence_text")
    listed = spark.createDataFrame([(i, w, new) for i, (w, new) in enumerate(REPLACEMENTS)], "pos int, word string, new string")
    return replace_words(s, listed, "sentence_text").select("sid", "replaced", "pairs")


def render_prompts(reviews: DataFrame, text_col: str = "text") -> DataFrame:
    """Every review in every template (templates are a fixed 3-element
    literal array, exploded in place -- no join)."""
    tpl = F.array(*[F.struct(F.lit(k).alias("strategy"), F.lit(v).alias("template"))
                    for k, v in PROMPT_TEMPLATES])
    r = reviews.select("*", F.explode(tpl).alias("t"))
    return r.select("*", F.col("t.strategy").alias("strategy"),
                    F.replace(F.col("t.template"), F.lit("{review}"), F.col(text_col)).alias("prompt")).drop("t")


@query("render_prompts", f"""
SELECT d.doc_id, t.strategy, replace(t.template, '{{review}}', d.text) AS prompt
FROM documents d JOIN labels l USING (doc_id),
     (VALUES {', '.join(f'({_q(k)}, {_q(v)})' for k, v in PROMPT_TEMPLATES)}) t(strategy, template)
""")
def q_render_prompts(spark, sf_dir):
    """Three prompts (zero-shot, few-shot, instruction) per labelled review."""
    d = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    return render_prompts(d).select("doc_id", "strategy", "prompt")


def stand_in_answer(prompt: str) -> Column:
    """What a stand-in for a language model says to a prompt, by the share of its letters that are an 'e'."""
    n_e = F.length(prompt) - F.length(F.replace(F.col(prompt), F.lit("e"), F.lit("")))
    return F.when(n_e * 12 >= F.length(prompt), F.lit("I find this review POSITIVE.")).otherwise(F.lit("It reads as a negative one."))


SQL_ANSWERS = f"""
prompts AS (
  SELECT d.doc_id, t.strategy, replace(t.template, '{{review}}', d.text) AS prompt, l.quality
  FROM documents d JOIN labels l USING (doc_id),
       (VALUES {', '.join(f'({_q(k)}, {_q(v)})' for k, v in PROMPT_TEMPLATES)}) t(strategy, template)
),
answers AS (
  SELECT doc_id, strategy, quality,
         CASE WHEN (length(prompt) - length(replace(prompt, 'e', ''))) * 12 >= length(prompt) THEN 'I find this review POSITIVE.'
              ELSE 'It reads as a negative one.' END AS answer
  FROM prompts
)"""


def prompt_answers(spark, sf_dir) -> DataFrame:
    """(doc_id, strategy, quality, answer) of every prompt of every labelled review."""
    d = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return render_prompts(d).select("doc_id", "strategy", "quality", stand_in_answer("prompt").alias("answer"))


@query("parse_response_label", f"""
WITH {SQL_ANSWERS}
SELECT doc_id, strategy, answer, CASE WHEN contains(lower(answer), 'positive') THEN 'Positive' ELSE 'Negative' END AS label
FROM answers
""")
def q_parse_response_label(spark, sf_dir):
    """Free-text answer to every prompt -> Positive / Negative."""
    return prompt_answers(spark, sf_dir).select("doc_id", "strategy", "answer", T.response_label("answer").alias("label"))


@query("punctuation_features", f"""
WITH {SQL_DOC_SENTENCES}
SELECT {_sql_sid()} AS sid,
       CAST(len(list_filter(string_split_regex(sentence_text, '\\s+'), lambda t: t <> '')) AS BIGINT) AS sentence_length,
       CAST(len(regexp_extract_all(sentence_text, ',', 0)) AS BIGINT) AS commas,
       CAST(len(regexp_extract_all(sentence_text, '\\.', 0)) AS BIGINT) AS period,
       CAST(len(regexp_extract_all(sentence_text, '"', 0)) + len(regexp_extract_all(sentence_text, '''', 0)) AS BIGINT) AS quotations,
       CAST(len(regexp_extract_all(sentence_text, '-', 0)) AS BIGINT) AS dashes,
       CAST(len(regexp_extract_all(sentence_text, '\\?', 0)) AS BIGINT) AS question
FROM sentences
""")
def q_punctuation_features(spark, sf_dir):
    """Word count and punctuation counts per sentence."""
    s = doc_sentences(spark, sf_dir)
    f = T.punctuation_features("sentence_text")
    return s.select(F.concat_ws("-", "doc_id", "para_no", "sent_no").alias("sid"),
                    *[v.alias(k) for k, v in f.items()])


# ------------------------------------------------------------- P12 / P13
@query("file_name_fields", """
WITH f AS (
  SELECT page_id, CASE page_id % 4 WHEN 0 THEN regexp_extract(url, '[^/]*$', 0)
         ELSE (page_id % 25) || CASE page_id % 4 WHEN 1 THEN '_ptm_' WHEN 2 THEN '_ptv_' ELSE '_pt_' END || regexp_extract(url, '[^/]*$', 0)
         END AS file_name
  FROM pages
)
SELECT page_id, file_name,
       CASE WHEN regexp_extract(file_name, '(\\d+)_pt', 1) = '' THEN -1
            ELSE CAST(regexp_extract(file_name, '(\\d+)_pt', 1) AS INTEGER) END AS knesset_number,
       CASE WHEN contains(file_name, 'ptm') THEN 'plenary' WHEN contains(file_name, 'ptv') THEN 'committee' ELSE 'undefined' END AS protocol_type
FROM f
""")
def q_file_name_fields(spark, sf_dir):
    """Number and type fields from file names: the last URL segment of every page, three quarters of them headed
    by a number and a type."""
    segment = F.regexp_extract("url", r"[^/]*$", 0)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("_ptm_", "_ptv_", "_pt_")]), F.greatest(F.col("page_id") % 4, F.lit(1)).cast("int"))
    named = F.concat((F.col("page_id") % 25).cast("string"), kind, segment)
    p = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 4 == 0, segment).otherwise(named).alias("file_name"))
    return p.select("page_id", "file_name", T.file_knesset_number("file_name").alias("knesset_number"),
                    T.file_protocol_type("file_name").alias("protocol_type"))


@query("alias_normalise", f"""
SELECT doc_id, source, CASE source {' '.join(f'WHEN {_q(k)} THEN {_q(v)}' for k, v in ALIASES.items())}
       ELSE source END AS canonical
FROM documents
""")
def q_alias_normalise(spark, sf_dir):
    """Several spellings -> one canonical name (literal map), default itself."""
    m = F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return d.select("doc_id", "source", F.coalesce(m[F.col("source")], F.col("source")).alias("canonical"))
