"""Corpus building (T8, T9, T10, T11, T12) from ordered paragraphs.

Input paragraphs are ``(doc_id, para_no, text)``.  The pipeline is one lazy
DataFrame chain: the only shuffles are the per-document first-match
aggregate (partial aggregation, skew-safe) and the carry-forward scan, which
is computed over fixed-size chunks of each document so that one huge
document never lands in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T

# --- fixed values that must equal the reference ---------------------------
# Hebrew number words and their values
HEBREW_NUMBER_WORDS = {
    "אחד": 1, "אחת": 1, "שניים": 2, "שתיים": 2, "שלושה": 3, "שלוש": 3, "ארבעה": 4, "ארבע": 4,
    "חמשה": 5, "חמש": 5, "ששה": 6, "שש": 6, "שבעה": 7, "שבע": 7, "שמונה": 8, "תשעה": 9, "תשע": 9,
    "עשרה": 10, "עשר": 10, "עשרים": 20, "שלושים": 30, "ארבעים": 40, "חמישים": 50,
    "שישים": 60, "שבעים": 70, "שמונים": 80, "תשעים": 90, "מאה": 100, "מאתיים": 200,
    "שלוש-מאות": 300, "ארבע-מאות": 400,
}
HEBREW_ARTICLE = "ה"                  # leading article dropped from a number phrase
HEBREW_CONNECTOR = "ו"                # conjunction letter turned into a blank
PROTOCOL_NUMBER_RE = r"פרוטוקול מס'? (\d+)"
SESSION_KEYWORD = "הישיבה"
SESSION_WORDS_RE = r"הישיבה\s([\x{0590}-\x{05FF}\-]+)"
MIN_TOKENS = 4
# ---------------------------------------------------------------------------


def paragraphs_from_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         keep: Sequence[str] = ()) -> DataFrame:
    """S3 stand-in for text tables: one paragraph per line, order kept."""
    return docs.select(F.col(id_col).alias("doc_id"), *keep,
                       F.posexplode(F.split(F.col(text_col), "\n")).alias("para_no", "text"))


def number_words_value(phrase, words: dict[str, int] | None = None,
                       article: str | None = HEBREW_ARTICLE,
                       connector: str | None = HEBREW_CONNECTOR) -> Column:
    """Sum of the dictionary values of a number phrase; unknown words are 0."""
    table = HEBREW_NUMBER_WORDS if words is None else words
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    s = T.strip(phrase if isinstance(phrase, Column) else F.col(phrase))
    if article:
        s = F.when(s.startswith(article), F.substring(s, len(article) + 1, 1 << 30)).otherwise(s)
    if connector:
        s = F.replace(F.replace(s, F.lit("-" + connector), F.lit(" ")), F.lit(connector), F.lit(" "))
    parts = F.split(s, r"[-\s]")
    return F.aggregate(parts, F.lit(0).cast("bigint"),
                       lambda acc, w: acc + F.coalesce(m[w], F.lit(0)).cast("bigint"))


def number_words_unknown(phrase, words: dict[str, int] | None = None,
                         article: str | None = HEBREW_ARTICLE,
                         connector: str | None = HEBREW_CONNECTOR) -> Column:
    """T10 second output: the non-empty words that are not in the dictionary."""
    table = HEBREW_NUMBER_WORDS if words is None else words
    keys = F.array(*[F.lit(k) for k in table])
    s = T.strip(phrase if isinstance(phrase, Column) else F.col(phrase))
    if article:
        s = F.when(s.startswith(article), F.substring(s, len(article) + 1, 1 << 30)).otherwise(s)
    if connector:
        s = F.replace(F.replace(s, F.lit("-" + connector), F.lit(" ")), F.lit(connector), F.lit(" "))
    return F.filter(F.split(s, r"[-\s]"), lambda w: (w != "") & ~F.array_contains(keys, w))


def paragraph_protocol_number(text, number_re: str = PROTOCOL_NUMBER_RE,
                              keyword: str = SESSION_KEYWORD, words_re: str = SESSION_WORDS_RE,
                              words: dict[str, int] | None = None) -> Column:
    """T9 per paragraph: the number this paragraph yields, or null."""
    t = text if isinstance(text, Column) else F.col(text)
    num = F.regexp_extract(t, number_re, 1)
    wtxt = F.regexp_extract(t, words_re, 1)
    return (F.when(num != "", num.cast("bigint"))
            .when(t.contains(keyword) & (wtxt != ""), number_words_value(wtxt, words)))


def first_protocol_number(paragraphs: DataFrame, value_col: str = "pnum") -> DataFrame:
    """First paragraph with a value gives the number; none or 0 -> -1.

    ``min_by`` is a partial aggregate, so a huge document is reduced map-side.
    """
    per_doc = (paragraphs.filter(F.col(value_col).isNotNull())
               .groupBy("doc_id").agg(F.min_by(value_col, "para_no").alias("v")))
    docs = paragraphs.select("doc_id").distinct()
    return (docs.join(per_doc, "doc_id", "left")
            .select("doc_id", F.coalesce(F.nullif(F.col("v"), F.lit(0)), F.lit(-1)).cast("bigint")
                    .alias("protocol_number")))


def carry_forward(df: DataFrame, part_col: str, order_col: str, value_col: str,
                  out_col: str, chunk_rows: int = 65536) -> DataFrame:
    """Last non-null ``value_col`` at or before each row, per ``part_col``.

    Segmented scan: rows are cut into chunks of ``chunk_rows`` consecutive
    order values; the scan runs inside each chunk, the last value of every
    chunk is carried across chunks on the small chunk table, then the two
    are combined.  No task ever holds more than one chunk.
    """
    chunk = F.floor(F.col(order_col) / chunk_rows).cast("bigint")
    d = df.withColumn("__chunk", chunk)
    w_in = (Window.partitionBy(part_col, "__chunk").orderBy(order_col)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("__in", F.last(value_col, ignorenulls=True).over(w_in))
    last_of_chunk = (d.filter(F.col(value_col).isNotNull())
                     .groupBy(part_col, "__chunk").agg(F.max_by(value_col, order_col).alias("__last")))
    chunks = d.select(part_col, "__chunk").distinct().join(last_of_chunk, [part_col, "__chunk"], "left")
    w_ch = (Window.partitionBy(part_col).orderBy("__chunk")
            .rowsBetween(Window.unboundedPreceding, -1))
    carry = chunks.select(part_col, "__chunk", F.last("__last", ignorenulls=True).over(w_ch).alias("__carry"))
    out = d.join(carry, [part_col, "__chunk"], "left")
    return out.withColumn(out_col, F.coalesce("__in", "__carry")).drop("__chunk", "__in", "__carry")


def sentences_of(df: DataFrame, text_col: str, script: str = T.HEBREW_BLOCK,
                 min_tokens: int = MIN_TOKENS) -> DataFrame:
    """T1 -> T2 -> T3 -> keep >= ``min_tokens`` tokens.

    Adds ``sent_no`` (0-based), ``sentence``, ``tokens`` and ``sentence_text``.
    """
    # Tokens are built inside the generator so that the size filter cannot be
    # pushed below it and re-run the tokenizer regex a second time.
    per_sentence = F.transform(T.split_sentences(F.col(text_col)),
                               lambda x: F.struct(x.alias("sentence"), T.tokenize(x, script).alias("tokens")))
    s = df.select("*", F.posexplode(per_sentence).alias("sent_no", "__s"))
    s = s.select(*df.columns, "sent_no", F.col("__s.sentence").alias("sentence"),
                 F.col("__s.tokens").alias("tokens"))
    s = s.filter(T.valid_sentence(F.col("sentence"), script) & (F.size("tokens") >= min_tokens))
    return s.withColumn("sentence_text", F.array_join("tokens", " "))


def build_corpus(paragraphs: DataFrame, script: str = T.HEBREW_BLOCK, mode: str = "colon",
                 min_tokens: int = MIN_TOKENS, unknown: str = "Unknown Speaker",
                 keywords: list[str] | None = None) -> DataFrame:
    """Paragraphs -> speaker turns -> sentences -> tokens.

    Input ``(doc_id, para_no, text, ...)``.  Output one row per kept sentence:
    ``doc_id, para_no, sent_no, speaker_name, sentence_text, n_tokens`` plus the
    extra input columns.
    """
    p = paragraphs.withColumn("__t", T.strip(F.col("text"))).filter(F.col("__t") != "")
    p = p.withColumn("__spk", T.extract_speaker(F.col("__t"), script, unknown, keywords))
    p = p.withColumn("__own", F.when(F.col("__spk") != unknown, F.col("__spk")))
    p = carry_forward(p, "doc_id", "para_no", "__own", "speaker_name")
    p = p.filter(F.col("speaker_name").isNotNull())
    body = F.when(F.col("__own").isNotNull(),
                  T.spoken_text(F.col("__t"), F.col("__own"), script, mode)).otherwise(F.col("__t"))
    p = p.withColumn("__body", body)
    s = sentences_of(p, "__body", script, min_tokens)
    return (s.withColumn("n_tokens", F.size("tokens").cast("bigint"))
            .drop("__t", "__spk", "__own", "__body", "text", "sentence"))


def build_records(paragraphs: DataFrame, script: str = T.HEBREW_BLOCK, mode: str = "colon", min_tokens: int = MIN_TOKENS,
                  unknown: str = "Unknown Speaker", keywords: list[str] | None = None,
                  protocol_number: Column | None = None) -> DataFrame:
    """T11 whole: paragraphs ``(file_name, para_no, text)`` of files (S3) to sentence records.

    One row per kept sentence: protocol_name, knesset_number and protocol_type
    from the file name (P12), protocol_number from the first paragraph that
    holds one (T9), speaker_name (T6-T8), sentence_text (T1-T3), and para_no,
    sent_no, n_tokens.  ``protocol_number`` is the number of one paragraph,
    by default by the Hebrew patterns.  Paragraphs without a text (a file that
    could not be read) give nothing.  The numbers are one row per file, found
    by a partial minimum; the paragraphs themselves meet only the speaker scan.
    """
    named = paragraphs.select(F.col("file_name").alias("doc_id"), "para_no", "text").filter(F.col("text").isNotNull())
    numbers = first_protocol_number(named.select("doc_id", "para_no", (
        paragraph_protocol_number("text") if protocol_number is None else protocol_number).alias("pnum")))
    rows = build_corpus(named, script, mode, min_tokens, unknown, keywords).join(numbers, "doc_id")
    return rows.select(F.col("doc_id").alias("protocol_name"), T.file_knesset_number("doc_id").cast("bigint").alias("knesset_number"),
                       T.file_protocol_type("doc_id").alias("protocol_type"), "protocol_number", "speaker_name", "sentence_text",
                       "para_no", "sent_no", "n_tokens")


def corpus_token_count(corpus: DataFrame) -> DataFrame:
    """Total kept tokens."""
    return corpus.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("bigint").alias("tokens_count"))
