"""Text rules on literal strings, including the Hebrew-script behaviour the
fixture tables cannot exercise."""

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import corpus as C


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text,expected", [
    ("Hello there. How are you? Fine", ["Hello there.", "How are you?", "Fine"]),
    ("...", ["..", "."]),
    (". abc.", [". abc."]),
    ("  one: two!  ", ["one:", "two!"]),
    ("no end mark", ["no end mark"]),
    ("", []),
    ("a.\n b", ["a.", "b"]),
])
def test_split_sentences(spark, text, expected):
    assert one(spark, T.split_sentences, text) == expected


def test_tokenize_hebrew(spark):
    s = "שלום, עולם! מחיר 12.5% ו-$3 באתר www.gov.il ודואר a.b@c.com (הערה)"
    toks = one(spark, lambda c: T.tokenize(c), s)
    assert toks[:4] == ["שלום", ",", "עולם", "!"]
    assert "12.5%" in toks
    assert "$" in toks and "3" in toks                 # '$' is taken as punctuation first
    assert "www.gov.il" in toks                        # URL after foreign letters
    assert "(" in toks and ")" in toks                 # parentheses never match whole
    assert "a.b@c.com" in toks                         # Latin letters survive only as URL / e-mail
    assert "gov" not in toks


def test_tokenize_latin_script(spark):
    toks = one(spark, lambda c: T.tokenize(c, r"\p{L}"), "Héllo, wörld a1 x_y")
    assert toks == ["Héllo", ",", "wörld", "a", "1", "x", "y"]


@pytest.mark.parametrize("s,ok", [
    ("זה משפט תקין.", True),
    ("English only.", False),
    ("משפט ... חסר", False),
    ("משפט --- חסר", False),
])
def test_valid_sentence_hebrew(spark, s, ok):
    assert one(spark, T.valid_sentence, s) is ok


def test_speaker_extraction(spark):
    rows = [("היו\"ר משה כהן: אני פותח את הישיבה.",),
            ("שר האוצר (יאיר לפיד): תודה רבה.",),
            ("טקסט ללא דובר",),
            ("Mr. Smith: hello",)]
    df = spark.createDataFrame(rows, "t string")
    r = df.select(T.extract_speaker("t").alias("s"),
                  T.spoken_text("t", T.extract_speaker("t"), mode="colon").alias("colon"),
                  T.spoken_text("t", T.extract_speaker("t"), mode="reference").alias("ref")).collect()
    assert r[0]["s"] == "היור משה כהן"            # quotes removed from the name
    assert r[0]["colon"] == "אני פותח את הישיבה."
    assert r[1]["s"] == "שר האוצר"                     # parenthesised part removed
    assert r[1]["colon"] == "תודה רבה."
    assert r[1]["ref"] != r[1]["colon"]                # reference cut leaves a remnant
    assert r[2]["s"] == "Unknown Speaker"
    assert r[3]["s"] == "Unknown Speaker"


def test_number_words_hebrew(spark):
    df = spark.createDataFrame([("העשרים ושלוש",), ("מאה",), ("שלוש-מאות",), ("משהו",)], "t string")
    r = [x[0] for x in df.select(C.number_words_value(F.col("t"))).collect()]
    # every conjunction letter becomes a blank, so words holding it count 0;
    # the hyphenated keys are unreachable after the split
    assert r == [20, 100, 0, 0]


def test_first_protocol_number(spark):
    paras = spark.createDataFrame([
        (1, 0, "כותרת"), (1, 1, "הישיבה"), (1, 2, "פרוטוקול מס' 57"), (1, 3, "פרוטוקול מס' 99"),
        (2, 0, "הישיבה העשרים ושלוש של הכנסת"),
        (3, 0, "אין מספר"),
        (4, 0, "פרוטוקול מס' 0"),
    ], "doc_id int, para_no int, text string")
    p = paras.withColumn("pnum", C.paragraph_protocol_number(F.col("text")))
    r = {x["doc_id"]: x["protocol_number"] for x in C.first_protocol_number(p).collect()}
    assert r == {1: 57, 2: 20, 3: -1, 4: -1}           # the word pattern takes one word


def test_words_tokenizers(spark):
    s = 'אמר "שלום רב" ו-יו"ר הכנסת ח\'ברה a'
    w = one(spark, T.tokenize_words, s)
    assert "שלום רב" in w and 'יו"ר' in w and "ח'ברה" in w
    assert all(len(x) > 1 for x in w)
    so = one(spark, T.tokenize_script_only, "שלום, abc עולם! ב")
    assert so == ["שלום", "עולם"]


def test_build_corpus_carry_forward(spark):
    paras = spark.createDataFrame([
        (1, 0, "מבוא ללא דובר שאינו נכלל בכלל."),
        (1, 1, "היו\"ר דוד לוי: אנו פותחים את הדיון בנושא החשוב."),
        (1, 2, "המשך דבריו של היושב ראש כאן."),
        (1, 3, ""),
        (1, 4, "שרה כהן: אני מסכימה עם הדברים שנאמרו כאן."),
    ], "doc_id int, para_no int, text string")
    out = C.build_corpus(paras).orderBy("para_no", "sent_no").collect()
    assert [r["speaker_name"] for r in out] == ["היור דוד לוי", "היור דוד לוי", "שרה כהן"]
    assert out[0]["sentence_text"].startswith("אנו פותחים")


def test_carry_forward_across_chunks(spark):
    rows = [(7, i, "s" if i in (3, 9) else None) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id int, para_no int, v string")
    r = C.carry_forward(df, "doc_id", "para_no", "v", "c", chunk_rows=4).orderBy("para_no").collect()
    assert [x["c"] for x in r] == [None] * 3 + ["s"] * 17


def test_clean_lyrics_and_prompts(spark):
    assert one(spark, T.clean_lyrics, "  Hello,   WORLD!! EmbedShare 42 ") == "hello world"
    assert one(spark, T.response_label, "Clearly POSITIVE.") == "Positive"
    assert one(spark, T.response_label, "meh") == "Negative"


def test_fill_markers(spark):
    df = spark.createDataFrame([("a [*] b [*] c", ["x", "y"])], "t string, p array<string>")
    assert df.select(T.fill_markers("t", "p")).first()[0] == "a x b y c"


def test_sentence_pattern_is_the_lazy_one(spark):
    """The possessive pattern finds what the lazy one found, at line ends and blanks too, and keeps no choices per character."""
    import itertools
    lazy = r"\s*\S[\s\S]*?[.!?:]|\s*\S[\s\S]*$"
    rows = [("".join(x),) for n in range(6) for x in itertools.product("a. \n?", repeat=n)] + [("é  .\r\n",), (None,)]
    d = spark.createDataFrame(rows, "t string")
    both = d.select("t", F.regexp_extract_all("t", F.lit(lazy), 0).alias("a"), F.regexp_extract_all("t", F.lit(T.SENTENCE_RE), 0).alias("b"))
    assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    assert "*?" not in T.SENTENCE_RE


def test_padded_sequences_are_written_once(spark, tmp_path):
    """The longest and the padding read the encoded sequences, not the texts again."""
    from quire.plans.q_text import q_pad_to_longest
    spark.createDataFrame([(1, "abc d"), (2, "ab"), (3, "a"), (4, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    d = q_pad_to_longest(spark, str(tmp_path))
    assert not any("documents.parquet" in f for f in d.inputFiles())
    assert {tuple(r) for r in d.collect()} == {(1, 4, 0), (2, 4, 3)}


def test_input_and_target_sequences_are_padded(spark):
    """The padded sequences themselves are made, the targets' too."""
    from quire.plans.q_text import pad_to_longest
    d = pad_to_longest(spark.createDataFrame([(1, [5, 6, 7, 8]), (2, [9, 11]), (2, [9, 11])], "doc_id long, codes array<long>"))
    assert sorted(tuple(r) for r in d.collect()) == [(1, 3, 0, "5,6,7", "6,7,8"), (2, 3, 2, "9,0,0", "11,0,0"), (2, 3, 2, "9,0,0", "11,0,0")]
