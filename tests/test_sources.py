"""File sources and sinks on files built in temp folders."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from quire.sources import files as S

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def make_docx(path, paragraphs):
    body = "".join(f'<w:p><w:r><w:t>{p}</w:t></w:r></w:p>' for p in paragraphs)
    xml = f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{W}"><w:body>{body}</w:body></w:document>'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", xml)


def test_read_corpus_jsonl(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "corpus.jsonl")
    with open(p, "w", encoding="utf-8") as f:
        f.write(json.dumps({"protocol_name": "a", "protocol_type": "Plenary", "sentence_text": "שלום עולם"},
                           ensure_ascii=False) + "\n")
        f.write(json.dumps({"protocol_name": "b", "sentence_text": "x"}) + "\n")
    df = S.read_corpus_jsonl(spark, p, ["protocol_name", "protocol_type", "sentence_text"])
    rows = sorted(df.collect())
    assert rows[0]["protocol_type"] == "plenary"
    assert rows[1]["protocol_type"] == ""            # missing field -> ''
    out = os.path.join(tmpdir_path, "out")
    S.write_corpus_jsonl(df, out)
    text = "".join(open(os.path.join(out, f), encoding="utf-8").read()
                   for f in os.listdir(out) if f.endswith(".json"))
    assert "שלום עולם" in text                       # no ASCII escaping


def test_read_document_folder(spark, tmpdir_path):
    make_docx(os.path.join(tmpdir_path, "25_ptm_1.docx"), ["פרוטוקול מס' 7", "דובר: שלום."])
    with open(os.path.join(tmpdir_path, "bad.docx"), "wb") as f:
        f.write(b"not a zip")
    with open(os.path.join(tmpdir_path, "notes.txt"), "w") as f:
        f.write("ignored")
    df = S.read_document_folder(spark, tmpdir_path)
    rows = df.orderBy("file_name", "para_no").collect()
    good = [r for r in rows if r["file_name"] == "25_ptm_1.docx"]
    assert [r["text"] for r in good] == ["פרוטוקול מס' 7", "דובר: שלום."]
    bad = [r for r in rows if r["file_name"] == "bad.docx"]
    assert len(bad) == 1 and bad[0]["error"] is not None
    meta = df.select(*S.protocol_metadata(F.col("file_name"))).distinct().collect()
    assert {(r["knesset_number"], r["protocol_type"]) for r in meta} >= {(25, "plenary")}


def test_docx_body_paragraphs_only(spark, tmpdir_path):
    xml = (f'<w:document xmlns:w="{W}"><w:body><w:p><w:pPr><w:tabs><w:tab/></w:tabs></w:pPr><w:r><w:t>a</w:t><w:tab/>'
           '<w:t>b</w:t><w:br/><w:br w:type="page"/></w:r><w:hyperlink><w:r><w:t>c</w:t></w:r></w:hyperlink>'
           '<w:r><w:txbxContent><w:p><w:r><w:t>box</w:t></w:r></w:p></w:txbxContent></w:r><w:r><w:t>d</w:t></w:r></w:p>'
           '<w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl><w:p/></w:body></w:document>')
    with zipfile.ZipFile(os.path.join(tmpdir_path, "t.docx"), "w") as z:
        z.writestr("word/document.xml", xml)
    rows = S.read_document_folder(spark, tmpdir_path).orderBy("para_no").collect()
    assert [r["text"] for r in rows] == ["a\tb\ncd", ""]


def test_headerless_and_header_csv(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "census.csv")
    with open(p, "w") as f:
        f.write("39, State-gov, 77516, Bachelors, 13, Never-married, ?, Not-in-family, White, Male, 2174, 0, 40, "
                "United-States, <=50K\n")
        f.write("50, ?, 83311, Bachelors, 13, Married, Exec, Husband, White, Male, 0, 0, 13, United-States, >50K.\n")
    df = S.read_headerless_csv(spark, p)
    assert df.columns == S.CENSUS_COLUMNS
    from quire.operators.tables import clean_and_map_label
    lab = [r[0] for r in df.select(clean_and_map_label("income", {"<=50K": 0, ">50K": 1})).collect()]
    assert lab == [0, 1]
    q = os.path.join(tmpdir_path, "songs.csv")
    with open(q, "w") as f:
        f.write('Artist,Lyrics,Other\n"A","line one\nline two",x\n"B","solo",y\n')
    songs = S.read_header_csv(spark, q, ["Artist", "Lyrics"])
    assert songs.count() == 2
    assert songs.filter(F.col("Artist") == "A").first()["Lyrics"] == "line one\nline two"


def test_text_lines_and_report(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "s.txt")
    with open(p, "w") as f:
        f.write("first\nsecond\nthird\n")
    lines = S.read_text_lines(spark, p).orderBy("line_no").collect()
    assert [r["text"] for r in lines] == ["first", "second", "third"]
    df = spark.createDataFrame([(3, "tfidf", 1, "e f g"), (2, "freq", 2, "c d"), (2, "freq", 1, "a b")],
                               "size int, metric string, rank int, gram string")
    out = os.path.join(tmpdir_path, "report")
    S.write_report(df, out, ["size", "metric"], "gram", ["rank"], {"size": {2: "Two", 3: "Three"}})
    txt = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.startswith("part"))
    assert txt.splitlines() == ["Two:", "freq:", "a b", "c d", "Three:", "tfidf:", "e f g"]


def test_cached_subset(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "subset")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)
    assert S.cached_subset(spark, p, build).count() == 5
    assert S.cached_subset(spark, p, build).count() == 5
    assert len(calls) == 1


def test_labelled_tree(spark, tmpdir_path):
    for d in ["Cloudy", "Rain"]:
        os.makedirs(os.path.join(tmpdir_path, "train", d))
        open(os.path.join(tmpdir_path, "train", d, "x1.jpg"), "w").write("jpg")
        open(os.path.join(tmpdir_path, "train", d, "x2.JPG"), "w").write("jpg")
    open(os.path.join(tmpdir_path, "train", "Rain", "readme.txt"), "w").write("txt")
    with pytest.warns(UserWarning, match="Sunrise"):
        tr = S.read_labelled_tree(spark, os.path.join(tmpdir_path, "train"), "folder")
    assert sorted(r["label"] for r in tr.collect()) == [0, 0, 3, 3]
    os.makedirs(os.path.join(tmpdir_path, "test"))
    for n in ["cloudy12.jpg", "Sunrise3.jpg", "shine7.JPG"]:
        open(os.path.join(tmpdir_path, "test", n), "w").write("jpg")
    te = S.read_labelled_tree(spark, os.path.join(tmpdir_path, "test"), "prefix")
    assert sorted(r["label"] for r in te.collect()) == [0, 1, 2]
    open(os.path.join(tmpdir_path, "test", "storm1.jpg"), "w").write("jpg")
    with pytest.raises(Exception):
        S.read_labelled_tree(spark, os.path.join(tmpdir_path, "test"), "prefix").collect()


def test_save_load_and_vectors(spark, tmpdir_path):
    df = spark.createDataFrame([("a", [1.0, 2.0])], "word string, vector array<double>")
    p = os.path.join(tmpdir_path, "model")
    S.save_table(df, p)
    assert S.load_table(spark, p).first()["vector"] == [1.0, 2.0]
    v = S.read_vector_table(spark, "/root/testdata/sf0.001/embeddings.parquet")
    assert v.columns == ["id", "features", "label"]


def test_files_to_records(spark, tmpdir_path):
    from quire.operators.corpus import build_records
    make_docx(os.path.join(tmpdir_path, "25_ptm_1.docx"), [
        "כותרת", "הישיבה העשרים-וארבע", "פרוטוקול מס' 8", "זה נאמר לפני הדובר הראשון כאן.", "דוד כהן: שלום לכם חברים יקרים! עוד משפט אחד ארוך כאן. קצר.",
        "והנה המשך דבריו של אותו דובר.", "", "רות לוי (סיעה): תודה רבה לך אדוני היושב."])
    make_docx(os.path.join(tmpdir_path, "7_ptv_2.docx"), ["יושב ראש: אין כאן מספר של פרוטוקול כלל."])
    make_docx(os.path.join(tmpdir_path, "other.docx"), ["פרוטוקול מס 31", "דוד כהן: משפט שלם עם מספיק מילים."] + ["עוד פסקה אחת של אותו דובר."] * 2500)
    with open(os.path.join(tmpdir_path, "1_ptm_bad.docx"), "wb") as f:
        f.write(b"not a zip")
    records = build_records(S.read_document_folder(spark, tmpdir_path))
    path = os.path.join(tmpdir_path, "records")
    S.write_corpus_jsonl(records.select(*S.CORPUS_FIELDS), path)
    got = [tuple(r) for r in S.read_corpus_jsonl(spark, path).collect()]
    assert sorted(got) == sorted([tuple(r) for r in records.select(*S.CORPUS_FIELDS).collect()])
    short = sorted(r for r in got if r[0] != "other.docx")
    assert [(r[:5]) for r in short] == [("25_ptm_1.docx", 25, "plenary", 24, "דוד כהן")] * 3 + [("25_ptm_1.docx", 25, "plenary", 24, "רות לוי"),
                                                                                               ("7_ptv_2.docx", 7, "committee", -1, "יושב ראש")]
    assert "שלום לכם חברים יקרים !" in {r[5] for r in short} and not any("לפני" in r[5] for r in short)
    long = [r for r in got if r[0] == "other.docx"]
    assert len(long) == 2501 and {r[1:5] for r in long} == {(-1, "undefined", 31, "דוד כהן")}
