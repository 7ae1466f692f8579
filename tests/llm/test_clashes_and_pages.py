"""Columns named like those the operators make, and page forms whose optional tags are left out."""

from collections import Counter

import pytest

from llm_tables import SMALL, odd_docs  # noqa: F401


def test_op4_columns_of_the_mix(spark, odd_docs):  # noqa: F811
    from quire.llm.mixing import take_mix
    plain = Counter((r["doc_id"], r["text"]) for r in take_mix(odd_docs).collect())
    clash = odd_docs
    for c in ("target", "edge", "source_size", "epochs", "cut", "q_source", "size", "taken", "rest", "before", "w", "cap", "level", "n"):
        clash = clash.withColumn(c, clash["id"])
    got = take_mix(clash)
    assert got.columns == clash.columns
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == plain
    assert {r["target"] for r in got.collect()} <= {"id"}


def test_op2_a_column_named_like_the_score(spark, odd_docs):  # noqa: F811
    from quire.llm.toxicity import fit, score
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    got = score(odd_docs, model)
    assert sorted(got.columns) == sorted(odd_docs.columns)
    want = score(odd_docs.drop("score"), model)
    assert Counter((r["doc_id"], r["score"]) for r in got.collect()) == Counter((r["doc_id"], r["score"]) for r in want.collect())


def test_op5_columns_named_like_the_result(spark):
    from quire.llm.html_extract import extract_text
    page = "<article><p>" + "A sentence of the article, long enough to be one. " * 3 + "</p></article>"
    pages = spark.createDataFrame([(1, page, "old", -1), (1, page, "old", -1), (2, None, "old", -1)], "page_id long, html string, text string, n_chars int")
    got = Counter(tuple(r) for r in extract_text(pages).collect())
    text = ("A sentence of the article, long enough to be one. " * 3).strip()
    assert got == Counter({(1, text, len(text)): 2, (2, "", 0): 1})


@pytest.mark.parametrize("page,texts", [
    ("<title>T</title><p>First.<p>Second.", ["First.", "Second."]),
    ("<head><meta charset=x><title>T</title><h1>Heading</h1><p>Text.", ["Heading", "Text."]),
    ("<html><head><title>T</title>Text at once<p>More.", ["Text at once", "More."]),
    ("<head><link rel=x><b>Bold</b> start", ["Bold start"]),
    ("<p>Before <svg class=icon/> after.<p>Next.", ["Before after.", "Next."]),
    ("<p>Before <svg><title>x</title><path d='M0'/></svg>after.<p>Next.", ["Before after.", "Next."]),
    ("<datalist id=x><option>a<option>b</datalist><p>Kept.", ["Kept."]),
    ("<datalist><option value=a><option value=b><p>Kept to the end.", ["Kept to the end."]),
    ("<select><option>a</select><p>Kept.", ["Kept."]),
    ("<p>Press <button>no<p>Kept after all.", ["Press", "no", "Kept after all."]),
    ("<p>The sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is c.", ["The sum a+b is c."]),
    ("<p>Given <math><semantics><mi>x</mi><annotation>\\\\x</annotation></semantics></math>.", ["Given x."]),
    ("<xmp>if a < b &amp; <b>c</b></xmp><p>Next.", ["if a < b &amp; <b>c</b>", "Next."]),
    ("<p>R&am<b>p;</b>D &amp; more &lt;x&gt;", ["R&amp;D & more <x>"]),
    ("<object data=x>fallback<p>Kept.", ["fallback", "Kept."]),
    ("<script>var a = '<p>no';</script><p>Yes.<script>never ends <p>no", ["Yes."]),
])
def test_op5_forms_of_pages(page, texts):
    from quire.llm.html_blocks import blocks
    assert [b.text for b in blocks(page)] == texts


def test_op5_all_parts_of_names():
    from quire.llm.html_blocks import blocks
    names = " ".join(f"n{chr(97 + i)}x" for i in range(20)) + " sidebar"
    assert "sidebar" in blocks(f"<div class='{names}'>Text</div>")[0].path[0][1]


def test_op5_accuracy_on_new_layouts():
    """Blocks of generated pages that the model was not trained on."""
    from quire.llm.html_blocks import blocks
    from quire.llm.html_extract import _Generator, labeller, main_texts
    make, model = _Generator(seed=77), labeller()
    right, total, whole, pages = 0, 0, 0, 0
    for _ in range(120):
        page, labels = make.page()
        own = blocks(page)
        if len(own) != len(labels):               # an advert in an inline element, part of its neighbour
            continue
        pages += 1
        want = [b.text for b, y in zip(own, labels) if y]
        got = main_texts(model, [page])[0]
        kept = set(got.split("\n"))
        right += sum((b.text in kept) == bool(y) for b, y in zip(own, labels))
        total += len(own)
        whole += got == "\n".join(want)
    assert pages > 110 and right / total > 0.96 and whole > pages / 2
