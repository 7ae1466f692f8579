"""Each operator against brute force on a small table, and on odd rows."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm_tables import SMALL, odd_docs  # noqa: F401


def lower_words(t):
    return (t or "").encode().lower().split()


def shingles(t, n=5):
    w = lower_words(t)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def low(d):
    return float("-inf") if d is None else d


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(params=["small", "odd", "empty"])
def table(request, docs, odd_docs):
    return {"small": docs, "odd": odd_docs, "empty": docs.limit(0)}[request.param]


def test_op1_near_duplicates(table):
    from quire.llm.minhash_dedup import drop_near_duplicates, near_duplicates
    rows = rows_of(table)
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    want = Counter()
    for i, (d, _) in enumerate(rows):
        c = min(least[find(i)], default=d)
        want[(d, len(sets[i]), c, d == c)] += 1
    assert Counter(map(tuple, near_duplicates(table).collect())) == want
    kept = drop_near_duplicates(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=low) == sorted({k[0] for k in want if k[3]}, key=low)


def test_op1_blocks_of_large_buckets(spark, monkeypatch):
    """A chain of texts in which no centre is linked with all: found whole, also over several blocks."""
    from quire.llm import minhash_dedup as M
    monkeypatch.setattr(M, "BLOCK", 4)
    words = [f"t{i}" for i in range(200)]
    rows = []
    for k in range(12):
        words[k * 10 + 3] = f"new{k}"
        rows.append((k, " ".join(words)))
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {0}


def test_op1_ids_of_several_texts(spark):
    """Null ids and an id with two texts: every clean document stays, near copies go, and links use the class's own text."""
    from quire.llm.minhash_dedup import drop_near_duplicates, near_duplicate_classes
    text = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcdefgh"}
    copy = {k: t.replace(f"{k}30", "other") for k, t in text.items()}
    rows = [*((None, t) for t in text.values()), *((None, copy[k]) for k in "abcd"), (1, copy["e"]), (2, "one text"), (2, "two texts"), (2, "two texts"),
            (None, None), (None, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_duplicate_classes(table)[1].count() == 5
    kept = [(r["doc_id"], r["text"]) for r in drop_near_duplicates(table).collect()]
    want = [*((None, k) for k in "abcdfgh"), (1, "e")]
    assert sorted((str(d), t[0]) for d, t in kept if t and len(t) > 20) == sorted((str(d), k) for d, k in want)
    assert Counter(r for r in kept if not r[1] or len(r[1]) <= 20) == Counter([(2, "one text"), (2, "two texts"), (None, None), (None, "")])


def test_op2_toxicity(spark, odd_docs):
    from quire.llm.toxicity import drop_toxic, fit, fold_of, score
    rng = np.random.default_rng(1)
    usual = [f"plain{i}" for i in range(300)]
    rows, labels = [], []
    for d in range(1500):
        t = rng.choice(usual, 40).tolist()
        if d % 4 == 0:
            t[::8] = [f"vile{rng.integers(1000)}" for _ in t[::8]]
        rows.append((d, " ".join(t)))
        labels.append((d, int(d % 4 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = fit(table, known)
    got = score(table.withColumn("held", fold_of("doc_id") == 0), model).where("held").collect()
    right = [(r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in got]
    assert len(right) > 200 and np.mean(right) > 0.98
    odd = score(odd_docs.withColumnRenamed("score", "score0"), model).collect()
    assert len(odd) == 15 and all(0 <= r["score"] <= 1 for r in odd)
    assert drop_toxic(odd_docs, model).columns == odd_docs.columns
    assert score(table.limit(0), model).count() == 0
    none = fit(table, known.where("toxic = 0"))
    assert {r["score"] for r in score(table, none).collect()} == {0.0}


def test_op2_whole_model(spark, docs, odd_docs):
    """Every counted gram is in the model, and a model too large to send scores the same by joins."""
    from quire.llm import toxicity as T
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    known = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None}
    text = {r["doc_id"]: (r["text"], r["f"]) for r in docs.select("doc_id", "text", T.fold_of("doc_id").alias("f")).collect()}
    want = set()
    for d, (t, f) in text.items():
        if d in known and f not in (T.HELD_OUT, T.CURVE):
            for w in set(lower_words(t)):
                w = b" " + w + b" "
                want |= {w[max(0, i - 5):i + 1][-m:] for i in range(1, len(w)) for m in range(2, T.ORDER + 1)}
    model = T.fit(docs, labels)
    assert len(model.keys) == len({w for w in want if len(w) > 1})
    joined = T.fit(docs, labels, model_grams=0)
    assert joined.tables
    for table in (docs, odd_docs.withColumnRenamed("score", "score0")):
        a = sorted((str(r["doc_id"]), str(r["text"]), r["score"]) for r in T.score(table, model).collect())
        b = sorted((str(r["doc_id"]), str(r["text"]), r["score"]) for r in T.score(table, joined).collect())
        assert [x[:2] for x in a] == [x[:2] for x in b]
        assert np.allclose([x[2] for x in a], [x[2] for x in b], atol=1e-9)
    assert T.drop_toxic(odd_docs, joined).columns == odd_docs.columns


def test_op2_curve_of_a_small_table():
    """Toxic rows just above the rest reach 0.5 beside a few texts far out, and the curve rises."""
    from quire.llm.toxicity import _fit_curve
    bins = [(-1.8, 1, 8), (-0.3, 3, 10), (0.02, 0, 1), (0.09, 1, 0), *((-0.1 - i / 1000, 0, 2) for i in range(30)), (-0.03, 4, 3), (0.01, 4, 0)]
    x, p = _fit_curve(bins)
    assert (np.diff(x) > 0).all() and (np.diff(p) > 0).all()
    assert np.interp(0.01, x, p) >= 0.5 > np.interp(-0.1, x, p)


def test_op3_fingerprints(table):
    from quire.llm.fingerprints import fingerprints
    rows = rows_of(table)
    ids = sorted({d for d, _ in rows}, key=low)
    by_id = {d: t or "" for d, t in rows}
    want = Counter()
    for d, t in rows:
        t, after = t or "", by_id[ids[(ids.index(d) + 1) % len(ids)]]
        n = len(t) // 4
        want[(d, len(t), hashlib.sha256((t[:len(t) - n] + after[:n]).encode()).hexdigest())] += 1
    got = fingerprints(table).collect()
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    prints = defaultdict(set)
    for r in got:
        prints[by_id[r["doc_id"]]].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(p) == 1 for p in prints.values())
    if len(rows) > 100:
        assert np.mean([r["near_edited"] for r in got]) > 0.3 > 0.1 > np.mean([r["near_next"] for r in got])


def test_op4_mixing(table):
    from quire.llm.mixing import mix, take_mix
    rows = [(r["doc_id"], len(lower_words(r["text"])), r["source"]) for r in table.collect()]
    size = Counter()
    for _, n, s in rows:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    free, left, want = set(order), sum(size.values()), {}
    while free:
        share = left / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] >= 3 * size[s]]
        if not over:
            want |= {s: share * weight[s] for s in free}
            break
        for s in over:
            want[s] = 3 * size[s]
            left -= want[s]
            free.discard(s)
    got = mix(table).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, n) for d, n, _ in rows)
    source = {d: s for d, _, s in rows}
    taken, largest = Counter(), Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == size[s] and r["target"] == pytest.approx(want[s]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in order)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix(table.repartition(5)).collect()), key=str)
    copies = Counter(r["doc_id"] for r in take_mix(table).collect())
    assert all(copies[r["doc_id"]] * r["size"] == r["taken"] * sum(x["doc_id"] == r["doc_id"] for x in got) for r in got if r["size"])


def test_op5_html(spark):
    from quire.llm.html_blocks import blocks
    from quire.llm.html_extract import Labeller, extract_text
    page = ('<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><nav class="menu"><a href="/">Home</a></nav>'
            '<article><h1>A &amp; B</h1><p><b>First  block,\nof the text.<br><p>Second block &lt;here&gt;, with more words.</p></article>'
            '<div class="ad">Buy now.</div><section class="comments"><p>Nice article, I agree.</p></section><footer>&copy; site</footer>')
    pages = spark.createDataFrame([(0, "u", page), (1, "v", None), (2, "w", ""), (3, "x", "<p"), (3, "x", "<p")], "page_id long, url string, html string")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in extract_text(pages).collect())
    text = "A & B\nFirst block, of the text.\nSecond block <here>, with more words."
    assert got == [(0, text, len(text)), (1, "", 0), (2, "", 0), (3, "", 0), (3, "", 0)]
    assert extract_text(pages.limit(0)).count() == 0
    assert [b.text for b in blocks("a<!-- x --><div>b <i>c</i><p>d<ul><li>e<li>f</ul>g")] == ["a", "b c", "d", "e", "f", "g"]
    # the gradient of the recurrent network against differences
    net, rng = Labeller(3, 2), np.random.default_rng(0)
    x, mask, y = rng.normal(size=(4, 2, 3)), np.array([[1, 1], [1, 1], [1, 0], [1, 0]], float), rng.integers(0, 2, (4, 2))

    def loss():
        z = net._logits(x, mask)[0]
        return ((np.log1p(np.exp(z)) - y * z) * mask).sum()
    z, top, tf, tb = net._logits(x, mask, keep=True)
    dz = (1 / (1 + np.exp(-z)) - y) * mask
    grad = {k: np.zeros_like(v) for k, v in net.p.items()}
    net._back(x, dz[:, :, None] * net.p["V"][:2], tf, "f", grad)
    net._back(x[::-1], (dz[:, :, None] * net.p["V"][2:4])[::-1], tb, "b", grad)
    for name, at in (("Wf", (1, 2)), ("Wb", (4, 5)), ("bf", (0,))):
        net.p[name][at] += 1e-5
        up = loss()
        net.p[name][at] -= 2e-5
        down = loss()
        net.p[name][at] += 1e-5
        assert grad[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6)


def test_op6_lines(table):
    from quire.llm.line_dedup import drop_shared_lines
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def key(line):
        return line.strip(" \t\n\x0b\f\r").translate(small)
    rows, held = rows_of(table), defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(d)
    want = Counter()
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (len(key(x)) >= 40 and len(held[key(x)]) >= 5 and max(held[key(x)], key=low) != d)]
        want[(d, len(lines), len(lines) - len(keep), "\n".join(keep))] += 1
    assert Counter(map(tuple, drop_shared_lines(table).collect())) == want


@pytest.mark.parametrize("window", [50, 4])
def test_op7_spans(table, window):
    from quire.llm.substring_dedup import remove_repeated_spans
    rows, first = rows_of(table), {}
    words = [(t or "").encode().split() for _, t in rows]
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, d), d, key=low)
    want = Counter()
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if low(first[tuple(w[i:i + window])]) < low(d):
                gone[i:i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        want[(d, len(w), sum(gone), hashlib.sha256(kept).hexdigest())] += 1
    got = remove_repeated_spans(table, window=window)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()) == want


def test_op8_pii(spark, docs, odd_docs):
    from quire.llm import pii
    plain = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    hard = ["a@b.c@d.e.f x@y x@@y.z a@b-.c", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112 12", "+1 (386) 555-3733 +1 2 ++49 30 1234567 x",
            "mail jane (at) site (dot) com or call (212) 555-0100", "é a.b+c@ü.de q@x.de"]
    texts = [t for _, t in rows_of(docs)] + [t for _, t in rows_of(odd_docs)] + hard

    def valid(k, s):
        digits = re.sub("[^0-9]", "", s)
        return (True, k == 1 and all(int(x) <= 255 for x in s.split(".")), 12 <= len(digits) <= 19 and pii._luhn(digits), 9 <= len(digits) <= 15)[k]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.personal_data(table).collect()}
    for i, t in enumerate(texts):
        spans = sorted((m.start(), k, m.end()) for k, p in enumerate(plain) for m in re.finditer(p, t or "") if valid(k, m[0]))
        base = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        r = got[i]
        assert (r["base_spans"], r["base_sha256"]) == (base, hashlib.sha256(base.encode()).hexdigest())
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == x for _, k, _ in spans) for x in range(4)]
        assert not base or set(base.split(",")) <= set(r["spans"].split(","))
    q = pii.reliabilities([(0, pii._pattern((1, 1, 1, 1), "x"), 50), (0, pii._pattern((0, 0, 0, 2), "x"), 50)])
    assert q[0] > 0.9 > 0.1 > q[1]
    assert pii.personal_data(table.limit(0)).count() == 0


@pytest.mark.parametrize("block_bytes", [8 << 20, 6000])
def test_op9_contamination(spark, table, block_bytes):
    from quire.llm.decontaminate import contaminated, drop_contaminated
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    items += [(900, "three SHORT words"), (901, None), (902, ""), (903, " ".join(f"word{i}" for i in range(20, 29))), (904, "dup row text here now"), (905, " ".join(f"w{i * 7919 % 9973}" for i in range(500, 900)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for d, t in rows_of(table):
        for i, x in items:
            s = shingles(x)
            n = min(5, len(lower_words(x)))
            w = lower_words(t)
            both = len(s & {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}) if s else 0
            if s and 100 * both >= 75 * len(s):
                want.append((d, i, len(s), both, both / len(s)))
    got = contaminated(table, bench, block_bytes=block_bytes)
    assert Counter(map(tuple, got.collect())) == Counter(want)
    clean = drop_contaminated(table, bench, block_bytes=block_bytes)
    bad = {w[0] for w in want}
    assert clean.columns == table.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(d for d, _ in rows_of(table) if d not in bad)


def test_op10_token_output(table, tmp_path):
    import tiktoken

    from quire.llm import token_output as T
    ranks = T.load_ranks(T.VOCABULARY)
    plain = tiktoken.Encoding("plain", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={})
    end, path = max(ranks.values()) + 1, str(tmp_path / "out")
    want = Counter((d, tuple(plain.encode_ordinary(t or ""))) for d, t in rows_of(table))
    index = sorted(T.write_training_order(table.repartition(3), path, length=64, per_shard=7).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in index] == list(range(len(index)))
    parts = defaultdict(list)
    for r in index:
        with open(f"{path}/shard-{r['shard']:06d}.bin", "rb") as f:
            f.seek(r["position"] * 128)
            raw = f.read(128)
        assert hashlib.sha256(raw).hexdigest() == r["sha256"]
        ids, current = np.frombuffer(raw, "<u2")[:r["n_tokens"]].tolist(), []
        pieces = []
        for x in ids:
            if x == end:
                pieces.append((current, True))
                current = []
            else:
                current.append(x)
        if current:
            pieces.append((current, False))
        assert len(pieces) == len(r["doc_ids"])
        for d, (p, _) in zip(r["doc_ids"], pieces):
            parts[d].append(p)
    total, ends = Counter(), defaultdict(Counter)
    for d, t in want:
        total[d] += want[(d, t)] * len(t)
        for x in t:
            ends[d][x] += want[(d, t)]
    for d in total:
        assert Counter(x for p in parts[d] for x in p) == ends[d]


def test_pieces_are_the_tokens_of_the_text():
    import tiktoken

    from quire.llm import kernel as K, token_output as T
    ranks = T.load_ranks(T.VOCABULARY)
    plain = tiktoken.Encoding("plain", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["a  b c", " lead and trail ", "x  y z  w", "it's  don't\n\n  stop", "é à ê 中文 字 b", "tab\t here", "", " ", "a b", "end ", "日本 a 日本"]
    tok, rng = T.PieceTokenizer(ranks), np.random.default_rng(5)
    texts += ["".join(rng.choice(list("ab é \n\t'.1 中"), 60)) for _ in range(200)]
    column = pa.array(texts)
    for _ in range(2):
        for a, b, buf, offsets in K.text_slices(column, 500):
            ids, per_row = tok.tokens(buf, offsets)
            for t, own in zip(texts[a:b], np.split(ids, np.cumsum(per_row)[:-1])):
                assert own.tolist() == [*plain.encode_ordinary(t), tok.end]


def test_feistel_is_a_permutation():
    from quire.llm.token_output import feistel_slots
    for n in (1, 2, 3, 17, 1000, 4097):
        assert sorted(feistel_slots(np.arange(n), n, 99).tolist()) == list(range(n))
    assert feistel_slots(np.arange(1000), 1000, 1).tolist() != feistel_slots(np.arange(1000), 1000, 2).tolist()


def test_pieces_are_encoded_once():
    """A corpus of more distinct pieces than 65,536 does not start the store anew again and again."""
    import numpy as np

    from quire.llm.token_output import VOCABULARY, PieceTokenizer, load_ranks
    tokenizer, asked = PieceTokenizer(load_ranks(VOCABULARY)), []
    encode = tokenizer.encode
    tokenizer.encode = lambda text: asked.append(text) or encode(text)
    batches = [" ".join(f"w{i}" for i in range(a, a + 40_000)) for a in (0, 40_000, 80_000)] * 2
    for text in batches:
        buf = np.frombuffer(text.encode(), np.uint8)
        ids, per_row = tokenizer.tokens(buf, np.array([0, len(buf)]))
        assert ids[:-1].tolist() == encode(text) and per_row.tolist() == [len(ids)]
    assert len(asked) == len(set(asked))
