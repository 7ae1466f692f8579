"""Main text of HTML pages by a recurrent block labeller.

A page is read as its sequence of leaf blocks.  Each block is a vector: hashed
tag-path parts (tags, and parts of class, id and role names, with their
prefixes), hashed words, and a few numbers (length, link share, position).  A
bidirectional LSTM in numpy reads the whole sequence in both directions, so
every block is classified in the context of its document, and the blocks
called content are joined.

The labeller is trained once per driver process by gradient descent on pages
that a seeded generator lays out from content and boilerplate regions (menus,
headers, footers, sidebars, notices, adverts, forms, comments, related links)
with varying elements, names, order and omissions; the words are drawn at
random, so only layout, form and context tell the classes apart.  The
generator's size is ``TRAINING_PAGES``.

Edge cases: null and empty pages, and pages without content blocks, give the
empty text; unclosed and broken markup ends where the page ends; rows that
repeat are handled each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import kernel as K
from quire.llm.common import share, shared
from quire.llm.html_blocks import Block, blocks

PATH, WORDS, NUMBERS, HIDDEN = 48, 8, 8, 20
TRAINING_PAGES, EPOCHS, BATCH = 480, 14, 24
#: blocks of one LSTM run over pages of similar length
RUN_BLOCKS = 8192

# Names that web pages give their regions.
BOILERPLATE = {
    "menu": (["nav", "div", "ul"], "nav navbar menu navigation topnav mainmenu breadcrumb breadcrumbs tabs".split()),
    "header": (["header", "div"], "header masthead banner topbar sitename logo branding siteheader".split()),
    "footer": (["footer", "div"], "footer bottom copyright legal colophon sitefooter imprint".split()),
    "sidebar": (["aside", "div", "section"], "sidebar side aside widget rail secondary popular trending tags".split()),
    "notice": (["div", "section", "p"], "cookie consent notice alert banner gdpr popup modal newsletter subscribe paywall message".split()),
    "advert": (["div", "aside", "section", "ins"], "ad ads advert advertisement sponsor sponsored promo adsbygoogle promotion banner".split()),
    "form": (["form", "div"], "search login form signup contact subscribe searchform".split()),
    "comments": (["section", "div", "ol"], "comments comment discussion replies responses disqus commentlist respond".split()),
    "related": (["div", "section", "aside"], "related recommended share social more readmore links author pagination pager".split()),
}
CONTENT = (["article", "main", "div", "section"], "content article post entry main story body text page articlebody entrycontent postbody".split())


@lru_cache(maxsize=1 << 16)
def _hashed(token: str, size: int) -> np.ndarray:
    """Fixed random signs of a token."""
    seed = np.uint64(zlib.crc32(token.encode())) + np.uint64(1)
    bits = K.mix64(np.full(size, seed) * np.uint64(0x9E3779B97F4A7C15) + np.arange(size, dtype=np.uint64))
    return np.where(bits & np.uint64(1), 1.0, -1.0) / np.sqrt(size)


@lru_cache(maxsize=1 << 14)
def _path_vector(path: tuple) -> np.ndarray:
    out = np.zeros(PATH)
    for depth, (tag, names) in enumerate(reversed(path)):
        near = 1.0 if depth < 2 else 0.8
        out += near * 2.0 * _hashed(f"tag:{tag}", PATH)
        for name in dict.fromkeys(names):
            out += near * 2.0 * _hashed(f"name:{name}", PATH)
            if len(name) > 4:
                out += near * _hashed(f"start:{name[:4]}", PATH)
    return out


def features(page_blocks: list[Block], sizes: list[int] | None = None) -> np.ndarray:
    """One row per block: tag-path vector, hashed-word vector, numbers.  ``sizes``: blocks of each page (default: one page)."""
    n = len(page_blocks)
    sizes = np.array([n] if sizes is None else sizes)
    out = np.zeros((n, PATH + WORDS + NUMBERS))
    raw = [b.text.encode() for b in page_blocks]
    offsets = np.cumsum([0, *map(len, raw)])
    buf = np.frombuffer(b"".join(raw), np.uint8)
    starts, ends, first = K.word_spans(buf, offsets)
    h = K.word_hashes(buf, starts, ends, lower=True)
    row = np.repeat(np.arange(n), np.diff(first))
    count = np.maximum(np.diff(first), 1)
    for k in range(WORDS):
        sign = np.where((h >> np.uint64(k)) & np.uint64(1), 1.0, -1.0)
        out[:, PATH + k] = np.bincount(row, weights=sign, minlength=n) / count
    paths: dict[tuple, int] = {}
    which = [paths.setdefault(b.path, len(paths)) for b in page_blocks]
    out[:, :PATH] = np.stack([_path_vector(p) for p in paths])[which]
    size = np.array([len(b.text) for b in page_blocks], float)
    links = np.array([b.link_chars for b in page_blocks], float)
    ended = np.array([b.text[-1] in ".!?…:;\"'»”)" for b in page_blocks], float)
    of_page = np.repeat(sizes, sizes)
    place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[:, PATH + WORDS:] = np.stack([np.log1p(size) / 5 - 1, np.minimum(1.0, links / np.maximum(1, size)), ended, place / of_page,
                                      (of_page - place) / of_page, 1.0 / (1 + place), size > 80, np.log1p(of_page) / 5], axis=1)
    return out


class Labeller:
    """Bidirectional LSTM with a logistic output, in numpy."""

    def __init__(self, inputs: int, hidden: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for d in "fb":
            self.p["W" + d] = rng.normal(0, 1 / np.sqrt(inputs + hidden), (inputs + hidden, 4 * hidden))
            self.p["b" + d] = np.concatenate([np.ones(hidden), np.zeros(3 * hidden)])
        self.p["V"] = rng.normal(0, 1 / np.sqrt(2 * hidden), 2 * hidden + inputs)
        self.p["c"] = np.zeros(1)

    def _direction(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """x: time, batch, inputs in reading order; a masked step leaves the state as it is."""
        steps, batch, _ = x.shape
        hsz, w, bias = self.hidden, self.p["W" + d], self.p["b" + d]
        n_in = x.shape[2]
        pre = x.reshape(-1, n_in) @ w[:n_in] + bias
        pre = pre.reshape(steps, batch, -1)
        h, c = np.zeros((batch, hsz)), np.zeros((batch, hsz))
        out, tape = np.zeros((steps, batch, hsz)), []
        for t in range(steps):
            z = pre[t] + h @ w[n_in:]
            gate = 1 / (1 + np.exp(-z[:, :3 * hsz]))
            f, i, o, g = gate[:, :hsz], gate[:, hsz:2 * hsz], gate[:, 2 * hsz:], np.tanh(z[:, 3 * hsz:])
            new_c = f * c + i * g
            tc = np.tanh(new_c)
            m = mask[t][:, None]
            if keep:
                tape.append((h, c, f, i, o, g, tc, m))
            h, c = m * (o * tc) + (1 - m) * h, m * new_c + (1 - m) * c
            out[t] = h
        return out, tape

    def _logits(self, x, mask, keep=False):
        fw, tf = self._direction(x, mask, "f", keep)
        bw, tb = self._direction(x[::-1], mask[::-1], "b", keep)
        top = np.concatenate([fw, bw[::-1], x], axis=2)
        return top @ self.p["V"] + self.p["c"][0], top, tf, tb

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self._logits(x, mask)[0]))

    def _back(self, x, dh_out, tape, d, grad):
        hsz, w, n_in = self.hidden, self.p["W" + d], x.shape[2]
        dh, dc = np.zeros_like(dh_out[0]), np.zeros_like(dh_out[0])
        for t in range(len(tape) - 1, -1, -1):
            h, c, f, i, o, g, tc, m = tape[t]
            dh = dh + dh_out[t]
            dho, dco = dh * m, dc * m
            do = dho * tc
            dct = dho * o * (1 - tc * tc) + dco
            dz = np.concatenate([dct * c * f * (1 - f), dct * g * i * (1 - i), do * o * (1 - o), dct * i * (1 - g * g)], axis=1)
            grad["W" + d][:n_in] += x[t].T @ dz
            grad["W" + d][n_in:] += h.T @ dz
            grad["b" + d] += dz.sum(axis=0)
            dh = dz @ w[n_in:].T + dh * (1 - m)
            dc = dct * f + dc * (1 - m)

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, batch: int = BATCH, rate: float = 0.01, seed: int = 11):
        """Adam on the mean logistic loss per block."""
        rng = np.random.default_rng(seed)
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, hsz = 0, self.hidden
        for epoch in range(epochs):
            order = rng.permutation(len(pages))
            order = order[np.argsort([len(pages[i][1]) + rng.random() * 8 for i in order], kind="stable")]
            groups = [order[a:a + batch] for a in range(0, len(order), batch)]
            for g in rng.permutation(len(groups)):
                x, mask, y = _padded([pages[i] for i in groups[g]])
                z, top, tf, tb = self._logits(x, mask, keep=True)
                dz = (1 / (1 + np.exp(-z)) - y) * mask / mask.sum()
                grad = {k: np.zeros_like(v) for k, v in self.p.items()}
                grad["V"] = (top * dz[:, :, None]).sum(axis=(0, 1))
                grad["c"][0] = dz.sum()
                self._back(x, dz[:, :, None] * self.p["V"][:hsz], tf, "f", grad)
                self._back(x[::-1], (dz[:, :, None] * self.p["V"][hsz:2 * hsz])[::-1], tb, "b", grad)
                step += 1
                lr = rate * (1 - 0.9 * epoch / epochs)
                for k, v in self.p.items():
                    gk = np.clip(grad[k], -1, 1)
                    m1[k] = 0.9 * m1[k] + 0.1 * gk
                    m2[k] = 0.999 * m2[k] + 0.001 * gk * gk
                    v -= lr * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def _padded(pages):
    steps = max(len(x) for x, _ in pages)
    x = np.zeros((steps, len(pages), pages[0][0].shape[1]))
    mask, y = np.zeros((steps, len(pages))), np.zeros((steps, len(pages)))
    for k, (f, label) in enumerate(pages):
        x[:len(f), k], mask[:len(f), k], y[:len(f), k] = f, 1, label
    return x, mask, y


class _Generator:
    """Pages of random layout, each block with its class."""

    def __init__(self, seed: int = 3):
        self.rng = np.random.default_rng(seed)
        self.words = ["".join(self.rng.choice(list("abcdefghilmnoprstuv"), self.rng.integers(2, 9))) for _ in range(600)]

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p):
        return self.rng.random() < p

    def sentence(self, lo, hi):
        s = " ".join(self.pick(self.words) for _ in range(int(self.rng.integers(lo, hi))))
        return s.capitalize() + (self.pick([".", ".", ".", "!", "?"]) if hi > 6 or self.chance(0.3) else "")

    def paragraph(self):
        return " ".join(self.sentence(4, 18) for _ in range(int(self.rng.integers(1, 6))))

    def names(self, pool, p):
        if not self.chance(p):
            return ""
        own = self.pick(pool)
        if self.chance(0.3):
            own = self.pick([own + "-" + self.pick(["box", "area", "wrap", "list", "inner", "1", "top"]), "site-" + own, own + " " + self.pick(pool)])
        return f' {self.pick(["class", "class", "id"])}="{own}"'

    def region(self, kind):
        tags, pool = BOILERPLATE[kind]
        tag = self.pick(tags)
        attr = self.names(pool, 1.0 if tag in ("div", "section", "ol", "ul", "p") else 0.5)
        body, out = [], []
        if kind in ("menu", "related") and self.chance(0.8) or kind == "footer" and self.chance(0.3):
            out = [self.sentence(1, 4) for _ in range(int(self.rng.integers(2, 9)))]
            body = ["<ul>", *(f'<li><a href="/x">{t}</a></li>' for t in out), "</ul>"] if tag != "ul" else [f'<li><a href="/x">{t}</a></li>' for t in out]
        elif kind == "comments":
            for _ in range(int(self.rng.integers(1, 5))):
                out += [self.sentence(1, 3), self.paragraph()]
                body.append(f'<div{self.names(["comment", "reply", "vcard"], 0.6)}><h4>{out[-2]}</h4><p>{out[-1]}</p></div>')
        elif kind in ("advert", "notice", "footer", "header") and self.chance(0.6) or tag == "p":
            out = [self.sentence(2, 14)]
            body = [out[0]]
        else:
            if self.chance(0.5):
                out.append(self.sentence(1, 4))
                body.append(f"<h3>{out[-1]}</h3>")
            for _ in range(int(self.rng.integers(1, 4))):
                out.append(self.sentence(2, 20))
                body.append(f"<p>{out[-1]}</p>")
        return f"<{tag}{attr}>{''.join(body)}</{tag}>", [0] * len(out)

    def article(self):
        tag = self.pick(CONTENT[0] + ["article", "article"])
        attr = self.names(CONTENT[1], 0.3 if tag in ("article", "main") else 1.0)
        body, labels = [], []
        if self.chance(0.85):
            body.append(f"<h1>{self.sentence(3, 9)}</h1>")
            labels.append(1)
        for _ in range(int(self.rng.integers(1, 14))):
            roll = self.rng.random()
            if roll < 0.68:
                lead = self.pick(["<p>", "<p>", "<p>", "<p><b>"])
                body.append(f"{lead}{self.paragraph() if self.chance(0.8) else self.sentence(1, 5)}{self.pick(['</p>', '</p>', '<br>'])}")
                labels.append(1)
            elif roll < 0.78:
                body.append(f"<h2>{self.sentence(2, 6)}</h2>")
                labels.append(1)
            elif roll < 0.86:
                n = int(self.rng.integers(2, 5))
                body.append("<ul>" + "".join(f"<li>{self.sentence(3, 12)}</li>" for _ in range(n)) + "</ul>")
                labels += [1] * n
            elif roll < 0.92:
                body.append(f"<blockquote>{self.paragraph()}</blockquote>")
                labels.append(1)
            else:
                part, own = self.region(self.pick(["advert", "related", "notice", "advert"]))
                body.append(part)
                labels += own
        return f"<{tag}{attr}>{''.join(body)}</{tag}>", labels

    def page(self):
        parts, labels = ["<html><head><title>t</title></head><body>"], []
        def put(p, kind):
            if self.chance(p):
                part, own = self.region(kind)
                parts.append(part)
                labels.extend(own)
        for p, kind in ((0.3, "notice"), (0.4, "header"), (0.75, "menu"), (0.4, "advert"), (0.25, "sidebar"), (0.15, "form")):
            put(p, kind)
        if self.chance(0.97):
            part, own = self.article()
            if self.chance(0.25):
                part = f"<main>{part}</main>"
            parts.append(part)
            labels.extend(own)
        for p, kind in ((0.3, "related"), (0.35, "comments"), (0.3, "sidebar"), (0.2, "advert"), (0.15, "form"), (0.75, "footer"), (0.1, "notice")):
            put(p, kind)
        return "".join(parts) + "</body></html>", np.array(labels, float)


_trained: dict[int, Labeller] = {}


def labeller(pages: int = TRAINING_PAGES) -> Labeller:
    """The trained labeller (kept for the life of the driver process)."""
    if pages not in _trained:
        make, data = _Generator(), []
        for _ in range(pages):
            page, labels = make.page()
            own = blocks(page)
            if own and len(own) == len(labels):
                data.append((features(own), labels))
        _trained[pages] = Labeller(PATH + WORDS + NUMBERS, HIDDEN).train(data)
    return _trained[pages]


def main_texts(model: Labeller, pages: list[str | None]) -> list[str]:
    """The content blocks of each page, joined by line feeds."""
    parsed = [blocks(p) for p in pages]
    order = sorted((i for i, b in enumerate(parsed) if b), key=lambda i: len(parsed[i]))
    out = [""] * len(pages)
    a = 0
    while a < len(order):
        b = a + 1
        while b < len(order) and (b + 1 - a) * len(parsed[order[b]]) <= RUN_BLOCKS:
            b += 1
        sizes = [len(parsed[i]) for i in order[a:b]]
        flat = features([block for i in order[a:b] for block in parsed[i]], sizes)
        x, mask, _ = _padded([(part, 0.0) for part in np.split(flat, np.cumsum(sizes)[:-1])])
        keep = model.probabilities(x, mask) >= 0.5
        for k, i in enumerate(order[a:b]):
            out[i] = "\n".join(block.text for block, on in zip(parsed[i], keep[:, k].tolist()) if on)
        a = b
    return out


def extract_text(pages: DataFrame, html_col: str = "html", model: Labeller | None = None) -> DataFrame:
    """``pages`` without the HTML column, with text and n_chars (code points); a map over the rows.

    Columns of ``pages`` named ``text`` or ``n_chars`` are replaced.  A null or
    empty page, or one without content, has the empty text; repeated rows stay.
    """
    sent = share(pages.sparkSession, model or labeller())
    kept = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html_col}`").cast("string").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared(sent)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                texts = main_texts(model, part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=[*part.schema.names[:-1], "text", "n_chars"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, text string, n_chars long" if schema else "text string, n_chars long")
