"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

One pass over the texts finds base spans (strict patterns of e-mail addresses,
IP addresses, card and phone numbers) and wider candidates (obfuscated or
loosely written forms), and asks four labelers about each: the strict pattern,
the well-formedness of its digits or names, a gazetteer, and cue words before
it.  What remains of a candidate is its vote pattern and a few coarse features,
so counts of patterns over all documents are a complete and bounded summary.
Expectation-maximisation over these counts estimates how reliable each labeler
is; the resulting probabilities train a logistic span classifier, which also
sees the features, and it decides on the candidates that are not base spans.

Edge cases: null and empty texts have no spans; no candidates at all: nothing
is trained and nothing added; spans are code points, end exclusive; rows that
repeat an id are handled each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import materialise

KINDS = ("email", "ip", "card", "phone")

# Each pattern matches at the same places as the plain one of the contract; the look-behinds and
# possessive repeats only keep long runs from being tried again from every character.
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NON_DIGIT = re.compile("[^0-9]+")

# Looser forms of the four kinds, cue words and gazetteers.
_WIDE = (
    re.compile(r"\b[A-Za-z0-9_-]{1,64}(?:\.[A-Za-z0-9_-]{1,64}){0,3} ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\.) ?[A-Za-z]{2,24}){1,3}\b"),
    re.compile(r"\b[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}\b"),
    re.compile(r"\b[0-9]{4}(?:[./_][0-9]{4}){3}\b"),
    re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])"),
)
_CUES = (
    re.compile(r"e-?mail|mailto|contact|write to|adresse|correo|courriel", re.I),
    re.compile(r"\bip\b|address|host|server|ping|login from", re.I),
    re.compile(r"card|visa|master|amex|karte|carte|tarjeta|payment", re.I),
    re.compile(r"phone|tel\b|call|mobile|fax|telefon|tél|teléfono|whatsapp", re.I),
)
_MAIL_ENDS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "nl", "ch", "at")
_CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "38")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            last = m.end()
            yield start, last


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    found = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _NON_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NON_DIGIT.sub("", m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def _wide_spans(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    digits = _DIGIT.search(text) is not None
    taken = [(s, e) for s, _, e in base]
    for kind, pattern in enumerate(_WIDE):
        if not (digits if kind else ("at)" in text or "at]" in text or "at}" in text)):
            continue
        for m in pattern.finditer(text):
            if not any(s < m.end() and m.start() < e for s, e in taken):
                yield m.start(), kind, m.end()


def _votes(text: str, start: int, kind: int, end: int, strict: bool) -> tuple[int, ...]:
    """1 for, 0 against, 2 no opinion: strict pattern, form, gazetteer, cue words."""
    span = text[start:end]
    digits = _NON_DIGIT.sub("", span)
    if kind == 0:
        form = 1 if re.search(r"[A-Za-z]", span[:2]) else 0
        listed = 1 if span.rsplit(".", 1)[-1].rsplit(" ", 1)[-1].lower().endswith(_MAIL_ENDS) else 2
    elif kind == 1:
        parts = [int(p) for p in re.findall("[0-9]{1,9}", span)]
        form = int(len(parts) == 4 and max(parts) <= 255)
        listed = 0 if parts[:1] == [0] else 2
    elif kind == 2:
        form, listed = int(_luhn(digits)), 1 if digits.startswith(_CARD_STARTS) else 0
    else:
        form = int(9 <= len(digits) <= 15)
        listed = 0 if digits[:1] == "0" and not strict else (1 if "(" in span or span.startswith("+") else 2)
    return int(strict), form, listed, 1 if _CUES[kind].search(text, max(0, start - 40), start) else 2


def _pattern(votes: tuple[int, ...], span: str) -> int:
    """Votes (base 3) and two coarse features: length class and whether the span has white space or brackets."""
    code = 0
    for v in votes:
        code = code * 3 + v
    return (code * 4 + min(3, len(span) // 8)) * 2 + any(c in " ()[]{}" for c in span)


def _features(kind: int, pattern: int) -> list[float]:
    code, length, spaced = pattern // 8, pattern // 2 % 4, pattern % 2
    votes = [code // 3 ** k % 3 for k in (3, 2, 1, 0)]
    return [1.0, *(float(kind == k) for k in range(1, 4)), *(float(v == 1) for v in votes), *(float(v == 0) for v in votes),
            length / 3.0, float(spaced)]


_FOUND = ("id long, n_email long, n_ip long, n_card long, n_phone long, base string, base_sha256 string, "
          "cands array<struct<s:int,kind:int,e:int,base:boolean,pattern:int>>")


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cand = pa.list_(pa.struct([("s", pa.int32()), ("kind", pa.int32()), ("e", pa.int32()), ("base", pa.bool_()), ("pattern", pa.int32())]))
    for batch in batches:
        counts, joined, shas, cands = [[], [], [], []], [], [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            base = base_spans(text)
            for k in range(4):
                counts[k].append(sum(1 for _, kind, _ in base if kind == k))
            joined.append(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base))
            shas.append(hashlib.sha256(joined[-1].encode()).hexdigest())
            every = [(s, k, e, True) for s, k, e in base] + [(s, k, e, False) for s, k, e in _wide_spans(text, base)]
            cands.append([{"s": s, "kind": k, "e": e, "base": b, "pattern": _pattern(_votes(text, s, k, e, b), text[s:e])} for s, k, e, b in every])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(joined, pa.string()), pa.array(shas, pa.string()), pa.array(cands, cand)],
            names=["id", "n_email", "n_ip", "n_card", "n_phone", "base", "base_sha256", "cands"])


def reliabilities(patterns: list[tuple[int, int, int]], rounds: int = 200) -> np.ndarray:
    """EM over (kind, pattern, count): the probability that a span of each row is personal data.

    Two classes; given the class, labelers vote independently, with one table of
    vote probabilities per labeler.  Starts from the share of votes in favour.
    """
    votes = np.array([[p // 8 // 3 ** k % 3 for k in (3, 2, 1, 0)] for _, p, _ in patterns])
    n = np.array([c for _, _, c in patterns], float)
    for_, against = (votes == 1).sum(axis=1), (votes == 0).sum(axis=1)
    q = (for_ + 1.0) / (for_ + against + 2.0)
    for _ in range(rounds):
        prior = np.clip((n * q).sum() / n.sum(), 1e-6, 1 - 1e-6)
        odds = np.full(len(n), np.log(prior / (1 - prior)))
        for lab in range(4):
            yes = np.array([(n * q * (votes[:, lab] == v)).sum() + 1.0 for v in range(3)])
            no = np.array([(n * (1 - q) * (votes[:, lab] == v)).sum() + 1.0 for v in range(3)])
            odds += np.log(yes / yes.sum())[votes[:, lab]] - np.log(no / no.sum())[votes[:, lab]]
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        done = np.abs(new - q).max() < 1e-10
        q = new
        if done:
            break
    return q


def train_classifier(patterns: list[tuple[int, int, int]]) -> dict[tuple[int, int], float]:
    """Span classifier (logistic, Newton steps) trained on EM's probabilities; its output by (kind, pattern)."""
    if not patterns:
        return {}
    q = reliabilities(patterns)
    x = np.array([_features(k, p) for k, p, _ in patterns])
    n = np.array([c for _, _, c in patterns], float)
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (n * (q - p)) - 0.1 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return {(k, pat): float(v) for (k, pat, _), v in zip(patterns, p)}


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per document: id_col, n_email, n_ip, n_card, n_phone (base spans), base_spans, base_sha256, spans (all)."""
    found = materialise(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
                        .mapInArrow(_find, _FOUND), "pii")
    counts = (found.select(F.explode("cands").alias("c")).groupBy("c.kind", "c.pattern").agg(F.count("*").alias("n"))
              .orderBy("kind", "pattern").collect())            # bounded by the number of patterns
    accepted = [k << 16 | p for (k, p), v in train_classifier([tuple(r) for r in counts]).items() if v >= least]
    listed = F.array(*map(F.lit, accepted)) if accepted else F.array().cast("array<int>")
    chosen = F.filter("cands", lambda c: c["base"] | F.array_contains(listed, F.shiftleft(c["kind"], 16).bitwiseOR(c["pattern"])))
    names = F.array(*map(F.lit, KINDS))
    spans = F.array_join(F.transform(F.array_sort(chosen), lambda c: F.concat_ws(
        ":", F.get(names, c["kind"]), c["s"].cast("string"), c["e"].cast("string"))), ",")
    any_wide = F.exists("cands", lambda c: ~c["base"])
    return found.select(F.col("id").alias(id_col), "n_email", "n_ip", "n_card", "n_phone", F.col("base").alias("base_spans"), "base_sha256",
                        F.when(any_wide, spans).otherwise(F.col("base")).alias("spans"))
