"""Text column expressions.

All functions return native Spark ``Column`` expressions (regex and
higher-order array functions), so they stay inside whole-stage codegen and
never leave the JVM.  Regexes avoid ``\\w`` / ``\\d`` because Java's are
ASCII-only; the explicit Unicode classes below match the reference's
Python semantics.

``script`` is a character-class body naming the letters of the corpus
language, e.g. the Hebrew block ``\\x{0590}-\\x{05FF}`` (the reference
default) or ``\\p{L}`` for Latin test text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference ---------------------------
HEBREW_BLOCK = r"\x{0590}-\x{05FF}"          # letter range used by the corpus rules
HEBREW_ALEF_TAV = r"\x{05D0}-\x{05EA}"       # letter range used by the word tokenizer
SENTENCE_END = ".!?:"                        # characters that may close a sentence
CURRENCY = "$₪€£"                            # optional number prefixes
# titles that make a speaker prefix valid
TITLE_KEYWORDS = ["יושב ראש", "חבר הכנסת", "חברת הכנסת", "שר", "שרה", "ראש הממשלה",
                  "נשיא", "סגן", "מזכיר", "מזכירה", "יו\"ר"]
# artefact substrings removed from lyrics before cleaning
LYRIC_ARTEFACTS = ["urlcopy", "embedshare", "dadadydowre", "chapiners"]
# ---------------------------------------------------------------------------

WORD = r"\p{L}\p{N}_"                        # Python's Unicode \w
DIGIT = r"\p{Nd}"                            # Python's Unicode \d

# A sentence ends at the first end mark once the stripped chunk is longer than
# one character; the non-empty tail is a sentence too.
# (possessive runs instead of a lazy one: a step per character, no choices kept)
SENTENCE_RE = r"\s*+\S[^.!?:]*+[.!?:]|\s*+\S[\s\S]*+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: Spark ``trim`` only removes blanks."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def split_sentences(text) -> Column:
    """Array of stripped sentences in text order."""
    return F.transform(F.regexp_extract_all(_c(text), F.lit(SENTENCE_RE), 0), strip)


def token_pattern(script: str = HEBREW_BLOCK) -> str:
    """T3 alternation in the reference's order (first alternative wins)."""
    s = script
    parts = [
        f"[{s}]+",                                        # script letters
        f"[^{WORD}{s}\\s]",                               # punctuation mark
        f"[{CURRENCY}]?{DIGIT}+(?:\\.{DIGIT}+)?%?",       # number, optional % / currency
        r"https?://\S+|www\.\S+",                         # URL
        f"[{WORD}.+-]+@[{WORD}]+\\.[{WORD}]+",            # e-mail
        r"\([^()]*\)",                                    # parenthesised text
        f"[{s}]+(?:-[{s}]+)*",                            # hyphenated words
        f"\\b(?:[{s}]\\.){{2,}}",                         # abbreviation
    ]
    return "(" + "|".join(parts) + ")"


def tokenize(sentence, script: str = HEBREW_BLOCK) -> Column:
    """Ordered regex tokens of a sentence.

    No alternative can match blanks only, so the reference's final
    ``token.strip()`` filter never removes anything and is not repeated here.
    """
    return F.regexp_extract_all(_c(sentence), F.lit(token_pattern(script)), 0)


def valid_sentence(sentence, script: str = HEBREW_BLOCK) -> Column:
    """Has a script letter, is not only punctuation words, no ``...``/``---``."""
    s = _c(sentence)
    has_script = s.rlike(f"[{script}]")
    all_punct = s.rlike(r"\S") & ~s.rlike(f"[{WORD}{script}]")
    incomplete = s.contains("...") | s.contains("---")
    return has_script & ~all_punct & ~incomplete


def whitespace_token_count(text) -> Column:
    """P11 helper: number of blank-separated tokens (Python ``len(s.split())``)."""
    return F.size(F.filter(F.split(_c(text), r"\s+"), lambda t: t != ""))


def words_pattern(script: str = HEBREW_ALEF_TAV) -> str:
    s = script
    return f'"[^"]+"|[{s}]+"[{s}]+|[{s}]+\'[{s}]+|[{s}]+'


def tokenize_words(sentence, script: str = HEBREW_ALEF_TAV) -> Column:
    """T4: quoted text / word"word / word'word / word; strip quotes; drop length 1."""
    toks = F.regexp_extract_all(_c(sentence), F.lit(words_pattern(script)), 0)
    toks = F.transform(toks, lambda t: F.regexp_replace(t, r'^"+|"+$', ""))
    return F.filter(toks, lambda t: F.length(t) > 1)


def tokenize_script_only(sentence, script: str = HEBREW_BLOCK) -> Column:
    """T5: blank split, delete characters outside the script, drop length <= 1."""
    parts = F.filter(F.split(_c(sentence), r"\s+"), lambda t: t != "")
    parts = F.transform(parts, lambda t: F.regexp_replace(t, f"[^{script}]", ""))
    return F.filter(parts, lambda t: F.length(t) > 1)


def speaker_prefix(text, script: str = HEBREW_BLOCK) -> Column:
    """Raw speaker group of ``^([script blanks ()"'`]+):`` or '' when absent."""
    return F.regexp_extract(_c(text), f"^([{script}\\s()\"'`]+):", 1)


def clean_speaker(raw) -> Column:
    name = strip(raw)
    name = F.regexp_replace(name, r"\s*\(.*?\)", "")
    return F.regexp_replace(name, "[\"']", "")


def extract_speaker(text, script: str = HEBREW_BLOCK, unknown: str = "Unknown Speaker",
                    keywords: list[str] | None = None) -> Column:
    """Cleaned speaker name, or ``unknown`` when absent or invalid."""
    raw = speaker_prefix(text, script)
    name = clean_speaker(raw)
    kws = TITLE_KEYWORDS if keywords is None else keywords
    has_kw = F.lit(False)
    for k in kws:
        has_kw = has_kw | name.contains(k)
    only_script = name.rlike(f"^[{script}\\s]+$")
    return F.when((raw != "") & (has_kw | only_script), name).otherwise(F.lit(unknown))


def spoken_text(text, speaker, script: str = HEBREW_BLOCK, mode: str = "colon") -> Column:
    """Text after the speaker prefix.

    ``mode='colon'`` cuts after the matched colon; ``mode='reference'`` cuts at
    ``len(cleaned name) + 1`` like the reference (leaves a remnant when the
    cleaning removed characters).
    """
    t = _c(text)
    if mode == "reference":
        cut = F.length(_c(speaker)) + 2
    elif mode == "colon":
        cut = F.length(F.regexp_extract(t, f"^[{script}\\s()\"'`]+:", 0)) + 1
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return strip(F.substring(t, cut, 1 << 30))


def file_knesset_number(name) -> Column:
    """``(\\d+)_pt`` -> number, else -1."""
    v = F.regexp_extract(_c(name), r"(\d+)_pt", 1)
    return F.when(v == "", F.lit(-1)).otherwise(v.cast("int"))


def file_protocol_type(name) -> Column:
    """``ptm`` -> plenary, ``ptv`` -> committee, else undefined."""
    n = _c(name)
    return (F.when(n.contains("ptm"), "plenary")
            .when(n.contains("ptv"), "committee")
            .otherwise("undefined"))


def clean_lyrics(text, artefacts: list[str] | None = None) -> Column:
    """Lower, drop artefacts, keep a-z and blanks, squeeze and strip blanks."""
    t = F.lower(_c(text))
    for a in (LYRIC_ARTEFACTS if artefacts is None else artefacts):
        t = F.replace(t, F.lit(a), F.lit(""))
    t = F.regexp_replace(t, r"[^a-z\s]", "")
    return strip(F.regexp_replace(t, r"\s+", " "))


def rewrite_marker(text, old: str = "[*]", new: str = "[MASK]") -> Column:
    """T15."""
    return F.replace(_c(text), F.lit(old), F.lit(new))


def fill_markers(text, predictions, marker: str = "[*]") -> Column:
    """Put predictions into the markers left to right (one each)."""
    pieces = F.split(_c(text), _regex_quote(marker), -1)
    preds = _c(predictions)
    filled = F.transform(
        pieces,
        lambda p, i: F.when(i == 0, p).otherwise(
            F.concat(F.coalesce(F.element_at(preds, i), F.lit(marker)), p)))
    return F.array_join(filled, "")


def response_label(answer) -> Column:
    """T19: 'Positive' when the answer mentions positive, else 'Negative'."""
    return F.when(F.lower(_c(answer)).contains("positive"), "Positive").otherwise("Negative")


def punctuation_features(text) -> dict[str, Column]:
    """Word count and counts of , . quotes - ?"""
    t = _c(text)

    def cnt(pat: str) -> Column:
        return F.size(F.regexp_extract_all(t, F.lit(pat), 0)).cast("bigint")

    return {
        "sentence_length": whitespace_token_count(t).cast("bigint"),
        "commas": cnt(","),
        "period": cnt(r"\."),
        "quotations": cnt("\"") + cnt("'"),
        "dashes": cnt("-"),
        "question": cnt(r"\?"),
    }


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)
