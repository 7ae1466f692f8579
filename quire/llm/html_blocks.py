"""HTML into leaf blocks with their tag paths (one scan over the tags, no tree)."""

from __future__ import annotations

import html
import re

# Element sets of the HTML standard.
#: their content is no markup; without an end tag it reaches to the end of the page
RAW = "script|style|noscript|iframe|textarea|title"
#: dropped with their content; without an end tag they are elements like others, so that nothing after them is lost
DROPPED = "template|svg|object|canvas|select|datalist|button|annotation|annotation-xml"
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output picture progress q "
                   "rp rt ruby s samp small span strike strong sub sup time tt u var wbr br input acronym map area audio video source track "
                   "math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover mtable mtr mtd "
                   "mpadded mphantom menclose".split())
HEAD = frozenset("html head title meta link base script style noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: an open element of the key's kind ends where an element of the value's kinds starts
ENDED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
                   "main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]), "optgroup": frozenset(["optgroup"]),
}

_ATTRIBUTES = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:svg|math)(?=[\s/>]){_ATTRIBUTES}(?<=/)>"
    rf"|<(?P<raw>{RAW})(?=[\s/>]){_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<xmp(?=[\s/>]){_ATTRIBUTES}>(?P<xmp>.*?)(?:</xmp\s*>|\Z)"
    rf"|<(?P<dropped>{DROPPED})(?=[\s/>]){_ATTRIBUTES}>.*?</(?P=dropped)\s*>"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>{_ATTRIBUTES})>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest2>[^>]*)>|<[!?][^>]*>|<[/!?a-zA-Z][^>]*\Z", re.S | re.I)
_NAMED = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _names(rest: str) -> tuple[str, ...]:
    out: list[str] = []
    for m in _NAMED.finditer(rest):
        out += [p.lower() for p in _PART.findall(m[1] or m[2] or m[3] or "")]
    return tuple(out)


class Block:
    __slots__ = ("path", "text", "link_chars")

    def __init__(self, path, text, link_chars):
        self.path, self.text, self.link_chars = path, text, link_chars


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order: path (tags, and parts of class, id and role names), text, characters inside links."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    link_chars, in_link, start_path = 0, 0, None

    def path():
        return tuple((t, names) for t, names in stack if t not in INLINE)

    def flush():
        nonlocal pieces, link_chars, start_path
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(start_path, text, link_chars))
            pieces, link_chars, start_path = [], 0, None

    def leave_head():
        at = next((i for i, (t, _) in enumerate(stack[:2]) if t == "head"), None)
        if at is not None:
            del stack[at:]

    def data(text):
        nonlocal link_chars, start_path
        if text and not text.isspace():
            leave_head()                          # text cannot stand in it: its end tag was left out
        if start_path is None:
            if not text or text.isspace():
                return
            start_path = path()
        pieces.append(text)
        if in_link:
            link_chars += len(text)

    last = 0
    for m in _TOKEN.finditer(page):
        data(html.unescape(page[last:m.start()]))      # a reference ends where its text does
        last = m.end()
        if m["xmp"] is not None:
            flush()
            stack.append(("xmp", ()))
            data(m["xmp"])
            flush()
            stack.pop()
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if tag == "br" and pieces:
            pieces.append(" ")
        if tag not in INLINE:
            flush()
        if m["close"] or m["close2"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if tag in INLINE and stack[i][0] not in INLINE:
                    break
            if tag == "a" or tag not in INLINE:
                in_link = sum(t == "a" for t, _ in stack)
            continue
        if tag not in HEAD:
            leave_head()
        if tag in VOID:
            continue
        if tag not in INLINE:
            while stack and (stack[-1][0] in INLINE or tag in ENDED_BY.get(stack[-1][0], ())):
                inner = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE), -1)
                if inner >= 0 and tag in ENDED_BY.get(stack[inner][0], ()):
                    del stack[inner:]
                else:
                    break
            in_link = sum(t == "a" for t, _ in stack)
        stack.append((tag, _names(m["rest"] or m["rest2"] or "")))
        in_link += tag == "a"
    data(html.unescape(page[last:]))
    flush()
    return out
