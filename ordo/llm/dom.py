"""A small tolerant reader of HTML into a tree of blocks, with node features.

Inline markup belongs to the text around it. Every run of text is one leaf; a
block that holds nothing but one run is that leaf itself. Scripts, styles,
titles, form fields and other elements without running text are skipped; labels
of buttons, formulas and what stands in for an object are text. Reading takes time in
proportion to the page, however it is broken.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections import Counter

import numpy as np

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*>"""
    r"""|<(?P<tag>[a-zA-Z][^\s/>]*)(?P<attr>(?:[^>"']|"[^"]*"|'[^']*')*+)>|<(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attr2>[^>]*)>""",
    re.S)
_ATTR = re.compile(r"""([a-zA-Z][\w:-]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# HTML element kinds.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small span "
    "strike strong sub sup time tt u var wbr button object math mi mo mn ms mtext mrow msup msub msubsup mfrac msqrt "
    "mroot mstyle mpadded mover munder munderover mtable mtr mtd merror semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template svg select canvas audio video "
                "annotation annotation-xml".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table body html article section div".split())

# Stems of attribute tokens that speak for and against running text.
FOR = ("article", "content", "post", "entry", "body", "main", "story", "text", "prose", "page")
AGAINST = (
    "advert", "sponsor", "promo", "banner", "cookie", "consent", "notice", "notif", "alert", "popup", "modal", "overlay",
    "newsletter", "subscri", "signup", "login", "comment", "reply", "replies", "respon", "discuss", "disqus", "share", "social",
    "related", "recommend", "sidebar", "side", "widget", "nav", "menu", "breadcrumb", "crumb", "header", "footer",
    "masthead", "topbar", "legal", "copyright", "form", "search", "toolbar", "pager", "pagination", "rail", "teaser",
    "trending", "popular", "tags", "gdpr", "privacy", "disclaimer", "feedback", "complementary", "contentinfo")
AGAINST_WHOLE = frozenset(("ad", "ads", "adv", "dfp", "foot", "head", "top"))

HEAD = frozenset("base basefont bgsound link meta title style script noscript noframes template head html".split())

GROUPS = {g: i for i, names in enumerate((
    "article main", "div section", "p", "h1 h2 h3 h4 h5 h6", "li dt dd", "ul ol dl menu dir", "nav", "aside", "header hgroup",
    "footer", "form fieldset legend input", "blockquote pre figure figcaption table tr td th tbody thead", "#text"))
    for g in names.split()}
TOKENS = 64  # buckets that attribute tokens are hashed into
FEATURES = len(set(GROUPS.values())) + 26 + 2 * TOKENS
_OPEN = re.compile(r"<[a-zA-Z/!?]")  # a tag that the page ends in
_SENTENCE = re.compile(r"[.!?,;](?=\s|$)")


class Page:
    """Blocks of a page as parallel lists, parents before children. ``text`` is
    set on leaves. ``mark`` is the value of the attribute ``k`` (training only)."""

    def __init__(self, source: str):
        self.tag, self.parent, self.attr, self.text, self.links, self.mark = ["body"], [-1], [""], [None], [0], [None]
        self.kids: list[list[int]] = [[]]
        self._read(source)
        self._fold()

    def _add(self, tag: str, parent: int, attr: str = "") -> int:
        n = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.attr.append(attr)
        self.text.append(None)
        self.links.append(0)
        self.mark.append(None)
        self.kids.append([])
        self.kids[parent].append(n)
        return n

    def _read(self, source: str) -> None:
        stack, run, pieces, link = [0], -1, [], 0
        at, size, head = 0, len(source), False
        last = source.rfind(">")       # no tag begins after it
        unclosed: set[str] = set()     # elements of which no end tag lies ahead
        opened: Counter[str] = Counter()

        def close_run() -> None:
            nonlocal run
            if run >= 0:
                self.text[run] = " ".join("".join(pieces).split())
                pieces.clear()
                run = -1

        def pop_to(names, stop=frozenset()) -> None:
            if not any(opened[x] for x in names):
                return
            for i in range(len(stack) - 1, 0, -1):
                if self.tag[stack[i]] in names:
                    close_run()
                    opened.subtract(self.tag[x] for x in stack[i:])
                    del stack[i:]
                    return
                if self.tag[stack[i]] in stop:
                    return

        while at < size:
            m = _TOKEN.search(source, at) if at <= last else None
            piece = source[at:m.start()] if m else _OPEN.split(source[at:], maxsplit=1)[0]
            head = head and (not piece or piece.isspace())  # text ends a head that nothing closed
            if piece and not head:
                if "&" in piece:
                    piece = html.unescape(piece)
                if run < 0 and not piece.isspace():
                    run = self._add("#text", stack[-1])
                if run >= 0:
                    pieces.append(piece)
                    if link:
                        self.links[run] += len(piece)
            if not m:
                break
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if tag:
                tag = tag.lower()
                head = head and tag in HEAD
                if tag in RAW:
                    end = None
                    if tag not in unclosed and at <= last:
                        end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                        if end is None:
                            unclosed.add(tag)
                    if not (m["attr"] or "").endswith("/"):
                        at = end.end() if end else (size if tag in ("script", "style") else at)
                elif tag == "head":
                    head = True
                elif tag in ("html", "body"):
                    pass
                elif tag == "br":
                    if run >= 0:
                        pieces.append(" ")
                elif tag in INLINE:
                    link += tag == "a"
                    if tag == "a":
                        link = 1
                elif tag in VOID:
                    if tag in ENDS_P:
                        close_run()
                elif not head:
                    if tag in ENDS_P:
                        pop_to(("p",), SCOPE)
                    if tag in ENDS_SAME:
                        pop_to(ENDS_SAME[tag], SCOPE - {"div", "section", "article"})
                    close_run()
                    attr = m["attr"] or m["attr2"] or ""
                    node = self._add(tag, stack[-1], attr)
                    if ' k="' in attr:
                        self.mark[node] = attr.split(' k="')[1][:1]
                    stack.append(node)
                    opened[tag] += 1
            elif m["end"]:
                tag = m["end"].lower()
                if tag in ("head", "body", "html"):
                    head = False
                elif tag == "a":
                    link = 0
                elif tag not in INLINE:
                    pop_to((tag,))
        close_run()

    def _fold(self) -> None:
        """A block whose only child is a run of text becomes the leaf itself;
        blocks without text keep their place as empty nodes."""
        for i, kids in enumerate(self.kids):
            if i and len(kids) == 1 and self.tag[kids[0]] == "#text":
                c = kids[0]
                self.text[i], self.links[i] = self.text[c], self.links[c]
                self.text[c], self.kids[i] = None, []
                self.parent[c] = -2  # taken in

    def nodes(self) -> list[int]:
        return [i for i in range(len(self.tag)) if self.parent[i] != -2]


def attribute_tokens(attr: str) -> list[str]:
    """Lower-case words of class, id, role and the like."""
    return [token.lower() for name, *values in _ATTR.findall(attr)
            if name.lower() in ("class", "id", "role", "itemprop", "aria-label", "data-role", "data-component")
            for token in _PART.findall("".join(values))]


def attribute_votes(attr: str) -> tuple[int, int]:
    """How many tokens of class, id, role and the like speak for and against."""
    good = bad = 0
    for token in attribute_tokens(attr):
        if token in AGAINST_WHOLE or token.startswith(AGAINST):
            bad += 1
        elif token.startswith(FOR):
            good += 1
    return good, bad


def token_buckets(attr: str) -> int:
    """The buckets of the attribute's tokens, one bit each."""
    bits = 0
    for token in attribute_tokens(attr):
        bits |= 1 << zlib.crc32(token.encode()) % TOKENS
    return bits


def _columns(bits: list[int]) -> np.ndarray:
    return np.unpackbits(np.array(bits, "<u8").view(np.uint8).reshape(-1, TOKENS // 8), axis=1, bitorder="little")


def features(page: Page) -> tuple[list[int], np.ndarray]:
    """(nodes in document order, their features): kind, attribute tokens of the
    node and its ancestors (votes of known stems, and every token by its bucket),
    depth, place among siblings, density of text, links and tags in the subtree,
    and the same of parent and siblings."""
    order = page.nodes()
    n = len(page.tag)
    chars, links, below, ends, leaves, longest, before = ([0] * n for _ in range(7))
    total = 0
    for i in order:
        before[i] = total
        if page.text[i]:
            t = page.text[i]
            chars[i], links[i], leaves[i], longest[i] = len(t), min(page.links[i], len(t)), 1, len(t)
            ends[i] = len(_SENTENCE.findall(t))
            total += len(t)
    for i in reversed(order):
        p = page.parent[i]
        if p >= 0:
            chars[p] += chars[i]
            links[p] += links[i]
            below[p] += below[i] + 1
            ends[p] += ends[i]
            leaves[p] += leaves[i]
            longest[p] = max(longest[p], longest[i])
    log = [math.log1p(c) for c in chars]
    rate = [links[i] / chars[i] if chars[i] else 0.0 for i in range(n)]
    depth, good, bad, up_good, up_bad, up_kind, bits, up_bits = ([0] * n for _ in range(8))
    group = [GROUPS.get(t, len(set(GROUPS.values())) - 1) for t in page.tag]
    kinds = len(set(GROUPS.values()))
    place = {c: k for kids in page.kids for k, c in enumerate(kids)}
    x = np.zeros((len(order), FEATURES), np.float32)
    total = max(total, 1)
    for row, i in enumerate(order):
        p = page.parent[i]
        if page.attr[i]:
            good[i], bad[i] = attribute_votes(page.attr[i])
            bits[i] = token_buckets(page.attr[i])
        sib = page.kids[p] if p >= 0 else [i]
        if p >= 0:
            depth[i] = depth[p] + 1
            up_good[i] = up_good[p] + good[p]
            up_bad[i] = up_bad[p] + bad[p]
            up_bits[i] = up_bits[p] | bits[p]
            up_kind[i] = up_kind[p] | (1 if group[p] == 0 else 2 if 6 <= group[p] <= 10 else 0)
        k = place.get(i, 0)
        prev, following = (sib[k - 1] if k > 0 else -1), (sib[k + 1] if k < len(sib) - 1 else -1)
        x[row, group[i]] = 1
        x[row, kinds:kinds + 26] = (
            good[i], bad[i], up_good[i], up_bad[i], up_kind[i] & 1, up_kind[i] >> 1, depth[i], len(page.kids[i]), len(sib),
            k, k / len(sib), log[i], chars[i] / total, rate[i], below[i] / (chars[i] + 1) * 100,
            ends[i] / (chars[i] + 1) * 100, chars[i] / max(leaves[i], 1), math.log1p(longest[i]),
            log[p] if p >= 0 else 0, rate[p] if p >= 0 else 0, chars[i] / max(chars[p], 1) if p >= 0 else 1,
            (log[prev] if prev >= 0 else 0), (rate[prev] if prev >= 0 else 0), (log[following] if following >= 0 else 0),
            (rate[following] if following >= 0 else 0), before[i] / total)
    x[:, kinds + 26:kinds + 26 + TOKENS] = _columns([bits[i] for i in order])
    x[:, kinds + 26 + TOKENS:] = _columns([up_bits[i] for i in order])
    return order, x


def decode(page: Page, order: list[int], p: np.ndarray) -> list[int]:
    """The most probable consistent choice of nodes: a node that goes takes its
    whole subtree with it, a node that stays leaves its children free. The body
    stays. Returns the leaves that stay, in page order."""
    p = np.clip(p, 1e-6, 1 - 1e-6)
    keep = dict(zip(order, np.log(p).tolist()))
    drop = dict(zip(order, np.log1p(-p).tolist()))
    for i in reversed(order):
        for c in page.kids[i]:
            keep[i] += max(keep[c], drop[c])
            drop[i] += drop[c]
    stays, out = {0}, []
    for i in order:
        if i and page.parent[i] in stays and keep[i] > drop[i]:
            stays.add(i)
        if i in stays and page.text[i]:
            out.append(i)
    return out
