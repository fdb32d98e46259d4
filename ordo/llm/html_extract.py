"""Main-text extraction: gradient-boosted trees over the blocks of a page and
a consistent decoding along the tree.

Every block gets a probability of belonging to the article (or holding parts
of it) from its own features; the decoding picks the most probable choice in
which no block stays inside one that goes.

There are no hand-made labels. The trees are fitted on a bounded sample of the
given pages (``fit_pages`` distinct pages; of those longer than ``fit_bytes``
bytes, which only fill up the sample, the first ``fit_bytes`` characters): those that
name their article with <article> or <main> label their own blocks, and their
texts are set again into varied layouts (named and unnamed containers, menus,
notices, adverts, side columns, forms, comments) whose blocks have known
labels. So the trees learn attribute tokens, densities and places that the
given layouts alone would not show.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.llm.dom import Page, attribute_votes, decode, features
from ordo.llm.tables import ship

FIT_PAGES = 250
FIT_BYTES = 65536
LAYOUTS = 4                # layouts that each sampled page is set into
OWN_WEIGHT = 4.0           # of a block of a given page over one of a layout
TREES, DEPTH, BINS, RATE = 70, 5, 32, 0.2
OUTPUT_ROWS = 64
# Fixed value: an article for the layouts where no sampled page has text.
PLAIN_PAGE = ("<article><h1>A day at the river</h1><p>The river was high that morning, and the boats stayed at the pier. Nobody "
              "had expected so much rain.</p><p>Later the sun came out, so the market opened after all; people stood about "
              "and talked. Some had come from the next town.</p><p>In the evening it was quiet again.</p></article>")


# ------------------------------------------------------------------ trees

class BoostedTrees:
    """Boosted regression trees for a yes/no label, second-order gains over
    binned features. Complete trees of one depth; ``score`` gives probabilities."""

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> BoostedTrees:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
        self.feature, self.cut, self.leaf = [], [], []
        binned = [np.searchsorted(c, v, side="left").astype(np.uint8) for c, v in zip(cuts, x.T)]
        upper = [np.flatnonzero(b) if len(c) == 1 else None for b, c in zip(binned, cuts)]  # of a column with two values
        share = np.clip((weight @ y) / weight.sum(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        f = np.full(len(x), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            g, h = weight * (y - p), weight * p * (1 - p)
            node = np.zeros(len(x), np.int64)
            feature, cut = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, np.inf)
            for level in range(DEPTH):
                first, n = 2 ** level - 1, 2 ** level
                best, pick = np.full(n, 1e-6), np.full(n, -1)
                at = np.zeros(n, np.int64)
                gt, ht = np.bincount(node, g, n)[:, None], np.bincount(node, h, n)[:, None]
                for j, rows in enumerate(upper):
                    if rows is None:
                        key = node * BINS + binned[j]
                        gl = np.bincount(key, g, n * BINS).reshape(n, BINS).cumsum(axis=1)[:, :-1]
                        hl = np.bincount(key, h, n * BINS).reshape(n, BINS).cumsum(axis=1)[:, :-1]
                    elif len(rows):
                        gl = gt - np.bincount(node[rows], g[rows], n)[:, None]
                        hl = ht - np.bincount(node[rows], h[rows], n)[:, None]
                    else:
                        continue
                    gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
                    gain[(hl < 1) | (ht - hl < 1)] = 0
                    b = gain.argmax(axis=1)
                    v = gain[np.arange(n), b]
                    better = (v > best) & (b < len(cuts[j]))
                    best[better], pick[better], at[better] = v[better], j, b[better]
                found = pick >= 0
                feature[first:first + n][found] = pick[found]
                cut[first:first + n][found] = [cuts[j][b] for j, b in zip(pick[found], at[found])]
                node = 2 * node + (x[np.arange(len(x)), feature[first + node]] > cut[first + node])
            G, H = np.bincount(node, g, 2 ** DEPTH), np.bincount(node, h, 2 ** DEPTH)
            leaf = RATE * G / (H + 1)
            self.feature.append(feature)
            self.cut.append(cut)
            self.leaf.append(leaf)
            f += leaf[node]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        f, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            f += leaf[node - (2 ** DEPTH - 1)]
        return 1 / (1 + np.exp(-f))


# ------------------------------------------------------------------ training pages

def own_labels(page: Page) -> list[bool] | None:
    """Blocks that belong to the article or hold it, if the page names it."""
    n = len(page.tag)
    inside, label = [False] * n, [False] * n
    if not {"article", "main"} & set(page.tag):
        return None
    for i in page.nodes():
        p = page.parent[i]
        inside[i] = (p >= 0 and inside[p]) or page.tag[i] in ("article", "main")
        if page.tag[i] in ("nav", "aside", "footer", "form", "header") or attribute_votes(page.attr[i])[1]:
            inside[i] = False
    for i in reversed(page.nodes()):
        label[i] = label[i] or bool(inside[i] and page.text[i])
        if label[i] and page.parent[i] >= 0:
            label[page.parent[i]] = True
    return label


def marked_labels(page: Page) -> list[bool]:
    """Blocks that are marked, are in a marked block or hold one."""
    n = len(page.tag)
    inside, label = [False] * n, [False] * n
    for i in page.nodes():
        p = page.parent[i]
        inside[i] = page.mark[i] == "1" or (p >= 0 and inside[p] and page.mark[i] != "0")
    for i in reversed(page.nodes()):
        label[i] = label[i] or bool(inside[i] and page.text[i])
        if label[i] and page.parent[i] >= 0:
            label[page.parent[i]] = True
    return label


def _escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;")


class Layouts:
    """Pages with known labels: an article's texts set among other blocks."""

    def __init__(self, texts: list[list[str]], seed: int = 5):
        self.r = np.random.default_rng(seed)
        self.words = [w for t in texts for s in t[:3] for w in s.split()[:30]] or ["word"]
        self.sentences = [" ".join(s.split()[:25]) for t in texts for s in t[:4]] or ["A sentence."]

    def pick(self, options):
        return options[int(self.r.integers(len(options)))]

    def few(self, low: int, high: int) -> str:
        return " ".join(self.pick(self.words) for _ in range(int(self.r.integers(low, high + 1))))

    def maybe(self, share: float) -> bool:
        return bool(self.r.random() < share)

    def box(self, inner: str, tags, names, named: float = 0.8) -> str:
        tag = self.pick(tags)
        attr = f' {self.pick(("class", "class", "id"))}="{self.pick(names)}"' if names and self.maybe(named) else ""
        return f'<{tag}{attr} k="0">{inner}</{tag}>'

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{self.few(1, 1)}">{_escape(self.few(1, 3))}</a>' for _ in range(int(self.r.integers(low, high + 1)))]
        return self.pick((lambda: "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>", lambda: " | ".join(items),
                          lambda: "".join(f"<div>{i}</div>" for i in items)))()

    def said(self, low: int, high: int) -> str:
        return "".join(f"<p>{_escape(self.pick(self.sentences))}</p>" for _ in range(int(self.r.integers(low, high + 1))))

    def aside(self) -> str:
        """One block that is not the article's."""
        return self.pick((
            lambda: self.box(_escape(self.pick(self.sentences)), ("div", "aside", "section", "ins"),
                             ("ad", "ads", "advert", "ad-slot", "banner-ad", "sponsored", "promo-box")),
            lambda: self.box(self.said(1, 2) + self.links(0, 2), ("div", "section"),
                             ("cookie-notice", "cookie-consent", "notice", "gdpr-banner", "alert", "popup", "modal")),
            lambda: self.box(f"<h3>{_escape(self.few(1, 3))}</h3>" + self.links(2, 8), ("div", "aside", "section"),
                             ("related", "related-posts", "recommended", "popular", "trending", "read-more-links")),
            lambda: self.box(f"<h3>{_escape(self.few(1, 3))}</h3>" + self.said(0, 2) + self.links(1, 6), ("aside", "div"),
                             ("sidebar", "side-column", "widget", "right-rail")),
            lambda: self.box(self.links(2, 6), ("div", "ul"), ("share", "social-links", "share-bar", "tags", "breadcrumb")),
            lambda: self.box(f"<p>{_escape(self.few(3, 12))}</p><label>{self.few(1, 2)}</label><input type=text>"
                             f"<button>{self.few(1, 2)}</button>", ("form", "div"),
                             ("newsletter", "subscribe", "signup-form", "login", "search-form"))))()

    def comments(self) -> str:
        one = lambda: self.box(f"<b>{_escape(self.few(1, 2))}</b>" + self.said(1, 3), ("div", "li", "article"),
                               ("comment", "comment-body", "reply", "response"), 0.7)
        inner = f"<h3>{self.few(1, 2)}</h3>" + "".join(one() for _ in range(int(self.r.integers(1, 6))))
        return self.box(inner, ("section", "div", "ol"), ("comments", "comment-list", "responses", "discussion", "reader-comments"), 0.95)

    def article(self, texts: list[str]) -> str:
        parts = []
        for n, t in enumerate(texts):
            tag = self.pick(("h1", "h2")) if n == 0 and self.maybe(0.6) else \
                self.pick(("p",) * 12 + ("div", "div", "blockquote", "h2", "li", "td"))
            words = t.split()
            if tag in ("h1", "h2"):
                t = " ".join(words[:int(self.r.integers(1, 10))])
                words = t.split()
            if len(words) > 9 and self.maybe(0.2):
                words[3] = f'<a href="/x">{_escape(words[3])}</a>'
                text = " ".join([_escape(w) if not w.startswith("<a ") else w for w in words])
            else:
                text = _escape(t)
            part = f'<{tag} k="1">{text}</{tag}>'
            parts.append(f"<ul>{part}</ul>" if tag == "li" else f"<table><tr>{part}</tr></table>" if tag == "td" else part)
            if self.maybe(0.08):
                parts.append(self.aside())
        inner = "".join(parts)
        for _ in range(int(self.r.integers(0, 3))):
            inner = f'<div class="{self.pick(("row", "col", "inner", "wrap", "c12", "grid"))}">{inner}</div>'
        tag, name = self.pick((("article", ""), ("main", ""), ("div", "content"), ("div", "main-content"), ("div", "post-body"),
                               ("div", "entry-content"), ("section", "story"), ("div", ""), ("div", "article-text"), ("section", "")))
        attr = f' {self.pick(("class", "id"))}="{name}"' if name else ""
        head = self.box(f"<p>{_escape(self.few(2, 6))}</p>", ("header", "div"), ("byline-header", "topbar")) if self.maybe(0.1) else ""
        return f"<{tag}{attr}>{head}{inner}</{tag}>"

    def page(self, texts: list[str]) -> str:
        top, bottom = [], []
        if self.maybe(0.7):
            top.append(self.box(f"<div>{_escape(self.few(1, 4))}</div>" + (self.links(2, 6) if self.maybe(0.5) else self.said(0, 1)),
                                ("header", "div"), ("header", "site-header", "masthead", "top")))
        if self.maybe(0.8):
            top.append(self.box(self.links(3, 12), ("nav", "div", "ul"), ("nav", "menu", "main-menu", "navbar")))
        top += [self.aside() for _ in range(int(self.r.integers(0, 3)))]
        bottom += [self.aside() for _ in range(int(self.r.integers(0, 3)))]
        if self.maybe(0.4):
            bottom.append(self.comments())
        if self.maybe(0.85):
            foot = self.pick((lambda: f"&copy; {_escape(self.few(1, 3))} " + _escape(self.pick(self.sentences)),
                              lambda: self.links(2, 8), lambda: self.said(1, 2) + self.links(0, 4)))()
            bottom.append(self.box(foot, ("footer", "div"), ("footer", "site-footer", "legal", "copyright"), 0.9))
        whole = "".join(top) + self.article(texts) + "".join(bottom)
        for _ in range(int(self.r.integers(0, 3))):
            whole = f'<div class="{self.pick(("page", "wrapper", "container", "site", "layout"))}">{whole}</div>'
        return f"<html><body>{whole}</body></html>"


def fit_trees(pages: list[str]) -> BoostedTrees | None:
    """Trees fitted on raw pages; None without any page that has text."""
    xs, ys, ws, texts = [], [], [], []

    def learn(page: Page, label: list[bool], weight: float) -> None:
        order, x = features(page)
        xs.append(x)
        ws.append(np.full(len(x), weight))
        ys.append(np.array([label[i] for i in order], float))

    for source in pages:
        page = Page(source)
        label = own_labels(page)
        leaves = [i for i in page.nodes() if page.text[i]]
        if label is not None and any(label):
            learn(page, label, OWN_WEIGHT)
            leaves = [i for i in leaves if label[i]]
        if leaves:
            texts.append([page.text[i] for i in leaves])
    if not texts:
        return None
    layouts = Layouts(texts)
    for t in texts:
        for _ in range(LAYOUTS):
            page = Page(layouts.page(t))
            learn(page, marked_labels(page), 1.0)
    return BoostedTrees().fit(np.concatenate(xs), np.concatenate(ys), np.concatenate(ws))


# ------------------------------------------------------------------ operator

def extract_text(trees: BoostedTrees, sources: list[str | None]) -> list[str]:
    """Main text of each page: the blocks that stay, joined by one space."""
    pages = [Page(s or "") for s in sources]
    found = [features(p) for p in pages]
    score = trees.score(np.concatenate([x for _, x in found])) if found else np.zeros(0)
    out, at = [], 0
    for page, (order, _) in zip(pages, found):
        leaves = decode(page, order, score[at:at + len(order)])
        at += len(order)
        out.append(" ".join(page.text[i] for i in leaves))
    return out


def extract_main_text(pages: DataFrame, html: str = "html", fit_pages: int = FIT_PAGES,
                      fit_bytes: int = FIT_BYTES) -> DataFrame:
    """``row`` (the input row as a struct) and ``main_text`` for every page.

    A null or empty page, and one without running text, has an empty text.
    Repeated rows are extracted alike; an empty table gives no rows. Pages of any length are
    read whole, in time in proportion to it. Columns of ``pages`` travel in a
    struct, so no name of theirs clashes. If no sampled page has text, the trees are
    fitted on layouts of a fixed article."""
    source = F.col(html).cast("string")
    held = pages.select(source.alias("s"), F.xxhash64(source).alias("h"),
                        (F.octet_length(source) > fit_bytes).alias("long")).filter(F.octet_length("s") > 0)
    # hashes first: copies of a page count once, and only the chosen texts are moved
    chosen = held.select("long", "h").distinct().orderBy("long", "h").limit(fit_pages)
    found = held.join(F.broadcast(chosen), ["long", "h"], "left_semi")
    found = found.groupBy("long", "h").agg(F.min(F.substring("s", 1, fit_bytes)).alias("s")).orderBy("long", "h")
    sample = [r["s"] for r in found.collect()]  # at most fit_pages of fit_bytes characters
    trees = (fit_trees(sample) or fit_trees([PLAIN_PAGE])) if sample else None
    rows = pages.select(F.struct("*").alias("row"), source.alias("s"))
    if trees is None:
        return rows.select("row", F.lit("").alias("main_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, OUTPUT_ROWS):
                part = batch.slice(at, OUTPUT_ROWS)
                texts = extract_text(trees, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["row", "main_text"])

    return ship(rows).mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, main_text string")
