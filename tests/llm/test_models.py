"""Quality classifier, main-text extraction and nearest neighbours."""

import time
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest
from plain import prose

from ordo.llm import ann, dom, html_extract, quality_mil
from ordo.llm.dom import Page, decode


# ------------------------------------------------------------------ quality classifier

def test_gradients_against_differences():
    r = np.random.default_rng(1)
    model = quality_mil.GatedAttention(features=7, seed=2)
    model.p = {k: v.astype(float) for k, v in model.p.items()}
    x, per_row, y = r.standard_normal((9, 7)), np.array([3, 1, 5]), np.array([1.0, 0.0, 1.0])

    def loss():
        s = model.score(x, per_row)
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    for name, g in model.gradients(x, per_row, y).items():
        w = model.p[name]
        for at in [tuple(r.integers(0, n) for n in w.shape) for _ in range(6)]:
            w[at] += 1e-5
            up = loss()
            w[at] -= 2e-5
            down = loss()
            w[at] += 1e-5
            assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-6), name


def labelled(make_docs, spark, n=240):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(i, 40 + i) if not bad else " | ".join(w.upper() + "!!" for w in prose(i, 40 + i).split())
        rows.append((i, text, "a"))
        labels.append((i, 0 if bad else 1, 0))
    return make_docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), dict((a, b) for a, b, _ in labels)


def test_held_out_accuracy(make_docs, spark):
    docs, labels, truth = labelled(make_docs, spark)
    got = quality_mil.score_quality(docs, labels).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 240 and len(held) > 20
    assert all(r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)
    assert np.mean([r["predicted"] == truth[r["id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_held_out_labels_are_never_learnt(make_docs, spark):
    docs, labels, _ = labelled(make_docs, spark)
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    a = {r["id"]: r["score"] for r in quality_mil.score_quality(docs, labels).collect()}
    b = {r["id"]: r["score"] for r in quality_mil.score_quality(docs, turned).collect()}
    assert a == b


def test_sample_is_taken_of_given_documents(make_docs, spark):
    """Labels without a document, and documents that are too long, take no place in the sample."""
    docs = make_docs([(i, prose(i, 3000 if i % 2 else 30), "a") for i in range(40)])
    labels = spark.createDataFrame([(i, i // 2 % 2) for i in range(4000)], "doc_id bigint, quality int")
    model = quality_mil.fit_quality(docs, labels, fit_rows=10, fit_bytes=4096)
    want = quality_mil.fit_quality(docs.filter("doc_id % 2 = 0"), labels.filter("doc_id < 40 and doc_id % 2 = 0"), fit_rows=10)
    assert model is not None and all((model.p[k] == want.p[k]).all() for k in want.p)


def test_quality_messy_and_empty(messy, make_docs, spark):
    docs, rows = messy
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 1), (9, None), (None, 1), (8, 0)], "doc_id bigint, quality int")
    got = quality_mil.score_quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    none = labels.filter("false")
    assert {r["score"] for r in quality_mil.score_quality(docs, none).collect()} == {0.5}
    assert quality_mil.score_quality(make_docs([]), labels).count() == 0


# ------------------------------------------------------------------ main text

ARTICLE = ["A title of the page", "The first paragraph is here, and it says something. It goes on for a while, as they do.",
           "A second one follows, with more to say about it; nothing else. It ends here, at last."]


def site_page(n, body="article"):
    text = [prose(3 * n + k, 25).replace("\n", " ") for k in range(3)]
    return (f'<!DOCTYPE html><html><head><title>t</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">{text[0][:9]}</a></li>'
            f'<li><a href="/b">b</a></li></ul></nav><!-- x --><div class="ad">{text[1][:40]}</div><{body}><h1>{text[0][:20]}</h1>'
            + "".join(f"<p>{t}</p>" for t in text) + f"</{body}><footer>&copy; example &middot; {text[2][:30]}</footer></body></html>",
            " ".join(([text[0][:20].strip()] + text)))


def test_reader_is_tolerant():
    p = Page("a<p>b&amp;<b>c</b> <i>d<p>e<br>f&nbsp;g<ul><li>h<li>i</ul>j<script>x<p></script><p")
    leaves = [p.text[i] for i in p.nodes() if p.text[i]]
    assert leaves == ["a", "b&c d", "e f g", "h", "i", "j"]
    for odd in ("", "<", "<<p>>", "</p>", "<p", "<!--", "<script>", "<a href='x>y", "&#0;&bogus;", "<p " + "a" * 50_000, "<div>" * 3000 + "x"):
        Page(odd)


def test_head_without_an_end():
    """The head ends at its end tag or at the first content that does not belong in it."""
    def read(source):
        p = Page(source)
        return [p.text[i] for i in p.nodes() if p.text[i]]
    head = '<html><head><meta charset=x><title>t</title> <style>p{}</style>\n<script>var s = "<p>";</script><link rel=x>'
    for end in ("", "</head>", "<body>", "</head><body>"):
        assert read(f"{head}{end}<p>a</p><div>b</div>") == ["a", "b"]
        assert read(f"{head}{end}a <b>b</b>") == ["a b"]


BROKEN = ("a <b ", "<button>", "<p><i x='", "</p><div>", "<select>x", '<a "', "<!-", "<svg></sv", "<li></ul>", "&am", "<td><div></td>")


@pytest.mark.parametrize("piece", BROKEN)
def test_reader_takes_linear_time(piece):
    """Pages of a megabyte that repeat one broken piece."""
    for source in (piece * (2 ** 20 // len(piece)), "<div><p>" + piece * (2 ** 20 // len(piece)) + ">"):
        start = time.perf_counter()
        Page(source)
        assert time.perf_counter() - start < 8


def test_labels_and_formulas_are_text():
    page = Page("<article><p>Press <button>Save</button> to keep <math><mi>x</mi><mo>=</mo><mn>2</mn></math>, or "
                "<object data=a>see here</object>.</p><script>no()</script><style>p{}</style></article>")
    assert [page.text[i] for i in page.nodes() if page.text[i]] == ["Press Save to keep x=2, or see here."]


class PlainReader(HTMLParser):
    """Runs of text between block tags, by the standard library's parser."""

    def __init__(self, source):
        super().__init__(convert_charrefs=True)
        self.runs, self.now, self.skipped = [], [], 0
        self.feed(source)
        self.close()
        self.cut()

    def cut(self):
        text = " ".join("".join(self.now).split())
        self.runs += [text] if text else []
        self.now = []

    def handle_starttag(self, tag, attrs):
        self.skipped += tag in dom.RAW
        if tag == "br":
            self.now.append(" ")
        elif tag not in dom.INLINE and tag not in dom.RAW and tag != "input":
            self.cut()

    def handle_endtag(self, tag):
        self.skipped -= tag in dom.RAW
        if tag not in dom.INLINE and tag not in dom.RAW:
            self.cut()

    def handle_data(self, data):
        if not self.skipped:
            self.now.append(data)


def test_blocks_against_the_standard_parser():
    """Order, character references and white space of all blocks of all kinds of pages."""
    texts = [[prose(100 * n + k, 30) + " &amp;lt; café &#8364; a&nbsp;b" for k in range(6)] for n in range(30)]
    made = html_extract.Layouts([[t.replace("&", "and") for t in x] for x in texts], seed=3)
    pages = [made.page(x) for x in texts for _ in range(4)]
    pages += [site_page(n)[0] for n in range(30)] + [p.replace("<p", "  <p").replace("</p>", "</p>\r\n\t<br><script>var a = '<p>';</script>") for p in pages]
    for source in pages:
        page = Page(source)
        assert [page.text[i] for i in page.nodes() if page.text[i]] == PlainReader(source).runs


def test_decoding_is_consistent():
    p = Page("<div>a<p>b</p><p>c</p></div><div><p>d</p></div>")
    order = p.nodes()
    r = np.random.default_rng(0)
    for _ in range(200):
        kept = {p.text[i] for i in decode(p, order, r.random(len(order)))}
        assert kept <= {"a", "b", "c", "d"}
    score = np.array([0.9 if p.text[i] != "d" else 0.95 for i in order])
    score[[p.tag[i] == "div" for i in order].index(True)] = 1e-5   # the first block goes, with all that it holds
    assert [p.text[i] for i in decode(p, order, score)] == ["d"]


def test_main_text(spark):
    pages = [site_page(n) for n in range(60)]
    df = spark.createDataFrame([(n, h, "x") for n, (h, _) in enumerate(pages)], "page_id bigint, html string, text string")
    got = {r["page_id"]: r["main_text"] for r in html_extract.extract_main_text(df).select("row.page_id", "main_text").collect()}
    assert np.mean([got[n] == want for n, (_, want) in enumerate(pages)]) > 0.95


def test_other_layouts():
    trees = html_extract.fit_trees([site_page(n)[0] for n in range(80)])
    inner = f"<h1>{ARTICLE[0]}</h1><p>{ARTICLE[1]}</p><div class='ad'>Buy this now, it is great.</div><p>{ARTICLE[2]}</p>"
    page = ("<body><header><div>Site</div><nav><a href=/>Home</a> <a href=/x>News</a></nav></header>"
            "<div class='cookie-notice'><p>We use cookies, as all do. Accept them.</p></div>"
            f"<div id='content'>{inner}</div><aside class='sidebar'><h3>Popular</h3><ul><li><a href=1>One</a></li></ul></aside>"
            "<section id='comments'><h3>Comments</h3><div class='comment'><p>I liked it, thanks. Really good.</p></div></section>"
            "<form><label>Name</label><input></form><footer>&copy; 2020 All rights reserved.</footer></body>")
    got = html_extract.extract_text(trees, [page, None, "", "  "])
    assert got[1:] == ["", "", ""]
    assert ARTICLE[1] in got[0] and ARTICLE[2] in got[0]
    assert not any(w in got[0] for w in ("cookies", "Buy", "liked", "Home", "Popular", "rights", "Name"))


def test_unlisted_attribute_tokens_are_learnt():
    """A token that no stem list names decides where all else is equal, on the block and below it."""
    def made(seeds):
        xs, ys = [], []
        for n in seeds:
            name = ("zork", "plim")[n % 2]
            page = Page(f"<div class='box {name}-{n}'><p>{prose(n // 2, 30)}</p></div>")
            order, x = dom.features(page)
            xs.append(x[1:])
            ys += [name == "plim"] * (len(order) - 1)
        return np.concatenate(xs), np.array(ys, float)
    assert dom.attribute_votes("class='box zork-1'") == dom.attribute_votes("class='box plim-1'") == (0, 0)
    x, y = made(range(80))
    trees = html_extract.BoostedTrees().fit(x, y, np.ones(len(y)))
    x, y = made(range(80, 120))
    assert (abs(trees.score(x) - y) < 0.2).all()


def test_pages_messy_and_empty(spark):
    schema = "page_id bigint, url string, html string, row string, s string, main_text string"
    long = "<article>" + "".join(f"<p>{prose(k, 60)}</p>" for k in range(400)) + "</article>"
    rows = [(1, None, None, "x", "x", "x"), (None, "u", "", "x", "x", "x"), (2, "u", long, "x", "x", "x"), (2, "u", long, "x", "x", "x")]
    got = html_extract.extract_main_text(spark.createDataFrame(rows, schema)).select("row.*", "main_text").toPandas()
    assert len(got) == 4
    empty = spark.createDataFrame([], schema)
    assert html_extract.extract_main_text(empty).count() == 0


def test_sample_of_long_and_repeated_pages(spark, monkeypatch):
    """Long pages alone are fitted on, copies count once, and a sample without text costs no page its text."""
    fitted, fit = [], html_extract.fit_trees
    monkeypatch.setattr(html_extract, "fit_trees", lambda pages: fitted.append(pages) or fit(pages))
    pages = [site_page(n) for n in range(12)]
    extract = lambda htmls, **own: [r["main_text"] for r in html_extract.extract_main_text(
        spark.createDataFrame([(n, h) for n, h in enumerate(htmls)], "page_id bigint, html string"), **own).orderBy("row.page_id").collect()]
    got = extract([h for h, _ in pages], fit_bytes=600)  # every page is longer
    assert all(got) and len(fitted[-1]) == 12 and max(map(len, fitted[-1])) <= 600
    extract([pages[0][0]] * 40 + [h for h, _ in pages], fit_pages=12)
    assert sorted(fitted[-1]) == sorted(h for h, _ in pages)
    assert extract([f"<p></p><!-- {n} -->" for n in range(5)] + [pages[0][0]], fit_pages=5, fit_bytes=100)[-1]
    assert extract(["<p></p>", None]) == ["", ""]


# ------------------------------------------------------------------ nearest neighbours

def brute(vectors, queries, k=5):
    out = {}
    for q, v in queries.items():
        near = sorted((-(np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w))), i) for i, w in vectors.items() if i != q)
        out[q] = [(i, -c) for c, i in near[:k]]
    return out


def test_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 700)
    monkeypatch.setattr(ann, "STRIPE", 16)
    monkeypatch.setattr(ann, "SEARCHED", 7)
    r = np.random.default_rng(3)
    centre = r.standard_normal((12, 32))
    vectors = {i: centre[i % 12] + 0.8 * r.standard_normal(32) for i in range(3000)}
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors.items()], "vec_id bigint, embedding array<double>")
    want = brute(vectors, {i: v for i, v in vectors.items() if i % 50 == 0})
    rows = ann.nearest(df, df.filter("vec_id % 50 = 0")).collect()
    hit = 0
    for r_ in rows:
        exact = dict(want[r_["query_id"]])
        if r_["vec_id"] in exact:
            hit += 1
            assert r_["score"] == pytest.approx(exact[r_["vec_id"]], abs=1e-12)
    assert len(rows) == 5 * len(want) and hit >= 0.98 * len(rows)


def test_ties_and_odd_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(400)]  # one vector many times: ties to the smaller id
    rows += [(1000, None), (1001, []), (1002, [0.0, 0.0]), (1003, [float("nan"), 1.0]), (1004, [float("inf"), 1.0]),
             (1005, [None, 1.0]), (None, [1.0, 1.0]), (1006, [1.0, 2.0, 3.0]), (7, [1.0, 2.0])]
    df = spark.createDataFrame([(*x, "x") for x in rows], "vec_id bigint, embedding array<double>, id string")
    queries = df.filter("vec_id in (3, 1000, 1003, 1006) or vec_id is null")
    got = ann.nearest(df, queries).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(3, 1, 0), (3, 2, 1), (3, 3, 2), (3, 4, 4), (3, 5, 5)]
    assert ann.nearest(df, df.filter("false")).count() == 0 and ann.nearest(df.filter("false"), df).count() == 0


def test_fewer_than_k(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (50, [-1.0, 0.5])], "vec_id bigint, embedding array<double>")
    got = ann.nearest(df, df.filter("vec_id % 50 = 0")).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]


def test_repeated_ids_with_other_vectors(spark, monkeypatch):
    """Every vector of an id is a candidate and a query; an id is found once, by its best score."""
    r = np.random.default_rng(4)
    rows = [(i % 60, [float(x) for x in r.standard_normal(8)]) for i in range(300)]
    df = spark.createDataFrame(rows + rows[:50], "vec_id bigint, embedding array<double>")
    unit = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows]
    for size in (ann.BLOCK_VECTORS, 40):
        monkeypatch.setattr(ann, "BLOCK_VECTORS", size)
        got = {(x["query_id"], x["vec_id"]): x["score"] for x in ann.nearest(df, df.filter("vec_id % 20 = 0"), k=60).collect()}
        want = {}
        for q, v in unit:
            for i, w in unit:
                if q % 20 == 0 and i != q:
                    want[q, i] = max(want.get((q, i), -2), float(v @ w))
        assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x], abs=1e-12) for x in want)
