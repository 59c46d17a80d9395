"""Page reader and recurrent block labeller."""

import time

import numpy as np
import pytest

from dockline.llm import main_text as M
from dockline.llm.page_blocks import read_page
from dockline.llm.queries import ORACLES, QUERIES
from tools.check import compare, connect


def texts(html):
    return [t for _, t, _ in read_page(html).blocks]


@pytest.mark.parametrize("html,blocks", [
    (None, []), ("", []), ("   ", []), ("no markup &amp; all", ["no markup & all"]),
    ("<p>a<p>b", ["a", "b"]), ("<p>a <b>b</b>c<br>d</p>e", ["a bc d", "e"]), ("<p><b>open<br><p>next</p>", ["open", "next"]),
    ("<script>var t='</p><p>x';</script><style>p{}</style>y", ["y"]), ("<script>never closed <p>x</p>", []),
    ("a<!-- <p>no</p> -->b", ["ab"]), ("a<!-- open", ["a"]), ("a<b", ["a"]), ("1 < 2 and 3 > 2", ["1 < 2 and 3 > 2"]),
    ('<a title="x > y" href=z>l</a>m', ["lm"]), ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("<p>\u00a0 &nbsp;x&#10;y\u3000z </p>", ["x y z"]),
    ("&am &amp &quot;q&quot &#x41;", ['&am & "q" A']), ("<SCRIPT>x</Script>A\u0130<STYLE>y</sTyLe>B", ["A\u0130B"]),
])
def test_blocks_of_small_pages(html, blocks):
    assert texts(html) == blocks


def test_paths_and_links():
    page = read_page('<body><nav class="mainMenu top-bar" id=x1><a href=/>Home</a> you</nav></b><p>text')
    (nav, home, links), (p, _, none) = page.blocks
    assert home == "Home you" and links == 4 and none == 0
    assert page.path(nav)[1] == ["t:nav", "c:main", "c:menu", "c:top", "c:bar", "c:x", "c:1"] and page.path(p) == [["t:body"], ["t:p"]]


@pytest.mark.parametrize("html", ["<div>x" * 60_000, "<b>" * 60_000 + "<p>x" * 60_000, '<a "' * 60_000, "<!-- " * 60_000, "</p>" * 60_000 + "<p",
                                  "<" * 200_000, "<p class='" * 50_000, "<script>" * 60_000, "<li>" * 50_000, "<p><b>" * 40_000])
def test_reading_is_linear(html):
    start = time.time()
    read_page(html)
    assert time.time() - start < 5


def test_gradient_equals_differences():
    rng = np.random.default_rng(1)
    pages = [[([["t:html"], ["t:p", f"c:k{i}"]], f"some words {i}.", i % 3) for i in range(n)] for n in (4, 1, 3)]
    blocks, labels = M.blocks_of(pages), np.array([1, 0, 0, 1, 1, 0, 1, 0], np.float32)
    model = M.Labeller(3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    _, grads = model.gradient(blocks, labels)
    for name, w in model.weights.items():
        rows = np.flatnonzero(np.abs(grads[name]).reshape(len(w), -1).sum(1)) if w.ndim > 1 else np.arange(len(w))
        for r in rng.choice(rows, min(3, len(rows)), replace=False):
            at = (r, *(rng.integers(n) for n in w.shape[1:]))
            old, step, said = w[at], 2e-3, []
            for move in (step, -step):
                w[at] = old + move
                said.append(model.gradient(blocks, labels)[0])
            w[at] = old
            assert np.isclose((said[0] - said[1]) / (2 * step), grads[name][at], atol=2e-4, rtol=2e-2), (name, at)


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return M.fit_labeller(M.sample_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")))


UNSEEN = [
    ("<title>T</title><header><h1>Site</h1></header><nav><a>Home</a><a>Blog</a></nav><main><h1>Head</h1><p>First para of text, long enough to be one.</p>"
     "<form><label>Name</label><button>Send</button></form><p>Second para, with more &amp; more words.</p></main>"
     "<section class=comments><p>I liked this article a lot, thank you.</p></section><footer>Copyright</footer>",
     "Head\nFirst para of text, long enough to be one.\nSecond para, with more & more words."),
    ("<div id=top-menu><ul><li><a>A</a></li><li><a>B</a></li></ul></div><div class=cookie-notice>We use cookies here.</div>"
     "<div class=content><h2>Title of it</h2><p>Some para with words, which says things.</p><div class=ad>Buy now!</div><p>Next para, which says more.</p></div>"
     "<div class=sidebar><h3>Related</h3><a>Other article</a></div><div class=reader-comments><div class=comment><p>Nice post, thanks.</p></div></div>",
     "Title of it\nSome para with words, which says things.\nNext para, which says more.")]


@pytest.mark.parametrize("html,text", UNSEEN)
def test_other_layouts(model, html, text):
    page = read_page(html)
    assert "\n".join(t for (_, t, _), s in zip(page.blocks, M.label_pages(model, [page])[0]) if s >= 0.5) == text


def test_made_layouts_of_unseen_pages(spark, sf_dir, model):
    rows = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/pages.parquet").where("page_id >= 150").collect()
    pages = [read_page(r["html"]) for r in rows]
    layouts, wrong, total = M.Layouts([t for p in pages for _, t, _ in p.blocks], 99), 0, 0
    for page in pages:
        paths = [(page.path(e), t, n) for e, t, n in page.blocks]
        blocks, labels = layouts.page([([p[-1][0]] if p[-1][0] not in M.MAIN else [], t, n) for p, t, n in paths if M.taught(p)])
        wrong += ((model.scores(M.blocks_of([blocks])) >= 0.5) != np.array(labels)).sum()
        total += len(labels)
    assert wrong / total < 0.03


def test_labels_do_not_hang_on_the_batch(spark, sf_dir, model):
    pages = [read_page(r["html"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()] + [read_page("<p>x" * 5000)]
    together = M.label_pages(model, pages)
    for page, scores in zip(pages[-8:], together[-8:]):
        assert np.allclose(M.label_pages(model, [page])[0], scores, atol=1e-4) and len(scores) == len(page.blocks)


def test_odd_rows(spark, model):
    page = "<html><body><nav><a>x</a></nav><article><p>A text, that says something.</p></article></body></html>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "v", ""), (None, "w", "<p"), (4, "x", "<article>" + "<p>word words, more.</p>" * 20_000)]
    frame = spark.createDataFrame([(*r, "clash", 7) for r in rows], "page_id bigint, url string, html string, text string, kept int").repartition(2)
    got = sorted(map(tuple, M.page_texts(frame, model).select("page_id", "url", "text").collect()), key=str)
    long = "\n".join(["word words, more."] * 20_000)
    assert got == sorted([(1, "u", "A text, that says something.")] * 2 + [(2, None, ""), (3, "v", ""), (None, "w", ""), (4, "x", long)], key=str)
    assert M.main_text(frame.limit(0)).count() == 0
    assert M.main_text(frame.where("page_id = 4")).first()["n_chars"] == len(long)  # no page is short enough to learn from


def test_query_equals_its_sql(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    assert compare(QUERIES["op12_main_text"](spark, folder), connect(folder), ORACLES["op12_main_text"]) == ""
