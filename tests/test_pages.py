import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from dockline.functions import urls as U
from dockline.operators import pages as O
from dockline.operators.markup import read_page
from dockline.sinks import tables as K

HOSTS = ["city.example", "www.city.example"]
PAGE = """
<html><head><title> Test Page </title><meta name="description" content="A test &amp; more">
<script>var t = "</p><h1>no</h1>";</script><style>p {}</style></head>
<body><nav><h1>Menu</h1><a href="/hidden">Hidden</a></nav><!-- note <h2>no</h2> -->
<main><h1>Welcome</h1><p>One  <b>bold</b> and <em>soft</em> word_s.</p><p> </p><p><img src="x.png"></p>
<h2>Steps</h2><ul><li>Find a station</li><li>Take a bike<ul><li>Any</li></ul></li></ul><ol><li>One</li><li>Two</li></ol>
<a href="/stations">Find Stations</a> <a href="/pricing">Pricing</a> <a href="/pricing">Again</a>
<a href="https://elsewhere.example/x">Away</a> <a href="/map.PDF">Map</a><br>End</main>
<footer>Footer <a href="/footer">f</a></footer></body></html>
"""


@pytest.mark.parametrize("url, good", [
    ("https://city.example/page", True), ("https://www.city.example/page", True), ("https://other.example/page", False),
    ("https://city.example/file.pdf", False), ("https://city.example/FILE.PDF", False), ("https://city.example/api/data", False),
    ("https://city.example/API/data", True), ("https://city.example:8080/x", False), ("mailto:a@city.example", False),
    ("not a url", False), ("", False), (None, False), ("https://city.example/login?x=1", False), ("//city.example/x", True)])
def test_admissible(spark, url, good):
    df = spark.createDataFrame([(url,)], "url string")
    assert U.admissible(df, "url", HOSTS).count() == int(good)
    hosts = spark.createDataFrame([(h,) for h in HOSTS], "host string")
    assert U.admissible(df, "url", hosts).count() == int(good)


@pytest.mark.parametrize("url, name", [
    ("https://city.example/test-page", "test-page"), ("https://city.example/", "index"), ("https://city.example", "index"),
    ("https://city.example/a/b c//d?q=1#f", "a_b_c_d"), ("https://city.example/été/œ", "été_œ"), ("https://city.example/___", "page"),
    ("https://city.example/" + "x" * 150, "x" * 100), ("https://city.example/a;v=1", "a"), ("https://city.example/v1.2_x", "v1.2_x")])
def test_file_name(spark, url, name):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(U.file_name(F.col("url"))).first()[0] == name


def test_page_parts():
    page = read_page("https://city.example/a/", PAGE)
    assert (page["title"], page["description"], page["main_heading"]) == ("Test Page", "A test & more", "Welcome")
    assert page["links"] == [
        "https://city.example/stations", "https://city.example/pricing", "https://elsewhere.example/x", "https://city.example/map.PDF"]
    body = page["body"]
    assert body.startswith("# Welcome\n\nOne **bold** and *soft* word\\_s.\n\n## Steps\n\n- Find a station\n- Take a bike")
    assert "1. One\n2. Two" in body and "[Find Stations](https" not in body and "[Find Stations](/stations)" in body
    for gone in ("Menu", "Footer", "Hidden", "note", "var t", "x.png"):
        assert gone not in body


def test_unclean_reading_keeps_navigation():
    page = read_page("https://city.example/a/", PAGE, clean=False)
    assert "https://city.example/hidden" in page["links"] and page["main_heading"] == "Menu"


@pytest.mark.parametrize("html, title, heading, body", [
    ("", "Untitled", "", ""), ("plain text", "Untitled", "", "plain text"),
    ("<p>open <b>never closed", "Untitled", "", "open **never closed**"),
    ("</p></div><p>stray ends</p>", "Untitled", "", "stray ends"),
    ("<title></title><body><h2>Low</h2><h1>High</h1></body>", "", "Low", "## Low\n\n# High"),
    ("<body><nav>unclosed <p>gone</body>", "Untitled", "", ""),
    ("<pre>a_b\n  c</pre>", "Untitled", "", "```\na_b\n  c\n```"),
    ("<blockquote>said</blockquote><hr>", "Untitled", "", "> said\n\n---"),
    ("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>", "Untitled", "", "| a | b |\n| --- | --- |\n| 1 | 2 |"),
])
def test_odd_pages(html, title, heading, body):
    page = read_page("u", html)
    assert (page["title"], page["main_heading"], page["body"]) == (title, heading, body)


def test_deep_nesting_is_read():
    page = read_page("u", "<div>" * 20000 + "deep" + "<p><b>" * 3000)
    assert "deep" in page["body"]


def test_parse_pages(spark):
    pages = spark.createDataFrame([
        ("https://city.example/a", PAGE), ("https://city.example/none", None), ("https://city.example/bad", '<a href="http://[bad">x</a>')],
        "url string, html string")
    got = {r.url[-1]: r for r in O.parse_pages(pages, HOSTS, scraped_at=F.lit(1640995200.0)).collect()}
    good = got["a"]
    assert good.status == "success" and good.metadata.title == "Test Page" and good.metadata.scraped_at == 1640995200.0
    assert good.links == ["https://city.example/stations", "https://city.example/pricing"]
    assert good.content.startswith(
        "# Test Page\n\n**URL:** https://city.example/a  \n**Description:** A test & more  \n"
        "**Main Heading:** Welcome  \n**Scraped:** 2022-01-01 00:00:00\n\n---\n\n# Welcome")
    for name in ("e", "d"):
        assert got[name].status == "error" and got[name].metadata.title == "Error" and got[name].links == []
        assert got[name].content.startswith(f"# Error scraping {got[name].url}\n\nError: ")


def test_reach_against_walk(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("a", "c"), ("c", "a"), ("x", "y"), ("a", "a")]
    df = spark.createDataFrame(edges, "src string, dst string")
    starts = spark.createDataFrame([("a",)], "url string")
    assert rows(O.reach(df, starts, 3)) == [("a", 0), ("b", 1), ("c", 1), ("d", 2), ("e", 3)]
    assert rows(O.reach(df, starts, 0)) == [("a", 0)]
    assert rows(O.reach(df, starts, 99)) == [("a", 0), ("b", 1), ("c", 1), ("d", 2), ("e", 3), ("f", 4)]


def test_crawl_index_stats_and_sink(spark, folder):
    site = lambda name, *links: (f"https://city.example/{name}", f"<title>{name}</title>" + "".join(f'<a href="/{l}">x</a>' for l in links))
    pages = spark.createDataFrame([site("home", "a", "b"), site("a", "home", "gone"), site("b"), site("island")], "url string, html string")
    parsed = K.overwrite(O.parse_pages(pages, HOSTS, scraped_at=F.lit(1.0)), f"{folder}/parsed")
    results = K.overwrite(O.crawl(parsed, spark.createDataFrame([("https://city.example/home",)], "url string")), f"{folder}/results")
    assert rows(results.select(F.element_at(F.split("url", "/"), -1), "depth", "status")) == [
        ("a", 1, "success"), ("b", 1, "success"), ("gone", 2, "error"), ("home", 0, "success")]
    assert tuple(O.crawl_stats(results).first()) == (4, 3, 1, 4, 4)
    paths = K.save_pages(results, f"{folder}/saved")
    index = {r.url[-1]: r for r in spark.read.json(paths["index"]).collect()}
    assert index["e"].links_count in (0, 2) and len(index) == 3  # home and gone both end in e
    assert spark.read.json(paths["totals"]).first().total_pages == 4
    assert rows(spark.read.parquet(paths["content"]), "filename") == [("a",), ("b",), ("gone",), ("home",)]
    metadata = [json.loads(r.value) for r in spark.read.text(paths["metadata"]).collect()]
    assert {m["filename"]: m["title"] for m in metadata}["gone"] == "Error"


def test_stats_count_errors(spark):
    df = spark.createDataFrame([("u1", ["u2"], "success"), ("u2", [], "error")], "url string, links array<string>, status string")
    got = O.crawl_stats(df).first()
    assert (got.total_pages, got.successful_pages, got.error_pages, got.total_links_found) == (2, 1, 1, 1)


def body(html):
    from dockline.operators.markup import read_page
    return read_page("https://a.example/", html)["body"]


def test_lists_keep_their_marks():
    assert body("<ul><li>one<li>two</ul>") == "- one\n- two"
    assert body("<ol><li>one<ul><li>a<li>b</ul><li>two</ol>") == "1. one\n\n   - a\n   - b\n\n2. two"
    assert body("<ul><li><p>first</p><p>second</p></li></ul>") == "- first\n\n  second"


def test_code_keeps_its_lines():
    assert body("<p>x</p><pre><code>a\n\n  b\n</code></pre><p>y</p>") == "x\n\n```\na\n\n  b\n```\n\ny"


def test_addresses_with_marks_are_addresses():
    assert body('<a href="https://a.example/x_y">https://a.example/x_y</a>') == "<https://a.example/x_y>"
    assert body('see <a href="/x"> the <b>page</b> </a>.') == "see  [the **page**](/x) ."


def test_reading_is_linear_in_unclosed_elements():
    import time
    from dockline.operators.markup import read_page

    def seconds(n):
        page = "<body>" + "".join(f"<p>word {i}<li>item <b>x<a href='/{i}'>y" for i in range(n))
        start = time.process_time()
        read_page("https://a.example/", page)
        return time.process_time() - start

    seconds(500)
    assert min(seconds(4000) for _ in range(3)) < 3.2 * min(seconds(2000) for _ in range(3))


def test_marks_of_nested_lists():
    from dockline.operators.outline import marks

    page = body("<body><h1>Top *1*</h1><ol>" + "<li>x</li>" * 9 + "<li>ten<ul><li>a <b>b</b><ol><li>deep <a href='/d(1)'>d</a></li></ol></li></ul></li></ol>"
                    "<blockquote><h3>quoted</h3><ul><li>q</li></ul></blockquote><ul><li><ul><li>inner</li></ul></li></ul><h2>End</h2></body>")
    got = marks(page)
    assert got[:2] == [("heading", 1, None, "Top *1*", None), ("item", 1, 1, "x", None)]
    assert got[10:] == [
        ("item", 1, 10, "ten", None), ("item", 2, None, "a b", None), ("item", 3, 1, "deep d", None), ("link", 3, None, "d", "/d(1)"),
        ("heading", 3, None, "quoted", None), ("item", 1, None, "q", None),
        ("item", 1, None, "", None), ("item", 2, None, "inner", None), ("heading", 2, None, "End", None)]


def test_marks_skip_code_and_keep_targets():
    from dockline.operators.outline import marks

    assert marks("") == [] and marks("plain text\n\nmore") == []
    assert marks("- a\n  ```\n  # no\n  - no [x](y)\n  ```\n  ## yes") == [("item", 1, None, "a", None), ("heading", 2, None, "yes", None)]
    assert marks("`[a](b)` <https://a.example/x> ![pic](p.png) [t\\_u](v)") == [
        ("link", 0, None, "", "https://a.example/x"), ("image", 0, None, "pic", "p.png"), ("link", 0, None, "t_u", "v")]


def test_marks_of_odd_pages(spark):
    from dockline.operators.outline import markdown_marks

    pages = spark.createDataFrame([("u", None), (None, "<h1>a</h1>"), ("e", ""), ("p", "no marks"), ("p", "<h2>b</h2>"), ("p", "<h2>b</h2>")],
                                  "url string, html string")
    parsed = O.parse_pages(pages)
    got = [(r.url, r.place_of_kind, r.kind, r.level, r.text) for r in markdown_marks(parsed).collect()]
    assert sorted(got, key=str) == sorted([(None, 1, "heading", 1, "a")] + [("p", 1, "heading", 2, "b")] * 2, key=str)
    assert markdown_marks(parsed.limit(0)).count() == 0


def test_marks_are_read_in_linear_time():
    import time

    from dockline.operators.outline import marks

    start = time.time()
    for text in ("[a](" * 50_000, "[" * 200_000, "- " * 2_000, "`" * 99_999, "[a](b)" * 30_000, "<a:" * 60_000):
        marks(text)
    assert time.time() - start < 10


def test_few_pages_are_held_at_a_time():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"url": [f"u{i}" for i in range(1000)] + [None], "html": [f"<p>page {i}</p>" for i in range(1000)] + [None]})
    sizes, taken = [], []
    for part in O._parse_batches(iter([batch])):
        sizes.append(part.num_rows)
        taken += list(zip(part.column("url").to_pylist(), part.column("body").to_pylist(), part.column("error").to_pylist()))
    assert max(sizes) <= 64 and taken == [(f"u{i}", f"page {i}", None) for i in range(1000)] + [(None, None, "page not found")]
