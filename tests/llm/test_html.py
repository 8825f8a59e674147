import pytest

from tallyhouse.llm.html_blocks import Page
from tallyhouse.llm.html_extract import Labeller, extract_main_text, main_text, train_labeller
from tallyhouse.llm.html_training import labelled_pages


@pytest.fixture(scope="module")
def weights():
    return train_labeller()


@pytest.mark.parametrize(
    ("html", "blocks"),
    [
        (None, []),
        ("", []),
        ("plain  text\n", ["plain text"]),
        ("<p>a<p>b</p>c<div>d<br>e <b>f</b>g</div>", ["a", "b", "c", "d e fg"]),
        ("<p>x &lt;b&gt; &amp;amp; &#233;&nbsp;&hellip; &am &copy 5</p>", ["x <b> &amp; é … &am © 5"]),
        ("a<script>var t='<p>no</p>';</script>b<style>p{}</style>c<!-- <p>no --> d<!-->e", ["abc de"]),
        ("<title>no</title><p>yes<textarea>in <b>it</textarea>", ["yes", "in <b>it"]),
        ("<p title='a>b' class=x>in</p", ["in"]),
        ('<p title="a>b>in</p> more', ["b>in", "more"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]),
        ("1 < 2 <3 </ x> <?php p ?> <!doctype x>y", ["1 < 2 <3 y"]),
        ("<svg><text>no</text></svg><P>Y</P><custom-x>z</custom-x>", ["Y", "z"]),
        ("a<script>never closed <p>b", ["a"]),
        ("a<!-- never closed <p>b", ["a"]),
        ("a<p class='", ["a"]),
    ],
)
def test_blocks(html, blocks):
    assert Page(html).texts == blocks


def test_paths_and_links():
    page = Page('<div id="mainMenu" class="top-bar x1"><a href="/x">ab</a> cd</div><section hidden><p role=note>e</section>f')
    assert page.texts == ["ab cd", "e", "f"] and page.linked[0] == 2

    def path(node):
        return path(page.nodes[node][0]) + [page.nodes[node][1]] if node > 0 else []

    assert path(page.paths[0]) == [("div", ".main", ".menu", ".top", ".bar", ".x")]
    assert path(page.paths[1]) == [("section", "hidden"), ("p", "role note")]
    assert path(page.paths[2]) == []


@pytest.mark.parametrize("piece", ["<", "<a ", '<a b="', "<a b='>", "<!--", "</", "<div>", "<p>x", "&amp", "<script>", "<li>", "</p>", "<td>", "<svg>"])
def test_long_broken_pages_take_linear_time(piece):
    Page(piece * 100_000)
    Page(piece * 50_000 + ">" + "<p>x</p>")


def test_pages_of_other_layouts_than_in_training(weights):
    """Labels of held-out generated pages, and the number of pages without a wrong block."""
    labeller = Labeller(weights)
    from tallyhouse.llm.html_extract import _training_sequence

    pages = labelled_pages(300, 4711)
    wrong = total = whole = 0
    for html, got in zip(pages, labeller.main_blocks([Page(html) for html in pages])):
        want = _training_sequence(html)[3]
        wrong, total, whole = wrong + int((got != want).sum()), total + len(want), whole + bool((got == want).all())
    assert wrong / total < 0.005 and whole / len(pages) > 0.95


WEBLOG = """<html><body><div id="top"><h1><a href="/">My Site</a></h1></div><div id="menu"><a href="/a">Home</a> <a href="/b">About</a></div>
<div class="post"><h2>Why cats purr</h2><p>Cats purr for <i>many</i> reasons. Some are well known.<p>Others are not, and studies go on.
<div class="ad-box">Buy cat food now!</div><ul><li>First reason is joy.<li>Second is pain.</ul></div>
<div id="respond"><h3>2 Comments</h3><div class="comment"><p>Great post, thanks for that.</p></div><form><label>Name</label><input><button>Send</button></form></div>
<div id="footer">Copyright 2020 by Me</div></body></html>"""
NEWS = """<body><header class="masthead"><a href="/">The Daily</a><nav><ul><li><a href="/w">World</a><li><a href="/s">Sport</a></ul></nav></header>
<div class="cookie-consent"><p>We use cookies.</p><button>OK</button></div>
<main><article><h1>River floods town</h1><p>The river rose by two metres on Monday, officials said.</p><aside class="related"><h3>Related</h3>
<ul><li><a href="/1">Storm ahead</a></ul></aside><p>Schools stay closed until Friday.</p></article></main>
<section id="comments"><h2>Comments</h2><article><p>Stay safe everyone, I hope it ends soon.</p></article></section>
<footer><p>&copy; The Daily. All rights reserved.</p></footer></body>"""


def test_written_pages(weights):
    pages = [Page(WEBLOG), Page(NEWS), Page("<p>Just a fragment of text without any layout.</p><p>And more of it.</p>")]
    weblog, news, fragment = [main_text(page, chosen) for page, chosen in zip(pages, Labeller(weights).main_blocks(pages))]
    assert weblog == (
        "Why cats purr Cats purr for many reasons. Some are well known. Others are not, and studies go on. First reason is joy. Second is pain."
    )
    assert news == "River floods town The river rose by two metres on Monday, officials said. Schools stay closed until Friday."
    assert fragment == "Just a fragment of text without any layout. And more of it."


def test_given_pages_against_their_article_element(spark, weights):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    wrong = 0
    got = {r.page_id: r for r in extract_main_text(rows, weights).collect()}
    for page_id, url, html in rows.select("page_id", "url", "html").collect():
        article = Page(html[html.index("<article>") : html.index("</article>")])
        wrong += got[page_id].text != " ".join(article.texts)
        assert got[page_id].url == url and got[page_id].n_chars == len(got[page_id].text)
    assert len(got) == rows.count() and wrong <= 3


def test_long_pages_in_pieces_equal_the_whole(weights, monkeypatch):
    import tallyhouse.llm.html_extract as module

    pages = [Page(html) for html in labelled_pages(6, 5)]
    whole = [list(x) for x in Labeller(weights).main_blocks(pages)]
    monkeypatch.setattr(module, "CELLS", 5)
    assert [list(x) for x in Labeller(weights).main_blocks(pages)] == whole


def test_edge_cases(spark, weights):
    long = "<article><h1>T</h1>" + "<p>Some words of a long page stand here.</p>" * 30_000 + "</article><footer>&copy; x</footer>"
    rows = [(1, "u", None, 1), (None, None, "", 1), (3, "u", "<nav><ul><li><a href='/'>Home</a></ul></nav>", 1), (4, "u", long, 1), (4, "u", long, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = extract_main_text(df, weights).collect()
    assert sorted((r.page_id or 0, r.n_chars > 1_000_000) for r in got) == [(0, False), (1, False), (3, False), (4, True), (4, True)]
    assert [r.text for r in got if r.page_id in (None, 1, 3)] == ["", "", ""]
    assert extract_main_text(df.limit(0), weights).count() == 0
