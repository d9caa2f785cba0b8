import html as references

import numpy as np
import pytest

from turnout.llm import html_text
from turnout.llm.blocks import page_blocks
from turnout.llm.html_text import extract_text, fit_extractor
from turnout.llm.queries import op10_html_text
from turnout.llm.tables import table

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def weights(spark):
    return fit_extractor(table(spark, SF_DIR, "pages"))


def test_blocks_of_broken_pages():
    texts = lambda page: [b.text for b in page_blocks(page)]
    assert texts("a<p>b <b>c<i> d</b>\n\ne<p>f&amp;g&nbsp; h&#33;<br>i<div>j") == ["a", "b c d e", "f&g h! i", "j"]
    assert texts("<script>var a='<p>x</p>'</script><style>p{}</style><!-- y --><p>z</p") == ["z"]
    assert texts("<title>t</title><ul><li>a<li>b<ul><li>c</ul></ul><td>d") == ["a", "b", "c", "d"]
    assert texts("<![endif]><p>x<![CDATA[y]]></p>") == ["x"]
    assert texts("") == [] and texts("< >&") == ["< >&"]
    assert len(texts("<div>x" * 20_000)) == 20_000


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    w = {k: x.astype(np.float64) for k, x in html_text.initial(rng).items()}
    pages = [page_blocks("<nav>m</nav><article><p>a b</p><p>c</p></article>"), page_blocks("<p>only")]
    labels = [[0, 1, 1], [0]]

    def loss(w):
        x = html_text.Inputs([b for p in pages for b in p]).vectors(w).astype(np.float64)
        logit, _ = html_text.forward(w, x, np.array([0, 3, 4]))
        p, y = html_text.sigmoid(logit), np.array([0, 1, 1, 0])
        return -np.mean(np.log(np.where(y == 1, p, 1 - p)))

    g = html_text.gradients(w, pages, labels)
    for k, at in (("on_x", (26, 5)), ("on_h", (3, 20)), ("back_h", (3, 40)), ("back_b", (50,)), ("out", (20,))):
        found = []
        for step in (1e-3, -1e-3):
            moved = {n: x.copy() for n, x in w.items()}
            moved[k][at] += step
            found.append(loss(moved))
        assert abs((found[0] - found[1]) / 2e-3 - g[k][at]) < 2e-4


def test_every_given_page(spark):
    """Markup of the given pages tells the article: the network must find it in all of them."""
    found = {r.page_id: r for r in op10_html_text(spark, SF_DIR).collect()}
    pages = table(spark, SF_DIR, "pages").collect()
    assert len(found) == len(pages)
    for page in pages:
        inside = page.html.split("<article>")[1].split("</article>")[0]
        text = inside
        for tag in ("b", "/b", "br"):
            text = text.replace(f"<{tag}>", " ")
        for tag in ("h1", "/h1", "p", "/p"):
            text = text.replace(f"<{tag}>", "\x00")
        blocks = [" ".join(references.unescape(t).split()) for t in text.split("\x00")]
        expected = "\n".join(b for b in blocks if b)
        assert found[page.page_id].text == expected
        assert found[page.page_id].n_chars == len(expected)


def test_other_layouts(weights):
    rng = np.random.default_rng(77)
    other = ["Contact us about this", "A notice of some length, which says little."]
    article = [f"Paragraph {i} of an article that goes on, with words in it." for i in range(9)]
    wrong = total = 0
    for _ in range(300):
        blocks, labels = html_text.laid_out(rng, article, other)
        found = html_text.article_blocks(weights, [blocks])[0]
        wrong, total = wrong + int((found != np.array(labels, bool)).sum()), total + len(labels)
    assert wrong < 0.02 * total


def test_odd_pages(spark, weights):
    long = "<article>" + "<p>word and word.</p>" * 20_000 + "</article>"
    rows = [(1, None), (2, ""), (3, "<nav>x</nav>"), (None, "<article><p>a&lt;b</p></article>"), (5, long), (5, long)]
    frame = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "1 as blocks", "2 as page", "3 as text")
    got = extract_text(frame, weights).select("page.page_id", "text").collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == 6 and by[1] == by[2] == "" and by[None] == "a<b"
    assert by[5].count("\n") == 19_999
    empty = frame.filter("false")
    assert extract_text(empty, fit_extractor(empty)).count() == 0


def test_head_without_end_and_formulas_stay():
    texts = lambda page: [b.text for b in page_blocks(page)]
    assert texts("<head><title>t</title><meta charset=u><article><p>a<p>b</article>") == ["a", "b"]
    assert texts("<html><head><script>x</script><title>t</title>\n<img src=s>a<p>b") == ["a", "b"]
    assert texts("<head><title>t</title> a<p>b") == ["a", "b"]
    assert texts("<head><noscript><link rel=r></noscript><style>s</style></head><p>a") == ["a"]
    assert texts("<head><noscript><link rel=r><p>a</noscript><p>b") == ["a", "b"]
    assert texts("<head><template><p>x</p></template><title>t</title></head><body>a") == ["a"]
    assert texts("<head><title>t</title><body><p>a") == ["a"]
    formula = "<math><mrow><mi>x</mi> <mo>=</mo> <mn>1</mn></mrow></math>"
    assert texts(f"<p>where {formula} holds</p>") == ["where x = 1 holds"]
    assert texts("<p>a</p><object data=d><p>b</p></object><noscript><p>c</p></noscript>") == ["a", "b", "c"]


def test_article_after_an_open_head(spark, weights):
    words = "A paragraph of an article that goes on, with <math><mi>y</mi></math> and words in it."
    page = "<head><title>t</title><article>" + f"<p>{words}" * 9 + "</article>"
    frame = spark.createDataFrame([(1, page)], "page_id long, html string")
    text = "A paragraph of an article that goes on, with y and words in it."
    assert extract_text(frame, weights).first().text == "\n".join([text] * 9)


def test_less_than_before_a_long_tail():
    texts = lambda page: [b.text for b in page_blocks(page)]
    tail = "goes on " * 5000 + "to its end"
    for sign in ("<5", "<3", "<", "< 5", "<=", "<é"):
        assert texts(f"<p>a<p>if x {sign} then it {tail}") == ["a", f"if x {sign} then it {tail}"]
    assert texts("<p>a <5 b <a href='x <5") == ["a <5 b"]
    for cut in ("</p", "<!-- b", "<?b", "<b class=x"):
        assert texts(f"<p>a {cut}") == ["a"]
