"""Hand-written pages in many layouts, with texts that no training page has: the whole text of each
page is compared."""

import pytest

from turnout.llm.blocks import page_blocks
from turnout.llm.html_text import article_blocks, fit_extractor
from turnout.llm.tables import table

SF_DIR = "/root/testdata/sf0.01"
TITLE = "How the old bridge was saved"
TEXTS = [
    "The bridge over the river was built by hand, and for two hundred years it carried carts to market.",
    "When the council wanted it gone, the people of the village met in the school and wrote a letter.",
    "It took four winters, a great deal of stone and the patience of a mason who came out of retirement.",
    "Today the bridge is open again, and on Sundays the children fish from it, as their parents did.",
]
PARAGRAPHS = "".join(f"<p>{t}</p>" for t in TEXTS)
ARTICLE = f"<h1>{TITLE}</h1>{PARAGRAPHS}"
EXPECTED = "\n".join([TITLE, *TEXTS])
NAV = "<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li><li><a href=/c>Contact</a></li></ul></nav>"
FOOT = "<footer><p>© 2024 The Valley Paper</p></footer>"
ASIDE = "<aside><h3>Most read</h3><ul><li><a href=/1>Rain again</a></li><li><a href=/2>Market day</a></li></ul></aside>"
COMMENTS = (
    '<section class="comments"><h2>Comments</h2><div class="comment"><p>Anna: I remember the letter well, '
    "my father signed it and so did all of our neighbours.</p></div></section>"
)
BODY_CLASSES = [
    "single", "no-sidebar", "comments-open", "has-banner", "page menu-open", "header-fixed",
    "no-comments layout-wide", "modal-open", "post-template-default single-post with-sidebar",
    "sidebar footer-visible nav-down",
]


def framed(article, before=NAV, after=FOOT, attributes=""):
    return f"<!DOCTYPE html><html><head><title>t</title></head><body{attributes}>{before}{article}{after}</body></html>"


PLAIN = f"<article>{ARTICLE}</article>"
LAYOUTS = {f"body class {c}": framed(PLAIN, attributes=f' class="{c}"') for c in BODY_CLASSES}
LAYOUTS |= {f"html class {c}": f'<html class="{c}"><body>{NAV}{PLAIN}{FOOT}' for c in ("no-js ad-free", "search menu")}
LAYOUTS |= {
    f"around {around}": framed(f"<div class='{around}'>{PLAIN}</div>")
    for around in (
        "page-with-sidebar", "site-content", "layout layout--two", "outer", "o-grid o-grid--wide", "no-comments",
        "wrap with-header", "u-clearfix", "content-area has-footer", "container is-open",
    )
}
LAYOUTS |= {
    f"article class {c}": framed(f'<article class="{c}">{ARTICLE}</article>')
    for c in ("post share-price tags-economy", "hentry category-search", "story related-topics", "type-post status-publish")
}
LAYOUTS |= {
    "article and aside": framed(PLAIN + ASIDE),
    "aside before": framed(ASIDE + PLAIN),
    "comments after": framed(PLAIN + COMMENTS),
    "comments within": framed(f"<article>{ARTICLE}{COMMENTS}</article>"),
    "all around": framed(PLAIN + ASIDE + COMMENTS, attributes=' class="comments-open has-sidebar"'),
    "main": framed(f"<main>{ARTICLE}</main>"),
    "main and article": framed(f"<main id=content><article>{ARTICLE}</article></main>"),
    "div main within sidebar page": framed(f"<div class='page-with-sidebar'><div class='main'>{ARTICLE}</div></div>"),
    "content div": framed(f"<div class='content'>{ARTICLE}</div>"),
    "entry content": framed(f"<div class='entry-content'>{ARTICLE}</div>"),
    "header of the article": framed(f"<article><header><h1>{TITLE}</h1></header>{PARAGRAPHS}</article>"),
    "sections": framed(f"<article><h1>{TITLE}</h1>" + "".join(f"<section><p>{t}</p></section>" for t in TEXTS) + "</article>"),
    "advert within": framed(
        f"<article><h1>{TITLE}</h1><p>{TEXTS[0]}</p><p>{TEXTS[1]}</p><div class='ad'>Cheap boats, this week only</div>"
        f"<p>{TEXTS[2]}</p><p>{TEXTS[3]}</p></article>"
    ),
    "cookie notice": framed(PLAIN, before="<div class='cookie-notice'><p>We use cookies to make this site work.</p></div>" + NAV),
    "form after": framed(PLAIN + "<form><label>Your mail</label><input><button>Subscribe</button></form>"),
    "breadcrumbs": framed(PLAIN, before=NAV + "<div class='breadcrumbs'><a href=/>Home</a> <a href=/n>News</a></div>"),
    "no closing tags": f"<html><body>{NAV}<article><h1>{TITLE}</h1>" + "".join(f"<p>{t}" for t in TEXTS) + "</article>" + FOOT,
    "upper case": framed(f"<ARTICLE CLASS='Post'><H1>{TITLE}</H1>{PARAGRAPHS}</ARTICLE>"),
    "spans and links": framed(
        f"<article><h1><span>{TITLE}</span></h1><p><a href=/b>The bridge</a>{TEXTS[0][10:]}</p>"
        + "".join(f"<p><em>{t}</em></p>" for t in TEXTS[1:]) + "</article>"
    ),
    "script within a paragraph": framed(
        f"<article><h1>{TITLE}</h1><p>{TEXTS[0][:30]}<script>var a = '<p>x</p>';</script>{TEXTS[0][30:]}</p>"
        + "".join(f"<p>{t}</p>" for t in TEXTS[1:]) + "</article>"
    ),
    "own elements": framed(f"<x-app><x-page>{PLAIN}</x-page></x-app>"),
    "share buttons": framed(f"<article>{ARTICLE}</article><div class='share'><a href=/f>Share</a> <a href=/t>Post</a></div>"),
    "modal": framed(PLAIN, after="<div class='modal'><p>Sign up for our letter</p></div>" + FOOT),
}


@pytest.fixture(scope="module")
def weights(spark):
    return fit_extractor(table(spark, SF_DIR, "pages"))


def text_of(weights, page):
    blocks = page_blocks(page)
    return "\n".join(b.text for b, y in zip(blocks, article_blocks(weights, [blocks])[0]) if y)


def test_there_are_many_layouts():
    assert len(LAYOUTS) >= 40


@pytest.mark.parametrize("name", LAYOUTS)
def test_layout(weights, name):
    assert text_of(weights, LAYOUTS[name]) == EXPECTED


@pytest.mark.parametrize(
    "inside, text",
    [
        ("super<wbr>cali", "supercali"), ("a<img src=x>b", "ab"), ("a<br>b", "a b"), ("a <!-- x --> b", "a b"),
        ("one <script>..</script> two", "one two"), ("one <style>p{}</style> two", "one two"),
        ("one <button>Share</button> two", "one two"), ("one <svg><title>t</title><path/></svg>two", "one two"),
        ("one <iframe src=x>no</iframe> two", "one two"), ("one <video src=x>two</video>", "one two"),
        ("one <object data=d>two</object>", "one two"), ("<x-y>one</x-y> <unknown>two</unknown>", "one two"),
        ("one <select><option>x<option>y</select>two", "one two"), ("one <textarea>x</textarea>two", "one two"),
        ("one <template><div><p>x</p></div></template>two", "one two"), ("on<b>e</b>\n\ttwo", "one two"),
    ],
)
def test_what_stands_in_a_paragraph_does_not_end_it(inside, text):
    assert [b.text for b in page_blocks(f"<p>before</p><p>{inside}</p><p>after</p>")] == ["before", text, "after"]


def test_unclosed_controls_lose_nothing_after_them():
    for name in ("button", "select", "svg"):
        blocks = page_blocks(f"<div><p>one <{name}>x<p>two</p></div><p>three")
        assert [b.text for b in blocks] == ["one", "two", "three"]
        assert all(name not in b.path for b in blocks)
        assert [b.text for b in page_blocks(f"<p>one <{name}>x</p>two")] == ["one", "two"]


def test_nearest_element_that_tells_decides():
    def decided(page):
        return [b.decided for b in page_blocks(page)]

    assert decided("<body class=sidebar><p>a") == [None]
    assert decided("<div class=sidebar><article><p>a") == [1]
    assert decided("<article><div class=site-sidebar><p>a") == [0]
    assert decided("<article><div class=no-sidebar><p>a") == [1]
    assert decided("<article class='comment odd'><p>a") == [0]
    assert decided("<article class='share-price'><header><h1>a</h1></header><footer>b") == [1, 0]
    assert decided("<header><h1>a") == [0]


def test_long_page_takes_little_memory(weights):
    import tracemalloc

    blocks = page_blocks("<article>" + "<p>word and word.</p>" * 400_000 + "</article>")
    tracemalloc.start()
    found = article_blocks(weights, [blocks])[0]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.all() and len(found) == 400_000
    assert most < 500 << 20
