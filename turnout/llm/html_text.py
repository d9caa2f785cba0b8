"""HTML extraction: a recurrent network labels each block of a page as article or not.

A page is the sequence of its leaf blocks. A block is read as the mean vector of the hashed words
of its text, the sum of the vectors of the hashed names on its tag path, and a few measures. A
bidirectional LSTM, in numpy, reads the sequence both ways, so that each decision rests on the whole
page, and a logistic unit decides each block.

The pages carry no labels. The network learns from pages whose markup says what is what (an
article or main element, less the menus and other parts within it), and from the same texts set
again in other markup: layouts of named containers, with menus, notices, adverts, forms and reader
comments around and inside the article.
"""

import pickle
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnout.llm.blocks import Block, element_names, page_blocks
from turnout.llm.text import split_words, text_chunks, word_hashes

NAMES, WORDS, EMBED, MEASURES, HIDDEN = 1 << 13, 1 << 11, 12, 6, 16
INPUT = 2 * EMBED + MEASURES
#: Steps of a batch of pages, blocks times pages.
BATCH_BLOCKS = 1 << 14
LAYOUTS = 3000
#: Steps whose inputs are multiplied at once.
STEPS = 1 << 12
Weights = dict[str, np.ndarray]

#: Containers of training layouts (fixed values): paths of element and class.
ARTICLE_PATHS = (
    "body article p|body main article p|body main p|body div.content p|body div.post-body p|"
    "body div#content div.entry-content p|body div.article-body section p|"
    "body div.page div.story p|body div.container div.main-content p|body article div.text p|"
    "body article section p|body div#main div.post p|body article ul li|"
    "body main div.article blockquote|body div.wrapper article p|"
    "body table tr td div.article p|body article header h1|body div.main article h2|"
    "body div.main p|body div#main section p|body div.main div.text p"
).split("|")
#: Elements around all of a page (fixed values), some with names that tell of a layout.
WRAPS = (
    "", "div", "div.page", "div.wrapper div", "div#page div.site", "div.page-with-sidebar",
    "div.no-sidebar div", "div.has-banner", "div.layout-wide", "div#root div.app", "center",
    "table tr td", "div.container div.row", "div.comments-open", "div.header-fixed div.outer",
)
OTHER_PATHS = (
    "nav ul li a|header div|header nav a|header p|div.menu ul li a|div.navbar a|ul.nav li a|"
    "ul.menu li a|div.breadcrumb a|div#header p|div.header h2|div.site-header p|"
    "div.masthead div|footer|footer p|footer div a|div.footer p|div#footer div|div.copyright|"
    "aside p|aside ul li a|aside h3|div.sidebar p|div.sidebar ul li|div#sidebar div|"
    "div.widget ul li a|div.ad|div.ads p|div.advert p|div.advertisement span|div.sponsored p|"
    "div.promo a|div#ad div|section.ad p|div.notice p|div.cookie-notice p|div.cookie-banner p|"
    "div#cookie-consent div|div.alert p|div.banner p|p.notice|div.popup p|div.modal p|"
    "div.newsletter p|div.subscribe p|form p|form label|form div span|div.search form label|"
    "div.login form p|div.signup p|section.comments p|section#comments div.comment p|"
    "div.comments div p|div#comments ul li p|ol.comment-list li p|div.comment p|"
    "div.comment-body p|article.comment p|div.replies p|div.discussion p|div#respond p|"
    "div.related ul li a|div.recommended a|div.share a|div.social ul li a|div.tags a|"
    "div.pagination a|section.comments h2|div#comments h3|div.related h3|aside h2|div.sidebar h2"
).split("|")


@lru_cache(1 << 14)
def name_cells(path: tuple[str, ...], inner: tuple[str, ...]) -> np.ndarray:
    """Cells of the distinct names of a path, and of its innermost elements."""
    names = {*path, *(f"in {n}" for n in inner)}
    return np.array(sorted(crc32(n.encode()) % NAMES for n in names) or [0])


def measures(blocks: list[Block]) -> np.ndarray:
    rows = []
    for b in blocks:
        size = len(b.text)
        rows.append(
            (
                np.log1p(size) / 6,
                b.linked,
                sum(c.isdigit() for c in b.text[:1]) * 0.5 + b.text.count("|") / size,
                b.text.count("©") * 0.5,
                (b.text.count(".") + b.text.count(",")) / size * 10,
                len(b.path) / 10,
            )
        )
    return np.array(rows, np.float32).reshape(-1, MEASURES)


class Inputs:
    """Blocks as index lists into the vectors of names and words, and measures."""

    def __init__(self, blocks: list[Block]) -> None:
        names = [name_cells(b.path, b.inner) for b in blocks]
        words = split_words([b.text.lower().encode("utf-8", "replace") for b in blocks])
        self.names = np.concatenate([*names, np.empty(0, np.int64)]).astype(np.int64)
        self.name_of = np.repeat(np.arange(len(blocks)), [len(n) for n in names])
        self.words = (word_hashes(words) % np.uint64(WORDS)).astype(np.int64)
        count = np.diff(words.first)
        self.word_of = np.repeat(np.arange(len(blocks)), count)
        self.word_share = (1 / np.maximum(1, count)).astype(np.float32)
        self.measures = measures(blocks)

    def vectors(self, w: Weights) -> np.ndarray:
        n = len(self.measures)
        out = np.empty((n, INPUT), np.float32)
        for k in range(EMBED):
            out[:, k] = np.bincount(self.name_of, w["names"][self.names, k], n)
            sums = np.bincount(self.word_of, w["words"][self.words, k], n)
            out[:, EMBED + k] = sums * self.word_share
        out[:, 2 * EMBED :] = self.measures
        return out

    def gradients(self, d: np.ndarray) -> Weights:
        shared = d[:, EMBED : 2 * EMBED] * self.word_share[:, None]
        return {
            "names": np.stack(
                [np.bincount(self.names, d[self.name_of, k], NAMES) for k in range(EMBED)], 1
            ).astype(np.float32),
            "words": np.stack(
                [np.bincount(self.words, shared[self.word_of, k], WORDS) for k in range(EMBED)], 1
            ).astype(np.float32),
        }


def initial(rng: np.random.Generator) -> Weights:
    w = {"names": np.zeros((NAMES, EMBED)), "words": np.zeros((WORDS, EMBED))}
    w["names"] += rng.standard_normal((1, EMBED)) * 0.05
    for side in ("on", "back"):
        w[f"{side}_x"] = rng.standard_normal((INPUT, 4 * HIDDEN)) * 0.2
        w[f"{side}_h"] = rng.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.2
        w[f"{side}_b"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
    w["out"] = rng.standard_normal(2 * HIDDEN) * 0.2
    w["out_b"] = np.zeros(1)
    return {k: x.astype(np.float32) for k, x in w.items()}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lstm(
    w: Weights, side: str, x: np.ndarray, live: np.ndarray, taped: bool = True
) -> tuple[np.ndarray, list]:
    """States (steps, pages, HIDDEN) of one direction; where a page has ended nothing changes. The
    tape of all steps, which gradients need, is kept only if asked for."""
    steps, pages, _ = x.shape
    h, c = np.zeros((2, pages, HIDDEN), np.float32)
    out, tape = np.zeros((steps, pages, HIDDEN), np.float32), []
    for t in range(steps):
        if t % STEPS == 0:
            gates = x[t : t + STEPS] @ w[f"{side}_x"] + w[f"{side}_b"]
        g = gates[t % STEPS] + h @ w[f"{side}_h"]
        i, f, o = np.split(sigmoid(g[:, : 3 * HIDDEN]), 3, axis=1)
        z = np.tanh(g[:, 3 * HIDDEN :])
        new = f * c + i * z
        on, bent = live[t][:, None], np.tanh(new)
        if taped:
            tape.append((h, c, i, f, o, z, bent))
        h, c = np.where(on, o * bent, h), np.where(on, new, c)
        out[t] = h
    return out, tape


def lstm_gradients(
    w: Weights, side: str, x: np.ndarray, live: np.ndarray, tape: list, d_out: np.ndarray
) -> tuple[np.ndarray, Weights]:
    steps, pages, _ = x.shape
    d_gates = np.zeros((steps, pages, 4 * HIDDEN), np.float32)
    d_h, d_c = np.zeros((2, pages, HIDDEN), np.float32)
    d_wh = np.zeros_like(w[f"{side}_h"])
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, z, new = tape[t]
        on = live[t][:, None]
        d_h = d_h + d_out[t]
        d_new = np.where(on, d_c + d_h * o * (1 - new * new), 0)
        d_o = np.where(on, d_h * new, 0)
        d_i, d_f = d_new * z * i * (1 - i), d_new * c * f * (1 - f)
        g = np.concatenate([d_i, d_f, d_o * o * (1 - o), d_new * i * (1 - z * z)], 1)
        d_gates[t] = g
        d_wh += h.T @ g
        d_h = np.where(on, g @ w[f"{side}_h"].T, d_h)
        d_c = np.where(on, d_new * f, d_c)
    flat = d_gates.reshape(-1, 4 * HIDDEN)
    d_wx = x.reshape(-1, INPUT).T @ flat
    grads = {f"{side}_h": d_wh, f"{side}_x": d_wx, f"{side}_b": flat.sum(0)}
    return d_gates @ w[f"{side}_x"].T, grads


def padded(vectors: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pages side by side: (steps, pages, INPUT), which steps are live, and the step and page of
    each block."""
    count = np.diff(first)
    page = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(vectors)) - first[page]
    x = np.zeros((int(count.max()), len(count), INPUT), np.float32)
    x[step, page] = vectors
    live = np.arange(len(x))[:, None] < count
    return x, live, np.stack([step, page])


def forward(
    w: Weights, vectors: np.ndarray, first: np.ndarray, taped: bool = True
) -> tuple[np.ndarray, tuple]:
    x, live, at = padded(vectors, first)
    on, on_tape = lstm(w, "on", x, live, taped)
    back, back_tape = lstm(w, "back", x[::-1], live[::-1], taped)
    states = np.concatenate([on[at[0], at[1]], back[::-1][at[0], at[1]]], 1)
    return states @ w["out"] + w["out_b"], (x, live, at, on_tape, back_tape, states)


def gradients(w: Weights, pages: list[list[Block]], labels: list[list[int]]) -> Weights:
    inputs = Inputs([b for page in pages for b in page])
    first = np.cumsum([0] + [len(p) for p in pages])
    logit, (x, live, at, on_tape, back_tape, states) = forward(w, inputs.vectors(w), first)
    known = np.array([y for page in labels for y in page], np.float32)
    d = ((sigmoid(logit) - known) / len(known)).astype(np.float32)
    g: Weights = {"out": states.T @ d, "out_b": np.array([d.sum()])}
    d_states = d[:, None] * w["out"]
    d_on, d_back = np.zeros((2, *x.shape[:2], HIDDEN), np.float32)
    d_on[at[0], at[1]], d_back[at[0], at[1]] = d_states[:, :HIDDEN], d_states[:, HIDDEN:]
    dx, on = lstm_gradients(w, "on", x, live, on_tape, d_on)
    dx_back, back = lstm_gradients(w, "back", x[::-1], live[::-1], back_tape, d_back[::-1])
    g |= on | back
    return g | inputs.gradients((dx + dx_back[::-1])[at[0], at[1]])


@lru_cache(1 << 14)
def named(element: str) -> tuple[str, ...]:
    """Names of an element written as tag, tag.class or tag#id."""
    tag, sign, word = element.replace("#", ".").partition(".")
    return element_names(tag, [("class", word)] if sign else [])


def laid_out(
    rng: np.random.Generator, article: list[str], other: list[str]
) -> tuple[list[Block], list[int]]:
    """Texts set in a layout drawn at random, and which blocks are the article."""

    def block(path: str, text: str, within: str = "html body") -> Block:
        elements = f"{within} {path}".split()
        linked = float(elements[-1] == "a")
        # Inline elements end before their block does.
        last = len(elements) - 1
        elements = [e for i, e in enumerate(elements) if e not in ("a", "span") or i == last]
        names = [named(e) for e in elements]
        flat = dict.fromkeys(n for each in names for n in each)
        return Block(tuple(flat), tuple(n for each in names[-2:] for n in each), text, linked)

    def others(count: int, within: str) -> list[tuple[Block, int]]:
        out = []
        for _ in range(count):
            path = OTHER_PATHS[rng.integers(len(OTHER_PATHS))]
            # Reader comments and notices may be as long as an article's paragraphs.
            pool = article if rng.random() < 0.5 and not path.endswith(" a") else other
            for _ in range(int(rng.integers(1, 6))):
                text = pool[rng.integers(len(pool))]
                short = " ".join(text.split()[: int(rng.integers(1, 5))])
                out.append((block(path, short if path.endswith(" a") else text, within), 0))
        return out

    shape = ARTICLE_PATHS[rng.integers(len(ARTICLE_PATHS))].removeprefix("body ")
    outside = " ".join(["html body", *WRAPS[rng.integers(len(WRAPS))].split()])
    if rng.random() < 0.3:
        outside += f" div.{''.join(rng.choice(list('abcdefgh'), 6))}"  # names that mean nothing
    inside = " ".join([outside, *shape.split()[:-1]])
    rows = others(int(rng.integers(0, 4)), outside)
    if rng.random() < 0.7:
        rows.append((block(" ".join([*shape.split()[:-1], "h1"]), article[0], outside), 1))
    for text in article[: int(rng.integers(1, 12))]:
        tag = ("p", "p", "p", "p", "h2", "li", "blockquote", "div")[rng.integers(8)]
        path = " ".join([*shape.split()[:-1], tag]) if rng.random() < 0.5 else shape
        path = path + " b" * (rng.random() < 0.1)
        rows.append((block(path, text, outside), 1))
        if rng.random() < 0.35:
            rows += others(1, inside if rng.random() < 0.8 else outside)
    rows += others(int(rng.integers(0, 4)), outside)
    return [b for b, _ in rows], [y for _, y in rows]


def marked_up(blocks: list[Block]) -> list[int] | None:
    """Labels by the page's own markup, by the nearest element that tells; None if it has no article
    or main element."""
    labels = [int(b.decided == 1) for b in blocks]
    return labels if any(labels) else None


def train(pages: list[str], epochs: int = 5, batch: int = 32, seed: int = 5) -> Weights:
    """Weights fitted by Adam to marked-up pages and to LAYOUTS layouts of their texts."""
    rng = np.random.default_rng(seed)
    w = initial(rng)
    known: list[tuple[list[Block], list[int]]] = []
    article, other = [["The text of an article, in a sentence or two."]], ["Menu", "Contact us"]
    for html in pages:
        blocks = page_blocks(html)
        labels = marked_up(blocks)
        if labels:
            known.append((blocks, labels))
            article.append([b.text for b, y in zip(blocks, labels) if y])
            other += [b.text for b, y in zip(blocks, labels) if not y]
    for _ in range(LAYOUTS):
        known.append(laid_out(rng, article[rng.integers(len(article))], other))
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    step, total = 0, epochs * -(-len(known) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(known))
        for at in range(0, len(order), batch):
            rows = [known[i] for i in order[at : at + batch]]
            g = gradients(w, [r[0] for r in rows], [r[1] for r in rows])
            step += 1
            rate = 2e-2 * (1 - step / (total + 1)) + 5e-4
            for k, x in g.items():
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                scale = np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7
                w[k] = w[k] - (rate * m[k] / (1 - 0.9**step) / scale).astype(np.float32)
    return w


def article_blocks(w: Weights, pages: list[list[Block]]) -> list[np.ndarray]:
    """Which blocks of each page are the article. Pages of like length are read together."""
    out = [np.empty(0, bool) for _ in pages]
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    while order:
        take, longest = 1, len(pages[order[-1]])
        while take < len(order) and (take + 1) * longest <= BATCH_BLOCKS:
            take += 1
        rows, order = order[-take:], order[:-take]
        inputs = Inputs([b for i in rows for b in pages[i]])
        first = np.cumsum([0] + [len(pages[i]) for i in rows])
        logit, _ = forward(w, inputs.vectors(w), first, taped=False)
        for i, a, b in zip(rows, first, first[1:]):
            out[i] = logit[a:b] > 0
    return out


def fit_extractor(
    pages: DataFrame, html: str = "html", rows: int = 400, longest: int = 1 << 16
) -> Weights:
    """Weights learnt from at most ``rows`` pages of at most ``longest`` bytes, those with the
    least hashes: the bound on what the driver holds, 26 MB at most, whatever the table's size.

    The hashes are picked first, and only these pages are fetched, equal ones once.
    """
    text = F.col(f"`{html}`")
    short = pages.select(text.alias("html"), F.xxhash64(text).alias("hash"))
    short = short.filter(F.col("html").isNotNull() & (F.octet_length("html") <= longest))
    hashes = short.select("hash").distinct().orderBy("hash").limit(rows)
    least = hashes.agg(F.max("hash")).first()[0]
    if least is None:
        return train([])
    sample = short.filter(F.col("hash") <= least).groupBy("hash").agg(F.min("html").alias("html"))
    return train(sorted(r.html for r in sample.collect()))


def extract_text(
    pages: DataFrame, weights: Weights, html: str = "html"
) -> DataFrame:
    """All other columns in a struct ``page``, ``text`` and ``blocks``, the texts that make it up.

    Null, empty and wholly silent pages have the empty text and no blocks. Character references are
    decoded, white space within a block becomes one space, blocks are joined by line ends. Any
    markup, however broken or deep, gives some blocks; every block of the page is read.
    """
    held = pages.sparkSession.sparkContext.broadcast(pickle.dumps(weights))
    rest = [c for c in pages.columns if c != html]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = pickle.loads(held.value)
        for part, chunk in text_chunks(batches, "html", 1 << 20):
            parsed = [page_blocks(t.decode("utf-8", "replace")) for t in chunk]
            kept = [
                [b.text for b, y in zip(page, marks) if y]
                for page, marks in zip(parsed, article_blocks(w, parsed))
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(kept, pa.list_(pa.string()))], ["page", "blocks"]
            )

    rows = pages.select(
        F.struct(*(F.col(f"`{c}`") for c in rest)).alias("page"),
        F.col(f"`{html}`").cast("binary").alias("html"),
    )
    schema = rows.select("page").schema.add("blocks", T.ArrayType(T.StringType()))
    found = rows.mapInArrow(extract, schema)
    return found.withColumn("text", F.array_join("blocks", "\n"))
