"""Leaf blocks of web pages: their text and the path of tags above them."""

import re
from html.parser import HTMLParser
from typing import NamedTuple

#: Elements whose content is no text of the page: scripts, styles, controls of forms, drawings and
#: other documents. They do not end the block that they stand in.
SILENT = {
    "script", "style", "title", "template", "textarea", "select", "button", "svg", "iframe",
    "head",
}
#: Of these, those that a block ends if their own end tag is missing.
BROKEN_OUT = {"select", "button", "svg"}
#: Elements that may stand in a head; any other, and text, ends it.
IN_HEAD = {"title", "meta", "link", "base", "script", "style", "noscript", "template"}
#: What opens a tag or a comment; any other "<" is text.
OPENING = re.compile(r"<[A-Za-z/!?]")
#: Elements that have no end tag.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
    "track", "wbr",
}
#: Elements that begin and end blocks; any other, known or not, stays within a block.
BLOCK_LEVEL = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "colgroup", "dd",
    "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "html",
    "legend", "li", "listing", "main", "menu", "nav", "noframes", "ol", "optgroup", "option", "p",
    "plaintext", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul", "xmp",
}
#: Elements that end an open element of the same kind.
ITEMS = {
    "li": {"ul", "ol", "menu"},
    "dt": {"dl"},
    "dd": {"dl"},
    "tr": {"table"},
    "td": {"tr", "table"},
    "th": {"tr", "table"},
    "option": {"select"},
}


#: Names of parts of a page that are not the article (fixed values).
NOT_ARTICLE = set(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead banner footer copyright "
    "sidebar widget ad ads advert adverts advertisement sponsor sponsored promo notice cookie "
    "cookies consent alert popup modal subscribe newsletter login signup search form comment "
    "comments reply replies discussion respond related recommended share social tags pagination "
    "contentinfo complementary".split()
)
#: Of these, those that an element named article may be: other people's or other texts.
OTHER_TEXTS = set("comment comments reply replies related recommended promo ad sponsored".split())
NOT_ARTICLE_TAGS = {"nav", "header", "footer", "aside", "form", "menu"}
ARTICLE = {"article", "main"}
#: Words of a name that make it tell of a state or a layout, not of a part ("no-sidebar").
STATES = set(
    "no not with without has is open opened closed fixed sticky off hide hidden show shown active "
    "enabled disabled layout wide narrow".split()
)
ATTRIBUTES = ("class", "id", "role", "itemprop", "aria-label")


class Block(NamedTuple):
    """``path``: the distinct names of the elements above, with their classes, ids and roles, from
    the outermost; ``inner``: the names of the innermost two; ``linked``: the share of characters
    within links; ``decided``: what the nearest element whose name tells makes of the block, 1 for
    the article, 0 for another part, None if no element tells."""

    path: tuple[str, ...]
    inner: tuple[str, ...]
    text: str
    linked: float
    decided: int | None = None


def attribute_words(attributes: list[tuple[str, str | None]]) -> list[list[str]]:
    """Each class, id, role or label as its parts, digits at their ends left out."""
    out = []
    for name, value in attributes:
        if name not in ATTRIBUTES or not value:
            continue
        for word in value.lower().split():
            clean = "".join(c if c.isalnum() else " " for c in word)
            if parts := [p.rstrip("0123456789") or p for p in clean.split()]:
                out.append(parts)
    return out


def element_names(tag: str, attributes: list[tuple[str, str | None]]) -> tuple[str, ...]:
    """The names that an element adds to the path of the blocks within it.

    Classes of the page as a whole say nothing of its parts. A name of several parts counts whole
    and by its parts, but whole only if it tells of a state, or belongs to an article.
    """
    names = [tag]
    if tag in ("html", "body"):
        return (tag,)
    for parts in attribute_words(attributes):
        whole = "-".join(parts)
        if tag in ARTICLE:
            names.append(f"{tag}.{whole}")
            continue
        names.append(f".{whole}")
        if not STATES & set(parts):
            names += [f".{p}" for p in parts if p != whole]
    return tuple(names)


def decision(tag: str, attributes: list[tuple[str, str | None]], outer: int | None) -> int | None:
    """What an element's name makes of the blocks within it, or else what those above it make."""
    if tag in ("html", "body"):
        return None
    named = [p for p in attribute_words(attributes) if not STATES & set(p)]
    if tag in ARTICLE:
        return 0 if any(p[0] in OTHER_TEXTS for p in named) else 1
    if any(p[0] in NOT_ARTICLE or p[-1] in NOT_ARTICLE for p in named):
        return 0
    if tag in NOT_ARTICLE_TAGS and not (tag == "header" and outer == 1):
        return 0
    return outer


class BlockParser(HTMLParser):
    """Collects blocks in page order. Unclosed and wrongly closed elements are tolerated."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, tuple[str, ...], int | None]] = []
        self.names: dict[str, int] = {}  # how often each name is open; no path is copied
        self.silent = 0
        self.links = 0
        self.parts: list[str] = []
        self.in_links = 0
        self.paths: dict[tuple[str, ...], tuple[str, ...]] = {}  # equal paths are one object

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            inner = tuple(name for _, names, _ in self.open[-2:] for name in names)
            path = tuple(self.names)
            path, inner = (self.paths.setdefault(x, x) for x in (path, inner))
            linked = min(1.0, self.in_links / len(text))
            decided = self.open[-1][2] if self.open else None
            self.blocks.append(Block(path, inner, text, linked, decided))
        self.parts, self.in_links = [], 0

    def close_to(self, at: int) -> None:
        for tag, names, _ in self.open[at:]:
            for name in names:
                self.names[name] -= 1
                if not self.names[name]:
                    del self.names[name]
            self.silent -= tag in SILENT
            self.links -= tag == "a"
        del self.open[at:]

    def close_last(self, tag: str, within: set[str] | None = None) -> bool:
        """Close the innermost ``tag``, if it is open and none of ``within`` is inside it."""
        if tag not in self.names:
            return False
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name == tag:
                self.close_to(at)
                return True
            if within and name in within:
                return False
        return False

    def break_out(self) -> None:
        """Close silent elements that hold no blocks, whose end tags are missing."""
        if self.silent:
            for name in BROKEN_OUT:
                self.close_last(name)

    def end_head(self) -> None:
        """Close a head, also one with an open noscript, whose end tag the page leaves out."""
        inner = [tag for tag, _, _ in self.open[-2:]]
        if inner and (inner[-1] == "head" or inner == ["head", "noscript"]):
            self.close_last("head")

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in IN_HEAD:
            self.end_head()
        if tag in VOID:
            if tag == "hr":
                self.end_block()
            elif tag == "br":
                self.parts.append(" ")
            return
        if tag in BLOCK_LEVEL and not (self.silent and tag in ("option", "optgroup")):
            self.break_out()
            if not self.silent:
                self.end_block()
                if tag in ITEMS:
                    self.close_last(tag, ITEMS[tag])
                self.close_last("p", {"td", "th", "li", "div", "section", "article", "object"})
        names = element_names(tag, attrs)
        outer = self.open[-1][2] if self.open else None
        self.open.append((tag, names, decision(tag, attrs, outer)))
        for name in names:
            self.names[name] = self.names.get(name, 0) + 1
        self.silent += tag in SILENT
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in BLOCK_LEVEL:
            return  # a slash does not close such an element
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in BLOCK_LEVEL:
            self.close_last(tag, {"td", "th", "table"})
            return
        if tag in self.names:
            self.break_out()
        if not self.silent:
            self.end_block()
            self.close_last(tag, {"td", "th", "table"} if tag == "p" else None)
        else:
            # What stands in a silent element closes nothing outside of it.
            self.close_last(tag, SILENT - {tag})

    def handle_data(self, data: str) -> None:
        if self.silent and data.strip():
            self.end_head()
        if not self.silent:
            self.parts.append(data)
            if self.links:
                self.in_links += len(data)


def page_blocks(html: str) -> list[Block]:
    tail = html.rfind(">") + 1
    cut = [tag.start() for tag in OPENING.finditer(html, tail)]
    if cut:
        html = html[: cut[-1]]  # a tag that the end of the page cuts off
    parser = BlockParser()
    # A marked section is a comment in a page, however it is written.
    parser.feed(html.replace("<![", "<!_["))
    parser.close()
    parser.end_block()
    return parser.blocks
