"""Main text of HTML pages from flat text blocks and a decision tree.

A page is cut into flat blocks at block-level tags. A block's features are its word count and
link density, those of its neighbours, and the kinds of region it stands in. A decision tree, grown on the labelled pages
below and on those of ``labelled_pages``, tells content from boilerplate: by region where a page
names its regions, by counts and neighbours where it does not.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled_pages import labelled_pages

#: A quote counts only after "="; one that is not closed runs to the page's end. Nothing backtracks.
_PIECE = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*+)(>|\Z)|[^<]+|<""", re.S)
_CLASS = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
#: The marker of the labelled table.
_KEEP = re.compile(r"(?:^|\s)data-keep=([01])(?=[\s/]|$)")
#: Elements whose content is no text.
RAW = frozenset("script style noscript template svg math iframe object canvas audio video select textarea title".split())
#: Those of them whose content is no markup either, up to their end tag.
RAW_TEXT = frozenset("script style textarea title iframe noscript".split())
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW_TEXT}
_SCRIPT = re.compile(r"<!(?=--)|-->|</?script(?=[\s/>]|\Z)", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Kinds of region by tag, and by words in class, id or role.
REGION_TAGS = {"nav": "nav", "menu": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "button": "form", "dialog": "notice", "article": "article", "main": "article", "head": "head"}
REGION_WORDS = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs",
    "header": "header masthead topbar banner",
    "footer": "footer copyright colophon",
    "aside": "sidebar aside related recommended trending widget rail share social tags complementary",
    "form": "form search subscribe newsletter signup login",
    "notice": "cookie cookies consent notice alert popup modal gdpr disclaimer overlay",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted banner-ad",
    "comment": "comment comments disqus replies reply respond discussion",
    "article": "article content post story entry body main",
}
#: Kinds of region that hold for an article within them, too: by tag, or by a whole class, id or role.
#: Others, and parts of names as in "has-comments", say nothing of an article or main element inside.
FIRM_TAGS, FIRM_WORDS = frozenset({"nav", "footer", "aside", "dialog"}), frozenset({"comment", "ad"})
_WORD_REGION = {w: kind for kind, words in REGION_WORDS.items() for w in words.split()}
KINDS = ("nav", "header", "footer", "aside", "form", "notice", "ad", "comment", "article", "head")
#: Elements that an opening tag of the same kind closes.
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())

LONG = "This is a long run of words that says little and yet says it at some length, so that the number of its words alone would pass for a paragraph of the text itself"
#: Boilerplate long and short, with and without links, beside text of one and two blocks.
VARIANTS = (
    (f"<p data-keep=0>{LONG}.</p>", f"<p data-keep=1>{LONG}, and on it goes.</p>"),
    (f"<p data-keep=0>{LONG}.</p><p data-keep=0>{LONG} with <a>a link</a>.</p>", f"<p data-keep=1>{LONG} with <a>a link</a>.</p><p data-keep=1>{LONG}, so it ends.</p>"),
    ("<p data-keep=0>A few words.</p><p data-keep=0><a>And a link</a></p>", f"<p data-keep=1>{LONG}.</p><p data-keep=1>{LONG} with <a>a link</a>.</p>"),
)
#: Short blocks of a text, with and without a link.
SHORT = "<p data-keep=1>Yes.</p><p data-keep=1><a>A link alone</a></p><p data-keep=1>A few words, no more.</p>"
#: The labelled table: pages whose blocks carry 1 (main text) or 0 in data-keep.
LABELLED = (
    '<nav><ul><li data-keep=0><a>Home</a></li><li data-keep=0><a>News</a></li><li data-keep=0>About us</li></ul></nav><div class="ad"><p data-keep=0>Buy these fine shoes at half the price today and never look back.</p></div>'
    "<article><h1 data-keep=1>A short title</h1><p data-keep=1>A first paragraph with a good number of words, such as articles have as a rule in practice.</p><p data-keep=1>Short.</p><p data-keep=1>See <a>this page</a> for more on it.</p></article><footer data-keep=0>All about us, a company with a long name and an address of many words.</footer>",
    '<header><h1 data-keep=0>Site name</h1><p data-keep=0>The best site of all for news and more news, day and night.</p></header><main><article><header><h1 data-keep=1>The title of it</h1></header><p data-keep=1>Text of some length that goes on for a while and then ends.</p><ul><li data-keep=1>one point</li><li data-keep=1>another point</li></ul></article></main>'
    '<aside><h3 data-keep=0>Related</h3><p data-keep=0>More to read on the same subject, by the same author, here and now.</p></aside><div class="comments"><p data-keep=0>I liked this text a lot and would like to say so at some length.</p></div>',
    '<div class="cookie-notice"><p data-keep=0>We use cookies to make this site work and to learn how you use it.</p></div><div class="content"><p data-keep=1>The text of this page stands in a plain container with many words in it.</p><p data-keep=1>Yes.</p></div><form><p data-keep=0>Subscribe to our letter and get all the news by mail each week.</p></form>'
    '<div class="sidebar"><p data-keep=0>Popular this week: a long list of things that many people read.</p></div>',
    "<div><a data-keep=0>Home</a></div><div data-keep=0><a>One</a> | <a>Two</a> | <a>Three</a></div><p data-keep=1>A page with no regions at all, whose text is told by its many words and few links alone.</p><p data-keep=1>It goes on with a second paragraph, which has enough words to be told as well as the first.</p><div data-keep=0><a>Next page</a></div>",
    '<article><h1 data-keep=1>Title</h1><p data-keep=1>Words and words and words, and then a few more words.</p><nav><p data-keep=0><a>Share</a></p></nav><div class="advert"><p data-keep=0>Sponsored: a thing you should buy at once, since it is good and cheap.</p></div><p data-keep=1>The end.</p>'
    '<aside><p data-keep=0>A note on the author, who writes here from time to time on many things.</p></aside><section class="comments"><p data-keep=0>First!</p><p data-keep=0>What a fine text, said a reader at length, and went on to say more.</p></section></article>',
    '<main><p data-keep=1>One.</p><h2 data-keep=1>Part two</h2><p data-keep=1>More text, this time in a main element and of a fair number of words in all.</p><form><label data-keep=0>Your mail</label></form><footer><p data-keep=0>Filed under many things.</p></footer></main><footer><p data-keep=0>Legal words, terms of use, and so on and so forth.</p></footer>',
    '<div id="menu"><p data-keep=0>Menu</p></div><div class="post"><h1 data-keep=1>On things</h1><p data-keep=1>Things are many, and this text is about a few of them.</p></div><div role="complementary"><p data-keep=0>Things you may also like, as others who came here did.</p></div><div class="newsletter"><p data-keep=0>Join us and many others.</p></div>',
    *(f"<{tag}>{boiler}</{tag}>{around}" for tag in ("nav", "header", "footer", "aside", "form") for boiler, around in VARIANTS),
    *(f'<div class="{name}">{boiler}</div>{around}' for name in ("cookie", "ad", "comments", "sidebar") for boiler, around in VARIANTS),
    *(f'<div class="content">{SHORT}<p data-keep=1>{LONG}.</p>{SHORT}</div><{tag}>{boiler}</{tag}>' for tag in ("nav", "header", "footer", "aside", "form") for boiler, _ in VARIANTS),
    *(f"{around}<{tag}>{boiler}</{tag}>" for tag in ("nav", "header", "footer", "aside", "form") for boiler, around in VARIANTS),
    *(f'<article><h1 data-keep=1>Title</h1>{around}{SHORT}<div class="{name}">{boiler}</div><p data-keep=1>So it ends.</p></article>' for name in ("cookie", "ad", "comments", "related", "newsletter", "breadcrumb", "colophon") for boiler, around in VARIANTS),
)
#: Further labelled pages made by rule: their number and seed.
PAGES, SEED = 400, 1


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    regions: frozenset = frozenset()
    heading: bool = False
    keep: str | None = None
    text: str = ""


def past_raw(page: str, at: int, tag: str) -> int:
    """Where the page goes on after the end tag of the raw text that begins at ``at``.

    In a script, end tags of scripts opened within "<!--" do not count, unless none is left then.
    """
    end = first = _RAW_END[tag].search(page, at)
    if tag == "script" and first:
        hidden = opened = False
        for end in _SCRIPT.finditer(page, at):
            mark = end[0].lower()
            if mark == "<!":
                hidden = True
            elif mark == "-->":
                hidden = opened = False
            elif mark == "<script":
                opened = hidden
            elif opened:
                opened = False
            else:
                break
        else:
            end = first
    close = page.find(">", end.end()) if end else -1
    return close + 1 if close >= 0 else len(page)


def blocks_of(page: str, labelled: bool = True) -> list[Block]:
    """The flat blocks of a page, in order, white space in each made one space; empty ones go.

    ``labelled``: the page is of the labelled table, and data-keep is read; else it means nothing.
    """
    out: list[Block] = []
    stack: list[tuple[str, frozenset, frozenset]] = []  # tag, kinds of region, those that hold for articles
    open_tags: Counter = Counter()
    block, links, raw = Block(), 0, None
    keep = None

    def close():
        nonlocal block
        block.text = " ".join(entities.unescape("".join(block.parts)).split())
        if block.text:
            out.append(block)
        block = Block()

    def end(k):
        tag = stack.pop(k)[0]
        open_tags[tag] -= 1
        return tag

    at = 0
    while m := _PIECE.match(page, at):
        at = m.end()
        tag = m[2]
        if raw:
            tag = tag.lower() if tag and m[4] else None
            if tag == raw and m[1]:
                raw = None
            elif tag in RAW_TEXT and not m[1] and not m[3].rstrip().endswith("/"):
                at = past_raw(page, at, tag)
            continue
        if tag is None:
            piece = m[0]
            if piece.startswith(("<!", "<?")):
                continue
            if not block.parts:
                block.regions = stack[-1][1] if stack else frozenset()
                block.heading = bool(stack) and any(s[0] in HEADINGS for s in stack[-2:])
                block.keep = keep
            block.parts.append(piece)
            block.linked += len(piece.split()) if links else 0
            continue
        if not m[4]:
            continue  # the page ends within a tag
        tag = tag.lower()
        if tag == "a":
            links = 0 if m[1] else 1
        if tag == "br" and block.parts:
            block.parts.append(" ")
        if labelled and (marker := _KEEP.search(m[3])):
            keep = marker[1]
        if tag in RAW and not m[1]:
            if tag != "title":
                block.parts and block.parts.append(" ")
            if m[3].rstrip().endswith("/"):
                continue
            if tag in RAW_TEXT:
                at = past_raw(page, at, tag)
            else:
                raw = tag
            continue
        if tag in INLINE:
            continue
        close()
        links = links if tag == "a" else 0
        if m[1]:
            if open_tags[tag]:
                while end(len(stack) - 1) != tag:
                    pass
            continue
        if tag in VOID:
            continue
        if tag in SELF_CLOSING:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    while len(stack) > k:
                        end(len(stack) - 1)
                    break
                if stack[k][0] not in SELF_CLOSING:
                    break
        above, firm = stack[-1][1:] if stack else (frozenset(), frozenset())
        kinds = {REGION_TAGS[tag]} if tag in REGION_TAGS else set()
        if tag in FIRM_TAGS:
            firm = firm | kinds
        if m[3] and tag not in ("html", "body"):
            for c in _CLASS.findall(m[3]):
                for name in re.split(r"[\s_]+", " ".join(c).lower()):
                    kinds |= {_WORD_REGION[w] for w in (name, *name.split("-")) if w in _WORD_REGION}
                    if _WORD_REGION.get(name) in FIRM_WORDS:
                        firm = firm | {_WORD_REGION[name]}
        if tag in ("article", "main"):
            above = firm
        stack.append((tag, above | kinds, firm))
        open_tags[tag] += 1
    close()
    return out


FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "heading", *KINDS)


def features_of(blocks: list[Block]) -> np.ndarray:
    n = len(blocks)
    own = np.zeros((n + 2, 2))
    out = np.zeros((n, len(FEATURES)))
    for i, b in enumerate(blocks):
        words = len(b.text.split())
        own[i + 1] = words, min(1.0, b.linked / max(1, words))
        out[i, 6] = b.heading
        for k in b.regions:
            out[i, 7 + KINDS.index(k)] = 1
    if n:
        out[:, 0:2], out[:, 2:4], out[:, 4:6] = own[1:-1], own[:-2], own[2:]
    return out


#: What a split prefers where several are equally good: a region, then the block's own counts.
_PREFERRED = np.array([0 if f > 5 else 1 if f < 2 else 2 for f in range(len(FEATURES))])


def grow(x: np.ndarray, y: np.ndarray, depth: int = 30):
    """A decision tree by Gini impurity: a leaf's share of 1, or (feature, cut, below, above)."""
    if depth == 0 or y.min() == y.max():
        return float(y.mean())
    found = []
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        at = np.flatnonzero(v[1:] != v[:-1])
        if len(at):
            n, k = at + 1.0, ones[at]
            gini = k * (1 - k / n) + (ones[-1] - k) * (1 - (ones[-1] - k) / (len(y) - n))
            best = int(np.argmin(gini))
            found.append((round(float(gini[best]), 6), int(_PREFERRED[f]), f, float(v[at[best]] + v[at[best] + 1]) / 2))
    if not found:
        return float(y.mean())
    _, _, f, cut = min(found)
    low = x[:, f] <= cut
    return (f, cut, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def classify(tree, row) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def examples(labelled) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of the blocks of labelled pages."""
    pages = [blocks_of(page) for page in labelled]
    return np.concatenate([features_of(blocks) for blocks in pages]), np.array([b.keep == "1" for blocks in pages for b in blocks], float)


def trained(labelled=None):
    """The tree of ``labelled`` pages, by default of LABELLED and PAGES pages made by rule."""
    return grow(*examples([*LABELLED, *labelled_pages(PAGES, SEED)] if labelled is None else labelled))


def main_text(page: str, tree) -> str:
    blocks = blocks_of(page, labelled=False)
    rows = features_of(blocks).tolist()
    return "\n".join(b.text for b, row in zip(blocks, rows) if classify(tree, row) >= 0.5)


def html_extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", tree=None) -> DataFrame:
    """id, url, text, n_chars (code points), a row per row of ``pages``.

    Null and empty pages, and pages without main text, give an empty text. Unclosed elements end
    with the page; a tag cut off by its end is no text. Repeated rows give repeated results, rows
    without an id keep theirs, an empty table gives no row; other columns are not read. Nothing is
    shuffled.
    """
    tree = trained() if tree is None else tree
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def extract(batches):
        for batch in batches:
            out = [main_text(p, tree) for p in pc.fill_null(batch.column(2), "").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], ["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(extract, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
