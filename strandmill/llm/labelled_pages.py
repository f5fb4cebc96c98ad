"""Labelled pages for the block classifier, built by a rule from a seed.

Half of the pages name their regions; the others are plain containers, where only the word counts
and link densities of a block and its neighbours tell the text. Blocks carry 1 (main text) or 0
in data-keep.
"""

from __future__ import annotations

from random import Random

#: Wrappers of boilerplate and of the text on pages that name their regions.
BOILER = ("nav", "footer", "aside", "form", "header", 'div class="ad"', 'div class="cookie-notice"', 'div class="comments"', 'div class="sidebar"', 'div id="menu"')
TEXT = ("article", "main", 'div class="content"', 'div class="post"')
#: Where a plain page's parts stand.
PLAIN = ("div", "section", 'div class="row"', "td")
#: Most words of a paragraph on a page.
LONG = 250


def _block(r: Random, keep: int, words: int, linked: int = 0, tag: str = "p") -> str:
    """A block of ``words`` words, the first ``linked`` of them in a link."""
    said = ["word"] * words
    link = f"<a>{' '.join(said[:linked])}</a> " if linked else ""
    return f"<{tag} data-keep={keep}>{link}{' '.join(said[linked:])}</{tag}>"


def _links(r: Random) -> str:
    """A list of links, at times with a word before each."""
    return "".join(_block(r, 0, n := r.randint(1, 5), n if r.random() < 0.85 else max(1, n - 1), "li") for _ in range(r.randint(2, 12)))


def _boiler(r: Random) -> str:
    """Links, a remark beside them, or a remark alone."""
    remark = _block(r, 0, n := r.randint(2, 30), r.choice((0, 0, n // 3)))
    return r.choice((_links(r), remark, remark + _links(r), _links(r) + remark))


def _text(r: Random, heading: bool = True) -> str:
    """A title and paragraphs, long ones and short ones between them, some with links or a link alone."""
    out = [_block(r, 1, r.randint(1, 14), tag=r.choice(("h1", "h2")))] if heading else []
    for k in range(r.randint(1, 9)):
        kind = r.random()
        if k and kind < 0.12:
            out.append(_block(r, 1, r.randint(1, 8), tag=r.choice(("p", "p", "h2", "li"))))
        elif k and kind < 0.2:
            out.append(_block(r, 1, n := r.randint(1, 6), n))
        else:
            n = r.randint(15, LONG)
            out.append(_block(r, 1, n, r.choice((0, 0, 0, n // 8, n // 4))))
    if len(out) > 2:
        out.append(_block(r, 1, r.randint(10, LONG)))
    return "".join(out)


def _within(tag: str, inner: str) -> str:
    return f"<{tag}>{inner}</{tag.split()[0]}>"


def _by_region(r: Random) -> str:
    """Regions have blocks of any length, so that they and not the counts tell."""
    around = [_within(tag, r.choice((_boiler(r), _text(r).replace("data-keep=1", "data-keep=0")))) for tag in r.sample(BOILER, 4)]
    text = _text(r, r.random() < 0.8) if r.random() < 0.6 else "".join(_block(r, 1, n := r.randint(1, 12), r.choice((0, n))) for _ in range(r.randint(1, 6)))
    return "".join(around[:2]) + _within(r.choice(TEXT), text) + "".join(around[2:])


def _plain(r: Random) -> str:
    """Links or a short remark beside links before the text; headed link lists and small print behind it."""
    tag = r.choice(PLAIN)
    before = _links(r) + (_block(r, 0, r.randint(2, 12)) + _links(r) if r.random() < 0.5 else "")
    side = _block(r, 0, r.randint(1, 4), tag="h3") + _links(r) if r.random() < 0.6 else ""
    after = side + _links(r) + _block(r, 0, r.randint(3, 14), r.choice((0, 1)))
    return _within(tag, before) + _within(tag, _text(r)) + _within(tag, after)


def labelled_pages(n: int, seed: int) -> list[str]:
    """``n`` pages, by turns with named regions and without."""
    r = Random(seed)
    return [_plain(r) if k % 2 else _by_region(r) for k in range(n)]
