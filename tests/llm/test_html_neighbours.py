"""Pages without named regions are told by their blocks' neighbours; edges of the operator."""

import numpy as np

from strandmill.llm import html_extract
from strandmill.llm.labelled_pages import labelled_pages

NEIGHBOURS = [k for k, name in enumerate(html_extract.FEATURES) if "before" in name or "after" in name]


def right(tree, x, y):
    return np.mean([(html_extract.classify(tree, row) >= 0.5) == (label == 1) for row, label in zip(x.tolist(), y)])


def test_neighbours_tell_blocks_of_held_out_pages():
    plain = labelled_pages(120, 99)[1::2]
    x, y = html_extract.examples(plain)
    tree = html_extract.trained()
    learned, labels = html_extract.examples([*html_extract.LABELLED, *labelled_pages(html_extract.PAGES, html_extract.SEED)])
    learned[:, NEIGHBOURS] = 0
    blind = x.copy()
    blind[:, NEIGHBOURS] = 0
    without = right(html_extract.grow(learned, labels), blind, y)
    assert right(tree, x, y) > 0.99 > 0.985 > without
    assert any((html_extract.classify(tree, a) >= 0.5) != (html_extract.classify(tree, b) >= 0.5) for a, b in zip(x.tolist(), blind.tolist()))


def test_short_blocks_go_with_their_neighbours():
    long = " ".join(["words"] * 60)
    menu = "".join(f"<div><a href=/{k}>Part {k}</a></div>" for k in range(6))
    page = f"<body>{menu}<div>All the news</div>{menu}<h1>A title</h1><div>{long}</div><div>Yes, it is.</div><div>{long}</div><div>{long}</div><h3>More</h3>{menu}<div>Some company, all rights reserved</div></body>"
    assert html_extract.main_text(page, html_extract.trained()) == f"A title\n{long}\nYes, it is.\n{long}\n{long}"


def test_named_regions_hold_for_blocks_of_any_length():
    x, y = html_extract.examples(labelled_pages(120, 98)[::2])
    assert right(html_extract.trained(), x, y) > 0.99


def test_empty_tables_and_columns_of_the_same_names(spark):
    schema = "page_id long, url string, html string, text string, n_chars long, id long"
    assert html_extract.html_extract(spark.createDataFrame([], schema)).collect() == []
    page = "<nav><a>Home</a></nav><article><p>The text.</p></article>"
    rows = [(1, "u", page, "other", 7, 9), (1, "u", page, "other", 7, 9), (None, None, None, None, None, None), (2, "v", "", "x", 1, 1)]
    out = sorted(map(tuple, html_extract.html_extract(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert out == sorted([(1, "u", "The text.", 9)] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
