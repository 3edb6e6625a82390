from __future__ import annotations

import time
from html.parser import HTMLParser
from itertools import product

import duckdb
import numpy as np
import pytest

from stintlog.llm.dom_blocks import RAW, leaf_blocks
from stintlog.llm.html_text import Field, _marginals, features, main_text, trained
from stintlog.llm.labelled_pages import labelled_page

SCHEMA = "page_id long, url string, html string, extra long"


@pytest.fixture(scope="module")
def field():
    return trained()


def path_score(potential, moves, labels):
    return sum(p for p, y in zip(potential, labels) if y) + sum(moves[a, b] for a, b in zip(labels, labels[1:]))


def test_field_equals_enumeration():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5):
        potential, moves = rng.normal(size=n), rng.normal(size=(2, 2))
        every = [(y, path_score(potential, moves, y)) for y in product((0, 1), repeat=n)]
        weight = np.exp([s for _, s in every])
        p, pairs = _marginals(potential, moves)
        assert np.allclose(p, (weight[:, None] * [y for y, _ in every]).sum(axis=0) / weight.sum())
        seen = sum(w * np.array([[sum(a == i and b == j for a, b in zip(y, y[1:])) for j in (0, 1)] for i in (0, 1)]) for (y, _), w in zip(every, weight))
        assert np.allclose(pairs, seen / weight.sum())

        class Fixed(Field):
            def potentials(self, blocks):
                return potential.tolist()

        assert tuple(Fixed({}, moves).decode([None] * n)) == max(every, key=lambda e: e[1])[0]


def test_blocks():
    page = (
        "<html><head><title>T</title><script>var a='<p>no</p>';</script></head><body><!-- <p>no</p> -->"
        "<p>One &amp; <b>two</b>\n  three&nbsp;four<p>five<br>six<ul><li>a<li><a href=x>b</a></ul>"
        "<div CLASS='Side-bar adBox' id=x7>&lt;y&gt;</div>tail <textarea>no</textarea><svg><text>no</text></svg>end"
    )
    got = [(b.text, b.linked) for b in leaf_blocks(page)]
    assert got == [("One & two three four", 0), ("five six", 0), ("a", 0), ("b", 1), ("<y>", 0), ("tail end", 0)]
    side = leaf_blocks(page)[4]
    assert side.tag == "div" and {"side", "bar", "ad", "box", "x", "7"} <= side.names


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "<p>", "</p>", "<!--", "<script>", "<a href='", "<p title=\"a>b\">x", "&", "<<<>>>", "\x00<p>\x00", "<p>" * 5000])
def test_broken_pages_do_not_fail(field, page):
    assert isinstance(field.text(page), str)


@pytest.mark.parametrize(
    "unit", ["<a", "<a ", "<!", "</b>", "<div>x", "<b>", "<li>x", "<p>x", "<td>", "<script", "<a href='", '<a title="', "<!--", "&lt;", "<div class=c>x</b>"]
)
def test_broken_and_deep_pages_take_linear_time(unit):
    def seconds(n):
        page = "<p><ul>" + "<div><b>" * n + unit * n
        start = time.process_time()
        leaf_blocks(page)
        return time.process_time() - start

    seconds(1_000)
    assert min(seconds(40_000) for _ in range(2)) < 3  # a quadratic parser takes minutes


class Shown(HTMLParser):
    """The visible text of a page by the standard library's parser, which knows nothing of blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in RAW
        self.parts.append(" ")

    def handle_endtag(self, tag):
        self.hidden -= tag in RAW
        self.parts.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def test_blocks_hold_all_visible_text():
    for sf in ("sf0.001", "sf0.01"):
        for (page,) in duckdb.sql(f"select html from '/root/testdata/{sf}/pages.parquet'").fetchall():
            parser = Shown()
            parser.feed(page)
            parser.close()
            want = "".join("".join(parser.parts).split())
            assert "".join("".join(b.text for b in leaf_blocks(page)).split()) == want


def test_accuracy_on_other_labelled_pages(field):
    rng = np.random.default_rng(77)
    right = total = 0
    for _ in range(150):
        page, labels = labelled_page(rng)
        found = field.decode(leaf_blocks(page))
        right += sum(a == b for a, b in zip(found, labels))
        total += len(labels)
    assert right / total > 0.98


def test_features_do_not_depend_on_words():
    one, two = (leaf_blocks(f"<article><p>{t}</p></article>") for t in ("abcd efgh ijkl.", "mnop qrst uvwx."))
    assert features(one) == features(two)


def test_whole_tables(spark, field):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = main_text(pages, field).collect()
    assert len(got) == pages.count() and all(r.n_chars == len(r.text) and r.text for r in got)
    by_id = {r.page_id: r.html for r in pages.collect()}
    for r in got:
        html = by_id[r.page_id]
        inside = [b.text for b in leaf_blocks(html) if "article" in b.tags]
        assert r.text == "\n".join(inside)


def test_odd_rows(spark, field):
    rows = [(1, "u", None, 5), (1, "u", None, 5), (None, None, "", 5), (3, "v", "<nav><a href=/>Home</a></nav>", 5), (4, "w", "<article><p>" + "Word " * 100_000 + "</p></article>", 5)]
    got = main_text(spark.createDataFrame(rows, SCHEMA), field).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got) == [("1", 0), ("1", 0), ("3", 0), ("4", 499_999), ("None", 0)]
    assert main_text(spark.createDataFrame([], SCHEMA), field).count() == 0
