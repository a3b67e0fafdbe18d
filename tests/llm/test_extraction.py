"""Extraction from pages with known articles."""

from __future__ import annotations

import html
import random
import time

import pyarrow.parquet as pq
import pytest

from ferry.llm import extraction
from ferry.llm.extraction import main_text


def test_article_without_what_surrounds_it():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></li></ul></nav><div id="cookie-notice">We use cookies, sorry.</div>
    <div class="wrap has-sidebar"><article><header><h1>Title &amp; more</h1></header><p>First,
      <b>bold</b>text &lt;here&gt;&nbsp;now.<br>Next<p>Second one.</p><form><input name=q><label>Search</label></form>
    <div class="adBox ad">Buy!</div><ul><li>item one<li>item two</ul><blockquote>Quote, it is.</blockquote><script>x()</script>
    <!-- note --></article><aside>Aside</aside><section id="comments"><article class="comment"><p>I, a reader, comment at length, with commas, many, many commas.</p></article></section></div>
    <footer>&copy; 2020</footer></body></html>"""
    assert main_text(page) == "Title & more First, boldtext <here> now. Next Second one. item one item two Quote, it is."


def test_best_container_among_plain_divs():
    body = "".join(f"<p>Sentence {i}, with words, and commas, that go on for a while.</p>" for i in range(6))
    links = "".join(f"<li><a href='/{i}'>Link, number, {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><div>{body}</div><div><a href=#>more</a></div></div><div>Short</div></body>"
    assert main_text(page) == " ".join(f"Sentence {i}, with words, and commas, that go on for a while." for i in range(6))


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<!--", "<script>x", "<html><head><title>x</title>"])
def test_empty(page):
    assert main_text(page) in ("", "<")


def test_deep_and_long():
    assert main_text("<div>" * 20_000 + "<p>deep</p>") == "deep"
    words = " ".join(["word,"] * 100_000)
    assert main_text(f"<article><p>{words}</p></article>") == words


def _truth(page: str) -> str:
    """What the generated pages' articles hold, cut out by their fixed markup."""
    import re

    article = page.split("<article>", 1)[1].split("</article>", 1)[0]
    blocks = re.split(r"</?(?:p|h1)>", article)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in blocks]
    return " ".join(t for t in texts if t)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in extraction.extract(pages).select("row.page_id", "text", "n_chars").collect()}
    rows = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()
    wrong = [r["page_id"] for r in rows if got[r["page_id"]] != (_truth(r["html"]), len(_truth(r["html"])))]
    assert len(got) == len(rows) and wrong == []


def test_clashing_names_and_nulls(spark):
    rows = [(1, None, "<p>a", 5), (1, "u", None, None), (None, "u", "", 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = extraction.extract(frame).select("row.page_id", "row.text", "text", "n_chars").collect()
    assert sorted((r[2], r[3]) for r in got) == [("", 0), ("", 0), ("a", 1)]
    assert extraction.extract(frame.limit(0)).count() == 0


class Walking(extraction._Tree):
    """The same tree by walking up from the open element for every tag."""

    def _open(self, node):
        self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node.parent and node.tag != tag:
            if tag not in extraction.BLOCKS and tag not in extraction.DROPPED and node.tag in extraction.BLOCKS or tag == "p" and node.tag in extraction.BLOCKS:
                return
            node = node.parent
        if node.parent:
            self.at = node.parent

    def _close(self, tag, within):
        node = self.at
        while node.parent and node.tag not in within:
            if node.tag == tag:
                self.at = node.parent
                return
            node = node.parent


def outline(node):
    return (node.tag, [c if isinstance(c, str) else outline(c) for c in node.children])


def test_tag_soup_gives_the_tree_of_a_plain_walk():
    rng = random.Random(5)
    tags = "p div b i span li ul td tr table article section nav br option select dt dl html".split()
    for _ in range(400):
        soup = "".join(f"<{rng.choice(('', '', '/'))}{rng.choice(tags)}>" + rng.choice(("", "x, ")) for _ in range(rng.randrange(60)))
        trees = []
        for kind in (extraction._Tree, Walking):
            tree = kind()
            tree.feed(soup)
            tree.close()
            trees.append(outline(tree.root))
        assert trees[0] == trees[1], soup


@pytest.mark.parametrize("start, end", [("<b>", "</i>"), ("<i>", "</b>"), ("<div>", "</p>"), ("<b><div>", "</b>")])
def test_end_tags_that_close_nothing_cost_no_walk(start, end):
    page = f"<b><p><div>{start * 40_000}{end * 40_000}word"
    began = time.process_time()
    tree = extraction._Tree()
    tree.feed(page)
    tree.close()
    assert time.process_time() - began < 20
