import os
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shoplens.llm import html_blocks as H
from shoplens.llm import html_training

P = "The river rose again in spring, and people moved their animals up the hill before the water came."
Q = "Later that year the council built a wall, which held for two decades until the great storm."
TEXT = f"River\n\n{P}\n\n{Q}"

PAGES = {
    "semantic": (f"<html><body><header><a href='/'>Site</a><nav><ul><li><a>Home</a></li></ul></nav></header>"
                 f"<div class='cookie-notice'>We use cookies.</div><main><article><h1>River</h1><p>{P}</p><p>{Q}</p>"
                 f"</article><section class='comments'><h2>Comments</h2><div class='comment'><b>Joe</b><p>{P}</p></div>"
                 f"</section></main><aside class='sidebar'><h3>Related</h3><ul><li><a>Another</a></li></ul></aside>"
                 f"<form><label>Email</label><input><button>Subscribe</button></form><footer>&copy; 2024</footer>"),
    "classes": (f"<body><div id='menu'><a>Home</a> <a>About</a></div><div id='content'><h1>River</h1><p>{P}<p>{Q}</div>"
                f"<div id='comments'><ul><li>{Q}</li></ul></div><div id='footer'>Imprint</div></body>"),
    "inside": (f"<body><nav><a>x</a></nav><article><h1>River</h1><p>{P}</p><div class='ad'>Buy {Q}</div><p>{Q}</p>"
               f"<section class='comments'><article class='comment'>{P}</article></section></article></body>"),
    "broken": f"<nav><a>x</a></nav><article><h1>River</h1><p><b>{P}<br><p>{Q}</article><footer>f</footer",
    "reader": f"<body><article><h1>River</h1><p>{P}</p><p>{Q}</p></article><div id='reader-comments'><p>{Q}</p></div>",
    "script": f"<script>var a='<p>no</p>';</script><style>p{{}}</style><article><h1>River</h1><p>{P}</p><p>{Q}</p></article>",
}


@pytest.mark.parametrize("name", PAGES)
def test_layouts(name):
    assert H.main_texts([PAGES[name]]) == [TEXT]


def test_blocks():
    def texts(page):
        return [b.text for b in H.blocks(page)]
    assert texts("") == [] and texts("   \n ") == [] and texts("<p></p><div> </div>") == []
    assert texts("a &amp; b&nbsp;c &lt;d&gt; &am") == ["a & b c <d> &am"]
    assert texts("<p>one <b>two</b>\n\n three<br>four</p>five") == ["one two three four", "five"]
    assert texts("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == ["a", "b", "c", "d"]
    assert texts("x<script>a<b</script>y<!-- <p>z</p> -->w<style>q") == ["xyw"]
    assert texts("1 < 2 <p title='a>b'>t</p><p cut") == ["1 < 2", "t"]
    assert texts("<p>a</p></div></x><p>b") == ["a", "b"]
    deep = "<div>" * 3000 + "t" + "</div>" * 3000
    assert texts(deep) == ["t"]


def test_every_ancestor_counts():
    """A container's name reaches its blocks through a hundred levels."""
    for n in (1, 30, 100, 3000):
        page = "<div class='sidebar'>" + "<div>" * n + f"<p>{P}</p>" + "</div>" * n + f"</div><p>{Q}</p>"
        inner, outer = H.blocks(page)
        assert inner.path & H._label_bits("div sidebar") == H._label_bits("div sidebar")
        assert outer.path == H._label_bits("p") | H._leaf_bit("p")
    deep = ("<body><article><h1>River</h1>" + f"<p>{P}</p><p>{Q}</p></article><aside class='sidebar'>"
            + "<div>" * 100 + f"<p>{P}</p>" + "</div>" * 100 + "</aside>")
    assert H.main_texts([deep]) == [TEXT]


def machine(page):
    """(is a tag, name or text) of a page, by the states of an HTML reader;
    a quoted value without an end is no value."""
    out, i = [], 0
    while i < len(page):
        j = i + 1 + (page[i + 1:i + 2] == "/")
        if page[i] != "<" or not page[j:j + 1].isalpha():
            out.append((False, page[i]))
            i += 1
            continue
        k = j
        while k < len(page) and page[k] not in " />":
            k += 1
        name, state = page[j:k], "before"
        while k < len(page) and page[k] != ">":
            c = page[k]
            if state == "before":
                state = "before" if c in " /" else "name"
            elif state == "name":
                state = "value" if c == "=" else "after" if c == " " else "before" if c == "/" else "name"
            elif state == "after":
                if c != " ":
                    state = "value" if c == "=" else "before" if c == "/" else "name"
            elif state == "value":
                if c in "\"'":
                    end = page.find(c, k + 1)
                    if end < 0:
                        state = "name"
                    else:
                        k, state = end, "before"
                elif c != " ":
                    state = "unquoted"
            elif state == "unquoted" and c == " ":
                state = "before"
            k += 1
        if k < len(page):
            out.append((True, name.lower()))
        i = k + 1
    return out


def test_stray_quotes_against_a_state_machine():
    rng = random.Random(5)
    parts = ["'", '"', "=", " ", "/", ">", "<b", "<p", "</p", "</b", "x", "it's", "class", "title=", "='", '="', ">word "]
    for _ in range(6000):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 16)))
        got, at = [], 0
        while at < len(page):
            m = H._TOKEN.match(page, at)
            at = m.end()
            if m.group(2) is None:
                got += [(False, c) for c in m.group()]
            elif m.group(4):
                got.append((True, m.group(2).lower()))
        assert got == machine(page), page


def test_stray_quotes_lose_no_text():
    paragraphs = [f"Paragraph {k}: {P}" for k in range(4)]
    for odd in ("<b title=it's>", "<a href=x\">", "<b title='a'b'>", "<i x=\"y\"z>", "<b '>", "<b \">", "<b =\">",
                "<a href=a=\"b>"):
        page = "<article>" + "".join(f"<p>The {odd}end.</b></a></i> {x}</p>" for x in paragraphs) + "</article>"
        want = "\n\n".join(f"The end. {x}" for x in paragraphs)
        assert H.main_texts([page]) == [want], odd
    assert [b.text for b in H.blocks("<p title=\"no end>text</p><p>more")] == ["text", "more"]
    assert H._label("div", " title=\"x class='ad'\" class=main") == "div main"


def test_batching_does_not_matter():
    pages = [None, "", *PAGES.values(), "<p>" + "word " * 50000, "<p>a" * 5000]
    alone = [H.main_texts([p])[0] for p in pages]
    assert H.main_texts(pages) == alone


def test_lstm_against_a_plain_loop():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 5])
    gates, state = rng.normal(size=(9, 4 * H.HIDDEN)), rng.normal(size=(H.HIDDEN, 4 * H.HIDDEN))

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))
    for reverse in (False, True):
        got, at = H.run_lstm(gates, state, lengths, reverse), 0
        for n in lengths:
            h = c = np.zeros(H.HIDDEN)
            for k in (range(n - 1, -1, -1) if reverse else range(n)):
                i, f, o, g = np.split(gates[at + k] + h @ state, 4)
                c = sigmoid(f) * c + sigmoid(i) * np.tanh(g)
                h = sigmoid(o) * np.tanh(c)
                np.testing.assert_allclose(got[at + k], h, atol=1e-9)
            at += n


def test_gradients():
    rng = np.random.default_rng(2)
    lengths = np.array([2, 3])
    gates, state = rng.normal(size=(5, 4 * H.HIDDEN)), rng.normal(size=(H.HIDDEN, 4 * H.HIDDEN)) * 0.3
    weight = rng.normal(size=(5, H.HIDDEN))
    for reverse in (False, True):
        def loss(g, s):
            return float((H.run_lstm(g, s, lengths, reverse) * weight).sum())
        d_gates, d_state = html_training._backward(gates, state, lengths, reverse, weight)
        for at in [(0, 3), (2, 40), (4, 90)]:
            step = np.zeros_like(gates)
            step[at] = 1e-5
            assert abs((loss(gates + step, state) - loss(gates - step, state)) / 2e-5 - d_gates[at]) < 1e-6
        step = np.zeros_like(state)
        step[5, 7] = 1e-5
        assert abs((loss(gates, state + step) - loss(gates, state - step)) / 2e-5 - d_state[5, 7]) < 1e-6


def test_unseen_generated_pages():
    wrong, blocks, pages = html_training.evaluate(H.weights(), 5_000_000, 150)
    assert wrong / blocks < 0.006


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01/pages.parquet"), reason="no test data")
def test_given_pages(spark):
    raw = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").withColumn("text", F.lit("x"))
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in H.extract(df).collect()}
    for r in raw:
        body = r["html"].split("<article>", 1)[1]
        body = body.split("</article>", 1)[0]
        want = "\n\n".join(b.text for b in H.blocks(body))
        assert got[r["page_id"]] == (r["url"], want, len(want))


def test_empty_table_and_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (None, "u", "<p>x")], "page_id long, url string, html string")
    assert sorted((r.page_id or 0, r.text is None) for r in H.extract(df).collect()) == [(0, False), (1, False)]
    assert H.extract(df.limit(0)).count() == 0
