from __future__ import annotations

import itertools
import math
import time

from marketloom.llm import html_text


def page(k):
    words = f"Word{k} and more of the text number {k}, which goes on for a while &amp; ends."
    return (
        f"<!DOCTYPE html><html><head><title>t</title><script>var a='<p>';</script></head><body><nav><ul><li><a href='/'>Menu {k}</a></li></ul></nav>"
        f"<div class='ad'>Buy it now, cheap.</div><article><h1>Title {k}</h1><p><b>{words}<br><p>Next\n part {k}.</p></article>"
        f"<footer>&copy; Site {k}</footer></body></html>"
    )


def expected(k):
    return f"Title {k}\nWord{k} and more of the text number {k}, which goes on for a while & ends.\nNext part {k}."


def test_chain_gradient_and_viterbi():
    blocks = html_text.leaf_blocks(page(1))
    chain = html_text.Chain({"article": 1.0, "nav": -0.5, "bias": 0.1}, [[0.2, -0.1], [0.3, 0.0]])

    def total(labels):
        score = sum(chain.score(b) for b, y in zip(blocks, labels, strict=True) if y)
        return score + sum(chain.turns[a][b] for a, b in zip(labels, labels[1:], strict=False))

    ways = list(itertools.product((0, 1), repeat=len(blocks)))
    assert tuple(chain.viterbi(blocks)) == max(ways, key=total)
    gold = [0] * len(blocks)
    weights = {w: math.exp(total(w)) for w in ways}
    chance = sum(v for w, v in weights.items() if w[0] == 1) / sum(weights.values())
    first_only = [n for n in blocks[0].names if all(n not in b.names for b in blocks[1:])]
    gradient = chain._gradient(blocks, gold)
    assert first_only and math.isclose(gradient[first_only[0]], -chance, rel_tol=1e-9)


def test_held_out_pages(spark):
    rows = [(k, f"http://x/{k}", page(k)) for k in range(120)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    chain = html_text.learn(pages.where("page_id < 60"))
    got = {r.page_id: r.text for r in html_text.extract(pages.where("page_id >= 60"), chain).collect()}
    assert got == {k: expected(k) for k in range(60, 120)}
    other = "<body><div id='sidebar'><p>Also read this.</p></div><main><p>The text of it, long enough to be one.</p><p>And a second part of it, as long as the first.</p></main><div class='comments'><p>Nice one.</p></div>"
    assert chain.main_text(other) == "The text of it, long enough to be one.\nAnd a second part of it, as long as the first."


def test_edges(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<article><h1>Head</h1><p>cut off &am"), (3, "u", "<article><h1>Head</h1><p>cut off &am"), (4, "u", "<" * 2000), (5, "u", "<p " + "a" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumnRenamed("url", "n_chars")
    chain = html_text.Chain().fit(html_text.training_pages([page(k) for k in range(30)]))
    out = html_text.extract(pages, chain)
    assert out.columns == ["page_id", "text", "n_chars"]
    texts = sorted((r.page_id, r.text, r.n_chars) for r in out.collect())
    assert texts[0] == (1, "", 0) and texts[1] == (2, "", 0) and texts[2] == texts[3] == (3, "Head\ncut off &am", 16)
    assert html_text.extract(pages.limit(0), html_text.learn(pages.limit(0))).count() == 0


def test_blocks_behind_elements_closed_by_a_slash():
    page = '<p>x <svg width="3"/> tail <math/>end</p><p>b <math><mi>y</mi><mo>=</mo><mn>2</mn></math> c</p><p><svg><title>t</title></svg>d</p>'
    assert [b.text for b in html_text.leaf_blocks(page)] == ["x tail end", "b y=2 c", "d"]


def test_unmatched_end_tags_take_time_in_proportion():
    """20,000 open and unmatched tags are far beyond what rescanning the open ones could do in this time."""
    start = time.perf_counter()
    assert [b.text for b in html_text.leaf_blocks("<b>x</i>" * 20_000)] == ["x" * 20_000]
    assert time.perf_counter() - start < 5
