from __future__ import annotations

import html
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventtrails.llm import html_extract as X
from eventtrails.llm.html_blocks import blocks

SF = "/root/testdata/sf0.01"


def article(page):
    """The given pages' article by its tags, as the brute-force answer."""
    inner = page[page.index("<article>") : page.index("</article>")]
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1|article)>", inner)]
    return "\n".join(p for p in parts if p)


def test_blocks():
    page = """<!doctype html><title>no</title><!-- <p>no</p> --><body><p>One <b>bold</b><br>two &amp; &lt;i&gt;<p title="a>b">Three
      four<script>var x="</p>";</script><ul><li>a<li><a href=#>b</a> c</ul><div class="sideBar ad-top" id=x1 hidden>five</div>
      <table><tr><td>six<td>seven</table>tail &eacute;&#26085;&nbsp;x <unknown>y</unknown> a < b <p>cut off <b"""
    got = blocks(page)
    assert [b.text for b in got] == ["One bold two & <i>", "Three four", "a", "b c", "five", "six", "seven", "tail é日 x", "y", "a < b", "cut off <b"]
    assert got[4].path == ("<body>", "<div>", "side", "bar", "ad", "top", "x", "hidden")
    assert got[3].linked == 1 and got[2].path[-2:] == ("<ul>", "<li>")
    assert blocks("") == [] and blocks("<!-- open") == [] and [b.text for b in blocks("plain")] == ["plain"]


def test_blocks_survive_broken_markup():
    rng = random.Random(5)
    bits = ["<", ">", "</", "<p", "<p>", "</p>", '"', "'", "=", "<a href='x", "<div class=", "text ", "&", "&#x;", "<!--", "-->", "<script>", "</script>", "\x00", "é"]
    for _ in range(500):
        blocks("".join(rng.choice(bits) for _ in range(rng.randint(0, 40))))
    assert len(blocks("<div>" * 20_000 + "x" + "<p>y" * 2_000)) == 2_001


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    net = X.new_network()
    sizes = np.array([3, 1, 5])
    x, y = rng.standard_normal((9, X.INPUT)).astype(np.float32), np.array([1, 0, -1, 1, 0, 0, 1, -1, 1], dtype=np.float32)

    def loss():
        z = X.run_network(net, x, sizes).astype(np.float64)
        return (np.log1p(np.exp(-z)) * (y == 1) + np.log1p(np.exp(z)) * (y == 0)).sum() / (y >= 0).sum()

    for p, g in zip(net.flat(), X._gradient(net, x, sizes, y), strict=True):
        at = tuple(int(k) for k in np.unravel_index(np.abs(g).argmax(), g.shape))
        old = p[at]
        p[at] = old + 1e-2
        up = loss()
        p[at] = old - 1e-2
        down = loss()
        p[at] = old
        assert (up - down) / 2e-2 == pytest.approx(float(g[at]), rel=0.05, abs=1e-4)


def test_batches_of_pages_do_not_mix():
    rng = np.random.default_rng(2)
    net, parts = X.new_network(), [rng.standard_normal((n, X.INPUT)).astype(np.float32) for n in (2, 7, 1)]
    together = X.run_network(net, np.concatenate(parts), np.array([2, 7, 1]))
    alone = np.concatenate([X.run_network(net, p, np.array([len(p)])) for p in parts])
    assert np.allclose(together, alone, atol=1e-5)


@pytest.fixture(scope="module")
def sample(spark):
    return [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]


def test_held_out_pages_and_layouts(sample):
    net = X.train(X.training_pages(sample[:90]))
    got = X.extract(net, sample[90:], X._Slots())
    assert sum(a == article(p) for a, p in zip(got, sample[90:], strict=True)) / len(got) >= 0.98
    held = X.training_pages(sample[90:130], seed=11)
    right = [((X.run_network(net, x, np.array([len(y)])) >= 0) == (y == 1))[y >= 0] for x, y in held]
    assert np.concatenate(right).mean() >= 0.97


def test_pages_frame(spark, sample):
    rows = [(i, "u", h, "t", 1) for i, h in enumerate(sample[:60])]
    rows += [(100, None, None, "t", 1), (101, "u", "", "t", 1), (None, "u", sample[0], "t", 1), (0, "u", sample[0], "t", 1)]
    rows += [(102, "u", "<article>" + "<p>long words here.</p>" * 20_000 + "</article>", "t", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = X.extract_main_text(pages).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert by[100].text == by[101].text == "" and by[None].text == by[0].text == article(sample[0])
    assert by[102].n_chars > 200_000
    assert X.extract_main_text(pages.limit(0)).count() == 0


def test_copies_do_not_shrink_the_sample(spark, sample, monkeypatch):
    taught = []
    monkeypatch.setattr(X, "training_pages", lambda pages: taught.append(pages))
    monkeypatch.setattr(X, "train", lambda pages: None)
    pages = spark.createDataFrame([(h,) for h in sample[:100]], "html string")
    X.fit(pages)
    X.fit(pages.unionByName(spark.range(20_000).select(F.lit("<p>copy").alias("html"))))
    assert len(taught[0]) == len(set(sample[:100])) and sorted(taught[1]) == sorted([*taught[0], "<p>copy"])


def test_digits_of_a_whole_block_count():
    text = "word " * 100
    plain, digits = (X.vectors(blocks(f"<p>{text}{end}"), X._Slots())[0, -2] for end in ("x" * 500, "7" * 500))
    assert plain == 0 and digits == pytest.approx(0.5)


def test_elements_without_text_swallow_nothing(sample):
    def of(page):
        return [b.text for b in blocks(page) if X.APART.isdisjoint(b.path)]

    assert of('<p>a<svg width="1"/><p>b<p>c<svg><text>no</text></svg>d') == ["a", "b", "c", "d"]
    assert of("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b<math/> c</p><p>d") == ["a x=1 b c", "d"]
    assert of("<object data=x><p>instead</p></object><p>b") == ["instead", "b"]
    for name in ("svg", "math", "object", "select", "template"):
        assert of(f"<p>a</p><{name}><p>b</p><p>c</p>") == ["a", "b", "c"]
    assert of("<svg><g><p>a</p><p>b</p><svg><text>no</text></svg><p>c") == ["a", "b", "c"]
    assert of("<select><option>no<option>no</select><template><div>no</div><p>no</template><p>b") == ["b"]
    assert of("<svg><title/><style/><text>no</text></svg><p>a<script>no</script>b") == ["a", "b"]
    net = X.train(X.training_pages(sample[:60]))
    page = sample[70].replace("<article>", "<article><svg /><select><option>no such words</select>", 1).replace("</body>", "<svg><text>no</text></svg></body>")
    assert X.extract(net, [page], X._Slots()) == [article(sample[70])]


def test_markup_left_open_takes_time_in_proportion():
    def seconds(page):
        start = time.process_time()
        blocks(page)
        return time.process_time() - start

    kinds = ["<div>x", '<p a="', '<p x">', '<p ">"', "<p<p", "<a b='", "<script/>", "<svg></svg </script ", "<li><x>", "</i", "<!", "&#9"]
    for kind in kinds:
        small, large = kind * 25_000, kind * 100_000 + '"'
        assert seconds(large) < 16 * seconds(small) + 1, kind
    start = time.process_time()
    blocks("<x>" * 100_000 + "<li></li>" * 100_000)
    blocks("&#" + "9" * 1_000_000)
    blocks("".join(f"<div class={'abcdefghij'[k % 10]}>x" for k in range(100_000)))
    assert time.process_time() - start < 30


def test_character_references():
    text = blocks("&#" + "9" * 5_000 + "; &#0000000000065; &#x0000000041; &#55296; &#1114112; &#x" + "f" * 5_000 + ";x")[0].text
    assert text == "� A A � � �x"


def test_quotes_and_brackets_in_tags():
    assert [b.text for b in blocks('<p title="a>b" x=\'">\'>one<p title="open>two</p> three')] == ["one", "two", "three"]
    assert [b.text for b in blocks('a <p b="c')] == ['a <p b="c'] and [b.text for b in blocks('<p "a">b<p ">c')] == ["b", "c"]


def test_long_pages_are_read_in_slices(monkeypatch, sample):
    page = blocks("<body><nav class=top>" + "<p>menu" * 30 + "</nav><article>" + "<p>Some longer words here." * 40 + "</article>")
    net, slots = X.train(X.training_pages(sample[:20]), epochs=1), X._Slots()
    whole = X.run_network(net, X.vectors(page, slots), np.array([len(page)]))
    monkeypatch.setattr(X, "SLICE_BLOCKS", 7)
    assert np.allclose(X.run_long(net, page, slots), whole, atol=1e-4)
    assert np.allclose(X.run_embedded(net, X.embed(net, page, slots), np.array([len(page)])), whole, atol=1e-4)


def test_layouts_unlike_the_samples(sample):
    net = X.train(X.training_pages(sample[:128]))
    intro, end = "Water boils when it is hot enough, and a kettle makes that easy for everyone.", "Then drink the tea slowly with a friend, and tell them of it."
    menu = '<nav><ul><li><a href="/">Home</a></li><li><a href="/x">Shop</a></li></ul></nav>'
    table = "<table><tr><th>Cups</th><th>Minutes</th></tr><tr><td>2</td><td>3</td></tr></table>"
    first = f"{menu}<article><h1>How to boil water</h1><p>{intro}</p>{table}<pre>heat = 80</pre><ol><li>Fill</li><li>Pour</li></ol><p>{end}</p></article><footer>Example</footer>"
    second = f"<div><div><h1>How to boil water</h1><div>{intro}</div><div>{end}</div></div></div><div>Copyright 2024 Example Ltd. All rights reserved.</div>"
    pages = [f"<html><head><title>Kettles</title></head><body>{p}</body></html>" for p in (first, second)]
    assert X.extract(net, pages, X._Slots()) == [
        "\n".join(["How to boil water", intro, "Cups", "Minutes", "2", "3", "heat = 80", "Fill", "Pour", end]),
        "\n".join(["How to boil water", intro, end]),
    ]
