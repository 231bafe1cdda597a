"""Main text of web pages: a bidirectional LSTM labels every block of a page.

A page is the sequence of its text blocks in order. Each block is a vector of
hashed tag-path words, hashed text words and a few shares (links, punctuation,
length); two LSTMs read the sequence in both directions, so each block is judged
with the whole page before and after it. Blocks labelled content, joined by line
breaks, are the main text.

Training. The network is trained in numpy on the driver, on the ``SAMPLE`` distinct
pages of smallest hash among those of at most ``TRAIN_CHARS`` characters, a bound on
the driver's memory; longer pages are labelled like all others. Blocks under telling elements
(``article``, ``main``; ``nav``, ``footer``, adverts...) are labelled by them, others
not at all. Every sampled page is also laid out anew several times, its content
under other containers and amid menus, sidebars, notices, forms and reader comments
made of the sample's own words, which labels those blocks by construction.

Scale. Pages are independent: one pass, no shuffle. A task labels a slice of pages
at a time, pages of like length together; the model is a small constant. Block vectors
exist for ``SLICE_BLOCKS`` blocks at a time, and a page of more blocks is read in such
slices, forward and then backward, with the state of the network carried on: memory is
that of the page's blocks, and time is in proportion to the page.

Defined cases: null and empty html give an empty text, as do pages without content
blocks; nothing of a block is dropped or capped, however long a page is, however deep its
elements are nested and whatever tags or quotes are left open; blocks in drawings, choice lists and
templates are never content; equal pages give equal texts; null
ids and urls are kept; without any pages the network trains on its own layouts'
placeholder words; extra columns are not read.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared as S
from .html_blocks import APART, Block, Node, blocks  # noqa: F401 (APART is for readers of paths)

SAMPLE = 128
TRAIN_CHARS = 200_000
LAYOUTS = 6
EPOCHS = 5
PATH_SLOTS, WORD_SLOTS, SHARES = 512, 256, 10
INPUT = PATH_SLOTS + WORD_SLOTS + SHARES
EMBED, HIDDEN = 32, 24
#: Blocks times pages of one padded batch.
CELLS = 1 << 15
SLICE_CHARS = 1 << 22
SLICE_BLOCKS = 1 << 12

# Path words that tell what a block is, where pages use them.
CONTENT_MARKS = frozenset("<article> <main>".split())
OTHER_MARKS = frozenset(
    "<nav> <footer> <header> <aside> <form> <button> ad ads advert advertisement sponsored promo banner menu navbar "
    "breadcrumb breadcrumbs sidebar widget cookie consent gdpr notice newsletter subscribe comment comments "
    "disqus respond share social related recommended footer copyright hidden login search".split()
)

_WORD = re.compile(r"\w+")


def _lines(node: Node, known) -> list[Node]:
    """The nodes from this one's nearest known ancestor down to it, outermost first."""
    out = []
    while node is not None and not known(node):
        out.append(node)
        node = node.parent
    return out[::-1]


def teacher(node: Node) -> int:
    """1 content, 0 other, -1 unknown: the innermost telling word of the path."""
    for n in _lines(node, lambda n: n.label is not None):
        above, inside = n.parent.label if n.parent else (-1, False)
        inside = inside or not CONTENT_MARKS.isdisjoint(n.marks)
        label = above
        for mark in n.marks:
            if mark in OTHER_MARKS:
                # the heading of an article is often in its own header
                label = -1 if mark == "<header>" and inside else 0
            elif mark in CONTENT_MARKS:
                label = 1
        n.label = label, inside
    return 0 if node.apart else node.label[0]


class _Slots(dict):
    def __missing__(self, key: str) -> int:
        if len(self) > 1 << 18:
            self.clear()
        v = self[key] = zlib.crc32(key.encode())
        return v


def _path_slots(node: Node, slots: _Slots) -> int:
    """The hashed path as bits: every mark, and the two innermost with their places."""
    for n in _lines(node, lambda n: n.slots is not None):
        bits = n.parent.slots[0] if n.parent else 0
        for mark in n.marks:
            bits |= 1 << slots[mark] % PATH_SLOTS
        last = (*(n.parent.marks if n.parent else ()), *n.marks)[-2:]
        near = bits
        for depth, mark in enumerate(reversed(last)):
            near |= 1 << slots[f"{depth}{mark}"] % PATH_SLOTS
        n.slots = bits, near
    return node.slots[1]


def vectors(page: list[Block], slots: _Slots, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """One row per block of a slice of a page: hashed path, hashed words, shares."""
    n, hi = len(page), len(page) if hi is None else min(hi, len(page))
    x = np.zeros((hi - lo, INPUT), dtype=np.float32)
    previous, path = page[lo - 1].node if lo else None, None
    for k in range(lo, hi):
        b, row = page[k], x[k - lo]
        if path is None or b.node is not previous:
            bits = _path_slots(b.node, slots).to_bytes(PATH_SLOTS // 8, "little")
            path = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), bitorder="little")
        row[:PATH_SLOTS] = path
        words = _WORD.findall(b.text.lower())
        if words:
            at = np.fromiter((slots[w] for w in words), dtype=np.int64, count=len(words)) % WORD_SLOTS
            row[PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = np.sqrt(np.bincount(at, minlength=WORD_SLOTS) / len(words))
        t = b.text
        size = len(t)
        row[-SHARES:] = (
            min(np.log1p(len(words)) / 6, 2),
            min(b.linked / size, 1),
            sum(map(t.count, ".,;:")) / (len(words) + 1),
            t[-1] in ".!?\"'”»",
            k / n,
            1 / (1 + k),
            1 / (n - k),
            b.node is previous,
            sum(map(str.isdigit, t)) / size,
            min(b.node.length / 10, 2),
        )
        previous = b.node
    return x


class Network(NamedTuple):
    """An embedding of block vectors, an LSTM each way, a logistic output."""

    we: np.ndarray
    be: np.ndarray
    forward: tuple[np.ndarray, np.ndarray, np.ndarray]
    backward: tuple[np.ndarray, np.ndarray, np.ndarray]
    wo: np.ndarray
    bo: np.ndarray

    def flat(self) -> list[np.ndarray]:
        return [self.we, self.be, *self.forward, *self.backward, self.wo, self.bo]


def new_network(seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    def lstm():
        b = np.zeros(4 * HIDDEN, dtype=np.float32)
        b[HIDDEN : 2 * HIDDEN] = 1  # remember at first
        return normal(EMBED, 4 * HIDDEN, scale=EMBED**-0.5), normal(HIDDEN, 4 * HIDDEN, scale=HIDDEN**-0.5), b

    return Network(
        normal(INPUT, EMBED, scale=0.1), np.zeros(EMBED, dtype=np.float32), lstm(), lstm(), normal(2 * HIDDEN, scale=0.1), np.zeros(1, dtype=np.float32)
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(z: np.ndarray, cell, keep: bool = False, state=None):
    """Hidden states ``(steps, pages, HIDDEN)``, the last state and, with ``keep``, what
    the gradient needs. ``state`` is that of the steps before, if there are any."""
    wx, wh, b = cell
    pre = z @ wx + b
    h, c = state or (np.zeros((z.shape[1], HIDDEN), dtype=np.float32),) * 2
    out, trace = np.empty((len(z), z.shape[1], HIDDEN), dtype=np.float32), []
    for t in range(len(z)):
        a = pre[t] + h @ wh
        gates = _sigmoid(a[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(a[:, 3 * HIDDEN :])
        if keep:
            trace.append((h, c, i, f, o, g))
        c = f * c + i * g
        h = o * np.tanh(c)
        out[t] = h
    return out, (h, c), trace


def _lstm_gradient(z: np.ndarray, cell, out: np.ndarray, trace, d_out: np.ndarray):
    wx, wh, _ = cell
    d_pre = np.empty((len(z), z.shape[1], 4 * HIDDEN), dtype=np.float32)
    d_wh = np.zeros_like(wh)
    d_h = np.zeros((z.shape[1], HIDDEN), dtype=np.float32)
    d_c = np.zeros_like(d_h)
    for t in range(len(z) - 1, -1, -1):
        h, c, i, f, o, g = trace[t]
        d_h = d_h + d_out[t]
        tc = np.tanh(f * c + i * g)
        d_c = d_c + d_h * o * (1 - tc * tc)
        a = d_pre[t]
        a[:, :HIDDEN] = d_c * g * i * (1 - i)
        a[:, HIDDEN : 2 * HIDDEN] = d_c * c * f * (1 - f)
        a[:, 2 * HIDDEN : 3 * HIDDEN] = d_h * tc * o * (1 - o)
        a[:, 3 * HIDDEN :] = d_c * i * (1 - g * g)
        d_wh += h.T @ a
        d_h = a @ wh.T
        d_c = d_c * f
    flat_z, flat_a = z.reshape(-1, z.shape[2]), d_pre.reshape(-1, 4 * HIDDEN)
    return d_pre @ wx.T, (flat_z.T @ flat_a, d_wh, flat_a.sum(axis=0))


def _places(sizes: np.ndarray):
    """Where each block stands in padded ``(step, page)`` arrays, read forward and backward."""
    page = np.repeat(np.arange(len(sizes)), sizes)
    step = np.arange(len(page)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return page, step, sizes[page] - 1 - step


def embed(net: Network, page: list[Block], slots: _Slots, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """What the network reads of the blocks ``lo`` to ``hi``: the dense vectors exist
    for one slice of blocks at a time."""
    hi = len(page) if hi is None else min(hi, len(page))
    z = np.empty((hi - lo, EMBED), dtype=np.float32)
    for k in range(lo, hi, SLICE_BLOCKS):
        x = vectors(page, slots, k, min(hi, k + SLICE_BLOCKS))
        z[k - lo : k - lo + len(x)] = np.tanh(x @ net.we + net.be)
    return z


def run_embedded(net: Network, z: np.ndarray, sizes: np.ndarray, keep: bool = False):
    """Logits of all blocks of pages with ``sizes`` blocks, laid end to end in ``z``."""
    page, step, back = _places(sizes)
    shape = (int(sizes.max()), len(sizes), EMBED)
    zf, zb = np.zeros(shape, dtype=np.float32), np.zeros(shape, dtype=np.float32)
    zf[step, page], zb[back, page] = z, z
    hf, _, tf = _lstm(zf, net.forward, keep)
    hb, _, tb = _lstm(zb, net.backward, keep)
    both = np.concatenate([hf[step, page], hb[back, page]], axis=1)
    logits = both @ net.wo + net.bo
    return (logits, (page, step, back, z, zf, zb, hf, hb, tf, tb, both)) if keep else logits


def run_network(net: Network, x: np.ndarray, sizes: np.ndarray, keep: bool = False):
    """Logits from block vectors."""
    return run_embedded(net, np.tanh(x @ net.we + net.be), sizes, keep)


def run_long(net: Network, page: list[Block], slots: _Slots) -> np.ndarray:
    """Logits of one page of any length, a slice of blocks at a time."""
    logits = np.full(len(page), net.bo[0], dtype=np.float32)
    starts = range(0, len(page), SLICE_BLOCKS)
    state = None
    for lo in starts:
        h, state, _ = _lstm(embed(net, page, slots, lo, lo + SLICE_BLOCKS)[:, None], net.forward, state=state)
        logits[lo : lo + len(h)] += h[:, 0] @ net.wo[:HIDDEN]
    state = None
    for lo in reversed(starts):
        z = embed(net, page, slots, lo, lo + SLICE_BLOCKS)[::-1, None]
        h, state, _ = _lstm(z, net.backward, state=state)
        logits[lo : lo + len(h)] += h[::-1, 0] @ net.wo[HIDDEN:]
    return logits


def _gradient(net: Network, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy over labelled blocks (``y`` of 0 or 1)."""
    logits, (page, step, back, z, zf, zb, hf, hb, tf, tb, both) = run_network(net, x, sizes, keep=True)
    d = np.where(y >= 0, _sigmoid(logits) - y, 0).astype(np.float32) / max(1, (y >= 0).sum())
    d_both = d[:, None] * net.wo[None, :]
    df, db = np.zeros_like(hf), np.zeros_like(hb)
    df[step, page], db[back, page] = d_both[:, :HIDDEN], d_both[:, HIDDEN:]
    dzf, gf = _lstm_gradient(zf, net.forward, hf, tf, df)
    dzb, gb = _lstm_gradient(zb, net.backward, hb, tb, db)
    dz = (dzf[step, page] + dzb[back, page]) * (1 - z * z)
    return [x.T @ dz, dz.sum(axis=0), *gf, *gb, both.T @ d, d.sum(keepdims=True)]


def train(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam over batches of pages ``(vectors, labels)``."""
    net, rng = new_network(seed), np.random.default_rng(seed)
    m, v = [np.zeros_like(p) for p in net.flat()], [np.zeros_like(p) for p in net.flat()]
    t = 0
    for epoch in range(epochs):
        order = rng.permutation(len(pages))
        for lo in range(0, len(order), 16):
            part = [pages[k] for k in order[lo : lo + 16]]
            x, y = np.concatenate([p[0] for p in part]), np.concatenate([p[1] for p in part])
            # some blocks lose their paths or words, so that neither is all there is
            x[rng.random(len(x)) < 0.1, :PATH_SLOTS] = 0
            x[rng.random(len(x)) < 0.2, PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = 0
            grads = _gradient(net, x, np.array([len(p[1]) for p in part]), y)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            t += 1
            step = rate * (0.3 if epoch >= epochs * 2 // 3 else 1)
            params = net.flat()
            for k, g in enumerate(grads):
                g = g * min(1, 5 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                params[k] -= (step * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


# Element conventions of the training layouts.
_CONTENT = [
    "<article>|</article>", "<main>|</main>", '<div class="content">|</div>', '<div id="main-content">|</div>', '<div class="post-body">|</div>',
    '<div class="entry-content">|</div>', '<div class="article__body">|</div>', '<section class="story">|</section>', '<div id="content"><div class="text">|</div></div>',
    '<main><article class="post">|</article></main>', "<table><tr><td>|</td></tr></table>", "|", "|", "<div>|</div>", "<div><div>|</div></div>",
    '<div class="post">|</div>', '<div class="entry">|</div>', '<div class="page-content">|</div>', '<div class="story-text">|</div>', '<td class="body">|</td>',
]
_LISTS = ['<nav>|</nav>', '<div class="menu">|</div>', '<div id="nav" role="navigation">|</div>', '<div class="navbar">|</div>', '<ul class="breadcrumbs">|</ul>', '<header><nav class="main-nav">|</nav></header>']
_WRAPS = ['<div class="wrap">|</div>', '<div id="page" class="container">|</div>', '<div class="row"><div class="col">|</div></div>', "<div>|</div>"]
_TOPS = ['<div class="topbar">|</div>', '<header>|</header>', '<div id="header">|</div>', '<div class="site-header">|</div>', '<div class="masthead">|</div>']
_SIDES = ['<aside>|</aside>', '<aside class="sidebar">|</aside>', '<div id="sidebar">|</div>', '<div class="widget">|</div>', '<div class="related">|</div>', '<div class="recommended">|</div>', '<section class="more-stories">|</section>']
_NOTES = ['<div class="advertisement">|</div>', '<div class="ad-container">|</div>', '<div id="cookie-banner">|</div>', '<div class="ad">|</div>', '<div class="advert">|</div>', '<div class="ads banner">|</div>', '<div id="sponsored">|</div>', '<div class="promo">|</div>', '<div class="cookie-notice">|</div>', '<div id="gdpr-consent">|</div>', '<div class="notice" role="alert">|</div>', '<div class="alert">|</div>', '<div class="share">|</div>', '<div class="social-links">|</div>', '<ins class="adsbygoogle">|</ins><div class="ad-slot">|</div>']
_FORMS = ['<form class="newsletter">|<input type="email"><button>Go</button></form>', '<form action="/search"><label>|</label><input><button>Search</button></form>', '<div class="subscribe">|</div>', '<form id="login">|</form>']
_COMMENTS = ['<div class="comments-area">|</div>', '<section class="comments">|</section>', '<div id="comments">|</div>', '<ol class="comment-list">|</ol>', '<div class="reader-comments">|</div>', '<div id="disqus_thread">|</div>']
_BOTTOMS = ['<div class="page-footer">|</div>', '<footer>|</footer>', '<div id="footer">|</div>', '<div class="site-footer">|</div>', '<div class="copyright">|</div>', '<div>|</div>', '<p>|</p>', '<div><small>|</small></div>']
_RIGHTS = ["Copyright YEAR NAME Ltd. All rights reserved.", "&copy; YEAR NAME. All rights reserved.", "Copyright &copy; YEAR NAME Inc.", "(c) YEAR NAME", "YEAR NAME. All rights reserved. Terms of use. Privacy policy."]


def layout(paragraphs: list[str], strings: list[str], rng: random.Random) -> str:
    """A page with the paragraphs as content, marked by a control character that
    ``labelled`` reads, amid boilerplate made of other strings."""

    def some(lo: int, hi: int) -> list[str]:
        return [rng.choice(strings) for _ in range(rng.randint(lo, hi))]

    def short() -> str:
        return " ".join(rng.choice(strings).split()[: rng.randint(1, 4)]) or "Home"

    def links(lo: int, hi: int) -> str:
        items = "".join(f'<li><a href="#">{short()}</a></li>' for _ in range(rng.randint(lo, hi)))
        return f"<ul>{items}</ul>" if rng.random() < 0.7 else items.replace("<li>", "").replace("</li>", " | ")

    def wrap(kinds: list[str], inner: str) -> str:
        kind = rng.choice(kinds)
        return kind.replace("|", inner)

    def comments() -> str:
        said = "".join(f"<div><b>{short()}</b><p>{x}</p></div>" if rng.random() < 0.6 else f"<li><p>{x}</p></li>" for x in some(1, 6))
        return wrap(_COMMENTS, f"<h3>{rng.choice(['Comments', short()])}</h3>{said}")

    def note() -> str:
        return wrap(_NOTES, rng.choice([short(), rng.choice(strings), f"<p>{rng.choice(strings)}</p>"]))

    def linked(t: str) -> str:
        words = t.split()
        if rng.random() < 0.25 and len(words) > 3:
            k = rng.randrange(len(words) - 1)
            words[k : k + 2] = [f'<a href="#">{" ".join(words[k : k + 2])}</a>']
        return " ".join(words)

    def bit(lo: int, hi: int) -> str:
        words = rng.choice(paragraphs).split()
        k = rng.randrange(len(words)) if words else 0
        return MARKED + (" ".join(words[k : k + rng.randint(lo, hi)]) or "x")

    def cell() -> str:
        return rng.choice([bit(1, 3), f"{MARKED}{rng.randint(0, 99)}", f"{MARKED}{rng.randint(0, 9999) / 10}"])

    def table() -> str:
        n = rng.randint(2, 4)
        head = f"<caption>{bit(1, 6)}</caption>" * (rng.random() < 0.3) + f"<tr>{''.join(f'<th>{bit(1, 2)}</th>' for _ in range(n))}</tr>"
        rows = "".join(f"<tr>{''.join(f'<td>{cell()}</td>' for _ in range(n))}</tr>" for _ in range(rng.randint(1, 5)))
        return f"<table>{head * (rng.random() < 0.7)}{rows}</table>"

    def code() -> str:
        lines = "\n".join(f"{bit(1, 1)[1:]} = {rng.choice([str(rng.randint(0, 999)), bit(1, 2)[1:]])}" for _ in range(rng.randint(1, 4)))
        return rng.choice(["<pre>|</pre>", "<pre><code>|</code></pre>", '<pre class="code">|</pre>']).replace("|", MARKED + lines)

    def points() -> str:
        tag = rng.choice(["ul", "ol"])
        return f"<{tag}>{''.join(f'<li>{bit(1, 4)}</li>' for _ in range(rng.randint(2, 6)))}</{tag}>"

    def figure() -> str:
        return f'<figure><img src="x.png"><figcaption>{bit(2, 12)}</figcaption></figure>'

    def terms() -> str:
        return f"<dl>{''.join(f'<dt>{bit(1, 2)}</dt><dd>{bit(1, 8)}</dd>' for _ in range(rng.randint(1, 4)))}</dl>"

    def rights() -> str:
        name = " ".join(w.capitalize() for w in short().split()[:2])
        return rng.choice(_RIGHTS).replace("YEAR", str(rng.randint(1990, 2035))).replace("NAME", name)

    def cut(t: str) -> str:
        return " ".join(t.split()[: rng.randint(4, 25)]) if rng.random() < 0.3 else t

    paragraphs = [cut(p) for p in paragraphs]
    title = f"<h1>{MARKED}{' '.join(paragraphs[0].split()[:10])}</h1>" if rng.random() < 0.8 else ""
    body = [f"<{t}>{MARKED}{linked(p)}</{t}>" for p in paragraphs for t in [rng.choice(["p"] * 8 + ["div", "blockquote", "h2"])]]
    if rng.random() < 0.25:
        items = "".join(f"<li>{MARKED}{linked(cut(rng.choice(paragraphs)))}</li>" for _ in range(rng.randint(2, 5)))
        body.insert(rng.randint(0, len(body)), f"<ul>{items}</ul>")
    for kind in (table, code, points, figure, terms):
        if rng.random() < 0.2:
            body.insert(rng.randint(0, len(body)), kind())
    if rng.random() < 0.3:
        body.insert(rng.randint(0, len(body)), note())
    if rng.random() < 0.2:
        body.insert(rng.randint(0, len(body)), wrap(["<aside>|</aside>"], f"<p>{rng.choice(strings)}</p>"))
    main = wrap(_CONTENT, title + "".join(body))
    if rng.random() < 0.15:  # a page of nothing but content
        return main if rng.random() < 0.5 else f"<html><body>{title}{''.join(body)}</body></html>"
    before = [wrap(_LISTS, links(3, 9))] * (rng.random() < 0.85) + [wrap(_TOPS, f"<p>{short()}</p>")] * (rng.random() < 0.5)
    before += [note()] * (rng.random() < 0.5) + [wrap(_FORMS, short())] * (rng.random() < 0.3)
    after = [comments()] * (rng.random() < 0.4) + [wrap(_SIDES, f"<h3>{short()}</h3>{links(2, 8)}")] * (rng.random() < 0.5)
    after += [wrap(_SIDES, "".join(f"<p>{x}</p>" for x in some(1, 3)))] * (rng.random() < 0.2)
    after += [note()] * (rng.random() < 0.3) + [wrap(_FORMS, rng.choice(strings))] * (rng.random() < 0.3)
    rng.shuffle(before)
    rng.shuffle(after)
    if rng.random() < 0.15 and after:
        before.append(after.pop())
    foot = wrap(_BOTTOMS, rng.choice([f"<p>{rights()}</p>", rights(), f"<p>&copy; {short()}</p>", f"&copy; {short()} &middot; {rng.choice(strings)}", links(2, 5)]))
    middle = main + "".join(after)
    page = "".join(before) + (wrap(_WRAPS, middle) if rng.random() < 0.4 else middle) + foot * (rng.random() < 0.9)
    return f"<html><head><title>{short()}</title></head><body>{page}" + "</body></html>" * (rng.random() < 0.8)


#: Marks a content block of a training layout; never part of a vector.
MARKED = "\x01"


def labelled(page: list[Block]) -> tuple[list[Block], np.ndarray]:
    y = np.array([b.text.startswith(MARKED) for b in page], dtype=np.float32)
    return [b._replace(text=b.text.lstrip(MARKED) or " ") for b in page], y


def nameless(page: list[Block]) -> list[Block]:
    """The blocks under the same elements without words of class, id and role."""
    seen: dict[int, Node] = {}
    for b in page:
        above = None
        for node in b.node.line():
            above = seen.setdefault(id(node), Node(above, node.marks[:1]))
    return [b._replace(node=seen[id(b.node)]) for b in page]


def training_pages(sample: list[str], layouts: int = LAYOUTS, seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors and labels of the sampled pages and of their new layouts."""
    rng, slots = random.Random(seed), _Slots()
    parsed = [p for p in (blocks(x) for x in sample) if p]
    taught = [np.array([teacher(b.node) for b in p], dtype=np.float32) for p in parsed]
    out = [(vectors(p, slots), y) for p, y in zip(parsed, taught, strict=True) if (y >= 0).any()]
    clean = lambda t: t.replace("<", " ").replace("&", " ").replace(MARKED, " ")
    texts = [[clean(b.text) for b, v in zip(p, y, strict=True) if v == 1] for p, y in zip(parsed, taught, strict=True)]
    # where nothing tells content, the longest blocks stand for it
    texts = [t or [clean(b.text) for b in sorted(p, key=lambda b: -len(b.text))[:5]] for t, p in zip(texts, parsed, strict=True)]
    texts = texts or [["Lorem ipsum dolor sit amet, consetetur sadipscing elitr.", "Sed diam nonumy eirmod tempor invidunt ut labore."]]
    strings = [" ".join(s.split()[: rng.randint(3, 60)]) for t in texts for s in t]
    strings = [s for s in strings if s.strip()] or ["lorem ipsum"]
    for t in texts:
        for _ in range(layouts):
            lo = rng.randrange(len(t))
            content = [x for x in t[lo : lo + rng.randint(1, 14)] if x.strip()] or ["lorem"]
            page, y = labelled(blocks(layout(content, strings, rng)))
            if rng.random() < 0.15:  # a site whose class names say nothing
                page = nameless(page)
            out.append((vectors(page, slots), y))
    return out


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> Network:
    """Trains on at most ``sample`` different pages, those with the smallest hashes."""
    rows = pages.select(S.text_or_empty(html_col).alias("html")).filter(F.length("html").between(1, TRAIN_CHARS))
    # copies of a page count once; they could fill or shrink the sample
    least = S.least_hashes(rows, "html", sample)
    u = F.xxhash64("html")
    chosen = [r["html"] for r in rows.filter(u <= least[-1]).distinct().orderBy(u, "html").collect()] if least else []
    return train(training_pages(chosen))


def extract(net: Network, pages: list[str], slots: _Slots, threshold: float = 0.5) -> list[str]:
    """The main texts of pages, labelled in batches of like length."""
    parsed = [blocks(p) for p in pages]
    texts = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if parsed[k]), key=lambda k: len(parsed[k]))
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi + 1 - lo) * len(parsed[order[hi]]) <= CELLS:
            hi += 1
        part = order[lo:hi]
        lo = hi
        if len(parsed[part[0]]) > SLICE_BLOCKS:
            logits = np.concatenate([run_long(net, parsed[k], slots) for k in part])
        else:
            sizes = np.array([len(parsed[k]) for k in part])
            logits = run_embedded(net, np.concatenate([embed(net, parsed[k], slots) for k in part]), sizes)
        content = logits >= np.log(threshold / (1 - threshold))
        at = 0
        for k in part:
            n = len(parsed[k])
            found = zip(parsed[k], content[at : at + n], strict=True)
            texts[k] = "\n".join(b.text for b, yes in found if yes and not b.node.apart)
            at += n
    return texts


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample: int = SAMPLE) -> DataFrame:
    """One row per page: ``(id, url, text, n_chars)``."""
    S.ship_code(pages.sparkSession)
    net = pages.sparkSession.sparkContext.broadcast(fit(pages, html_col, sample))

    @F.pandas_udf("struct<text:string,n_chars:long>")
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        slots = _Slots()
        for batch in batches:
            out: list[str] = []
            part: list[str] = []
            size = 0
            for page in batch:
                part.append(page)
                size += len(page)
                if size >= SLICE_CHARS:
                    out += extract(net.value, part, slots)
                    part, size = [], 0
            out += extract(net.value, part, slots) if part else []
            yield pd.DataFrame({"text": out, "n_chars": [len(t) for t in out]})

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), main_text(S.text_or_empty(html_col)).alias("m"))
    return rows.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "m.text", "m.n_chars")
