"""Pages as sequences of text blocks with their tag paths.

A block is the text between two block-level tags; inline tags do not end it. The
path of a block is its open elements, each with the words of its class, id and
role. Contents of scripts, styles and other elements that are not rendered as text
never become blocks. Formulas are inline text. What is inside drawings, choice lists
and templates has their names in its path (``APART``), by which readers tell it; such
an element without a closing tag is left out of paths, so that it swallows nothing.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# How element names behave.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle mpadded msub msup msubsup munder mover munderover "
    "mtable mtr mtd semantics annotation".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe noframes".split())
APART = frozenset("<svg> <select> <template>".split())
#: An opening tag of the key closes an open element of the values, up to its container.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
CONTAINERS = frozenset("ul ol dl table tbody thead tfoot tr div section article main aside nav header footer form body html".split())
CLOSE_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)

_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>\"']*)([^>\"']*)>")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ASIDE = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_ENDS = re.compile(r"[\"'>]")
_LONG_REFERENCE = re.compile(r"&#0*([0-9]{8,});?")
_ZEROS = re.compile(r"&#0+(?=[0-9])")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HUMP = re.compile(r"([a-z0-9])([A-Z])")
_WORDS = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    """An open element: its own marks (its name, words of class, id and role) and the
    element around it. Blocks under equal paths share their nodes."""

    __slots__ = ("parent", "marks", "length", "apart", "slots", "label")

    def __init__(self, parent: Node | None, marks: tuple[str, ...]):
        self.parent, self.marks = parent, marks
        self.length: int = len(marks) + (parent.length if parent else 0)
        self.apart: bool = (parent is not None and parent.apart) or not APART.isdisjoint(marks)
        # what a reader of paths works out once a node
        self.slots = self.label = None

    def line(self) -> list[Node]:
        """The nodes from the outermost to this one."""
        out, node = [], self
        while node is not None:
            out.append(node)
            node = node.parent
        return out[::-1]


class Block(NamedTuple):
    text: str
    node: Node
    linked: int  # characters inside links

    @property
    def path(self) -> tuple[str, ...]:
        """The marks of all open elements, outermost first."""
        return tuple(m for node in self.node.line() for m in node.marks)


def _marks(attributes: str) -> list[str]:
    """Words of class, id and role; ``hidden`` for elements that are not shown."""
    out: list[str] = []
    for name, a, b, c in _ATTR.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            out += _WORDS.findall(_HUMP.sub(r"\1 \2", value).lower())
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _HIDDEN.search(value)):
            out.append("hidden")
    return out


def _unescape(text: str) -> str:
    """Character references decoded; numbers beyond any character are U+FFFD."""
    if "&#" in text:
        text = _LONG_REFERENCE.sub("\ufffd", _ZEROS.sub("&#", text))
    return html.unescape(text)


class _Tags:
    """Tags of a page from left to right, in time proportional to the page.

    What lies ahead is remembered: the next ``>``, the next quote or ``>``, and the
    quotes from which no tag ends, so nothing is read again from every tag.
    """

    def __init__(self, page: str):
        self.page = page
        self._ahead: dict[str, tuple[int, int]] = {}
        self._endless: set[int] = set()

    def next(self, what: str, at: int, find) -> int:
        """``find(at)``, which gives a place at or after ``at`` or -1, remembered."""
        since, found = self._ahead.get(what, (1, 0))
        if not (since <= at and (found < 0 or at <= found)):
            found = find(at)
            self._ahead[what] = at, found
        return found

    def gt(self, at: int) -> int:
        return self.next(">", at, lambda i: self.page.find(">", i))

    def _special(self, at: int) -> int:
        def find(i: int) -> int:
            m = _ENDS.search(self.page, i)
            return m.start() if m else -1

        return self.next("ends", at, find)

    def _end(self, at: int) -> int:
        """The first ``>`` outside quotes; where quotes do not close, the first at all."""
        page, i, quotes = self.page, at, []
        while (i := self._special(i)) >= 0:
            if page[i] == ">":
                return i
            if i in self._endless:
                break
            quotes.append(i)
            i = page.find(page[i], i + 1) + 1
            if not i:
                break
        self._endless.update(quotes)
        return self.gt(at)

    def close(self, name: str, at: int) -> int:
        """The place after the closing tag of ``name``, -1 if none follows."""

        def find(i: int) -> int:
            m = re.compile(rf"</{re.escape(name)}\b", re.I).search(self.page, i)
            return m.start() if m else -1

        start = self.next("</" + name, at, find)
        return self.gt(start) + 1 or -1 if start >= 0 else -1

    def __call__(self, at: int):
        """``(start, end, closing, name, attributes)`` of the next tag, comment or
        declaration (these without a name); None if there is none."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            if page[at : at + 1] in ("!", "?"):
                return start, _ASIDE.match(page, start).end(), False, "", ""
            closing = page[at : at + 1] == "/"
            if self.gt(at) < 0:
                continue
            plain = _PLAIN.match(page, start)
            if plain:
                return start, plain.end(), closing, plain[2].lower(), plain[3]
            name = _NAME.match(page, at + closing)
            if name:
                end = self._end(name.end())
                return start, end + 1, closing, name[0].lower(), page[name.end() : end]
        return None


class _Open:
    """The open elements, with the places of each name."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, Node]] = []
        self._at: dict[str, list[int]] = {}
        self._containers: list[int] = []  # but for table rows
        self._known: dict[tuple[int, tuple[str, ...]], Node] = {}
        self.top = self._root = Node(None, ())

    def last(self, *names: str) -> int:
        """The place of the innermost open element of these names, -1 if none."""
        return max((self._at[n][-1] for n in names if self._at.get(n)), default=-1)

    def container(self, rows: bool) -> int:
        return max(self._containers[-1] if self._containers else -1, self.last("tr") if rows else -1)

    def push(self, name: str, marks: tuple[str, ...]) -> None:
        key = id(self.top), marks
        node = self._known.get(key)
        if node is None:
            node = self._known[key] = Node(self.top, marks)
        place = len(self.stack)
        self._at.setdefault(name, []).append(place)
        if name in CONTAINERS and name != "tr":
            self._containers.append(place)
        self.stack.append((name, node))
        self.top = node

    def cut(self, place: int) -> None:
        """Closes the element at ``place`` and all inside it."""
        while len(self.stack) > place:
            name, _ = self.stack.pop()
            self._at[name].pop()
            if name in CONTAINERS and name != "tr":
                self._containers.pop()
        self.top = self.stack[-1][1] if self.stack else self._root


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, with white space collapsed.

    Takes time and memory in proportion to the page, however deep its elements are
    nested and whatever quotes, tags and comments are left open.
    """
    out: list[Block] = []
    tags, opened = _Tags(page), _Open()
    bare: dict[str, tuple[str, ...]] = {}
    parts: list[str] = []
    links = linked = 0
    node = opened.top

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(_unescape("".join(parts)).split())
            if text:
                out.append(Block(text, node, linked))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked, node
        if text and not text.isspace() and not "".join(parts[-1:]).strip():
            node = opened.top
        if text:
            parts.append(text)
            linked += len(text.strip()) if links else 0

    apart_seen = False
    at = 0
    while True:
        tag = tags(at)
        if not tag:
            add(page[at:])
            break
        start, end, closing, name, attributes = tag
        add(page[at:start])
        at = end
        if not name:
            continue
        if closing:
            if name == "a":
                links = max(0, links - 1)
            if name not in INLINE:
                flush()
                if (place := opened.last(name)) >= 0:
                    opened.cut(place)
            continue
        empty = attributes.rstrip().endswith("/")
        if name in RAW and empty and opened.last("svg") >= 0:
            continue
        if name in RAW:
            flush()
            end = tags.close(name, at)
            at = end if end >= 0 else at if empty else len(page)
            continue
        if name in INLINE:
            if name == "br":
                add(" ")
            elif name == "a":
                links += 1
            continue
        flush()
        links = 0
        if apart_seen and name in CLOSE_P and name != "hr":
            # block elements end a drawing or a choice list that is still open
            place = opened.last("svg", "select")
            if place > opened.last("foreignobject", "template"):
                opened.cut(place)
        if name in CLOSE_P and (place := opened.last("p")) >= 0:
            opened.cut(place)
        if name in CLOSES:
            place = opened.last(*CLOSES[name])
            if place >= 0 and place >= opened.container(rows=name not in ("tr", "td", "th")):
                opened.cut(place)
        if f"<{name}>" in APART:
            if tags.close(name, at) < 0:
                continue
            apart_seen = True
        if name not in VOID and not empty:
            marks = bare.setdefault(name, (f"<{name}>",))
            opened.push(name, (*marks, *_marks(attributes)) if attributes and not attributes.isspace() else marks)
    flush()
    return out
