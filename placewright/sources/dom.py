"""A small document tree over the standard library's HTML parser.

What a browser lays out can't be known from a parser: ``shown`` looks at inline styles and the ``hidden`` attribute
only, and ``layout_text`` breaks lines at block elements and ``br``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style", "template", "noscript"))
BLOCK = frozenset("address article aside blockquote body dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
#: An element of the key closes open ones of the values, up to the given border.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}


class Node:
    __slots__ = ("tag", "attrs", "items", "parent", "number")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.items, self.number = tag, attrs, parent, [], -1

    def get(self, name: str) -> str:
        return self.attrs.get(name) or ""

    @property
    def classes(self) -> list[str]:
        return self.get("class").split()

    @property
    def children(self) -> list[Node]:
        return [x for x in self.items if isinstance(x, Node)]

    def walk(self) -> Iterator[Node]:
        """All elements below, in document order."""
        for x in self.items:
            if isinstance(x, Node):
                yield x
                yield from x.walk()

    def above(self) -> Iterator[Node]:
        n = self.parent
        while n is not None and n.tag != "#root":
            yield n
            n = n.parent

    def strings(self) -> Iterator[str]:
        for x in self.items:
            if isinstance(x, str):
                yield x
            elif x.tag not in SILENT:
                yield from x.strings()

    def text(self, between: str = " ") -> str:
        """Its pieces of text, stripped, blank ones left out."""
        return between.join(filter(None, (s.strip() for s in self.strings())))

    def whole_text(self) -> str:
        return "".join(self.strings() if self.tag not in SILENT else (x for x in self.items if isinstance(x, str)))

    def layout_text(self) -> str:
        """Text as a browser would break it into lines."""
        out: list[str] = []

        def visit(n: Node) -> None:
            for x in n.items:
                if isinstance(x, str):
                    out.append(re.sub(r"\s+", " ", x) if n.tag not in ("pre", "textarea") else x)
                elif x.tag == "br":
                    out.append("\n")
                elif x.tag not in SILENT and x.shown(alone=True):
                    border = "\n" if x.tag in BLOCK and x.tag not in ("td", "th") else "\t" if x.tag in ("td", "th") else ""
                    out.append(border)
                    visit(x)
                    out.append(border)

        visit(self)
        return "".join(out)

    def shown(self, alone: bool = False) -> bool:
        for n in [self] if alone else [self, *self.above()]:
            if "hidden" in n.attrs or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", n.get("style")):
                return False
        return True

    def sibling(self, step: int) -> Node | None:
        own = self.parent.children if self.parent else []
        at = next((i for i, x in enumerate(own) if x is self), -1) + step
        return own[at] if 0 <= at < len(own) else None

    def find(self, tag: str) -> Node | None:
        return next((n for n in self.walk() if n.tag == tag), None)

    def select(self, selector: str) -> list[Node]:
        """Elements below that a selector picks (see ``compile_selector``)."""
        fits = compile_selector(selector)
        return [n for n in self.walk() if fits(n, self)]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES:
            kinds, border = CLOSES[tag]
            n = self.now
            while n.tag != "#root" and n.tag not in border:
                if n.tag in kinds:
                    self.now = n.parent
                n = n.parent
        elif tag in BLOCK:
            n = self.now
            if n.tag == "p":
                self.now = n.parent
        node = Node(tag, {k: v if v is not None else "" for k, v in attrs}, self.now)
        self.now.items.append(node)
        if tag not in VOID:
            self.now = node

    def handle_endtag(self, tag):
        n = self.now
        while n.tag not in ("#root", tag):
            if n.tag == "table" and tag != "table":
                return
            n = n.parent
        if n.tag == tag:
            self.now = n.parent

    def handle_data(self, data):
        self.now.items.append(data)


def parse(html: str | None) -> Node:
    """The root of the document tree."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


_PART = re.compile(r'\s*([>\s]?)\s*((?:[\w*-]+|[.#][\w-]+|:scope|:nth-child\(\d+\)|:-soup-contains\("[^"]*"\)|\[[\w-]+\])+)')
_SIMPLE = re.compile(r'([.#]?)([\w*-]+)|(:scope)|:nth-child\((\d+)\)|:-soup-contains\("([^"]*)"\)|\[([\w-]+)\]')
Test = Callable[[Node, Node], bool]


def compile_selector(selector: str) -> Test:
    """Tags, ``.class``, ``#id``, ``[attribute]``, ``:scope``, ``:nth-child(n)``, ``:-soup-contains("text")``, with
    descendant and child combinators and commas; anything else is an error."""
    choices = [_chain(s) for s in selector.split(",")] if "(" not in selector else [_chain(selector)]
    return lambda n, scope: any(c(n, scope) for c in choices)


def _chain(selector: str) -> Test:
    steps: list[tuple[str, Test]] = []
    at, selector = 0, selector.strip().replace("\\", "")
    while at < len(selector):
        m = _PART.match(selector, at)
        if not m:
            raise ValueError(f"selector not supported: {selector}")
        steps.append((">" if ">" in m[0][: m.start(2) - m.start()] else " ", _compound(m[2])))
        at = m.end()
    if not steps:
        raise ValueError("empty selector")

    def fits(n: Node, scope: Node, i: int = len(steps) - 1) -> bool:
        if not steps[i][1](n, scope):
            return False
        if i == 0:
            return True
        if steps[i][0] == ">":
            return n.parent is not None and (n.parent is scope or n.parent.tag != "#root") and fits(n.parent, scope, i - 1)
        return any(fits(p, scope, i - 1) for p in n.above())

    return fits


def _compound(part: str) -> Test:
    tests: list[Test] = []
    for mark, name, scope, nth, inside, attribute in _SIMPLE.findall(part):
        if scope:
            tests.append(lambda n, s: n is s)
        elif nth:
            tests.append(lambda n, s, k=int(nth): n.parent is not None and len(n.parent.children) >= k and n.parent.children[k - 1] is n)
        elif inside:
            tests.append(lambda n, s, t=inside: t in n.whole_text())
        elif attribute:
            tests.append(lambda n, s, a=attribute: a in n.attrs)
        elif mark == ".":
            tests.append(lambda n, s, c=name: c in n.classes)
        elif mark == "#":
            tests.append(lambda n, s, c=name: n.get("id") == c)
        elif name != "*":
            tests.append(lambda n, s, t=name.lower(): n.tag == t)
    return lambda n, s: all(t(n, s) for t in tests)
