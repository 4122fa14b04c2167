"""A small tree of an HTML page, from the standard library's parser. One parse serves all lookups in a page."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.entities import html5
from html.parser import HTMLParser

REFERENCE = re.compile(r"&(#[0-9]+;|#[xX][0-9A-Fa-f]+;|[A-Za-z][A-Za-z0-9]*;)?")
VOID = frozenset(("br", "img", "hr", "meta", "link", "input", "source", "wbr", "col", "area", "base", "embed", "track", "param"))
#: A start tag that ends an open element, and the elements beyond which it doesn't reach.
ENDS = {"tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "p": ({"p"}, {"div", "td", "li", "body", "article"})}


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def walk(self) -> Iterator[Node]:
        """All elements below, in the order of the page."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def all(self, *selectors: str) -> Iterator[Node]:
        """Elements that fit any selector: `tag`, `.class`, `#id`, `tag.class`."""
        tests = [fits(s) for s in selectors]
        return (n for n in self.walk() if any(t(n) for t in tests))

    def first(self, *selectors: str) -> Node | None:
        """The first element of the first selector that has one."""
        return next((n for s in selectors for n in self.all(s)), None)

    def own(self, *tags: str) -> list[Node]:
        """Child elements of these tags."""
        return [c for c in self.children if isinstance(c, Node) and c.tag in tags]

    def up(self, tag: str) -> Node | None:
        node = self.parent
        while node is not None and node.tag != tag:
            node = node.parent
        return node

    def after(self) -> list[Node]:
        """The elements beside this one, behind it."""
        beside = [c for c in self.parent.children if isinstance(c, Node)] if self.parent else []
        return beside[next(i for i, c in enumerate(beside) if c is self) + 1 :] if beside else []

    def strings(self, without: Callable[[Node], bool] | None = None, breaks: frozenset[str] = frozenset()) -> Iterator[str]:
        """The pieces of text; a line break after an element in `breaks`."""
        for c in self.children:
            if isinstance(c, str):
                yield c
            elif without is None or not without(c):
                yield from c.strings(without, breaks)
                if c.tag in breaks:
                    yield "\n"

    def text(self) -> str:
        """One line: pieces between blanks, white space collapsed."""
        return " ".join(" ".join(self.strings()).split())


def fits(selector: str) -> Callable[[Node], bool]:
    tag, dot, name = selector.partition(".")
    if selector.startswith("#"):
        return lambda n: n.attrs.get("id") == selector[1:]
    return lambda n: (not tag or n.tag == tag) and (not dot or name in n.classes)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDS:
            ended, bound = ENDS[tag]
            node, last = self.at, None
            while node.parent is not None and node.tag not in bound:
                last = node if node.tag in ended else last
                node = node.parent
            self.at = last.parent if last is not None else self.at
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def closed(html: str) -> str:
    """The page with an & as text wherever no whole entity with its semicolon follows."""
    return REFERENCE.sub(lambda m: m[0] if m[1] and (m[1][0] == "#" or m[1] in html5) else f"&amp;{m[1] or ''}", html)


def parse(html: str | None, strict: bool = False) -> Node:
    """Browsers also read some entities that lack their semicolon (`&amp` at the end of a text that was cut); if strict,
    these stay as they are written."""
    builder = _Builder()
    builder.feed(closed(html or "") if strict else html or "")
    builder.close()
    return builder.root
