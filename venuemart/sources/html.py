"""A small element tree over the standard HTML parser, for page parsers that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class Node:
    """An element: tag, attributes, and children (elements and texts)."""

    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def elements(self) -> Iterator["Node"]:
        """All elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def matching(self, tag: str, cls: str | None = None, deep: bool = True, **attrs: str) -> Iterator["Node"]:
        """Elements with the tag, with the class (one of its classes, or all of them as written) and attributes."""
        for node in self.elements() if deep else (c for c in self.children if isinstance(c, Node)):
            if node.tag != tag or any(node.attrs.get(k) != v for k, v in attrs.items()):
                continue
            if cls is not None:
                names = node.attrs.get("class", "").split()
                if cls not in names and cls != " ".join(names):
                    continue
            yield node

    def find_all(self, tag: str, cls: str | None = None, deep: bool = True, **attrs: str) -> list["Node"]:
        return list(self.matching(tag, cls, deep, **attrs))

    def find(self, tag: str, cls: str | None = None, deep: bool = True, **attrs: str) -> "Node | None":
        return next(self.matching(tag, cls, deep, **attrs), None)

    @property
    def text(self) -> str:
        parts, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item)
            else:
                stack.extend(reversed(item.children))
        return "".join(parts)

    def markup(self) -> str:
        """The element as HTML again."""
        parts, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item)
            elif isinstance(item, tuple):
                parts.append(item[0])
            else:
                if not item.tag:
                    stack.extend(c if isinstance(c, Node) else (escape(c, quote=False),) for c in reversed(item.children))
                    continue
                attrs = "".join(f' {k}="{escape(v)}"' for k, v in item.attrs.items())
                if item.tag in VOID:
                    parts.append(f"<{item.tag}{attrs}/>")
                    continue
                parts.append(f"<{item.tag}{attrs}>")
                stack.append((f"</{item.tag}>",))
                raw = item.tag in ("script", "style")
                stack.extend(c if isinstance(c, Node) else (c if raw else escape(c, quote=False),) for c in reversed(item.children))
        return "".join(parts)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse_html(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root
