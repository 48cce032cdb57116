"""Pages as trees of elements, by the standard library's parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.entities import html5
from html.parser import HTMLParser

#: Elements without content.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements that are no part of a body.
NOISE = {"script", "style", "noscript", "nav", "footer", "header", "aside", "form", "iframe", "svg", "button", "template"}
#: What may be a character reference, and what stands for an ampersand that is none; texts of tables never hold it.
REFERENCE, BARE = re.compile(r"&(#(?:[0-9]+|[xX][0-9a-fA-F]+);|[a-zA-Z][a-zA-Z0-9]*;)?"), "\ud800"


@dataclass
class Node:
    tag: str
    attrs: dict[str, str]
    parent: Node | None = None
    children: list = field(default_factory=list)

    def walk(self, skip: frozenset = frozenset()) -> Iterator[Node]:
        """This element and those in it, in the order of the page; not into elements to skip."""
        stack = [self]
        while stack:
            node = stack.pop()
            if node.tag not in skip:
                yield node
                stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self, skip: frozenset = frozenset()) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif node.tag not in skip:
                stack += reversed(node.children)
        return re.sub(r"\s+", " ", "".join(out)).strip()


class _Tree(HTMLParser):
    """Builds the tree; how many elements of a tag are open is counted, so an end without a start costs nothing."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#", {})
        self.open: dict[str, int] = {}

    def handle_starttag(self, tag, attrs):
        tag = tag.replace(BARE, "&")
        if tag == "p" and self.at.tag == "p":
            self._close()
        node = Node(tag, {k.replace(BARE, "&"): (v or "").replace(BARE, "&") for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] = self.open.get(tag, 0) + 1

    def _close(self):
        self.open[self.at.tag] -= 1
        self.at = self.at.parent

    def handle_endtag(self, tag):
        tag = tag.replace(BARE, "&")
        if self.open.get(tag):
            while self.at.tag != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        self.at.children.append(data.replace(BARE, "&"))


def _terminated(found: re.Match) -> str:
    name = found[1]
    return found[0] if name and (name[0] == "#" or name in html5) else BARE + (name or "")


def parse(html: str, terminated: bool = False) -> Node:
    """The tree of a page. Browsers read some references without their semicolon (``&amp`` as ``&``), and so does this,
    unless it is told to read ``terminated`` ones only, as texts that were cut within a reference want it."""
    tree = _Tree()
    tree.feed(REFERENCE.sub(_terminated, html or "") if terminated else html or "")
    tree.close()
    return tree.root
