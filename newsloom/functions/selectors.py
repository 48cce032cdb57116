"""CSS selectors compiled to an automaton that reads a page's elements once, for any number of selectors.

A selector is a row of steps (``article h2 > a[href]``); a state says which steps an element has reached, as bits of one
number. An element is tested only against steps that its tag, its id, one of its classes or nothing at all may meet,
and hands its state on to the elements within, so the work does not grow with the number of selectors that a page has
no use for, nor with the depth of its nesting.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from newsloom.functions.dom import Node

_STEP = re.compile(r"\s*([>]?)\s*((?:[a-zA-Z][\w-]*|\*)?(?:[.#][\w&-]+|\[[^\]]+\])*)")
_PART = re.compile(r"([.#])([\w&-]+)|\[\s*([\w:-]+)\s*(?:([*^$~]?=)\s*(?:\"([^\"]*)\"|'([^']*)'|([^\]\s]*))\s*)?\]")


class Step:
    """One compound of a selector: a tag, an id, classes and conditions on attributes."""

    def __init__(self, text: str) -> None:
        tag = re.match(r"[a-zA-Z][\w-]*", text)
        self.tag = tag[0].lower() if tag else ""
        self.ids, self.classes, self.attrs = [], [], []
        for kind, name, attr, op, *values in _PART.findall(text):
            if attr:
                self.attrs.append((attr.lower(), op, next((v for v in values if v), "")))
            else:
                (self.ids if kind == "#" else self.classes).append(name)
        if not (text.strip("*") == "" or self.tag or self.ids or self.classes or self.attrs):
            raise ValueError(f"not a selector: {text}")

    def key(self) -> tuple[str, str]:
        """What an element must have for the step to be tried: the rarest part that it names."""
        if self.ids:
            return "#", self.ids[0]
        if self.classes:
            return ".", self.classes[0]
        return ("t", self.tag) if self.tag else ("", "")

    def meets(self, node: Node, classes: list[str]) -> bool:
        if self.tag and node.tag != self.tag:
            return False
        if any(node.attrs.get("id") != i for i in self.ids) or any(c not in classes for c in self.classes):
            return False
        return all(self._has(node.attrs.get(name), op, value) for name, op, value in self.attrs)

    @staticmethod
    def _has(have: str | None, op: str, value: str) -> bool:
        if have is None:
            return False
        if op in ("", "="):
            return not op or have == value
        if not value:
            return False  # nothing begins with, ends with or holds nothing
        return {"*=": value in have, "^=": have.startswith(value), "$=": have.endswith(value), "~=": value in have.split()}[op]


def steps(selector: str) -> list[tuple[bool, Step]]:
    """The steps of a selector, each with whether it has to be a child of the one before."""
    out, at = [], 0
    selector = selector.strip()
    while at < len(selector):
        found = _STEP.match(selector, at)
        if not found or found.end() == at or not found[2]:
            raise ValueError(f"not a selector: {selector}")
        out.append((found[1] == ">", Step(found[2])))
        at = found.end()
    if not out or out[0][0]:
        raise ValueError(f"not a selector: {selector}")
    return out


class Automaton:
    """Several selectors, read in one pass; ``run`` gives the elements of each by its place in the list."""

    def __init__(self, selectors: tuple[str, ...]) -> None:
        self.tried: dict[tuple[str, str], list[tuple[int, int, int, Step]]] = {}
        self.final: dict[int, int] = {}
        bit = 0
        for place, selector in enumerate(selectors):
            last = None
            for child, step in steps(selector):
                # needs the bit of the step before: among all ancestors, or of the parent alone
                self.tried.setdefault(step.key(), []).append((1 << bit, 0 if last is None or child else 1 << last, 1 << last if last is not None and child else 0, step))
                last, bit = bit, bit + 1
            self.final[1 << last] = place

    def run(self, root: Node) -> Iterator[tuple[int, Node]]:
        """(place of a selector, element) in the order of the page."""
        stack: list[tuple[Node, int, int]] = [(root, 0, 0)]  # element, states of all ancestors, state of the parent
        while stack:
            node, above, parent = stack.pop()
            own, classes = 0, node.attrs.get("class", "").split()
            keys = [("", ""), ("t", node.tag), ("#", node.attrs.get("id", "")), *((".", c) for c in dict.fromkeys(classes))]
            for key in keys:
                for bit, ancestor, child, step in self.tried.get(key, ()):
                    if not ancestor & ~above and not child & ~parent and step.meets(node, classes):
                        own |= bit
            hits = sorted(self.final[bit] for bit in self.final if own & bit) if own else []
            for place in hits:
                yield place, node
            stack += [(c, above | own, own) for c in reversed(node.children) if isinstance(c, Node)]


@lru_cache(maxsize=512)
def compiled(*selectors: str) -> Automaton:
    return Automaton(selectors)


def select(root: Node, *selectors: str) -> list[Node]:
    """Elements of any of some selectors, once each, in the order of the page."""
    out: list[Node] = []
    for _, node in compiled(*selectors).run(root):
        if not out or out[-1] is not node:
            out.append(node)
    return out


def first(root: Node, selector: str) -> Node | None:
    return next((node for _, node in compiled(selector).run(root)), None)
