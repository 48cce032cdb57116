"""Bodies of pages: the element that scores best, and the full text by its lines. Both read the tree once.

``best_block`` sums up every element from what is within it, bottom up: lengths of normalised text, of links and of
distinct blocks can all be joined from those of the children, so a page of deep nesting costs no more than a flat one.
``full_text`` cuts the page into lines and finds the best way to split them into stretches of text and of everything
else, by a dynamic programme over neighbours; a short line between long ones stays, since leaving and entering cost
more than it does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from newsloom.functions.dom import NOISE, Node

#: Elements that hold text, elements that may be a body, and weights of a block and of its links.
BLOCKS = {"p", "li", "h2", "h3", "h4", "blockquote", "pre", "td", "th", "figcaption"}
BODIES = {"article", "main", "section", "div", "body", "#"}
PER_BLOCK, PER_LINK = 120, 2
#: Elements that end a line of text, apart from blocks, and those that are never read.
BREAKS = BLOCKS | {"article", "body", "br", "center", "dd", "div", "dl", "dt", "figure", "h1", "h5", "h6", "hr", "html", "main", "ol", "section", "table", "tbody", "tr", "ul"}
UNREAD = frozenset(NOISE | {"head", "option", "select", "textarea"})
#: What a character of a line, of its links and a line itself are worth, and what a change between text and the rest costs.
LINE, LINK, CHANGE = -40, -3, 60


@dataclass
class Length:
    """How long a text is once blanks are drawn together and trimmed, in a form that can be joined to what follows."""

    chars: int = 0
    before: bool = False
    after: bool = False

    @classmethod
    def of(cls, text: str) -> Length:
        core = len(" ".join(text.split()))
        return cls(core, bool(text) and text[0].isspace(), bool(text) and text[-1].isspace())

    def then(self, other: Length) -> Length:
        if not self.chars:
            return Length(other.chars, self.before or other.before, other.after or (not other.chars and self.after))
        if not other.chars:
            return Length(self.chars, self.before, self.after or other.before)
        return Length(self.chars + other.chars + (self.after or other.before), self.before, other.after)


@dataclass
class Sum:
    """What is known of an element: lengths without and with noise, its blocks, their distinct texts and its links."""

    clean: Length = field(default_factory=Length)
    whole: Length = field(default_factory=Length)
    blocks: int = 0
    has_block: bool = False
    texts: dict[str, None] = field(default_factory=dict)
    chars: int = 0
    links: int = 0

    def score(self, tag: str) -> int:
        size = self.chars + max(len(self.texts) - 1, 0) if self.texts else self.clean.chars
        return size + PER_BLOCK * self.blocks - PER_LINK * min(self.links, size) + (tag == "article")

    def take(self, child: Sum) -> None:
        self.blocks += child.blocks
        self.has_block |= child.has_block
        self.links += child.links
        small, large = sorted((self.texts, child.texts), key=len)  # the smaller goes into the larger: n log n in all
        chars = child.chars if large is child.texts else self.chars
        for text in small:
            if text not in large:
                large[text] = None
                chars += len(text)
        self.texts, self.chars = large, chars


def block_texts(node: Node) -> list[str]:
    """Texts of an element's innermost blocks in their order, outside of menus, footers and the like."""
    noise, out, stack = frozenset(NOISE), [], [(node, False)]
    inner: dict[int, bool] = {}
    order: list[Node] = []
    while stack:  # children before their parents decide which blocks are innermost
        n, done = stack.pop()
        if done:
            inner[id(n)] = any(c.tag in BLOCKS or inner.get(id(c), False) for c in n.children if isinstance(c, Node) and c.tag not in noise)
        elif n.tag not in noise:
            order.append(n)
            stack.append((n, True))
            stack += [(c, False) for c in reversed(n.children) if isinstance(c, Node)]
    for n in order:
        if n.tag in BLOCKS and not inner[id(n)] and (text := n.text(noise)):
            out.append(text)
    return out


def own_text(node: Node) -> str:
    """Distinct blocks of an element as lines, or all of its text if it has none."""
    return "\n".join(dict.fromkeys(block_texts(node))) or node.text(frozenset(NOISE))


def best_block(root: Node) -> str:
    """Text of the element that scores best by its text and blocks, less its links; of equals the first on the page."""
    noise = frozenset(NOISE)
    sums: dict[int, Sum] = {}
    best: tuple[int, int] | None = None
    winner, number = None, 0
    stack: list[tuple[Node, int, bool]] = [(root, 0, False)]
    while stack:
        node, place, noisy = stack.pop()
        if id(node) not in sums:
            sums[id(node)] = Sum()
            number += 1
            stack.append((node, number, noisy))
            stack += [(c, 0, noisy or c.tag in noise) for c in reversed(node.children) if isinstance(c, Node)]
            continue
        own = sums[id(node)]
        for child in node.children:
            if isinstance(child, str):
                size = Length.of(child)
                own.clean, own.whole = own.clean.then(size), own.whole.then(size)
                continue
            part = sums.pop(id(child))
            own.whole = own.whole.then(part.whole)
            if child.tag not in noise:
                own.clean = own.clean.then(part.clean)
                own.take(part)
        if node.tag in BLOCKS and not noisy:
            if not own.has_block and own.clean.chars:
                text = node.text(noise)
                own.blocks, own.texts, own.chars = 1, {text: None}, len(text)
            own.has_block = True
        if node.tag == "a":
            own.links += own.whole.chars
        if node.tag in BODIES and not noisy:
            rank = own.score(node.tag), -place
            if rank[0] > 0 and (best is None or rank > best):
                best, winner = rank, node
    return own_text(winner) if winner else ""


def lines(root: Node) -> list[tuple[str, int]]:
    """Lines of a page with the characters of their links: text between elements that begin or end a line."""
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    linked = 0

    def end() -> None:
        nonlocal linked
        if text := " ".join("".join(parts).split()):
            out.append((text, min(linked, len(text))))
        parts.clear()
        linked = 0

    stack: list[tuple[Node | str | None, bool]] = [(root, False)]
    while stack:
        node, in_link = stack.pop()
        if node is None:
            end()
        elif isinstance(node, str):
            parts.append(node)
            linked += len(" ".join(node.split())) if in_link else 0
        elif node.tag not in UNREAD:
            if node.tag in BREAKS:
                end()
                stack.append((None, False))
            stack += [(c, in_link or node.tag == "a") for c in reversed(node.children)]
    end()
    return out


def full_text(root: Node) -> str:
    """Lines of the stretches of text that are worth most in all (``split``)."""
    found = lines(root)
    kept = split([len(text) + LINK * linked + LINE for text, linked in found])
    return "\n".join(text for (text, _), k in zip(found, kept, strict=True) if k)


def split(worth: list[int]) -> list[bool]:
    """Which lines are kept so that their worth, less ``CHANGE`` for every stretch of kept lines, is greatest.

    Of equally good ways the one that keeps more of the last lines is taken.
    """
    out, kept = 0, -CHANGE  # best so far if the last line was left, or kept
    came: list[tuple[bool, bool]] = []  # whether each of both came from a kept line
    for w in worth:
        from_kept = kept >= out, kept >= out - CHANGE
        out, kept = max(out, kept), max(kept, out - CHANGE) + w
        came.append(from_kept)
    last, flags = kept >= out, []
    for left, stayed in reversed(came):
        flags.append(last)
        last = stayed if last else left
    return flags[::-1]
