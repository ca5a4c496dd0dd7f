"""Pages as trees of blocks with their runs of text."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

# Elements that break lines, elements whose content is no markup and is not read, elements that are
# parts of forms or pictures, which a block ends, and elements that end an open one.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul "
    "button canvas iframe noscript object optgroup option select svg template".split()
)
RAW = frozenset("script style title textarea".split())
ENDED = frozenset("button optgroup option select svg".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset(("ul", "ol", "dl", "table", "menu"))

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>|</?[a-zA-Z][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|data-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HINT = re.compile(r"[a-z]+")


class Node:
    """A block element, or (tag ``#``) a run of text between block borders."""

    __slots__ = ("tag", "parent", "hints", "label", "text", "size", "linked")

    def __init__(self, tag: str, parent: int, hints: tuple[str, ...] = (), label: str | None = None):
        self.tag, self.parent, self.hints, self.label = tag, parent, hints, label
        self.text, self.size, self.linked = "", 0, 0


def parse(html: str) -> list[Node]:
    """Nodes in page order, each after its parent; sizes hold all text below.

    Only scripts, styles, titles and text areas are left out, to the end of the page where they
    are not closed; formulas are text, and buttons, pictures, frames and the like are nodes.
    """
    nodes, stack = [Node("html", -1)], [0]
    # How many elements of a tag are open: a stray end tag does not search the stack.
    opened: Counter[str] = Counter()
    run: list[tuple[str, bool]] = []
    link, at, end = False, 0, len(html)

    def close_run() -> None:
        nonlocal run
        if run:
            text = " ".join(unescape("".join([t for t, _ in run])).split())
            if text:
                node = Node("#", stack[-1])
                node.text, node.size = text, len(text)
                node.linked = min(len(text), sum([len(t.strip()) for t, linked in run if linked]))
                nodes.append(node)
            run = []

    def cut(depth: int) -> None:
        for i in stack[depth:]:
            opened[nodes[i].tag] -= 1
        del stack[depth:]

    def pop_to(tags: tuple[str, ...], walls: frozenset[str]) -> None:
        if not any(opened[tag] for tag in tags):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[depth]].tag
            if tag in tags:
                cut(depth)
                return
            if tag in walls:
                return

    while at < end:
        found = TOKEN.search(html, at)
        stop = found.start() if found else end
        if stop > at:
            run.append((html[at:stop], link))
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag, closing = found[2].lower(), bool(found[1])
        if tag in RAW:
            if not closing and not found[3].endswith("/"):
                finish = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                at = finish.end() if finish else end
        elif tag == "a":
            link = not closing
        elif tag == "br":
            run.append((" ", link))
        elif tag in BLOCKS:
            close_run()
            link = False
            if closing:
                pop_to((tag,), frozenset())
                continue
            if tag != "hr" and not (tag == "svg" and found[3].endswith("/")):
                if tag not in ENDED:
                    while nodes[stack[-1]].tag in ENDED:
                        cut(len(stack) - 1)
                if tag in CLOSES:
                    pop_to(CLOSES[tag], LISTS)
                pop_to(("p",), frozenset(BLOCKS - {"p"}))
                hints, label = [], None
                for name, *values in ATTRIBUTE.findall(found[3]) if found[3] else ():
                    value = "".join(values)
                    if name.lower() == "data-label":
                        label = value
                    else:
                        hints += HINT.findall(value.lower())
                nodes.append(Node(tag, stack[-1], tuple(hints), label))
                stack.append(len(nodes) - 1)
                opened[tag] += 1
    close_run()
    for node in reversed(nodes):
        if node.parent >= 0:
            nodes[node.parent].size += node.size
            nodes[node.parent].linked += node.linked
    return nodes
