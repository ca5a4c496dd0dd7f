"""Main text of pages by a tree-structured graphical model.

Every node of a page's tree of blocks is main text or not. A node's own evidence (element,
names in class, id and role, share of links, length, sentence ends) gives its unary
potential, and each edge has a potential for parent and child by the child's element. Messages pass up
the tree and down again (sum-product), which is exact on a tree, and a run of text whose
marginal reaches 0.5 is kept. Both potentials are counted over labelled pages: layouts
labelled by rule, and at most ``SAMPLE`` given pages (smallest hash of the page) whose own article
or main element marks the text; blocks in it that bear a name of page furniture are not.

Defined results: null and empty pages give the empty text, as do pages without main text;
unclosed and stray tags are repaired as browsers do; repeated rows are read each by
itself; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm import labelled_pages as layouts
from episodica.llm.dom import HINT, Node, parse
from episodica.llm.tables import slices, smallest_hashes

SAMPLE = 1000
SMOOTH = 0.5
OWN, EDGE = 0.4, 2.0
"""Exponents of the potentials: pieces of evidence overlap, so each counts less than alone. Chosen on layouts of another seed."""
FURNITURE_TAGS = frozenset(("nav", "footer", "aside", "form"))
FURNITURE_HINTS = frozenset(
    h for kinds in (layouts.MENUS, layouts.FOOTERS, layouts.SIDES, layouts.NOTICES, layouts.ADS, layouts.FORMS, layouts.COMMENTS) for _, a in kinds for h in HINT.findall(a)
) - {"class", "id", "role", "top", "list"}


def evidence(node: Node) -> list[str]:
    out = ["tag " + node.tag, *{"name " + h for h in node.hints}]
    if node.size:
        share = node.linked / node.size
        out.append("links " + ("none" if share == 0 else "some" if share < 0.34 else "many" if share < 0.8 else "all"))
    if node.tag == "#":
        out.append(f"size {min(6, int(math.log2(1 + node.size / 12)))}")
        out.append("ends" if node.text[-1] in ".!?" else "open")
    return out


def labels_by_hand(nodes: list[Node]) -> list[bool | None]:
    """Marks hold for all below them; a block is main text if most of its text is."""
    inside = [False] * len(nodes)
    for i, node in enumerate(nodes):
        inside[i] = node.label == "1" or (node.parent >= 0 and inside[node.parent])
    return by_share(nodes, inside)


def labels_by_element(nodes: list[Node]) -> list[bool | None] | None:
    """Labels of a page that has an article or main element, None for other pages."""
    inside, out = [False] * len(nodes), [False] * len(nodes)
    for i, node in enumerate(nodes):
        above = node.parent >= 0 and inside[node.parent]
        shut = node.parent >= 0 and out[node.parent]
        out[i] = shut or node.tag in FURNITURE_TAGS or bool(FURNITURE_HINTS.intersection(node.hints))
        inside[i] = (above or node.tag in ("article", "main")) and not out[i]
    return by_share(nodes, inside) if any(inside) else None


def by_share(nodes: list[Node], inside: list[bool]) -> list[bool | None]:
    good = [n.size if n.tag == "#" and x else 0 for n, x in zip(nodes, inside, strict=True)]
    for i in range(len(nodes) - 1, 0, -1):
        good[nodes[i].parent] += good[i]
    return [2 * g >= n.size if n.size else None for g, n in zip(good, nodes, strict=True)]


def count(nodes: list[Node], labels: list[bool | None], into: Counter) -> None:
    for node, label in zip(nodes, labels, strict=True):
        if label is None:
            continue
        into["node", "", int(label)] += 1
        for e in evidence(node):
            into["own", e, int(label)] += 1
        if node.parent >= 0 and labels[node.parent] is not None:
            into["edge", node.tag, 2 * int(labels[node.parent]) + int(label)] += 1


class Model:
    def __init__(self, counts: dict[tuple[str, str, int], int]):
        get = counts.get
        totals = [get(("node", "", y), 0) + 2 * SMOOTH for y in (0, 1)]
        self.own = {e: [((get(("own", e, y), 0) + SMOOTH) / totals[y]) ** OWN for y in (0, 1)] for kind, e, _ in counts if kind == "own"}
        edge = {tag: [(get(("edge", tag, s), 0) + SMOOTH) ** EDGE for s in range(4)] for kind, tag, _ in counts if kind == "edge"}
        self.edge = {tag: (a / (a + b), b / (a + b), c / (c + d), d / (c + d)) for tag, (a, b, c, d) in edge.items()}
        self.other = (0.9, 0.1, 0.3, 0.7)

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of main text for every node, by messages to the root and back."""
        n = len(nodes)
        belief0, belief1 = [1.0] * n, [1.0] * n
        up0, up1 = [1.0] * n, [1.0] * n
        for i, node in enumerate(nodes):
            p0 = p1 = 1.0
            for e in evidence(node):
                if (own := self.own.get(e)) is not None:
                    p0, p1 = p0 * own[0], p1 * own[1]
            belief0[i], belief1[i] = p0 / (p0 + p1), p1 / (p0 + p1)
        for i in range(n - 1, 0, -1):
            # All below i has arrived: scale, then send sum over i's states to the parent.
            b0, b1 = belief0[i], belief1[i]
            total = b0 + b1
            b0, b1 = b0 / total, b1 / total
            e = self.edge.get(nodes[i].tag, self.other)
            belief0[i], belief1[i] = b0, b1
            up0[i], up1[i] = b0 * e[0] + b1 * e[1], b0 * e[2] + b1 * e[3]
            parent = nodes[i].parent
            p0, p1 = belief0[parent] * up0[i], belief1[parent] * up1[i]
            belief0[parent], belief1[parent] = p0 / (p0 + p1), p1 / (p0 + p1)
        for i in range(1, n):
            # The parent's belief without what i itself sent.
            parent = nodes[i].parent
            d0, d1 = belief0[parent] / up0[i], belief1[parent] / up1[i]
            e = self.edge.get(nodes[i].tag, self.other)
            b0, b1 = belief0[i] * (d0 * e[0] + d1 * e[2]), belief1[i] * (d0 * e[1] + d1 * e[3])
            belief0[i], belief1[i] = b0 / (b0 + b1), b1 / (b0 + b1)
        return belief1

    def main_text(self, html: str) -> str:
        nodes = parse(html)
        found = self.marginals(nodes)
        return "\n".join([n.text for n, p in zip(nodes, found, strict=True) if n.tag == "#" and p >= 0.5])


def fit(pages: DataFrame, html_column: str = "html", sample: int = SAMPLE) -> Model:
    """Counts over the labelled pages; one row per piece of evidence comes to the driver."""
    spark = pages.sparkSession
    by_hand = spark.createDataFrame([(h, True) for h in layouts.labelled_pages()], "html string, by_hand boolean")
    given = pages.filter(F.col(html_column).isNotNull()).select(F.col(html_column).alias("html"))
    given = smallest_hashes(given, sample, "html").select("html", F.lit(False).alias("by_hand"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch, texts in slices(batches, 0):
            for html, hand in zip(texts, batch.column(1).to_pylist(), strict=True):
                nodes = parse(html)
                labels = labels_by_hand(nodes) if hand else labels_by_element(nodes)
                if labels is not None:
                    count(nodes, labels, found)
        columns = list(zip(*((*k, n) for k, n in found.items()), strict=True)) or [[], [], [], []]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["kind", "what", "state", "n"])

    counted = by_hand.union(given).mapInArrow(run, "kind string, what string, state int, n long").groupBy("kind", "what", "state").agg(F.sum("n").alias("n"))
    return Model({(r["kind"], r["what"], r["state"]): r["n"] for r in counted.collect()})


def extracted(pages: DataFrame, model: Model, columns: tuple[str, ...] = ("page_id", "url"), html_column: str = "html") -> DataFrame:
    """The named columns, text and n_chars of every page."""
    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in columns)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, len(columns)):
            found = [shared.value.main_text(t) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=[*columns, "text", "n_chars"])

    return pages.select(*(F.col(f"`{c}`") for c in columns), F.col(html_column)).mapInArrow(run, f"{fields}, text string, n_chars long")
