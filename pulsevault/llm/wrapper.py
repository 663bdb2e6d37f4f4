"""Main text of pages by wrapper induction.

Pages of a host share a template. Every page is read into a tree of blocks; simple tree matching aligns
it with a reference page of the host: the smallest tree of its own outline if that is frequent on the host,
else of the host's most frequent outline; of equally large matchings one with most equal texts counts. Aligned text
positions are slots, and the other texts share a slot with those of the same path of labels. A text that a large share of the host's different pages have in the same slot is
template there; every other text of the slot is content. The share does
not depend on how many pages a host has.

Names are a prior. Parts that HTML itself names as something else (navigation, footers, forms, adverts,
comments ...) are left out unless nothing else remains, so that they are never why a page is empty. On hosts of
``MIN_PAGES`` different pages or more, text in an article or main part is template only if half of the pages agree
on it, and the slots decide outside of it too; on smaller hosts content is looked for in the article or main
part only, if a page has one.

Nothing is gathered by host: outlines and slot texts are counted by partial aggregates, and the
references (a few small trees per host) and template texts are broadcast if they are few, else joined by
host. Pages with equal trees count once, so copies of an article do not turn it into template.

Defined results: a null page equals the empty page, whose text is empty; broken markup ends with the page;
pages of a null url share the empty host; repeated rows get equal results; a host with fewer than ``MIN_PAGES`` different
pages has no template slots; an empty table gives an empty table; only the id, url and page are read, so
other columns cannot clash.
"""

from __future__ import annotations

import json
import struct
from base64 import b64decode
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsevault.llm.common import executors_ready, small_or, stored
from pulsevault.llm.page_tree import Node, parse, texts
from pulsevault.llm.url_reputation import host_of

#: Different pages that a slot must occur in, and that must have the same text there for it to be template.
MIN_PAGES, MIN_SAME = 8, 5
#: Share of a host's different pages from which an outline has its own reference.
MIN_OUTLINE = 0.05
#: Share of the slot's different pages from which a text is template, outside and within an article or main part.
MIN_SHARE, MIN_SHARE_MAIN = 0.2, 0.5
#: References and templates are broadcast up to so many hosts and characters, else joined by host (a host with a
#: large share of the pages is split by Spark's adaptive skew join then).
BROADCAST_HOSTS, BROADCAST_CHARS = 50_000, 64 << 20


def _short(data: bytes) -> int:
    return struct.unpack("<q", blake2b(data, digest_size=8).digest())[0]


def outline(root: Node) -> int:
    """Hash of the tree's labels with runs of equal siblings as one."""
    inner: list[list[bytes]] = [[]]
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, closed = todo.pop()
        if closed:
            own = blake2b(node.label.encode() + b"(" + b"".join(inner.pop()), digest_size=16).digest()
            if not inner[-1] or inner[-1][-1] != own:
                inner[-1].append(own)
        elif node.text is None:
            inner.append([])
            todo.append((node, True))
            todo.extend((c, False) for c in reversed(node.children))
    return _short(inner[0][0])


def packed_tree(root: Node) -> str:
    """The tree as text: '(label' and ')' for elements, 't' for text runs."""
    out: list[str] = []
    todo: list[Node | None] = [root]
    while todo:
        node = todo.pop()
        if node is None:
            out.append(")")
        elif node.text is not None:
            out.append("t")
        else:
            out.append("(" + node.label)
            todo.append(None)
            todo.extend(reversed(node.children))
    return "\n".join(out)


def unpacked_tree(data: str) -> Node:
    stack = [Node("")]
    for line in data.split("\n"):
        if line == "t":
            stack[-1].children.append(Node("#text", ""))
        elif line == ")":
            stack.pop()
        else:
            node = Node(line[1:])
            stack[-1].children.append(node)
            stack.append(node)
    return stack[0].children[0]


#: Length from which lists are matched a row at a time.
_WIDE = 64
#: Weight of a matched pair; equal texts weigh 1 and so only choose among matchings of one size.
_PAIR = 1 << 32


class _Shapes:
    """Subtrees by shape: label, shapes of the children, and the value of a text that both trees have. A matching's
    weight depends on the two shapes alone, so equal parts are weighed once and lists of like siblings stay small."""

    def __init__(self, a: Node, b: Node, ours: dict[int, int], theirs: dict[int, int]):
        both = set(ours.values()) & set(theirs.values())
        self.of: dict[int, int] = {}  # shape of a node, by identity
        self.label: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.own: list[int] = []  # weight of the shape matched with itself
        self.plain: list[bool] = []  # whether it is an element around one text
        self.weights: dict[tuple[int, int], int] = {}
        known: dict[tuple, int] = {}
        for root, values in ((a, ours), (b, theirs)):
            todo = [(root, False)]
            while todo:
                node, closed = todo.pop()
                if not closed and node.children:
                    todo.append((node, True))
                    todo.extend((c, False) for c in node.children)
                    continue
                value = values.get(id(node), 0) if node.text is not None else 0
                value, kids = value if value in both else 0, tuple(self.of[id(c)] for c in node.children)
                key = (node.label, node.text is not None, value, kids)
                if key not in known:
                    known[key] = len(self.own)
                    self.label.append(node.label)
                    self.kids.append(kids)
                    self.own.append(_PAIR + (value != 0) + sum(self.own[k] for k in kids))
                    self.plain.append(len(kids) == 1 and self.label[kids[0]] == "#text" and not self.kids[kids[0]])
                self.of[id(node)] = known[key]

    def _open(self, c: int, d: int) -> bool:
        """Whether the weight of the pair takes a matching of its children."""
        return c != d and self.label[c] == self.label[d] and bool(self.kids[c]) and bool(self.kids[d]) and not (self.plain[c] and self.plain[d])

    def _pair(self, c: int, d: int) -> int:
        if c == d:
            return self.own[c]
        if self.label[c] != self.label[d]:
            return 0
        if self._open(c, d):
            return self.weights[c, d]
        return 2 * _PAIR if self.plain[c] and self.plain[d] else _PAIR

    def _ends(self, xs: tuple[int, ...], ys: tuple[int, ...]) -> tuple[int, int]:
        """How many children are equal at the start and at the end; matching these is never worse."""
        n, start, end = min(len(xs), len(ys)), 0, 0
        while start < n and xs[start] == ys[start]:
            start += 1
        while end < n - start and xs[-1 - end] == ys[-1 - end]:
            end += 1
        return start, end

    def lists(self, xs: tuple[int, ...], ys: tuple[int, ...], trace: bool = False) -> tuple[int, list[tuple[int, int]]]:
        """Weight of the best order-keeping matching of two lists of children, and its places if traced: two
        rows of weights and a byte a cell."""
        start, end = self._ends(xs, ys)
        total = sum(self.own[k] for k in (*xs[:start], *xs[len(xs) - end:]))
        left, right = xs[start:len(xs) - end], ys[start:len(ys) - end]
        rows = self._wide_rows if len(right) >= _WIDE else self._rows
        weight, steps = rows(left, right, trace)
        total += weight
        if not trace:
            return total, []
        chosen = [(k, k) for k in range(start)] + [(len(xs) - k, len(ys) - k) for k in range(1, end + 1)]
        i, j = len(left), len(right)
        while i and j:
            step = steps[i - 1][j - 1]
            if step == 2:
                chosen.append((start + i - 1, start + j - 1))
            i, j = i - (step != 1), j - (step != 0)
        return total, chosen

    def _rows(self, left: tuple[int, ...], right: tuple[int, ...], trace: bool) -> tuple[int, list]:
        """Weight of the best matching, and a step for each cell: 0 leaves out the left one, 1 the right one, 2 pairs them."""
        above, steps, last, weights = [0] * (len(right) + 1), [], None, []
        for c in left:
            if c != last:
                last, weights = c, [self._pair(c, d) for d in right]
            best, row, step = 0, [0], bytearray(len(right))
            for j, w in enumerate(weights):
                if above[j + 1] >= best:
                    best = above[j + 1]
                else:
                    step[j] = 1
                if w and above[j] + w > best:
                    best, step[j] = above[j] + w, 2
                row.append(best)
            above = row
            if trace:
                steps.append(step)
        return above[-1], steps

    def _wide_rows(self, left: tuple[int, ...], right: tuple[int, ...], trace: bool) -> tuple[int, list]:
        """The same, a row at a time: what comes from the left is the running maximum."""
        shapes, at = np.unique(np.array(right), return_inverse=True)
        above, steps, known = np.zeros(len(right) + 1, np.int64), [], {}
        for c in left:
            if c not in known:
                if len(known) * len(shapes) > 1 << 20:
                    known.clear()
                known[c] = np.array([self._pair(c, d) for d in shapes.tolist()], np.int64)
            w = known[c][at]
            paired = np.where(w > 0, above[:-1] + w, 0)
            row = np.zeros_like(above)
            np.maximum.accumulate(np.maximum(above[1:], paired), out=row[1:])
            if trace:
                other = np.maximum(above[1:], row[:-1])
                steps.append(np.where(paired > other, 2, above[1:] < row[:-1]).astype(np.uint8).tobytes())
            above = row
        return int(above[-1]), steps

    def weight(self, a: int, b: int) -> int:
        """Weight of the best matching of two shapes of one label."""
        todo = [(a, b, False)] if self._open(a, b) else []
        while todo:
            c, d, ready = todo.pop()
            if (c, d) in self.weights:
                continue
            xs, ys = self.kids[c], self.kids[d]
            if ready:
                self.weights[c, d] = _PAIR + self.lists(xs, ys)[0]
                continue
            todo.append((c, d, True))
            start, end = self._ends(xs, ys)
            inner = set(ys[start:len(ys) - end])
            todo.extend((e, f, False) for e in set(xs[start:len(xs) - end]) for f in inner if self._open(e, f))
        return self._pair(a, b)


def _matching(a: Node, b: Node, ours: dict[int, int] = {}, theirs: dict[int, int] = {}) -> tuple[int, list[tuple[Node, Node]]]:  # noqa: B006
    """Simple tree matching: size of the largest top-down, order-keeping matching of two trees, and its pairs;
    of equally large ones, one with most pairs of text runs with equal values (by identity)."""
    if a.label != b.label:
        return 0, []
    shapes = _Shapes(a, b, ours, theirs)
    size, of = shapes.weight(shapes.of[id(a)], shapes.of[id(b)]), shapes.of
    pairs, walk = [], [(a, b)]
    while walk:
        x, y = walk.pop()
        pairs.append((x, y))
        c, d = of[id(x)], of[id(y)]
        if c == d:
            walk.extend(zip(x.children, y.children, strict=True))
        elif x.children and y.children:
            walk.extend((x.children[i], y.children[j]) for i, j in shapes.lists(shapes.kids[c], shapes.kids[d], True)[1])
    return size // _PAIR, pairs


def paths(root: Node) -> list[int]:
    """Negative hash of the labels above each text run, in page order."""
    out, todo = [], [(root, 0)]
    while todo:
        node, above = todo.pop()
        if node.text is not None:
            out.append(above)
        else:
            own = _short(struct.pack("<q", above) + node.label.encode()) | -(1 << 63)
            todo.extend((c, own) for c in reversed(node.children))
    return out


def slots(reference: Node, values: list[int], page: Node, page_values: list[int]) -> dict[int, int]:
    """Slot of each text run of the page, by identity: the index among the reference's text runs, or the
    (negative) path of a run that does not align."""
    ours, runs = texts(reference), texts(page)
    order = {id(t): k for k, t in enumerate(ours)}
    theirs = dict(zip(map(id, runs), page_values, strict=True))
    pairs = _matching(reference, page, dict(zip(map(id, ours), values, strict=True)), theirs)[1]
    found = dict(zip(map(id, runs), paths(page), strict=True))
    found.update((id(b), order[id(a)]) for a, b in pairs if a.text is not None)
    return found


class Wrapper:
    """A host's references and template texts, read from their JSON forms."""

    def __init__(self, references: str, template: str | None = None):
        rows = json.loads(references)
        self.trees = {r["outline"]: (unpacked_tree(r["tree"]), np.frombuffer(b64decode(r["values"]), np.int64).tolist()) for r in rows}
        self.main = rows[0]["outline"]
        self.template: dict[int, set[tuple[int, int, int]]] = {}
        for t in json.loads(template or "[]"):
            self.template.setdefault(t["outline"], set()).add((t["slot"], t["place"], t["value"]))
        self.inside = {own for own, found in self.template.items() if any(place < 2 for _, place, _ in found)}

    def text(self, page: Node) -> str:
        own = outline(page) if self.inside else self.main
        own = own if own in self.trees else self.main
        if own not in self.inside and any(not t.outside and (t.main or not t.link) for t in texts(page)):
            return main_text(page, set(), {}, True)  # only texts that names leave out anyway are template
        own, at_slot = self.aligned(outline(page), page, [_value(t.text) for t in texts(page)])
        return main_text(page, self.template.get(own, set()), at_slot, True)

    def aligned(self, own: int, page: Node, values: list[int]) -> tuple[int, dict[int, int]]:
        """The outline of the reference of a page with the outline ``own``, and the slots of its text runs."""
        own = own if own in self.trees else self.main
        return own, slots(*self.trees[own], page, values)


def _wrapper(known: dict, *key: str | None) -> Wrapper:
    if key not in known:
        if len(known) >= 256:
            known.clear()
        known[key] = Wrapper(*key)
    return known[key]


def _value(text: str) -> int:
    return _short(text.encode()) | 1


def _place(t: Node) -> int:
    return 2 if t.outside else int(t.main)


def main_text(root: Node, template: set[tuple[int, int, int]], aligned: dict[int, int], induced: bool = False) -> str:
    """The content's blocks, joined by an empty line; ``template``: (slot, place, text's hash); ``induced``: whether
    the host has enough pages for its slots to decide, else an article or main part does."""
    runs = [t for t in texts(root) if not template or (aligned.get(id(t)), _place(t), _value(t.text)) not in template]
    inside = [t for t in runs if not t.outside]
    kept = [] if induced else [t for t in inside if t.main]
    kept = kept or [t for t in inside if not t.link or induced and t.main] or [t for t in runs if not t.link] or inside
    return "\n\n".join(t.text for t in kept)


def _pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    return pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"),
                        host_of(pages[url_col].cast("string")).alias("host"), F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"))


def trees(rows: DataFrame) -> DataFrame:
    """(host, outline, tree_key, nodes, tree, values) of the pages (host, html): the tree and the hashes of its
    text runs with their place (1: in an article or main part; 2: named as not being main text). Texts of
    the last kind are not in the key, unless they are longer than all others."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                out = []
                for host, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    root = parse(page)
                    runs = texts(root)
                    values = np.array([_value(t.text) for t in runs], np.int64)
                    places = bytes(map(_place, runs))
                    named = sum(len(t.text) if t.outside else -len(t.text) for t in runs) > 0
                    told = values if named else np.where(np.frombuffer(places, np.uint8) == 2, 0, values)
                    packed = packed_tree(root)
                    out.append((host, outline(root), _short(packed.encode() + told.tobytes()), packed.count("\n") + 1,
                                packed, values.tobytes(), places))
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 names=["host", "outline", "tree_key", "nodes", "tree", "values", "places"])

    return rows.select("host", "html").mapInArrow(run, "host string, outline long, tree_key long, nodes int, tree string, values binary, places binary")


def references(found: DataFrame) -> DataFrame:
    """(host, references) with the smallest tree of each frequent outline of the host, the most frequent first."""
    by_outline = stored(found.groupBy("host", "outline").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("nodes", "tree_key")).alias("small")),
                        "wrapper-outlines")
    top = by_outline.groupBy(F.col("host").alias("t_host")).agg(F.sum("n").alias("pages"), F.max(F.struct("n", "outline")).alias("top"))
    frequent = (F.col("n") >= MIN_PAGES) & (F.col("n") >= MIN_OUTLINE * F.col("pages")) | (F.col("outline") == F.col("top.outline"))
    best = by_outline.join(top, F.col("host") == F.col("t_host")).filter((F.col("pages") >= MIN_PAGES) & frequent)
    best = stored(best.select("host", "n", F.col("small.tree_key").alias("tree_key")), "wrapper-best")
    one = found.join(best, ["host", "tree_key"]).select("host", "n", "outline", "tree", "values")
    each = one.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("n", "outline", "tree", "values")), asc=False).alias("r"))
    return each.select("host", F.to_json(F.expr("transform(r, x -> struct(x.outline, x.tree, x.values))")).alias("references"))


def _broadcast(hosts: DataFrame) -> DataFrame:
    """The stored ``hosts``, marked for broadcast if they are few and short."""
    size = F.sum(sum(F.coalesce(F.length(c), F.lit(0)) for c in hosts.columns))
    if (hosts.agg(size).first()[0] or 0) > BROADCAST_CHARS:
        return hosts
    return small_or(hosts, BROADCAST_HOSTS)[1]


def template_texts(found: DataFrame, refs: DataFrame) -> DataFrame:
    """(host, template): the texts that are template, as (outline of the reference, slot, place, value)."""
    refs = _broadcast(refs)
    rows = found.join(refs, "host").select("host", "outline", "tree", "values", "places", "references")

    def run(batches):
        known: dict = {}
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part, out = b.slice(at, 512), []
                for host, own, tree, values, places, refs_ in zip(*(part.column(i).to_pylist() for i in range(6)), strict=True):
                    page, values = unpacked_tree(tree), np.frombuffer(values, np.int64).tolist()
                    own, at_slot = _wrapper(known, refs_).aligned(own, page, values)
                    filled = {(at_slot[id(t)], place, v) for t, v, place in zip(texts(page), values, places, strict=True)}
                    filled |= {(slot, place, 0) for slot, place, _ in filled}
                    out.extend((host, own, *f) for f in filled)
                cols = list(zip(*out, strict=True)) if out else [()] * 5
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                 names=["host", "outline", "slot", "place", "value"])

    #: A page counts once per slot as value 0 and once per slot and text.
    filled = rows.mapInArrow(run, "host string, outline long, slot long, place int, value long")
    keys = ["host", "outline", "slot", "place"]
    values = filled.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    values = stored(values.filter(F.col("n") >= MIN_SAME), "wrapper-values")
    pages = values.filter((F.col("value") == 0) & (F.col("n") >= MIN_PAGES)).select(*keys, F.col("n").alias("pages"))
    often = values.filter("value != 0").join(pages, keys)
    fixed = often.filter(F.col("n") >= F.when(F.col("place") == 1, MIN_SHARE_MAIN).otherwise(MIN_SHARE) * F.col("pages"))
    template = F.sort_array(F.collect_set(F.struct("outline", "slot", "place", "value")))
    return fixed.groupBy("host").agg(F.to_json(template).alias("template"))


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    executors_ready(pages.sparkSession)
    rows = _pages(pages, id_col, url_col, html_col)
    first = F.min(F.struct("values", "places", "outline", "nodes", "tree")).alias("first")
    found = stored(trees(rows).groupBy("host", "tree_key").agg(first).select("host", "tree_key", "first.*"), "wrapper-trees")
    refs = stored(references(found), "wrapper-references")
    fixed = template_texts(found, refs)
    wrappers = stored(refs.join(fixed, "host", "left"), "wrapper-templates")
    wrappers = _broadcast(wrappers)
    rows = rows.join(wrappers, "host", "left").select("page_id", "url", "html", "references", "template")
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches):
        known: dict = {}
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part, out = b.slice(at, 512), []
                for page, refs_, fixed_ in zip(*(part.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                    root = parse(page)
                    out.append(_wrapper(known, refs_, fixed_).text(root) if refs_ else main_text(root, set(), {}))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
