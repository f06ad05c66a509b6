"""Just enough of HTML: a page as a tree of elements, and simple tree matching of two trees."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np

# A quote hides what follows only where it opens a value, behind "="; one that is never closed hides
# nothing, and a tag that is never closed runs to the end of the page. Possessive, so that a broken page
# is read once.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
# Elements without content, elements whose content is no markup, inline elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for tag in RAW}
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
                   "q ruby s samp small span strike strong sub sup time tt u var wbr img".split())
# Cells of a table of two runs of siblings and of all tables of a match, beyond which a match goes level by
# level; weights that it keeps then, and parts that a table which is too large is read off in.
CELLS, ALL_CELLS, KEPT, PARTS = 1 << 20, 1 << 22, 1 << 22, 16
# What an opening tag ends, and which elements such an end does not leave.
_BLOCKS = frozenset("address article aside blockquote details div dl fieldset figcaption figure "
                    "footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul "
                    "menu".split())
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
         "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
         "tbody": {"tr", "td", "th", "thead", "tbody"}}
_SCOPES = frozenset("html body div table ul ol dl section article main nav aside header footer form "
                    "blockquote td th select button".split())


class Node:
    """An element: tag, attributes, and children, which are nodes or texts."""

    __slots__ = ("attributes", "children", "name", "tag")

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag, self.attributes, self.children = tag, attributes, []
        self.name = (tag, attributes.get("class", ""), attributes.get("id", ""))


def parse(page: str) -> Node:
    """The tree of a page; never fails. What is left open ends with its parent or the page."""
    root = Node("#root", {})
    stack, at = [root], 0
    opened: Counter[str] = Counter()  # tags on the stack: what is not there need not be looked for

    def close(k: int) -> None:
        opened.subtract(node.tag for node in stack[k:])
        del stack[k:]

    while token := _TOKEN.search(page, at):
        if token.start() > at:
            stack[-1].children.append(html.unescape(page[at:token.start()])
                                      if stack[-1].tag not in RAW else "")
        at = token.end()
        if not token[2]:
            continue
        tag = token[2].lower()
        if token[1]:
            if opened[tag] > 0:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        ends = {"p"} if tag in _BLOCKS else _ENDS.get(tag)
        if ends and any(opened[end] > 0 for end in ends):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    close(k)
                    if tag in _BLOCKS or tag in ("li", "option"):
                        break
                elif stack[k].tag in _SCOPES:
                    break
        attributes = {}
        for key, value in _ATTRIBUTE.findall(token[3]):
            attributes.setdefault(key.lower(), html.unescape(value.strip("\"'")))
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag not in VOID and not token[3].endswith("/"):
            stack.append(node)
            opened[tag] += 1
            if tag in RAW:  # inside a script and the like only its own end tag counts
                end = _RAW_END[tag].search(page, at)
                if end is None:
                    at = len(page)
                else:
                    close(len(stack) - 1)
                    at = end.end()
    if at < len(page) and stack[-1].tag not in RAW:
        stack[-1].children.append(html.unescape(page[at:]))
    return root


def own_text(node: Node) -> str:
    """The text directly in an element, white space as one blank."""
    return " ".join(" ".join(c for c in node.children if isinstance(c, str)).split())


class Tree:
    """A page's elements in page order, by number: names, texts, children, and subtree keys."""

    def __init__(self, root: Node, skipped=lambda node: False) -> None:
        self.nodes: list[Node] = []
        self.names: list[tuple] = []
        self.texts: list[str] = []
        self.kids: list[list[int]] = []
        todo = [(root, -1)]
        while todo:
            node, parent = todo.pop()
            k = len(self.nodes)
            self.nodes.append(node)
            self.names.append(node.name)
            self.texts.append(own_text(node))
            self.kids.append([])
            if parent >= 0:
                self.kids[parent].append(k)
            todo += [(c, k) for c in reversed(node.children)
                     if isinstance(c, Node) and not skipped(c)]
        self.keys: list = [None] * len(self.nodes)
        self.sizes = [1] * len(self.nodes)
        for k in range(len(self.nodes) - 1, -1, -1):
            self.sizes[k] += sum(self.sizes[j] for j in self.kids[k])
            self.keys[k] = hash((self.nodes[k].name, self.texts[k], *[self.keys[j] for j in self.kids[k]]))


def _trimmed(a: Tree, b: Tree, left: list[int], right: list[int]) -> tuple[list, list[int], list[int]]:
    """Pairs of equal subtrees at both ends of two runs, which need no table, and what lies between."""
    pairs: list[tuple[int, int]] = []
    head = tail = 0
    while head < min(len(left), len(right)) and a.keys[left[head]] == b.keys[right[head]]:
        pairs.append((left[head], right[head]))
        head += 1
    while (tail < min(len(left), len(right)) - head
           and a.keys[left[-1 - tail]] == b.keys[right[-1 - tail]]):
        pairs.append((left[-1 - tail], right[-1 - tail]))
        tail += 1
    return pairs, left[head:len(left) - tail], right[head:len(right) - tail]


class _Levels:
    """The weights of `match` by whole levels: an element of `a` against a run of a level of `b` at once.

    In the order of its levels the children of neighbours are neighbours, so the tables of an element
    against all of a run are one row of numbers, one part for each, lifted by `step` a part: a running
    maximum then never takes from the part before. Memory follows the length of the pages (and KEPT):
    weights that are not kept are computed again when pairs are read off from the top.
    """

    def __init__(self, a: Tree, b: Tree) -> None:
        self.a, self.b, self.step = a, b, 3 * a.sizes[0] + 1
        order = [0]
        for k in order:
            order += b.kids[k]
        self.place = {k: p for p, k in enumerate(order)}
        n_kids = np.array([len(b.kids[k]) for k in order])
        self.first = np.concatenate([[1], 1 + np.cumsum(n_kids)])  # of an element's children, in that order
        self.lift = self.step * np.concatenate([[0], np.repeat(np.arange(len(order)), n_kids)])
        ids: dict = {}

        def numbers(values: list) -> list[int]:
            return [ids.setdefault(v, len(ids)) for v in values]

        self.own = [*zip(*(numbers(x) for x in ([n.tag for n in a.nodes], a.names, a.texts)))]
        self.tags, self.names, self.texts = (np.array(numbers([x[k] for k in order])) for x in (
            [n.tag for n in b.nodes], b.names, b.texts))
        self.kept: dict[int, tuple[int, np.ndarray]] = {}
        self.least: list[tuple[int, int]] = []  # the kept ones, smallest subtrees first
        self.n_kept = 0

    def _known(self, x: int, lo: int, hi: int) -> np.ndarray | None:
        at, found = self.kept.get(x, (hi, None))
        return found[lo - at:hi - at] if found is not None and at <= lo and hi <= at + len(found) else None

    def _keep(self, x: int, lo: int, found: np.ndarray) -> None:
        if self.a.sizes[x] == 1 or x in self.kept:
            return
        self.kept[x] = lo, found
        heappush(self.least, (self.a.sizes[x], x))
        self.n_kept += len(found)
        while self.n_kept > KEPT:
            self.n_kept -= len(self.kept.pop(heappop(self.least)[1])[1])

    def _opened(self, x: int, lo: int, hi: int) -> list:
        same = self.tags[lo:hi] == self.own[x][0]
        lift = self.lift[self.first[lo]:self.first[hi]]
        return [x, lo, hi, same, lift, lift, iter(self.a.kids[x] if len(lift) and same.any() else [])]

    def _closed(self, x: int, lo: int, hi: int, same: np.ndarray, lift: np.ndarray, best: np.ndarray, _) -> np.ndarray:
        _, name, text = self.own[x]
        found = 1 + (self.names[lo:hi] == name) + (self.texts[lo:hi] == text)
        ends = self.first[lo:hi + 1] - self.first[lo]
        some = ends[1:] > ends[:-1]
        found[some] += (best - lift)[ends[1:][some] - 1]
        found *= same
        self._keep(x, lo, found)
        return found

    def weights(self, x: int, lo: int, hi: int) -> np.ndarray:
        """Weights of x and places lo to hi of one level, 0 where the tags differ."""
        found = self._known(x, lo, hi)
        if found is not None:
            return found
        open_ = [self._opened(x, lo, hi)]
        while True:  # children before parents, by a stack of our own, as pages may be nested deeply
            x, lo, hi, _, lift, best, kids = top = open_[-1]
            kid = next(kids, None)
            if kid is None:
                found = self._closed(*open_.pop())
                if not open_:
                    return found
                top = open_[-1]
            else:
                run = int(self.first[lo]), int(self.first[hi])
                found = self._known(kid, *run)
                if found is None:
                    open_.append(self._opened(kid, *run))
                    continue
            lift, best = top[4:6]
            before = np.concatenate([lift[:1], np.maximum(best[:-1], lift[1:])])
            top[5] = np.maximum.accumulate(np.maximum(best, before + found))

    def pairs(self, i: int, j: int) -> list[tuple[int, int]]:
        """Pairs of the children of a pair. Of a large table a few rows are kept, and those between come again."""
        pairs, left, right = _trimmed(self.a, self.b, self.a.kids[i], self.b.kids[j])
        if not left or not right:
            return pairs
        if len(left) == len(right) == 1:
            same = self.a.nodes[left[0]].tag == self.b.nodes[right[0]].tag
            return [*pairs, *zip(left, right)] if same else pairs
        lo = self.place[right[0]]

        def rows(row: np.ndarray, run: list[int]) -> Iterator[np.ndarray]:
            for x in run:
                gain = row[:-1] + self.weights(x, lo, lo + len(row) - 1)
                row = np.concatenate([row[:1], np.maximum.accumulate(np.maximum(row[1:], gain))])
                yield row

        n = len(right)
        runs = [(np.zeros(n + 1, np.int64), left)]  # with the row of the table before each
        while runs and n:
            row, run = runs.pop()
            row, m = row[:n + 1], len(run)
            if m > 1 and m * n > CELLS:
                size = -(-m // PARTS)
                for k in range(0, m, size):
                    runs.append((row, run[k:k + size]))
                    for row in rows(row, run[k:k + size]) if k + size < m else ():
                        pass
                continue
            table = [row, *rows(row, run)]
            while m and n:
                if table[m][n] == table[m - 1][n]:
                    m -= 1
                elif table[m][n] == table[m][n - 1]:
                    n -= 1
                else:
                    m, n = m - 1, n - 1
                    pairs.append((run[m], right[n]))
        return pairs


def _match_by_levels(a: Tree, b: Tree) -> dict[int, int]:
    levels = _Levels(a, b)
    matched, todo = {}, [(0, 0)]
    while todo:
        i, j = todo.pop()
        matched[i] = j
        todo += zip(a.kids[i], b.kids[j]) if a.keys[i] == b.keys[j] else levels.pairs(i, j)
    return matched


def match(a: Tree, b: Tree) -> dict[int, int]:
    """Simple tree matching: pairs of elements of an order-preserving top-down matching of most weight.

    Elements match only with equal tags and matched parents. A pair weighs 1, and as much again
    for the same class and id, and for the same text. Equal subtrees match as they are. Pages whose
    tables would be large are matched level by level, with the same pairs in memory that follows
    their length; the work is the product of the lengths of their levels.
    """
    weights: dict[tuple[int, int], tuple[float, list]] = {}
    plans: dict[tuple[int, int], tuple[list, list[int], list[int]]] = {}
    spent = 0

    def weigh(i: int, j: int) -> tuple[float, list]:
        """Weight and pairs of the children of a pair, of whose own pairs the weights are known."""
        pairs, left, right = plans.pop((i, j))
        total = 1.0 + (a.names[i] == b.names[j]) + (a.texts[i] == b.texts[j])
        total += sum(3.0 * a.sizes[x] for x, _ in pairs)
        if not left or not right:
            return total, pairs
        table = [[0.0] * (len(right) + 1)]
        others = [(b.names[y], b.texts[y], y, not b.kids[y], b.nodes[y].tag) for y in right]
        for x in left:
            name, text, tag, leaf = a.names[x], a.texts[x], a.nodes[x].tag, not a.kids[x]
            above, row, best = table[-1], [0.0], 0.0
            for n, (name2, text2, y, leaf2, tag2) in enumerate(others):
                up = above[n + 1]
                if up > best:
                    best = up
                if tag == tag2:
                    if leaf and leaf2:
                        gain = above[n] + 1.0 + (name == name2) + (text == text2)
                    elif a.keys[x] == b.keys[y]:
                        gain = above[n] + 3.0 * a.sizes[x]
                    else:
                        gain = above[n] + weights[x, y][0]
                    if gain > best:
                        best = gain
                row.append(best)
            table.append(row)
        total += table[-1][-1]
        m, n = len(left), len(right)
        while m and n:
            if table[m][n] == table[m - 1][n]:
                m -= 1
            elif table[m][n] == table[m][n - 1]:
                n -= 1
            else:
                m, n = m - 1, n - 1
                pairs.append((left[m], right[n]))
        return total, pairs

    asked = [(0, 0)]
    while asked:  # children before parents, by a stack of our own, as pages may be nested deeply
        i, j = pair = asked[-1]
        if pair in weights:
            asked.pop()
        elif pair in plans:
            weights[pair] = weigh(i, j)
        else:
            _, left, right = plans[pair] = _trimmed(a, b, a.kids[i], b.kids[j])
            spent += len(left) * len(right)
            if len(left) * len(right) > CELLS or spent > ALL_CELLS:
                return _match_by_levels(a, b)
            asked += [(x, y) for x in left for y in right
                      if a.nodes[x].tag == b.nodes[y].tag and (a.kids[x] or b.kids[y])
                      and a.keys[x] != b.keys[y] and (x, y) not in weights]
    matched, todo = {}, [(0, 0)]
    while todo:
        i, j = todo.pop()
        matched[i] = j
        todo += weights[i, j][1] if (i, j) in weights else zip(a.kids[i], b.kids[j])
    return matched
