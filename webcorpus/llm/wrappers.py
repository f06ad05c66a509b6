"""Main text of pages by wrapper induction.

Pages of a host are aligned with each other by simple tree matching. An element whose text is the
same on the pages it is aligned with belongs to the host's template; a slot whose text varies holds
content. Marked parts (menus, headers, footers, sidebars, notices, adverts, forms, comments) go
wherever they vary too, and a marked article bounds what can be content.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import map_batches, partitions
from webcorpus.llm.dom import INLINE, Node, Tree, match, parse
from webcorpus.operators.joins import lookup
from webcorpus.session import written

# Different pages of a group, partners that a page is aligned with, and the share that must agree.
GROUP, PARTNERS = 8, 4
AGREE_OUTSIDE, AGREE_INSIDE = 0.5, 1.0
# Pages of a bucket of a host that has more than one of them.
BUCKET = 64
# Elements that hold no main text, and words in classes, ids and roles that say so.
ASIDE_TAGS = frozenset("head script style noscript template nav header footer aside form button select "
                       "input textarea iframe svg canvas object embed audio video dialog menu "
                       "title".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment "
    "comments disqus replies reply cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription share sharing social related recommended widget "
    "toolbar pagination pager login signup search complementary contentinfo".split())
MAIN_WORDS = frozenset("article content entry main post story".split())
# Elements that are never dropped for their class: they hold everything.
_WHOLE = frozenset(["html", "body", "main"])
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _words(value: str) -> set[str]:
    return {w.lower() for w in _PIECES.findall(value)}


def is_aside(node: Node) -> bool:
    """Whether an element's tag, class, id, role or style says that it holds no main text."""
    if node.tag in ASIDE_TAGS:
        return True
    at = node.attributes
    if not at or node.tag in _WHOLE:
        return False
    if "hidden" in at or at.get("aria-hidden") == "true" or re.search(
            r"display\s*:\s*none|visibility\s*:\s*hidden", at.get("style", "")):
        return True
    words = _words(" ".join(at.get(k, "") for k in ("class", "id", "role")))
    if words & MAIN_WORDS:
        words -= {"header"}  # the head of an article holds its title
    return bool(words & ASIDE_WORDS)


def _is_main(node: Node) -> bool:
    return node.tag in ("article", "main") or node.attributes.get("role") in ("main", "article")


def _named_main(node: Node) -> bool:
    return bool(_words(" ".join(node.attributes.get(k, "") for k in ("class", "id"))) & MAIN_WORDS)


class Page:
    """A parsed page without its marked parts."""

    def __init__(self, page: str) -> None:
        self.root = parse(page)
        self.tree = Tree(self.root, is_aside)
        self.same = hash(tuple(self.tree.texts))

    def _inside(self) -> set[int] | None:
        """Elements in the marked articles, else in the elements named like one; None without."""
        for marked in (_is_main, _named_main):
            inside: set[int] = set()
            for k, node in enumerate(self.tree.nodes):
                if k in inside or marked(node):
                    inside.add(k)
                    inside.update(self.tree.kids[k])
            if inside and any(self.tree.texts[k] for k in inside):
                return inside
        return None

    def constant(self, partners: list[Page], known: dict[tuple[int, int], dict[int, int]]) -> dict[int, float]:
        """Share of the partners that have the same text in the slot of an element.

        Partners are the first PARTNERS of the given pages that are no copies.
        `known` keeps the matchings of a group, each of which serves both of its pages.
        """
        seen, counts = {self.same}, {}
        for other in partners:
            if len(seen) > PARTNERS:
                break
            if other.same in seen:
                continue  # copies of an article say nothing about its template
            seen.add(other.same)
            back = known.get((id(other), id(self)))
            if back is None:
                pairs = known[id(self), id(other)] = {
                    i: j for i, j in match(self.tree, other.tree).items()
                    if self.tree.texts[i] and self.tree.texts[i] == other.tree.texts[j]}
            for i in (pairs if back is None else back.values()):
                counts[i] = counts.get(i, 0) + 1
        return {i: n / (len(seen) - 1) for i, n in counts.items()}

    def text(self, shares: dict[int, float]) -> str:
        """Texts of the varying slots, in page order; `shares` as `constant` gives them."""
        inside = self._inside()
        number = {id(node): k for k, node in enumerate(self.tree.nodes)}
        out: list[str] = []
        todo: list = [self.root]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                out.append(item)
                continue
            k = number.get(id(item))
            if k is None:
                continue  # a marked part
            block = item.tag not in INLINE
            template = shares.get(k, 0) >= (AGREE_OUTSIDE if inside is None else AGREE_INSIDE)
            content = (inside is None or k in inside) and not template
            if block:
                out.append(" ")
                todo.append(" ")
            todo += [c for c in reversed(item.children) if isinstance(c, Node) or content]
        return " ".join("".join(out).split())


def texts_of(pages: list[str], known_host: bool = True) -> list[str]:
    """Main texts of a group of pages of one host, each aligned with the next ones in the round."""
    different = list(dict.fromkeys(pages))
    parsed = [Page(p) for p in different]
    known: dict = {}
    texts = {html: page.text(page.constant(parsed[k + 1:] + parsed[:k] if known_host else [], known))
             for k, (html, page) in enumerate(zip(different, parsed))}
    return [texts[html] for html in pages]


def groups(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Consecutive rows with the same key (first field), with GROUP to 2 * GROUP - 1 different pages
    (last field) where the key has so many; copies share the text of their page."""
    held: list[tuple] = []
    different: dict = {}
    for row in rows:
        if held and held[0][0] != row[0]:
            yield held
            held, different = [], {}
        held.append((*row[:-1], different.setdefault(row[-1], row[-1])))
        if len(different) == 2 * GROUP:
            first = set(list(different)[:GROUP])
            yield [r for r in held if r[-1] in first]
            held = [r for r in held if r[-1] not in first]
            different = {r[-1]: r[-1] for r in held}
    if held:
        yield held


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every page, repeated rows included.

    Pages are dealt by host; a host with two buckets or more in buckets of about 64 pages, by the hash of
    the page, so that one with a third of all pages is spread over many tasks. A task aligns the
    pages of a host or bucket in the order of their hashes, in groups of 8 to 15 different ones, so the
    groups depend on the pages of the host alone: not on partitions, nor on other hosts. Pages with no
    host in their url are dealt by their hash and read by their marks alone; pages that are alone on
    their host or have only copies beside them are read by their marks, too. Null html is empty; empty
    pages have an empty text, no pages none. Pages of any length are parsed in one pass. Null ids and
    urls stay, ids of any type. Other columns are not read.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    sizes = written(pages.select(host.alias("host")).filter("host <> ''").groupBy("host").agg(
        F.floor(F.count("*") / BUCKET).alias("buckets")).filter("buckets > 1"), "hosts")
    place = F.xxhash64("page_id", "html")
    keyed = lookup(pages.select(F.nullif(host, F.lit("")).alias("host"), "page_id", "url", "html"), sizes, "host")
    pieces = F.when(F.col("host").isNull(), F.lit(1 << 16)).otherwise(F.col("buckets"))  # a host has no slash
    keyed = keyed.select(F.concat_ws("/", F.coalesce("host", F.lit("/")), F.pmod(place, pieces)).alias("key"),
                         "page_id", "url", F.col("host").isNotNull().alias("known"), "html")
    dealt = keyed.repartition(partitions(pages), "key").sortWithinPartitions("key", place)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
            kinds[:] = [batch.schema.field("page_id").type]
            for k in range(0, batch.num_rows, 64):
                for *row, page in zip(*[c.to_pylist() for c in batch.slice(k, 64).columns]):
                    yield *row, page or ""

        rows = (row for b in batches for row in rows_of(b))
        made = ((page_id, url, text) for group in groups(rows) for (_, page_id, url, *_), text in zip(
            group, texts_of([html for *_, html in group], group[0][3])))
        while part := list(islice(made, 256)):
            ids, urls, texts = zip(*part)
            yield pa.RecordBatch.from_pydict({
                "page_id": pa.array(ids, kinds[0]), "url": pa.array(urls, pa.string()),
                "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_batches(dealt, task, f"page_id {kind}, url string, text string, n_chars long")
