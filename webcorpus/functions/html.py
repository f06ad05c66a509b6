"""Markup to links, text, title and date, as column expressions over a page's HTML."""

from __future__ import annotations

from functools import cache
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcorpus.functions.text import BLANK, let, or_empty, strip


# Functions of a value that are used often or are long, as SQL text: it is parsed once, where a Python
# expression would be put together anew at every use.

def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _map(values: dict[str, str]) -> str:
    """A map of texts. Two texts that are split are read much faster than its many entries."""
    def array(texts) -> str:
        return f"split({_quoted(chr(31).join(texts))}, '{chr(31)}')"

    return f"map_from_arrays({array(values)}, {array(values.values())})"


def _bound(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


@cache
def _lambda(sql: str) -> Column:
    return F.expr(sql)


def _applied(function: str, value: Column) -> Column:
    """`function`, the text of a lambda, of a value."""
    return F.element_at(F.call_function("transform", F.array(value), _lambda(function)), 1)


def _decoder(end: str) -> str:
    """The text of a lambda that decodes character references; `end` is what ends them, as a pattern.

    Names with a semicolon are looked for among those of HTML 4 first, as a map is searched from its
    start; those that older pages may write without one, longest first. Numbers 128 to 159 are read as
    Windows-1252 where that has a character; controls and what is no character are ''.
    """
    known = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}
    often = {name: known.pop(name) for name in [*name2codepoint, "apos"]}
    windows = {str(code): bytes([code]).decode("cp1252", "ignore") or chr(code) for code in range(128, 160)}
    opened = {name: char for name, char in html5.items() if not name.endswith(";")}
    character = f"""CASE WHEN c = 0 OR c > 1114111 OR c BETWEEN 55296 AND 57343 THEN '\ufffd'
        WHEN c BETWEEN 128 AND 159 THEN element_at({_map(windows)}, CAST(c AS STRING))
        WHEN c BETWEEN 1 AND 8 OR c = 11 OR c BETWEEN 14 AND 31 OR c = 127 OR c BETWEEN 64976 AND 65007
          OR c % 65536 >= 65534 THEN ''
        ELSE decode(unhex(lpad(hex(c), 8, '0')), 'UTF-32') END"""
    digits = f"regexp_extract(p, '^#([0-9]+|[xX][0-9A-Fa-f]+){end}', 1)"
    code = "CAST(IF(d RLIKE '^[xX]', conv(substring(d, 2, 8), 16, 10), nullif(substring(d, 1, 9), '')) AS BIGINT)"
    rest = f"regexp_replace(p, '^#(?:[0-9]+|[xX][0-9A-Fa-f]+){end}', '')"
    numbered = _bound(f"regexp_replace({digits}, '^([xX]?)0+(?=.)', '$1')", "d",
                      _bound(code, "c", f"concat({character}, {rest})"))
    named = _bound("regexp_extract(p, '^([A-Za-z][A-Za-z0-9]{0,31});', 1)", "n",
                   f"concat(coalesce(element_at({_map(often)}, n), element_at({_map(known)}, n)), substr(p, length(n) + 2))")
    choices = [f"IF(startswith(p, '#'), {numbered}, {named})"]
    if end == ";?":
        names = "|".join(sorted(opened, key=len, reverse=True))
        choices.append(_bound(f"regexp_extract(p, '^(?:{names})', 0)", "o",
                              f"concat(element_at({_map(opened)}, o), substr(p, length(o) + 1))"))
    decoded = f"IF(p RLIKE '^[#A-Za-z]', coalesce({', '.join(choices)}, concat('&', p)), concat('&', p))"
    return "t -> " + _bound("split(t, '&')", "s", "IF(size(s) = 1, s[0], concat(s[0], array_join("
                            f"transform(slice(s, 2, size(s)), p -> {decoded}), '')))")


_DECODED, _DECODED_STRICT = _decoder(";?"), _decoder(";")

# Tags that start or end a block of text, and tags that hold no article text.
BLOCK_TAGS = ("p|div|section|article|main|body|br|hr|ul|ol|dl|dt|dd|table|tbody|thead|tr|td|th|"
              "blockquote|pre|figure|figcaption|h[1-6]|li|address|details|summary")
ASIDE_TAGS = ["nav", "header", "footer", "aside", "form"]

# Names under which a page states its date of publication.
DATE_NAMES = ("article:published_time|datePublished|og:published_time|pubdate|publishdate|"
              "publish_date|publish-date|date|dc.date|dc.date.issued|dcterms.date")

# The rest of a tag up to its end: a quote that opens a value hides what stands inside it. Possessive
# throughout, so that broken pages are read once.
_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_END = r"(?:>|\z)"  # a tag that is never closed runs to the end of the page
_TAG = rf"<[A-Za-z/!?]{_REST}{_END}"

# Attributes before an href, which need no blank behind a quoted value, and the href itself.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
_OTHERS = rf"(?:[\s/]++|(?!href(?![^\s=>/]))[^\s>/][^\s=>/]*+(?:\s*+=\s*+{_VALUE})?+)*+"
# Any other tag is stepped over, so that a link inside an attribute is none.
_HREF = rf"(?is)<a(?=[\s/]){_OTHERS}href\s*+=\s*+({_VALUE}){_REST}|{_TAG}"


def _hidden(tags: str) -> str:
    """Comments and whole elements of `tags`; other tags are kept as group 2, with what they quote.

    An unclosed comment or element runs to the end of the page, as in a browser; this also keeps the
    match linear on broken pages.
    """
    return (rf"(?is)<!--.*?(?:-->|\z)|<({tags})\b{_REST}{_END}.*?(?:</\1\s*>|\z)"
            rf"|({_TAG})")


def visible(html: Column) -> Column:
    """The page without comments, scripts, styles and what stands in for scripts."""
    return F.regexp_replace(html, _hidden("script|style|noscript"), "$2")


def linking(html: Column) -> Column:
    """The page with all markup that may hold links: without comments, scripts and styles."""
    return F.regexp_replace(html, _hidden("script|style"), "$2")


def decode_entities(text: Column, strict: bool = False) -> Column:
    """Character references replaced by what they stand for, each once, left to right.

    The names are those of HTML 5. `strict` asks for the semicolon, as in addresses, where `&copy=1` is
    a parameter.
    """
    return _applied(_DECODED_STRICT if strict else _DECODED, text)


def hrefs(markup: Column) -> Column:
    """All link targets of `<a>` tags, in page order, as an array."""
    raw = F.filter(F.regexp_extract_all(markup, F.lit(_HREF), F.lit(1)), lambda h: h != "")
    return F.transform(raw, lambda h: decode_entities(
        F.regexp_replace(h, r"""^["']|["']\z""", ""), strict=True))


def _first(markup: Column, opening: str, rest: str) -> Column:
    """Array of what `rest` captures after the first match of `opening`, if any.

    Anchored and atomic, and an opening without an end runs to the end of the page: a page full of
    them is still read once.
    """
    return F.regexp_extract_all(
        markup, F.lit(rf"(?is)\A(?>.*?{opening}){rest}"), F.lit(1))


def _element(markup: Column, tag: str) -> Column:
    """What follows the first opening tag, up to the last closing tag; NULL when there is none."""
    return F.get(_first(markup, rf"<{tag}\b{_REST}{_END}", rf"(.*</{tag}\s*>)"), 0)


def _without_asides(text: Column) -> Column:
    """Drop every aside element, tag by tag, from its opening to the first closing of its name.

    One linear rule for texts of every length. A closing tag counts wherever it stands, also quoted.
    """
    def cut(t: Column, tag: str) -> Column:
        # Cut behind every closing tag; what a piece holds from its first opening tag on, goes.
        pieces = F.split(F.regexp_replace(t, rf"(?i)</{tag}\s+>", f"</{tag}>"), rf"(?i)(?<=</{tag}>)")
        opened = rf"(?is)\A(?>(.*?)<{tag}\b{_REST}{_END}).*</{tag}>\z"
        return F.array_join(F.transform(pieces, lambda p: F.regexp_replace(p, opened, "$1")), "")

    for tag in ASIDE_TAGS:
        text = cut(text, tag)
    return text


# Marks inside a text: a block begins, the text of a link begins and ends. Pages may not hold them.
_BLOCK_MARK, _LINK, _LINK_END = "\x02", "\x03", "\x04"
# What a block costs, in letters: a run of blocks pays for what is short or linked between its parts.
BLOCK_COST = 60
_WIDE = r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]"


def _letters(text: Column) -> Column:
    """Length without blanks; a character of a script without spaces says as much as three letters."""
    bare = F.regexp_replace(text, r"(?U)\s+", "")
    return F.length(bare) + 2 * F.regexp_count(bare, F.lit(_WIDE))


def _links_in_blocks(text: Column) -> Column:
    """Links that go on over several blocks end and begin again at each of them."""
    def inside(piece: Column) -> Column:
        link = F.when(piece.contains(_LINK_END), F.substring_index(piece, _LINK_END, 1)) \
            .otherwise(F.substring_index(piece, _BLOCK_MARK, 1))  # never closed: to the block's end
        return F.concat(F.lit(_LINK), F.replace(link, F.lit(_BLOCK_MARK), F.lit(_LINK_END + _BLOCK_MARK + _LINK)),
                        F.lit(_LINK_END), F.substr(piece, F.length(link) + 1))

    def split(pieces: Column) -> Column:
        return F.concat(pieces[0], F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), inside), ""))

    return let(F.split(text, _LINK), split)


def _best_run(scores: Column) -> Column:
    """(first, last) of the consecutive scores with the largest sum, counted from 1; the earliest end and
    the fewest scores among equals; last = 0 if no sum is above zero."""
    def state(best, first, last, total, start, at):
        return F.struct(best.alias("best"), first.alias("first"), last.alias("last"),
                        total.alias("total"), start.alias("start"), at.alias("at"))

    def step(a: Column, score: Column) -> Column:
        total = a["total"] + score
        better = total > a["best"]
        return state(F.when(better, total).otherwise(a["best"]), F.when(better, a["start"]).otherwise(a["first"]),
                     F.when(better, a["at"]).otherwise(a["last"]), F.greatest(total, F.lit(0)),
                     F.when(total > 0, a["start"]).otherwise(a["at"] + 1), a["at"] + 1)

    zero, one = F.lit(0), F.lit(1)
    return F.aggregate(scores, state(zero, one, zero, zero, one, one), step)


def _content(text: Column) -> Column:
    """The article of a text with marks: the run of blocks that says most for what it costs.

    A block scores its letters, less twice those of its links, less BLOCK_COST. Headings right before
    the run belong to it, blocks of links inside it do not. Where no run pays, all but links stay. Blocks
    without letters score nothing and only keep their lines.
    """
    def measured(block: Column) -> Column:
        said = F.regexp_replace(block, r"(?U)^[\s#-]+|[\x03\x04]", "")
        linked = F.array_join(F.regexp_extract_all(block, F.lit("\x03([^\x04]*)\x04"), F.lit(1)), "")
        return F.struct(block.alias("text"), _letters(said).alias("letters"), _letters(linked).alias("linked"),
                        block.rlike(r"(?U)^\s*(?:#{1,6} |\z)").alias("heading"))

    def chosen(blocks: Column) -> Column:
        scores = F.transform(blocks, lambda b: F.when(b["letters"] == 0, 0).otherwise(
            b["letters"] - 2 * b["linked"] - BLOCK_COST))

        def pick(run: Column) -> Column:
            heads = F.transform(F.sequence(F.lit(1), F.greatest(run["first"] - 1, F.lit(1))), lambda k: F.when(
                k < run["first"], F.get(blocks, run["first"] - 1 - k)["heading"]).otherwise(False))
            before = F.coalesce(F.nullif(F.array_position(heads, False), F.lit(0)) - 1, F.size(heads)).cast("int")
            run_of = F.slice(blocks, run["first"] - before, run["last"] - run["first"] + 1 + before)
            kept = F.when(run["last"] == 0, blocks).otherwise(run_of)
            return F.array_join(F.transform(F.filter(kept, lambda b: 2 * b["linked"] <= b["letters"]),
                                            lambda b: b["text"]), "")

        return let(_best_run(scores), pick)

    parts = F.transform(F.split(_links_in_blocks(text), _BLOCK_MARK), measured)
    return F.translate(let(parts, chosen), _LINK + _LINK_END, "")


def _formatted(text: Column) -> Column:
    """Tags to Markdown and characters, with a mark before each block and item.

    A mark before a tag that may open a link stays if it has an address, and goes with it otherwise.
    """
    text = F.regexp_replace(text, rf"(?i)<h([1-6])\b{_REST}{_END}", f"{_BLOCK_MARK}\n\n\x01$1")
    for level in range(1, 7):
        text = F.replace(text, F.lit(f"\x01{level}"), F.lit("#" * level + " "))
    text = F.regexp_replace(text, rf"(?i)<li\b{_REST}{_END}", f"{_BLOCK_MARK}\n- ")
    text = F.regexp_replace(text, rf"(?i)</?(?:{BLOCK_TAGS})\b{_REST}{_END}", f"{_BLOCK_MARK}\n\n")
    address = rf"<a(?=[\s/]){_OTHERS}href(?![^\s=>/]){_REST}{_END}"
    return decode_entities(F.regexp_replace(text, rf"(?is)({_LINK}){address}|{_LINK}?{_TAG}", "$1"))


def _marks_of_links(text: Column) -> Column:
    text = F.regexp_replace(text, r"(?i)(<a[\s/])", f"{_LINK}$1")
    return F.regexp_replace(text, r"(?i)</a\s*>", _LINK_END)


def markdown(markup: Column) -> Column:
    """Main text of visible markup as Markdown: of `<article>`, else `<main>`, else what reads like one."""
    own = F.coalesce(_element(markup, "article"), _element(markup, "main"))
    whole = F.coalesce(_element(markup, "body"), markup)

    def told(marked: Column) -> Column:
        """Whether there is an article, and the text with marks of blocks, else of links as well."""
        inner = _without_asides(F.regexp_replace(F.coalesce(marked, whole), "[\x01-\x04]", ""))
        linked = let(inner, lambda i: F.when(marked.isNull(), _marks_of_links(i)).otherwise(i))
        return F.struct(marked.isNotNull().alias("own"), _formatted(linked).alias("text"))

    text = let(let(own, told), lambda t: F.when(t["own"], F.replace(t["text"], F.lit(_BLOCK_MARK)))
               .otherwise(_content(t["text"])))
    # Patterns that match little are much cheaper than one that matches every blank.
    text = F.regexp_replace(text, r"[\t\r\f\x0b\u00a0]", " ")
    text = F.regexp_replace(text, r" {2,}", " ")
    text = F.replace(F.replace(text, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return F.trim(text, F.lit("\n "))


def _plain(fragment: Column) -> Column:
    bare = decode_entities(F.regexp_replace(fragment, _TAG, ""))
    return strip(F.regexp_replace(bare, r"(?U)\s+", " "))


# Keys under which an object of JSON-LD holds further objects, and how deep these are followed.
LD_INSIDE = ["@graph", "mainEntity", "mainEntityOfPage", "itemListElement", "item", "hasPart"]
LD_DEPTH = 3
# Types of objects that are articles.
LD_ARTICLES = ["Article", "NewsArticle", "BlogPosting", "ReportageNewsArticle", "AnalysisNewsArticle",
               "OpinionNewsArticle", "LiveBlogPosting", "SocialMediaPosting", "TechArticle", "ScholarlyArticle",
               "WebPage"]


def _linked() -> str:
    """The text of a lambda from a page to what its JSON-LD states."""
    opening = rf"<script\b{_REST}{_END}"
    every = _quoted(rf"(?is)<!--.*?(?:-->|\z)|{opening}.*?(?:</script\s*>|\z)")
    typed = _quoted(r"(?is)\A<script\b[^>]*application/ld\+json")
    around = _quoted(rf"(?is)\A{opening}|</script\s*>\z")
    scripts = (f"transform(filter(regexp_extract_all(h, {every}, 0), s -> s RLIKE {typed}), "
               f"s -> regexp_replace(s, {around}, ''))")

    def listed(v: str) -> str:
        """A variant's elements if it is an array, else itself alone."""
        return f"IF(startswith(schema_of_variant({v}), 'ARRAY'), try_variant_get({v}, '$', 'array<variant>'), array({v}))"

    def text(*names: str) -> str:
        said = [_bound(f"try_variant_get(v, '$.{name}', 'variant')", "w", "IF(schema_of_variant(w) = 'STRING', nullif("
                       f"regexp_replace(try_variant_get(w, '$', 'string'), {_quoted(f'(?U)^{BLANK}+|{BLANK}+' + chr(92) + 'z')}, ''), ''), NULL)")
                for name in names]
        return f"coalesce({', '.join(said)})"

    keys = ", ".join(f"""try_variant_get(v, "$['{key}']", 'variant')""" for key in LD_INSIDE)
    inside = f"flatten(transform(filter(array({keys}), w -> w IS NOT NULL), w -> {listed('w')}))"
    kind = """try_variant_get(v, "$['@type']", '{}')"""
    kinds = f"coalesce({kind.format('array<string>')}, array({kind.format('string')}))"
    articles = f"array({', '.join(map(_quoted, LD_ARTICLES))})"
    described = (f"v -> named_struct('article', coalesce(arrays_overlap({kinds}, {articles}), false), "
                 f"'headline', {text('headline', 'name')}, 'published', {text('datePublished', 'dateCreated')})")
    body = f"transform(concat({', '.join(f'l{k}' for k in range(LD_DEPTH + 1))}), {described})"
    for k in range(LD_DEPTH, 0, -1):
        body = _bound(f"flatten(transform(l{k - 1}, v -> {inside}))", f"l{k}", body)
    parsed = f"filter(transform({scripts}, s -> try_parse_json(s)), v -> v IS NOT NULL)"
    body = _bound(f"flatten(transform({parsed}, v -> {listed('v')}))", "l0", body)
    nothing = "CAST(array() AS array<struct<article:boolean,headline:string,published:string>>)"
    return f"h -> IF(contains(h, 'ld+json'), {body}, {nothing})"


_LINKED = _linked()


def linked_data(html: Column) -> Column:
    """(article, headline, published) of the objects in a page's JSON-LD, outer ones first; an array.

    Scripts that hold no JSON are passed over. Objects may come alone, in arrays, and inside the keys
    of LD_INSIDE, LD_DEPTH levels deep.
    """
    return _applied(_LINKED, html)


def _of_linked(found: Column | None, field: str) -> Column:
    """The field of the first article that has it, else of the first object; NULL without."""
    if found is None:
        return F.lit(None).cast("string")
    having = F.filter(found, lambda x: x[field].isNotNull())
    return let(having, lambda h: F.coalesce(F.get(F.filter(h, lambda x: x["article"]), 0)[field], F.get(h, 0)[field]))


def title(markup: Column, linked: Column | None = None) -> Column:
    """`<title>`, else the first `<h1>`, else the headline that `linked` data state, else ''."""
    def inner(tag: str) -> Column:
        return F.get(_first(markup, rf"<{tag}\b{_REST}{_END}", rf"(.*?)</{tag}\s*>"), 0)

    said = F.transform(F.array(inner("title"), inner("h1"), _of_linked(linked, "headline")), lambda t: _plain(or_empty(t)))
    return or_empty(F.get(F.filter(said, lambda t: t != ""), 0))


def published(markup: Column, linked: Column | None = None) -> Column:
    """Date of publication as the page spells it: meta tag, else linked data, else `<time>`, else ''."""
    value = r"""\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""
    tags = F.regexp_extract_all(markup, F.lit(rf"(?is)<meta\s{_REST}{_END}"), F.lit(0))
    named = F.filter(tags, lambda t: t.rlike(
        rf"""(?is)\b(?:property|name|itemprop)\s*=\s*["']?(?:{DATE_NAMES})["'\s/>]"""))
    dates = F.transform(named, lambda t: F.regexp_extract(t, rf"(?is)\bcontent{value}", 1))
    time = F.regexp_extract(markup, rf"(?is)<time\b[^<>]*\bdatetime{value}", 1)
    said = F.transform(F.concat(dates, F.array(or_empty(_of_linked(linked, "published")), time)), lambda d: strip(
        decode_entities(F.regexp_replace(d, r"""^["']|["']\z""", ""))))
    return or_empty(F.get(F.filter(said, lambda d: d != ""), 0))
