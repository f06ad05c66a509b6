"""URL splitting, canonical form, fingerprints and reference resolution as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcorpus.functions.text import let
from webcorpus.settings import ARTICLE_URL_PATTERN, TRACKING_PARAMS

# Schemes whose URLs have an authority part, and schemes that allow relative links.
AUTHORITY_SCHEMES = [
    "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https", "shttp",
    "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp", "nfs",
    "git", "git+ssh", "ws", "wss", "itms-services",
]
RELATIVE_SCHEMES = [
    "", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms",
    "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss",
]

# A web URL that is its own canonical form.
_CANONICAL = r"^https?://[a-z0-9.:\-]+/[^?#\x00-\x20]*\z"


def _clean(url: Column) -> Column:
    # Leading control characters and blanks, and line breaks anywhere, are not part of a URL.
    return F.when(url.rlike(r"[\x00-\x20]"), F.regexp_replace(
        url, r"^[\x00-\x20]+|[\t\r\n]", "")).otherwise(url)


def _after(text: Column, head: Column) -> Column:
    """What follows `head` and one separator in `text`; '' when nothing does."""
    return F.substr(text, F.length(head) + 2)


def split_url(url: Column) -> Column:
    """Struct of scheme (lower case), netloc, path, query and fragment; '' where absent."""
    def parts(scheme: Column, rest: Column, head: Column, place: Column, netloc: Column) -> Column:
        path = F.when(netloc.isNull(), place).otherwise(F.substr(place, F.length(netloc) + 3))
        return F.struct(
            F.lower(scheme).alias("scheme"), F.coalesce(netloc, F.lit("")).alias("netloc"),
            path.alias("path"), _after(head, place).alias("query"),
            _after(rest, head).alias("fragment"))

    def cut(scheme: Column, rest: Column) -> Column:
        # Up to '#', of that up to '?', and of that, after '//', up to '/'.
        return let(F.substring_index(rest, "#", 1), lambda head: let(
            F.substring_index(head, "?", 1), lambda place: let(
                F.when(place.startswith("//"),
                       F.substring_index(F.substr(place, F.lit(3)), "/", 1)),
                lambda netloc: parts(scheme, rest, head, place, netloc))))

    return let(_clean(url), lambda u: let(
        F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1), lambda scheme: let(
            F.when(scheme == "", u).otherwise(_after(u, scheme)), lambda rest: cut(scheme, rest))))


def _one_of(scheme: Column, schemes: list[str]) -> Column:
    names = "|".join(name.replace("+", r"\+") for name in schemes)
    return scheme.rlike(rf"^(?:{names})\z")


def _join(scheme: Column, netloc: Column, path: Column, query: Column, fragment: Column) -> Column:
    rooted = F.when((netloc != "") & (path != "") & ~path.startswith("/"),
                    F.concat(F.lit("/"), path)).otherwise(path)
    bare_authority = path.startswith("//") | (
        _one_of(scheme, AUTHORITY_SCHEMES) & ((path == "") | path.startswith("/")))
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(netloc != "", F.concat(F.lit("//"), netloc))
         .when(bare_authority, F.lit("//")).otherwise(""),
        rooted,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )


def _form_decode(text: Column) -> Column:
    # A percent sign that starts no escape stands for itself.
    return F.try_url_decode(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"))


def _form_encode(text: Column) -> Column:
    encoded = F.url_encode(text)
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _canonical_query(query: Column) -> Column:
    def name(pair: Column) -> Column:
        return _form_decode(F.substring_index(pair, "=", 1))

    def value(pair: Column) -> Column:
        return _form_decode(F.regexp_extract(pair, r"(?s)^[^=]*=(.*)\z", 1))

    # Pairs without a value carry nothing; tracking names are compared after decoding.
    pairs = F.filter(F.split(query, "&"),
                     lambda p: p.rlike(r"(?s)=.") & ~name(p).isin(TRACKING_PARAMS))
    kept = F.transform(pairs, lambda p: F.concat(
        _form_encode(name(p)), F.lit("="), _form_encode(value(p))))
    return F.when(query == "", F.lit("")).otherwise(F.array_join(kept, "&"))


def normalized_url(url: Column) -> Column:
    """Canonical spelling: host part in lower case, no fragment, no tracking parameters."""
    general = let(split_url(url), lambda p: _join(
        p["scheme"], F.lower(p["netloc"]),
        F.when(p["path"] == "", F.lit("/")).otherwise(p["path"]),
        _canonical_query(p["query"]), F.lit("")))
    return F.when(url.rlike(_CANONICAL), url).otherwise(general)


def fingerprint(url: Column) -> Column:
    return F.sha1(normalized_url(url))


def scheme_of(url: Column) -> Column:
    web = F.regexp_extract(url, r"^(https?):", 1)
    return let(web, lambda w: F.when(w != "", w).otherwise(split_url(url)["scheme"]))


def _host_of_netloc(netloc: Column) -> Column:
    place = F.regexp_extract(netloc, r"([^@]*)\z", 1)
    return F.lower(let(place, lambda p: F.when(
        p.contains("["), F.regexp_extract(p, r"\[([^\]]*)", 1),
    ).otherwise(F.substring_index(p, ":", 1))))


def host_of(url: Column) -> Column:
    """Host name without user info and port, in lower case; '' when there is none."""
    plain = F.regexp_extract(url, r"^https?://([a-z0-9.\-]+)(?::[0-9]*)?(?:[/?#]|\z)", 1)
    netloc = F.regexp_extract(_clean(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    return let(plain, lambda h: F.when(h != "", h).otherwise(_host_of_netloc(netloc)))


def domain_of(url: Column) -> Column:
    """What stands between '//' and the next '/', untouched (port and case stay)."""
    return F.split_part(F.split_part(url, F.lit("//"), F.lit(2)), F.lit("/"), F.lit(1))


def in_domain(host: Column, domain: str) -> Column:
    return (host == domain) | host.endswith("." + domain)


def is_article_url(url: Column) -> Column:
    return url.rlike(ARTICLE_URL_PATTERN)


def _walk_dots(path: Column, relative: Column) -> Column:
    def walk(segments: Column) -> Column:
        last = F.size(segments) - 1
        tidy = F.when(relative, F.filter(
            segments, lambda s, i: (i == 0) | (i == last) | (s != ""))).otherwise(segments)
        kept = F.aggregate(
            tidy, F.array().cast("array<string>"),
            lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
                             .when(s == ".", done)
                             .otherwise(F.concat(done, F.array(s))))
        tail = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))) \
                .otherwise(F.array().cast("array<string>"))
        return F.array_join(F.concat(kept, tail), "/")

    walked = let(F.split(path, "/"), walk)
    return F.when(walked == "", F.lit("/")).otherwise(walked)


def _resolve_parts(base: Column, href: Column, b: Column, h: Column) -> Column:
    scheme = F.when(h["scheme"] == "", b["scheme"]).otherwise(h["scheme"])
    foreign = (scheme != b["scheme"]) | ~_one_of(scheme, RELATIVE_SCHEMES)

    # Parameters of the last segment take no part in the walk; an empty list of them is dropped.
    params = F.regexp_extract(h["path"], r";([^/]*)\z", 1)
    params = F.when(params != "", F.concat(F.lit(";"), params)).otherwise("")
    core = F.regexp_replace(h["path"], r";[^/]*\z", "")
    base_path = F.regexp_replace(b["path"], r";\z", "")
    folder = F.when(b["path"] == "", F.lit("/")) \
              .otherwise(F.regexp_replace(F.regexp_replace(b["path"], r";[^/]*\z", ""), r"[^/]*\z", ""))
    relative = ~core.startswith("/")
    merged = F.when(relative, F.concat(folder, core)).otherwise(core)
    needs_walk = merged.rlike(r"(?:^|/)\.\.?(?:/|\z)") | (relative & merged.contains("//"))
    path = F.when(needs_walk, _walk_dots(merged, relative)).otherwise(merged)
    query = F.when(h["query"] != "", h["query"]).otherwise(b["query"])

    def target(netloc: Column, path: Column, query: Column) -> Column:
        return F.struct(netloc.alias("netloc"), path.alias("path"), query.alias("query"))

    chosen = (
        F.when(h["netloc"] != "", target(h["netloc"], F.concat(core, params), h["query"]))
         .when((core == "") & (params == ""), target(b["netloc"], base_path, query))
         .otherwise(target(b["netloc"], F.concat(path, params), h["query"]))
    )
    return F.when(href == "", base).when(foreign, href).otherwise(let(
        chosen, lambda t: _join(scheme, t["netloc"], t["path"], t["query"], h["fragment"])))


def resolve(base: Column, href: Column) -> Column:
    """The absolute URL that `href` means on the page `base`."""
    # Nearly all links are plain absolute paths or plain web URLs: settle those with one match each.
    origin = F.regexp_extract(base, r"^(https?://[^/?#\x00-\x20]+)", 1)
    plain_path = href.rlike(r"^/(?!/)[^?#;\x00-\x20]*\z") & ~href.contains("/.")
    plain_url = href.rlike(r"^https?://[^/?#;\x00-\x20]+(?:/[^?#;\x00-\x20]*)?\z")
    return (
        F.when((origin != "") & plain_path, F.concat(origin, href))
         .when((origin != "") & plain_url, href)
         .otherwise(let(
             F.struct(split_url(base).alias("b"), split_url(href).alias("h")),
             lambda p: _resolve_parts(base, href, p["b"], p["h"])))
    )
