"""The same results in ANSI-style SQL for DuckDB, written from the definitions, not the Spark code."""

from __future__ import annotations

from webcorpus.functions.addresses import IPV4_BLOCKED, IPV4_PUBLIC
from webcorpus.plans.fixtures import AS_OF, EDGE_ADDRESSES, OWN_RANGES

# ---- URL expressions ----------------------------------------------------------------------------

_SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?"


def _scheme(u: str) -> str:
    return rf"lower(regexp_extract({u}, '^\s*([A-Za-z][A-Za-z0-9+.\-]*):', 1))"


def _netloc(u: str) -> str:
    return rf"regexp_extract(ltrim({u}), '{_SCHEME}//([^/?#]*)', 1)"


def _host(u: str) -> str:
    return rf"lower(regexp_extract({_netloc(u)}, '^(?:[^@]*@)?([^:]*)', 1))"


def _norm(u: str) -> str:
    path = rf"regexp_extract({u}, '{_SCHEME}(?://[^/?#]*)?([^?#]*)', 1)"
    query = rf"regexp_extract({u}, '^[^?#]*\?([^#]*)', 1)"

    def decoded(x: str) -> str:
        return f"url_decode(replace({x}, '+', ' '))"

    def encoded(x: str) -> str:
        return f"replace(url_encode({x}), '%20', '+')"

    name = decoded("split_part(p, '=', 1)")
    value = decoded("substr(p, strpos(p, '=') + 1)")
    kept = (f"array_to_string(list_transform(list_filter(string_split({query}, '&'), "
            f"lambda p: regexp_matches(p, '=.') AND {name} NOT IN ('utm_source', 'utm_medium', "
            f"'utm_campaign', 'utm_term', 'utm_content')), "
            f"lambda p: {encoded(name)} || '=' || {encoded(value)}), '&')")
    return (f"({_scheme(u)} || '://' || lower({_netloc(u)}) || "
            f"CASE WHEN {path} = '' THEN '/' ELSE {path} END || "
            f"CASE WHEN {kept} = '' THEN '' ELSE '?' || {kept} END)")


def _domain(u: str) -> str:
    return f"split_part(split_part({u}, '//', 2), '/', 1)"


def _absolute(base: str, href: str) -> str:
    return (f"CASE WHEN regexp_matches({href}, '^[a-z]+:') THEN {href} "
            f"ELSE regexp_extract({base}, '^[a-z]+://[^/?#]*') || {href} END")


_ARTICLE = r"'/\d{4}/\d{2}/\d+\.shtml?$'"
_HREF = r"""'(?is)<a\s(?:[^<>]*?\s)?href\s*=\s*"([^"]*)"'"""

# ---- page expressions ---------------------------------------------------------------------------


def _sub(text: str, pattern: str, to: str = "''") -> str:
    return f"regexp_replace({text}, '{pattern}', {to}, 'g')"


def _visible(html: str) -> str:
    out = _sub(html, r"(?is)<!--.*?(?:-->|\z)")
    for tag in ("script", "style", "noscript"):
        out = _sub(out, rf"(?is)<{tag}\b[^>]*>.*?(?:</{tag}\s*>|\z)")
    return out


# Character references that occur in the tables.
_REFERENCES = {"lt": "<", "gt": ">", "quot": '"', "nbsp": "\u00a0", "copy": "©", "middot": "·",
               "uuml": "ü", "eacute": "é", "rarr": "→"}

# Elements that stand on lines of their own.
_BLOCKS = ("address|article|blockquote|body|br|dd|details|div|dl|dt|figcaption|figure|h1|h2|h3|h4|h5|h6|"
           "hr|li|main|ol|p|pre|section|summary|table|tbody|td|th|thead|tr|ul")

# The end of a tag: what stands in a quoted value is no part of the markup.
_TO_END = r"""(?:[^>=]|=\s*"[^"]*"|=\s*''[^'']*''|=)*(?:>|\z)"""


def _entities(text: str) -> str:
    for name, char in _REFERENCES.items():  # the ampersand last, so that nothing is decoded twice
        quoted = char.replace("'", "''")
        text = f"replace({text}, '&{name};', '{quoted}')"
    return f"replace({text}, '&amp;', '&')"


def _bare(out: str, mark: str = "") -> str:
    """Blocks and items on lines of their own, behind `mark`; no other tags; characters for references."""
    for level in range(1, 7):
        out = _sub(out, rf"(?i)<h{level}\b[^>]*(?:>|\z)", f"'{mark}' || chr(10) || chr(10) || '{'#' * level} '")
    out = _sub(out, r"(?i)<li\b[^>]*(?:>|\z)", f"'{mark}' || chr(10) || '- '")
    out = _sub(out, rf"(?i)</?(?:{_BLOCKS})\b[^>]*(?:>|\z)", f"'{mark}' || chr(10) || chr(10)")
    return _entities(_sub(out, rf"<[A-Za-z/!?]{_TO_END}"))


def _without_asides(out: str) -> str:
    for tag in ("nav", "header", "footer", "aside", "form"):
        out = _sub(out, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>")
    return out


def _spaced(out: str) -> str:
    out = _sub(out, r"[ \t\r\f\v\x{a0}]+", "' '")
    out = _sub(_sub(out, r" ?\n ?", "chr(10)"), r"\n{3,}", "chr(10) || chr(10)")
    return f"trim({out}, chr(10) || ' ')"


def _element(markup: str, tag: str) -> str:
    return rf"nullif(regexp_extract({markup}, '(?is)<{tag}\b[^>]*>.*</{tag}\s*>'), '')"


def _markdown(markup: str) -> str:
    out = f"coalesce({_element(markup, 'article')}, {_element(markup, 'main')}, {_element(markup, 'body')}, {markup})"
    return _spaced(_bare(_without_asides(out)))


_SPACE = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WIDE = r"[^\x{3040}-\x{30ff}\x{3400}-\x{9fff}\x{ac00}-\x{d7af}]"


def _letters(text: str) -> str:
    return f"(length({_sub(text, _SPACE)}) + 2 * length({_sub(text, _WIDE)}))"


def _runs(pages: str) -> str:
    """Texts of pages that mark no article, from (page_id, markup): the best run of their blocks."""
    body = _without_asides(f"coalesce({_element('markup', 'body')}, markup)")
    linked = _sub(_sub(body, r"(?i)<a\s[^>]*\bhref[^>]*>", "chr(3)"), r"(?i)</a\s*>", "chr(4)")
    said = _sub("block", rf"^(?:{_SPACE}|[#-])+|[\x03\x04]")
    return rf"""cut AS (SELECT page_id, unnest(string_split(t, chr(2))) AS block, generate_subscripts(string_split(t, chr(2)), 1) AS k
  FROM (SELECT page_id, {_bare(linked, chr(2))} AS t FROM {pages})),
sized AS (SELECT page_id, block, k AS pos, {_letters(said)} AS n, regexp_matches(block, '^{_SPACE}*(?:#{{1,6}} |\z)') AS heading,
  {_letters(r"array_to_string(regexp_extract_all(block, '\x03([^\x04]*)\x04', 1), '')")} AS linked FROM cut),
sums AS (SELECT *, sum(CASE WHEN n = 0 THEN 0 ELSE n - 2 * linked - 60 END) OVER (PARTITION BY page_id ORDER BY pos) AS s FROM sized),
lows AS (SELECT *, least(0, coalesce(min(s) OVER (PARTITION BY page_id ORDER BY pos
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low FROM sums),
ends AS (SELECT page_id, arg_min(pos, (-(s - low), pos)) AS last, max(s - low) AS best, arg_min(low, (-(s - low), pos)) AS low
  FROM lows GROUP BY page_id),
begins AS (SELECT e.page_id, e.last, e.best, 1 + coalesce(max(pos) FILTER (s = e.low AND pos < last), 0) AS first
  FROM ends e JOIN sums USING (page_id) GROUP BY ALL),
headed AS (SELECT b.page_id, b.best, b.last, 1 + coalesce(max(pos) FILTER (NOT heading AND pos < first), 0) AS first
  FROM begins b JOIN sums USING (page_id) GROUP BY b.page_id, b.best, b.last),
joined AS (SELECT page_id, string_agg(translate(block, chr(3) || chr(4), ''), '' ORDER BY pos)
    FILTER (2 * linked <= n AND (best <= 0 OR pos BETWEEN first AND last)) AS t
  FROM sums JOIN headed USING (page_id) GROUP BY page_id),
runs AS (SELECT page_id, {_spaced("coalesce(t, '')")} AS content_md FROM {pages} LEFT JOIN joined USING (page_id))"""


_BLANK = "' '"


def _title(markup: str) -> str:
    def plain(tag: str) -> str:
        inner = rf"regexp_extract({markup}, '(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>', 1)"
        bare = _entities(_sub(inner, r"<[A-Za-z/!?][^>]*(?:>|\z)"))
        return f"trim({_sub(bare, '[[:space:]]+', to=_BLANK)})"
    return f"coalesce(nullif({plain('title')}, ''), {plain('h1')})"


def _published(markup: str) -> str:
    meta = rf"""regexp_extract({markup}, '(?is)<meta\s[^>]*article:published_time[^>]*\scontent="([^"]*)"', 1)"""
    time = rf"""regexp_extract({markup}, '(?is)<time\b[^>]*\sdatetime="([^"]*)"', 1)"""
    return f"trim(coalesce(nullif({meta}, ''), {time}))"


# ---- inputs -------------------------------------------------------------------------------------

_D1 = r"""d1b AS (SELECT doc_id,
  CASE WHEN doc_id % 31 = 0 THEN 'http://' || source || '.example.com/other/weather_error_404.html'
       ELSE 'http://' || source || '.example.com/2024/' || lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0')
            || '/' || doc_id || '.shtml' END AS url,
  CASE WHEN doc_id % 13 = 0 THEN '' WHEN doc_id % 17 = 0 THEN substr(text, 1, 20) || '-生活'
       WHEN doc_id % 19 = 0 THEN substr(text, 1, 20) || '-图片频道'
       WHEN doc_id % 23 = 0 THEN '视频' || substr(text, 1, 20)
       ELSE substr(text, 1, 20) || '-资讯' END AS title,
  CASE WHEN doc_id % 29 = 0 THEN text || chr(10) || '热门城市' ELSE text END AS content_md,
  TIMESTAMP '2024-01-01' + to_minutes(doc_id * 619) AS crawled_at FROM documents),
d1 AS (SELECT doc_id + 1 AS id, url, sha1(url) AS url_fp, title,
  CASE WHEN doc_id % 5 = 0 THEN '' ELSE strftime(crawled_at, '%Y-%m-%d') END AS published,
  content_md, sha1(content_md) AS content_fp, crawled_at FROM d1b)"""

_REASON = """CASE
  WHEN title LIKE '%图片频道%' OR title LIKE '%视频%' OR title LIKE '%直播%' OR title LIKE '%专题%'
    OR title LIKE '%-生活' OR title LIKE '%-图片频道' THEN 'title'
  WHEN url LIKE '%error%' THEN 'error'
  WHEN length(content_md) < 300 THEN 'short'
  WHEN content_md LIKE '%热门城市%' OR content_md LIKE '%热门景点%' OR content_md LIKE '%选择省市%'
    OR content_md LIKE '%选择洲际%' OR content_md LIKE '%周边城市%' OR content_md LIKE '%周边景点%'
    OR content_md LIKE '%本地乡镇%' OR content_md LIKE '%返回 全国%' THEN 'nav' END"""

_STORE_COLUMNS = """id, url, url_fp, title, published, length(content_md) AS content_len, content_fp,
  strftime(crawled_at, '%Y-%m-%d %H:%M:%S') AS crawled_at"""

_D2 = rf"""n AS (SELECT count(*) AS n FROM pages),
d2 AS (SELECT page_id, 'http://news.example.com/2024/01/' || page_id || '.shtml' AS url,
  'Grün → café ' || url || ' ' || url || ' ' || url || ' ' || url AS body, ['/2024/01/' || ((page_id * 7 + 1) % n) || '.shtml',
  '/2024/01/' || ((page_id * 3 + 2) % n) || '.shtml', '/2024/01/' || ((page_id + 5) % n) || '.shtml',
  'http://news.example.com/2024/01/' || ((page_id * 7 + 1) % n) || '.shtml',
  '/2024/01/error/9.shtml', '/list/', 'http://evil.example.org/2024/01/417.shtml'] AS hrefs
  FROM pages, n),
d2_links AS (SELECT page_id, url, {_absolute('url', 'href')} AS abs_url
  FROM (SELECT page_id, url, unnest(hrefs) AS href FROM d2))"""

_EDGES = _D2 + rf""",
edges AS (SELECT DISTINCT url AS src, abs_url AS dst FROM d2_links
  WHERE regexp_matches(abs_url, {_ARTICLE}) AND abs_url NOT LIKE '%error%'
    AND abs_url LIKE 'http://news.example.com/%'),
l0 AS (SELECT url FROM d2 WHERE page_id % 50 = 0),
l1 AS (SELECT DISTINCT dst AS url FROM edges JOIN l0 ON src = url
  WHERE dst NOT IN (SELECT url FROM l0)),
l2 AS (SELECT DISTINCT dst AS url FROM edges JOIN l1 ON src = url
  WHERE dst NOT IN (SELECT url FROM l0) AND dst NOT IN (SELECT url FROM l1)),
frontier AS (SELECT url, sha1(url) AS url_fp, CAST(0 AS BIGINT) AS depth FROM l0
  UNION ALL SELECT url, sha1(url), 1 FROM l1 UNION ALL SELECT url, sha1(url), 2 FROM l2)"""

_D8 = rf"""d8_bare AS (SELECT page_id, url, replace(replace(
    regexp_replace(html, '<(/?)(?:article|main|nav|footer)>', '<\1div>', 'g'), '</title>', ' &hellip ☆’</title>'),
    '</h1>', ' It’s ’ ✓{{ © 2020 café¬it;</h1>') AS html FROM pages),
d8 AS (SELECT page_id, url, {_visible("CASE WHEN page_id % 5 = 0 THEN regexp_replace(regexp_replace(html, "
    "'(?s)<title>.*?</title>', ''), '<(/?)h1>', '<\\1h2>', 'g') ELSE html END")} AS markup,
  '2024-' || lpad(CAST(page_id % 12 + 1 AS VARCHAR), 2, '0') || '-03T08:00:00Z' AS published FROM d8_bare),
{_runs('d8')},
d8_texts AS (SELECT page_id, url, published, content_md,
  CASE WHEN page_id % 5 = 0 THEN 'Headline № ' || page_id ELSE {_title('markup')} END AS title
  FROM d8 JOIN runs USING (page_id))"""

_D3 = """last AS (SELECT conv_id, max(turn) // 3 + 1 AS last_page FROM conversations GROUP BY conv_id),
own AS (SELECT conv_id, turn, role, text, turn // 3 + 1 AS page FROM conversations),
both_pages AS (SELECT * FROM own UNION ALL
  SELECT o.conv_id, turn, role, text, page + 1 FROM own o JOIN last l ON o.conv_id = l.conv_id
  WHERE turn % 3 = 2 AND page + 1 <= last_page),
d3 AS (SELECT CAST(conv_id AS VARCHAR) AS post, page,
  row_number() OVER (PARTITION BY conv_id, page ORDER BY turn) - 1 AS pos,
  CAST(conv_id * 1000 + turn AS VARCHAR) AS id, role AS screen_name, role || '客户端' AS region, text
  FROM both_pages),
d3_pages AS (SELECT post, page, CASE WHEN page = last_page THEN 0 ELSE page END AS max_id
  FROM (SELECT DISTINCT post, page FROM d3) JOIN last ON post = CAST(conv_id AS VARCHAR)),
d3_known AS (SELECT CAST(conv_id * 1000 + turn AS VARCHAR) AS id FROM conversations
  WHERE turn = 0 AND conv_id % 5 = 0),
d3_new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY post, page, pos) AS rn
  FROM d3) WHERE rn = 1 AND id NOT IN (SELECT id FROM d3_known)),
d3_log AS (SELECT d3.post, d3.page, count(*) AS n_rows, count(n.id) AS n_new
  FROM d3 LEFT JOIN d3_new n ON d3.post = n.post AND d3.page = n.page AND d3.pos = n.pos
  GROUP BY d3.post, d3.page
  UNION ALL SELECT CAST(conv_id AS VARCHAR), 99, 0, 0 FROM conversations WHERE turn = 0 AND conv_id % 3 = 0
  UNION ALL SELECT 'empty-' || conv_id, 1, 0, 0 FROM conversations WHERE turn = 0 AND conv_id % 3 = 0)"""

_D4 = """d4 AS (SELECT event_id AS seq, md5(CAST(event_id AS VARCHAR)) AS id, 'article' AS spider,
  CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'running' ELSE 'finished' END AS state,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS start_time,
  strftime(ts + to_seconds(CAST(floor(value) AS BIGINT)), '%Y-%m-%d %H:%M:%S.%f') AS end_time, value
  FROM events),
d4_brief AS (SELECT seq, state, substr(id, 1, 8) AS id, spider, substr(start_time, 1, 19) AS start_time,
  substr(end_time, 1, 19) AS end_time FROM d4)"""

_D5 = """d5 AS (SELECT c_custkey, 'h' || c_custkey || '.example.com' AS host,
  CASE WHEN c_custkey % 10 <> 0 THEN (c_custkey % 256) || '.' || ((c_custkey * 37) % 256) || '.'
    || ((c_custkey * 11) % 256) || '.' || (c_custkey % 254 + 1) END AS ip,
  '  ' || CASE WHEN c_custkey % 7 = 0 THEN 'ftp' ELSE 'http' END || '://H' || c_custkey
    || '.EXAMPLE.COM:8080/x' AS url, c_custkey % 7 <> 0 AS web, c_custkey % 3 <> 0 AS allowed
  FROM customer)"""

_IP = ("(CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536"
       " + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT))")
_BLOCKED = f"""({_IP} < 16777216 OR ip LIKE '10.%' OR ip LIKE '127.%' OR ip LIKE '169.254.%'
  OR {_IP} BETWEEN 2886729728 AND 2887778303
  OR (ip LIKE '192.0.0.%' AND ip NOT IN ('192.0.0.9', '192.0.0.10')) OR ip LIKE '192.0.2.%'
  OR ip LIKE '192.168.%' OR ip LIKE '198.18.%' OR ip LIKE '198.19.%' OR ip LIKE '198.51.100.%'
  OR ip LIKE '203.0.113.%' OR {_IP} >= 3758096384)"""

_D6 = """d6 AS (SELECT event_id // 6 * 3 + CASE WHEN event_id % 6 = 0 THEN 0 WHEN event_id % 6 <= 2 THEN 1
    ELSE 2 END AS k,
  event_id % 6 - CASE WHEN event_id % 6 = 0 THEN 0 WHEN event_id % 6 <= 2 THEN 1 ELSE 3 END + 1 AS attempt,
  CASE event_type WHEN 'error' THEN [429, 403, 500, 502, 503, 504][event_id // 2 % 6 + 1]
    WHEN 'view' THEN 404 ELSE CAST(200 AS BIGINT) END AS status FROM events),
d6_url AS (SELECT 'http://h' || (k % 50) || '.example.com/' || k AS url, attempt, status FROM d6)"""

_D7 = f"""d7 AS (SELECT page_id, url FROM pages UNION ALL
  SELECT page_id + (SELECT count(*) FROM pages), url || '#frag' FROM pages WHERE page_id % 4 = 0),
d7_fp AS (SELECT page_id, url, {_norm('url')} AS norm_url, sha1({_norm('url')}) AS url_fp FROM d7),
d7_known AS (SELECT sha1({_norm('url')}) AS url_fp FROM pages WHERE page_id % 10 = 0)"""

_MARKED = f"marked AS (SELECT page_id, url, {_visible('html')} AS markup FROM pages)"
_LINKS = f"""{_MARKED},
hrefs AS (SELECT page_id, url, unnest(regexp_extract_all(markup, {_HREF}, 1)) AS raw FROM marked),
decoded AS (SELECT page_id, url, {_entities('raw')} AS href FROM hrefs)"""
_ARTICLES = f"""{_MARKED},
texts AS (SELECT page_id, url, {_title('markup')} AS title, {_published('markup')} AS published,
  {_markdown('markup')} AS content_md FROM marked),
made AS (SELECT page_id, url, sha1({_norm('url')}) AS url_fp, title, published, content_md,
  sha1(content_md) AS content_fp FROM texts WHERE length(content_md) >= 50),
good AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content_fp ORDER BY page_id) AS rn
  FROM made WHERE {_REASON} IS NULL) WHERE rn = 1)"""
_HOSTS = f"hosts AS (SELECT page_id, url, {_host('url')} AS host FROM pages)"
_KNOWN = f"""{_D1}, known AS (SELECT * FROM d1 WHERE id % 37 = 0),
incoming AS (SELECT * FROM d1 WHERE id % 37 <> 0)"""
_HALF = f"""{_D1}, half AS (SELECT count(*) // 2 AS h FROM d1),
target AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content_fp ORDER BY id) AS rn
  FROM d1, half WHERE id <= h) WHERE rn = 1),
fresh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content_fp ORDER BY id) AS rn
  FROM d1, half WHERE id > h AND content_fp NOT IN (SELECT content_fp FROM target)) WHERE rn = 1),
numbered AS (SELECT * EXCLUDE (id), id AS arrival,
  (SELECT max(id) FROM target) + row_number() OVER (ORDER BY id) AS id FROM fresh)"""
_TOP = f"""top AS (SELECT {_domain('url')} AS name, count(*) AS value FROM d1
  GROUP BY 1 ORDER BY value DESC, name LIMIT 10)"""
_TREND = "trend AS (SELECT strftime(crawled_at, '%m-%d') AS date, count(*) AS count FROM d1 GROUP BY 1)"
_TOTALS = (f"totals AS (SELECT count(*) AS total, count(*) FILTER (WHERE CAST(crawled_at AS DATE) = "
           f"DATE '{AS_OF}') AS today FROM d1)")
_LIST = """id, CASE WHEN title = '' THEN '(无标题)' ELSE title END AS title, url,
  CASE WHEN published = '' THEN '-' ELSE published END AS published"""
_JSON = """'{"url":' || to_json(url) || ',"url_fp":' || to_json(url_fp) || ',"title":' || to_json(title)
  || ',"published":' || to_json(published) || ',"content_fp":' || to_json(content_fp) || '}'"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes} {body}"


def all_sql() -> dict[str, str]:
    edges = ", ".join(f"('edge-{ip}', '{ip}')" for ip in EDGE_ADDRESSES)
    fixed = [("0.0.0.0/0", False), *[(c, True) for c in IPV4_BLOCKED], *[(f"{ip}/32", False) for ip in IPV4_PUBLIC]]
    ranges = ", ".join(f"('{cidr}', {blocked})" for cidr, blocked in fixed + OWN_RANGES)
    progress = """SELECT post, arg_max(max_id, page) AS max_id, max(page) AS page,
      arg_max(max_id, page) = 0 AS done FROM d3_pages"""
    return {
        # sources and sinks
        "seeds_source": """SELECT url || '  # entry' AS url FROM pages
          WHERE page_id % 5 <> 0 AND page_id % 7 <> 0""",
        "seed_override": "SELECT arg_min(url, page_id) AS url FROM pages",
        "host_list": _with(_HOSTS, """SELECT DISTINCT unnest([host, 'www.' || host]) AS host
          FROM hosts"""),
        "pages_source": """SELECT page_id, url, length(html) AS html_len, sha1(html) AS html_fp
          FROM pages""",
        "articles_source": _with(_D1, f"SELECT {_STORE_COLUMNS} FROM d1"),
        "articles_ddl": _with(_D1, f"SELECT {_STORE_COLUMNS} FROM d1"),
        "articles_sink": _with(_D1, """SELECT count(DISTINCT content_fp) AS stored,
          count(DISTINCT content_fp) AS contents, count(DISTINCT content_fp) AS last_id,
          count(DISTINCT content_fp) AS inserted, CAST(0 AS BIGINT) AS inserted_again FROM d1"""),
        "articles_sink_runs": _with(f"""{_D1}, loads AS (
            SELECT *, 1 AS load FROM d1 WHERE id % 3 <> 0 UNION ALL SELECT *, 2 FROM d1 WHERE id % 60 = 0
            UNION ALL SELECT *, 3 FROM d1 WHERE id % 3 = 0 OR id % 100 = 1),
          won AS (SELECT *, row_number() OVER (PARTITION BY content_fp ORDER BY load, id) AS rn FROM loads),
          numbered AS (SELECT * EXCLUDE (id), row_number() OVER (ORDER BY load, id) AS id FROM won WHERE rn = 1)""",
            f"SELECT {_STORE_COLUMNS} FROM numbered"),
        "message_sink": _with(_D1, f"SELECT {_JSON} AS value FROM d1"),
        "message_source": _with(_D1, "SELECT url, url_fp, title, published, content_fp FROM d1"),
        "comments_csv_sink": _with(_D3, "SELECT DISTINCT id, screen_name, region, text FROM d3"),
        "seen_comment_ids": _with(_D3, "SELECT DISTINCT id FROM d3"),
        "comment_pages_source": _with(_D3, """SELECT p.post, p.page, count(*) AS comments,
          any_value(max_id) AS max_id FROM d3_pages p JOIN d3 ON p.post = d3.post AND p.page = d3.page
          GROUP BY p.post, p.page"""),
        "progress_store": _with(_D3, f"{progress} GROUP BY post"),
        # projections
        "normalize_urls": _with(_D7, "SELECT page_id, url, norm_url FROM d7_fp"),
        "url_fingerprints": _with(_D7, "SELECT page_id, url_fp FROM d7_fp"),
        "url_parts": _with(_D7, f"SELECT page_id, {_scheme('url')} AS scheme, {_host('url')} AS host FROM d7"),
        "url_domain": _with(_D7, f"SELECT page_id, {_domain('url')} AS domain FROM d7"),
        "extract_links": _with(_LINKS, "SELECT page_id, url, href FROM decoded"),
        "resolve_links": _with(_LINKS, f"""SELECT page_id, url, href,
          {_absolute('url', 'href')} AS abs_url FROM decoded"""),
        "extract_text": _with(_MARKED, f"SELECT page_id, {_markdown('markup')} AS content_md FROM marked"),
        "extract_metadata": _with(_MARKED, f"""SELECT page_id, {_title('markup')} AS title,
          {_published('markup')} AS published FROM marked"""),
        "build_articles": _with(_ARTICLES, """SELECT page_id, url, url_fp, title, published, content_md,
          content_fp FROM made"""),
        "extract_text_unmarked": _with(_D8, "SELECT page_id, content_md FROM d8_texts"),
        "extract_metadata_linked": _with(_D8, "SELECT page_id, title, published FROM d8_texts"),
        "build_articles_unmarked": _with(_D8, f"""SELECT page_id, url, sha1({_norm('url')}) AS url_fp, title,
          published, content_md, sha1(content_md) AS content_fp FROM d8_texts WHERE length(content_md) >= 50"""),
        "article_messages": _with(_D1, f"SELECT content_fp AS key, {_JSON} AS value FROM d1"),
        "article_rows": _with(_D1, f"""SELECT {_LIST}, length(content_md) AS content_len,
          strftime(crawled_at, '%Y-%m-%d %H:%M') AS crawled_at FROM d1"""),
        "article_detail": _with(_D1, f"""SELECT {_LIST}, content_md,
          strftime(crawled_at, '%Y-%m-%d %H:%M') AS crawled_at FROM d1 WHERE id = 14"""),
        "flatten_comments": _with(_D3, "SELECT post, page, pos, id, screen_name, region, text FROM d3"),
        "next_page_token": _with(_D3, "SELECT post, page, max_id AS next_max_id FROM d3_pages"),
        "job_briefs": _with(_D4, "SELECT * FROM d4_brief"),
        "elapsed_mmss": """WITH s AS (SELECT event_id AS seq,
            CAST(floor(value * 60 + event_id % 60) AS BIGINT) AS s FROM events)
          SELECT seq, printf('%02d:%02d', s // 60, s % 60) AS elapsed FROM s""",
        "content_length_meta": _with(_D1, "SELECT id, length(content_md) AS content_len FROM d1"),
        # filters
        "filter_scheme": _with(_D5, "SELECT c_custkey, url FROM d5 WHERE web"),
        "filter_hosts": _with(f"{_D7}, {_HOSTS}", f"""SELECT page_id, url FROM d7 WHERE {_host('url')} IN
          (SELECT host FROM hosts WHERE page_id % 3 = 0)"""),
        "filter_domain_suffix": _with(_D7, f"""SELECT page_id, url FROM d7
          WHERE {_host('url')} = 'example.com' OR {_host('url')} LIKE '%.example.com'"""),
        "filter_blocked_ips": _with(f"""{_D5}, a AS (SELECT host, ip FROM d5 WHERE ip IS NOT NULL
          UNION ALL SELECT * FROM (VALUES {edges}))""", f"SELECT host, ip FROM a WHERE NOT {_BLOCKED}"),
        "filter_blocked_ips_table": _with(f"""{_D5}, a AS (SELECT host, ip FROM d5 WHERE ip IS NOT NULL
            UNION ALL SELECT * FROM (VALUES {edges})),
          r AS (SELECT split_part(cidr, '/', 1) AS ip, 1::BIGINT << (32 - split_part(cidr, '/', 2)::INT) AS size, blocked
            FROM (VALUES {ranges}) AS v(cidr, blocked)),
          bounds AS (SELECT {_IP} // size * size AS low, size, bool_or(blocked) AS blocked FROM r GROUP BY ALL),
          judged AS (SELECT host, ip, arg_min(blocked, size) AS blocked
            FROM (SELECT *, {_IP} AS n FROM a) JOIN bounds ON n >= low AND n < low + size GROUP BY host, ip)""",
            "SELECT host, ip FROM judged WHERE NOT blocked"),
        "admission": _with(_D5, f"""SELECT c_custkey, CASE WHEN NOT web THEN 'scheme'
          WHEN NOT allowed THEN 'host' WHEN ip IS NULL THEN 'unresolved' WHEN {_BLOCKED} THEN 'ip'
          ELSE '' END AS reject_reason FROM d5"""),
        "seed_admission": _with(_D5, """SELECT c_custkey, trim(url) AS url,
          CASE WHEN NOT web THEN 'scheme' WHEN NOT allowed THEN 'host' ELSE '' END AS reject_reason
          FROM d5"""),
        "article_url_filter": _with(_D2, f"""SELECT page_id, abs_url FROM d2_links
          WHERE regexp_matches(abs_url, {_ARTICLE})"""),
        "error_link_filter": _with(_D2, """SELECT page_id, abs_url FROM d2_links
          WHERE abs_url NOT LIKE '%error%'"""),
        "page_link_distinct": _with(_D2, "SELECT DISTINCT page_id, abs_url FROM d2_links"),
        "min_article_chars": _with(f"""{_MARKED}, {_D2}, t AS (
          SELECT page_id, url, {_markdown('markup')} AS content_md FROM marked UNION ALL
          SELECT page_id, url, body FROM d2 WHERE page_id % 2 = 0)""",
            "SELECT page_id, url, length(content_md) AS content_len FROM t WHERE length(content_md) >= 50"),
        "quality_title": _with(_D1, """SELECT id FROM d1 WHERE regexp_matches(title,
          '图片频道|视频|直播|专题|-生活$|-图片频道$')"""),
        "quality_error_url": _with(_D1, "SELECT id FROM d1 WHERE url LIKE '%error%'"),
        "quality_min_chars": _with(_D1, "SELECT id FROM d1 WHERE length(content_md) < 300"),
        "quality_nav": _with(_D1, """SELECT id FROM d1 WHERE regexp_matches(content_md,
          '热门城市|热门景点|选择省市|选择洲际|周边城市|周边景点|本地乡镇|返回 全国')"""),
        "quality_filter": _with(_D1, f"SELECT id, content_fp FROM d1 WHERE {_REASON} IS NULL"),
        # joins, dedupe, upsert
        "host_semi_join": _with(_HOSTS, """SELECT page_id, url, host FROM hosts
          WHERE host IN (SELECT host FROM hosts WHERE page_id % 3 = 0)"""),
        "resolve_hosts": _with(_D5, "SELECT c_custkey, host, ip FROM d5"),
        "unseen_urls": _with(_D7, """SELECT page_id, url, url_fp FROM (SELECT *,
          row_number() OVER (PARTITION BY url_fp ORDER BY page_id) AS rn FROM d7_fp)
          WHERE rn = 1 AND url_fp NOT IN (SELECT url_fp FROM d7_known)"""),
        "content_dedupe": _with(_KNOWN, """SELECT id, url, content_fp FROM (SELECT *,
          row_number() OVER (PARTITION BY content_fp ORDER BY id) AS rn FROM incoming)
          WHERE rn = 1 AND content_fp NOT IN (SELECT content_fp FROM known)"""),
        "comment_dedupe": _with(_D3, "SELECT post, page, id FROM d3_new"),
        "fulltext_lookup": _with(_D1, """SELECT url_fp, content_fp, url, title, published, content_md
          FROM (SELECT *, row_number() OVER (PARTITION BY content_fp ORDER BY id) AS rn FROM d1)
          WHERE rn = 1"""),
        "fulltext_lookup_stream": _with(_D1, """SELECT url_fp, content_fp, url, title, published, content_md
          FROM (SELECT *, row_number() OVER (PARTITION BY content_fp ORDER BY id) AS rn FROM d1)
          WHERE rn = 1"""),
        "pending_posts": _with(_D3, """, p AS (SELECT post, arg_max(max_id, page) AS max_id,
            max(page) AS page FROM d3_pages WHERE page <= 2 GROUP BY post)
          SELECT post, max_id, page FROM p WHERE max_id <> 0
          UNION ALL SELECT '-1', 0, 0"""),
        "insert_if_absent": _with(_HALF, f"SELECT {_STORE_COLUMNS} FROM numbered"),
        "rank_duplicates": _with(_KNOWN, """SELECT content_fp, rejected FROM (
          SELECT content_fp, count(*) - CASE WHEN content_fp IN (SELECT content_fp FROM known)
            THEN 0 ELSE 1 END AS rejected FROM incoming GROUP BY content_fp) WHERE rejected > 0"""),
        # aggregations
        "article_totals": _with(f"{_D1}, {_TOTALS}", "SELECT * FROM totals"),
        "domain_top10": _with(f"{_D1}, {_TOP}", "SELECT * FROM top"),
        "domain_top10_pages": _with(_ARTICLES, f"""SELECT {_domain('url')} AS name, count(*) AS value
          FROM good GROUP BY 1 ORDER BY value DESC, name LIMIT 10"""),
        "daily_trend": _with(f"{_D1}, {_TREND}", "SELECT * FROM trend"),
        "kpi_cards": _with(f"{_D1}, {_TOTALS}, {_TOP}, {_TREND}", """SELECT total, today,
          (SELECT count(*) FROM top) AS domains, (SELECT max(count) FROM trend) AS peak_day
          FROM totals"""),
        "domain_share": _with(f"{_D1}, {_TOP}", """SELECT name, value,
          round(100.0 * value / (SELECT sum(value) FROM top), 4) AS share FROM top"""),
        "quality_drop_stats": _with(_D1, f"""SELECT drop_reason, count(*) AS dropped
          FROM (SELECT {_REASON} AS drop_reason FROM d1) WHERE drop_reason IS NOT NULL
          GROUP BY drop_reason"""),
        "ingest_run_stats": _with(f"""{_KNOWN}, tagged AS (SELECT *, {_REASON} AS r FROM incoming),
          ins AS (SELECT count(DISTINCT content_fp) AS n FROM tagged WHERE r IS NULL
            AND content_fp NOT IN (SELECT content_fp FROM known))""",
            """SELECT count(*) FILTER (WHERE r IS NOT NULL) AS dropped,
            count(*) FILTER (WHERE r IS NULL) - any_value(n) AS duplicate,
            any_value(n) AS inserted, any_value(n) AS sent FROM tagged, ins"""),
        "ingest_run_observed": _with(f"""{_KNOWN}, tagged AS (SELECT *, {_REASON} AS r FROM incoming),
          ins AS (SELECT count(DISTINCT content_fp) AS n FROM tagged WHERE r IS NULL
            AND content_fp NOT IN (SELECT content_fp FROM known))""",
            """SELECT count(*) FILTER (WHERE r IS NOT NULL) AS dropped,
            count(*) FILTER (WHERE r IS NULL) - any_value(n) AS duplicate,
            any_value(n) AS inserted, any_value(n) AS sent FROM tagged, ins"""),
        "fingerprint_sketches": _with(_D1, """SELECT count(DISTINCT url_fp) AS urls, count(DISTINCT content_fp) AS contents,
          true AS urls_close, true AS contents_close FROM d1"""),
        "fingerprint_cardinality": _with(_D1, """SELECT count(DISTINCT url_fp) AS urls,
          count(DISTINCT content_fp) AS contents FROM d1"""),
        "comment_page_totals": _with(_D3, """SELECT post, CAST(sum(n_rows) AS BIGINT) AS comments,
          CAST(sum(n_new) AS BIGINT) AS new_comments FROM d3_log GROUP BY post"""),
        "comment_progress": _with(_D3, f"{progress} GROUP BY post"),
        "article_count": _with(_D1, "SELECT count(*) AS total FROM d1"),
        "seen_count": _with(_D3, "SELECT count(DISTINCT id) AS seen FROM d3"),
        # sequences
        "first_wins": _with(_D1, "SELECT min(id) AS id, content_fp FROM d1 GROUP BY content_fp"),
        "comment_page_log": _with(_D3, """SELECT post, page, n_rows, n_new, CAST(sum(n_new)
          OVER (PARTITION BY post ORDER BY page) AS BIGINT) AS total FROM d3_log"""),
        "assign_ids": _with(_HALF, "SELECT arrival, id FROM numbered"),
        # sort, limit, frontier
        "article_page": _with(_D1, f"""SELECT {_LIST}, length(content_md) AS content_len,
          strftime(crawled_at, '%Y-%m-%d %H:%M') AS crawled_at FROM d1
          ORDER BY id DESC LIMIT 20 OFFSET 20"""),
        "article_page_deep": _with(_D1, f"""SELECT {_LIST}, length(content_md) AS content_len,
          strftime(crawled_at, '%Y-%m-%d %H:%M') AS crawled_at
          FROM (SELECT *, row_number() OVER (ORDER BY id DESC) AS rn, count(*) OVER () // 7 * 9 // 10 AS page FROM d1)
          WHERE rn > (page - 1) * 7 AND rn <= page * 7"""),
        "recent_jobs": _with(_D4, """SELECT * FROM d4_brief WHERE state <> 'finished' UNION ALL
          SELECT * FROM (SELECT * FROM d4_brief WHERE state = 'finished' ORDER BY seq DESC LIMIT 5)"""),
        "link_graph": _with(_D2, f"""SELECT DISTINCT sha1(d2.url) AS src_fp, abs_url AS url, sha1(abs_url) AS url_fp
          FROM d2 LEFT JOIN (SELECT * FROM d2_links WHERE regexp_matches(abs_url, {_ARTICLE})
            AND abs_url NOT LIKE '%error%') l ON d2.page_id = l.page_id"""),
        "crawl_frontier": _with(_EDGES, "SELECT url, url_fp, depth FROM frontier"),
        "frontier_budget": _with(_EDGES, """, ranked AS (SELECT f.*, d2.page_id % 2 = 0 AS item,
            row_number() OVER (ORDER BY depth, url_fp) AS rn FROM frontier f JOIN d2 ON f.url = d2.url),
          counted AS (SELECT *, coalesce(sum(CAST(item AS INT)) OVER (ORDER BY rn
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM ranked WHERE rn <= 5)
          SELECT url, url_fp, depth FROM counted WHERE done < 3"""),
        "follow_links_switch": _with(_EDGES, "SELECT url, url_fp, depth FROM frontier WHERE depth = 0"),
        "page_cap": _with(_D3, f"{progress} WHERE page <= 2 GROUP BY post"),
        "frontier_host_cap": _with(_HOSTS, """SELECT page_id, url, host FROM (SELECT *,
          row_number() OVER (PARTITION BY host ORDER BY page_id) AS rn FROM hosts) WHERE rn <= 2"""),
        "retry_candidates": _with(_D6, """, latest AS (SELECT url, max(attempt) AS attempts,
            arg_max(status, attempt) AS last_status FROM d6_url GROUP BY url)
          SELECT * FROM latest WHERE last_status IN (429, 403, 500, 502, 503, 504) AND attempts <= 2"""),
        # sets
        "register_fingerprints": _with(_D7, """SELECT url_fp FROM d7_known UNION
          SELECT url_fp FROM d7_fp"""),
        "new_fingerprints": _with(_D7, """SELECT url_fp FROM d7_fp EXCEPT
          SELECT url_fp FROM d7_known"""),
        # streaming
        "stream_ingest": _with(_ARTICLES, """SELECT row_number() OVER (ORDER BY page_id) AS id, url,
          url_fp, title, published, content_fp FROM good"""),
        "stream_ingest_runs": _with(_ARTICLES, """SELECT row_number() OVER (ORDER BY page_id) AS id, url,
          url_fp, title, published, content_fp FROM good"""),
        "stream_dedupe": _with(_D1, """SELECT arg_min(id, (id // 64 % 4, id)) AS id, content_fp
          FROM d1 GROUP BY content_fp"""),
        "stream_consume": _with(_D1, """SELECT CASE WHEN title = '' THEN '(无标题)' ELSE title END
          AS title, url FROM d1"""),
        "stream_stats": _with(f"{_D1}, {_TOTALS}, {_TOP}, {_TREND}", """
          SELECT 'totals' AS view, 'total' AS name, total AS value FROM totals UNION ALL
          SELECT 'totals', 'today', today FROM totals UNION ALL
          SELECT 'domains', name, value FROM top UNION ALL
          SELECT 'trend', date, count FROM trend"""),
        "resume": _with(_D3, "SELECT DISTINCT id, region, text FROM d3"),
    }
