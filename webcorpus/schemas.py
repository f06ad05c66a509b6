"""Explicit schemas of every stored table and JSON document."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _L, _B = T.StringType(), T.LongType(), T.BooleanType()

PAGE = _struct(("page_id", _L), ("url", _S), ("html", _S))

ARTICLE = _struct(
    ("id", _L), ("url", _S), ("url_fp", _S), ("title", _S), ("published", _S),
    ("content_md", _S), ("content_fp", _S), ("crawled_at", T.TimestampType()),
)

ARTICLE_FIELDS = ARTICLE.fieldNames()
ITEM_FIELDS = ["url", "url_fp", "title", "published", "content_md", "content_fp"]

MESSAGE = _struct(("url", _S), ("url_fp", _S), ("title", _S), ("published", _S),
                  ("content_fp", _S))

PAGE_LINKS = _struct(("src_fp", _S), ("links", T.ArrayType(_struct(("url", _S), ("url_fp", _S)))))

# Ids are read as text: raw feeds carry numbers, stored files carry strings.
COMMENT_PAGE = _struct(
    ("data", T.ArrayType(_struct(
        ("id", _S),
        ("user", _struct(("screen_name", _S))),
        ("source", _S),
        ("text_raw", _S),
    ))),
    ("max_id", _L),
)

COMMENT_CSV = _struct(("id", _S), ("screen_name", _S), ("region", _S), ("text", _S))

PROGRESS = _struct(("post", _S), ("max_id", _L), ("page", _L), ("done", _B))
