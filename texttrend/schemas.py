"""Fixed schemas. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of the raw article table.
ARTICLE_COLUMNS = ("query", "source", "author", "title", "description", "content", "url", "published_at")

ARTICLE = T.StructType([T.StructField(name, T.StringType()) for name in ARTICLE_COLUMNS])

SCORED_ARTICLE = T.StructType(
    ARTICLE.fields + [T.StructField("text", T.StringType()), T.StructField("sentiment", T.DoubleType())]
)

_RESULT = T.StructType(
    [
        T.StructField("headline", T.StructType([T.StructField("main", T.StringType())])),
        T.StructField("byline", T.StructType([T.StructField("original", T.StringType())])),
        T.StructField("snippet", T.StringType()),
        T.StructField("web_url", T.StringType()),
        T.StructField("pub_date", T.StringType()),
    ]
)

RESPONSE = T.StructType(
    [
        T.StructField("docs", T.ArrayType(_RESULT)),
        T.StructField("meta", T.StructType([T.StructField("hits", T.LongType())])),
    ]
)

# One landed search response: which search and page it answers, and its body.
SEARCH_PAGE = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("range_start", T.StringType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("response", RESPONSE),
    ]
)

LEXICON = T.StructType(
    [
        T.StructField("term", T.StringType(), False),
        T.StructField("polarity", T.DoubleType()),
        T.StructField("intensity", T.DoubleType()),
        T.StructField("kind", T.StringType(), False),  # polar, modifier or negation
    ]
)

REQUEST_LOG = T.StructType(
    [T.StructField("request_id", T.LongType(), False), T.StructField("ts", T.TimestampType(), False)]
)
