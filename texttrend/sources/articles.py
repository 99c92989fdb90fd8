"""Article sources: CSV, Parquet, and landed search responses (JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ARTICLE, ARTICLE_COLUMNS, SEARCH_PAGE

# Fixed value: the source name given to articles from search responses.
SOURCE_NAME = "The New York Times"
STATUS_OK = "OK"
CORRUPT_LINE = "corrupt_line"


def read_articles(spark: SparkSession, path: str, schema=ARTICLE, mode: str = "PERMISSIVE") -> DataFrame:
    """Articles from CSV with a header and doubled quotes; blank cells become NULL.

    Fields may hold line breaks, so one file is one task; land many files.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("mode", mode)
        .csv(path)
    )


def read_pages(spark: SparkSession, path: str, on_error: str = "skip") -> DataFrame:
    """Landed search responses, one JSON object per line.

    ``on_error="skip"`` keeps unreadable lines as rows with a NULL status and
    their text in ``corrupt_line``, which ``split_pages`` turns into rejects;
    ``"fail"`` stops at the first one.
    """
    mode = {"skip": "PERMISSIVE", "fail": "FAILFAST"}[on_error]
    schema = SEARCH_PAGE if on_error == "fail" else T.StructType([*SEARCH_PAGE.fields, T.StructField(CORRUPT_LINE, T.StringType())])
    return spark.read.schema(schema).option("mode", mode).option("columnNameOfCorruptRecord", CORRUPT_LINE).json(path)


def split_pages(pages: DataFrame, on_error: str = "skip") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) pages by response status; ``"fail"`` raises on a reject.

    The check is a filter, so no selection of columns and no count skips it.
    """
    ok = F.coalesce(F.col("status") == STATUS_OK, F.lit(False))
    if on_error == "fail":
        message = F.concat(F.lit("search response status: "), F.coalesce("status", F.lit("missing")))
        return pages.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))), pages.filter(F.lit(False))
    return pages.filter(ok), pages.filter(~ok)


def flatten_pages(pages: DataFrame, source: str = SOURCE_NAME, keep: tuple[str, ...] = (), on_error: str = "skip") -> DataFrame:
    """One article row per document of the accepted pages; missing fields become ''.

    The snippet serves as description and content. Pages without documents give no rows.
    """
    listed = F.col("response.docs")
    if on_error == "skip":
        # Decided where the documents are listed: a filter would move below the decoding and run it once more.
        listed = F.when(F.col("status") == STATUS_OK, listed)
    else:
        pages, _ = split_pages(pages, on_error)
    docs = pages.select("query", *keep, F.posexplode_outer(listed).alias("_at", "d")).filter("_at IS NOT NULL")

    def text(path: str):
        return F.coalesce(F.col(path), F.lit(""))

    fields = {
        "query": F.col("query"),
        "source": F.lit(source),
        "author": text("d.byline.original"),
        "title": text("d.headline.main"),
        "description": text("d.snippet"),
        "content": text("d.snippet"),
        "url": text("d.web_url"),
        "published_at": text("d.pub_date"),
    }
    return docs.select(*keep, *[fields[name].alias(name) for name in ARTICLE_COLUMNS])


def total_hits(pages: DataFrame, keys: tuple[str, ...] = ("query", "range_start"), on_error: str = "skip") -> DataFrame:
    """Hits reported by the first page of each search, 0 when it reports none."""
    accepted, _ = split_pages(pages, on_error)
    hits = F.coalesce(F.col("response.meta.hits"), F.lit(0))
    first_page = accepted.filter(F.col("page") == 0)
    return first_page.groupBy(*keys).agg(F.max(hits).alias("total_hits"))
