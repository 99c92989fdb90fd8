"""The given tables seen as articles, search responses and ranked lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEXICON, SEARCH_PAGE
from ..session import small_table

# Terms that occur in the given documents, with made-up polarities.
SAMPLE_LEXICON = (
    ("license", -0.4, None, "polar"),
    ("best", 1.0, None, "polar"),
    ("orre", 0.5, None, "polar"),
    ("rewh", -0.5, None, "polar"),
    ("er", 0.2, None, "polar"),
    ("very", None, 1.3, "modifier"),
    ("the", None, 1.2, "modifier"),
    ("no", None, None, "negation"),
    ("not", None, None, "negation"),
    ("never", None, None, "negation"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def lexicon(spark: SparkSession, rows=SAMPLE_LEXICON) -> DataFrame:
    return small_table(spark, list(rows), LEXICON)


def articles(docs: DataFrame) -> DataFrame:
    """Documents as articles: first line the title, second the description, all of it the content."""
    lines = F.split("text", "\n")
    seconds = F.pmod(F.col("doc_id") * 1234577, F.lit(31622400)) + 1704067200
    return docs.select(
        "doc_id",
        F.col("lang").alias("query"),
        "source",
        F.when(F.col("lang") != "en", F.concat(F.lit("By "), F.col("source"))).alias("author"),
        F.get(lines, F.lit(0)).alias("title"),
        F.get(lines, F.lit(1)).alias("description"),
        F.col("text").alias("content"),
        F.concat(F.lit("http://"), "source", F.lit("/"), F.md5("text")).alias("url"),
        F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
    )


def response_pages(events: DataFrame) -> DataFrame:
    """Each event as a search response, sent through JSON text as a landed one would be.

    Errors carry a status other than OK, purchases list no documents, small
    values lack a byline and small ``k`` a snippet.
    """
    k = F.get_json_object("props", "$.k").cast("long")
    day = F.date_format("ts", "yyyy-MM-dd")
    doc = F.struct(
        F.struct(F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("main")).alias("headline"),
        F.when(F.col("value") >= 5, F.struct(F.concat(F.lit("By "), F.col("user_id").cast("string")).alias("original")))
        .alias("byline"),
        F.when(k >= 10, F.col("props")).alias("snippet"),
        F.concat(F.lit("http://events/"), F.col("event_id").cast("string")).alias("web_url"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("pub_date"),
    )
    body = F.struct(
        F.col("event_type").alias("query"),
        day.alias("range_start"),
        F.when(F.col("value") >= 1, 0).otherwise(1).alias("page"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("OK").alias("status"),
        F.struct(
            F.when(F.col("event_type") != "purchase", F.array(doc)).otherwise(F.array().cast(_DOCS)).alias("docs"),
            F.struct(k.alias("hits")).alias("meta"),
        ).alias("response"),
    )
    landed = events.select("event_id", F.to_json(body).alias("line"))
    return landed.select("event_id", F.from_json("line", SEARCH_PAGE).alias("p")).select("event_id", "p.*")


_DOCS = SEARCH_PAGE["response"].dataType["docs"].dataType


def ranked_lists(conversations: DataFrame) -> DataFrame:
    """Conversations as ranked lists: the turn is the rank, the text's length a grade from 0 to 3."""
    grade = F.least(F.lit(3.0), F.floor(F.length("text") / 400).cast("double"))
    return conversations.select(F.col("conv_id").alias("query_id"), (F.col("turn") + 1).alias("rank"), grade.alias("rel"))
