"""Article fields to one clean text per document."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import article_text, may_clean_to_nothing
from ..session import new_path, store

# Bytes of text in a bucket of a stored corpus, and a bound on the buckets.
BUCKET_BYTES, MOST_BUCKETS = 256 << 20, 100_000

FIELDS = ("title", "description", "content")


def with_doc_id(articles: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Add ``doc_id``, a digest; stable across runs and plans.

    By default of all columns and of a row's number among equal rows, so no two
    rows share an id. Equal rows are counted before the shuffle and numbered
    from their count: many copies of one article are one row per task. Given
    ``keys`` must be unique themselves; then nothing is shuffled.
    """

    def digest(columns: Sequence[str], *more) -> Column:
        parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("")) for c in columns]
        return F.md5(F.concat_ws("\x1f", *parts, *more))

    if keys is not None:
        return articles.withColumn("doc_id", digest(keys))
    columns = articles.columns
    counted = articles.groupBy(*(f"`{c}`" for c in columns)).agg(F.count(F.lit(1)).alias("_copies"))
    numbered = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return numbered.select(*(f"`{c}`" for c in columns), digest(columns, F.col("_copy").cast("string")).alias("doc_id"))


def build_corpus(articles: DataFrame) -> DataFrame:
    """Fill missing title, description and content, add ``text``, drop empty texts.

    Blank articles keep the separators ('. .') and so survive; only a row whose
    fields are all URLs ends up empty.
    """
    filled = articles.withColumns({f: F.coalesce(F.col(f), F.lit("")) for f in FIELDS})
    # Tested first: Spark moves the filter to the scan, where it would clean
    # every text once more. Only texts beginning with a URL need that.
    kept = ~may_clean_to_nothing(*FIELDS) | (F.length("text") > 0)
    return filled.withColumn("text", article_text(*FIELDS)).filter(kept)


def store_corpus(corpus: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """Store a corpus in buckets by document, sorted in each, so that work by document needs no shuffle.

    ``annotate`` and whatever else groups or joins by ``id_col`` then run where
    the buckets lie. The number of buckets follows from the bytes of text; the
    rows are shuffled once, here. ``load_corpus`` finds the table again.
    """
    spark = corpus.sparkSession
    path = path or new_path(spark)
    if buckets is None:
        size = corpus.agg(F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0))).first()[0]
        buckets = min(MOST_BUCKETS, max(1, math.ceil(size / BUCKET_BYTES)))
    table = f"texttrend_corpus_{uuid.uuid4().hex}"
    writer = corpus.repartition(buckets, id_col).write.format("parquet").bucketBy(buckets, id_col).sortBy(id_col)
    writer.option("path", f"{path}/rows").saveAsTable(table)
    store(spark.createDataFrame([(id_col, buckets, corpus.schema.json())], "id_col string, buckets int, columns string"), f"{path}/settings")
    return spark.table(table)


def load_corpus(spark: SparkSession, path: str) -> DataFrame:
    """The corpus that ``store_corpus`` stored at ``path``, in this or another session."""
    from pyspark.sql.types import StructType

    kept = spark.read.parquet(f"{path}/settings").first()
    table, schema = f"texttrend_corpus_{uuid.uuid4().hex}", StructType.fromJson(json.loads(kept["columns"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f"`{kept['id_col']}`"
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {kept['buckets']} BUCKETS LOCATION '{path}/rows'")
    return spark.table(table)
