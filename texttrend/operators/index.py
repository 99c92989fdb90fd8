"""Term statistics shared by both rankers, and the tables derived from them."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import term_runs, term_starts, tokenize
from ..session import new_path, small_table, store

# Defaults of the two ranking models.
MIN_DF = 2
MAX_DF = 0.8
MIN_TERM_CHARS = 2
K1 = 1.5
B = 0.75
EPSILON = 0.25

# Term tables of at most this many bytes are broadcast to the postings: the terms' own, and so many for the rest of a row.
BROADCAST_BYTES, ROW_BYTES = 64 << 20, 48
# A stored index: words of the corpus for each bucket of documents and for each file in it, and bounds on buckets and folders.
# A task sorts its bucket's postings twice at once, with about 190 bytes for each word.
BUCKET_TOKENS, LEAST_BUCKETS, MOST_BUCKETS = 4_000_000, 8, 100_000
FILE_TOKENS, LEAST_PARTS, MOST_PARTS = 500_000, 8, 256

STOP_WORD_FILE = Path(__file__).parent.parent / "resources" / "english_stop_words.txt"


@lru_cache
def read_stop_words(path: str | Path = STOP_WORD_FILE) -> tuple[str, ...]:
    """Words of a plain text file; lines starting with '#' are comments."""
    lines = Path(path).read_text(encoding="utf-8").splitlines()
    return tuple(word for line in lines if not line.startswith("#") for word in line.split())


def with_tokens(corpus: DataFrame, text: str = "text") -> DataFrame:
    """Add the ``tokens`` array, unless the corpus was stored with one."""
    return corpus if "tokens" in corpus.columns else corpus.withColumn("tokens", tokenize(text))


def term_counts(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Postings (``id_col``, term, tf, length), counted inside each document's row.

    A grouping by (document, term) would shuffle the whole inverted index; here
    the tokens of a row are sorted and cut into runs, without a shuffle. The
    steps are separate projections so that each array is computed once, and
    ``explode_outer`` because ``explode`` adds a filter that evaluates the
    tokenizer a second time.
    """
    runs = (
        docs.select(id_col, F.sort_array("tokens").alias("_sorted"))
        .select(id_col, "_sorted", term_starts("_sorted").alias("_starts"))
        .select(id_col, F.size("_sorted").alias("length"), F.explode_outer(term_runs("_sorted", "_starts")).alias("_run"))
    )
    return runs.select(id_col, "_run.term", "_run.tf", "length").filter("term IS NOT NULL")


def term_statistics(docs: DataFrame) -> DataFrame:
    """(term, df, n_tokens) in one pass over the documents.

    Every document also contributes a NULL term; its row therefore holds the
    number of documents in ``df`` and the total length in ``n_tokens``. Terms
    are made distinct inside the row, and Spark's partial counts leave one row
    per term and split to shuffle, however frequent a term is.
    """
    distinct = F.concat(F.array(F.lit(None).cast("string")), F.array_distinct("tokens"))
    rows = docs.select(F.size("tokens").alias("_length"), distinct.alias("_terms")).select(
        "_length", F.explode_outer("_terms").alias("term")
    )
    return rows.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum(F.when(F.col("term").isNull(), F.col("_length"))).alias("n_tokens")
    )


@dataclass(frozen=True)
class TermIndex:
    """A corpus (``id_col``, tokens), its stored term statistics, and their totals."""

    docs: DataFrame
    statistics: DataFrame
    id_col: str
    n_docs: float
    n_tokens: float
    n_terms: int
    term_bytes: int
    mean_idf: float

    @property
    def small(self) -> bool:
        """Whether a table of all terms may be broadcast."""
        return self.term_bytes + ROW_BYTES * self.n_terms <= BROADCAST_BYTES

    @property
    def terms(self) -> DataFrame:
        return self.statistics.filter("term IS NOT NULL").select("term", F.col("df").cast("double").alias("df"))

    @property
    def average_length(self) -> float:
        return self.n_tokens / self.n_docs if self.n_docs else 0.0


def _index(corpus: DataFrame, statistics: DataFrame, text: str, id_col: str) -> TermIndex:
    is_term = F.col("term").isNotNull()
    totals = statistics.agg(
        F.max(F.when(~is_term, F.col("df"))).alias("n_docs"),
        F.max("n_tokens").alias("n_tokens"),
        F.count("term").alias("n_terms"),
        F.coalesce(F.sum(F.octet_length("term").cast("long")), F.lit(0)).alias("term_bytes"),
    ).first()
    n_docs = float(totals["n_docs"] or 0)
    mean = statistics.filter(is_term).agg(F.avg(plain_idf(n_docs)).alias("mean_idf")).first()["mean_idf"]
    docs = with_tokens(corpus, text).select(id_col, "tokens")
    n_tokens = float(totals["n_tokens"] or 0)
    return TermIndex(docs, statistics, id_col, n_docs, n_tokens, totals["n_terms"], totals["term_bytes"], mean or 0.0)


def fit_terms(
    corpus: DataFrame, text: str = "text", id_col: str = "doc_id", path: str | None = None, store_tokens: bool = False
) -> TermIndex:
    """Count the terms of a corpus and store the counts (the vocabulary, not the corpus).

    The statistics feed idf, average length and the idf floor. Of them only the
    totals come to the driver, to be constants in plans. With ``store_tokens``
    the words of the documents are stored too, so that weights read them instead
    of cutting the texts a second time. Searches need the postings as well: see
    ``fit_index``.
    """
    if store_tokens:
        corpus = store(with_tokens(corpus, text).select(id_col, "tokens"))
    return _index(corpus, store(term_statistics(with_tokens(corpus, text)), path), text, id_col)


def load_terms(corpus: DataFrame, path: str, text: str = "text", id_col: str = "doc_id") -> TermIndex:
    """The index over ``corpus`` whose statistics ``fit_terms`` stored at ``path``."""
    return _index(corpus, corpus.sparkSession.read.parquet(path), text, id_col)


def join_terms(postings: DataFrame, terms: DataFrame, small: bool, how: str = "inner") -> DataFrame:
    """Join postings with a table of one or few rows per term.

    Spark's own estimate does not see how many rows ``explode`` adds and may
    broadcast the postings, so the side is named here: the term table when its
    size is known to be small, else neither. The sort-merge join then splits
    frequent terms under adaptive execution.
    """
    return postings.join(F.broadcast(terms) if small else terms.hint("merge"), "term", how)


# ---- TF-IDF ---------------------------------------------------------------------------


def analyzer_terms(term: str = "term", stop_words: Iterable[str] | None = None) -> Column:
    """Condition for terms TF-IDF indexes: two or more characters, no stop word.

    The list becomes one IN with constants, a hash lookup in generated code.
    """
    words = read_stop_words() if stop_words is None else tuple(stop_words)
    long_enough = F.length(term) >= MIN_TERM_CHARS
    if not words:
        return long_enough
    quoted = ["'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words]
    return long_enough & F.expr(f"{term} NOT IN ({', '.join(quoted)})")


def vocabulary(
    index: TermIndex, min_df: int = MIN_DF, max_df: float = MAX_DF, stop_words: Iterable[str] | None = None
) -> DataFrame:
    """(term, df) with min_df <= df <= max_df * N, after stop words."""
    df = F.col("df")
    kept = analyzer_terms("term", stop_words) & (df >= min_df) & (df <= float(max_df) * index.n_docs)
    return index.terms.filter(kept)


def smoothed_idf(index: TermIndex, **vocabulary_options) -> DataFrame:
    """(term, df, idf) with idf = ln((1 + N) / (1 + df)) + 1."""
    idf = F.log(F.lit(1 + index.n_docs) / (1 + F.col("df"))) + 1
    return vocabulary(index, **vocabulary_options).withColumn("idf", idf)


def tfidf_weights(index: TermIndex, **vocabulary_options) -> DataFrame:
    """(doc, term, tf, weight): tf * idf, scaled to length 1 per document.

    Documents without vocabulary terms have no rows, the long form of a zero
    vector. The window covers one document's terms, so none can be large. With a
    broadcast vocabulary it is the documents that are shuffled, words in one
    row, and not their postings.
    """
    idf = smoothed_idf(index, **vocabulary_options).select("term", "idf")
    docs = index.docs.repartition(index.id_col) if index.small else index.docs
    postings = term_counts(docs, index.id_col).filter(
        analyzer_terms("term", vocabulary_options.get("stop_words"))
    )
    raw = join_terms(postings, idf, index.small).withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(index.id_col)))
    return raw.select(index.id_col, "term", "tf", (F.col("_w") / norm).alias("weight"))


def split_idf(index: TermIndex, most_bytes: int | None = None, **vocabulary_options) -> tuple[DataFrame, DataFrame | None]:
    """(term, idf) of the vocabulary in two tables: one to broadcast, and the rare terms that exceed it (None if none do).

    The first holds every term from some document frequency on, with a NULL idf
    for those outside the vocabulary, so a term it lacks is rare. Few postings
    belong to rare terms, however many those are.
    """
    idf = smoothed_idf(index, **vocabulary_options)
    most_bytes = BROADCAST_BYTES if most_bytes is None else most_bytes
    level = F.length(F.bin(F.col("df").cast("long")))  # the power of two above a frequency
    each = F.octet_length("term").cast("long") + ROW_BYTES
    at_least = index.terms.filter(F.col("df") >= vocabulary_options.get("min_df", MIN_DF))
    sizes = at_least.groupBy(level.alias("level")).agg(F.sum(each).alias("n")).collect()  # 64 rows at most
    for row in sorted(sizes, reverse=True):
        most_bytes -= row["n"]
        if most_bytes < 0:
            is_rare = F.col("df") < float(1 << row["level"])
            listed = index.terms.filter(~is_rare).select("term").join(idf.filter(~is_rare).select("term", "idf"), "term", "left")
            return listed, idf.filter(is_rare).select("term", "idf")
    return idf.select("term", "idf"), None


def _other_words(docs: DataFrame, listed: DataFrame, id_col: str) -> DataFrame:
    """(document, term, tf) of words that ``listed`` lacks; a word may have several rows in a document."""
    words = docs.select(id_col, F.explode("tokens").alias("term"))
    return words.join(F.broadcast(listed.select("term")), "term", "left_anti").select(id_col, "term", F.lit(1).alias("tf"))


def rare_squares(postings: DataFrame, rare: DataFrame, id_col: str) -> DataFrame:
    """(document, _rare): the squared weights of its rare terms, added up."""
    found = postings.hint("merge").join(rare.hint("merge"), "term")
    terms = found.groupBy(id_col, "term").agg(F.sum("tf").alias("tf"), F.first("idf").alias("idf"))
    w = F.col("tf") * F.col("idf")
    return terms.groupBy(id_col).agg(F.sum(w * w).alias("_rare"))


# ---- BM25 -----------------------------------------------------------------------------


def plain_idf(n_docs: float) -> Column:
    """ln(N - df + 0.5) - ln(df + 0.5), negative for terms in more than half the documents."""
    df = F.col("df").cast("double")
    return F.log(F.lit(n_docs) - df + 0.5) - F.log(df + 0.5)


def bm25_idf(index: TermIndex, epsilon: float = EPSILON) -> DataFrame:
    """(term, df, idf); a negative idf is replaced by epsilon * the mean over distinct terms."""
    idf = plain_idf(index.n_docs)
    floored = F.when(idf < 0, float(epsilon) * index.mean_idf).otherwise(idf)
    return index.terms.select("term", "df", floored.alias("idf"))


def bm25_stats(index: TermIndex) -> DataFrame:
    """One row: documents, tokens, average length, distinct terms, mean idf."""
    row = (int(index.n_docs), int(index.n_tokens), index.average_length, index.n_terms, index.mean_idf)
    schema = "n_docs long, n_tokens long, avgdl double, n_terms long, mean_idf double"
    return small_table(index.statistics.sparkSession, [row], schema)


# ---- stored index -----------------------------------------------------------------------


@dataclass(frozen=True)
class SearchIndex(TermIndex):
    """A stored index: fitted once, searched often.

    ``postings`` (document, term, tf, length, norm) is a table in folders by a
    hash of the term and in buckets by document. A search reads only the folders
    of its words and adds up a document's score within its bucket. ``norm`` is
    the length of the document's TF-IDF vector, fixed by ``options``. An index of
    segments keeps it ``apart``, as postings without and a table (document, norm).
    """

    postings: DataFrame
    parts: int
    options: dict
    n_vocabulary: int
    apart: tuple[DataFrame, DataFrame] | None = None


def part_of(term: Column | str, parts: int) -> Column:
    """The folder of a term."""
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def postings_layout(n_tokens: int) -> tuple[int, int]:
    """(folders of terms, buckets of documents) of an index over so many words.

    Each folder holds a file of every bucket. Buckets follow the words, so that
    a task that builds or scores one needs as much memory however large the
    corpus is; folders cut each bucket into files of about ``FILE_TOKENS`` words,
    no smaller however large the corpus is. Files are sorted by term, so a search
    skips most of a file by its statistics.
    """
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, int(n_tokens // BUCKET_TOKENS)))
    parts = min(MOST_PARTS, max(LEAST_PARTS, n_tokens // (buckets * FILE_TOKENS)))
    return parts, buckets


def new_table(what: str) -> str:
    """A name of its own for an external table of this session."""
    return f"texttrend_{what}_{uuid.uuid4().hex}"


def _search_index(terms: TermIndex, table: str, parts: int, options: dict) -> SearchIndex:
    n_vocabulary = vocabulary(terms, **options).count()
    return SearchIndex(**vars(terms), postings=terms.docs.sparkSession.table(table), parts=parts, options=options, n_vocabulary=n_vocabulary)


def fit_index(
    corpus: DataFrame,
    path: str | None = None,
    text: str = "text",
    id_col: str = "doc_id",
    parts: int | None = None,
    buckets: int | None = None,
    **vocabulary_options,
) -> SearchIndex:
    """Store everything searches read below ``path``, a new folder all executors reach; the caller removes it.

    The texts are tokenized once. Documents meet in their bucket before their
    terms are listed, so no posting is shuffled; of a vocabulary too large to
    broadcast, the occurrences of its rare words are, for the norms alone.
    Fails on repeated document ids, whose scores would add up.
    """
    spark = corpus.sparkSession
    path = path or new_path(spark)
    docs = store(with_tokens(corpus, text).select(id_col, "tokens"), f"{path}/documents")
    if not docs.groupBy(id_col).count().filter("count > 1").isEmpty():
        raise ValueError(f"{id_col} repeats; an index needs unique ids")
    terms = fit_terms(docs, id_col=id_col, path=f"{path}/statistics")
    layout = postings_layout(terms.n_tokens)
    parts, buckets = parts or layout[0], buckets or layout[1]

    docs = docs.repartition(buckets, id_col)
    frequent, rare = split_idf(terms, **vocabulary_options)
    weighted = term_counts(docs, id_col).join(F.broadcast(frequent), "term", "left")
    w = F.col("tf") * F.col("idf")
    square = F.sum(w * w).over(Window.partitionBy(id_col))
    if rare is not None:
        # Only words that the broadcast lacks leave their document; what they add comes back as one number.
        others = rare_squares(_other_words(docs, frequent, id_col), rare, id_col)
        weighted = weighted.join(others, id_col, "left")
        square = F.coalesce(square + F.col("_rare"), square, F.col("_rare"))
    norm = F.sqrt(square)
    rows = weighted.select(id_col, "term", "tf", "length", norm.alias("norm"), part_of("term", parts).alias("part"))
    table = new_table("postings")
    writer = rows.write.format("parquet").partitionBy("part").bucketBy(buckets, id_col).sortBy("term")
    writer.option("path", f"{path}/postings").saveAsTable(table)

    options = {k: list(v) if k == "stop_words" and v is not None else v for k, v in vocabulary_options.items()}
    settings = small_table(spark, [(id_col, parts, buckets, json.dumps(options))], "id_col string, parts int, buckets int, options string")
    store(settings, f"{path}/settings")
    return _search_index(terms, table, parts, options)


def load_index(spark: SparkSession, path: str) -> SearchIndex:
    """The index that ``fit_index`` stored at ``path``, in this or another session."""
    settings = spark.read.parquet(f"{path}/settings").first()
    id_col, table = settings["id_col"], new_table("postings")
    docs = spark.read.parquet(f"{path}/documents")
    id_type = docs.schema[id_col].dataType.simpleString()
    spark.sql(
        f"CREATE TABLE {table} (`{id_col}` {id_type}, term STRING, tf INT, length INT, norm DOUBLE, part INT) USING parquet "
        f"PARTITIONED BY (part) CLUSTERED BY (`{id_col}`) SORTED BY (term) INTO {settings['buckets']} BUCKETS LOCATION '{path}/postings'"
    )
    spark.catalog.recoverPartitions(table)
    terms = load_terms(docs, f"{path}/statistics", id_col=id_col)
    return _search_index(terms, table, settings["parts"], json.loads(settings["options"]))
