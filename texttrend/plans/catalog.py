"""The registered queries: each operator applied to the whole of the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, labels, text
from ..operators import corpus as corpora
from ..operators import bounds, evaluation, index, model, retrieval, search, sentiment, states, trends
from ..operators.segments import SegmentStore
from ..session import configure, new_path, small_table, store
from ..sources import articles as sources
from ..sources import metrics, sinks
from ..sources.collection import Collection
from ..streaming import trend as streaming
from ..schemas import ARTICLE_COLUMNS
from . import analysis, views

SEARCH_QUERIES = ("license", "best no", "the the orre", "the", "zzz")
COMPARE_QUERIES = ("en", "de", "es", "license fr")
GRID_RANGE = ("2024-01-15", "2024-12-20")
QUOTA = 300
K_LISTS = 3
MAX_DF_PRUNED = 0.1

QUERIES = {}


def query(fn):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(configure(spark), folder)

    QUERIES[fn.__name__] = run
    return fn


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def _day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def _articles(spark, folder):
    return views.articles(views.documents(spark, folder))


def _corpus(spark, folder):
    return corpora.build_corpus(_articles(spark, folder))


def _index(spark, folder):
    return index.fit_terms(views.documents(spark, folder))


def _stored_index(spark, folder, **options):
    return index.fit_index(views.documents(spark, folder), **options)


def _article_scores(spark, folder, *keep):
    return sentiment.lexicon_scores(_corpus(spark, folder), views.lexicon(spark), keep=keep)


# ---- sources ------------------------------------------------------------------------


@query
def scan_articles(spark, folder):
    return _articles(spark, folder)


def _pages(spark, folder):
    return views.response_pages(views.table(spark, folder, "events"))


@query
def flatten_json(spark, folder):
    return sources.flatten_pages(_pages(spark, folder), source="events", keep=("event_id",))


@query
def reject_split(spark, folder):
    _, rejected = sources.split_pages(_pages(spark, folder))
    return rejected.select("event_id", "query", "status")


@query
def search_hits(spark, folder):
    return sources.total_hits(_pages(spark, folder))


@query
def tag_union(spark, folder):
    docs = views.documents(spark, folder).select("doc_id", "source", "text")
    return retrieval.tag_searches(docs, ("best", "no", "license")).select("doc_id", "source", "query")


@query
def run_version(spark, folder):
    orders = views.table(spark, folder, "orders")
    runs = orders.select(
        F.col("o_orderstatus").alias("name"),
        F.col("o_orderdate").cast("date").alias("run_date"),
        F.col("o_custkey").alias("run_seq"),
    )
    return sinks.next_runs(runs).withColumn("run_date", _day("run_date"))


@query
def run_claims(spark, folder):
    """Runs of the orders of each status, claimed and written one after another, and what was read back of them."""
    root, orders = new_path(spark), views.table(spark, folder, "orders")
    for status in ("F", "O", "P"):
        sinks.write_run(orders.filter(F.col("o_orderstatus") == status), root, "orders", "2024-12-31")
    runs = sinks.runs_table(spark, root, "orders").filter("finished")
    folders = spark.read.option("basePath", f"{root}/orders").parquet(f"{root}/orders/run_date=*")
    rows = folders.groupBy("run_seq").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderstatus").alias("status"))
    return runs.join(rows, "run_seq").select("run_seq", _day("run_date"), "status", "n")


@query
def collect_metrics(spark, folder):
    """What is counted while the pages' articles are written, beside the rows read back."""
    path = new_path(spark)
    seen = metrics.write_collected(_pages(spark, folder), path, source="events")
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("stored"), *(F.lit(v).cast("long").alias(k) for k, v in seen.items()))


@query
def resumed_collection(spark, folder):
    """The ledger after an attempt in which error responses fail their searches, and another that repairs them."""
    collected, pages = Collection(spark, new_path(spark)), store(_pages(spark, folder))
    grid = pages.select("query", "range_start")

    def landed(searches):
        return pages.join(searches, ["query", "range_start"], "left_semi").select(pages.columns)

    collected.run(grid, landed, keep=("event_id",))
    collected.run(grid, lambda searches: landed(searches).withColumn("status", F.lit(sources.STATUS_OK)), keep=("event_id",))
    found = collected.articles().groupBy("query", "range_start").agg(F.countDistinct("event_id").alias("articles"))
    ledger = collected.ledger().join(found, ["query", "range_start"], "left")
    return ledger.select("query", "range_start", "attempt", "status", "pages", "bad_pages", F.coalesce("articles", F.lit(0)).alias("articles"))


@query
def csv_round_trip(spark, folder):
    """Articles written as CSV and read again."""
    path = new_path(spark)
    sinks.write_csv(_articles(spark, folder).select(*ARTICLE_COLUMNS), path)
    articles = sources.read_articles(spark, path)
    filled = [F.coalesce(c, F.lit("")).alias(c) for c in ARTICLE_COLUMNS]
    return articles.select(*filled).groupBy(*ARTICLE_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


# ---- retrieval ----------------------------------------------------------------------


@query
def month_ranges(spark, folder):
    spans = views.table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi")
    )
    months = spans.select("o_custkey", F.explode(dates.month_ranges(F.col("lo"), F.col("hi"))).alias("r"))
    return months.select(
        "o_custkey",
        dates.compact_date("r.range_start").alias("begin_date"),
        dates.compact_date("r.range_end").alias("end_date"),
        dates.month_label("r.range_start").alias("month"),
    )


@query
def search_grid(spark, folder):
    langs = views.table(spark, folder, "documents").select(F.col("lang").alias("query")).distinct()
    return retrieval.search_grid(langs, *GRID_RANGE).withColumns({c: _day(c) for c in ("range_start", "range_end")})


def _search(spark, folder, monthly=True):
    return retrieval.search_articles(_corpus(spark, folder), ("license", "best", "no"), *GRID_RANGE, monthly=monthly)


@query
def search_articles(spark, folder):
    return _search(spark, folder).select("doc_id", "query", _day("range_start"), _day("range_end"), "published_at")


@query
def oldest_topn(spark, folder):
    found = retrieval.oldest_first(_search(spark, folder), page_size=2)
    return found.select("query", _day("range_start"), "position", "doc_id", "published_at")


@query
def search_whole(spark, folder):
    found = retrieval.oldest_first(_search(spark, folder, monthly=False))
    return found.select("query", _day("range_start"), "position", "doc_id", "published_at")


@query
def search_table(spark, folder):
    """Every article beside all benchmark items, months apart, whose words it holds."""
    items = _benchmark_queries(spark, folder)
    asked = items.unionByName(small_table(spark, list(enumerate(("license", "best no", "the the orre", "the", "zzz", ""), -6)), "query_id long, query string"))
    found = retrieval.search_table(_corpus(spark, folder), asked, *GRID_RANGE)
    return found.select("query_id", "doc_id", _day("range_start"), _day("range_end"), "published_at")


@query
def daily_quota(spark, folder):
    return retrieval.daily_quota(views.table(spark, folder, "events"), QUOTA).withColumn("day", _day("day"))


@query
def quota_admit(spark, folder):
    log = views.table(spark, folder, "events").select(F.col("event_id").alias("request_id"), "ts")
    return retrieval.admit_requests(log, QUOTA).select("request_id", _day("day"), "request_no")


@query
def dedup(spark, folder):
    return retrieval.dedup_articles(_articles(spark, folder)).select("doc_id", "url", "published_at")


@query
def dedup_blank_urls(spark, folder):
    """German articles have no URL, Spanish ones a blank one: none of these may go."""
    url = F.when(F.col("query") == "es", F.lit(" ")).when(F.col("query") != "de", F.col("url"))
    articles = _articles(spark, folder).withColumn("url", url)
    return retrieval.dedup_articles(articles).select("doc_id", "url", "published_at")


# ---- corpus ---------------------------------------------------------------------------


@query
def build_corpus(spark, folder):
    return _corpus(spark, folder).select("doc_id", "title", "description", "text")


@query
def clean_text(spark, folder):
    page = F.concat_ws(" ", "url", "html")
    return views.table(spark, folder, "pages").select("page_id", text.clean_text(page).alias("text"))


# ---- sentiment ------------------------------------------------------------------------


@query
def lexicon_polarity(spark, folder):
    scores = sentiment.lexicon_scores(views.documents(spark, folder), views.lexicon(spark))
    return scores.select("doc_id", r6("sentiment").alias("sentiment"))


@query
def conversation_polarity(spark, folder):
    turns = views.table(spark, folder, "conversations")
    scores = sentiment.lexicon_scores(turns, views.lexicon(spark), keep=["turn"], id_col="conv_id")
    return scores.select("conv_id", "turn", r6("sentiment").alias("sentiment"))


@query
def annotate_sentiment(spark, folder):
    scored = sentiment.annotate(_corpus(spark, folder), lexicon=views.lexicon(spark))
    return scored.select("doc_id", "query", "url", F.length("text").alias("n_chars"), r6("sentiment").alias("sentiment"))


@query
def annotate_bucketed(spark, folder):
    """The rows of ``annotate_sentiment``, over a corpus stored in buckets by document."""
    scored = sentiment.annotate(corpora.store_corpus(_corpus(spark, folder)), lexicon=views.lexicon(spark))
    return scored.select("doc_id", "query", "url", F.length("text").alias("n_chars"), r6("sentiment").alias("sentiment"))


@query
def scored_runs(spark, folder):
    """Scores of the second of two numbered runs, by the method named, read back from the months of the second half-year."""
    root = new_path(spark)
    for _ in range(2):
        path = analysis.write_scored(sentiment.annotate(_corpus(spark, folder), "lexicon", views.lexicon(spark)), root, "2024-12-31")
    ranged = trends.time_filter(spark.read.parquet(path), start="2024-07-01", end="2024-12-31")
    run = F.lit(path.removeprefix(root))
    return ranged.select("doc_id", run.alias("run"), r6("sentiment").alias("sentiment"))


@query
def model_polarity(spark, folder):
    # Stands in for a model: label and score follow from the text's length, and
    # every 11th length fails. Nested, so that it is sent to workers whole.
    def factory():
        names = ("positive", "LABEL_0", "neutral", "NEGATIVE", "label_2")

        def predict(texts):
            if any(len(t) % 11 == 0 for t in texts):
                raise ValueError("no prediction")
            return [(names[len(t) % 5], len(t) % 101 / 100) for t in texts]

        return predict

    scored = model.annotate_with_model(views.documents(spark, folder), factory)
    return scored.select("doc_id", r6("sentiment").alias("sentiment"), F.col("error").isNotNull().alias("failed"))


@query
def truncate_text(spark, folder):
    docs = views.table(spark, folder, "documents")
    return docs.select("doc_id", text.truncate_text("text").alias("text"))


@query
def label_to_polarity(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    names = F.array(*[F.lit(n) for n in ("positive", "LABEL_2", "NEGATIVE", "label_0", "neutral", "LABEL_1", "other")])
    label = F.get(names, F.pmod(k, F.lit(7)))
    events = views.table(spark, folder, "events")
    return events.select("event_id", labels.label_to_polarity(label, "value").alias("polarity"))


@query
def sentiment_label(spark, folder):
    return _article_scores(spark, folder).select("doc_id", labels.sentiment_label("sentiment").alias("label"))


# ---- index ----------------------------------------------------------------------------


@query
def tokenize(spark, folder):
    tokens = text.tokenize("text")
    return views.documents(spark, folder).select(
        "doc_id", F.size(tokens).alias("n_tokens"), F.array_join(tokens, " ").alias("tokens")
    )


@query
def tfidf_terms(spark, folder):
    counts = index.term_counts(index.with_tokens(views.documents(spark, folder)))
    return counts.filter(index.analyzer_terms("term")).drop("length")


@query
def vocabulary(spark, folder):
    return index.vocabulary(_index(spark, folder)).withColumn("df", F.col("df").cast("long"))


@query
def vocabulary_pruned(spark, folder):
    terms = index.vocabulary(_index(spark, folder), max_df=MAX_DF_PRUNED)
    return terms.withColumn("df", F.col("df").cast("long"))


@query
def idf(spark, folder):
    return index.smoothed_idf(_index(spark, folder)).select("term", r6("idf").alias("idf"))


@query
def tfidf_weights(spark, folder):
    weights = index.tfidf_weights(index.fit_terms(views.documents(spark, folder), store_tokens=True))
    return weights.select("doc_id", "term", "tf", r6("weight").alias("weight"))


@query
def bm25_stats(spark, folder):
    stats = index.bm25_stats(_index(spark, folder))
    return stats.withColumns({c: r6(c) for c in ("avgdl", "mean_idf")})


@query
def bm25_idf(spark, folder):
    return index.bm25_idf(_index(spark, folder)).select("term", r6("idf").alias("idf"))


# ---- search ---------------------------------------------------------------------------


def _rounded(results):
    return results.withColumn("score", r6("score"))


@query
def tfidf_search(spark, folder):
    return _rounded(search.tfidf_search(_stored_index(spark, folder), SEARCH_QUERIES))


@query
def tfidf_search_pruned(spark, folder):
    return _rounded(search.tfidf_search(_stored_index(spark, folder, max_df=MAX_DF_PRUNED), SEARCH_QUERIES))


@query
def tfidf_matches(spark, folder):
    return _rounded(search.tfidf_search(_stored_index(spark, folder), SEARCH_QUERIES, fill_zero=False))


@query
def bm25_search(spark, folder):
    return _rounded(search.bm25_search(_stored_index(spark, folder), SEARCH_QUERIES))


@query
def bm25_matches(spark, folder):
    return _rounded(search.bm25_search(_stored_index(spark, folder), SEARCH_QUERIES, fill_zero=False))


def _benchmark_queries(spark, folder):
    items = views.table(spark, folder, "benchmark")
    return items.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


@query
def tfidf_benchmark(spark, folder):
    return _rounded(search.tfidf_search(_stored_index(spark, folder), _benchmark_queries(spark, folder)))


@query
def bm25_benchmark(spark, folder):
    return _rounded(search.bm25_search(_stored_index(spark, folder), _benchmark_queries(spark, folder)))


def _bounded(spark, folder, queries, ranker):
    found = bounds.bounded_search(bounds.fit_bounds(_stored_index(spark, folder)), queries, ranker)
    return _rounded(found.results)


@query
def bm25_bounded(spark, folder):
    """The rows of ``bm25_search``, read from the blocks that can reach them."""
    return _bounded(spark, folder, SEARCH_QUERIES, "bm25")


@query
def tfidf_bounded(spark, folder):
    return _bounded(spark, folder, SEARCH_QUERIES, "tfidf")


@query
def bm25_bounded_benchmark(spark, folder):
    return _bounded(spark, folder, _benchmark_queries(spark, folder), "bm25")


@query
def tfidf_bounded_benchmark(spark, folder):
    return _bounded(spark, folder, _benchmark_queries(spark, folder), "tfidf")


def _segments(spark, folder):
    """Documents by language, and benchmark items that are deleted again."""
    docs, items = views.documents(spark, folder).select("doc_id", "text"), views.table(spark, folder, "benchmark")
    english = views.documents(spark, folder).filter("lang = 'en'").select("doc_id", "text")
    others = views.documents(spark, folder).filter("lang != 'en' OR lang IS NULL").select("doc_id", "text")
    extra = items.select((-1 - F.col("item_id")).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text")
    kept = SegmentStore(spark, new_path(spark)).create()
    kept.add(english)
    kept.add(others.unionByName(extra))
    kept.delete(extra.select("doc_id"))
    return kept


@query
def bm25_segments(spark, folder):
    """The rows of ``bm25_search``, over an index grown in segments."""
    return _rounded(search.bm25_search(_segments(spark, folder).load(norms=False), SEARCH_QUERIES))


@query
def tfidf_segments(spark, folder):
    kept = _segments(spark, folder)
    kept.compact()
    return _rounded(search.tfidf_search(kept.load(), SEARCH_QUERIES))


def _compared(spark):
    return small_table(spark, list(enumerate(COMPARE_QUERIES)), "query_id long, query string")


def _judged(spark, folder):
    corpus, asked = _corpus(spark, folder), _compared(spark)
    results = store(search.rank_all(index.fit_index(corpus), COMPARE_QUERIES))
    return evaluation.judge(results, corpus.select("doc_id", "query"), asked)


@query
def rank_compare(spark, folder):
    report = evaluation.compare_rankers(_judged(spark, folder), queries=_compared(spark))
    named = report.drop("query_id").withColumn("query", F.coalesce("query", F.lit("(average)")))
    return named.withColumns({m: r6(m) for m in evaluation.METRICS[:-1]})


@query
def relevance(spark, folder):
    return _judged(spark, folder).select("ranker", "query", "rank", "doc_id", "article_query", "rel")


# ---- evaluation -----------------------------------------------------------------------


def _lists(spark, folder):
    return views.ranked_lists(views.table(spark, folder, "conversations"))


@query
def precision_at_k(spark, folder):
    found = evaluation.precision_at_k(_lists(spark, folder), K_LISTS)
    return found.withColumn("precision_at_k", r6("precision_at_k"))


@query
def ndcg_at_k(spark, folder):
    return evaluation.ndcg_at_k(_lists(spark, folder), K_LISTS).withColumn("ndcg", r6("ndcg"))


@query
def mrr(spark, folder):
    return evaluation.mean_reciprocal_rank(_lists(spark, folder)).withColumn("mrr", r6("mrr"))


@query
def evaluate_ranking(spark, folder):
    report = evaluation.evaluate_ranking(_lists(spark, folder), K_LISTS)
    return report.withColumns({m: r6(m) for m in evaluation.METRICS})


def _labelled(spark, folder):
    """Given labels beside labels predicted from the lexicon score."""
    truth = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    given = views.table(spark, folder, "labels").select("doc_id", truth.alias("y_true"))
    scores = sentiment.lexicon_scores(views.documents(spark, folder), views.lexicon(spark))
    return given.join(scores, "doc_id").select("y_true", labels.sentiment_label("sentiment").alias("y_pred"))


@query
def confusion(spark, folder):
    return evaluation.confusion_counts(_labelled(spark, folder))


@query
def classification_report(spark, folder):
    report = evaluation.classification_report(_labelled(spark, folder))
    return report.select(*[r6(c).alias(c) for c in report.columns])


# ---- distributions and trends -----------------------------------------------------------


def _rounded_statistics(df):
    return df.select(*[r6(c).alias(c) if "sentiment" in c or "ratio" in c else F.col(c) for c in df.columns])


@query
def sentiment_distribution(spark, folder):
    return _rounded_statistics(trends.sentiment_distribution(_article_scores(spark, folder)))


@query
def distribution_by(spark, folder):
    scores = _article_scores(spark, folder, "query")
    return _rounded_statistics(trends.sentiment_distribution(scores, keys=["query"]))


@query
def distribution_lineitem(spark, folder):
    lines = views.table(spark, folder, "lineitem")
    scores = lines.select("l_returnflag", "l_linestatus", (F.col("l_tax") - F.col("l_discount")).alias("sentiment"))
    keys = ["l_returnflag", "l_linestatus"]
    return _rounded_statistics(trends.sentiment_distribution(scores, keys, pos_th=0.025, neg_th=-0.025))


def _states(spark, folder):
    """Daily states of the articles, stored in two batches, the second of them run twice."""
    path, scores = new_path(spark), _article_scores(spark, folder, "query", "published_at")
    first = F.coalesce(F.col("query") == "en", F.lit(False))
    for batch, rows in (("a", first), ("b", ~first), ("b", ~first)):
        states.update_states(states.daily_states(scores.filter(rows), ["query"]), path, batch)
    return states.read_states(spark, path)


@query
def distribution_merged(spark, folder):
    """The rows of ``sentiment_distribution``, from states."""
    return _rounded_statistics(states.distribution_of(_states(spark, folder)))


@query
def distribution_merged_by(spark, folder):
    return _rounded_statistics(states.distribution_of(_states(spark, folder), ["query"]))


@query
def trend_merged(spark, folder):
    return _trend(states.trend_of(_states(spark, folder)))


def _closed_stream(spark, folder, columns):
    """The events as a stream, and behind them one far later that closes what came before."""
    path, events = new_path(spark), views.table(spark, folder, "events").select(*columns)
    events.write.parquet(path)
    later = F.expr("max(ts) + INTERVAL 1 YEAR").cast(events.schema["ts"].dataType).alias("ts")
    end = events.agg(later, *(F.lit(None).cast(events.schema[c].dataType).alias(c) for c in columns if c != "ts"))
    end.select(*columns).write.mode("append").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _run_stream(spark, stream):
    out = new_path(spark)
    streaming.run_to_end(stream, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


@query
def streamed_trend(spark, folder):
    """The rows of ``trend_events`` with whole last days, from the states a stream emits month by month."""
    # Files arrive in any order, so the watermark waits for all the range.
    events = _closed_stream(spark, folder, ["ts", "value"])
    return _trend(states.trend_of(_run_stream(spark, streaming.monthly_states(events, "ts", "value", delay="300 days"))))


@query
def streamed_quota(spark, folder):
    """The rows of ``quota_admit``, from the candidates a stream emits day by day."""
    events = _closed_stream(spark, folder, ["event_id", "ts"]).withColumnRenamed("event_id", "request_id")
    found = _run_stream(spark, streaming.daily_candidates(events, QUOTA, delay="300 days"))
    return retrieval.admit_requests(found, QUOTA).select("request_id", _day("day"), "request_no")


@query
def parse_time(spark, folder):
    usable, _ = trends.split_unparsed(_articles(spark, folder))
    parsed = dates.parsed_time(usable, "published_at")
    return usable.select("doc_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query
def time_rejects(spark, folder):
    """Articles whose time cannot be read: here those not in English, which get a month 13."""
    time = F.when(F.col("query") != "en", F.regexp_replace("published_at", "-[0-9]{2}-", "-13-")).otherwise(F.col("published_at"))
    _, rejected = trends.split_unparsed(_articles(spark, folder).withColumn("published_at", time))
    return rejected.select("doc_id", "published_at")


@query
def time_filter(spark, folder):
    orders = trends.time_filter(views.table(spark, folder, "orders"), "o_orderdate", "1996-01-01", "1998-12-31")
    return orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


def _trend(df):
    return df.select(_day("bucket"), "label", r6("sentiment").alias("sentiment"), F.col("n").cast("long").alias("n"))


@query
def monthly_trend(spark, folder):
    return _trend(trends.sentiment_trend(_article_scores(spark, folder, "published_at")))


@query
def trend_daily(spark, folder):
    events = views.table(spark, folder, "events")
    return _trend(trends.sentiment_trend(events, "ts", "value", "D", "2024-01-01", "2024-02-15"))


@query
def trend_weekly(spark, folder):
    scores = _article_scores(spark, folder, "published_at")
    return _trend(trends.sentiment_trend(scores, freq="W", end_inclusive="day"))


@query
def trend_events(spark, folder):
    events = views.table(spark, folder, "events")
    return _trend(trends.sentiment_trend(events, "ts", "value"))


@query
def trend_orders(spark, folder):
    orders = views.table(spark, folder, "orders")
    return _trend(trends.sentiment_trend(orders, "o_orderdate", "o_totalprice", "ME", "1995-01-01", "2001-12-31"))
