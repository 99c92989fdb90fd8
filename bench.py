"""Time the headline queries: one JSON line, seconds per query (best of two runs, results discarded).

``fit_index`` is the time to store the index; the searches then run over that
one index, as a user fits once and searches often. ``rank_compare`` fits its own.
``more`` is not part of the total: searches that fit an index each, and searches
by score bounds over blocks fitted beforehand.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from texttrend.operators import bounds, index, search
from texttrend.plans import views
from texttrend.plans.catalog import QUERIES, SEARCH_QUERIES
from texttrend.session import local_session

HEADLINE = (
    "monthly_trend",
    "sentiment_distribution",
    "annotate_sentiment",
    "vocabulary",
    "tfidf_weights",
    "rank_compare",
    "classification_report",
    "search_whole",
    "dedup",
    "flatten_json",
    "quota_admit",
    "evaluate_ranking",
    "trend_orders",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    timings = {}

    def best(name, run):
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            result = run()
            if isinstance(result, DataFrame):
                result.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(min(runs), 3)
        return result

    for name in HEADLINE:
        best(name, lambda: QUERIES[name](spark, folder))
    stored = best("fit_index", lambda: index.fit_index(views.documents(spark, folder)))
    items = views.table(spark, folder, "benchmark").selectExpr("item_id AS query_id", "text AS query")
    for name, ranker in search.RANKERS.items():
        best(f"{name}_search", lambda: ranker(stored, SEARCH_QUERIES))
        best(f"{name}_benchmark", lambda: ranker(stored, items))
    total, headline = round(sum(timings.values()), 3), list(timings)
    for name in ("tfidf_search", "bm25_search"):
        best(f"{name}_single", lambda: QUERIES[name](spark, folder))
    blocks = best("fit_bounds", lambda: bounds.fit_bounds(stored))
    for name in search.RANKERS:
        best(f"{name}_bounded", lambda: bounds.bounded_search(blocks, SEARCH_QUERIES, name).results)
    spark.stop()
    more = {name: timings.pop(name) for name in list(timings) if name not in headline}
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": timings, "more": more, "sf": scale}))


if __name__ == "__main__":
    main()
