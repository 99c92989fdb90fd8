import json

import pytest

from texttrend.operators.retrieval import append_searches, tag_search
from texttrend.plans import views
from texttrend.plans.analysis import collect_articles, run_analysis
from texttrend.schemas import ARTICLE, ARTICLE_COLUMNS
from texttrend.sources import articles as src
from texttrend.sources import sinks

ROW = ("q", "s", None, 'He said "hi", twice', "line\nbreak", "", "http://u/1", "2024-02-03T04:05:06Z")


def test_csv_round_trip(spark, frame, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_csv(frame([ROW], ARTICLE), path)
    back = src.read_articles(spark, path)
    row = back.first()
    assert back.columns == list(ARTICLE_COLUMNS) and row.title == ROW[3] and row.description == ROW[4]
    assert row.author is None and row.published_at == ROW[7]


def page(status="OK", docs=(), query="q", number=0, hits=None):
    body = {"query": query, "range_start": "2024-01-01", "page": number, "status": status, "response": {"docs": list(docs)}}
    if hits is not None:
        body["response"]["meta"] = {"hits": hits}
    return json.dumps(body)


@pytest.fixture
def landed(spark, tmp_path):
    docs = [
        {"headline": {"main": "T"}, "byline": {"original": "By A"}, "snippet": "S", "web_url": "U", "pub_date": "D", "more": 1},
        {"headline": {"main": "T2"}, "byline": None, "web_url": "U2"},
    ]
    lines = [page(docs=docs, hits=7), page(docs=[]), page(docs=docs, number=1, hits=9), page("ERROR", docs, "bad"), page(docs=[], query="none"), "{broken"]
    (tmp_path / "pages.json").write_text("\n".join(lines))
    return str(tmp_path / "pages.json")


def test_flatten_pages(spark, landed):
    pages = src.read_pages(spark, landed)
    rows = src.flatten_pages(pages, source="X").collect()
    assert len(rows) == 4 and {r.query for r in rows} == {"q"} and {r.source for r in rows} == {"X"}
    full, bare = (next(r for r in rows if r.title == t) for t in ("T", "T2"))
    assert (full.author, full.description, full.content, full.url, full.published_at) == ("By A", "S", "S", "U", "D")
    assert (bare.author, bare.description, bare.content, bare.published_at) == ("", "", "", "")


def test_rejects_and_hits(spark, landed):
    pages = src.read_pages(spark, landed)
    accepted, rejected = src.split_pages(pages)
    assert accepted.count() == 4 and rejected.count() == 2
    assert {(r.query, r.total_hits) for r in src.total_hits(pages).collect()} == {("q", 7), ("none", 0)}
    strict, _ = src.split_pages(pages, on_error="fail")
    with pytest.raises(Exception, match="search response status"):
        strict.collect()
    for look in (lambda df: df.count(), lambda df: df.select("query").collect()):
        with pytest.raises(Exception, match="search response status"):
            look(strict)
    with pytest.raises(Exception, match="search response status"):
        src.flatten_pages(pages, on_error="fail").select("query").collect()
    with pytest.raises(Exception, match="search response status"):
        src.total_hits(pages, on_error="fail").count()
    with pytest.raises(Exception):
        src.read_pages(spark, landed, on_error="fail").collect()


def test_tags_append_with_duplicates(frame):
    df = frame([("u",)], "url string")
    both = append_searches(tag_search(df, "a"), tag_search(df, "b"), tag_search(df, "b"))
    assert sorted(r.query for r in both.collect()) == ["a", "b", "b"]


def test_runs_are_numbered_after_the_highest(spark, frame, tmp_path):
    root, df = str(tmp_path), frame([(1,)], "x int")
    first = sinks.write_run(df, root, "articles", "2024-05-06")
    second = sinks.write_run(df, root, "articles", "2024-05-06")
    assert first.endswith("run_date=20240506/run_seq=001") and second.endswith("run_seq=002")
    assert sinks.write_run(df, root, "articles", "2024-05-07").endswith("run_date=20240507/run_seq=001")
    runs = frame([("a", "2024-05-06", 7), ("a", "2024-05-06", 3), ("a", "2024-05-06", 1204)], "name string, run_date string, run_seq int")
    row = sinks.next_runs(runs.selectExpr("name", "date(run_date) AS run_date", "run_seq")).first()
    assert (row.run_seq, row.run_name) == (1205, "a_20240506_1205")


def test_empty_guard(frame):
    df = frame([(1,)], "x int")
    assert sinks.assert_not_empty(df) is df
    with pytest.raises(ValueError):
        sinks.assert_not_empty(df.filter("false"))


def test_whole_job(spark, folder, tmp_path):
    archive = views.articles(views.documents(spark, folder))
    queries = ["the", "no", "license"]
    found = collect_articles(archive, queries, page_size=5)
    job = run_analysis(found, str(tmp_path), "2024-12-31", lexicon=views.lexicon(spark), queries=queries, k=5)
    assert job.corpus.count() == spark.read.parquet(job.articles_path).count() > 0
    assert job.trend.count() == 12 and job.distribution.count() == 1
    assert {(r.ranker, r.query) for r in job.ranking.collect()} == {(m, q) for m in ("bm25", "tfidf") for q in [*queries, None]}
    again = run_analysis(found, str(tmp_path), "2024-12-31", lexicon=views.lexicon(spark), queries=queries, k=5)
    assert again.corpus_path.endswith("run_seq=002")
