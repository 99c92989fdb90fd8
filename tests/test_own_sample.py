"""The whole job over a sample of its own, written and read as CSV, against plain Python."""

import math
import random
import statistics

import pytest
from test_search import brute_bm25, brute_tfidf, words

from texttrend.operators import index as ix
from texttrend.operators.corpus import build_corpus, with_doc_id
from texttrend.plans.analysis import run_analysis
from texttrend.schemas import ARTICLE, LEXICON
from texttrend.sources.articles import read_articles
from texttrend.sources.sinks import write_csv

QUERIES = ["storm damage", "market", "the market of the storm", "harvest"]
POLAR = {"good": 0.7, "calm": 0.3, "bad": -0.7, "loss": -0.4, "fine": 0.1}
PLAIN = ["storm", "damage", "market", "harvest", "city", "river", "the", "of", "a", "price"]


def articles(seed=8, n=40):
    draw = random.Random(seed)
    some = lambda k: " ".join(draw.choices([*PLAIN, *POLAR], weights=[4] * len(PLAIN) + [1] * len(POLAR), k=k))
    rows = []
    for i in range(n):
        title, content = some(draw.randint(1, 4)), some(draw.randint(5, 30))
        if i % 7 == 0:
            title = f'"{title}", he said'
        if i % 5 == 0:
            content = content.replace(" ", "\n", 1)
        description = None if i % 6 == 0 else f"see http://h{i}/x?y=1  {some(3)}"
        rows.append((draw.choice(QUERIES), "s", None, title, description, content, f"http://u/{i}", f"2024-{1 + i % 9:02d}-{1 + i % 28:02d}T00:00:00Z"))
    return rows


def plain_text(title, description, content):
    joined = ". ".join(x or "" for x in (title, description, content))
    return " ".join(w for w in joined.split() if not w.startswith("http://"))


def plain_score(text):
    polar = [POLAR[w] for w in words(text) if w in POLAR]
    return round(sum(polar) / len(polar), 9) if polar else 0.0


def best(scores, k=5):
    """The k best by score, ties by the higher id."""
    return sorted(scores.items(), key=lambda s: (round(s[1], 9), s[0]), reverse=True)[:k]


@pytest.fixture(scope="module")
def rows():
    return articles()


@pytest.fixture(scope="module")
def landed(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("own") / "csv")
    write_csv(spark.createDataFrame(rows, ARTICLE), path)
    return read_articles(spark, path)


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame([(w, p, None, "polar") for w, p in POLAR.items()], LEXICON)


def test_the_job_matches_plain_python(spark, rows, landed, lexicon, tmp_path):
    job = run_analysis(landed, str(tmp_path), "2024-12-31", lexicon=lexicon, queries=QUERIES, k=5)
    stored = {r.url: r for r in job.corpus.collect()}
    want = {r[6]: plain_text(*r[3:6]) for r in rows}
    assert {u: r.text for u, r in stored.items()} == want
    score = {u: plain_score(t) for u, t in want.items()}
    assert {u: r.sentiment for u, r in stored.items()} == pytest.approx(score)

    values, n = list(score.values()), len(rows)
    shares = sum(v > 0.1 for v in values) / n, sum(v < -0.1 for v in values) / n, sum(-0.1 <= v <= 0.1 for v in values) / n
    assert tuple(job.distribution.first()) == pytest.approx((statistics.mean(values), statistics.stdev(values), *shares))

    months = {}
    for r in rows:
        months.setdefault(r[7][:7], []).append(score[r[6]])
    got = {r.label: r.sentiment for r in job.trend.collect()}
    assert len(got) == 12 and {m: v for m, v in got.items() if v is not None} == pytest.approx({m: statistics.mean(v) for m, v in months.items()})

    docs, asked = {r.doc_id: r.text for r in stored.values()}, {r.doc_id: r.query for r in stored.values()}
    for ranker, brute in (("tfidf", brute_tfidf), ("bm25", brute_bm25)):
        report = {r.query: (r.precision_at_k, r.ndcg, r.mrr) for r in job.ranking.filter(f"ranker = '{ranker}'").collect()}
        sums = []
        for q in QUERIES:
            rel = [float(q in asked[d] or asked[d] in q) for d, _ in best(brute(docs, q))]
            gain = lambda xs: sum(x / math.log2(i + 2) for i, x in enumerate(xs))
            ideal = gain(sorted(rel, reverse=True))
            sums.append((sum(rel) / 5, gain(rel) / ideal if ideal else 0.0, next((1 / (i + 1) for i, x in enumerate(rel) if x), 0.0)))
            assert report[q] == pytest.approx(sums[-1])
        assert report[None] == pytest.approx(tuple(statistics.mean(x) for x in zip(*sums)))


def test_the_scored_column_can_be_chosen(rows, landed, lexicon, tmp_path):
    job = run_analysis(landed, str(tmp_path), "2024-12-31", lexicon=lexicon, queries=QUERIES[:1], k=5, text="title")
    assert {r.url: r.sentiment for r in job.corpus.collect()} == pytest.approx({r[6]: plain_score(r[3]) for r in rows})


def test_index_statistics(landed):
    corpus = build_corpus(with_doc_id(landed)).select("doc_id", "text")
    index = ix.fit_index(corpus)
    tokens = [words(r.text) for r in corpus.collect()]
    assert (index.n_tokens, index.n_terms) == (sum(map(len, tokens)), len({w for t in tokens for w in t}))
    assert index.average_length == pytest.approx(index.n_tokens / len(tokens))


def test_files_of_an_index_stay_large():
    for power in range(3, 15):
        parts, buckets = ix.postings_layout(10**power)
        assert ix.LEAST_PARTS <= parts <= ix.MOST_PARTS and ix.LEAST_BUCKETS <= buckets <= ix.MOST_BUCKETS
        if 10**power >= ix.LEAST_PARTS * ix.LEAST_BUCKETS * ix.FILE_TOKENS:
            assert 10**power / (parts * buckets) >= ix.FILE_TOKENS  # never many small files
            assert 10**power / (parts * buckets) < 2 * ix.FILE_TOKENS or parts == ix.MOST_PARTS
