import random
import re

import pytest
from pyspark.sql import functions as F

from texttrend.functions import text
from texttrend.operators.corpus import build_corpus, with_doc_id

SPACES = "  　\u0085\u001c \t\n"


def clean(t):
    return re.sub(r"\s+", " ", re.sub(r"http\S+", "", t)).strip()


def test_blank_articles_survive_and_all_url_rows_drop(frame):
    rows = [
        (1, "", None, ""),
        (2, "http://a", "http://b", "http://c"),
        (3, "http://a", "text", ""),
        (4, " http", "x", "y"),
    ]
    got = build_corpus(frame(rows, "doc_id long, title string, description string, content string"))
    want = {}
    for i, *parts in rows:
        joined = clean(". ".join(p or "" for p in parts))
        if joined:
            want[i] = joined
    assert {r.doc_id: r.text for r in got.collect()} == want
    assert want[1] == ". ." and 2 not in want


@pytest.mark.parametrize(
    "raw, cleaned",
    [("HTTP://x y", "HTTP://x y"), ("xhttpfoo", "x"), ("see http", "see http"), (None, ""), ("a  b\u001cc", "a b c")],
)
def test_clean_text_edges(frame, raw, cleaned):
    assert frame([(raw,)], "t string").select(text.clean_text("t")).first()[0] == cleaned


def test_clean_and_tokens_agree_with_python_on_random_text(frame):
    rng = random.Random(7)
    alphabet = ["http", "://", "a", "É", "_", "9", "²", ".", "’", "中", *SPACES]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 25))) for _ in range(500)]
    df = frame([(t,) for t in texts], "t string").select("t", text.clean_text("t").alias("c"), text.tokenize("t").alias("w"))
    for row in df.collect():
        assert row.c == clean(row.t)
        assert row.w == re.findall(r"\b\w+\b", row.t.lower())


def test_tokens(frame):
    words = frame([("Café déjà_vu 2²½ A.I. naïve’s",)], "t string").select(text.tokenize("t")).first()[0]
    assert words == ["café", "déjà_vu", "2²½", "a", "i", "naïve", "s"]


def test_truncation_counts_characters(frame):
    row = frame([("é" * 3000,)], "t string").select(F.length(text.truncate_text("t"))).first()
    assert row[0] == 2048


def test_doc_id_is_stable_and_distinct(frame):
    df = frame([("q", "u1", "t"), ("q", "u2", None), ("q", "u1", "t2")], "query string, url string, published_at string")
    first = [r.doc_id for r in with_doc_id(df).orderBy("url", "published_at").collect()]
    again = [r.doc_id for r in with_doc_id(df.repartition(3)).orderBy("url", "published_at").collect()]
    assert first == again and len(set(first)) == 3


def test_no_two_rows_share_an_id(frame):
    rows = [("q", "", "", "a"), ("q", "", "", "b"), ("q", "", "", "b"), ("q", None, "", "b"), ("q", "", None, "c")]
    df = frame(rows, "query string, url string, published_at string, title string")
    ids = {(r.url, r.published_at, r.title, r.doc_id) for r in with_doc_id(df).collect()}
    assert len(ids) == len({i[-1] for i in ids}) == 5
    assert ids == {(r.url, r.published_at, r.title, r.doc_id) for r in with_doc_id(df.repartition(4)).collect()}
