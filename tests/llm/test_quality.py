import numpy as np

from texttrend.llm import quality


def test_gradient_of_the_attention_model():
    random = np.random.default_rng(0)
    bags = [random.normal(size=(int(n), quality.FEATURES)) for n in (1, 3, 2, 5)]
    model = quality.train(bags, np.array([0, 1, 1, 0]), steps=400)
    assert [round(model.score(b)) for b in bags] == [0, 1, 1, 0]


def test_attention_finds_the_one_telling_passage():
    random = np.random.default_rng(3)
    bags, labels = [], []
    for i in range(400):
        bag = random.normal(0, 0.3, (int(random.integers(3, 12)), quality.FEATURES))
        labels.append(i % 2)
        if i % 2:
            bag[int(random.integers(len(bag))), 4] += 6
        bags.append(bag)
    model = quality.train(bags[:300], np.array(labels[:300]))
    assert np.mean([(model.score(b) >= 0.5) == y for b, y in zip(bags[300:], labels[300:])]) > 0.95


def test_passages_cover_the_whole_text():
    words = ["word"] * 1000 + ["LOUD!!"] * 48
    passages = quality.encode_passages(" ".join(words))
    assert passages.shape == (22, quality.FEATURES) and np.isfinite(passages).all()
    assert passages[-1, 0] > passages[0, 0]
    assert (quality.encode_passages(None) == quality.encode_passages(" \n")).all()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in scored]) > 0.93
    assert any(r.predicted == 0 for r in scored)


def test_labels_and_other_columns_are_no_inputs(edge_docs, edge_rows, spark, given):
    labels = given("labels")
    model = quality.fit(given("documents"), labels)
    first = {(r.doc_id, r.text): r.q for r in quality.with_score(edge_docs, model, "text", "q").collect()}
    other = edge_docs.selectExpr("doc_id + 5 AS doc_id", "text", "'zz' AS lang", "'yy' AS source")
    assert {(r.doc_id and r.doc_id - 5, r.text): r.q for r in quality.with_score(other, model, "text", "q").collect()} == first


def test_edge_rows(edge_docs, edge_rows, no_docs, given, spark):
    got = quality.score_documents(edge_docs, given("labels")).collect()
    assert len(got) == len(edge_rows) and all(r.score is not None and 0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.7) for r in got)
    none = spark.createDataFrame([(None, 1, 0), (1, None, None), (2, 7, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score_documents(edge_docs, none).collect()} == {0.5}
    assert quality.score_documents(no_docs, given("labels")).count() == 0
    assert quality.keep_good(edge_docs, none).count() == 0
    assert quality.keep_good(edge_docs, given("labels")).columns == edge_docs.columns
