import corpus_pipeline
from texttrend.llm import decontam, packing, quality, secrets, simhash
from texttrend.session import store


def test_every_stage_against_its_operator(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    columns = docs.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    stages = [f for _, f in corpus_pipeline.STAGES]

    good = store(stages[0](spark, docs, folder))
    assert ids(good) == ids(quality.score_documents(docs, labels).where("predicted = 1")) and good.columns == columns
    single = store(stages[1](spark, good, folder))
    assert ids(single) == sorted({r.component_id for r in simhash.near_duplicates(good).collect()}) and single.columns == columns
    clean = store(stages[2](spark, single, folder))
    leaked = {r.doc_id for r in decontam.contaminated(single, items).collect()}
    assert ids(clean) == [i for i in ids(single) if i not in leaked] and leaked and clean.columns == columns
    masked = store(stages[3](spark, clean, folder))
    assert ids(masked) == ids(clean) and masked.columns == columns
    assert secrets.scan_versions(masked, secrets.new_ledger(spark)).where("size(findings) > 0").count() == 0
    before, after = ({r.doc_id: r for r in t.collect()} for t in (clean, masked))
    assert all(after[i].n_chars == len(after[i].text) for i in after if before[i].text != after[i].text)
    packed = stages[4](spark, masked, folder).collect()
    whole = packing.pack_documents(masked).collect()
    assert sorted(r[:5] for r in packed) == sorted(r[:5] for r in whole) and {r.doc_id for r in packed} == set(ids(masked))
    ran = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r[:5] for r in ran) == sorted(r[:5] for r in packed)


def test_stages_take_edge_rows_and_empty_tables(spark, folder, edge_docs, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        for docs in (edge_docs, no_docs):
            out = stage(spark, docs, folder)
            rows = out.count()
            assert rows == 0 if docs is no_docs else rows > 0
            assert "doc_id" in out.columns


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert corpus_pipeline.run is names["pipeline"]
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
