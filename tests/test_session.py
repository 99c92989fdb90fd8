from texttrend.schemas import LEXICON
from texttrend.session import is_small, shared_folder, small_table, store


def test_store_cuts_lineage_and_keeps_rows(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    kept = store(df)
    assert sorted(map(tuple, kept.collect())) == [(i, 2 * i) for i in range(10)]
    assert kept.inputFiles()[0].split("texttrend")[0].removeprefix("file:").rstrip("/").endswith(
        shared_folder(spark).removeprefix("file:").rstrip("/").split("texttrend")[0].rstrip("/"))
    assert store(df, str(tmp_path / "t")).count() == 10


def test_small_tables_have_a_known_size(spark):
    df = small_table(spark, [("a", 1.0, None, "polar")], LEXICON)
    assert "LocalRelation" in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.first().term == "a" and small_table(spark, [], LEXICON).isEmpty()
    assert is_small(df, 1) and not is_small(spark.range(5), 4)
