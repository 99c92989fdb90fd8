import threading

import pytest
from pyspark.sql import functions as F

from texttrend.sources import claims, sinks


def in_threads(n, work):
    """Run ``work(i)`` in n threads that start together; results in order, the first error raised."""
    out, errors, start = [None] * n, [], threading.Barrier(n)

    def run(i):
        start.wait()
        try:
            out[i] = work(i)
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(n)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
    return out


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}/out"


def test_one_writer_publishes(spark, root):
    won = in_threads(12, lambda i: claims.publish_once(spark, f"{root}/entry.json", {"writer": i}))
    assert sum(won) == 1
    rows = claims.read_published(spark, f"{root}/entry.json", "writer int").collect()
    assert [r.writer for r in rows] == [won.index(True)]
    assert claims.published(spark, f"{root}/*") == ["entry.json"]


def test_nothing_published(spark, root):
    assert claims.published(spark, f"{root}/*.json") == []
    assert claims.read_published(spark, f"{root}/*.json", "a int").count() == 0


def test_two_writers_get_two_numbers(spark, root):
    paths = in_threads(4, lambda i: sinks.write_run(spark.range(i + 1), root, "numbers", "2024-05-06"))
    assert sorted(p.rsplit("=", 1)[1] for p in paths) == ["001", "002", "003", "004"]
    for i, path in enumerate(paths):
        assert spark.read.parquet(path).count() == i + 1
    table = sinks.runs_table(spark, root, "numbers").collect()
    assert sorted((r.run_seq, str(r.run_date), r.finished) for r in table) == [(i, "2024-05-06", True) for i in range(1, 5)]
    assert len({r.owner for r in table}) == 4


def test_unfinished_and_unclaimed_runs_keep_their_numbers(spark, root):
    assert sinks.claim_run(spark, root, "numbers", "2024-05-06") == 1  # its writer is lost here
    spark.range(1).write.parquet(sinks.run_path(root, "numbers", "2024-05-06", 5))  # written by other means
    assert sinks.write_run(spark.range(1), root, "numbers", "2024-05-06").endswith("run_seq=006")
    assert sinks.write_run(spark.range(1), root, "numbers", "2024-05-07").endswith("run_seq=001")
    table = sinks.runs_table(spark, root, "numbers").orderBy("run_date", "run_seq").collect()
    assert [(r.run_seq, r.finished) for r in table] == [(1, False), (6, True), (1, True)]
    assert sinks.list_runs(spark, root, "numbers").filter(F.col("run_seq") == 6).count() == 1


def test_a_run_is_finished_once(spark, root):
    number = sinks.claim_run(spark, root, "numbers", "2024-05-06", "me")
    sinks.finish_run(spark, root, "numbers", "2024-05-06", number, "me")
    with pytest.raises(ValueError):
        sinks.finish_run(spark, root, "numbers", "2024-05-06", number, "other")
