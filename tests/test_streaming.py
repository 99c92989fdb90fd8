from pyspark.sql import functions as F

from texttrend.operators.trends import sentiment_trend
from texttrend.plans import views
from texttrend.streaming import trend


def run(stream, tmp_path, name):
    query = (
        stream.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.table(name)


def test_streamed_days_equal_batch(spark, folder, tmp_path):
    events = views.table(spark, folder, "events")
    source = str(tmp_path / "in")
    events.select("event_id", "ts", "value").repartition(3).write.parquet(source)
    stream = spark.readStream.schema("event_id long, ts timestamp_ntz, value double").parquet(source)
    days = run(trend.daily_sums(stream, "ts", "value"), tmp_path, "days")
    batch = events.groupBy(F.to_date("ts").alias("day")).agg(F.sum("value").alias("total"), F.count("value").alias("n"))
    want = {r.day: (round(r.total, 6), r.n) for r in batch.collect()}
    got = {r.day: (round(r.total, 6), r.n) for r in days.collect()}
    # The newest days wait for the watermark; the emitted ones are final.
    assert len(got) >= len(want) - 4 and got == {d: want[d] for d in got}
    month = trend.monthly_means(batch).first()
    january = next(r for r in sentiment_trend(events, "ts", "value").collect() if r.label == month.label)
    assert month.n == january.n and abs(month.sentiment - january.sentiment) < 1e-9


def test_streamed_dedup(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("u", "2024-01-01T00:00:00Z"), ("u", "2024-01-01T01:00:00Z"), ("v", "2024-01-01T02:00:00Z")]
    spark.createDataFrame(rows, "url string, published_at string").write.parquet(source)
    stream = spark.readStream.schema("url string, published_at string").parquet(source)
    assert sorted(r.url for r in run(trend.dedup_stream(stream), tmp_path, "urls").collect()) == ["u", "v"]


def landed(spark, df, closing, source):
    """A folder of files in order of arrival, the last of them far later, which closes what came before."""
    for i, rows in enumerate((df.filter("id % 3 = 0"), df.filter("id % 3 > 0"), closing)):
        rows.coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)


def test_streamed_months_equal_batch(spark, tmp_path):
    import random

    from texttrend.operators import states, trends

    draw = random.Random(3)
    rows = [(i, f"2024-{draw.randint(1, 4):02d}-{draw.randint(1, 28):02d}T10:00:00Z", draw.choice([None, draw.uniform(-1, 1)])) for i in range(300)]
    rows += [(301, "2024-01-31T23:59:59Z", 0.5), (302, "2024-02-29T23:59:59Z", -0.5), (303, None, 1.0), (304, "unreadable", 1.0)]
    scored = spark.createDataFrame(rows, "id long, published_at string, sentiment double")
    closing = spark.createDataFrame([(999, "2025-06-01T00:00:00Z", None)], scored.schema)
    stream = trend.monthly_states(landed(spark, scored, closing, str(tmp_path / "in")), delay="200 days", salts=4)
    trend.run_to_end(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    kept = spark.read.parquet(str(tmp_path / "out")).filter("day < DATE '2025-01-01'")
    assert kept.count() <= 4 * 4
    span = {"start": "2024-01-01", "end": "2024-04-30"}
    want = trends.sentiment_trend(scored, end_inclusive="day", **span)
    digits = lambda df: [(str(r.bucket), round(r.sentiment, 9), r.n) for r in df.orderBy("bucket").collect()]
    assert digits(states.trend_of(kept, **span)) == digits(want)
    whole = lambda df: [round(v, 9) for v in df.first()]
    assert whole(states.distribution_of(kept)) == whole(trends.sentiment_distribution(scored.filter("published_at LIKE '2024%'")))


def test_streamed_admission_equals_batch(spark, tmp_path):
    from texttrend.operators import retrieval

    log = spark.range(400).selectExpr("id", "id AS request_id", "timestamp_seconds(1704067200 + pmod(xxhash64(id), 3 * 86400)) AS ts")
    closing = spark.range(1).selectExpr("id", "CAST(NULL AS LONG) AS request_id", "TIMESTAMP '2024-09-01' AS ts")
    stream = trend.daily_candidates(landed(spark, log, closing, str(tmp_path / "in")), 17, delay="30 days", salts=3)
    trend.run_to_end(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    kept = spark.read.parquet(str(tmp_path / "out"))
    assert kept.count() == 3 * 3 * 17
    rows = lambda df: sorted((r.request_id, str(r.day), r.request_no) for r in retrieval.admit_requests(df, 17).collect())
    assert rows(kept) == rows(log)
