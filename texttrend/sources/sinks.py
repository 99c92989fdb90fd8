"""Writing tables, numbered run outputs, and the guard against empty results."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .claims import publish_once, published, read_published

CLAIM = "name string, run_date string, run_seq int, owner string, state string"


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV with a header and doubled quotes, a part file per task."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("quoteAll", False).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "error") -> None:
    """The default sink. Partition articles by month to prune later range reads."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def run_label(sequence: Column) -> Column:
    """Three-digit run number; longer numbers keep all digits."""
    return F.format_string("%03d", sequence)


def next_runs(runs: DataFrame) -> DataFrame:
    """The next run number of each (name, run_date), one above the highest taken.

    The highest, not the count: after a run is removed the count would name an
    existing one.
    """
    last = runs.groupBy("name", "run_date").agg(F.max("run_seq").alias("last_seq"))
    following = F.col("last_seq") + 1
    label = F.concat_ws("_", "name", F.date_format("run_date", "yyyyMMdd"), run_label(following))
    return last.select("name", "run_date", following.alias("run_seq"), label.alias("run_name"))


def list_runs(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(name, run_date, run_seq) of the outputs below ``root``; only folder names are read."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}/run_date=*/run_seq=*")
    found = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jvm_path) or []
    rows = []
    for status in found:
        path = status.getPath()
        rows.append((name, path.getParent().getName().split("=")[1], int(path.getName().split("=")[1])))
    taken = spark.createDataFrame(rows, "name string, run_date string, run_seq int")
    return taken.withColumn("run_date", F.to_date("run_date", "yyyyMMdd"))


def _claims(root: str, name: str, run_date: str) -> str:
    return f"{root.rstrip('/')}/{name}/_claims/run_date={run_date.replace('-', '')}"


def claim_run(spark: SparkSession, root: str, name: str, run_date: str, owner: str | None = None) -> int:
    """Take the next run number of a day for this writer alone.

    The number above all taken ones is tried first; if another writer publishes
    the same claim before, the next number is, until one is free. Folders
    written without a claim count as taken, numbers of removed runs stay taken.
    """
    owner, folder = owner or uuid.uuid4().hex, _claims(root, name, run_date)
    written = list_runs(spark, root, name).filter(F.col("run_date") == F.lit(run_date).cast("date")).agg(F.max("run_seq")).first()[0] or 0
    claimed = [int(n.split(".")[0]) for n in published(spark, f"{folder}/*.claimed.json")]
    number = max([written, *claimed]) + 1
    day = date.fromisoformat(run_date).isoformat()
    while not publish_once(spark, f"{folder}/{number:03d}.claimed.json", {"name": name, "run_date": day, "run_seq": number, "owner": owner, "state": "claimed"}):
        number += 1
    return number


def finish_run(spark: SparkSession, root: str, name: str, run_date: str, number: int, owner: str) -> None:
    """Mark a run as written; fails if it is marked already."""
    entry = {"name": name, "run_date": run_date, "run_seq": number, "owner": owner, "state": "finished"}
    if not publish_once(spark, f"{_claims(root, name, run_date)}/{number:03d}.finished.json", entry):
        raise ValueError(f"run {number} of {name} on {run_date} is finished already")


def runs_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(name, run_date, run_seq, owner, finished): every claimed run, one row each.

    A run that is not finished is being written, or its writer was lost; its
    folder must not be read.
    """
    entries = read_published(spark, f"{root.rstrip('/')}/{name}/_claims/run_date=*/*.json", CLAIM)
    runs = entries.groupBy("name", F.col("run_date").cast("date").alias("run_date"), "run_seq")
    return runs.agg(F.max("owner").alias("owner"), F.max(F.col("state") == "finished").alias("finished"))


def run_path(root: str, name: str, run_date: str, number: int) -> str:
    return f"{root.rstrip('/')}/{name}/run_date={run_date.replace('-', '')}/run_seq={number:03d}"


def write_run(df: DataFrame, root: str, name: str, run_date: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write below ``root/name/run_date=YYYYMMDD/run_seq=NNN`` and return that folder.

    ``run_date`` is YYYY-MM-DD. The number is claimed before anything is
    written, so writers at the same time get different folders, and the run is
    marked as finished after. An existing folder is an error, never overwritten.
    """
    spark, owner = df.sparkSession, uuid.uuid4().hex
    number = claim_run(spark, root, name, run_date, owner)
    path = run_path(root, name, run_date, number)
    write_parquet(df, path, partition_by)
    finish_run(spark, root, name, run_date, number, owner)
    return path


def assert_not_empty(df: DataFrame, what: str = "articles") -> DataFrame:
    """Return ``df``, or fail when it has no rows (reads at most one)."""
    if df.isEmpty():
        raise ValueError(f"no {what} collected")
    return df
