"""Collecting search by search, with a ledger: failed searches are left out, kept on record, and run again alone."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import store
from .articles import CORRUPT_LINE, flatten_pages, split_pages
from .claims import publish_once, published

KEYS = ("query", "range_start")
FINISHED, FAILED, UNANSWERED = "finished", "failed", "unanswered"
LEDGER = "query string, range_start string, attempt int, status string, pages long, bad_pages long"


def with_search_keys(pages: DataFrame) -> DataFrame:
    """Fill the search of unreadable lines in from their text, as far as it is there."""
    if CORRUPT_LINE not in pages.columns:
        return pages

    def field(name: str):
        found = F.regexp_extract(CORRUPT_LINE, rf'"{name}"\s*:\s*"([^"]*)"', 1)
        return F.coalesce(F.col(name), F.when(F.col(CORRUPT_LINE).isNotNull() & (found != ""), found))

    return pages.withColumns({name: field(name) for name in KEYS})


class Collection:
    """Articles, ledger and rejected pages of all attempts below one folder.

    An attempt writes its tables under a name of its own and then commits them
    all at once; what a lost attempt wrote is never read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _attempts(self) -> list[str]:
        logged = published(self.spark, f"{self.path}/log/*.json")
        return [json.loads(self.spark.read.text(f"{self.path}/log/{n}").first()[0])["name"] for n in logged]

    def _read(self, table: str) -> DataFrame | None:
        names = self._attempts()
        return self.spark.read.parquet(*(f"{self.path}/{n}/{table}" for n in names)) if names else None

    def ledger(self) -> DataFrame:
        """One row per search and attempt: query, range_start, attempt, status, pages, bad_pages."""
        found = self._read("ledger")
        return self.spark.createDataFrame([], LEDGER) if found is None else found

    def articles(self) -> DataFrame | None:
        """Articles of all finished searches, each search once; None before the first attempt."""
        return self._read("articles")

    def rejects(self) -> DataFrame | None:
        """Rejected pages of all attempts, unreadable lines with their text."""
        return self._read("rejects")

    def pending(self, grid: DataFrame) -> DataFrame:
        """The searches of a grid (query, range_start) that no attempt has finished."""
        done = self.ledger().filter(F.col("status") == FINISHED).select(*KEYS)
        return grid.select("query", F.col("range_start").cast("string").alias("range_start")).distinct().join(done, list(KEYS), "left_anti")

    def run(self, grid: DataFrame, fetch: Callable[[DataFrame], DataFrame], limit: int | None = None, keep: tuple[str, ...] = (), **flatten_options) -> int:
        """Make one attempt at the pending searches (the first ``limit`` of them by query and date); returns its number.

        ``fetch`` gives the response pages of a table of searches, such as those
        landed for them. A search is finished if it was answered and all its pages
        can be read and report success; only then are its articles kept, so running
        it again doubles nothing. Every other search is recorded as failed or
        unanswered and is pending again, beside its rejected pages.
        """
        name = uuid.uuid4().hex
        folder = f"{self.path}/{name}"
        wanted = self.pending(grid)
        searches = store(wanted if limit is None else wanted.orderBy(*KEYS).limit(limit), f"{folder}/searches")
        pages = store(with_search_keys(fetch(searches)), f"{folder}/pages")
        ok = F.coalesce(F.col("status") == "OK", F.lit(False))
        answers = pages.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("pages"), F.count_if(~ok).alias("bad_pages"))
        status = F.when(F.col("pages").isNull(), UNANSWERED).when(F.col("bad_pages") > 0, FAILED).otherwise(FINISHED)
        number = len(self._attempts()) + 1
        ledger = searches.join(answers, list(KEYS), "left").select(
            *KEYS, F.lit(number).alias("attempt"), status.alias("status"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("pages", "bad_pages"))
        )
        ledger = store(ledger, f"{folder}/ledger")
        done = ledger.filter(F.col("status") == FINISHED).select(*KEYS)
        accepted = pages.join(done, list(KEYS), "left_semi")
        store(flatten_pages(accepted, keep=("range_start", *keep), **flatten_options), f"{folder}/articles")
        store(split_pages(pages)[1], f"{folder}/rejects")
        if not publish_once(self.spark, f"{self.path}/log/{number:06d}.json", {"name": name}):
            raise RuntimeError(f"attempt {number} was made by another writer; this one was not committed")
        return number
