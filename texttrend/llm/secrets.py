"""Secret scans with an incremental ledger of content-addressed versions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..session import shared_folder
from .common import filled, packed
from .matching import Rule, between, joined, let, running, segments

# The base rules, then the ones this method adds.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        valid=lambda m, g: F.length(g) >= 6,
        sql="length({g}) >= 6",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", hint="AKIA", valid=lambda m, g: F.length(m) >= 20, sql="length({m}) >= 20"),
    # Runs are taken whole, so asking for 24 characters at once drops the same runs as a later test would.
    Rule("hex", r"[0-9a-f]{24,}", fast=r"(?<![0-9a-f])[0-9a-f]{24,}+"),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint="PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}", hint="gh"),
    Rule("chat_host", r"xox[abprs]-[A-Za-z0-9-]{10,}", hint="xox"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint="eyJ"),
)
RULES = BASE + ADDED
VERSION = "1"
FINDINGS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def findings(text: F.Column, rules: tuple[Rule, ...] = RULES) -> F.Column:
    """All spans of a text, by start, then in the order of the rules."""

    def ranked(rank: int, rule: Rule) -> F.Column:
        return F.transform(
            rule.found(text),
            lambda x: F.struct(
                x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(rule.kind).alias("kind")
            ),
        )

    kinds = [ranked(rank, rule) for rank, rule in enumerate(rules)]
    return F.array_sort(F.concat(*kinds).cast(FINDINGS))


class BlobLedger:
    """What has been scanned: a Parquet folder of (blob, rule_version, findings), only ever appended to."""

    def __init__(self, spark, path: str):
        self._spark, self.path = spark, path

    def entries(self, rule_version: str) -> DataFrame:
        """(blob, findings) of one rule version, one row per blob."""
        schema = f"blob string, findings {FINDINGS}, rule_version string"
        try:
            rows = self._spark.read.schema(schema).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self._spark.createDataFrame([], schema)
        return rows.where(F.col("rule_version") == rule_version).select("blob", "findings").dropDuplicates(["blob"])

    def add(self, scanned: DataFrame, rule_version: str) -> None:
        """Append scanned blobs; a job that fails leaves the ledger as it was."""
        scanned.withColumn("rule_version", F.lit(rule_version)).write.mode("append").partitionBy("rule_version").parquet(self.path)


def address(text: F.Column) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


def scan_versions(
    versions: DataFrame, ledger: BlobLedger, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, rule_version: str = VERSION
) -> DataFrame:
    """(id, blob, findings) of every version, scanning only blobs that the ledger lacks for this rule version.

    Every text is addressed by its SHA-256; equal texts meet in one row per task
    before they are shuffled, so a hot group of copies is scanned once and moved
    little. Findings are joined back to all paths (a join that adaptive
    execution can split). NULL texts count as empty; repeated rows and NULL ids
    come back as often as they occur; an empty table gives no rows; other
    columns are not read.
    """
    text = filled(text_col)
    paths = versions.select(F.col(id_col).alias("doc_id"), address(text).alias("blob"))
    blobs = versions.select(address(text).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    unseen = blobs.join(ledger.entries(rule_version).select("blob"), "blob", "left_anti")
    ledger.add(unseen.select("blob", findings(F.col("text"), rules).alias("findings")), rule_version)
    return paths.join(ledger.entries(rule_version), "blob").select("doc_id", "blob", "findings")


def new_ledger(spark) -> BlobLedger:
    """An empty ledger in the shared folder."""
    return BlobLedger(spark, f"{shared_folder(spark).rstrip('/')}/texttrend/ledger-{uuid.uuid4().hex}")


def digest(scanned: DataFrame) -> DataFrame:
    """The findings of each version as counts, a digest of the base spans, and all spans."""
    base = F.filter("findings", lambda x: x["rank"] < len(BASE))

    def count(rank: int) -> F.Column:
        return F.size(F.filter("findings", lambda x: x["rank"] == rank)).cast("long")

    counts = [count(k).alias(f"n_{rule.kind}") for k, rule in enumerate(BASE)]
    return scanned.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def _masked(text: F.Column, spans: F.Column, mask: str) -> F.Column:
    """A text with its spans (by start) replaced, overlapping ones as one: the parts between them are joined once."""
    upto = running(spans, F.lit(0), lambda at, x: F.greatest(at, x["end"]), "int")

    def joined_up(pieces: F.Column, ends: F.Column) -> F.Column:
        before = lambda i: F.coalesce(F.get(ends, i - 1), F.lit(0))
        parts = F.transform(spans, lambda x, i: F.when(x["start"] >= before(i), F.concat(between(pieces, before(i), x["start"]), F.lit(mask))))
        rest = between(pieces, F.element_at(ends, -1), F.length(text))
        return F.concat(F.array_join(parts, ""), rest)

    return let(segments(text), lambda pieces: let(upto, lambda ends: joined_up(pieces, ends)))


def redact(versions: DataFrame, ledger: BlobLedger, id_col: str = "doc_id", text_col: str = "text", mask: str = "<secret>", length_col: str | None = None) -> DataFrame:
    """``versions`` with every found span replaced by ``mask``; texts without findings are untouched.

    Overlapping spans are masked as one. Texts with findings meet their spans by
    blob; all columns and all rows are kept. ``length_col`` is set to the new
    length of the texts that change.
    """
    hits = (
        scan_versions(versions, ledger, id_col, text_col)
        .where(F.size("findings") > 0)
        .groupBy("blob")
        .agg(F.first("findings").alias("findings"))
    )
    content = filled(text_col)
    rows = versions.select(packed(versions), content.alias("content"), address(content).alias("blob")).join(hits, "blob", "left")
    rows = rows.withColumn("masked", F.when(F.col("findings").isNotNull(), _masked(F.col("content"), F.col("findings"), mask)))
    changed = {text_col: F.coalesce("masked", f"_row.`{text_col}`")}
    if length_col:
        kind = versions.schema[length_col].dataType
        changed[length_col] = F.coalesce(F.length("masked").cast(kind), f"_row.`{length_col}`")
    return rows.select(*(changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in versions.columns))


def _oracle() -> str:
    from .matching import duckdb_found

    parts = [
        f"list_transform({duckdb_found(rule, 't')}, lambda x: struct_pack(start := x.\"end\" - length(x.m), rank := {k}, \"end\" := x.\"end\", kind := '{rule.kind}'))"
        for k, rule in enumerate(RULES)
    ]
    text = "array_to_string(list_transform({}, lambda x: x.kind || ':' || x.start || ':' || x.\"end\"), ',')"
    counts = ", ".join(f"len(list_filter(f, lambda x: x.rank = {k}))::BIGINT AS n_{rule.kind}" for k, rule in enumerate(BASE))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, list_sort(list_concat({", ".join(parts)})) AS f FROM d)
SELECT doc_id, {counts},
  sha256(coalesce({text.format(f"list_filter(f, lambda x: x.rank < {len(BASE)})")}, '')) AS base_sha256,
  coalesce({text.format("f")}, '') AS spans
FROM s"""


ORACLE_SQL = _oracle()
