"""Chat formatting of logged conversations, snapshots of longer ones left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .matching import running

# How a turn is rendered, and what separates the parts of a turn's key.
TURN = "<|im_start|>{role}\n{text}<|im_end|>\n"
UNIT = "\x1f"


def turn_table(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per conversation: its turns in order as an array of (role, text).

    Order is the turn number (NULL first), then role and text; NULL roles and
    texts count as empty. A conversation is gathered whole, as its rendering
    must be.
    """
    return (
        turns.select(
            F.col(conv).alias("conv_id"),
            F.struct(
                F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
            ).alias("t"),
        )
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("t")).alias("turns"))
    )


def prefix_hashes(turns: str) -> F.Column:
    """SHA-256 of every turn prefix: each is the hash of the one before and the next turn."""

    def extend(before, t):
        return F.sha2(F.concat_ws(UNIT, before, F.sha2(t["role"], 256), F.sha2(t["text"], 256)), 256)

    return running(F.col(turns), F.lit(""), extend, "string")


def maximal_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns) of the conversations that are no proper prefix of another, and one of each set of equal ones.

    A rolling hash identifies every prefix. The hash of a whole conversation is
    looked up among the proper prefixes of all others (distinct per task before
    they are shuffled, so a common first turn is one row), and an anti-join
    keeps those not found. Of equal conversations the smallest id stays. Rows
    that repeat a turn count as turns; the rows without a conversation id form
    one conversation; an empty table gives no rows; other columns are not read.
    """
    hashed = turn_table(turns, conv, turn, role, text).withColumn("_prefixes", prefix_hashes("turns"))
    whole = hashed.select("conv_id", "turns", F.element_at("_prefixes", -1).alias("_whole"))
    proper = (
        hashed.select(F.explode(F.slice("_prefixes", F.lit(1), F.greatest(F.size("_prefixes") - 1, F.lit(0)))).alias("_whole")).distinct()
    )
    kept = (
        whole.select("conv_id", "_whole")
        .groupBy("_whole")
        .agg(F.min("conv_id").alias("conv_id"))
        .join(proper, "_whole", "left_anti")
        .select("conv_id", F.col("_whole").alias("_kept"))
    )
    return whole.join(kept, whole["conv_id"].eqNullSafe(kept["conv_id"]) & (F.col("_whole") == F.col("_kept")), "left_semi").select("conv_id", "turns")


def rendered(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, text): every turn between its markers, in order."""
    opening, rest = TURN.split("{role}")
    between, closing = rest.split("{text}")
    each = F.transform("turns", lambda t: F.concat(F.lit(opening), t["role"], F.lit(between), t["text"], F.lit(closing)))
    return conversations.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.array_join(each, "").alias("text"))


ORACLE_SQL = """
WITH t AS (SELECT conv_id, list_sort(list(struct_pack(turn := turn, role := coalesce(role, ''), text := coalesce(text, ''))), 'ASC', 'NULLS FIRST') AS turns
           FROM conversations GROUP BY conv_id),
k AS (SELECT conv_id, turns, list_transform(turns, lambda x: struct_pack(role := x.role, text := x.text)) AS key FROM t),
p AS (SELECT DISTINCT key[:n] AS key FROM k, unnest(range(1, len(key))) AS u(n)),
m AS (SELECT key, min(conv_id) AS conv_id FROM k GROUP BY key)
SELECT k.conv_id, len(turns)::BIGINT AS n_turns,
  array_to_string(list_transform(turns, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), '') AS text
FROM k JOIN m ON k.conv_id = m.conv_id AND k.key = m.key
WHERE k.key NOT IN (SELECT key FROM p)
"""
