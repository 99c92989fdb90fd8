"""Pattern matches with their places, as column expressions that stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


RUN, SEGMENT = 256, 1024  # elements of a block of ``running``, characters of a segment


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, zero: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """What ``step(state, value)`` gives after each value of an array, from ``zero`` on; ``kind`` is the state's type.

    Appending to one array would copy it for every value. States are gathered in
    blocks of ``RUN`` and the blocks in one array, so that time grows with the
    length of the array, and not with its square.
    """
    empty, lists = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def cut(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), F.lit(RUN))
        return F.transform(starts, lambda i: F.slice(v, i + 1, RUN))

    def inner(state: Column, value: Column) -> Column:
        return let(step(state["last"], value), lambda n: F.struct(n.cast(kind).alias("last"), F.array_append(state["out"], n.cast(kind)).alias("out")))

    def outer(state: Column, block: Column) -> Column:
        begin = F.struct(state["last"].alias("last"), empty.alias("out"))
        own = F.aggregate(block, begin, inner)
        return let(own, lambda o: F.struct(o["last"].alias("last"), F.array_append(state["out"], o["out"]).alias("out")))

    begin = F.struct(zero.cast(kind).alias("last"), lists.alias("out"))
    return F.aggregate(let(values, cut), begin, outer, lambda s: F.flatten(s["out"]))


def segments(text: Column) -> Column:
    """A text in pieces of ``SEGMENT`` code points, in which places are found without walking from its beginning."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{SEGMENT}}}"), F.lit(0))


def between(pieces: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end`` (exclusive; both within the text) of a text in segments."""
    first, last = F.floor(start / SEGMENT).cast("int"), F.floor(end / SEGMENT).cast("int")
    here = lambda i: F.coalesce(F.get(pieces, i), F.lit(""))
    within = F.substring(here(first), start - first * SEGMENT + 1, end - start)
    across = F.concat(
        F.substring(here(first), start - first * SEGMENT + 1, F.lit(SEGMENT)),
        F.array_join(F.slice(pieces, first + 2, last - first - 1), ""),
        F.substring(here(last), F.lit(1), end - last * SEGMENT),
    )
    return F.when(end <= start, F.lit("")).when(first == last, within).otherwise(across)


@dataclass(frozen=True)
class Rule:
    """What a kind of span looks like.

    ``pattern`` is the rule as stated; ``fast`` an equal Java pattern that never
    searches a run of characters twice (and so stays linear on any text);
    ``hint`` a string every match holds; ``valid`` the test of a match, given
    the match and its second group where ``group`` is 2; ``sql`` the same test
    in DuckDB over ``m`` and ``g``.
    """

    kind: str
    pattern: str
    fast: str | None = None
    hint: str | None = None
    group: int = 0
    valid: Callable[[Column, Column], Column] = field(default=lambda m, g: F.lit(True))
    sql: str = "true"

    def found(self, text: Column) -> Column:
        """Valid matches in order: array of (start, end, match); code points, end exclusive.

        Leftmost non-overlapping matches; invalid ones are dropped without a
        retry. The lengths of matches and of the texts between them give places.
        """
        pattern = self.fast or self.pattern
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(self.group)) if self.group else matches
        between = F.split(text, pattern, -1)
        pieces = F.zip_with(
            F.zip_with(matches, groups, lambda m, g: F.struct(m.alias("m"), g.alias("g"))),
            F.transform(between, F.length),
            lambda x, gap: F.struct(x["m"].alias("m"), x["g"].alias("g"), gap.alias("gap")),
        )

        def placed(found: Column) -> Column:
            ends = running(found, F.lit(0), lambda at, x: at + x["gap"] + F.length(x["m"]), "int")
            spans = F.zip_with(found, ends, lambda x, end: F.struct(x["m"].alias("m"), x["g"].alias("g"), end.alias("end")))
            return F.transform(
                F.filter(spans, lambda x: self.valid(x["m"], x["g"])),
                lambda x: F.struct((x["end"] - F.length(x["m"])).alias("start"), x["end"].alias("end"), x["m"].alias("match")),
            )

        kept = let(F.filter(pieces, lambda x: x["m"].isNotNull()), placed)
        possible = F.contains(text, F.lit(self.hint)) if self.hint else F.lit(True)
        return F.when(possible & text.rlike(pattern), kept).otherwise(F.array().cast(FOUND))


FOUND = "array<struct<start:int,end:int,match:string>>"


def joined(spans: Column) -> Column:
    """kind:start:end of every span in the given order, comma-joined; '' for none."""
    each = F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    )
    return F.array_join(each, ",")


def duckdb_found(rule: Rule, text: str) -> str:
    """The same matches in DuckDB: list of (m, g, end)."""
    quoted = "'" + rule.pattern.replace("'", "''") + "'"
    matches, gaps = f"regexp_extract_all({text}, {quoted}, 0)", f"string_split_regex({text}, {quoted})"
    groups = f"regexp_extract_all({text}, {quoted}, {rule.group})"
    upto = "coalesce(list_sum(list_transform({0}[:i], lambda y: length(y))), 0)"
    placed = f"""list_transform(range(1, len({matches}) + 1), lambda i: struct_pack(
        m := {matches}[i], g := {groups}[i], "end" := ({upto.format(matches)} + {upto.format(gaps)})::INTEGER))"""
    return f"list_filter({placed}, lambda x: {rule.sql.format(m='x.m', g='x.g')})"
