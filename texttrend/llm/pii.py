"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from .common import filled
from .matching import Rule, between, joined, let, running, segments

KINDS = ("email", "ip", "card", "phone", "name")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Whether the digits of a string pass the Luhn check."""
    reverse = F.reverse(_digits(m))
    doubled = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(reverse), F.lit(1))),
        lambda i: F.coalesce(F.expr("0") + F.substring(reverse, i, F.lit(1)).try_cast("int"), F.lit(0)) * F.when(i % 2 == 0, 2).otherwise(1),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return total % 10 == 0


def _octets(m: Column) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))


# The base rules, then what may be personal data besides.
BASE = (
    Rule(
        "email",
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        fast=r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        hint="@",
    ),
    Rule(
        "ip",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        fast=r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        valid=lambda m, g: _octets(m),
    ),
    Rule(
        "card",
        r"[0-9]([\x20-]?[0-9])+",
        fast=r"[0-9](?:[\x20-]?[0-9])++",
        valid=lambda m, g: F.length(_digits(m)).between(16, 19) & luhn(m),
    ),
    Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]", hint="+", valid=lambda m, g: F.length(_digits(m)).between(8, 15)),
)
LOOSE = (
    Rule("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]\x20?(?:dot|DOT)\x20?[\])])\x20?[A-Za-z0-9-]++)++"),
    Rule("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    Rule("card", r"(?<![0-9A-Za-z.])3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}(?![0-9A-Za-z])"),
    Rule("phone", r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])"),
    Rule("name", r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]+(?:\x20[A-Z][a-z]+)?"),
)
CONTEXT = {
    "email": "mail|contact|write|reach|send",
    "ip": "ip|host|server|address|login|client",
    "card": "card|visa|credit|debit|payment|amex|master",
    "phone": "phone|tel|call|mobile|cell|fax|contact|sms",
    "name": "contact|dear|from|sincerely|regards|patient|client",
}
AGAINST = "version|release|isbn|invoice|order|build|serial|part no|chapter|example only"
GAZETTEER = {
    "email": r"(?i)(?:\.|dot\x20?[\])]\x20?)(?:com|org|net|edu|gov|info|biz|io|co|de|fr|es|it|uk|nl|eu|ca|au|us|ch|at|be|jp|in|br)$",
    "ip": r"^(?:[1-9][0-9]?|1[0-9]{2}|2[01][0-9]|22[0-3])\.|:",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^(?:\+(?:1|2[07]|3[0-469]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])|\(?[2-9])",
    "name": r"\x20(?:James|John|Robert|Michael|William|David|Richard|Joseph|Thomas|Charles|Mary|Patricia|Jennifer|Linda|Elizabeth|Barbara|Susan|Jessica|Sarah|Karen|Anna|Maria|Peter|Paul|Laura|Emma)\b",
}
LABELERS = ("shape", "gazetteer", "context", "boundary", "form")
NEAR = 32  # characters of context


def _character(c: Column) -> Column:
    return (
        F.when(c == "", "edge")
        .when(c.rlike(r"^\s$"), "space")
        .when(c.rlike("^[A-Za-z0-9]$"), "alphanumeric")
        .when(c.rlike(r"^[.,;:!?()\[\]\"'<>]$"), "mark")
        .otherwise("other")
    )


def _candidate(text: Column, rule: Rule, base: bool) -> Column:
    """Candidates of one rule: place, votes and features."""
    kind = rule.kind

    def described(x: Column, pieces: Column) -> Column:
        m, start, end = x["match"], x["start"], x["end"]
        before = F.lower(between(pieces, F.greatest(start - NEAR, F.lit(0)), start))
        # The last piece may end with the text; what lies behind it is ''.
        left, right = between(pieces, F.greatest(start - 1, F.lit(0)), start), between(pieces, end, end + 1)
        named, against = before.rlike(CONTEXT[kind]), before.rlike(AGAINST)
        glued = (_character(left) == "alphanumeric") | (_character(right) == "alphanumeric")
        digits = F.length(_digits(m)) * 4 / F.length(m)
        # A labeler abstains where the pattern itself has made sure of what it would say: such a yes says nothing.
        shape = F.lit(1) if base else F.when(luhn(m), 1).otherwise(-1) if kind == "card" else F.lit(0)
        separators = F.size(F.array_distinct(F.regexp_extract_all(m, F.lit(r"[\x20-]"), F.lit(0))))
        form = {"card": separators <= 1, "phone": F.length(F.regexp_replace(m, "[^(]", "")) == F.length(F.regexp_replace(m, "[^)]", "")), "email": F.length(m) <= 254}.get(kind)
        votes = F.array(
            shape,
            F.when(m.rlike(GAZETTEER[kind]), 1).otherwise(-1),
            F.when(against, -1).when(named, 1).otherwise(0),
            F.when(glued, -1).otherwise(0),
            F.lit(0) if form is None else F.when(form, 0).otherwise(-1),
        )
        features = F.array(
            F.lit(f"kind={kind}"),
            F.concat(F.lit("left="), _character(left)),
            F.concat(F.lit("right="), _character(right)),
            F.concat(F.lit("length="), F.least(F.floor(F.log2(F.length(m) + 1)), F.lit(8)).cast("string")),
            F.concat(F.lit("digits="), F.floor(digits).cast("string")),
            F.concat(F.lit("named="), named.cast("string")),
            F.concat(F.lit("against="), against.cast("string")),
        )
        return F.struct(
            F.lit(KINDS.index(kind)).alias("rank"),
            start.alias("start"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            F.lit(base).alias("base"),
            votes.cast("array<int>").alias("votes"),
            features.alias("features"),
        )

    # Texts are cut only where something was found.
    return let(
        rule.found(text),
        lambda found: let(F.when(F.size(found) > 0, segments(text)).otherwise(F.array().cast("array<string>")), lambda pieces: F.transform(found, lambda x: described(x, pieces))),
    )


def _apart(loose: Column, base: Column) -> Column:
    """The spans of ``loose`` that overlap none of ``base``.

    One sorted array: every base span at its start, every loose one at its end,
    before base spans that start there. A loose span overlaps if the base spans
    before it reach beyond its start.
    """
    at = lambda x, place, own: F.struct(place.alias("at"), F.lit(own).alias("own"), x["end"].alias("end"), x.alias("span"))
    both = F.array_sort(F.concat(F.transform(loose, lambda x: at(x, x["end"], 0)), F.transform(base, lambda x: at(x, x["start"], 1))))

    def kept(spans: Column) -> Column:
        reach = running(spans, F.lit(0), lambda far, x: F.when(x["own"] == 1, F.greatest(far, x["end"])).otherwise(far), "int")
        free = F.filter(F.zip_with(spans, reach, lambda x, far: F.struct(x.alias("x"), far.alias("far"))), lambda p: (p["x"]["own"] == 0) & (p["far"] <= p["x"]["span"]["start"]))
        return F.transform(free, lambda p: p["x"]["span"])

    return let(both, kept)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, candidates) of every document: base matches, and loose ones that touch none of them."""
    text = F.col("_text")
    rows = docs.select(F.col(id_col).alias("doc_id"), filled(text_col).alias("_text"))
    rows = rows.select(
        "doc_id",
        F.concat(*(_candidate(text, r, True) for r in BASE)).alias("_base"),
        F.concat(*(_candidate(text, r, False) for r in LOOSE)).alias("_loose"),
    )
    return rows.select("doc_id", F.array_sort(F.concat("_base", F.when((F.size("_loose") > 0) & (F.size("_base") > 0), _apart(F.col("_loose"), F.col("_base"))).otherwise(F.col("_loose")))).alias("candidates"))


def _log_odds(votes: Column, prior: Column, reliability: Column) -> Column:
    each = F.zip_with(
        votes,
        reliability,
        lambda v, r: F.when(v == 1, F.log(r["true"] / r["false"])).when(v == -1, F.log((1 - r["true"]) / (1 - r["false"]))).otherwise(F.lit(0.0)),
    )
    return F.aggregate(each, F.log(prior / (1 - prior)), lambda a, x: a + x)


def _probability(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def estimate_reliabilities(found: DataFrame, rounds: int = 25) -> dict[str, tuple[float, list[tuple[float, float]]]]:
    """By kind: share of true spans, and per labeler how often it votes yes on true and on false spans.

    Expectation-maximisation over counts of equal vote patterns, for each kind
    apart: a gazetteer that tells phones well says nothing of its cards. There
    are at most 3 to the number of labelers patterns a kind, however many spans
    there are. All rounds are one expression over that one small array.
    Pseudo-counts say that a labeler is right in four of five of ten votes
    before any are seen.
    """
    patterns = (
        found.select(F.explode("candidates").alias("c"))
        .groupBy("c.kind", "c.votes")
        .agg(F.count("*").cast("double").alias("n"))
        .groupBy("kind")
        .agg(F.array_sort(F.collect_list(F.struct("votes", "n"))).alias("patterns"))
    )
    start = F.struct(F.lit(0.8).alias("prior"), F.array(*[F.struct(F.lit(0.8).alias("true"), F.lit(0.2).alias("false"))] * len(LABELERS)).alias("r"))
    total = lambda xs, f: F.aggregate(xs, F.lit(0.0), lambda a, x: a + f(x))

    def round_(state: Column, _: Column) -> Column:
        weighed = F.transform(
            "patterns",
            lambda p: F.struct(p["votes"].alias("votes"), p["n"].alias("n"), (p["n"] * _probability(_log_odds(p["votes"], state["prior"], state["r"]))).alias("w")),
        )

        def updated(q: Column) -> Column:
            def labeler(j: int) -> Column:
                voted = lambda x, value: F.when(x["votes"][j] != 0, value).otherwise(0.0)
                yes = lambda x, value: F.when(x["votes"][j] == 1, value).otherwise(0.0)
                return F.struct(
                    ((total(q, lambda x: yes(x, x["w"])) + 8) / (total(q, lambda x: voted(x, x["w"])) + 10)).alias("true"),
                    ((total(q, lambda x: yes(x, x["n"] - x["w"])) + 2) / (total(q, lambda x: voted(x, x["n"] - x["w"])) + 10)).alias("false"),
                )

            prior = (total(q, lambda x: x["w"]) + 4) / (total(q, lambda x: x["n"]) + 5)
            return F.struct(F.least(prior, F.lit(0.999)).alias("prior"), F.array(*(labeler(j) for j in range(len(LABELERS)))).alias("r"))

        return F.transform(F.array(weighed), updated)[0]

    states = patterns.select("kind", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, round_).alias("s")).collect()
    return {row.kind: (row.s.prior, [(r["true"], r["false"]) for r in row.s.r]) for row in states}


def _crossed(features: Column) -> Column:
    """A span's features, each with its kind (the first of them)."""
    return F.transform(features, lambda f: F.concat(features[0], F.lit(" "), f))


def train_spans(found: DataFrame, reliabilities: dict[str, tuple[float, list[tuple[float, float]]]]) -> tuple[float, dict[str, float]]:
    """(bias, weight of every feature): naive Bayes over span features by kind, taught by the labelers' joint opinion.

    There is a fixed small number of features, so their sums are what reaches
    the driver.
    """
    if not reliabilities:
        return 0.0, {}
    learned = F.create_map(
        *(
            x
            for kind, (prior, r) in sorted(reliabilities.items())
            for x in (F.lit(kind), F.struct(F.lit(prior).alias("prior"), F.array(*(F.struct(F.lit(t).alias("true"), F.lit(f).alias("false")) for t, f in r)).alias("r")))
        )
    )
    spans = found.select(F.explode("candidates").alias("c")).select(_crossed(F.col("c.features")).alias("features"), "c.votes", learned[F.col("c.kind")].alias("s"))
    taught = spans.select("features", _probability(_log_odds(F.col("votes"), F.col("s.prior"), F.col("s.r"))).alias("q"))
    sums = taught.select(F.explode(F.concat("features", F.array(F.lit("")))).alias("f"), "q").groupBy("f").agg(F.sum("q").alias("yes"), F.sum(1 - F.col("q")).alias("no"))
    table = {row.f: (row.yes, row.no) for row in sums.collect()}
    yes, no = table.pop("", (0.0, 0.0))
    of_kind = {f.split(" ")[0]: counts for f, counts in table.items() if len(set(f.split(" "))) == 1}
    weights = {}
    for f, (a, b) in sorted(table.items()):
        own_yes, own_no = of_kind[f.split(" ")[0]]
        if f.split(" ")[0] == f.split(" ")[1]:  # the kind's own odds
            weights[f] = math.log((a + 1) / (yes + 2)) - math.log((b + 1) / (no + 2))
        else:
            weights[f] = math.log((a + 1) / (own_yes + 2)) - math.log((b + 1) / (own_no + 2))
    return math.log((yes + 1) / (no + 1)), weights


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(doc_id, spans) of every document; spans hold rank, start, end, kind, base and probability.

    One pass over the texts finds candidates and their votes, written to the
    shared folder (most documents have none); everything after works on those.
    Base matches are always kept, other candidates if the span classifier gives
    them at least ``threshold``. Spans are ordered by kind, then start. NULL
    texts are empty; repeated rows and NULL ids come back as often as they
    occur; an empty table gives no rows; other columns are not read.
    """
    found = store(candidates(docs, id_col, text_col))
    bias, weights = train_spans(found, estimate_reliabilities(found))
    known = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair)) if weights else F.lit(None).cast("map<string,double>")
    scored = F.transform(
        "candidates",
        lambda x: F.struct(
            x["rank"].alias("rank"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["kind"].alias("kind"),
            x["base"].alias("base"),
            _probability(F.aggregate(_crossed(x["features"]), F.lit(bias), lambda a, f: a + F.coalesce(known[f], F.lit(0.0)))).alias("probability"),
        ),
    )
    return found.select("doc_id", F.filter(scored, lambda x: x["base"] | (x["probability"] >= threshold)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and a digest of the base spans, and all spans."""
    base = F.filter("spans", lambda x: x["base"])

    def count(rank: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["base"] & (x["rank"] == rank))).cast("long")

    counts = [count(k).alias(f"n_{rule.kind}") for k, rule in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
