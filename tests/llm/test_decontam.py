import math
from itertools import combinations

from texttrend.llm import decontam

ITEM = "alpha bravo charlie delta echo foxtrot golf hotel india juliett kilo lima mike november oscar papa quebec romeo sierra tango"
BENCH = "item_id long, text string, doc_id long, start int"


def bench(spark, texts):
    return spark.createDataFrame([(i, t, 9, 9) for i, t in enumerate(texts)], BENCH)


def by_hand(docs, items, window=decontam.WINDOW, share=decontam.SHARE):
    found = {}
    for d, text in docs:
        w = (text or "").encode().lower().split()
        for i, item in items:
            v = (item or "").encode().lower().split()
            size = min(window, len(v))
            for start in range(-len(v), len(w)) if v else ():
                equal = [0 <= start + k < len(w) and w[start + k] == x for k, x in enumerate(v)]
                best = max(sum(equal[a : a + size]) for a in range(len(v) - size + 1))
                if best >= math.ceil(size * share) and best > found.get((d, i), 0):
                    found[d, i] = best
    return found


def pairs(found):
    return {(r.doc_id, r.item_id): r.matched for r in found.collect()}


def test_given_documents_match_brute_force(given):
    docs, items = ([tuple(r) for r in given(t).select(i, "text").collect()] for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = pairs(decontam.contaminated(given("documents"), given("benchmark")))
    assert got == by_hand(docs, items) and got


def test_substitutions_are_tolerated(spark, docs_of):
    words = ITEM.split()
    one_in_five = " ".join("xx" if i % 5 == 4 else w for i, w in enumerate(words))
    every_other = " ".join("xx" if i % 2 else w for i, w in enumerate(words))
    docs = ["pre " * 30 + ITEM + " post" * 20, "so " + ITEM.upper(), "x " + one_in_five, every_other, " ".join(words[:12]), " ".join(words[3:17]) + " z", "nothing here", None, "", ITEM + " " + ITEM]
    got = pairs(decontam.contaminated(docs_of(docs), bench(spark, [ITEM])))
    want = by_hand(enumerate(docs), [(0, ITEM)])
    assert got == want and set(want) == {(i, 0) for i in (0, 1, 2, 4, 5, 9)}


def test_masks_find_every_allowed_substitution():
    for window in (13, 9):
        for n in range(1, window + 1):
            for shortest in range(1, n + 1):
                family = next(m for ns, m in decontam.families(list(range(shortest, window + 1)), window).items() if n in ns)
                for gone in combinations(range(n), decontam.allowed(n)):
                    fits = any(all(at + i not in gone for i, c in enumerate(m) if c == "1") for m in family for at in range(n - len(m) + 1))
                    assert fits, (n, shortest, gone)
    assert all(len(m) <= decontam.MOST_MASKS for m in decontam.families(list(range(1, 14))).values())


def test_no_allowed_substitution_is_lost(spark, docs_of):
    """Items of 1 to 20 words, each with every pattern of substitutions that the rule allows in some 13 of its words, and one too many."""
    items, docs, want = [], [], set()
    for n in range(1, 21):
        words = [f"item{n}word{i}" for i in range(n)]
        items.append(" ".join(words))
        size = min(n, decontam.WINDOW)
        for begin in range(n - size + 1):
            for gone in combinations(range(size), decontam.allowed(size)):
                kept = ["other" if i - begin in gone or not begin <= i < begin + size else w for i, w in enumerate(words)]
                want.add((len(docs), n - 1))
                docs.append("lead in " + " ".join(kept) + " and out")
        docs.append(" ".join("other" if i <= decontam.allowed(size) or i >= size else w for i, w in enumerate(words)))
    found = pairs(decontam.contaminated(docs_of(docs), bench(spark, items)))
    assert len(want) > 1000 and set(found) == want


def test_short_items(spark, docs_of):
    docs = ["we say red blue now", "red green blue", "blue red", "Red Blue", "a b c x e", "a x c y e", "one"]
    items = ["red blue", "", None, " ", "a b c d e", "one"]
    got = pairs(decontam.contaminated(docs_of(docs), bench(spark, items)))
    assert got == by_hand(enumerate(docs), list(enumerate(items))) and set(got) == {(0, 0), (3, 0), (4, 4), (6, 5)}


def test_clean_documents_stay_as_they_are(edge_docs, edge_rows, no_docs, spark):
    items = bench(spark, [edge_rows[0][1], edge_rows[0][1], None])
    kept = decontam.clean_documents(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted((str(r[0]), r[1] or "") for r in edge_rows if "quick brown" not in (r[1] or "").lower())
    assert len(decontam.contaminated(edge_docs, items).collect()) == 2 * 5
    assert decontam.contaminated(no_docs, items).count() == 0 == decontam.contaminated(edge_docs, bench(spark, [])).count()


def test_large_benchmarks_are_joined_by_a_shuffle(spark, docs_of, monkeypatch):
    docs = docs_of(["so " + ITEM, "none"])
    monkeypatch.setattr(decontam, "SEED_BOUND", 1)
    monkeypatch.setattr(decontam, "HIT_BOUND", 1)
    assert set(pairs(decontam.contaminated(docs, bench(spark, [ITEM])))) == {(0, 0)}


def test_no_python_runs(edge_docs, spark):
    plan = decontam.contaminated(edge_docs, bench(spark, [ITEM]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
