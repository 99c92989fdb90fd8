import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from texttrend.llm import collocations as co

SCHEMA = "doc_id long, lang string, text string, n long, phrase string"


def pieces(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
        yield re.findall(r"[^\x20\x09]+", piece)


def plain(docs, longest=3, least=10, share=50, kept=2000):
    """The contract, read off literally."""
    f, total = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        for words in pieces(text):
            total[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    f[lang, tuple(words[i : i + n])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    rows = defaultdict(list)
    for (lang, words), a in candidates.items():
        inside = lambda longer: any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
        if any(o == lang and len(w) > len(words) and 100 * b >= share * a and inside(w) for (o, w), b in candidates.items()):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        rows[lang].append((" ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], total[lang], score))
    out = []
    for lang, own in rows.items():
        own.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i, *r) for i, r in enumerate(own[:kept], 1)]
    return sorted(out)


def prose(seed, docs, words=120, vocabulary=30):
    draw = random.Random(seed)
    known = [f"w{i}" for i in range(vocabulary)] + ["Été", "don't", "数据"]
    out = []
    for i in range(docs):
        tokens = [draw.choice(known) + draw.choice(["", "", "", ",", ".", "\n", "!?"]) for _ in range(words)]
        out.append((i, draw.choice(["en", "de", None]), draw.choice([" ", "\t", "  "]).join(tokens), 1, "x"))
    return out


def got(docs, **options):
    return sorted(map(tuple, co.collocations(docs, **options).collect()))


@pytest.mark.parametrize("longest, modulus, bits", [(3, 16, 27), (3, 1, 6), (2, 5, 10), (4, 3, 20), (4, 50, 7)])
def test_every_row_as_the_contract_says(spark, longest, modulus, bits):
    docs = prose(longest, 60, vocabulary=8)
    docs += [docs[0]] * 25  # repeated rows
    df = spark.createDataFrame(docs, SCHEMA)
    want = plain([d[1:3] for d in docs], longest=longest)
    assert len(want) > 100
    assert got(df, longest=longest, modulus=modulus, pruning_bits=bits) == want


def test_edge_rows(edge_docs, edge_rows, no_docs):
    assert got(edge_docs, least=2, kept=7) == plain([(r[2], r[1]) for r in edge_rows], least=2, kept=7)
    assert got(no_docs) == []


def test_whole_table(given):
    docs = given("documents")
    assert got(docs) == plain([(r.lang, r.text) for r in docs.select("lang", "text").collect()])


@pytest.mark.parametrize("overlap, modulus", [(1, 4), (2, 16), (3, 2), (2, 10**9)])
def test_chunks_overlap_and_hold_every_token_once(overlap, modulus):
    for _, _, text, *_ in prose(7, 20):
        tokens = [co.BREAK] * overlap + co._WORDS(co._PIECES(b" \n ", text.encode().lower()))
        parts = [c.split(b" ") for c in co.chunks(text, overlap, modulus, co._Hashes())]
        assert [t for i, p in enumerate(parts) for t in p[overlap if i else 0 :]] == tokens
        assert all(a[-overlap:] == b[:overlap] and len(b) > overlap for a, b in zip(parts, parts[1:]))


def test_equal_passages_give_equal_chunks():
    draw = random.Random(3)
    passage = " ".join(f"v{draw.randrange(900)}" for _ in range(400))
    a, b = (set(co.chunks(f"{lead} {passage} end", 2, 16, co._Hashes())) for lead in ("one", "quite another beginning here"))
    assert len(a & b) >= len(a) - 2 > 5


def test_parse_is_prefix_free(spark):
    draw = random.Random(4)
    texts = [" ".join(draw.choices(["a", "b", "c"], k=500)) for _ in range(30)]
    found = co.parse(spark.createDataFrame([("en", t) for t in texts], "lang string, text string"), modulus=4).collect()
    inner = sorted(r.chunk.split(" ") for r in found if not any(t.endswith(" ".join(r.chunk.split(" ")[-5:])) for t in texts))
    assert len(inner) > 50
    assert not any(b[: len(a)] == a for a, b in zip(inner, inner[1:]))


def test_copies_do_not_grow_the_dictionary(spark):
    text = prose(9, 1, words=3000)[0][2]
    once, often = (co.parse(spark.range(n).select(F.lit("en").alias("lang"), F.lit(text).alias("text"))) for n in (1, 500))
    one = {r.chunk: r.parses for r in once.collect()}
    assert {r.chunk: r.parses for r in often.collect()} == {c: 500 * n for c, n in one.items()}


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(10**13, 10**13 + 7, 10**13 + 9), (3, 7, 10**18), (999_999_999_999_999, 999_999_999_999_999, 999_999_999_999_999), (12, 12, 12), (123456789012, 987654321098, 123456789013)]
    df = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", co.association(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in df.collect())


def test_hashes_agree():
    import pyarrow as pa

    rows = pa.table({"lang": ["en", "und"], "chunk": ["\n \n a b c", "x a b"], "parses": [1, 2]})
    own = co.Dictionary(rows, 2)
    assert own.hashes(2)[[3, 4, 7]].tolist() == co.phrase_hashes(["en", "en", "und"], ["a b", "b c", "a b"]).tolist()
    assert np.array_equal(own.ends(1), [2, 3, 4, 7]) and np.array_equal(own.ends(3), [4, 7])
