import array
import zlib
from collections import defaultdict

import pytest

from texttrend.llm import packing
from texttrend.llm.tokens import WordEncoder, default_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def check_places(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_words_give_the_tokenizers_ids(tokenizer, edge_rows, given):
    encoder = WordEncoder(default_tokenizer(), most=50)
    texts = [r[1] or "" for r in edge_rows] + [r.text for r in given("documents").limit(60).collect()]
    texts += ["é ́ ª µ ß İ ſ K", "it's WE'LL o'clock", "12 3a4 ½", "a​b c d", "x<|endoftext|>y"]
    for text in texts:
        want = array.array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        assert encoder.text_ids(text) == want


@pytest.mark.parametrize("capacity", [4096, 64])
def test_pieces_and_places(edge_docs, edge_rows, tokenizer, capacity):
    rows = packing.pack_documents(edge_docs, capacity=capacity, with_ids=True, slack=2).collect()
    want = []
    for doc_id, text, *_ in edge_rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = array.array("I", ids[start : start + capacity])
            want.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes()), part.tobytes()))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    check_places(rows, capacity)


def test_few_sequences_over_many_partitions(spark, given):
    items = spark.range(0, 4000, 1, 16).selectExpr("id AS item", "1 + pmod(xxhash64(id), 900) AS length")
    rows = packing.pack_items(items, capacity=1000, slack=4, fan_in=4).collect()
    used = check_places(rows, 1000)
    assert len(rows) == 4000
    # Bins are merged whole, so each partition's last few bins are the price of packing where the items lie.
    assert used <= len(packing.best_fit([r.length for r in rows], 1000)[1]) + 4 * 16


def test_halves_that_never_fit_end_the_levels(spark):
    items = spark.range(0, 3000, 1, 8).selectExpr("id AS item", "600L AS length")
    assert check_places(packing.pack_items(items, capacity=1000, most=500).collect(), 1000) == 3000


def test_best_fit_takes_the_tightest_bin():
    place, fill = packing.best_fit([6, 4, 5, 5, 10, 3], 10)
    assert sorted(fill) == [3, 10, 10, 10]
    assert place[0][0] == place[1][0] and place[2][0] == place[3][0]
    assert packing.best_fit([], 10) == ([], [])


def test_no_documents(no_docs):
    assert packing.pack_documents(no_docs).count() == 0
