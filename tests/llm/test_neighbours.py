import array
import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from texttrend.llm import byte_tokens, neighbours
from texttrend.llm.tokens import default_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_tokens.byte_tokenizer())


def test_ids_are_the_tokenizers(tokenizer, edge_rows, given):
    encoder = byte_tokens.text_encoder(byte_tokens.byte_tokenizer())
    assert encoder._fast is not None
    texts = [r[1] or "" for r in edge_rows] + [r.text or "" for r in given("documents").collect()]
    texts += ["a<|endoftext|>b", "don't WE'LL 's", "  two  \t\n\n three ", "\x00\x1c\x85 é́ 数据\U0001f600", "12 3½ a1", " " * 5000 + "x", "\n" * 3000]
    for text in texts:
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_files_of_another_kind_go_through_their_tokenizer():
    encoder = byte_tokens.TextEncoder(default_tokenizer())
    assert encoder._fast is None
    assert encoder.ids("Some Words, 12").tolist() == encoder.tokenizer.encode("Some Words, 12", add_special_tokens=False).ids


def test_merges_out_of_order_are_refused():
    with open(byte_tokens.byte_tokenizer(), encoding="utf-8") as file:
        content = json.load(file)
    assert byte_tokens.merge_ranks(content)
    content["model"]["merges"] = content["model"]["merges"][::-1]
    assert byte_tokens.merge_ranks(content) is None


def check(rows, want, capacity):
    """Every id once, sequences gapless, no padding except in none: each is full or a power of two."""
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        data = bytes(r.ids)
        assert len(data) == 4 * r.length and zlib.crc32(data) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id, r.doc_tokens].append((r.start, data))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == capacity or (at < capacity and at & (at - 1) == 0)
    found = Counter()
    for (doc_id, tokens), pieces in parts.items():
        copies = sum(len(d) for _, d in pieces) // 4 // tokens
        assert sum(len(d) for _, d in pieces) == 4 * tokens * copies
        if copies == 1:
            joined = b"".join(d for _, d in sorted(pieces))
            assert sorted(s for s, _ in pieces) == sorted(np.cumsum([0] + [len(d) // 4 for _, d in sorted(pieces)])[:-1].tolist())
            assert joined in want[doc_id]
        found[doc_id] += copies
    assert found == Counter({k: len(v) for k, v in want.items()})


@pytest.mark.parametrize("capacity, shard_tokens", [(1024, 4 << 20), (64, 5000)])
def test_pieces_and_places(edge_docs, edge_rows, tokenizer, capacity, shard_tokens):
    want = defaultdict(list)
    for doc_id, text, *_ in edge_rows:
        want[doc_id].append(array.array("I", tokenizer.encode(text or "", add_special_tokens=False).ids + [0]).tobytes())
    rows = neighbours.pack_by_retrieval(edge_docs, capacity=capacity, shard_tokens=shard_tokens, part_tokens=20_000, with_ids=True).collect()
    check(rows, want, capacity)


def test_whole_table(given, tokenizer):
    docs = given("documents")
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append(array.array("I", tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]).tobytes())
    check(neighbours.pack_by_retrieval(docs, with_ids=True, part_tokens=100_000).collect(), want, 1024)


def test_no_documents(no_docs):
    assert neighbours.pack_by_retrieval(no_docs).count() == 0


def plain_scores(ids, idf, average, doc, terms):
    """BM25 of every document for the document's heaviest terms, one number at a time."""

    def weight(term, other):
        tf = ids[other].tolist().count(term)
        return float(idf[term]) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(ids[other]) / average))

    query = sorted(set(ids[doc].tolist()), key=lambda t: (-weight(t, doc), t))[:terms]
    return [sum(weight(t, other) for t in query) for other in range(len(ids))]


def test_neighbours_are_those_of_plain_bm25():
    draw = np.random.default_rng(3)
    ids = [draw.zipf(1.4, n).clip(0, 299).astype(np.uint16) for n in draw.integers(1, 200, 60)]
    frequency = sum(np.bincount(np.unique(x), minlength=300) for x in ids)
    idf = np.log1p((60 - frequency + 0.5) / (frequency + 0.5)).astype(np.float32)
    shard, average = neighbours.Shard(ids, idf, 90.0), 90.0
    used = draw.random(60) < 0.3
    for doc in range(0, 60, 7):
        got = shard.neighbours(doc, used, terms=5, nearest=10)
        scores = plain_scores(ids, idf, average, doc, 5)
        left = sorted((s for i, s in enumerate(scores) if not used[i] and s > 0), reverse=True)[:10]
        assert not used[got].any()
        assert [scores[i] for i in got] == pytest.approx(left, rel=1e-5)


def test_windows_hold_related_documents(spark):
    draw = random.Random(2)
    topics = [[f"{stem}{i}" for i in range(40)] for stem in ("copper", "violin", "harbor", "saffron")]
    docs = [(i, " ".join(draw.choices(topics[i % 4], k=30))) for i in range(200)]
    rows = neighbours.pack_by_retrieval(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    windows = defaultdict(Counter)
    for r in rows:
        windows[r.sequence_id][r.doc_id % 4] += r.length
    alike = sum(max(c.values()) for c in windows.values()) / sum(sum(c.values()) for c in windows.values())
    assert alike > 0.8  # a quarter by chance


def test_passage_frequencies(docs_of):
    rows = neighbours.passages(docs_of(["a b a", "b c", None, ""]), "doc_id", "text", byte_tokens.byte_tokenizer(), 0, 1024)
    frequency = neighbours.passage_frequencies(rows, 50_257)
    assert frequency[0] == 4 and sorted(frequency[frequency > 0].tolist()) == [1, 1, 1, 1, 1, 4]  # the end, and a, b with and without a space, c


def test_long_texts_are_rows_of_a_window(docs_of):
    rows = neighbours.passages(docs_of(["a " * 5000, "b"]), "doc_id", "text", byte_tokens.byte_tokenizer(), 0, 64).collect()
    assert max(r.length for r in rows) == 64 and all(len(r.ids) == 2 * r.length for r in rows)
    assert sum(r.length == 64 for r in rows) > 70 and sum(r.length < 64 for r in rows) == 2


def test_tail_is_cut_at_powers_of_two():
    windows = neighbours.fill_windows([700, 400, 90], lambda doc, used: [], 1024)
    assert [sum(n for *_, n in w) for w in windows] == [1024, 128, 32, 4, 2]
    assert neighbours.fill_windows([], None, 8) == []
