import array
import zlib

import numpy as np
import pytest

from texttrend.llm import blocks
from texttrend.llm.tokens import WordEncoder, default_tokenizer


@pytest.mark.parametrize("size", [0, 1, 63, 1023, 1024, 1025, 9000, 5_000_000])
def test_any_range_comes_back(size):
    random = np.random.default_rng(size)
    ids = random.zipf(1.3, size).clip(0, 49_000).astype(np.uint32)
    ids[::97] = random.integers(0, 1 << 32, len(ids[::97]), dtype=np.uint32)
    file = blocks.IdFile(blocks.file_bytes(ids, np.zeros(0, blocks.DOCUMENT)))
    assert file.ids == size and (file.range(0, size) == ids).all()
    for start, end in random.integers(0, size + 1, (20, 2)):
        start, end = sorted((int(start), int(end)))
        assert (file.range(start, end) == ids[start:end]).all()


@pytest.mark.parametrize("value", [0, 7, (1 << 32) - 1])
def test_constant_ids_take_no_bits(value):
    ids = np.full(3000, value, np.uint32)
    index, words, exceptions = blocks.encode_blocks(ids)
    assert len(words) == 0 and len(exceptions) == 0
    assert (blocks.decode_blocks(index, words, exceptions, 0, 3)[:3000] == ids).all()


def test_outliers_are_exceptions():
    ids = np.arange(1024, dtype=np.uint32) % 16
    ids[5], ids[900] = 1 << 31, (1 << 32) - 1
    index, words, exceptions = blocks.encode_blocks(ids)
    assert index["width"][0] == 4 and exceptions["position"].tolist() == [5, 900]


def test_another_file_is_refused():
    with pytest.raises(ValueError):
        blocks.IdFile(b"x" * 200)


def test_round_trip_through_files(edge_docs, edge_rows, no_docs, tmp_path):
    from tokenizers import Tokenizer

    tokenizer, at, want = Tokenizer.from_file(default_tokenizer()), 0, []
    ordered = sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for doc_id, text, *_ in ordered:
        ids = array.array("I", tokenizer.encode(text or "", add_special_tokens=False).ids + [2])
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    for size in (1 << 25, 3000):
        got = blocks.round_trip(edge_docs, text_bytes_per_file=size).collect()
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    folder = str(tmp_path / "ids")
    manifest = blocks.write_id_files(edge_docs, folder, text_bytes_per_file=3000)
    back = blocks.read_id_files(edge_docs.sparkSession, folder, manifest, with_ids=True).collect()
    assert all(zlib.crc32(bytes(r["ids"])) == r.ids_crc32 for r in back) and len(back) == len(want)
    assert blocks.round_trip(no_docs).count() == 0


def test_the_model_is_asked_once_for_a_word_however_it_is_capitalised():
    ids_of = WordEncoder(default_tokenizer())
    asked, whole = [], ids_of._tokenizer
    ids_of._tokenize = lambda run: asked.append(run) or ids_of._model.tokenize(run)
    text = "Orre orre ORRE, orre; <|endoftext|> zürich Zürich 12a"
    want = np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
    assert ids_of.text_ids(text) == want.tobytes()
    assert asked.count("orre") == 1 and len(set(asked)) == len(asked)
