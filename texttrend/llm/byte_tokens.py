"""Token ids of whole texts for a byte-level BPE, the same as the tokenizer file gives."""

from __future__ import annotations

import json
import os

import numpy as np

# How byte-level BPE splits a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _letter_bytes() -> dict[str, int]:
    """The letters that byte-level vocabularies write for the 256 bytes."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def merge_ranks(file: dict) -> dict[bytes, int] | None:
    """Token bytes by id, if the file is a plain byte-level BPE whose merges are in the order of their ids; else None."""
    model, split = file["model"], file.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not file.get("normalizer") and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not plain or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or split.get("use_regex") is False:
        return None
    vocabulary, letters = model["vocab"], _letter_bytes()
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    special = {t["content"] for t in file.get("added_tokens", [])}
    singles = [t for t in vocabulary if len(t) == 1 and t not in special]
    ids = [vocabulary.get(t, -1) for t in merged]
    ordered = all(a < b for a, b in zip(ids, ids[1:])) and (not ids or ids[0] > max(vocabulary[t] for t in singles))
    if not ordered or set(merged) | set(singles) | special != set(vocabulary) | special or len(singles) != 256:
        return None
    return {bytes(letters[c] for c in token): vocabulary[token] for token in (*singles, *merged)}


class TextEncoder:
    """Ids of whole texts, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    A file whose merges are in the order of their ids says the same as a table of
    ranks, which encodes several times faster. Any other file, and a text that
    holds the string of an added token, goes through the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self._added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            ranks = merge_ranks(json.load(file))
        self._fast = None
        if ranks:
            import tiktoken

            self._fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if self._fast is None or any(a in text for a in self._added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self._fast.encode_ordinary(text), np.uint32)


_ENCODERS: dict[str, TextEncoder] = {}


def text_encoder(path: str) -> TextEncoder:
    """One encoder per worker process and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
