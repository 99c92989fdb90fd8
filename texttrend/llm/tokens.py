"""Token ids of whole texts, the same as the tokenizer gives, with a bounded memory of words."""

from __future__ import annotations

import array
import os
import re

# White space that ends a word here; what a plain word may hold
# (ASCII but the apostrophe, Latin-1 letters); the runs the tokenizer makes of it.
_ODD = re.compile("[\x1c-\x1f]")
_WORDS = re.compile("[^ \t-\r]+").findall
_PLAIN = re.compile("[!-&(-~À-ÖØ-öø-ÿ]*").fullmatch
_RUNS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+").findall


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write the UTF-8 bytes of Latin-1 letters."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class WordEncoder(dict):
    """Words to their ids (little-endian unsigned 32-bit), for a lower-casing BPE with word ends.

    Such a tokenizer drops white space and never looks across it, so a text's
    ids are those of its words. Plain words go straight to the tokenizer's own
    model, all others (apostrophes, other scripts, special tokens) through the
    whole tokenizer. At most ``most`` words are remembered.
    """

    def __init__(self, path: str, most: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self._tokenizer, self._most, self._letters = Tokenizer.from_file(path), most, _byte_letters()
        self._model = self._tokenizer.model
        special = [re.escape(t.content) for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(special) or "(?!)").search
        self._tokenize = self._model.tokenize

    def _run(self, run: str) -> bytes:
        found = self._tokenize(run if run.isascii() else run.translate(self._letters))
        return array.array("I", [t.id for t in found]).tobytes()

    def __missing__(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            # The model is asked once for a word, however it is capitalised.
            lower = word.lower()
            ids = self._run(word) if lower == word else self[lower]
        elif _PLAIN(word) and not self._special(word):
            ids = b"".join([self._run(r) if r == word else self[r] for r in _RUNS(word.lower())])
        else:
            ids = array.array("I", self._tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if len(self) >= self._most:
            self.clear()
        self[word] = ids
        return ids

    def text_ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.__getitem__, _WORDS(text) if _ODD.search(text) else text.split()))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
