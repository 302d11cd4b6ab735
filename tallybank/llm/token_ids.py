"""Whole texts to ids with a `tokenizers` vocabulary, remembering the ids of words.

Where the vocabulary's pipeline is Unicode NFC, white space to one space, lower case, a pattern that drops white space,
and byte-level BPE, words between ASCII white space encode independently. Their ids are kept in a table of bounded size. A new
word of Latin letters is normalised and split here, which needs no table of Unicode versions below U+0250, and only its
pieces go to the library's BPE. Any other word goes through the whole library, as do whole texts of other pipelines.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Callable
from functools import cache

import numpy as np
import regex

MOST_WORDS, MOST_PIECES = 750_000, 250_000
MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
#: A pattern that takes letters, and marks after them, as one piece each.
LETTERS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_MARK_INSIDE = regex.compile(r"[^A-Za-z].*[A-Za-z]", regex.DOTALL)
_LATIN_END = "ɐ"


class TextEncoder:
    @staticmethod
    @cache
    def of(path: str) -> TextEncoder:
        """One per Python worker, so that the vocabulary is read once."""
        return TextEncoder(path)

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        spec = json.loads(self.library.to_str())
        self.pattern = _split_pattern(spec)
        self.added = [token["content"] for token in spec["added_tokens"]]
        self.bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.first_letters = {token[0] for token in self.added}
        # Whether no added token can be found in ASCII letters with marks after them.
        apart = self.pattern is not None and self.pattern.pattern == LETTERS_APART
        self.simple = apart and all(_MARK_INSIDE.search(token) for token in self.added)
        self.words = Known(self._word, MOST_WORDS)
        self.pieces = Known(self._piece)
        self.letters = Known(self._letter)

    def encode(self, text: bytes, end_id: int | None = None) -> np.ndarray:
        """Ids of one UTF-8 text, and the end id."""
        end = b"" if end_id is None else _packed([end_id])
        if self.pattern is None:
            return np.frombuffer(self._whole(text.decode()) + end, np.uint32)
        return np.frombuffer(b"".join(map(self.words.__getitem__, text.split())) + end, np.uint32)

    def forget(self) -> None:
        """Give the memory of remembered ids back, at the end of a task."""
        self.words.forget()
        self.pieces.forget()

    def _whole(self, text: str) -> bytes:
        return _packed(self.library.encode(text, add_special_tokens=False).ids)

    def _word(self, word: bytes) -> bytes:
        if self.simple:
            body = word.rstrip(MARKS)
            if body.isalpha():
                low = body.lower()
                if low == word:
                    return self._piece(low.decode())
                ids = self.words[low]
                return ids if len(body) == len(word) else ids + self.pieces[word[len(body) :].decode()]
        text = word.decode()
        if not text.isascii() and max(text) >= _LATIN_END:
            return self._whole(text)
        if not self.first_letters.isdisjoint(text) and any(token in text for token in self.added):
            return self._whole(text)
        parts = self.pattern.findall(text.lower())
        if len(parts) == 1:
            return self.pieces[parts[0]]
        return b"".join(map(self.pieces.__getitem__, parts))

    def _letter(self, code: int) -> str:
        return "".join(shown for shown, _ in self.bytes_of.pre_tokenize_str(chr(code)))

    def _piece(self, part: str) -> bytes:
        if not (part.isascii() and part.isprintable()):
            part = part.translate(self.letters)
        return _packed([token.id for token in self.library.model.tokenize(part)])


class Known(dict):
    """Remembers what `make` returned for a key; beyond `most` keys, only those that are used again."""

    def __init__(self, make: Callable, most: int = MOST_PIECES):
        super().__init__()
        self.make, self.most = make, most
        self.old: dict = {}

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _split_pattern(spec: dict) -> regex.Pattern | None:
    """The pattern of the words' pieces, or None if words do not encode independently as described above."""
    normal = (spec["normalizer"] or {}).get("normalizers", [])
    steps = [(n["type"], n.get("pattern", {}).get("Regex"), n.get("content")) for n in normal]
    splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    kinds = [(s["type"], s.get("behavior"), s.get("invert"), s.get("use_regex")) for s in splits]
    wanted = [("NFC", None, None), ("Replace", r"\s+", " "), ("Lowercase", None, None)]
    if steps != wanted or kinds != [("Split", "Removed", True, None), ("ByteLevel", None, None, False)]:
        return None
    if spec["model"]["type"] != "BPE" or spec["model"]["dropout"] or any(t["normalized"] for t in spec["added_tokens"]):
        return None
    return regex.compile(splits[0]["pattern"]["Regex"])
