"""Whole texts to ids with a byte-level BPE vocabulary of `tokenizers`, remembering the ids of words.

The vocabulary's pattern lets a space begin a piece and otherwise ends pieces at white space. So a text may be cut before a
single space that follows a character other than white space, and each part, with its space, encodes independently.
The ids of parts are kept in tables of bounded size. A new part of Latin letters is split by the vocabulary's pattern here,
which needs no table of Unicode versions below U+0250, and only its pieces go to the library's BPE. Any other part goes
through the whole library, as do whole texts that cannot be cut so, and whole texts of other pipelines.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from functools import cache

import regex

LONG = 100
MOST, MOST_LATER = 250_000, 1_000_000
MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
#: The pattern of byte-level pre-tokenizers.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_LATIN_END = "ɐ"
_DOUBTFUL = regex.compile("[\x1c-\x1f\x85]")  # white space to some libraries only
_UNEVEN = (b"  ", b"\n ", b"\t ", b"\r ", b"\x0b ", b"\x0c ")
_CUT = re.compile(rb"(?<=[^\s]) (?=[^ ])")


class Parts(dict):
    """Remembers what `make` returned for a short key; beyond `most` keys, only those that are used again."""

    def __init__(self, make: Callable[[bytes | str], bytes | None], most: int = MOST):
        super().__init__()
        self.make, self.most = make, most
        self.old: dict = {}

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def __missing__(self, key):
        value = self.old.get(key) or self.make(key)
        if len(key) <= LONG:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class ByteEncoder:
    @staticmethod
    @cache
    def of(path: str) -> ByteEncoder:
        """One per Python worker, so that the vocabulary is read once."""
        return ByteEncoder(path)

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        from tokenizers import pre_tokenizers

        mapped = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # How each byte is written in the vocabulary; a lone byte above 127 is not UTF-8, so it is taken from a letter's end.
        self.written = {c: mapped.pre_tokenize_str(chr(c))[0][0] for c in range(128)}
        for c in range(0x80, 0xC0):
            self.written[c] = mapped.pre_tokenize_str(chr(c))[0][0][1]
        for c in range(0xC2, 0xE0):
            self.written[c] = mapped.pre_tokenize_str(bytes([c, 0x80]).decode())[0][0][0]
        self.space = self.written[0x20]
        self.tokenize = self.library.model.tokenize
        spec = json.loads(self.library.to_str())
        self.added = [token["content"] for token in spec["added_tokens"]]
        self.first_letters = {token[0] for token in self.added}
        self.cuts = _cuts_at_spaces(spec)
        self.pieces = Parts(self._piece)
        self.first = Parts(self._part)
        self.later = Parts(self._later, MOST_LATER)

    def encode(self, text: bytes) -> bytes:
        """Ids of one UTF-8 text as unsigned 32-bit numbers."""
        if not self.cuts:
            return self._whole(text)
        uneven = any(mark in text for mark in _UNEVEN)
        first, *rest = _CUT.split(text) if uneven else text.split(b" ")
        if not rest:
            return self._whole(text)
        last = rest.pop()
        parts = [self.first[first], *map(self.later.__getitem__, rest)]
        if None in parts:
            return self._whole(text)
        parts.append(self.later[last] or self._whole(b" " + last))
        return b"".join(parts)

    def forget(self) -> None:
        """Give the memory of remembered ids back, at the end of a task."""
        self.first.forget()
        self.later.forget()
        self.pieces.forget()

    def _whole(self, text: bytes) -> bytes:
        return array("I", self.library.encode(text.decode(), add_special_tokens=False).ids).tobytes()

    def _later(self, word: bytes) -> bytes | None:
        """A word and the space before it."""
        if word.isalpha():
            return self._ids(self.space + word.decode())
        body = word.rstrip(MARKS)
        if body.isalpha():
            letters = body.decode()
        else:
            text = body.decode(errors="replace")
            letters = body.decode("latin-1").translate(self.written) if text.isalpha() and max(text) < _LATIN_END else ""
        if letters and len(body) == len(word):
            return self._ids(self.space + letters)
        if letters:
            # Letters are one piece, and the marks after them another.
            return self.later[body] + self.pieces[word[len(body) :].decode()]
        return self._part(b" " + word)

    def _ids(self, shown: str) -> bytes:
        return array("I", [token.id for token in self.tokenize(shown)]).tobytes()

    def _part(self, part: bytes) -> bytes | None:
        """None if white space at its end may belong together with the next part's space."""
        text = part.decode()
        if text[-1:].isspace():
            return None
        if len(text) > LONG or (not text.isascii() and max(text) >= _LATIN_END):
            return self._whole(part)
        if not text.isprintable() and _DOUBTFUL.search(text):
            return self._whole(part)
        if not self.first_letters.isdisjoint(text) and any(token in text for token in self.added):
            return self._whole(part)
        return b"".join(map(self.pieces.__getitem__, PATTERN.findall(text)))

    def _piece(self, piece: str) -> bytes:
        return self._ids(piece.encode().decode("latin-1").translate(self.written))


def _cuts_at_spaces(spec: dict) -> bool:
    split, model = spec["pre_tokenizer"] or {}, spec["model"]
    return (
        spec["normalizer"] is None
        and (split.get("type"), split.get("add_prefix_space"), split.get("use_regex")) == ("ByteLevel", False, True)
        and (model["type"], model["dropout"]) == ("BPE", None)
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        and not any(" " in t["content"] for t in spec["added_tokens"])
    )
