"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search goes over the text once. At each boundary it keeps the best way to reach it: the last piece and where that
begins. In a unigram model the best way has the largest sum of scores. In a BPE model a way is valid only if every two
neighbouring pieces are what the model's merges make of their two strings; each boundary then has exactly one way, and
the ids equal those of merging. No piece is longer than the longest one, so only that many boundaries can still be
continued. Whenever the ways to all of them come from one boundary, the ids up to it are committed and forgotten: memory
follows the distance between such boundaries, not the text.

A space becomes the sign U+2581, one is put in front, and characters without a piece become byte pieces, which join with
nothing. Where no piece of the model crosses from a letter to that sign, every word starts at a boundary on which all
ways agree; the ids of words are then remembered in a table of bounded size.

Null and empty texts have no pieces and decode to an empty text. Columns other than those named are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallybank.llm.token_ids import Known
from tallybank.llm.words import text_bytes

SIGN = "▁"
MOST_SEGMENTS, MOST_PAIRS = 160_000, 120_000


class Pieces:
    """A vocabulary: scores of the pieces, byte pieces, and whether pieces are merged (BPE) or summed (unigram)."""

    def __init__(self, scores: dict[str, float], ids: dict[str, int], byte_ids: list[int], merged: bool):
        self.scores, self.ids, self.byte_ids, self.merged = scores, ids, byte_ids, merged
        self.longest = max(map(len, scores), default=1)
        self.names = {i: piece for piece, i in ids.items()}
        self.follows = Known(self._follows, MOST_PAIRS)
        whole = (piece for piece in ids if not merged or self.merge(piece) == [piece])
        self.usable = {piece: (ids[piece], scores[piece]) for piece in whole}
        self.whole_ids = {piece: id_ for piece, (id_, _) in self.usable.items()}
        self.endings = {piece[k:] for piece in self.usable for k in range(len(piece))} if merged else set()
        self.characters = {piece for piece in scores if len(piece) == 1}
        self.inside = {piece[k : k + 2] for piece in scores for k in range(len(piece) - 1)}
        crossed = any(pair[0] != SIGN and pair[1] == SIGN for pair in self.inside)
        self.segments = re.compile(r"(?s).+" if crossed else f"{SIGN}+[^{SIGN}]*|[^{SIGN}]+")
        self.known = Known(self._segment, MOST_SEGMENTS)
        self.atoms = Known(self._atom, MOST_SEGMENTS)
        table = {i: piece.replace(SIGN, " ").encode() for piece, i in ids.items()}
        self.bytes_of = table | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.changed: set[str] = set()

    @staticmethod
    @cache
    def of(path: str) -> Pieces:
        """One per Python worker."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        plain = [i for i in every if not any(is_kind(i) for is_kind in special)]
        names = {model.id_to_piece(i): i for i in plain}
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        scores = {name: model.get_score(i) for name, i in names.items()}
        # Scores of a BPE model are negative ranks; those of a unigram model are log probabilities.
        merged = all(score == round(score) for score in scores.values())
        return Pieces(scores, names, byte_ids, merged)

    def merge(self, text: str) -> list[str]:
        """Join the neighbours whose joint piece has the best score, leftmost first, until none can be joined."""
        parts = list(text)
        while True:
            joins = [(-self.scores[p], k) for k in range(len(parts) - 1) if (p := parts[k] + parts[k + 1]) in self.scores]
            if not joins:
                return parts
            k = min(joins)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def _follows(self, pair: int) -> bool:
        """Whether merging the strings of two pieces, packed into one number, gives just these two."""
        first, second = self.names[pair >> 32], self.names[pair & 0xFFFFFFFF]
        return self.merge(first + second) == [first, second]

    def forget(self) -> None:
        """Give the memory of remembered ids back, at the end of a task. Pairs of pieces are those of any text, so they stay."""
        for known in (self.known, self.atoms):
            known.forget()
        self.changed.clear()

    def _segment(self, text: str) -> bytes:
        """Ids of one segment. A segment whose ids do not decode to it is noted in `changed`."""
        ids = self._ids(text)
        pieces = np.frombuffer(ids, "<u4").tolist()
        if b"".join(map(self.bytes_of.__getitem__, pieces)) != text.replace(SIGN, " ").encode():
            self.changed.add(text)
        return ids

    def _ids(self, text: str) -> bytes:
        """Cut where no piece has the two characters next to each other."""
        inside = self.inside
        cuts = [k for k, pair in enumerate(map(add, text, text[1:]), 1) if pair not in inside]
        if not cuts:
            return self.atoms[text]
        return b"".join([self.atoms[text[a:b]] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)])

    def _atom(self, text: str) -> bytes:
        if self.merged and len(text) <= 4 * self.longest and self.characters.issuperset(text):
            return self._short(text)
        return b"".join(self.search(text))

    def _short(self, text: str) -> bytes:
        """As `_run` in a BPE model, for a text that ends before its first commit. Every boundary has one way, so the order in
        which ways are tried does not matter: after the last piece with one more character, from the shortest piece on, as
        long as a piece can end so."""
        piece_at, follows, endings = self.whole_ids.get, self.follows, self.endings
        begins, lasts = [0], [-1]
        for end in range(1, len(text) + 1):
            begin = begins[-1]
            id_ = piece_at(text[begin:end])
            if id_ is None or ((last := lasts[begin]) >= 0 and not follows[last << 32 | id_]):
                id_, begin = -1, end - 1
                while begin >= 0 and (part := text[begin:end]) in endings:
                    found = piece_at(part)
                    if found is not None and ((last := lasts[begin]) < 0 or follows[last << 32 | found]):
                        id_ = found
                        break
                    begin -= 1
            begins.append(begin)
            lasts.append(id_)
        found, end = [], len(text)
        while end > 0:
            found.append(lasts[end])
            end = begins[end]
        return array("I", found[::-1]).tobytes()

    def search(self, text: str) -> Iterator[bytes]:
        """Ids of one segment, packed, as they are committed."""
        run = 0
        for at, char in enumerate(text):
            if char not in self.scores:
                yield from self._run(text[run:at])
                yield np.array([self.byte_ids[b] for b in char.encode()], "<u4").tobytes()
                run = at + 1
        yield from self._run(text[run:])

    def _run(self, text: str) -> Iterator[bytes]:
        """Characters that all have pieces. The lists hold the boundaries since the last commit, at `base`."""
        piece_at, follows, merged, longest = self.usable.get, self.follows, self.merged, self.longest
        base, begins, lasts, totals = 0, [0], [-1], [0.0]
        for end in range(1, len(text) + 1):
            from_, id_, total = -1, -1, 0.0
            if merged and (begin := begins[-1]) >= base and (piece := piece_at(text[begin:end])):
                # Only one way can be valid, and it is often the last piece with one more character.
                last = lasts[begin - base]
                if last < 0 or follows[last << 32 | piece[0]]:
                    from_, id_ = begin, piece[0]
            for begin in range(max(base, end - longest), end) if id_ < 0 else ():
                piece = piece_at(text[begin:end])
                if piece is None:
                    continue
                last = lasts[begin - base]
                if merged:
                    if last < 0 or follows[last << 32 | piece[0]]:
                        from_, id_ = begin, piece[0]
                        break
                elif id_ < 0 or totals[begin - base] + piece[1] > total:
                    from_, id_, total = begin, piece[0], totals[begin - base] + piece[1]
            begins.append(from_)
            lasts.append(id_)
            totals.append(total)
            if end == len(text) or len(begins) > 4 * self.longest:
                meet = end if end == len(text) else self._meet(begins, base, end)
                if meet > base:
                    yield self._path(begins, lasts, base, meet)
                    keep = meet - base
                    base, begins, lasts, totals = meet, begins[keep:], lasts[keep:], totals[keep:]

    def _meet(self, begins: list[int], base: int, end: int) -> int:
        """The boundary that the ways to all boundaries that can still be continued have in common."""
        live = set(range(max(base, end - self.longest + 1), end + 1))
        while len(live) > 1:
            latest = max(live)
            live.remove(latest)
            live.add(max(base, begins[latest - base]))
        return live.pop()

    def _path(self, begins: list[int], lasts: list[int], base: int, end: int) -> bytes:
        found = []
        while end > base:
            found.append(lasts[end - base])
            end = begins[end - base]
        return np.array(found[::-1], "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        signed = SIGN + text.replace(" ", SIGN)
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.segments.findall(signed))), "<u4")

    def encode_checked(self, text: str) -> tuple[np.ndarray, bool]:
        """Ids, and whether they decode to the text: known per segment, so that no id is decoded again.

        The sign in front comes back as a space, which decoding takes away; a sign in the text comes back as a space.
        """
        if not text:
            return np.zeros(0, np.uint32), True
        segments = self.segments.findall(SIGN + text.replace(" ", SIGN))
        ids = np.frombuffer(b"".join(map(self.known.__getitem__, segments)), "<u4")
        return ids, SIGN not in text and (not self.changed or self.changed.isdisjoint(segments))

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, model: str, keep: list[str]) -> DataFrame:
    """The columns `keep` of `docs` with `piece_ids`, and whether decoding them gives the text back.

    U+2581 in a text comes back as a space, so such a text does not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(model)
        for batch in batches:
            data, at = text_bytes(batch["text"])
            for row in range(0, batch.num_rows, 256):
                texts = [data[a:b].tobytes() for a, b in zip(at[row : row + 256], at[row + 1 : row + 257], strict=False)]
                found = [pieces.encode_checked(text.decode()) for text in texts]
                ids = [i for i, _ in found]
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = pa.array(np.concatenate(ids).astype(np.int32))
                yield pa.record_batch(
                    {name: batch[name].slice(row, len(ids)) for name in keep}
                    | {
                        "piece_ids": pa.ListArray.from_arrays(pa.array(offsets), flat),
                        "round_trip": pa.array([same for _, same in found], pa.bool_()),
                    }
                )
        pieces.forget()
        pa.default_memory_pool().release_unused()

    kinds = dict(docs.dtypes)
    schema = "".join(f"`{name}` {kinds[name]}, " for name in keep) + "piece_ids array<int>, round_trip boolean"
    return docs.select(*keep, "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, keep: list[str]) -> DataFrame:
    """The columns `keep` of `encoded` with the text that its `piece_ids` stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(model)
        for batch in batches:
            for row in range(0, batch.num_rows, 512):
                part = batch.slice(row, 512)
                texts = [pieces.decode(ids.values.to_numpy().tolist()) for ids in part["piece_ids"]]
                yield pa.record_batch({name: part[name] for name in keep} | {"decoded": pa.array(texts, pa.string())})

    kinds = dict(encoded.dtypes)
    schema = "".join(f"`{name}` {kinds[name]}, " for name in keep) + "decoded string"
    return encoded.select(*dict.fromkeys([*keep, "piece_ids"])).mapInArrow(run, schema)
