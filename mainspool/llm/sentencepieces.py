"""SentencePiece encoding and decoding on a public model file.

Encoding: an Aho-Corasick automaton over the model's pieces reports, for each position of
the text, every piece that ends there, by following its output links. One pass over these
matches relaxes the best score of each position (Viterbi); the best path, read backwards,
is the segmentation of highest summed piece score, the library's unigram lattice's best.
Characters that no piece covers cost the lowest score less ten and become their UTF-8
bytes' pieces, or the unknown piece where the model has none.

Of two paths of one score, the one whose last piece is longer wins. Spaces are written as
U+2581 with one in front of the text, as the model's normaliser does, so a U+2581 in a text
is read back as a space. The scores come from the file; for a file that was trained for pair
merging the segmentation is the best-scoring one, not the order-of-merges one.

Null text: null ids, count and round trip. Empty text: no ids. Repeated rows are encoded
each. Texts are read whole, whatever their length: no piece spans a cut made before a
space, at a line end or between a word and a mark, so the passes between cuts are
independent and memory follows the longest stretch without a space.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mainspool.llm.common import append, per_worker

#: Fixed value: the mark the format writes for a space.
SPACE = "▁"

#: Fixed value: how far below the lowest score an uncovered character lies.
UNKNOWN_PENALTY = 10.0

#: Segments of frequent stretches a worker remembers, at most so many.
MEMO = 400_000


class Pieces:
    """A model file's pieces, their automaton, and both directions."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.unknown = sp.unk_id()
        self.byte_ids = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.automaton = ahocorasick.Automaton()
        singles, pairs, inside = set(), set(), set()
        for i in plain:
            piece = sp.id_to_piece(i)
            self.automaton.add_word(piece, (len(piece) - 1, sp.get_score(i), i))
            inside.update(piece)
            pairs.update(zip(piece, piece[1:]))
            if len(piece) == 1:
                singles.add(piece)
        self.automaton.make_automaton()
        self.floor = min((sp.get_score(i) for i in plain), default=0.0) - UNKNOWN_PENALTY
        self.covered = singles.issuperset
        self.singles = singles
        self.bytes_of = [b""] * size
        for i in plain:
            self.bytes_of[i] = sp.id_to_piece(i).replace(SPACE, " ").encode()
        for b, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([b])
        self.bytes_of[self.unknown] = " ⁇ ".encode()
        self.stretches = self._cuts(pairs, inside)
        self.memo: dict[str, list[int]] = {}

    @staticmethod
    def _cuts(pairs: set[tuple[str, str]], inside: set[str]) -> re.Pattern:
        """A pattern whose matches no piece spans two of."""
        if any(b == SPACE and a != SPACE for a, b in pairs) or "\n" in inside:
            return re.compile(r"(?s).+")
        marks = set("#*$%&!|.,;:?")
        while bad := {b for a, b in pairs if b in marks and a not in marks and a != SPACE}:
            marks -= bad
        m = "".join(map(re.escape, sorted(marks)))
        word = f"{SPACE}*[^{SPACE}\n{m}]+"
        return re.compile(f"{word}|{SPACE}*[{m}][^{SPACE}\n]*|{SPACE}+|\n" if m else f"{word}|{SPACE}+|\n")

    def best(self, text: str) -> list[int]:
        """The best segmentation of one stretch."""
        if not self.covered(text):
            return self._best_with_gaps(text)
        score, piece, start, last = [0.0], [], [], -1
        for end, (back, value, i) in self.automaton.iter(text):
            value += score[end - back]
            if end != last:  # the first, longest piece that ends here
                score.append(value)
                piece.append(i)
                start.append(end - back)
                last = end
            elif value > score[end + 1]:
                score[end + 1], piece[end], start[end] = value, i, end - back
        out, at = [], len(text)
        while at:
            out.append(piece[at - 1])
            at = start[at - 1]
        out.reverse()
        return out

    def _best_with_gaps(self, text: str) -> list[int]:
        """The same where some characters have no piece of their own."""
        n = len(text)
        ends: list[list] = [[] for _ in range(n)]
        for end, found in self.automaton.iter(text):
            ends[end].append(found)
        score, piece, start = [0.0] * (n + 1), [None] * n, [0] * n
        for end in range(n):
            top = -np.inf
            for back, value, i in ends[end]:
                if value + score[end - back] > top:
                    top, piece[end], start[end] = value + score[end - back], i, end - back
            if text[end] not in self.singles and score[end] + self.floor > top:
                top, piece[end], start[end] = score[end] + self.floor, None, end
            score[end + 1] = top
        out, at = [], n
        while at:
            i = piece[at - 1]
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in reversed(text[at - 1].encode())]
            elif not (out and out[-1] == self.unknown):
                out.append(self.unknown)
            at = start[at - 1]
        out.reverse()
        return out

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        memo, best = self.memo, self.best
        for stretch in self.stretches.findall(SPACE + text.replace(" ", SPACE)):
            ids = memo.get(stretch)
            if ids is None:
                ids = best(stretch)
                if len(memo) < MEMO and len(stretch) <= 64:
                    memo[stretch] = ids
            out += ids
        return out

    def decode(self, ids) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def load(path: str) -> bytes:
    """The model file, read once on the driver and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def _pieces(model: bytes) -> Pieces:
    return per_worker(("pieces", hashlib.sha1(model).digest()), lambda: Pieces(model))


def encode(docs: DataFrame, model: bytes, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``round_trip`` (decoding gives the text back)."""

    def run(texts: pa.Array) -> list[pa.Array]:
        pieces = _pieces(model)
        ids, same = [], []
        for t in texts.to_pylist():
            if t is None:
                ids.append(None)
                same.append(None)
                continue
            found = pieces.encode(t)
            same.append(pieces.decode(found) == t.replace(SPACE, " "))
            ids.append(np.asarray(found, np.int32))
        return [
            pa.array(ids, pa.list_(pa.int32())),
            pa.array([None if x is None else len(x) for x in ids], pa.int64()),
            pa.array(same, pa.bool_()),
        ]

    return append(docs, "ids array<int>, n_tokens bigint, round_trip boolean", run, text, keep=keep)


def decode(rows: DataFrame, model: bytes, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``rows`` with ``decoded``, the text of the ids; null for null ids."""

    def run(lists: pa.Array) -> list[pa.Array]:
        pieces = _pieces(model)
        return [pa.array([None if x is None else pieces.decode(x) for x in lists.to_pylist()], pa.string())]

    return append(rows, "decoded string", run, ids, keep=keep)
