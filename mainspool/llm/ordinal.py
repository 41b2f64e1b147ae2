"""Ordinal quality grades by a cumulative-link model on hashed text.

A document's grade is one of 0, 1, .., K. One weight vector over hashed features gives a
score, ordered thresholds cut it: P(grade >= k) is the logistic function of the score less
the k-th threshold. The model gives the expected grade (the sum of these probabilities) and
the tail probability of the top grade, by which documents are selected.

Features are present or not: lower-cased words and runs of marks, their first four and first
five letters, words in capitals, and the shares, in tenths, of marks, of capitals and of
repeated runs of three tokens. Each is hashed to one of ``2 ** BITS`` places with CRC-32. Only places
seen in at least ``LEAST`` training documents, whose mean grade lies ``LEAN`` standard errors from
the mean of all, get a weight.

The model is fitted on at most about ``sample`` rated documents, chosen by a hash of their
id; scoring reads all of every text. Null or empty texts have no features: their score is
zero, so the thresholds alone decide. Null grades are not trained on; of several
ratings of an id the lowest counts. Without two different grades nothing can be
learned, and every document gets the one known grade (the top one if there is none). Ties and
repeated rows get equal results.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mainspool.llm.common import append, per_worker

BITS = 18
LEAST = 8
LEAN = 6.0
SAMPLE = 8_000
STEPS = 200
SHRINK = 1e-4
RATE = 0.1

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+")
_MASK = (1 << BITS) - 1


def _place(feature: str) -> int:
    return crc32(feature.encode()) & _MASK


class Places(dict):
    """The places of a token's three features in one number, remembered for frequent tokens."""

    LIMIT = 300_000

    def __missing__(self, token: str) -> int:
        low = "^" if len(token) > 1 and token.isupper() else token.lower()
        code = _place(low) | _place(low[:4] + "-") << BITS | _place(low[:5] + "~") << 2 * BITS
        if len(self) < self.LIMIT:
            self[token] = code
        return code


def _tenths(name: str, part: int, whole: int) -> int:
    return _place(f"{name} {10 * part // max(whole, 1)}")


def features(text: str | None, places: Places) -> np.ndarray:
    """Distinct places of a whole text, in order."""
    tokens = _TOKEN.findall(text or "")
    if not tokens:
        return np.zeros(0, np.int32)
    codes = np.fromiter(map(places.__getitem__, tokens), np.int64, len(tokens))
    of_word = codes & _MASK
    marks = sum(not t[0].isalnum() for t in tokens)
    capitals = int((of_word == _CAPITALS).sum())
    three = (of_word[:-2] << BITS | of_word[1:-1]) * 0x9E3779B1 + of_word[2:]
    shares = [
        _tenths("marks", marks, len(tokens)),
        _tenths("capitals", capitals, len(tokens) - marks),
        _tenths("repeats", len(three) - len(np.unique(three)), len(three)),
    ]
    codes = np.unique(codes)
    return np.unique(np.concatenate([codes & _MASK, codes >> BITS & _MASK, codes >> 2 * BITS, shares])).astype(np.int32)


_CAPITALS = _place("^")


@dataclass
class Model:
    weights: np.ndarray
    cuts: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K, a row each."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - score[:, None], -40, 40)))


def fit(bags: list[np.ndarray], grades: np.ndarray, top: int) -> Model:
    """Maximum likelihood with shrunken weights, by full-batch Adam steps."""
    size = 1 << BITS
    known = sorted(set(grades.tolist()))
    if len(known) < 2:
        only = known[0] if known else top
        return Model(np.zeros(size, np.float32), np.where(np.arange(1, top + 1) <= only, -30.0, 30.0))
    row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    place = np.concatenate(bags)
    seen = np.bincount(place, minlength=size)
    use = seen[place] >= LEAST
    n = len(bags)
    off = grades - grades.mean()
    lean = np.bincount(place, off[row], size) / np.sqrt(np.maximum(seen, 1)) / max(off.std(), 1e-9)
    use &= np.abs(lean)[place] >= LEAN
    row, place = row[use], place[use]
    names, column = np.unique(place, return_inverse=True)
    above = np.array([(grades >= k).mean() for k in range(1, top + 1)]).clip(1e-3, 1 - 1e-3)
    w, cuts = np.zeros(len(names)), np.minimum.accumulate(above)
    cuts = np.maximum.accumulate(np.log((1 - cuts) / cuts) + np.arange(top) * 1e-3)
    w_m, w_v, c_m, c_v = np.zeros_like(w), np.zeros_like(w), np.zeros(top), np.zeros(top)
    for step in range(1, STEPS + 1):
        score = np.bincount(row, w[column], n)
        tail = np.c_[np.ones(n), 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -40, 40))), np.zeros(n)]
        slope = tail * (1 - tail)
        p = np.maximum(tail[np.arange(n), grades] - tail[np.arange(n), grades + 1], 1e-12)
        low, high = slope[np.arange(n), grades] / p, slope[np.arange(n), grades + 1] / p
        g_w = np.bincount(column, ((high - low) / n)[row], len(names)) + SHRINK * w
        g_c = np.zeros(top + 2)
        np.add.at(g_c, grades, low / n)
        np.add.at(g_c, grades + 1, -high / n)
        for x, g, m, v, rate in ((w, g_w, w_m, w_v, RATE), (cuts, g_c[1:-1], c_m, c_v, RATE)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        cuts[:] = np.maximum.accumulate(cuts + np.arange(top) * 1e-6)
    weights = np.zeros(size, np.float32)
    weights[names] = w
    return Model(weights, cuts)


def train(docs: DataFrame, ratings: DataFrame, grade: str, id: str = "doc_id", text: str = "text", top: int = 2, sample: int = SAMPLE) -> Model:
    """A model from the rated documents, at most about ``sample`` of them."""
    rated = ratings.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{grade}`").cast("int").alias("__grade"))
    rated = rated.where(F.col("__grade").between(0, top) & F.col("__id").isNotNull()).groupBy("__id").agg(F.min("__grade").alias("__grade"))
    share = min(1.0, sample / max(rated.count(), 1))
    chosen = rated.where(F.pmod(F.xxhash64("__id", F.lit("ordinal")), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{text}`").alias("__text"))

    def run(column: pa.Array) -> list[pa.Array]:
        places = per_worker("ordinal places", Places)
        return [pa.array([features(t, places) for t in column.to_pylist()], pa.list_(pa.int32()))]

    # one text of each id: the sample is bounded though ids may repeat
    rows = texts.join(chosen, "__id").groupBy("__id", "__grade").agg(F.min("__text").alias("__text"))
    found = append(rows, "bag array<int>", run, "__text", keep=["__id", "__grade"]).toArrow().sort_by("__id")
    bags = found.column("bag").combine_chunks()
    offsets, places = bags.offsets.to_numpy(), bags.values.to_numpy()
    return fit([places[a:b] for a, b in zip(offsets, offsets[1:])], found.column("__grade").to_numpy().astype(np.int64), top)


def grade(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability``, that of the top grade."""
    key = f"{crc32(model.weights.tobytes())} {model.cuts.tolist()}"
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.cuts))

    def run(column: pa.Array) -> list[pa.Array]:
        m = per_worker(("ordinal model", key), lambda: Model(*sent.value))
        places = per_worker("ordinal places", Places)
        score = np.array([float(m.weights[features(t, places)].sum(dtype=np.float64)) for t in column.to_pylist()])
        tails = m.tails(score)
        return [pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])]

    return append(docs, "expected_grade double, tail_probability double", run, text, keep=keep)
