"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap.

The test items make an inverted index: for each term the items that hold it, their BM25
impacts, the list's largest impact and the largest of each block of items. Every passage of
every document is a query: windows of twice the longest item's words, one longest item
apart, so that any item that occurs lies whole in some window.

An item's impacts are divided by its own threshold: its full score less its heaviest
``missing`` terms, the most that a passage may lack and still pass verification. So the
threshold of retrieval is 1 for all items, and no verified pair is lost before verification.
Terms are put before the pivot, commonest first, as long as no item gets more than a set share
of its threshold from such terms alone; only the lists behind the pivot propose results. For a batch of passages at a time,
a passage is dropped if the bounds of its lists behind the pivot do not reach what is
lacking; a block of items if its own maxima do not; an item if its own impacts do not. What
is left is scored in full. All items above the threshold are retrieved, however many.

Verification: an item's last sentence is its answer, what stands before is the question (one
sentence: halves of its words). A pair is a leak if the passage holds at least
``overlap`` of the five-word shingles of question and answer together; both shares are given.
Words are runs of letters and digits, lower-cased.

Null or empty texts leak nothing; items without words match nothing; repeated items are each
reported; repeated documents are each checked. Very long texts are read whole. The index is
sent to the tasks only up to ``index_bytes`` of item text; more items are dealt into
several indexes. Document frequencies, lengths and the passages' length are then counted over all items in one job, so that
scores are those of one index, and the indexes go over the documents one after the other, so that a worker and
the driver hold one at a time. What they find is a row per text that leaks, joined back by the texts' digests.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mainspool.llm.common import append, materialise, per_worker

#: BM25's usual parameters, and the contract's shingles and similarity.
K1, B = 1.2, 0.75
SHINGLE, OVERLAP = 5, 0.8

#: Items in a block of a list; bytes of item text in one index.
BLOCK, INDEX_BYTES = 16, 8 << 20

#: The share of its threshold that an item may get before the pivot.
BEFORE = 0.6

#: The threshold, with room for rounding.
EDGE = 1 - 1e-9

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")

_LEAK = pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())])
LEAKS = "array<struct<item_id:bigint,score:double,question:double,answer:double>>"


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [w for w in map(words, _SENTENCE.split(text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    whole = parts[0] if parts else []
    return whole[: len(whole) // 2], whole[len(whole) // 2 :]


def shingles(ws: list) -> set[tuple]:
    if len(ws) < SHINGLE:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i : i + SHINGLE]) for i in range(len(ws) - SHINGLE + 1)}


@dataclass
class Index:
    """Postings in term order; impacts are relative to each item's threshold."""

    ids: list
    vocabulary: dict[str, int]
    start: np.ndarray  # of each term's postings
    item: np.ndarray
    impact: np.ndarray
    behind: np.ndarray  # whether a term is behind the pivot
    bound: np.ndarray  # the largest impact of each term
    block_start: np.ndarray  # of each term's blocks
    block: np.ndarray
    block_bound: np.ndarray
    before: np.ndarray  # the most each item gets before the pivot
    block_before: np.ndarray  # the most an item of each block gets there
    questions: list[set]
    answers: list[set]
    longest: int


class Lookup(dict):
    """Term numbers of the words of a blank-separated token; remembers frequent tokens.

    One word: its number, or -1 for none of the index. No word: -2. Several: -3 less a
    place in ``several``.
    """

    LIMIT = 300_000

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary
        self.several: list[list[int]] = []

    def __missing__(self, token: str) -> int:
        found = [self.vocabulary.get(w, -1) for w in words(token)]
        if len(found) == 1:
            code = found[0]
        elif not found:
            code = -2
        else:
            code = -3 - len(self.several)
            self.several.append(found)
        if len(self) < self.LIMIT:
            self[token] = code
        return code

    def numbers(self, text: str | None) -> np.ndarray:
        tokens = (text or "").lower().split()
        out = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        if len(out) and out.min() < -1:
            if out.min() < -2:
                out = np.array([x for c in out.tolist() for x in ((c,) if c > -3 else self.several[-3 - c])], np.int64)
            out = out[out != -2]
        if len(self.several) > self.LIMIT:
            self.clear()
            self.several = []
        return out


@dataclass(frozen=True)
class Whole:
    """What an index of some of the items has to know of all of them."""

    n: int
    mean: float
    longest: int
    df: dict[str, int]  # of its own words


def build(items: list[tuple[object, str | None]], overlap: float = OVERLAP, whole: Whole | None = None) -> Index:
    items = sorted(((i, t) for i, t in items if words(t)), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    bags = [words(t) for _, t in items]
    vocabulary = {w: k for k, w in enumerate(sorted({w for b in bags for w in b}))}
    n, longest = len(bags), max(map(len, bags), default=1)
    mean = sum(map(len, bags)) / max(n, 1)
    holds: list[list[tuple[int, int]]] = [[] for _ in vocabulary]
    for k, bag in enumerate(bags):
        for w in sorted(set(bag)):
            holds[vocabulary[w]].append((k, bag.count(w)))
    term = np.array([t for t, h in enumerate(holds) for _ in h], np.int64)
    item = np.array([k for h in holds for k, _ in h], np.int64)
    tf = np.array([c for h in holds for _, c in h], float)
    df = np.array([len(h) for h in holds], float)
    every = n
    if whole is not None:
        every, mean, longest = whole.n, whole.mean, whole.longest
        df = np.array([whole.df[w] for w in vocabulary], float)
    idf = np.log1p((every - df + 0.5) / (df + 0.5))
    size = np.array([len(b) for b in bags], float)
    impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[item] / max(mean, 1))) if n else np.zeros(0)
    questions, answers, threshold = [], [], np.ones(n)
    for k, (_, text) in enumerate(items):
        q, a = question_and_answer(text)
        questions.append({tuple(vocabulary[w] for w in s) for s in shingles(q)})
        answers.append({tuple(vocabulary[w] for w in s) for s in shingles(a)})
        # a missing word takes a shingle with it, but for four words of a part that is gone
        missing = int((1 - overlap) * (len(questions[-1]) + len(answers[-1])) + 1e-9) + SHINGLE - 1
        own = np.sort(impact[item == k])
        threshold[k] = max(own[: max(len(own) - missing, 1)].sum(), 1e-6)
    impact = impact / threshold[item] if n else impact
    start = np.searchsorted(term, np.arange(len(vocabulary) + 1))
    behind, got = np.ones(len(vocabulary), bool), np.zeros(n)
    for t in np.argsort(-df, kind="stable"):
        at = slice(start[t], start[t + 1])
        if (got[item[at]] + impact[at]).max() < BEFORE:
            got[item[at]] += impact[at]
            behind[t] = False
    key = term * (n // BLOCK + 1) + item // BLOCK
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return Index(
        ids=[i for i, _ in items],
        vocabulary=vocabulary,
        start=start,
        item=item,
        impact=impact,
        behind=behind,
        bound=np.maximum.reduceat(impact, start[:-1]) if n else impact,
        block_start=np.searchsorted(term[first], np.arange(len(vocabulary) + 1)),
        block=item[first] // BLOCK,
        block_bound=np.maximum.reduceat(impact, first) if n else impact,
        before=got,
        block_before=np.array([got[k : k + BLOCK].max() for k in range(0, n, BLOCK)]),
        questions=questions,
        answers=answers,
        longest=longest,
    )


def _spread(start: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of terms: the row and the place of each entry of their lists."""
    count = start[terms + 1] - start[terms]
    row = np.repeat(np.arange(len(terms)), count)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + start[terms][row]
    return row, place


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, in order, and the sum of the values of each."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else order
    return keys[first], np.add.reduceat(values, first) if len(first) else values


def candidates(index: Index, passage: np.ndarray, term: np.ndarray) -> np.ndarray:
    """Passages that can hold a result, from distinct (passage, term) behind the pivot."""
    if not len(passage):
        return passage
    total = np.bincount(passage, index.bound[term])
    some = total[passage] >= EDGE - index.block_before.max()
    passage, term = passage[some], term[some]
    row, place = _spread(index.block_start, term)
    blocks = len(index.block_before)
    keys, reach = _sums(passage[row] * blocks + index.block[place], index.block_bound[place])
    keys = keys[reach + index.block_before[keys % blocks] >= EDGE]
    some = np.isin(passage, keys // blocks)
    passage, term = passage[some], term[some]
    row, place = _spread(index.start, term)
    items = len(index.ids)
    keys, score = _sums(passage[row] * items + index.item[place], index.impact[place])
    return np.unique(keys[score + index.before[keys % items] >= EDGE] // items)


def scores(index: Index, terms: np.ndarray) -> dict[int, float]:
    """Items whose score for a passage of these distinct terms reaches the threshold."""
    _, place = _spread(index.start, terms)
    score = np.bincount(index.item[place], index.impact[place], len(index.ids))
    return {int(i): float(score[i]) for i in np.flatnonzero(score >= EDGE)}


def leaks_of(index: Index, lookup: Lookup, texts: list[str | None], overlap: float = OVERLAP) -> list[list[dict]]:
    """The leaks of each text, by item; of several passages that hold an item the best counts."""
    best: list[dict] = [{} for _ in texts]
    if not index.ids:
        return [[] for _ in texts]
    span, width = index.longest, len(index.vocabulary)
    ids = [lookup.numbers(t) for t in texts]
    size = np.array([len(x) for x in ids])
    first = np.r_[0, np.cumsum(-(-size // span) + 1)]  # of each text's passages
    flat = np.concatenate(ids)
    behind = np.flatnonzero((flat >= 0) & index.behind[flat])
    text = np.searchsorted(np.cumsum(size), behind, "right")
    block = (behind - (np.cumsum(size) - size)[text]) // span
    passage = first[text] + block
    # a word is in the passage that starts with its stretch, and in the one before
    twice = np.concatenate([passage[block > 0] - 1, passage])
    terms = np.concatenate([flat[behind][block > 0], flat[behind]])
    distinct = np.sort(twice * width + terms)
    if len(distinct):
        distinct = distinct[np.r_[True, distinct[1:] != distinct[:-1]]]
    for p in candidates(index, distinct // width, distinct % width).tolist():
        d = int(np.searchsorted(first, p, "right")) - 1
        k = p - int(first[d])
        here = ids[d][k * span : (k + 2) * span]
        for item, score in scores(index, np.unique(here[here >= 0])).items():
            question, answer = index.questions[item], index.answers[item]
            seen = here.tolist()
            held = {s for n in {len(s) for s in question | answer} for s in zip(*(seen[i:] for i in range(n)))}
            q, a = len(question & held), len(answer & held)
            if q + a >= overlap * (len(question) + len(answer)) - 1e-9:
                found = (q + a, score, q / max(len(question), 1), a / max(len(answer), 1))
                best[d][item] = max(best[d].get(item, found), found)
    return [[{"item_id": index.ids[i], "score": s, "question": q, "answer": a} for i, (_, s, q, a) in sorted(b.items())] for b in best]


def _words_of(batches):
    """The distinct words of items, and a row without a word that says how many there are in all."""
    for batch in batches:
        part, word, size = [], [], []
        for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            bag = words(text)
            if bag:
                some = [None, *sorted(set(bag))]
                part += [k] * len(some)
                word += some
                size += [len(bag)] * len(some)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(word, pa.string()), pa.array(size, pa.int64())], names=["part", "word", "size"])


def _in_parts(texts: DataFrame, items: DataFrame, indexes: int, overlap: float) -> DataFrame:
    """``digest, leaks`` of every text that leaks, by ``indexes`` indexes one after the other."""
    sc = texts.sparkSession.sparkContext
    dealt = items.withColumn("part", F.pmod(F.xxhash64("i", "t"), F.lit(indexes)).cast("int"))
    held = materialise(dealt.select("part", "t").mapInArrow(_words_of, "part int, word string, size bigint"))
    sizes = held.where("word is null").agg(F.count("*"), F.avg("size"), F.max("size")).first()
    counts = held.where("word is not null").groupBy("word").agg(F.count("*").alias("df"), F.collect_set("part").alias("parts"))
    counts = materialise(counts.select("word", "df", F.explode("parts").alias("part")))
    found = []
    for k in range(indexes):
        rows = [(r.i, r.t) for r in dealt.where(F.col("part") == k).collect()]
        df = {r.word: r.df for r in counts.where(F.col("part") == k).collect()}
        sent, key = sc.broadcast((rows, Whole(sizes[0], sizes[1] or 0.0, sizes[2] or 1, df))), uuid.uuid4().hex
        marked = append(texts, f"leaks {LEAKS}", _finder(sent, key, overlap), "t").where(F.size("leaks") > 0)
        found.append(materialise(marked.select(F.sha2("t", 256).alias("digest"), "leaks").dropDuplicates(["digest"])))
        sent.unpersist()
    each = found[0]
    for more in found[1:]:
        each = each.unionAll(more)
    by_item = "array_sort(flatten(collect_list(leaks)), (a, b) -> CASE WHEN a.item_id < b.item_id OR b.item_id IS NULL THEN -1 WHEN a.item_id > b.item_id OR a.item_id IS NULL THEN 1 ELSE 0 END)"
    return each.groupBy("digest").agg(F.expr(by_item).alias("leaks"))


def _finder(sent, key: str, overlap: float):
    def run(texts: pa.Array) -> list[pa.Array]:
        index = per_worker(("leak index", key), lambda: build(sent.value[0], overlap, sent.value[1]))
        lookup = per_worker(("leak words", key), lambda: Lookup(index.vocabulary))
        return [pa.array(leaks_of(index, lookup, texts.to_pylist(), overlap), pa.list_(_LEAK))]

    return run


def find_leaks(docs: DataFrame, items: DataFrame, id: str = "item_id", text: str = "text", item_text: str = "text", keep: list[str] | None = None, overlap: float = OVERLAP, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``docs`` with ``leaks``, an array of (item_id, score, question, answer); often empty."""
    items = items.select(F.col(f"`{id}`").alias("i"), F.col(f"`{item_text}`").alias("t"))
    indexes = max(1, -(-(items.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // index_bytes))
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != "leaks"]
    if indexes == 1:
        rows = [tuple(r) for r in items.collect()]
        sent = docs.sparkSession.sparkContext.broadcast((rows, None))
        return append(docs, f"leaks {LEAKS}", _finder(sent, uuid.uuid4().hex, overlap), text, keep=keep)
    found = _in_parts(docs.select(F.col(f"`{text}`").alias("t")), items, indexes, overlap)
    found = found.withColumnsRenamed({"digest": "__digest", "leaks": "__leaks"})
    own = docs.select(*(F.col(f"`{c}`") for c in keep), F.sha2(F.col(f"`{text}`"), 256).alias("__of"))
    joined = own.join(found, F.col("__of") == F.col("__digest"), "left")
    return joined.select(*(F.col(f"`{c}`") for c in keep), F.coalesce("__leaks", F.expr(f"cast(array() AS {LEAKS})")).alias("leaks"))
