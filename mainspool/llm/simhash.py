"""SimHash near-duplicates by a Gray-order hierarchical index.

A fingerprint has one bit for each bit that is set in more than half of the text's shingle
hashes. Documents whose fingerprints differ in at most ``radius`` bits are linked, and a
document's class is all that can be reached over links.

The index has three levels, all of them exact:

1. Distinct fingerprints are sorted by their rank in Gray order (a range partitioning, so
   no fingerprint and no class is a hot key) and cut into leaves: runs of neighbours close
   to the first of the run.
2. The 64 bits are cut into ``blocks`` blocks. Two fingerprints that differ in ``radius``
   bits agree on at least ``blocks - radius`` whole blocks, so for each choice of that many
   blocks the masked pattern is an upper node, and each linked pair meets below one. A leaf
   hangs below a node as one row for each pattern it has, so a dense class moves as
   a few arrays.
3. Below a node, each leaf is a node of the bits its members share. Whole leaves are pruned
   when the differences from their shared bits alone exceed ``radius``; only members of the
   others are compared. The search walks from member to member and compares what has not
   been reached yet, so a dense class costs about one comparison a member, and its links
   come out as one star, not as pairs.

Null and empty texts have fingerprint zero and are linked like any other. Null ids take part
but are never a class id (a class of null ids only has a null id). Repeated rows stay, each
with its class. Equal distances need no rule: classes do not depend on order.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mainspool.llm.common import append, materialise, without
from mainspool.llm.components import components

#: The contract's shingle length, hash seed and link distance.
SHINGLE, SEED, RADIUS = 4, 42, 4

#: Members of a leaf, and differences from its first member, at most.
LEAF, SPREAD = 64, 8

#: Members that a node may have on average before the blocks are cut finer.
CROWD = 64


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text; 0 for no words."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) < width:
        hashes = [h(b" ".join(words), SEED)]
    else:
        hashes = [h(b" ".join(words[i : i + width]), SEED) for i in range(len(words) - width + 1)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 16384):
        part = np.array(hashes[at : at + 16384], np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long."""

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64).view(np.int64))]

    return append(docs, f"{name} bigint", run, text, keep=keep)


def gray_rank(fps: DataFrame) -> DataFrame:
    """``fp, g``: g sorts, as a signed long, like the fingerprint's rank in Gray order."""
    ranked = fps.select("fp", F.col("fp").alias("g"))
    for s in (1, 2, 4, 8, 16, 32):  # the rank is the prefix parity of the bits
        ranked = ranked.select("fp", F.expr(f"g ^ shiftrightunsigned(g, {s})").alias("g"))
    return ranked.select("fp", F.expr("g ^ shiftleft(1L, 63)").alias("g"))


def _masks(blocks: int, radius: int) -> np.ndarray:
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return np.array([sum(c) for c in combinations(parts, blocks - radius)], np.uint64)


def _blocks_for(count: int, radius: int) -> int:
    """Fewest blocks whose nodes have ``CROWD`` members on average at most."""
    for blocks in range(radius + 2, radius + 6):
        if count / 2 ** (64 * (blocks - radius) // blocks) <= CROWD:
            return blocks
    return radius + 5


def _leaf_numbers(fps: np.ndarray) -> np.ndarray:
    """A number for each run of neighbours that are close to the first of the run."""
    out, n, at, k = np.zeros(len(fps), np.int64), len(fps), 0, 0
    while at < n:
        run = fps[at : at + LEAF]
        near = np.bitwise_count(run ^ run[0]) <= SPREAD
        size = len(run) if near.all() else int(near.argmin())
        out[at : at + size] = k
        at, k = at + size, k + 1
    return out


def _upper_nodes(masks: np.ndarray):
    """Rows (choice, pattern, members) of the leaves of a sorted partition."""

    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(fps):
                continue
            leaf = _leaf_numbers(fps)
            for k, mask in enumerate(masks):
                pattern = fps & mask
                order = np.lexsort((pattern, leaf))
                p, g, f = pattern[order], leaf[order], fps[order]
                first = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (g[1:] != g[:-1])])
                offsets = pa.array(np.r_[first, len(f)].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first), k, np.int32)), pa.array(p[first].view(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(f.view(np.int64)))],
                    names=["choice", "pattern", "members"],
                )

    return run


def reach(leaves: list[np.ndarray], radius: int) -> list[tuple[int, int]]:
    """A star (member, smallest member) for each class below one node."""
    if len(leaves) > 1 and max(map(len, leaves)) < LEAF // 4:  # many small ones: cut again
        whole = np.sort(np.concatenate(leaves))
        leaves = np.split(whole, np.arange(LEAF, len(whole), LEAF))
    rest = np.concatenate(leaves)
    of = np.repeat(np.arange(len(leaves)), [len(x) for x in leaves])
    common = np.array([np.bitwise_and.reduce(x) for x in leaves])
    shared = ~(common ^ np.array([np.bitwise_or.reduce(x) for x in leaves]))
    out = []
    while len(rest) > 1:
        group, todo = [rest[0]], [rest[0]]
        rest, of = rest[1:], of[1:]
        while todo and len(rest):
            f = todo.pop()
            open_leaves = np.bitwise_count((f ^ common) & shared) <= radius
            at = np.flatnonzero(open_leaves[of])
            at = at[np.bitwise_count(rest[at] ^ f) <= radius]
            if len(at):
                new = rest[at]
                group += list(new)
                todo += list(new)
                stay = np.ones(len(rest), bool)
                stay[at] = False
                rest, of = rest[stay], of[stay]
        if len(group) > 1:
            own = np.array(group, np.uint64).view(np.int64)
            root = int(own.min())
            out += [(int(x), root) for x in own if x != root]
    return out


def _below_nodes(radius: int):
    """Links (a, b) found below each node; the rows come sorted by node."""

    def links(rows: list) -> list[tuple[int, int]]:
        if sum(map(len, rows)) < 2:
            return []
        return reach([np.array(r, np.int64).view(np.uint64) for r in rows], radius)

    def run(batches):
        key, held = None, []
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            if not batch.num_rows:
                continue
            choice, pattern, lists = (batch.column(i) for i in range(3))
            choice, pattern = choice.to_numpy(), pattern.to_numpy()
            sizes = np.diff(lists.offsets.to_numpy())
            edge = np.flatnonzero(np.r_[True, (choice[1:] != choice[:-1]) | (pattern[1:] != pattern[:-1])])
            ends = np.r_[edge[1:], len(choice)]
            # a node of one leaf of one member, whole in this batch, has no link
            some = np.flatnonzero((ends - edge > 1) | (sizes[edge] > 1) | (edge == 0) | (ends == len(choice)))
            found: list[tuple[int, int]] = []
            for s, e in zip(edge[some].tolist(), ends[some].tolist()):
                now = (int(choice[s]), int(pattern[s]))
                if now != key:
                    found += links(held)
                    key, held = now, []
                held += lists.slice(s, e - s).to_pylist()
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)
        if found := links(held):
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    return run


def linked(distinct_fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a, b`` whose classes are those of all pairs of ``fp`` within ``radius``.

    ``distinct_fps`` is best a written table: it is counted, sampled for ranges and read.
    """
    masks = _masks(_blocks_for(distinct_fps.count(), radius), radius)
    leaves = gray_rank(distinct_fps).repartitionByRange("g").sortWithinPartitions("g").select("fp")
    nodes = leaves.mapInArrow(_upper_nodes(masks), "choice int, pattern bigint, members array<bigint>")
    dealt = nodes.repartition("choice", "pattern").sortWithinPartitions("choice", "pattern")
    return dealt.mapInArrow(_below_nodes(radius), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: list[str] | None = None, radius: int = RADIUS) -> DataFrame:
    """One row per document: its id, the columns ``keep``, ``fp``, ``fingerprint`` and ``component_id``."""
    keep = [id] if keep is None else keep
    marked = materialise(fingerprints(docs, text, keep=keep))
    distinct = materialise(marked.groupBy("fp").agg(F.min(f"`{id}`").alias("least")))
    roots = components(linked(distinct, radius))
    of_root = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("class"))
    # written, so that a class of very many fingerprints is a skewed join, which Spark splits
    ids = materialise(of_root.groupBy("class").agg(F.min("least").alias("component_id")))
    classes = materialise(of_root.join(ids, "class").select(F.col("fp").alias("__fp"), F.col("class").alias("class_fp"), "component_id"))
    named = without(marked, ["fingerprint", "component_id", "class_fp"])
    return named.join(classes, named.fp == classes["__fp"]).select(*named.columns, "class_fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each class: the smallest id, then the smallest row hash.

    Null ids come last. Rows equal in every column are one row.
    """
    hashed = with_row_hash(docs)
    return keep_first(hashed, near_duplicates(hashed, id, text, keep=[id, "__row"], radius=radius), "class_fp", id)


def with_row_hash(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__row", F.xxhash64(*(f"`{c}`" for c in docs.columns)))


def keep_first(hashed: DataFrame, found: DataFrame, key: str, id: str) -> DataFrame:
    """The rows of ``hashed`` that come first in their class ``key`` of ``found``."""
    order = F.struct(F.col(f"`{id}`").isNull().alias("n"), F.col(f"`{id}`").alias("i"), F.col("__row").alias("r"))
    chosen = materialise(found.groupBy(key).agg(F.min(order).alias("o")).select(F.col("o.i").alias("__i"), F.col("o.r").alias("__r")))
    same = (hashed["__row"] == chosen["__r"]) & hashed[f"`{id}`"].eqNullSafe(chosen["__i"])
    return hashed.join(chosen, same, "left_semi").dropDuplicates(["__row", id]).drop("__row")
