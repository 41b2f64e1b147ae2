"""Token ids as fixed-stride binary shards in training order.

Texts are encoded by a public byte-level pair vocabulary and library. Each text ends with the
end token, the first id past the vocabulary, and the ids of a partition's texts run on through
sequences of ``length`` ids, of which only the last of a partition is filled up, with end tokens.
A sequence's number is its partition and its place there, a number below
``PARTITIONS << ROW_BITS``. A keyed Feistel network permutes the next power of four; numbers
that leave the domain walk on along their cycle until they are back in it. The global slot of a
sequence is its rank in this order: equal stretches of the permuted domain are the shards, each
task gets a range of them, and a shard's first slot is the number of sequences in the shards
before it. So ids are made once and moved once: permuting ``0 .. n - 1`` itself would need
the count of sequences first, which costs a second encoding or a second copy.

A shard is a file of records of ``length`` little-endian ids, two bytes each (four for
vocabularies over 65,535). The record of a slot is ``(slot - first) * stride`` bytes into
its shard, so reading goes on at any slot. A shard is written under a name of its
attempt and renamed when its last record is in it: an attempt that fails or is killed publishes
no part of a shard, and of two attempts the second finds the first one's whole shard and leaves it. The
order is one for one partitioning of the table: sequences run on through a partition, so other partitions make
other sequences; a fixed one would cost a shuffle of the texts.

Null texts give no ids, empty ones the end token. Repeated rows are written each; an
empty table gives no rows and no files.
"""

from __future__ import annotations

import base64
import contextlib
import uuid
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mainspool.llm.common import materialise, per_worker

#: Bits of a sequence's place in its partition, and more partitions than any table has.
ROW_BITS, PARTITIONS = 40, 3 << 20
ROUNDS = 8
LENGTH = 1024

#: Text bytes for a shard, and the fewest shards, so that small tables still spread.
SHARD_BYTES, LEAST_SHARDS = 256 << 20, 64

#: Tasks that write at most; a task writes its shards one after the other.
TASKS = 100_000


def feistel(numbers: np.ndarray, domain: int, key: int) -> np.ndarray:
    """A keyed permutation of ``0 .. domain - 1``."""
    half = max(1, ((max(domain, 2) - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    shift = np.uint64(half)

    def mixed(x: np.ndarray, r: int) -> np.ndarray:
        x = x + np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) & low

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & low
        for r in range(ROUNDS):
            left, right = right, left ^ mixed(right, r)
        return left << shift | right

    with np.errstate(over="ignore"):
        out = once(numbers.astype(np.uint64))
        away = np.flatnonzero(out >= np.uint64(domain))
        while len(away):  # walk the cycle
            out[away] = once(out[away])
            away = away[out[away] >= np.uint64(domain)]
    return out


def filesystem(uri: str):
    """The file system of a shared path and the path in it; only ``file:`` may lack a scheme."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    scheme, _, rest = uri.partition("://")
    if not rest:
        return fs.LocalFileSystem(), uri
    host, _, path = rest.partition("/")
    found, _ = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return found, f"/{path}" if scheme in ("hdfs", "viewfs") else f"{host}/{path}"


class Encoder:
    """The ids of whole texts, each with the end token, by the public library."""

    def __init__(self, vocabulary: bytes, pattern: str, wide: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.wide = wide
        self.end = max(ranks.values()) + 1

    def encode(self, text: str) -> np.ndarray:
        ids = self.library.encode_to_numpy(text, disallowed_special=())
        return np.append(ids, self.end).astype(self.wide)


def load(path: str) -> bytes:
    """The vocabulary file (base64 piece and rank a line), read once on the driver."""
    with open(path, "rb") as f:
        return f.read()


def ids_in(vocabulary: bytes) -> int:
    """Ids of a vocabulary with the end token."""
    return max(int(line.split()[1]) for line in vocabulary.splitlines()) + 2


def _sequences(vocabulary: bytes, pattern: str, length: int, domain: int, key: int, shards: int, wide: str):
    def run(batches):
        from pyspark import TaskContext

        made = ("encoder", crc32(vocabulary), pattern, wide)
        encoder = per_worker(made, lambda: Encoder(vocabulary, pattern, wide))
        first = TaskContext.get().partitionId() << ROW_BITS
        done, ids, owners, fill = 0, np.zeros(0, wide), [], 0
        stretch = -(-domain // shards)

        def rows(ids: np.ndarray, owners: list, last: bool):
            """Whole sequences of ``ids``; owners: (end, doc) in order."""
            nonlocal done, fill
            count = -(-len(ids) // length) if last else len(ids) // length
            if not count:
                return None, ids, owners
            fill = count * length - len(ids) if last else 0
            whole = np.r_[ids, np.full(fill, encoder.end, wide)] if last else ids[: count * length]
            ends = np.array([e for e, _ in owners])
            docs, sizes = [], []
            for k in range(count):
                a, b = np.searchsorted(ends, [k * length, (k + 1) * length - 1], "right")
                docs.append([d for _, d in owners[a : b + 1]])
                sizes.append(min(len(ids), (k + 1) * length) - k * length)
            place = feistel(np.arange(first + done, first + done + count, dtype=np.uint64), domain, key).astype(np.int64)
            done += count
            size = length * np.dtype(wide).itemsize
            data = pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer((np.arange(count + 1) * size).astype(np.int32)), pa.py_buffer(whole.tobytes())])
            batch = pa.RecordBatch.from_arrays(
                [pa.array((place // stretch).astype(np.int32)), pa.array(place), pa.array(docs, pa.list_(pa.int64())), pa.array(sizes, pa.int32()), data],
                names=["shard", "place", "doc_ids", "n_tokens", "record"],
            )
            used = count * length
            return batch, ids[used:], [(e - used, d) for e, d in owners if e > used]

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                parts, end = [ids], len(ids)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if text is None:
                        continue
                    parts.append(encoder.encode(text))
                    end += len(parts[-1])
                    owners.append((end, doc))
                out, ids, owners = rows(np.concatenate(parts), owners, False)
                if out is not None:
                    yield out
        out, _, _ = rows(ids, owners, True)
        if out is not None:
            yield out

    return run


def _write(path: str):
    def run(batches):
        from pyarrow import fs

        files, base = filesystem(path)
        shard, stream, temp, rank = None, None, "", 0

        def close():
            """Publish the shard whose last record is written."""
            nonlocal stream
            if stream is None:
                return
            stream.close()
            stream = None
            place, size = f"{base}/shard-{shard:08d}.bin", files.get_file_info(temp).size
            there = files.get_file_info(place)
            if there.type == fs.FileType.NotFound:
                files.move(temp, place)
                return
            files.delete_file(temp)  # another attempt was first
            if there.size != size:
                raise RuntimeError(f"{place} holds {there.size} bytes, not the {size} of this attempt")

        try:
            for batch in batches:
                shards = batch.column(0).to_numpy()
                data = batch.column(4)
                ranks, crcs = np.zeros(len(shards), np.int64), np.zeros(len(shards), np.int64)
                for k, record in enumerate(data):
                    if shards[k] != shard:
                        close()
                        shard, rank = int(shards[k]), 0
                        temp = f"{base}/.{shard:08d}-{uuid.uuid4().hex}"
                        stream = files.open_output_stream(temp)
                    view = record.as_buffer()
                    stream.write(view)
                    ranks[k], crcs[k] = rank, crc32(view)
                    rank += 1
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:4], pa.array(ranks), pa.array(crcs)], names=["shard", "place", "doc_ids", "n_tokens", "rank", "crc32"]
                )
            close()
        except BaseException:
            # a failed or killed attempt may hold the first records of a shard only
            if stream is not None:
                with contextlib.suppress(OSError):
                    stream.close()
                with contextlib.suppress(OSError):
                    files.delete_file(temp)
            raise

    return run


def write_order(docs: DataFrame, path: str, vocabulary: bytes, pattern: str, key: int, id: str = "doc_id", text: str = "text", length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the shards below ``path``, a shared folder; one row per sequence.

    Columns: slot, shard, byte_offset, doc_ids (those with ids in the sequence, in order),
    n_tokens (less for the filled-up last of a partition), crc32 of the record.
    """
    files, base = filesystem(path)
    files.create_dir(base, recursive=True)
    texts = docs.select(F.col(f"`{id}`").cast("bigint").alias("i"), F.col(f"`{text}`").alias("t"))
    size = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-size // shard_bytes))
    wide = "<u2" if ids_in(vocabulary) <= 1 << 16 else "<u4"
    run = _sequences(vocabulary, pattern, length, PARTITIONS << ROW_BITS, key, shards, wide)
    rows = texts.mapInArrow(run, "shard int, place bigint, doc_ids array<bigint>, n_tokens int, record binary")
    # shards are equal stretches, so ranges of them are even without sampling the rows first
    tasks = min(shards, TASKS)
    dealt = rows.repartitionById(tasks, F.expr(f"cast(shard * {tasks}L div {shards} AS int)")).sortWithinPartitions("shard", "place")
    written = materialise(dealt.mapInArrow(_write(path), "shard int, place bigint, doc_ids array<bigint>, n_tokens int, rank bigint, crc32 bigint"))
    counts = written.groupBy("shard").agg(F.max("rank").alias("n"))  # a row per shard
    first = counts.select("shard", F.coalesce(F.sum(F.col("n") + 1).over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    stride = length * np.dtype(wide).itemsize
    return written.join(F.broadcast(first), "shard").select((F.col("first") + F.col("rank")).alias("slot"), "shard", (F.col("rank") * stride).alias("byte_offset"), "doc_ids", "n_tokens", "crc32")


def read_order(spark: SparkSession, path: str, firsts: dict[int, int], start: int = 0, length: int = LENGTH, wide: str = "<u2") -> DataFrame:
    """Records from slot ``start`` on, as (slot, ids); ``firsts``: each shard's first slot."""
    order = sorted((f, s) for s, f in firsts.items())
    todo = [(s, f) for k, (f, s) in enumerate(order) if k + 1 == len(order) or order[k + 1][0] > start]
    stride = length * np.dtype(wide).itemsize

    def run(batches):
        files, base = filesystem(path)
        for batch in batches:
            for shard, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_input_file(f"{base}/shard-{shard:08d}.bin") as f:
                    at = max(start - first, 0)
                    f.seek(at * stride)
                    while data := f.read(stride * 256):
                        ids = np.frombuffer(data, wide).reshape(-1, length).astype(np.int32)
                        yield pa.RecordBatch.from_arrays([pa.array(np.arange(first + at, first + at + len(ids))), pa.array(list(ids), pa.list_(pa.int32()))], names=["slot", "ids"])
                        at += len(ids)

    rows = spark.createDataFrame(todo or [(0, 0)], "shard int, first bigint").limit(len(todo))
    return rows.repartition(max(1, min(len(todo), 200))).mapInArrow(run, "slot bigint, ids array<int>")
