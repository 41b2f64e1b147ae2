"""Worker-side byte reading: ranges of files into Arrow batches of records.

These functions run inside ``mapInArrow`` tasks. A task streams its byte range in
blocks, so memory does not grow with the range or the file.

A variable-length record starts with a 4-byte descriptor: a big-endian length that
counts the descriptor itself, then two zero bytes.
"""

from __future__ import annotations

import struct
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

from mainspool.sources.pushed import Output

# Size of a record descriptor and the longest record it can announce.
DESCRIPTOR = 4
LONGEST = 0xFFFF

BLOCK = 8 << 20

CHAIN_SCHEMA = pa.schema(
    [
        ("file", pa.string()),
        ("length", pa.int64()),
        ("span", pa.int64()),
        ("unit", pa.int64()),
        ("entries", pa.list_(pa.int64())),
        ("exits", pa.list_(pa.int64())),
        ("records", pa.list_(pa.int64())),
    ]
)

# Settings of Spark's own object store client, by the name that the readers' client has for them.
_S3_SETTINGS = {
    "access_key": "access.key",
    "secret_key": "secret.key",
    "session_token": "session.token",
    "endpoint_override": "endpoint",
    "region": "endpoint.region",
}
_S3_SCHEMES = ("s3", "s3a", "s3n")

#: What the clients of buckets are made with in tasks; sent along with the functions that read or write.
STORES: dict[str, dict[str, str]] = {}


def store_settings(setting: Callable[[str], str | None], bucket: str) -> dict[str, str]:
    """Arguments of a bucket's client from Spark's settings; those of the bucket come before general ones."""

    def get(name: str) -> str | None:
        return setting(f"fs.s3a.bucket.{bucket}.{name}") or setting(f"fs.s3a.{name}")

    out = {ours: value for ours, name in _S3_SETTINGS.items() if (value := get(name))}
    scheme, _, rest = out.get("endpoint_override", "").rpartition("://")
    if rest:
        out["endpoint_override"] = rest
    if scheme or get("connection.ssl.enabled") == "false":
        out["scheme"] = scheme or "http"
    return out


def remember_stores(spark, paths: Iterable[str]) -> None:
    """Keep the settings of the buckets that paths lie in for the functions that tasks will run."""
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        scheme, _, rest = path.partition("://")
        if scheme in _S3_SCHEMES and rest:
            bucket = rest.partition("/")[0]
            STORES[bucket] = store_settings(conf.get, bucket)


def filesystem(path: str):
    """(filesystem, path in it) for a qualified path as Spark prints it; a path without a scheme
    is local. The path may hold any characters: only scheme and host are read as a URI. Buckets are
    opened with the settings Spark has for them (:func:`remember_stores`)."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    scheme, _, rest = path.partition("://")
    if not rest:
        return fs.LocalFileSystem(), path
    host, _, inner = rest.partition("/")
    if scheme in _S3_SCHEMES:
        if STORES.get(host):
            return fs.S3FileSystem(**STORES[host]), f"{host}/{inner}"
        scheme = "s3"
    system, root = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    # object stores count the bucket into the path
    return system, f"{root.rstrip('/')}/{inner}"


def open_file(path: str):
    """A seekable binary file for a path as Spark's file listing prints it."""
    system, inner = filesystem(path)
    return system.open_input_file(inner)


def follow(buf: bytes, pos: int, stop: int) -> tuple[list[int], int, bool]:
    """Record starts from ``pos`` on, as long as they lie before ``stop`` and their
    descriptor is in ``buf``; the next start; and whether that one is corrupt."""
    starts: list[int] = []
    add, unpack = starts.append, struct.Struct(">HH").unpack_from
    stop = min(stop, len(buf) - DESCRIPTOR + 1)
    while pos < stop:
        size, zero = unpack(buf, pos)
        if size < DESCRIPTOR or zero:
            return starts, pos, True
        add(pos)
        pos += size
    return starts, pos, False


def follow_unseen(buf: bytes, pos: int, stop: int, owner: array, me: int) -> tuple[list[int], int, bool]:
    """:func:`follow`, marking starts as owned by ``me`` and ending early on an owned one."""
    starts: list[int] = []
    add, unpack = starts.append, struct.Struct(">HH").unpack_from
    stop = min(stop, len(buf) - DESCRIPTOR + 1)
    while pos < stop and not owner[pos]:
        size, zero = unpack(buf, pos)
        if size < DESCRIPTOR or zero:
            return starts, pos, True
        owner[pos] = me
        add(pos)
        pos += size
    return starts, pos, False


def variable_records(path: str, start: int, end: int, length: int, first: int, out: Output = Output(), code: int = 0) -> Iterator[pa.RecordBatch]:
    """Records that start in ``[start, end)``; ``start`` must be a record start.

    A descriptor that is no descriptor, or that reaches past the end of the file,
    ends the range with one error row.
    """
    with open_file(path) as f:
        at = start
        rec_no = first
        while at < end:
            f.seek(at)
            # a block holds at least one whole record
            buf = f.read(min(BLOCK, length - at, end - at + LONGEST))
            starts, nxt, corrupt = follow(buf, 0, min(end - at, len(buf)))
            partial = bool(starts) and nxt > len(buf)
            if partial:
                nxt = starts.pop()
            if starts:
                begin = np.array(starts, dtype=np.int64)
                sizes = np.diff(np.append(begin, nxt)) - DESCRIPTOR
                batch = out.batch(path, code, rec_no, np.frombuffer(buf, dtype=np.uint8), begin + DESCRIPTOR, sizes)
                if batch is not None:
                    yield batch
                rec_no += len(starts)
            at += nxt
            if corrupt:
                yield out.reject(path, code, rec_no, at, "bad record descriptor")
                return
            if not starts and at < end:
                yield out.reject(path, code, rec_no, at, "record cut off by the end of the file")
                return


def blocked_records(path: str, start: int, end: int, length: int, first: int, out: Output = Output(), code: int = 0) -> Iterator[pa.RecordBatch]:
    """Records of the blocks that start in ``[start, end)``: a block has a descriptor like a
    record's, and holds whole records. A block that does not is where the file is given up."""
    rec_no, at = first, start
    for batch in variable_records(path, start, end, length, 1):
        if batch.column(4).null_count < batch.num_rows:  # the scan's own reject
            yield out.reject(path, code, rec_no, at, batch.column(4)[0].as_py().rsplit(" at byte ", 1)[0])
            return
        blocks = batch.column(3)
        ends = np.frombuffer(blocks.buffers()[1], dtype=np.int32)[1 : len(blocks) + 1].tolist()
        body = blocks.buffers()[2].to_pybytes()[: ends[-1]] if ends[-1] else b""
        starts: list[int] = []
        begin, bad = 0, None
        for stop in ends:
            found, nxt, corrupt = follow(body, begin, stop)
            starts += found
            if corrupt or nxt != stop:
                # a record that reaches past its block is not whole
                if not corrupt and found and nxt > stop:
                    nxt = starts.pop()
                bad = nxt
                break
            begin = stop
        last = begin if bad is None else bad
        if starts:
            where = np.array(starts, dtype=np.int64)
            sizes = np.diff(np.append(where, last)) - DESCRIPTOR
            kept = out.batch(path, code, rec_no, np.frombuffer(body, dtype=np.uint8), where + DESCRIPTOR, sizes)
            if kept is not None:
                yield kept
            rec_no += len(starts)
        if bad is not None:
            block = next(i for i, stop in enumerate(ends) if bad < stop or i + 1 == len(ends))
            yield out.reject(path, code, rec_no, at + bad + DESCRIPTOR * (block + 1), "bad record descriptor in a block")
            return
        at += ends[-1] + DESCRIPTOR * len(ends)


def fixed_records(path: str, start: int, end: int, record_len: int, out: Output = Output(), code: int = 0) -> Iterator[pa.RecordBatch]:
    """Fixed-length records in ``[start, end)``; the file's last one may be short."""
    step = max(BLOCK // record_len, 1) * record_len
    with open_file(path) as f:
        f.seek(start)
        for at in range(start, end, step):
            buf = f.read(min(step, end - at))
            n = -(-len(buf) // record_len)
            sizes = np.full(n, record_len, dtype=np.int64)
            sizes[-1] = len(buf) - (n - 1) * record_len
            batch = out.batch(path, code, at // record_len + 1, np.frombuffer(buf, dtype=np.uint8), np.arange(n, dtype=np.int64) * record_len, sizes)
            if batch is not None:
                yield batch


def _plausible(buf: bytes, window: int, stop: int) -> list[int]:
    """Positions below ``window`` whose bytes could be a record descriptor, followed by
    others as far as this looks. What it leaves out meets a corrupt one before ``stop``."""
    data = np.frombuffer(buf, dtype=np.uint8)
    n = min(window + 4 * LONGEST, stop, len(data) - DESCRIPTOR + 1)
    if n <= 0:
        return []
    size = data[:n].astype(np.int64) << 8 | data[1 : n + 1]
    ok = (size >= DESCRIPTOR) & (data[2 : n + 2] == 0) & (data[3 : n + 3] == 0)
    at = np.flatnonzero(ok)
    following = at + size[at]
    while True:
        # what lies behind the bytes looked at is taken for plausible
        good = ok[np.minimum(following, n - 1)] | (following >= n)
        if good.all():
            return at[at < window].tolist()
        ok[at[~good]] = False
        at, following = at[good], following[good]


def _block_exits(buf: bytes, entries: list[int], stop: int) -> dict[int, tuple[int, int, bool]]:
    """For each entry: where its chain leaves the block, records passed, corrupt or not.

    Chains that meet are walked once from there on.
    """
    owner = array("i", bytes(4 * len(buf)))
    walked: list[tuple[list[int], int, int, bool]] = []
    out: dict[int, tuple[int, int, bool]] = {}
    for entry in entries:
        starts, nxt, corrupt = follow_unseen(buf, entry, stop, owner, len(walked) + 1)
        count = len(starts)
        if not corrupt and nxt < min(stop, len(buf)) and owner[nxt]:
            chain, total, exit_, corrupt_ = walked[owner[nxt] - 1]
            count, nxt, corrupt = count + total - bisect_left(chain, nxt), exit_, corrupt_
        walked.append((starts, count, nxt, corrupt))
        out[entry] = (nxt, count, corrupt)
    return out


def chunk_chains(path: str, chunk: int, chunk_bytes: int, length: int, base: int = 0) -> pa.RecordBatch:
    """Where record chains go that enter a chunk at any plausible position.

    The true entry is not known yet: it depends on every earlier chunk. So each
    plausible entry is followed. One that meets a corrupt descriptor is left out: if it
    is the true one after all, reading the chunk from there finds the same corruption.
    ``exits`` are the first starts behind the chunk. Chunks and positions count from ``base``, a record
    start, and ``length`` is that of the file behind it.
    """
    begin = chunk * chunk_bytes
    end = min(begin + chunk_bytes, length)
    alive: dict[int, tuple[int, int]] = {}
    with open_file(path) as f:
        for at in range(begin, end, BLOCK):
            stop = min(at + BLOCK, end)
            f.seek(base + at)
            buf = f.read(min(stop - at + DESCRIPTOR - 1, length - at))
            if at == begin:
                first = _plausible(buf, min(LONGEST, end - begin), stop - at) if chunk else [0]
                alive = {begin + p: (begin + p, 0) for p in first}
            here = sorted({pos - at for pos, _ in alive.values() if pos < stop})
            exits = _block_exits(buf, here, stop - at)
            for entry, (pos, count) in list(alive.items()):
                if pos >= stop:
                    continue
                nxt, passed, corrupt = exits[pos - at]
                # so is a record cut off by the end of the file
                if corrupt or at + nxt < stop or at + nxt > length:
                    del alive[entry]
                else:
                    alive[entry] = (at + nxt, count + passed)
    entries = sorted(alive)
    row = {
        "file": path,
        "length": length,
        "span": chunk_bytes,
        "unit": chunk,
        "entries": entries,
        "exits": [alive[e][0] for e in entries],
        "records": [alive[e][1] for e in entries],
    }
    return pa.RecordBatch.from_pylist([row], schema=CHAIN_SCHEMA)


def bytes_at(path: str, starts: list[int], size: int) -> list[bytes]:
    """The bytes at some places of a file, as far as it reaches."""
    out = []
    with open_file(path) as f:
        length = f.size()
        for start in starts:
            f.seek(min(start, length))
            out.append(f.read(max(min(size, length - start), 0)))
    return out
