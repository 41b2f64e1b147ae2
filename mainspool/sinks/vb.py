"""Variable-length record files.

Each task appends its records to part files, one run of equal ``file`` values at a
time: ``<path>/<input name>/part-<first record number>-<task>-<n>-..vb``. Records are not
shuffled, a large input file is written by many tasks, and part names sort in record
order. Concatenating the parts of one folder gives the file as one piece.

Parts are written in place and committed by a manifest (:mod:`mainspool.sinks.commit`): nothing
is moved, and the readers of this library read what the manifest lists. With a block size records are
packed into blocks that have descriptors of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource
from pyspark.sql.types import StructType

from mainspool.session import qualified, scratch_path
from mainspool.sinks.commit import AttemptNames, PartWriter, save
from mainspool.sources.files import list_files
from mainspool.sources.framing import DESCRIPTOR, LONGEST, filesystem, remember_stores

_REFUSED = "would both be written to"
_REJECT_DDL = "file string, rec_no bigint, rec_len int, error string, error_at int, rec_hex string"
_REJECT_COLUMNS = ("file", "rec_no", "rec_len", "error", "error_at", "rec_hex")

#: Bytes of a part's records kept back to fill blocks with.
BLOCKED = 4 << 20


def framed(records: pa.Array, descriptors: bool) -> bytes:
    """The bytes of a batch of records, each behind its descriptor."""
    records = records.cast(pa.binary())
    offsets = np.frombuffer(records.buffers()[1], dtype=np.int32)[records.offset : records.offset + len(records) + 1]
    body = np.frombuffer(records.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    if not descriptors:
        return body.tobytes()
    sizes = np.diff(offsets).astype(np.int64) + DESCRIPTOR
    if len(sizes) and sizes.max() > LONGEST:
        raise ValueError(f"a record of {sizes.max() - DESCRIPTOR} bytes does not fit a record descriptor")
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    out = np.zeros(int(sizes.sum()), dtype=np.uint8)
    is_body = np.ones(len(out), dtype=bool)
    for k in range(DESCRIPTOR):
        is_body[begin + k] = False
    out[begin] = sizes >> 8
    out[begin + 1] = sizes & 0xFF
    out[is_body] = body
    return out.tobytes()


def _folder(file: str) -> str:
    """The name an input's parts are put under."""
    return file.rstrip("/").rsplit("/", 1)[-1].replace("'", "")


def block_ends(sizes: np.ndarray, block: int) -> np.ndarray:
    """Of framed records of these sizes, how many lie in each block, as running totals: each block takes
    as many whole records as fit."""
    room = block - DESCRIPTOR
    if len(sizes) and sizes.max() > room:
        raise ValueError(f"a record of {sizes.max() - DESCRIPTOR} bytes does not fit a block of {block}")
    ends, total, at = [], np.concatenate([[0], np.cumsum(sizes)]), 0
    while at < len(sizes):
        at = int(np.searchsorted(total, total[at] + room, "right")) - 1
        ends.append(at)
    return np.array(ends, dtype=np.int64)


def blocked(records: bytes, sizes: np.ndarray, block: int, last: bool) -> tuple[bytes, int]:
    """Framed records packed into blocks; gives the bytes and how many records they hold. Unless these are
    the ``last``, the block that may not be full is left for later."""
    ends = block_ends(sizes, block)
    if not last:
        ends = ends[:-1]
    if not len(ends):
        return b"", 0
    starts = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends])]
    lengths = np.diff(starts) + DESCRIPTOR
    out = bytearray()
    for start, stop, length in zip(starts[:-1].tolist(), starts[1:].tolist(), lengths.tolist()):
        out += length.to_bytes(2, "big") + b"\0\0"
        out += records[start:stop]
    return bytes(out), int(ends[-1])


class _Part:
    """One open part file."""

    def __init__(self, names: AttemptNames, source: str, first: int, block: int):
        self.names, self.source, self.block = names, source, block
        self.path = names.new(_folder(source), f"part-{first:020d}-", ".vb")
        self.stream, self.bytes, self.rows = names.open(self.path), 0, 0
        self.held, self.sizes = bytearray(), [np.zeros(0, np.int64)]

    def add(self, data: bytes, sizes: np.ndarray) -> None:
        self.rows += len(sizes)
        if not self.block:
            self._put(data)
            return
        self.held += data
        self.sizes.append(sizes)
        if len(self.held) >= BLOCKED:
            self._pack(last=False)

    def _pack(self, last: bool) -> None:
        sizes = np.concatenate(self.sizes)
        data, n = blocked(bytes(self.held), sizes, self.block, last)
        self._put(data)
        del self.held[: int(sizes[:n].sum())]
        self.sizes = [sizes[n:]]

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.bytes += len(data)

    def close(self) -> dict:
        if self.block:
            self._pack(last=True)
        self.stream.close()
        return {"path": self.path, "bytes": self.bytes, "rows": self.rows, "source": self.source}


class _RecordWriter(PartWriter):
    def __init__(self, options: dict[str, str], schema: StructType):
        super().__init__(options)
        self.columns = schema.names
        self.descriptors, self.block, self.rejects = options["descriptors"] == "true", int(options["block"]), options.get("rejects")

    def write_parts(self, batches: Iterator[pa.RecordBatch], names: AttemptNames) -> list[dict]:
        files: list[dict] = []
        part: _Part | None = None
        rejected: list[pa.RecordBatch] = []

        def column(batch: pa.RecordBatch, name: str) -> pa.Array:
            return batch.column(self.columns.index(name))

        for batch in batches:
            if self.rejects:
                bad = pa.compute.is_valid(column(batch, "error"))
                if pa.compute.any(bad).as_py():
                    rejected.append(batch.filter(bad).select([self.columns.index(c) for c in _REJECT_COLUMNS]))
                    batch = batch.filter(pa.compute.invert(bad))
            if not batch.num_rows:
                continue
            inputs, numbers, records = (column(batch, c) for c in ("file", "rec_no", "rec"))
            ends = pa.compute.run_end_encode(inputs).run_ends.to_pylist()
            for begin, end in zip([0, *ends[:-1]], ends):
                if part is None or inputs[begin].as_py() != part.source:
                    if part is not None:
                        files.append(part.close())
                    part = _Part(names, inputs[begin].as_py(), numbers[begin].as_py(), self.block)
                some = records.slice(begin, end - begin)
                part.add(framed(some, self.descriptors), pa.compute.binary_length(some).to_numpy().astype(np.int64) + DESCRIPTOR)
        if part is not None:
            files.append(part.close())
        if rejected:
            self._keep(pa.Table.from_batches(rejected).rename_columns(list(_REJECT_COLUMNS)), names)
        return files

    def _keep(self, rejected: pa.Table, names: AttemptNames) -> None:
        """Rejects go to a table of the write's own; a repeated task writes the same file again."""
        import pyarrow.parquet as pq

        system, base = filesystem(self.rejects)
        whole = f"{base}/.{names.task}-{names.attempt}-{self.id}"
        with system.open_output_stream(whole) as out:
            pq.write_table(rejected, out)
        system.move(whole, f"{base}/part-{names.task:06d}.parquet")

    def check(self, files: list[dict]) -> None:
        inputs: dict[str, str] = {}
        for f in files:
            other = inputs.setdefault(_folder(f["source"]), f["source"])
            if other != f["source"]:
                raise ValueError(f"{min(other, f['source'])} and {max(other, f['source'])} {_REFUSED} {_folder(other)}")


class RecordFiles(DataSource):
    """The sink that :func:`write_vb` writes with."""

    @classmethod
    def name(cls) -> str:
        return "mainspool_records"

    def writer(self, schema: StructType, overwrite: bool) -> _RecordWriter:
        return _RecordWriter(dict(self.options), schema)


def write_vb(df: DataFrame, path: str, *, descriptors: bool = True, block: int | None = None) -> DataFrame | None:
    """Write records to variable-length files, one folder per input file; never overwrites.

    With ``descriptors=False`` records are laid end to end, as in fixed-length files. With ``block`` each
    part holds blocks of up to so many bytes, to be read with ``bdw=True``. Two
    input files of one base name would share a folder and are refused. Rows that carry an
    ``error`` (:func:`mainspool.operators.segments.split_tagged`) are not written but given
    back, from the same scan; without that column there is nothing to give back.
    """
    from pyarrow import fs

    if block is not None and not (descriptors and 2 * DESCRIPTOR <= block <= LONGEST):
        raise ValueError(f"a block holds records with descriptors and takes {2 * DESCRIPTOR} to {LONGEST} bytes")
    spark = df.sparkSession
    path = qualified(spark, path)
    remember_stores(spark, [path])
    system, root = filesystem(path)
    if system.get_file_info(root).type != fs.FileType.NotFound and list_files(spark, path).limit(1).count():
        raise FileExistsError(f"{path} already holds files")
    columns, options = ["file", "rec_no", "rec"], {"descriptors": descriptors, "block": block or 0}
    if "error" in df.columns:
        columns += ["rec_len", "error", "error_at", "rec_hex"]
        options["rejects"] = scratch_path(spark, "rejects")
        at, inner = filesystem(options["rejects"])
        at.create_dir(inner)
    try:
        save(df.select(*columns), RecordFiles, path, **options)
    except PySparkException as failed:
        # what the commit refuses comes back as the text of an error in a worker
        refused = re.search(rf"ValueError: (.* {_REFUSED} \S.*)", str(failed))
        raise ValueError(refused[1]) if refused else failed
    return spark.read.schema(_REJECT_DDL).parquet(options["rejects"]) if "error" in df.columns else None
