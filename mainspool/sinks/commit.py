"""Files that tasks write in place, and that exist once their write is committed.

A task gives its files names of its own (task, attempt) in the folders they are meant for, and
reports them in its commit message. The write is committed by a manifest in the output's root that lists the
files of all tasks that succeeded; nothing is moved or copied, so a commit costs the same on
an object store as on a disk. Readers that follow manifests (:func:`committed`) never see files of failed or
repeated attempts; for readers that list folders, the commit takes such files away. A write that
fails takes away all its files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from mainspool.sources.framing import filesystem, remember_stores

# Fixed value: what manifests' names start with; listings skip such names.
MANIFEST = "_manifest-"
SUCCESS = "_SUCCESS"

#: Bytes of manifests that the driver reads itself.
SMALL = 1 << 20

_LISTED = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC"))])
_LISTED_DDL = "path string, length bigint, modificationTime timestamp"


class Parts(WriterCommitMessage):
    """The files one task wrote: ``{"path": below the root, "bytes": .., "rows": .., ..}``."""

    def __init__(self, files: list[dict]):
        self.files = files


class PartWriter(DataSourceArrowWriter):
    """Writes parts below ``options["path"]`` under names that end in the write's id, and commits them by manifest."""

    def __init__(self, options: dict[str, str]):
        self.root, self.id = options["path"].rstrip("/"), options["write_id"]

    def write_parts(self, batches: Iterator[pa.RecordBatch], names: AttemptNames) -> list[dict]:
        """Write the batches of a task; gives the files. ``names`` knows what to take back on failure."""
        raise NotImplementedError

    def check(self, files: list[dict]) -> None:
        """Raises if the files of all tasks must not be committed together."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        names = AttemptNames(self.root, self.id)
        try:
            return Parts(self.write_parts(iterator, names))
        except BaseException:
            names.take_back()
            raise

    def finish(self, files: list[dict]) -> list[dict]:
        """Files the commit itself adds."""
        return []

    def commit(self, messages: list[Parts | None]) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        self.check(files)
        files += self.finish(files)
        self._remove({f["path"] for f in files})
        system, base = filesystem(self.root)
        system.create_dir(base)
        with system.open_output_stream(f"{base}/{MANIFEST}{self.id}") as out:
            for f in files:
                out.write(json.dumps(f).encode() + b"\n")
        with system.open_output_stream(f"{base}/{SUCCESS}"):
            pass

    def abort(self, messages: list[Parts | None]) -> None:
        self._remove(set())

    def _remove(self, kept: set[str]) -> None:
        """Take away the write's files but those kept."""
        from pyarrow import fs

        system, base = filesystem(self.root)
        base = base.rstrip("/")
        folders = set()
        for info in system.get_file_info(fs.FileSelector(base, allow_not_found=True, recursive=True)):
            if self.id in info.base_name and info.type == fs.FileType.File and info.path[len(base) + 1 :] not in kept:
                system.delete_file(info.path)
                folders.add(info.path.rsplit("/", 1)[0])
        for folder in folders - {base}:
            if not system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                system.delete_dir(folder)


class AttemptNames:
    """Names for the files of one attempt of one task, in order; knows them for taking them back."""

    def __init__(self, root: str, write_id: str):
        from pyspark import TaskContext

        context = TaskContext.get()
        self.system, self.base = filesystem(root)
        self.task, self.attempt, self.id = context.partitionId(), context.taskAttemptId(), write_id
        self.given: list[str] = []

    def new(self, folder: str, prefix: str, ending: str) -> str:
        """A path below the root; its folder is there."""
        name = f"{folder}/{prefix}{self.task:06d}-{len(self.given):04d}-{self.attempt}-{self.id}{ending}".lstrip("/")
        self.given.append(name)
        self.system.create_dir(f"{self.base}/{folder}")
        return name

    def open(self, name: str):
        return self.system.open_output_stream(f"{self.base}/{name}")

    def size(self, name: str) -> int:
        return self.system.get_file_info(f"{self.base}/{name}").size

    def take_back(self) -> None:
        from pyarrow import fs

        for name in self.given:
            path = f"{self.base}/{name}"
            if self.system.get_file_info(path).type != fs.FileType.NotFound:
                self.system.delete_file(path)


def save(df: DataFrame, source: type[DataSource], path: str, **options: object) -> str:
    """Write with a source whose writer is a :class:`PartWriter`; gives the write's id."""
    spark, write_id = df.sparkSession, uuid.uuid4().hex
    remember_stores(spark, [path, *(str(o) for o in options.values())])
    spark.dataSource.register(source)
    df.write.format(source.name()).mode("append").options(path=path, write_id=write_id, **options).save()
    return write_id


def manifests(spark: SparkSession, paths: Iterable[str]) -> dict[str, list[tuple[str, int]]]:
    """The manifests in the root of each path (or of what it matches) and their sizes, none where it was
    written otherwise."""
    out: dict[str, list[tuple[str, int]]] = {}
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFEST}*")
        found = hadoop.getFileSystem(conf).globStatus(hadoop)
        out[path] = sorted((f.getPath().toString(), f.getLen()) for f in found or ())
    return out


def _read_manifests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            root = path.rsplit("/", 1)[0]
            system, inner = filesystem(path)
            at = system.get_file_info(inner).mtime
            with system.open_input_stream(inner) as f:
                lines = pa.BufferReader(f.read())
            rows = [json.loads(line) for line in lines.read().splitlines()]
            for start in range(0, len(rows), 10_000):
                some = rows[start : start + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{root}/{r['path']}" for r in some], pa.string()),
                        pa.array([r["bytes"] for r in some], pa.int64()),
                        pa.array([at] * len(some), pa.timestamp("us", "UTC")),
                    ],
                    schema=_LISTED,
                )


def committed(spark: SparkSession, found: list[tuple[str, int]]) -> DataFrame:
    """``(path, length, modificationTime)`` of the files that manifests list; large manifests are read by tasks."""
    paths = [path for path, _ in found]
    if sum(size for _, size in found) <= SMALL:
        batches = list(_read_manifests([pa.record_batch({"path": paths})]))
        return spark.createDataFrame(pa.Table.from_batches(batches, schema=_LISTED), _LISTED_DDL)
    rows = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 64))
    return rows.mapInArrow(_read_manifests, _LISTED_DDL)
