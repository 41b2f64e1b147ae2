"""One table per record type, each with its own columns, from one pass over mixed records.

Spark's own writers give all files of a write one schema. Here a task gets rows that hold a struct
per type, takes the rows of each type out of a batch, opens its struct and writes them to a file of that
type with the kept columns and the type's own only. Files are committed as in
:mod:`mainspool.sinks.commit`; a type without rows gets an empty file, so that its folder has a schema.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from mainspool.session import qualified
from mainspool.sinks.commit import AttemptNames, PartWriter, save

#: Bytes of a type's rows written together, and of all types' rows held by a task, at most.
ROW_GROUP, HELD = 32 << 20, 128 << 20

TYPE = "rec_type"


def opened(schema: pa.Schema, kept: Sequence[str], name: str) -> pa.Schema:
    """The columns of one type's table: the kept ones, then those of the type's struct."""
    return pa.schema([*(schema.field(k) for k in kept), *schema.field(name).type])


def _writer(fmt: str, stream, schema: pa.Schema):
    if fmt == "orc":
        from pyarrow import orc

        return orc.ORCWriter(stream, compression="zlib")
    import pyarrow.parquet as pq

    return pq.ParquetWriter(stream, schema, compression="snappy")


class _TypeFile:
    """One task's open file of one type."""

    def __init__(self, names: AttemptNames, folder: str, fmt: str, schema: pa.Schema):
        self.names, self.schema = names, schema
        self.path = names.new(folder, "part-", f".{fmt}")
        self.stream = names.open(self.path)
        self.writer = _writer(fmt, self.stream, schema)
        self.batches: list[pa.RecordBatch] = []
        self.held = self.rows = 0

    def add(self, batch: pa.RecordBatch) -> None:
        self.batches.append(batch)
        self.held += batch.nbytes
        self.rows += batch.num_rows

    def flush(self) -> None:
        if self.batches:
            self.writer.write(pa.Table.from_batches(self.batches, self.schema).combine_chunks())
        self.batches, self.held = [], 0

    def close(self) -> dict:
        self.flush()
        self.writer.close()
        self.stream.close()
        return {"path": self.path, "bytes": self.names.size(self.path), "rows": self.rows}


class _TypeWriter(PartWriter):
    def __init__(self, options: dict[str, str], schema: StructType):
        super().__init__(options)
        self.fmt, self.below = options["fmt"], options["below"]
        self.kept, self.types = json.loads(options["kept"]), json.loads(options["types"])
        # the structs are named by their place: a type may be named like a kept column
        self.columns = {t: f"_{i}" for i, t in enumerate(self.types)}
        self.schema = schema

    def folder(self, name: str) -> str:
        return f"{TYPE}={name}" + (f"/{self.below}" if self.below else "")

    def write_parts(self, batches: Iterator[pa.RecordBatch], names: AttemptNames) -> list[dict]:
        files: dict[str, _TypeFile] = {}
        for batch in batches:
            batch = batch.rename_columns(self.schema.names)
            which = batch.column(TYPE).dictionary_encode()
            for code, name in enumerate(which.dictionary.to_pylist()):
                mine = batch.filter(pa.compute.equal(which.indices, code))
                schema = opened(batch.schema, self.kept, self.columns[name])
                columns = [*(mine.column(k) for k in self.kept), *mine.column(self.columns[name]).flatten()]
                if name not in files:
                    files[name] = _TypeFile(names, self.folder(name), self.fmt, schema)
                files[name].add(pa.RecordBatch.from_arrays(columns, schema=schema))
                if files[name].held >= ROW_GROUP:
                    files[name].flush()
            if sum(f.held for f in files.values()) >= HELD:
                max(files.values(), key=lambda f: f.held).flush()
        return [f.close() for f in files.values()]

    def finish(self, files: list[dict]) -> list[dict]:
        """An empty file for each type that has none."""
        from mainspool.sources.framing import filesystem

        system, base = filesystem(self.root)
        schema, added = to_arrow_schema(self.schema), []
        for name in self.types:
            folder = self.folder(name)
            if any(f["path"].startswith(f"{folder}/") for f in files):
                continue
            path = f"{folder}/part-empty-{self.id}.{self.fmt}"
            own = opened(schema, self.kept, self.columns[name])
            system.create_dir(f"{base}/{folder}")
            with system.open_output_stream(f"{base}/{path}") as stream:
                writer = _writer(self.fmt, stream, own)
                writer.write(own.empty_table())
                writer.close()
            added.append({"path": path, "bytes": system.get_file_info(f"{base}/{path}").size, "rows": 0})
        return added


class TypedFiles(DataSource):
    """The sink that :func:`write_types` writes with."""

    @classmethod
    def name(cls) -> str:
        return "mainspool_types"

    def writer(self, schema: StructType, overwrite: bool) -> _TypeWriter:
        return _TypeWriter(dict(self.options), schema)


def write_types(rows: DataFrame, types: Sequence[str], path: str, fmt: str, *, kept: Sequence[str] = (), below: str = "") -> None:
    """Write rows of ``kept`` columns, ``rec_type`` and a struct per type, as
    :func:`mainspool.operators.route.decode_routed` gives them, to ``<path>/rec_type=<type>[/<below>]``."""
    named = rows.toDF(*kept, TYPE, *(f"_{i}" for i in range(len(types))))
    save(named, TypedFiles, qualified(rows.sparkSession, path), fmt=fmt, kept=json.dumps(list(kept)), types=json.dumps(list(types)), below=below)
