"""Helpers shared by the pipeline operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mainspool.session import shared_dir

#: Rows handed to an operator's function at once; bounds what a task holds beside the
#: Arrow batch itself.
SLICE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder, with the lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` less the columns an operator is about to add: its own columns win."""
    taken = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in taken))


def append(df: DataFrame, fields: str, fn: Callable[..., list[pa.Array]], *inputs: str, keep: Iterable[str] | None = None) -> DataFrame:
    """Add the columns ``fields`` computed by ``fn`` from the columns ``inputs``.

    ``fn`` gets one Arrow array per input, of at most ``SLICE`` rows, and returns one
    array per field. ``keep`` names the columns that stay (default: all). An input column
    with the name of a new one is read, then replaced.
    """
    added = T.StructType.fromDDL(fields)
    names = [f.name for f in added]
    taken = {n.lower() for n in names}
    stay = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    wanted = [*(F.col(f"`{c}`") for c in stay), *(F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(inputs))]
    source = df.select(*wanted)
    n = len(stay)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                new = fn(*part.columns[n:])
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *new], names=[*stay, *names])

    return source.mapInArrow(run, T.StructType([*source.schema.fields[:n], *added.fields]))


def per_worker(key: object, build: Callable[[], object]) -> object:
    """A value built once in each Python worker and reused by its later tasks.

    Functions of this library travel to the workers by value, so module globals do not
    outlive a task. Only the last eight values are kept.
    """
    store = sys.modules.setdefault("_mainspool_kept", types.ModuleType("_mainspool_kept")).__dict__.setdefault("kept", {})
    if key not in store:
        while len(store) >= 8:
            store.pop(next(iter(store)))
        store[key] = build()
    return store[key]
