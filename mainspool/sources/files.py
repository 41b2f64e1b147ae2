"""File listing: one row per input file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from mainspool.sinks.commit import committed, manifests
from mainspool.sources.framing import remember_stores

#: Tasks that each core gets of small chunks, and the bytes a task takes of them before there are more tasks.
TASKS_A_CORE, TASK_BYTES = 4, 32 << 20


def split_paths(paths: str | Sequence[str]) -> list[str]:
    """A path, a comma-separated list of paths, or a list of either."""
    given = [paths] if isinstance(paths, str) else list(paths)
    return [p.strip() for entry in given for p in entry.split(",") if p.strip()]


def list_files(spark: SparkSession, paths: str | Sequence[str], recursive: bool = True) -> DataFrame:
    """``(path, length, modificationTime)`` of every file below the paths; no content is read.

    Where a path was written by this library, its manifest says which files there are."""
    given = split_paths(paths)
    remember_stores(spark, given)
    found = manifests(spark, given)
    known = [m for path in given for m in found[path]]
    others = [path for path in given if not found[path]]
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    names = ("path", "length", "modificationTime")
    parts = [listing.load(others).select(*names)] if others else []
    if known:
        parts.append(committed(spark, known).select(*names))
    return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])


def tasks_for(spark: SparkSession, total: int, chunk_bytes: int) -> int:
    """Tasks to spread the byte ranges over: about one chunk each. Of small chunks a task takes several once
    every core has a few tasks, so that the cost of starting tasks does not grow with the number of chunks."""
    enough = max(TASKS_A_CORE * spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    return max(1, min(-(-total // chunk_bytes), enough))
