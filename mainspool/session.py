"""Session helpers: where shared scratch files go, and the charset switch."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Fixed value: Spark's switch that lets ``decode`` use any JVM charset.
_JAVA_CHARSETS = "spark.sql.legacy.javaCharsets"

# Spark's limit on a generated method, its default, and the size over
# which the JVM leaves a method to its interpreter.
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_METHOD_LIMIT_DEFAULT = "65535"
_JIT_LIMIT = "8000"

# Partitions of a shuffle before small ones are joined, and the size they are joined up to.
_FINE_SHUFFLES = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

# Plans are built by one thread at a time while the charset switch is on.
_CHARSETS_LOCK = threading.RLock()


@contextmanager
def java_charsets(spark: SparkSession) -> Iterator[None]:
    """Resolve expressions with the JVM's own charsets available to ``decode``.

    Spark captures the switch in the expression when a DataFrame is analysed, so
    the session setting is put back on exit and the plans keep working.
    """
    with _CHARSETS_LOCK:
        before = spark.conf.get(_JAVA_CHARSETS, "false")
        spark.conf.set(_JAVA_CHARSETS, "true")
        try:
            yield
        finally:
            spark.conf.set(_JAVA_CHARSETS, before)


@contextmanager
def fine_shuffles(spark: SparkSession) -> Iterator[None]:
    """Run what is run inside with smaller shuffle partitions.

    By default adaptive execution joins partitions up to 64 MB as written, several times that
    unpacked; sorts, windows and collected lists of several tasks in one executor then spill. Settings
    the session made itself stay.
    """
    unset = [name for name in _FINE_SHUFFLES if spark.conf.get(name, None) is None]
    for name in unset:
        spark.conf.set(name, _FINE_SHUFFLES[name])
    try:
        yield
    finally:
        for name in unset:
            spark.conf.unset(name)


def limit_generated_methods(spark: SparkSession) -> None:
    """Keep wide projections compiled.

    Decoding a wide layout in one whole-stage method gives a method the JVM only
    interprets, several times slower than separate, compiled projections. Spark chooses
    those over the limit set here. A limit the session set itself stays.
    """
    if spark.conf.get(_METHOD_LIMIT, _METHOD_LIMIT_DEFAULT) == _METHOD_LIMIT_DEFAULT:
        spark.conf.set(_METHOD_LIMIT, _JIT_LIMIT)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's ``spark.checkpoint.dir``.

    Only a local session, where executors and driver share the disk, may name none and
    gets one made; elsewhere that is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="mainspool-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return qualified(spark, named.rstrip("/"))


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme and host that Spark resolves it against, for readers and writers
    in tasks, which know no default file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop).toString()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of this path, by the cluster's own file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
