"""Fixed-length records: ranges follow from arithmetic on the file length."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mainspool.sources.files import list_files, tasks_for
from mainspool.sources.framing import fixed_records
from mainspool.sources.pushed import Output, RawFilter

CHUNK_BYTES = 64 << 20

#: Ranges dealt out by the driver, and files named by a number instead of their path in every row, at most.
FEW_RANGES, FEW_FILES = 4096, 256

RECORD_COLUMNS = ("file", "rec_no", "rec_len", "rec")


def spread(ranges: DataFrame, by: str, tasks: int) -> DataFrame:
    """Byte ranges dealt to tasks by range of their order, so that tasks get equal numbers of them;
    rows dealt round-robin from many small partitions would start in the same few tasks."""
    return ranges.repartitionByRange(tasks, "file", by)


def read_ranges(
    ranges: DataFrame,
    chunk_bytes: int,
    records: Callable[[dict, Output], Iterator[pa.RecordBatch]],
    columns: Sequence[str] | None,
    where: RawFilter | None,
) -> DataFrame:
    """Records, with ``error``, of byte ranges ``(file, start, end, ..)`` that ``records`` reads one at a time.

    The rows of few ranges are handed out by the driver, without a shuffle. Rows of few files carry
    their file's number, which becomes a path only where someone looks at it. The ranges are given as an RDD, of
    which Spark knows no size: by the size of the ranges it would take the records for few enough to broadcast.
    """
    spark = ranges.sparkSession
    wanted = RECORD_COLUMNS if columns is None else tuple(columns)
    unknown = set(wanted) - set(RECORD_COLUMNS)
    if unknown:
        raise ValueError(f"a scan has the columns {RECORD_COLUMNS}, not {sorted(unknown)}")
    few = ranges.limit(FEW_RANGES + 1).toArrow()
    paths = None
    if few.num_rows <= FEW_RANGES:
        few = few.sort_by([("file", "ascending"), ("start", "ascending")])
        names = few.column("file").unique().to_pylist()
        rows = [tuple(r.values()) for r in few.to_pylist()]
        total = sum(r["end"] - r["start"] for r in few.select(["start", "end"]).to_pylist())
        tasks = max(spark.sparkContext.defaultParallelism, tasks_for(spark, total, chunk_bytes))
        dealt = spark.sparkContext.parallelize(rows, max(1, min(tasks, len(rows))))
        if len(names) <= FEW_FILES:
            paths = names
    else:
        total = ranges.agg(F.sum(F.col("end") - F.col("start"))).first()[0]
        dealt = spread(ranges, "start", tasks_for(spark, total, chunk_bytes)).rdd
    coded = paths is not None and "file" in wanted
    out = Output((*("code" if coded and c == "file" else c for c in wanted), "error"), where)
    numbers = {path: i for i, path in enumerate(paths or ())}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield from records({**r, "code": numbers.get(r["file"], 0)}, out)

    found = spark.createDataFrame(dealt, ranges.schema).mapInArrow(read, out.ddl)
    return found.select(*(_path(paths).alias("file") if c == "code" else c for c in out.columns)) if coded else found


def _path(paths: list[str]) -> Column:
    """The path of a file's number."""
    if not paths:
        return F.lit(None).cast("string")
    return F.element_at(F.array(*map(F.lit, paths)), F.col("code") + 1)


def read_fb(
    spark: SparkSession,
    paths: str | Sequence[str],
    record_len: int,
    *,
    chunk_bytes: int = CHUNK_BYTES,
    columns: Sequence[str] | None = None,
    where: RawFilter | None = None,
) -> DataFrame:
    """``(file, rec_no, rec_len, rec)``; ``rec_no`` counts from 1 in each file.

    Every file is cut into ranges of whole records, so a single large file is read
    by many tasks. A file that is no multiple of ``record_len`` ends in a short
    record, whose missing fields decode as bad. ``columns`` are those to fill, and ``where`` says which
    records need not become rows (:func:`mainspool.operators.rules.raw_filter`).
    """
    if record_len < 1:
        raise ValueError("record_len must be positive")
    step = max(chunk_bytes // record_len, 1) * record_len
    files = list_files(spark, paths).filter("length > 0")
    ranges = files.select(
        F.col("path").alias("file"),
        "length",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(step).cast("bigint"))).alias("start"),
    ).select("file", "start", F.least(F.col("start") + step, F.col("length")).alias("end"))

    def records(r: dict, out: Output) -> Iterator[pa.RecordBatch]:
        return fixed_records(r["file"], r["start"], r["end"], record_len, out, r["code"])

    return read_ranges(ranges, step, records, columns, where).drop("error")
