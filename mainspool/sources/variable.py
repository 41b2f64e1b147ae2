"""Variable-length records, read in parallel inside a file.

Record starts are known only by following descriptors from the start of the file.
To cut one large file into ranges anyway, every chunk but a file's last is scanned at
once, from each plausible entry position (:func:`mainspool.sources.framing.chunk_chains`).
That gives each chunk a map from entries to the first start behind it and the records
between. Maps of ``FAN`` neighbours are composed into one, level by level, until one is left;
going down again, the true entry of each unit gives those of the units it is made of. Each step
is grouped by unit, so a group holds at most ``FAN`` maps, a file of n chunks takes log n
steps, and any number of chunks will do. The index that results, one row a range, is
checkpointed; give it to the readers to scan for it once, or keep it for later (:func:`keep_index`).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mainspool.session import qualified, shared_dir
from mainspool.sources.files import list_files, tasks_for
from mainspool.sources.fixed import CHUNK_BYTES, FEW_RANGES, read_ranges, spread
from mainspool.sources.framing import LONGEST, blocked_records, bytes_at, chunk_chains, variable_records
from mainspool.sources.pushed import Output, RawFilter

#: Maps composed into one.
FAN = 16

#: Bytes kept of the start of each range, to know the file by.
MARK = 64

INDEX_DDL = "file string, start bigint, end bigint, length bigint, first_rec_no bigint, modified timestamp, mark binary"

_MAP_DDL = "file string, length bigint, span bigint, unit bigint, entries array<bigint>, exits array<bigint>, records array<bigint>"
_REACHED_DDL = "file string, length bigint, unit bigint, pos bigint, n bigint"


def _scan_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            yield chunk_chains(r["file"], r["chunk"], r["chunk_bytes"], r["length"], r["base"])


def _composed(units: pd.DataFrame) -> pd.DataFrame:
    """One map of neighbouring units, for entries a record from before them can reach."""
    units = units.sort_values("unit")
    file, length, span, first = (units[c].iloc[0] for c in ("file", "length", "span", "unit"))
    begin, end = first // FAN * FAN * span, (first // FAN + 1) * FAN * span
    onward: dict[int, tuple[int, int]] = {}
    for row in reversed(list(units.itertuples(index=False))):
        here = {}
        for entry, exit_, n in zip(row.entries, row.exits, row.records):
            if exit_ >= end or exit_ >= length:
                here[entry] = (exit_, n)
            elif exit_ in onward:
                far, more = onward[exit_]
                here[entry] = (far, n + more)
        onward |= here
    entries = sorted(e for e in onward if e < begin + LONGEST)
    row = (file, length, span * FAN, first // FAN, entries, [onward[e][0] for e in entries], [onward[e][1] for e in entries])
    return pd.DataFrame([row], columns=["file", "length", "span", "unit", "entries", "exits", "records"])


def _opened(span: int):
    """From the true entry of a unit to those of its parts of ``span`` bytes."""

    def run(reached: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        out = []
        by_unit = {row.unit: row for row in parts.itertuples(index=False)}
        for known in reached.itertuples(index=False):
            pos, n, end = known.pos, known.n, min((known.unit + 1) * FAN * span, known.length)
            while pos < end:
                out.append((known.file, known.length, pos // span, pos, n))
                part = by_unit.get(pos // span)
                i = np.searchsorted(part.entries, pos) if part is not None else 0
                if part is None or i == len(part.entries) or part.entries[i] != pos:
                    break  # the last chunk, or corrupt in here: reading the range will say where
                pos, n = part.exits[i], n + part.records[i]
        return pd.DataFrame(out, columns=["file", "length", "unit", "pos", "n"])

    return run


def _count_blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges with the number of records in their blocks, and whether one ends in a reject."""
    for batch in batches:
        counts, bad = [], []
        for r in batch.to_pylist():
            found = [(b.num_rows, b.column(3).null_count) for b in blocked_records(r["file"], r["start"], r["end"], r["length"], 1)]
            counts.append(sum(n for n, rejected in found if not rejected))
            bad.append(any(rejected for _, rejected in found))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64()), pa.array(bad)], names=[*batch.schema.names, "n", "bad"])


def _numbered(ranges: DataFrame, chunk_bytes: int) -> DataFrame:
    """First record numbers from the counts of ranges: prefix sums in stretches of ranges, then
    over the stretches of a file."""
    total = ranges.agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0
    counted = spread(ranges.drop("first_rec_no"), "start", tasks_for(ranges.sparkSession, total, chunk_bytes)).mapInArrow(
        _count_blocked, "file string, start bigint, end bigint, length bigint, modified timestamp, n bigint, bad boolean"
    )
    counted = counted.withColumn("stretch", F.expr(f"start div ({chunk_bytes}L * 4096)")).checkpoint()
    # a file ends where a block is corrupt, whichever range that is in
    ends = counted.filter("bad").groupBy(F.col("file").alias("f")).agg(F.min("start").alias("e"))
    counted = counted.join(ends, F.col("file") == F.col("f"), "left").filter("e IS NULL OR start <= e").drop("f", "e")
    before = lambda *by: W.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(W.unboundedPreceding, -1)
    stretches = counted.groupBy("file", "stretch").agg(F.sum("n").alias("n"))
    offsets = stretches.select(F.col("file").alias("f"), F.col("stretch").alias("s"), F.coalesce(F.sum("n").over(before("file", "stretch")), F.lit(0)).alias("o"))
    local = counted.withColumn("b", F.coalesce(F.sum("n").over(before("file", "stretch", "start")), F.lit(0)))
    joined = local.join(offsets, (F.col("file") == F.col("f")) & (F.col("stretch") == F.col("s")))
    return joined.select("file", "start", "end", "length", (F.col("o") + F.col("b") + 1).alias("first_rec_no"), "modified").checkpoint()


def _files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    listed = list_files(spark, paths).filter("length > 0")
    return listed.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def vb_ranges(
    spark: SparkSession, paths: str | Sequence[str], *, chunk_bytes: int = CHUNK_BYTES, bdw: bool = False
) -> DataFrame:
    """The read index: ``(file, start, end, length, first_rec_no, modified)``, one row a range.

    With ``bdw`` the files hold blocks with descriptors of their own; the index is then one of blocks, and
    the records in them are counted in a scan more. :func:`keep_index` keeps an index for later reads.
    """
    zero = F.lit(0).cast("bigint")
    files = _files(spark, paths).withColumns({"base": zero, "n0": zero})
    return _ranges(spark, files, chunk_bytes, bdw)


def _ranges(spark: SparkSession, files: DataFrame, chunk_bytes: int, bdw: bool) -> DataFrame:
    """Index rows of ``files (file, length, modified, base, n0)`` from the record start ``base`` on, before which lie
    ``n0`` records."""
    shared_dir(spark)  # checkpoint() needs the folder set
    rest = files.withColumn("rest", F.col("length") - F.col("base"))
    few = rest.limit(FEW_RANGES + 1).toArrow()
    if few.num_rows <= FEW_RANGES:  # listed once
        rest = spark.createDataFrame(few, rest.schema)
        files = rest.drop("rest")
        each = few.column("rest").to_pylist()
        total, largest = sum(each), max(each, default=0)
    else:
        sizes = rest.agg(F.sum("rest").alias("total"), F.max("rest").alias("largest")).first()
        total, largest = sizes["total"], sizes["largest"]
    if largest <= chunk_bytes:  # nothing to look for: each file is one range
        one = rest.select("file", F.col("base").alias("start"), F.col("length").alias("end"), "length", (F.col("n0") + 1).alias("first_rec_no"), "modified")
        return _numbered(one, chunk_bytes) if bdw else one
    size = F.lit(chunk_bytes).cast("bigint")
    chunks = (
        rest.select("file", "base", F.col("rest").alias("length"), size.alias("chunk_bytes"))
        .withColumn("chunk", F.explode(F.expr("sequence(0L, (length - 1) div chunk_bytes)")))
        .filter("(chunk + 1) * chunk_bytes < length")
    )
    maps = spread(chunks, "chunk", tasks_for(spark, total, chunk_bytes)).mapInArrow(_scan_chunks, _MAP_DDL)
    above = (F.col("unit") / FAN).cast("bigint").alias("above")
    levels, span, units = [(maps.checkpoint(), chunk_bytes)], chunk_bytes, -(-largest // chunk_bytes)
    while units > FAN:
        maps = levels[-1][0].groupBy("file", above).applyInPandas(_composed, _MAP_DDL)
        span, units = span * FAN, -(-units // FAN)
        levels.append((maps.checkpoint(), span))
    zero = F.lit(0).cast("bigint")
    reached = rest.select("file", F.col("rest").alias("length"), zero.alias("unit"), zero.alias("pos"), zero.alias("n"))
    for maps, span in reversed(levels):
        parts = maps.groupBy("file", above)
        reached = reached.groupBy("file", F.col("unit").alias("above")).cogroup(parts).applyInPandas(_opened(span), _REACHED_DDL)
    found = reached.join(files.select(F.col("file").alias("f"), "base", "n0", "modified"), F.col("file") == F.col("f"))
    ranges = found.select(
        "file",
        (F.col("base") + F.col("pos")).alias("start"),
        (F.col("base") + F.least(F.expr(f"(unit + 1) * {chunk_bytes}L"), F.col("length"))).alias("end"),
        (F.col("base") + F.col("length")).alias("length"),
        (F.col("n0") + F.col("n") + 1).alias("first_rec_no"),
        "modified",
    ).checkpoint()
    return _numbered(ranges, chunk_bytes) if bdw else ranges


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to index rows the bytes at their starts."""
    for batch in batches:
        rows = batch.to_pylist()
        found = [bytes_at(r["file"], [r["start"]], MARK)[0] for r in rows]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, "mark"])


def _still(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether files still hold the marks of index rows."""
    for batch in batches:
        rows = batch.to_pylist()
        held = [bytes_at(r["file"], [r["start"]], len(r["mark"]))[0] == r["mark"] for r in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held)], names=["file", "held"])


def current_ranges(spark: SparkSession, paths: str | Sequence[str], index: DataFrame, *, chunk_bytes: int = CHUNK_BYTES, bdw: bool = False) -> DataFrame:
    """The index rows of all files that ``paths`` hold now, from ``index`` as far as it still holds.

    Rows of files that are no longer there, or elsewhere, are left out. A file of the length and time it was
    indexed with keeps its rows. One that grew is scanned from its last range on if it still holds the bytes it had
    at the start of every range; any other file is scanned whole. So reading by any index
    gives what reading without one does.
    """
    known = index if "modified" in index.columns else index.withColumn("modified", F.lit(None).cast("timestamp"))
    known = known if "mark" in known.columns else known.withColumn("mark", F.lit(None).cast("binary"))
    had = known.groupBy(F.col("file").alias("f")).agg(F.max("length").alias("had"), F.max("modified").alias("at"), F.max("start").alias("last"), F.count("mark").alias("marks"), F.count("*").alias("n"))
    state = _files(spark, paths).join(had, F.col("file") == F.col("f"), "left")
    same = (F.col("had") == F.col("length")) & (F.col("at").isNull() | (F.col("at") == F.col("modified")))
    grown = (F.col("had") < F.col("length")) & (F.col("marks") == F.col("n")) & F.lit(not bdw)
    state = state.withColumn("state", F.when(same, "same").when(grown, "grown").otherwise("new")).checkpoint()
    counts = {r["state"]: r["count"] for r in state.groupBy("state").count().collect()}
    columns = ["file", "start", "end", "length", "first_rec_no", "modified", "mark"]

    def of(which: DataFrame) -> DataFrame:
        return known.join(which.select(F.col("file").alias("w")), F.col("file") == F.col("w"), "left_semi")

    parts = [of(state.filter("state = 'same'")).select(*columns)]
    todo, zero = state.filter("state = 'new'"), F.lit(0).cast("bigint")
    scans = todo.select("file", "length", "modified", zero.alias("base"), zero.alias("n0"))
    if counts.get("grown"):
        old = of(state.filter("state = 'grown'"))
        kept = old.select("file", "start", "mark").mapInArrow(_still, "file string, held boolean").groupBy("file").agg(F.min("held").alias("held"))
        judged = state.filter("state = 'grown'").join(kept.withColumnRenamed("file", "k"), F.col("file") == F.col("k")).checkpoint()
        lasts = known.select(F.col("file").alias("g"), F.col("start").alias("s"), (F.col("first_rec_no") - 1).alias("n0"))
        onward = judged.filter("held").join(lasts, (F.col("file") == F.col("g")) & (F.col("last") == F.col("s")))
        scans = scans.unionAll(onward.select("file", "length", "modified", F.col("last").alias("base"), "n0"))
        scans = scans.unionAll(judged.filter("NOT held").select("file", "length", "modified", zero.alias("base"), zero.alias("n0")))
        news = judged.filter("held").select(F.col("file").alias("j"), F.col("length").alias("now"), F.col("modified").alias("then"), "last")
        front = old.join(news, (F.col("file") == F.col("j")) & (F.col("start") < F.col("last")))
        parts.append(front.select("file", "start", "end", F.col("now").alias("length"), "first_rec_no", F.col("then").alias("modified"), "mark"))
    if counts.get("new") or counts.get("grown"):
        parts.append(_ranges(spark, scans.checkpoint(), chunk_bytes, bdw).withColumn("mark", F.lit(None).cast("binary")).select(*columns))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def keep_index(spark: SparkSession, paths: str | Sequence[str], folder: str, *, chunk_bytes: int = CHUNK_BYTES, bdw: bool = False) -> DataFrame:
    """The index of ``paths``, kept in versions below ``folder``: the newest is read, checked and brought up to
    date by :func:`current_ranges`, and written as the next one if anything changed.

    Of two jobs that write one version the later fails; it can run again. Files that are new, grown or
    changed are scanned, no others.
    """
    folder = qualified(spark, folder.rstrip("/"))
    version = _newest(spark, folder)
    old = spark.read.parquet(f"{folder}/v={version:08d}") if version else spark.createDataFrame([], INDEX_DDL)
    now = current_ranges(spark, paths, old, chunk_bytes=chunk_bytes, bdw=bdw).checkpoint()
    rows = now.agg(F.count("*").alias("n"), F.count("mark").alias("marked")).first()
    if version and rows["n"] == rows["marked"] == old.count():
        return old
    bare = now.filter("mark IS NULL").drop("mark")
    marked = spread(bare, "start", max(1, (rows["n"] - rows["marked"]) // 64)).mapInArrow(_mark, INDEX_DDL)
    target = f"{folder}/v={version + 1:08d}"
    now.filter("mark IS NOT NULL").unionAll(marked).write.parquet(target)
    return spark.read.parquet(target)


def _newest(spark: SparkSession, folder: str) -> int:
    """The number of the newest whole version below a folder, 0 for none."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/v=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return max((int(s.getPath().getParent().getName()[2:]) for s in found or ()), default=0)


def _scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    chunk_bytes: int,
    index: DataFrame | None,
    bdw: bool,
    checked: bool = False,
    columns: Sequence[str] | None = None,
    where: RawFilter | None = None,
) -> DataFrame:
    if index is None:
        ranges = vb_ranges(spark, paths, chunk_bytes=chunk_bytes, bdw=bdw)
    else:
        ranges = index if checked else current_ranges(spark, paths, index, chunk_bytes=chunk_bytes, bdw=bdw)
    read = blocked_records if bdw else variable_records

    def records(r: dict, out: Output) -> Iterator[pa.RecordBatch]:
        return read(r["file"], r["start"], r["end"], r["length"], r["first_rec_no"], out, r["code"])

    return read_ranges(ranges.select("file", "start", "end", "length", "first_rec_no"), chunk_bytes, records, columns, where)


def tagged_vb(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    chunk_bytes: int = CHUNK_BYTES,
    index: DataFrame | None = None,
    bdw: bool = False,
    checked: bool = False,
    columns: Sequence[str] | None = None,
    where: RawFilter | None = None,
) -> DataFrame:
    """Records and rejects of one scan: ``(file, rec_no, rec_len, rec, error)``; a row with an
    ``error`` says where a corrupt file was given up and holds no record."""
    return _scan(spark, paths, chunk_bytes, index, bdw, checked, columns, where)


def read_vb(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    on_corrupt: str = "fail",
    chunk_bytes: int = CHUNK_BYTES,
    index: DataFrame | None = None,
    bdw: bool = False,
    checked: bool = False,
    columns: Sequence[str] | None = None,
    where: RawFilter | None = None,
) -> DataFrame:
    """``(file, rec_no, rec_len, rec)`` of variable-length files; ``rec`` is without
    its descriptor, ``rec_no`` counts from 1 in each file. ``bdw`` says that the records lie in
    blocks with descriptors of their own; without it such a file reads as a record per block.

    A corrupt descriptor ends its file, as no later record start can be trusted. It
    fails the query, or with ``on_corrupt="reject"`` shows up in :func:`vb_rejects`.

    An ``index`` spares the search for record starts in files it still fits (:func:`current_ranges`); ``checked``
    says that it was made for these paths just now. ``columns`` are those to fill, and ``where`` says which
    records need not become rows (:func:`mainspool.operators.rules.raw_filter`).
    """
    if on_corrupt not in ("fail", "reject"):
        raise ValueError(f"on_corrupt must be 'fail' or 'reject', not {on_corrupt!r}")
    scanned = _scan(spark, paths, chunk_bytes, index, bdw, checked, columns, where)
    if on_corrupt == "fail":
        message = F.concat(F.col("file"), F.lit(": "), F.col("error")) if "file" in scanned.columns else F.col("error")
        scanned = scanned.filter(F.col("error").isNull() | F.raise_error(message).cast("boolean"))
    else:
        scanned = scanned.filter(F.col("error").isNull())
    return scanned.drop("error")


def vb_rejects(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    chunk_bytes: int = CHUNK_BYTES,
    index: DataFrame | None = None,
    bdw: bool = False,
    checked: bool = False,
) -> DataFrame:
    """``(file, rec_no, error)``: where each corrupt file was given up."""
    scanned = _scan(spark, paths, chunk_bytes, index, bdw, checked)
    return scanned.filter(F.col("error").isNotNull()).select("file", "rec_no", "error")
