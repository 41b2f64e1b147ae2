"""Contiguous shards of near equal bytes, from global prefix sums.

Rows are ordered by id (null ids first), ties by size, checksum and a number that only spreads
rows equal in all these over tasks. A range partitioning sorts them; each partition sums
its bytes and rows as it is read; a prefix over these totals (a row per partition) gives
every row its global byte offset and position. A row belongs to the shard in whose
equal stretch of the total its middle byte lies, so shards are runs of the order and each
edge is at most half a row off its target.

Null texts count as no bytes, every row as one more. Repeated rows are separate rows. A row
larger than a stretch leaves shards empty; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from mainspool.llm.common import materialise, without

LAW = "bytes"


def _running(at: int):
    """Adds to each row of a partition its part, its row number and the bytes before it."""

    def run(batches):
        from pyspark import TaskContext

        part, rows, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            sizes = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(rows, rows + n)), pa.array(before + sums - sizes)],
                names=[*batch.schema.names, "__part", "__row", "__before"],
            )
            rows, before = rows + n, before + (int(sums[-1]) if n else 0)

    return run


def shard(rows: DataFrame, shards: int, id: str = "doc_id", size: str = "size", ties: list[str] | None = None) -> DataFrame:
    """``rows`` with ``law``, ``shard``, ``slot`` (gapless in its shard) and ``position`` (in all).

    ``rows`` is moved and written once: select only what the assignment has to carry.
    """
    rows = without(rows, ["law", "shard", "slot", "position"])
    keys = [F.col(f"`{c}`") for c in dict.fromkeys([id, size, *(ties or [])])]
    spread = rows.withColumn("__spread", F.xxhash64(F.monotonically_increasing_id()))
    names = [*rows.columns, "__spread"]
    ordered = spread.repartitionByRange(*keys, "__spread").sortWithinPartitions(*keys, "__spread")
    added = T.StructType.fromDDL("__part int, __row bigint, __before bigint").fields
    summed = materialise(ordered.mapInArrow(_running(names.index(size)), T.StructType([*ordered.schema.fields, *added])))
    totals = summed.groupBy("__part").agg(F.max("__row").alias("n"), F.max(F.col("__before") + F.col(f"`{size}`")).alias("b"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = totals.select("__part", F.coalesce(F.sum(F.col("n") + 1).over(earlier), F.lit(0)).alias("__n0"), F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("__b0"))
    total = totals.agg(F.sum("b")).first()[0] or 0
    placed = summed.join(F.broadcast(offsets), "__part")
    # the product stays exact beyond 64 bits, where total * shards does not fit
    whole = "decimal(38,0)"
    middle = F.expr(f"2 * cast(__b0 + __before as {whole}) + `{size}`")
    where = F.floor(middle.cast(whole) * F.lit(shards) / F.lit(max(2 * total, 1)).cast(whole))
    placed = placed.select(*(F.col(f"`{c}`") for c in rows.columns), F.least(where, F.lit(shards - 1)).cast("int").alias("shard"), (F.col("__n0") + F.col("__row")).alias("position"))
    first = placed.groupBy("shard").agg(F.min("position").alias("__first"))  # a row per shard
    return placed.join(F.broadcast(first), "shard").select(
        *(F.col(f"`{c}`") for c in rows.columns), F.lit(LAW).alias("law"), "shard", (F.col("position") - F.col("__first")).alias("slot"), "position"
    )


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``size``, the text's UTF-8 bytes and one, and ``text_crc32``."""
    docs = without(docs, ["size", "text_crc32"])
    column = F.col(f"`{text}`")
    return docs.select("*", (F.coalesce(F.octet_length(column), F.lit(0)) + 1).cast("bigint").alias("size"), F.crc32(F.coalesce(column, F.lit("")).cast("binary")).alias("text_crc32"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, files and rows in order; an existing folder fails."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def oracle(shards: int) -> str:
    """The shards of ``documents`` in SQL, with one window over all rows where Spark has partition totals."""
    step = "list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c >> 1, (c & 1) * 3988292384))"
    octets = "list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    crc = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), octets), lambda s, b: xor(s >> 8, crcs[xor(s & 255, b) + 1])), 4294967295)"
    return f"""
WITH crc_table AS (
  SELECT list({step} ORDER BY x) AS crcs FROM (SELECT unnest(range(256)) AS x)
), sized AS (
  SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) + 1 AS BIGINT) AS size, {octets} AS octets FROM documents
), summed AS (
  SELECT doc_id, size, {crc} AS text_crc32 FROM sized, crc_table
), placed AS (
  SELECT *, sum(size) OVER () AS total, sum(size) OVER w - size AS before, row_number() OVER w - 1 AS position
  FROM summed WINDOW w AS (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), dealt AS (
  SELECT *, CAST(least((2 * before + size) * {shards} // (2 * total), {shards - 1}) AS INT) AS shard FROM placed
)
SELECT doc_id, size, text_crc32, '{LAW}' AS law, shard, CAST(position - min(position) OVER (PARTITION BY shard) AS BIGINT) AS slot,
  CAST(position AS BIGINT) AS position, CAST(NULL AS INT) AS grown_shard FROM dealt"""
