"""Encoders for test inputs: table columns to EBCDIC record bytes, as Spark expressions.

Written apart from the codecs; the codecs are also pinned by hand-written vectors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rows of one key that a task may sort; keys are told apart by so many hashes.
MANY = 1 << 17
HASHES = 1 << 16


def text(c: Column, size: int) -> Column:
    """Characters padded or cut to ``size``, as cp037 bytes. Needs ``java_charsets``."""
    return F.encode(F.rpad(c.cast("string"), size, " "), "cp037")


def digits(c: Column, size: int) -> Column:
    """Unsigned zoned decimal."""
    return F.encode(F.lpad(c.cast("string"), size, "0"), "cp037")


def unscaled(c: Column, scale: int) -> Column:
    """The digits of the absolute value of a number with ``scale`` places."""
    return F.replace(F.abs(c.cast(f"decimal(18,{scale})")).cast("string"), F.lit("."), F.lit(""))


def _sign(c: Column) -> Column:
    return F.when(c.cast("decimal(18,2)") < 0, "D").otherwise("C")


def zoned(c: Column, size: int, scale: int = 0) -> Column:
    """Signed zoned decimal: the last zone is C or D."""
    whole = F.lpad(unscaled(c, scale), size, "0")
    head = F.encode(F.substring(whole, 1, size - 1), "cp037")
    return F.concat(head, F.unhex(F.concat(_sign(c), F.substring(whole, size, 1))))


def comp3(c: Column, size: int, scale: int = 0) -> Column:
    return F.unhex(F.concat(F.lpad(unscaled(c, scale), 2 * size - 1, "0"), _sign(c)))


def comp(c: Column, size: int) -> Column:
    wide = F.lpad(F.hex(c.cast("bigint")), 16, "0")
    return F.unhex(F.substring(wide, 17 - 2 * size, 2 * size))


def hex_float(c: Column, size: int) -> Column:
    """Hexadecimal floating point; a DOUBLE fits one of eight bytes as it is."""
    value, places = F.abs(c.cast("double")), 8 * size - 8
    power = F.floor(F.floor(F.log2(value)) / 4).cast("int") + 1
    fraction = lambda p: F.floor(value * F.pow(F.lit(2.0), places - 4 * p))
    # the logarithm may be rounded to the next whole number
    power = F.when(fraction(power) >= 1 << places, power + 1).when(fraction(power) < 1 << (places - 4), power - 1).otherwise(power)
    head = F.hex((F.when(c < 0, 192).otherwise(64) + power).cast("bigint"))
    some = F.unhex(F.concat(F.lpad(head, 2, "0"), F.lpad(F.hex(fraction(power).cast("bigint")), places // 4, "0")))
    return F.when(value > 0, some).otherwise(F.unhex(F.lit("00" * size)))


def edited(c: Column, size: int, minus: str = "") -> Column:
    """A number with two places and commas, blanks in front; ``minus`` behind negative ones, or else a sign before the digits."""
    shown = F.format_number(F.abs(c), 2)
    negative = F.round(c, 2) < 0
    if minus:
        whole = F.concat(F.lpad(shown, size - len(minus), " "), F.when(negative, minus).otherwise(" " * len(minus)))
    else:
        whole = F.lpad(F.concat(F.when(negative, "-").otherwise("+"), shown), size, " ")
    return F.encode(whole, "cp037")


def rank_in_key(df: DataFrame, key: str, order: list[str], salt: str, name: str = "rn") -> DataFrame:
    """``row_number() over (partition by key order by salt, order)``, safe for hot keys.

    Rows are ranked inside (key, salt); the few salts of a key then give the rank each
    one starts at. No task holds all rows of a key.
    """
    local = df.withColumn("_local", F.row_number().over(W.partitionBy(key, salt).orderBy(*order)))
    sizes = df.groupBy(key, salt).agg(F.count("*").alias("_size"))
    before = W.partitionBy(key).orderBy(salt).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(key, salt, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return local.join(starts, [key, salt]).withColumn(name, F.col("_local") + F.col("_start")).drop("_local", "_start")


def joined(items: Column) -> Column:
    """Bytes of (rank, bytes) structs, in rank order, end to end."""
    none = F.unhex(F.lit(""))
    return F.aggregate(F.sort_array(items), none, lambda whole, s: F.concat(whole, F.coalesce(s["bytes"], none)))


def runs_in_key(df: DataFrame, key: str, order: list[str], salt: str, size: int, one: Column) -> DataFrame:
    """Runs of ``size`` rows of a key, in the ranks of :func:`rank_in_key`: ``(key, block, n, body)``, where ``body`` is the
    bytes ``one`` of a run's rows end to end.

    Keys of few rows are sorted whole, and a run's first row looks at those behind it. Which keys may have
    many is told by how many rows share the hash of their key; those are ranked by salt, so that no task holds all
    rows of one.
    """
    whole = df.where(F.col(key).isNotNull()).withColumn("_hash", F.pmod(F.xxhash64(key), F.lit(HASHES)))
    many = [r["_hash"] for r in whole.groupBy("_hash").agg(F.count("*").alias("n")).where(F.col("n") > MANY).select("_hash").collect()]
    none = F.unhex(F.lit(""))
    # the bytes are made behind the shuffle, which they would make larger
    few = (whole.where(~F.col("_hash").isin(many)) if many else whole).drop("_hash").repartition(key)
    along = W.partitionBy(key).orderBy(salt, *order)
    # as in rank_in_key, a row without a salt has a rank but is left out
    row = few.select(key, salt, *order, F.when(F.col(salt).isNotNull(), F.struct(one.alias("bytes"))).alias("_row"))
    next_ones = [F.lead("_row", i).over(along).alias(f"_row{i}") for i in range(1, size)]
    first = row.select(key, F.row_number().over(along).alias("_rn"), F.col("_row").alias("_row0"), *next_ones).where((F.col("_rn") - 1) % size == 0)
    rows = [F.col(f"_row{i}") for i in range(size)]
    body = F.concat(*(F.coalesce(r["bytes"], none) for r in rows))
    n = sum((r.isNotNull().cast("bigint") for r in rows[1:]), rows[0].isNotNull().cast("bigint"))
    runs = first.select(key, F.expr(f"(_rn - 1) div {size}").alias("block"), n.alias("n"), body.alias("body")).where(F.col("n") > 0)
    if not many:
        return runs
    ranked = rank_in_key(whole.where(F.col("_hash").isin(many)), key, order, salt, "_rn").withColumn("block", F.expr(f"(_rn - 1) div {size}"))
    lists = ranked.groupBy(key, "block").agg(F.count("*").alias("n"), F.collect_list(F.struct("_rn", one.alias("bytes"))).alias("items"))
    return runs.unionByName(lists.select(key, "block", "n", joined(F.col("items")).alias("body")))
