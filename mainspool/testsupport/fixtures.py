"""Record files made from the test tables with Spark, for queries and tests.

Every row of the source tables is encoded. Each input is written once per session and
table folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mainspool.session import fine_shuffles, java_charsets, limit_generated_methods, scratch_path
from mainspool.sinks.vb import write_vb
from mainspool.testsupport import encode as e

_written: dict[tuple[str, str, str], str] = {}

OFFSET = 4
MARKER = "a7"
SKIPPED_STATUS = "P"
LINES_PER_RECORD = 100
PIECE = 30_000
ORDERS_PER_RECORD = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], descriptors: bool = True) -> str:
    """Path of an input, writing it first if this session has not."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_path(spark, name)
        limit_generated_methods(spark)
        with java_charsets(spark):
            records = build()
        with fine_shuffles(spark):
            write_vb(
                records.select(F.lit(name).alias("file"), (F.monotonically_increasing_id() + 1).alias("rec_no"), "rec"),
                path,
                descriptors=descriptors,
            )
        _written[key] = path
    return _written[key]


def customers(spark: SparkSession, sf_dir: str) -> str:
    """Variable-length: one record per customer and up to six of its orders, all orders."""

    def build() -> DataFrame:
        orders = table(spark, sf_dir, "orders").withColumn("salt", F.expr("o_orderkey div 65536"))
        ranked = e.rank_in_key(orders, "o_custkey", ["o_orderkey"], "salt")
        one = F.concat(
            e.comp3(F.col("o_totalprice"), 8, 2),
            e.digits(F.col("o_orderkey"), 12),
            e.text(F.date_format("o_orderdate", "yyyy-MM-dd"), 10),
            e.text(F.col("o_orderpriority"), 15),
        )
        blocks = (
            ranked.withColumn("block", F.expr(f"(rn - 1) div {ORDERS_PER_RECORD}"))
            .groupBy("o_custkey", "block")
            .agg(
                F.count("*").alias("n"),
                F.collect_list(F.struct("rn", one.alias("bytes"))).alias("items"),
            )
            .select("o_custkey", "n", e.joined(F.col("items")).alias("body"))
        )
        customer = table(spark, sf_dir, "customer")

        def person(held: Column) -> Column:
            return F.concat(
                e.digits(F.col("c_custkey"), 12),
                e.comp(held, 2),
                e.text(F.col("c_name"), 24),
                e.digits(F.col("c_nationkey"), 4),
                e.text(F.col("c_mktsegment"), 14),
            )

        # one join: a second one for customers without orders would rank all orders again
        each = customer.join(blocks, F.col("c_custkey") == F.col("o_custkey"), "left")
        body = F.coalesce("body", F.unhex(F.lit("")))
        return each.select(F.concat(person(F.coalesce("n", F.lit(0))), body).alias("rec"))

    return _once(spark, sf_dir, "customers", build)


def cut_customers(spark: SparkSession, sf_dir: str) -> str:
    """Variable-length account records without orders, cut short: by nation, the record
    ends inside the nation code or holds a blank segment."""

    def build() -> DataFrame:
        segment = F.when(F.col("c_nationkey") % 3 == 1, F.lit("")).otherwise(F.col("c_mktsegment"))
        whole = F.concat(
            e.digits(F.col("c_custkey"), 12),
            e.comp(F.lit(0), 2),
            e.text(F.col("c_name"), 24),
            e.digits(F.col("c_nationkey"), 4),
            e.text(segment, 14),
        )
        cut = F.when(F.col("c_nationkey") % 3 == 2, F.substring(whole, 1, 40)).otherwise(whole)
        return table(spark, sf_dir, "customer").select(cut.alias("rec"))

    return _once(spark, sf_dir, "cut_customers", build)


def sale_record() -> Column:
    gap = F.col("l_tax").cast("decimal(5,2)") - F.col("l_discount").cast("decimal(5,2)")
    sold = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return F.concat(
        e.text(F.col("l_orderkey"), 12),
        e.digits(F.col("l_linenumber"), 4),
        e.comp3(F.col("l_suppkey"), 5),
        e.comp3(F.col("l_partkey"), 5),
        e.comp3(F.date_format("l_shipdate", "yyyyMMdd"), 5),
        e.comp3(F.col("l_extendedprice"), 6, 2),
        e.comp3(sold, 5),
        e.zoned(gap, 5, 2),
    )


def sales(spark: SparkSession, sf_dir: str) -> str:
    """Fixed-length: one record per lineitem."""
    return _once(
        spark,
        sf_dir,
        "sales",
        lambda: table(spark, sf_dir, "lineitem").select(sale_record().alias("rec")),
        descriptors=False,
    )


def sales_vb(spark: SparkSession, sf_dir: str) -> str:
    """The same records, variable-length."""
    return _once(
        spark, sf_dir, "sales_vb", lambda: table(spark, sf_dir, "lineitem").select(sale_record().alias("rec"))
    )


def blocked(spark: SparkSession, sf_dir: str) -> str:
    """Variable-length sales records in blocks: up to 40 records of an order, each behind its own
    descriptor, behind the block's."""

    def build() -> DataFrame:
        size = F.lpad(F.hex(F.octet_length("rec") + 4), 4, "0")
        framed = F.concat(size, F.lit("0000"), F.hex("rec"))
        each = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", sale_record().alias("rec"))
        part = F.pmod(F.xxhash64("l_partkey", "rec"), F.lit(4096))
        blocks = each.groupBy("l_orderkey", part).agg(F.collect_list(framed).alias("records"))
        cut = F.explode(F.expr("transform(sequence(0, (size(records) - 1) div 40), i -> slice(records, i * 40 + 1, 40))"))
        return blocks.select(cut.alias("records")).select(F.unhex(F.array_join("records", "")).alias("rec"))

    return _once(spark, sf_dir, "blocked", build)


def suppliers(spark: SparkSession, sf_dir: str) -> str:
    """Fixed-length: one record per supplier."""

    def build() -> DataFrame:
        record = F.concat(
            e.text(F.col("s_name"), 30),
            e.text(F.lit("<>"), 2),
            e.comp(F.col("s_suppkey"), 4),
            e.comp((F.col("s_acctbal") - 5000).cast("decimal(15,2)") * 100, 8),
            e.comp(F.col("s_nationkey") - 12, 2),
            e.text(F.lit("|"), 1),
            e.text(F.when(F.col("s_acctbal") > 0, "Y").otherwise("N"), 1),
        )
        return table(spark, sf_dir, "supplier").select(record.alias("rec"))

    return _once(spark, sf_dir, "suppliers", build, descriptors=False)


def unset(spark: SparkSession, sf_dir: str) -> str:
    """Variable-length: a lineitem's number in two zoned fields, by number unset with blanks or
    low-values, behind blanks, or with a blank behind it."""

    def build() -> DataFrame:
        n = F.col("l_linenumber")
        kind = n % 4
        behind = F.encode(F.lpad(n.cast("string"), 4, " "), "cp037")
        before = F.encode(F.rpad(n.cast("string"), 4, " "), "cp037")
        field = F.when(kind == 0, F.unhex(F.lit("40404040"))).when(kind == 1, F.unhex(F.lit("00000000")))
        record = F.concat(e.digits(F.col("l_orderkey"), 12), field.when(kind == 2, behind).otherwise(before), F.when(kind < 2, F.unhex(F.lit("00400040"))).otherwise(e.zoned(-n, 4)))
        return table(spark, sf_dir, "lineitem").select(record.alias("rec"))

    return _once(spark, sf_dir, "unset", build)


def figures(spark: SparkSession, sf_dir: str) -> str:
    """Fixed-length: a customer's balance edited for print in two ways and in floating point."""

    def build() -> DataFrame:
        balance = F.col("c_acctbal")
        nation = F.when(F.col("c_nationkey") > 0, F.lpad(F.col("c_nationkey").cast("string"), 3, " ")).otherwise("   ")
        record = F.concat(
            e.digits(F.col("c_custkey"), 12),
            e.edited(balance, 14, "CR"),
            e.edited(balance, 12),
            e.hex_float(balance, 8),
            e.hex_float(F.col("c_nationkey") / 8 - 1, 4),
            F.encode(nation, "cp037"),
        )
        return table(spark, sf_dir, "customer").select(record.alias("rec"))

    return _once(spark, sf_dir, "figures", build, descriptors=False)


def baskets(spark: SparkSession, sf_dir: str) -> str:
    """Variable-length: a customer's orders, up to three a record, each with up to four of its lines, each
    with up to two notes. All orders and lines."""

    def build() -> DataFrame:
        lines = table(spark, sf_dir, "lineitem").withColumn("salt", F.expr("l_partkey div 4096"))
        notes = F.col("l_linenumber") % 3
        note = F.when(notes == 0, F.unhex(F.lit(""))).when(notes == 1, e.text(F.lit("one"), 3)).otherwise(e.text(F.lit("onetwo"), 6))
        line = F.concat(e.digits(F.col("l_linenumber"), 4), e.comp3(F.col("l_extendedprice"), 8, 2), e.digits(notes, 1), note, e.digits(F.col("l_partkey"), 12))
        # lines alike up to the price have the same bytes
        order = LINE_ORDER[: LINE_ORDER.index("l_extendedprice") + 1]
        held = e.runs_in_key(lines.select("l_orderkey", "salt", *order), "l_orderkey", order, "salt", 4, line)
        orders = table(spark, sf_dir, "orders")
        each = orders.join(held, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumns({"chunk": F.coalesce("block", F.lit(0)), "m": F.coalesce("n", F.lit(0))})
        placed = F.concat(e.digits(F.col("o_orderkey"), 12), e.comp(F.col("m"), 2), F.coalesce("body", F.unhex(F.lit(""))), e.text(F.col("o_orderstatus"), 1))
        # kept, as counting a customer's rows would make them all once more
        kept = scratch_path(spark, "placed")
        with fine_shuffles(spark):
            each.select("o_custkey", "o_orderkey", "chunk", placed.alias("placed"), F.expr("o_orderkey div 65536").alias("salt")).write.parquet(kept)
        blocks = e.runs_in_key(spark.read.parquet(kept), "o_custkey", ["o_orderkey", "chunk"], "salt", 3, F.col("placed"))
        return blocks.select(F.concat(e.digits(F.col("o_custkey"), 12), e.digits(F.col("n"), 1), F.col("body"), e.text(F.lit("END"), 3)).alias("rec"))

    return _once(spark, sf_dir, "baskets", build)


MIXED_LENGTH = 60


def mixed(spark: SparkSession, sf_dir: str, fixed: bool = False) -> str:
    """Customers, orders, parts and suppliers in one file, variable-length or blank up to one
    fixed length; no type takes the suppliers."""

    def build() -> DataFrame:
        customer = table(spark, sf_dir, "customer").select(
            F.concat(
                e.text(F.lit("10"), 2),
                e.digits(F.col("c_custkey"), 12),
                e.text(F.col("c_name"), 20),
                e.comp3(F.col("c_acctbal"), 6, 2),
            ).alias("rec")
        )
        order = table(spark, sf_dir, "orders").select(
            F.concat(
                e.text(F.lit("20"), 2),
                e.digits(F.col("o_orderkey"), 12),
                e.text(F.col("o_orderstatus"), 1),
                e.comp3(F.col("o_totalprice"), 6, 2),
                e.text(F.col("o_orderpriority"), 15),
            ).alias("rec")
        )
        part = table(spark, sf_dir, "part").select(
            F.concat(
                e.text(F.lit("30"), 2),
                e.digits(F.col("p_partkey"), 12),
                e.text(F.col("p_brand"), 10),
                e.comp(F.col("p_size"), 2),
            ).alias("rec")
        )
        supplier = table(spark, sf_dir, "supplier").select(
            F.concat(e.text(F.lit("40"), 2), e.digits(F.col("s_suppkey"), 12)).alias("rec")
        )
        whole = customer.unionByName(order).unionByName(part).unionByName(supplier)
        if not fixed:
            return whole
        blanks = F.unhex(F.lit("40" * MIXED_LENGTH))
        return whole.select(F.substring(F.concat("rec", blanks), 1, MIXED_LENGTH).alias("rec"))

    return _once(spark, sf_dir, f"mixed-{fixed}", build, descriptors=not fixed)


# Total order of one order's lineitems; the leading salt keeps ranking parallel, and there are
# the more of them the more parts there are.
LINE_ORDER = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def composite(
    spark: SparkSession, sf_dir: str, *, offset: int = 0, marked: bool = False, broken: bool = False
) -> str:
    """Variable-length: an order header, then one segment per lineitem, up to 100 a record.

    Shipped lines have longer segments. Orders without lines are header only. ``marked``
    gives returned lines the marker form of the length; ``broken`` ends records of the
    three lower priorities in a bad segment, in three different ways.
    """

    def build() -> DataFrame:
        body = F.concat(
            e.digits(F.col("l_linenumber"), 4),
            e.digits(F.col("l_partkey"), 12),
            e.digits(F.col("l_suppkey"), 12),
            e.comp3(F.col("l_quantity"), 5),
            e.comp3(F.col("l_extendedprice"), 8, 2),
        )
        padded = F.concat(body, F.when(F.col("l_linestatus") == "F", e.text(F.lit(""), 11)).otherwise(e.text(F.lit(""), 1)))
        said = F.octet_length(padded) + 4 - offset
        prefix = F.concat(e.text(F.lit("LI"), 2), e.comp(said, 2))
        if marked:
            with_marker = F.concat(F.unhex(F.lit(MARKER)), e.comp(said, 2).substr(2, 1), e.comp(F.lit(0), 2))
            prefix = F.when(F.col("l_returnflag") == "R", with_marker).otherwise(prefix)
        lines = table(spark, sf_dir, "lineitem").withColumn("salt", F.expr("l_partkey div 4096"))
        ranked = e.rank_in_key(lines, "l_orderkey", LINE_ORDER, "salt")
        blocks = (
            ranked.withColumn("block", F.expr(f"(rn - 1) div {LINES_PER_RECORD}"))
            .groupBy("l_orderkey", "block")
            .agg(F.collect_list(F.struct("rn", F.concat(prefix, padded).alias("bytes"))).alias("items"))
            .select("l_orderkey", "block", e.joined(F.col("items")).alias("body"))
        )
        orders = table(spark, sf_dir, "orders")
        on = F.col("o_orderkey") == F.col("l_orderkey")

        def header(block: Column) -> Column:
            key = F.when(F.col("o_orderstatus") == SKIPPED_STATUS, F.unhex(F.lit(MARKER))).otherwise(e.text(F.lit("A"), 1))
            return F.concat(
                e.digits(F.col("o_orderkey"), 12),
                e.text(F.col("o_orderstatus"), 1),
                key,
                e.digits(block, 6),
                e.text(F.col("o_orderpriority"), 20),
            )

        tail = F.unhex(F.lit(""))
        if broken:
            # too long; zero; cut off
            priority = F.col("o_orderpriority")
            bad = F.when(priority == "5-LOW", "E9E97FFF00").when(priority == "4-NOT SPECIFIED", "E9E9000000")
            tail = F.unhex(bad.when(priority == "3-MEDIUM", "E9E9").otherwise(""))
        # one join: a second one for orders without lines would rank all lines again
        held = F.when(F.col("block").isNotNull(), F.concat("body", tail)).otherwise(F.unhex(F.lit("")))
        return orders.join(blocks, on, "left").select(F.concat(header(F.coalesce("block", F.lit(0))), held).alias("rec"))

    return _once(spark, sf_dir, f"composite-{offset}-{marked}-{broken}", build)


def documents(spark: SparkSession, sf_dir: str) -> str:
    """Variable-length: document texts, whole, in pieces that fit a record: key 9(12), piece
    number 9(6), text."""

    def build() -> DataFrame:
        pieces = F.sequence(F.lit(0), F.greatest(F.expr(f"(length(text) - 1) div {PIECE}"), F.lit(0)).cast("int"))
        each = table(spark, sf_dir, "documents").select("doc_id", "text", F.explode(pieces).alias("piece"))
        held = F.substring(F.col("text"), F.col("piece") * PIECE + 1, F.lit(PIECE))
        # characters the charset lacks become a question mark
        known = F.regexp_replace(held, "[^\\x00-\\xFF]", "?")
        return each.select(
            F.concat(e.digits(F.col("doc_id"), 12), e.digits(F.col("piece"), 6), F.encode(known, "cp037")).alias("rec")
        )

    return _once(spark, sf_dir, "documents", build)
