"""One query per operator, each over whole test tables, with the SQL it must equal.

A query reads record files that Spark encoded from the tables, runs the operator, and
gives columns the SQL computes from the original tables. Decimals are compared as
doubles or text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mainspool.functions import codec
from mainspool.operators import decode as d
from mainspool.operators import route as r
from mainspool.operators import rules
from mainspool.operators import segments as s
from mainspool.plans import jobs
from mainspool.session import java_charsets, scratch_path
from mainspool.sinks import tables
from mainspool.sinks.vb import write_vb
from mainspool.sources.files import list_files
from mainspool.sources.fixed import read_fb
from mainspool.sources.framing import filesystem, open_file
from mainspool.sources.variable import keep_index, read_vb
from mainspool.testsupport import fixtures as fx
from mainspool.testsupport import layouts as lay

# Ranges small enough that test files are cut and indexed as large ones are.
CHUNK = 1 << 18

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def num(name: str, as_: str | None = None) -> Column:
    return F.col(name).cast("double").alias(as_ or name)


def big(name: str, as_: str | None = None) -> Column:
    return F.col(name).cast("bigint").alias(as_ or name)


# --- SQL shared by several oracles ---------------------------------------------------

# customer records: up to six orders each, all orders; customers without orders once
CUSTOMER_SQL = """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS rn FROM orders
), placed AS (
  SELECT *, rn // 6 AS block, rn % 6 AS pos FROM ranked
), sized AS (
  SELECT *, count(*) OVER (PARTITION BY o_custkey, block) AS n FROM placed
), records AS (
  SELECT c_custkey, c_name, c_mktsegment, c_nationkey, block, coalesce(n, 0) AS n
  FROM customer LEFT JOIN (SELECT DISTINCT o_custkey, block, n FROM sized) ON c_custkey = o_custkey
)
"""

# lineitems in composite records of up to 100
LINES_SQL = """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey // 4096, l_linenumber, l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS rn FROM lineitem
), lines AS (
  SELECT *, rn // 100 AS block, rn % 100 AS pos, CASE WHEN l_linestatus = 'F' THEN 56 ELSE 46 END AS stride
  FROM ranked JOIN orders ON l_orderkey = o_orderkey
)
"""

LINE_FIELDS_SQL = """o_orderkey AS order_key, l_linenumber AS line_no, l_partkey AS part_key, l_suppkey AS supp_key,
  l_quantity AS quantity, l_extendedprice AS price"""

NATION_SQL = "lpad(CAST(c_nationkey AS VARCHAR), 4, '0')"

SALE_SQL = """SELECT CAST(l_orderkey AS VARCHAR) AS order_ref, l_suppkey AS supplier_no,
  CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS shipped_on, l_partkey AS part_no,
  CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT) AS units,
  l_extendedprice AS net_price FROM lineitem"""


def clean_sql(text: str) -> str:
    """The cleaning rule in SQL."""
    for chars in ("chr(10) || chr(13)", "chr(13) || chr(10)", "chr(10)", "chr(13)", "chr(9)", "chr(8)"):
        text = f"replace({text}, {chars}, ' ')"
    folded = f"regexp_replace(strip_accents({text}), '[^\\x00-\\x7F]', '', 'g')"
    return f"regexp_replace({folded}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


# --- scans ----------------------------------------------------------------------------


@query(
    CUSTOMER_SQL
    + """SELECT c_custkey AS acct_key, c_name AS holder_name, CAST(n AS BIGINT) AS orders_held,
    CAST(56 + 45 * n AS BIGINT) AS rec_len FROM records"""
)
def scan_vb(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.customers(spark, sf_dir), chunk_bytes=CHUNK)
    decoded = d.decode_flat(records, lay.ACCOUNT, keep=("rec_len",))
    return decoded.select(
        big("ACCT_KEY", "acct_key"),
        F.rtrim("HOLDER_NAME").alias("holder_name"),
        big("ORDERS_HELD", "orders_held"),
        big("rec_len"),
    )


@query("SELECT s_suppkey AS vendor_no, s_name AS vendor_name, CAST(48 AS BIGINT) AS rec_len FROM supplier")
def scan_fb(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_fb(spark, fx.suppliers(spark, sf_dir), lay.SUPPLIER.max_length)
    decoded = d.decode_flat(records, lay.SUPPLIER, keep=("rec_len",))
    return decoded.select(big("VENDOR_NO", "vendor_no"), F.rtrim("VENDOR_NAME").alias("vendor_name"), big("rec_len"))


@query(
    """SELECT CAST((SELECT count(*) FROM lineitem) + (SELECT count(*) FROM customer) AS BIGINT) AS records,
    CAST((SELECT count(*) FROM lineitem) * 47 + (SELECT sum(CASE WHEN c_nationkey % 3 = 2 THEN 40 ELSE 56 END)
    FROM customer) AS BIGINT) AS bytes"""
)
def scan_multi_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = f"{fx.sales_vb(spark, sf_dir)},{fx.cut_customers(spark, sf_dir)}"
    return read_vb(spark, both).agg(F.count("*").alias("records"), F.sum("rec_len").cast("bigint").alias("bytes"))


@query("SELECT CAST(count(*) * (47 + 4) AS BIGINT) AS bytes, TRUE AS is_part FROM lineitem")
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per file with its length: the lengths add up to the records written."""
    files = list_files(spark, fx.sales_vb(spark, sf_dir)).filter("length > 0")
    return files.agg(F.sum("length").alias("bytes"), F.every(F.expr("path LIKE '%/part-%.vb' AND length % 51 = 0")).alias("is_part"))


@query(CUSTOMER_SQL + "SELECT CAST(56 + 45 * n AS BIGINT) AS rec_len, count(*) AS records FROM records GROUP BY 1")
def record_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.customers(spark, sf_dir))
    return records.groupBy(big("rec_len")).agg(F.count("*").alias("records"))


@query(
    """SELECT count(*) AS records, CAST(1 AS BIGINT) AS first_no, count(*) AS distinct_numbers, TRUE AS dense
    FROM lineitem"""
)
def record_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record numbers run from 1 without gaps in every file, however it is cut up to read it."""
    records = read_vb(spark, fx.sales_vb(spark, sf_dir), chunk_bytes=CHUNK)
    each = records.groupBy("file").agg(
        F.count("*").alias("n"), F.min("rec_no").alias("lo"), F.max("rec_no").alias("hi"), F.sum("rec_no").alias("total")
    )
    dense = (F.col("hi") == F.col("n")) & (F.col("total") == F.expr("n * (n + 1) div 2"))
    return each.agg(
        F.sum("n").alias("records"),
        F.min("lo").alias("first_no"),
        F.sum("hi").alias("distinct_numbers"),
        F.every(dense).alias("dense"),
    )


@query(
    """SELECT count(*) AS records, CAST(1 AS BIGINT) AS first_no, TRUE AS dense, CAST(sum(l_orderkey) AS BIGINT) AS keys
    FROM lineitem"""
)
def scan_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in blocks with descriptors: all are found and numbered without gaps."""
    records = read_vb(spark, fx.blocked(spark, sf_dir), chunk_bytes=CHUNK, bdw=True)
    decoded = d.decode_flat(records, lay.SALES).select("file", "rec_no", F.rtrim("ORDER_REF").cast("bigint").alias("key"))
    each = decoded.groupBy("file").agg(
        F.count("*").alias("n"), F.min("rec_no").alias("lo"), F.max("rec_no").alias("hi"), F.sum("rec_no").alias("total"), F.sum("key").alias("keys")
    )
    dense = (F.col("hi") == F.col("n")) & (F.col("total") == F.expr("n * (n + 1) div 2"))
    return each.agg(F.sum("n").alias("records"), F.min("lo").alias("first_no"), F.every(dense).alias("dense"), F.sum("keys").alias("keys"))


# --- field decode ---------------------------------------------------------------------


def _append_files(batches):
    """Appends the bytes of each row's ``source`` to its ``target``, in a task."""
    for batch in batches:
        for source, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            system, inner = filesystem(target)
            with open_file(source) as f, system.open_append_stream(inner) as out:
                while data := f.read(1 << 20):
                    out.write(data)
        yield batch


@query(
    """SELECT CAST(l_orderkey AS VARCHAR) AS order_ref, CAST(l_linenumber AS BIGINT) AS line_pos, l_extendedprice AS net_price
    FROM lineitem WHERE l_linenumber % 3 = 0 UNION ALL SELECT CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS BIGINT), l_extendedprice
    FROM lineitem, (VALUES (1), (2)) WHERE l_linenumber % 3 = 2"""
)
def index_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index kept while files are added, removed and appended to reads what is there."""
    root, kept = scratch_path(spark, "indexed"), scratch_path(spark, "index")
    lines = fx.table(spark, sf_dir, "lineitem")

    def put(rest: int) -> None:
        with java_charsets(spark):
            number = (F.monotonically_increasing_id() + 1).alias("rec_no")
            rows = lines.filter(F.col("l_linenumber") % 3 == rest).select(F.lit("lines").alias("file"), number, fx.sale_record().alias("rec"))
        write_vb(rows, f"{root}/{rest}")

    put(0)
    put(1)
    keep_index(spark, root, kept, chunk_bytes=CHUNK)
    put(2)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/1")
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    by_place = F.row_number().over(W.orderBy("path"))  # a row per file
    old, new = (list_files(spark, f"{root}/{n}/lines").select("path", by_place.alias("k")) for n in (0, 2))
    # the first file takes what has no partner
    pairs = new.join(old.withColumnRenamed("path", "target"), "k", "left").crossJoin(old.filter("k = 1").select(F.col("path").alias("first")))
    pairs = pairs.select("path", F.coalesce("target", "first").alias("target"))
    pairs.repartition("target").mapInArrow(_append_files, "path string, target string").count()
    index = keep_index(spark, root, kept, chunk_bytes=CHUNK)
    back = d.decode_flat(read_vb(spark, root, index=index, chunk_bytes=CHUNK), lay.SALES)
    return back.select(F.rtrim("ORDER_REF").alias("order_ref"), big("LINE_POS", "line_pos"), num("NET_PRICE", "net_price"))


@query(
    """SELECT doc_id, piece, regexp_replace(substr(text, piece * 30000 + 1, 30000), '[^\\x00-\\xFF]', '?', 'g') AS text
    FROM (SELECT doc_id, text, unnest(range(greatest((length(text) - 1) // 30000, 0) + 1)) AS piece FROM documents)"""
)
def decode_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts, in the pieces that fit a record."""
    records = read_vb(spark, fx.documents(spark, sf_dir))
    with java_charsets(spark):
        return records.select(
            codec.decode("substring(rec, 1, 12)", "zoned", 12).cast("bigint").alias("doc_id"),
            codec.decode("substring(rec, 13, 6)", "zoned", 6).cast("bigint").alias("piece"),
            codec.decode("substring(rec, 19, rec_len - 18)", "text", 0).alias("text"),
        )


@query(
    """SELECT CAST(l_linenumber AS BIGINT) AS line_pos,
    CAST(CAST(l_tax AS DECIMAL(5,2)) - CAST(l_discount AS DECIMAL(5,2)) AS DOUBLE) AS tax_gap FROM lineitem"""
)
def decode_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_fb(spark, fx.sales(spark, sf_dir), lay.SALES.max_length)
    return d.decode_flat(records, lay.SALES).select(big("LINE_POS", "line_pos"), num("TAX_GAP", "tax_gap"))


@query(
    """SELECT s_suppkey AS vendor_no, CAST(s_nationkey - 12 AS BIGINT) AS nation_gap,
    CAST(CAST(s_acctbal - 5000 AS DECIMAL(15,2)) AS DOUBLE) AS balance_gap FROM supplier"""
)
def decode_comp(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_fb(spark, fx.suppliers(spark, sf_dir), lay.SUPPLIER.max_length)
    return d.decode_flat(records, lay.SUPPLIER).select(
        big("VENDOR_NO", "vendor_no"), big("NATION_GAP", "nation_gap"), num("BALANCE_GAP", "balance_gap")
    )


def _sale(decoded: DataFrame, *more: Column) -> DataFrame:
    return decoded.select(
        F.rtrim("ORDER_REF").alias("order_ref"),
        big("SUPPLIER_NO", "supplier_no"),
        big("SHIPPED_ON", "shipped_on"),
        big("PART_NO", "part_no"),
        big("UNITS", "units"),
        num("NET_PRICE", "net_price"),
        *more,
    )


@query(SALE_SQL)
def decode_comp3(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_fb(spark, fx.sales(spark, sf_dir), lay.SALES.max_length)
    return _sale(d.decode_flat(records, lay.SALES))


@query(
    SALE_SQL.replace("l_extendedprice AS net_price FROM", "l_extendedprice AS net_price, CAST(0 AS BIGINT) AS bad FROM")
)
def decode_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_fb(spark, fx.sales(spark, sf_dir), lay.SALES.max_length)
    typed = d.decode_typed(records, lay.SALES)
    flat = typed.select("LINE_ID.*", "SUPPLIER_NO", "SHIPPED_ON", "PART_NO", "UNITS", "NET_PRICE", "_bad_fields")
    return _sale(flat, F.size("_bad_fields").cast("bigint").alias("bad"))


@query(
    """SELECT replace(CAST(CAST(l_extendedprice AS DECIMAL(11,2)) AS VARCHAR), '.', ',') AS net_price,
    replace(CAST(CAST(l_tax AS DECIMAL(5,2)) - CAST(l_discount AS DECIMAL(5,2)) AS VARCHAR), '.', ',') AS tax_gap,
    CAST(l_linenumber AS VARCHAR) AS line_pos FROM lineitem"""
)
def decode_comma_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.sales_vb(spark, sf_dir))
    decoded = d.decode_text(records, lay.SALES, dialect="comma")
    return decoded.select(
        F.col("NET_PRICE").alias("net_price"), F.col("TAX_GAP").alias("tax_gap"), F.col("LINE_POS").alias("line_pos")
    )


@query(
    CUSTOMER_SQL
    + """SELECT o_orderkey AS order_key, strftime(o_orderdate, '%Y-%m-%d') AS whole, strftime(o_orderdate, '%d') AS day,
    strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%Y') AS year FROM orders"""
)
def decode_redefines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overlay of the order day, in every order."""
    records = read_vb(spark, fx.customers(spark, sf_dir))
    typed = d.decode_typed(records, lay.ACCOUNT).select(F.explode("BOOK.PLACED").alias("t"))
    return typed.select(
        big("t.ORDER_KEY", "order_key"),
        F.col("t.ORDER_DAY").alias("whole"),
        F.col("t.DAY_PARTS.DAY_OF_MONTH").alias("day"),
        F.col("t.DAY_PARTS.DAY_MONTH").alias("month"),
        F.col("t.DAY_PARTS.DAY_YEAR").alias("year"),
    )


@query(
    CUSTOMER_SQL
    + """SELECT c_custkey AS acct_key, c_name AS holder_name, pos, o_orderkey AS order_key,
    o_totalprice AS amount, o_orderpriority AS comment
    FROM sized JOIN customer ON c_custkey = o_custkey"""
)
def decode_occurs_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.customers(spark, sf_dir))
    typed = d.decode_typed(records, lay.ACCOUNT)
    each = typed.select(
        "ACCT_KEY", "HOLDER.HOLDER_NAME", F.posexplode("BOOK.PLACED").alias("pos", "t")
    )
    return each.select(
        big("ACCT_KEY", "acct_key"),
        F.rtrim("HOLDER_NAME").alias("holder_name"),
        big("pos"),
        big("t.ORDER_KEY", "order_key"),
        num("t.PRICE", "amount"),
        F.rtrim("t.PRIORITY").alias("comment"),
    )


def _flat_sql(i: int) -> str:
    bad = "'BAD_FIELD_RECORD'"
    return f"""coalesce(max(CASE WHEN pos = {i} THEN CAST(o_orderkey AS VARCHAR) END), {bad}) AS key_{i},
    coalesce(max(CASE WHEN pos = {i} THEN CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END), {bad}) AS amount_{i},
    coalesce(max(CASE WHEN pos = {i} THEN o_orderpriority END), {bad}) AS comment_{i}"""


@query(
    CUSTOMER_SQL
    + f"""SELECT CAST(c_custkey AS VARCHAR) AS acct_key, {", ".join(_flat_sql(i) for i in range(6))}
    FROM customer LEFT JOIN sized ON c_custkey = o_custkey GROUP BY c_custkey, block"""
)
def decode_occurs_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column per subscript; past the record's end the bad-field marker."""
    records = read_vb(spark, fx.customers(spark, sf_dir))
    text = d.decode_text(records, lay.ACCOUNT)
    columns = [F.col("ACCT_KEY").alias("acct_key")]
    for i in range(6):
        columns += [
            F.col(f"ORDER_KEY_{i}").alias(f"key_{i}"),
            F.col(f"PRICE_{i}").alias(f"amount_{i}"),
            F.col(f"PRIORITY_{i}").alias(f"comment_{i}"),
        ]
    return text.select(*columns)


@query(
    """SELECT c_custkey AS cust_key, c_acctbal AS printed, c_acctbal AS signed, CAST(CAST(c_acctbal AS DECIMAL(9,2)) AS VARCHAR) AS shown,
    CAST(c_nationkey AS VARCHAR) AS nation FROM customer"""
)
def decode_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances edited for print with commas, a floating sign and CR, read back as numbers and as text."""
    records = read_fb(spark, fx.figures(spark, sf_dir), lay.FIGURES.max_length, chunk_bytes=CHUNK)
    flat = d.decode_flat(records, lay.FIGURES).select("file", "rec_no", big("CUST_KEY", "cust_key"), num("PRINTED", "printed"), num("SIGNED", "signed"))
    text = d.decode_text(records, lay.FIGURES).select("file", "rec_no", F.col("SIGNED").alias("shown"), F.col("NATION").alias("nation"))
    return flat.join(text, ["file", "rec_no"]).drop("file", "rec_no")


@query(
    """SELECT c_custkey AS cust_key, c_acctbal AS exact, CAST(c_nationkey AS DOUBLE) / 8 - 1 AS short,
    CAST(CAST(c_nationkey AS DOUBLE) / 8 - 1 AS VARCHAR) AS shown FROM customer"""
)
def decode_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hexadecimal floating point of eight and four bytes."""
    records = read_fb(spark, fx.figures(spark, sf_dir), lay.FIGURES.max_length, chunk_bytes=CHUNK)
    typed = d.decode_typed(records, lay.FIGURES).select("file", "rec_no", big("CUST_KEY", "cust_key"), F.col("EXACT").alias("exact"), F.col("SHORT").alias("short"))
    text = d.decode_text(records, lay.FIGURES).select("file", "rec_no", F.col("SHORT").alias("shown"))
    return typed.join(text, ["file", "rec_no"]).drop("file", "rec_no")


BASKET_SQL = """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey // 4096, l_linenumber, l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS rn FROM lineitem
), held AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, coalesce(rn // 4, 0) AS chunk, rn, l_linenumber, l_partkey, l_extendedprice
  FROM orders LEFT JOIN ranked ON o_orderkey = l_orderkey
)
"""


@query(
    BASKET_SQL
    + """SELECT o_custkey AS owner, o_orderkey AS order_key, o_orderstatus AS status, CAST(l_linenumber AS BIGINT) AS line_no, l_partkey AS part_key,
    l_extendedprice AS price, CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN 'one' WHEN 2 THEN 'one,two' END AS notes, 'END' AS mark, TRUE AS good FROM held"""
)
def decode_nested_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of varying length in groups of varying length, nested, all orders and lines."""
    t = d.decode_typed(read_vb(spark, fx.baskets(spark, sf_dir), chunk_bytes=CHUNK), lay.BASKET, keep=())
    placed = t.select("OWNER", "LAST_MARK", (F.size("_bad_fields") == 0).alias("good"), F.explode("PLACED").alias("p"))
    lines = placed.select("OWNER", "LAST_MARK", "good", "p", F.explode_outer("p.LINE").alias("l"))
    return lines.select(
        big("OWNER", "owner"),
        big("p.ORDER_KEY", "order_key"),
        F.col("p.STATUS").alias("status"),
        big("l.LINE_NO", "line_no"),
        big("l.PART_KEY", "part_key"),
        num("l.PRICE", "price"),
        F.array_join("l.NOTE", ",").alias("notes"),
        F.col("LAST_MARK").alias("mark"),
        "good",
    )


@query(
    BASKET_SQL
    + """SELECT o_custkey AS owner, o_orderkey AS order_key, o_orderstatus AS status, count(l_partkey) AS held, CAST(coalesce(sum(l_partkey), 0) AS BIGINT) AS parts,
    'END' AS mark FROM held GROUP BY o_custkey, o_orderkey, o_orderstatus, chunk"""
)
def decode_nested_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records in a column per subscript: the columns of occurrences that a record lacks are NULL."""
    f = d.decode_flat(read_vb(spark, fx.baskets(spark, sf_dir), chunk_bytes=CHUNK), lay.BASKET, keep=())

    def occurrence(i: int) -> Column:
        lines = [F.coalesce(F.col(f"PART_KEY_{i}__{k}").cast("bigint"), F.lit(0)) for k in range(4)]
        return F.struct(F.col(f"ORDER_KEY_{i}").alias("k"), F.col(f"STATUS_{i}").alias("s"), F.col(f"LINES_HELD_{i}").alias("m"), sum(lines[1:], lines[0]).alias("p"))

    each = f.select("OWNER", "LAST_MARK", F.explode(F.array(*map(occurrence, range(3)))).alias("o")).filter("o.k IS NOT NULL")
    return each.select(big("OWNER", "owner"), big("o.k", "order_key"), F.col("o.s").alias("status"), big("o.m", "held"), F.col("o.p").cast("bigint").alias("parts"), F.col("LAST_MARK").alias("mark"))



@query(
    CUSTOMER_SQL
    + """SELECT c_custkey AS acct_key, pos, o_orderkey AS order_key, o_totalprice AS price,
    strftime(o_orderdate, '%Y-%m-%d') AS order_day, FALSE AS has_parts
    FROM sized JOIN customer ON c_custkey = o_custkey"""
)
def split_redefine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without overlays: each order's other fields as they are, no part of its day."""
    records = read_vb(spark, fx.customers(spark, sf_dir))
    short = d.decode_flat(records, lay.ACCOUNT, keep=(), split="redefine")
    each = ", ".join(f"{i}L, ORDER_KEY_{i}, PRICE_{i}, ORDER_DAY_{i}" for i in range(6))
    orders = short.selectExpr("ACCT_KEY", f"stack(6, {each}) AS (pos, order_key, price, order_day)")
    return orders.filter("order_key IS NOT NULL").select(
        big("ACCT_KEY", "acct_key"),
        "pos",
        big("order_key"),
        num("price"),
        "order_day",
        F.lit(any("DAY_YEAR" in c or "FILLER" in c for c in short.columns)).alias("has_parts"),
    )


@query(
    """SELECT s_suppkey AS vendor_no, s_name AS vendor_name, lower(printf('%08x', s_suppkey)) AS seen_hex,
    'VENDOR_NAME,FILLER_1,VENDOR_NO,BALANCE_GAP,NATION_GAP,FILLER_2,IN_CREDIT' AS first_view FROM supplier"""
)
def split_level1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two level-01 views of one record: both are decoded, or only the first."""
    records = read_fb(spark, fx.suppliers(spark, sf_dir), lay.SUPPLIER.max_length)
    both = d.decode_flat(records, lay.SUPPLIER_VIEWS, keep=("rec_no",))
    first = d.decode_flat(records, lay.SUPPLIER_VIEWS, keep=(), split="level1")
    return both.select(
        big("VENDOR_NO", "vendor_no"),
        F.rtrim("VENDOR_NAME").alias("vendor_name"),
        F.lower(F.lpad(F.hex("SEEN_NO"), 8, "0")).alias("seen_hex"),
        F.lit(",".join(first.columns)).alias("first_view"),
    )


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS "VENDOR_NO", CAST(s_nationkey - 12 AS VARCHAR) AS "NATION_GAP", '<>' AS "FILLER_1",
    CAST(CAST(s_acctbal - 5000 AS DECIMAL(15,2)) AS VARCHAR) AS "BALANCE_GAP", s_name AS "VENDOR_NAME", '|' AS "FILLER_2",
    CASE WHEN s_acctbal > 0 THEN 'Y' ELSE 'N' END AS "IN_CREDIT" FROM supplier"""
)
def column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as they come out of the layout: dashes replaced, fillers numbered."""
    records = read_fb(spark, fx.suppliers(spark, sf_dir), lay.SUPPLIER.max_length)
    return d.decode_text(records, lay.SUPPLIER, keep=())


@query(f"SELECT doc_id, {clean_sql('text')} AS text FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "documents").select("doc_id", F.expr(codec.clean("text")).alias("text"))


@query(f"SELECT conv_id, turn, {clean_sql('text')} AS text FROM conversations")
def clean_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(codec.clean("text")).alias("text"))


CUT_SQL = f"""SELECT CAST(c_custkey AS VARCHAR) AS acct_key, c_name AS holder_name,
  CASE c_nationkey % 3 WHEN 2 THEN 'BAD_FIELD_RECORD' WHEN 1 THEN 'NULL' ELSE c_mktsegment END AS segment,
  CASE WHEN c_nationkey % 3 = 2 THEN 'BAD_FIELD_RECORD' ELSE {NATION_SQL} END AS nation_code,
  '0' AS orders_held FROM customer"""

PERSON_COLUMNS = ("ACCT_KEY", "HOLDER_NAME", "SEGMENT", "NATION_CODE", "ORDERS_HELD")


@query(CUT_SQL)
def null_bad_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.cut_customers(spark, sf_dir))
    text = d.decode_text(records, lay.ACCOUNT)
    return text.select(*(F.col(c).alias(c.lower()) for c in PERSON_COLUMNS))


@query(
    """SELECT c_custkey AS acct_key, CASE WHEN c_nationkey % 3 = 2
    THEN 'HOLDER.NATION_CODE,HOLDER.SEGMENT,BOOK.PLACED'
    ELSE '' END AS bad FROM customer"""
)
def bad_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed mode names the fields it could not decode."""
    records = read_vb(spark, fx.cut_customers(spark, sf_dir))
    typed = d.decode_typed(records, lay.ACCOUNT)
    return typed.select(big("ACCT_KEY", "acct_key"), F.array_join("_bad_fields", ",").alias("bad"))


@query(
    f"""SELECT acct_key || chr(9) || holder_name || chr(9) || segment || chr(9) || nation_code || chr(9)
    || orders_held || chr(9) AS value FROM ({CUT_SQL})"""
)
def render_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.cut_customers(spark, sf_dir))
    return tables.to_tsv(d.decode_text(records, lay.ACCOUNT), columns=PERSON_COLUMNS)


@query(
    """SELECT s_suppkey AS vendor_no, lower(printf('%08x', s_suppkey)) AS vendor_no_hex,
    CASE WHEN s_acctbal > 0 THEN 'e8' ELSE 'd5' END AS credit_hex, CAST(96 AS BIGINT) AS hex_digits FROM supplier"""
)
def hex_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_fb(spark, fx.suppliers(spark, sf_dir), lay.SUPPLIER.max_length)
    reader = d.FieldReader(lay.SUPPLIER)

    def raw(name: str) -> str:
        return codec.to_hex(reader.raw(lay.SUPPLIER.find(name)))

    return records.selectExpr(
        f"{reader.value(lay.SUPPLIER.find('VENDOR-NO'))} AS vendor_no",
        f"{raw('VENDOR-NO')} AS vendor_no_hex",
        f"{raw('IN-CREDIT')} AS credit_hex",
        f"cast(length({codec.to_hex('rec')}) AS bigint) AS hex_digits",
    )


@query(
    """SELECT '10' AS kind_code, c_custkey AS cust_key, c_name AS cust_name, c_acctbal AS cust_balance FROM customer"""
)
def merged_layout_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header layout and a body layout make one record layout."""
    header = lay.Layout.parse(lay.IDENT_TEXT)
    whole = header + lay.Layout.parse(lay.MIXED_BODIES["customer"])
    records = rules.include(read_vb(spark, fx.mixed(spark, sf_dir)), whole, "KIND-CODE=10")
    return d.decode_flat(records, whole).select(
        F.col("KIND_CODE").alias("kind_code"),
        big("CUST_KEY", "cust_key"),
        F.rtrim("CUST_NAME").alias("cust_name"),
        num("CUST_BALANCE", "cust_balance"),
    )


# --- filters and routing --------------------------------------------------------------


def _kept_customers(records: DataFrame) -> DataFrame:
    return d.decode_flat(records, lay.ACCOUNT).select(
        big("ACCT_KEY", "acct_key"),
        F.rtrim("SEGMENT").alias("segment"),
        big("ORDERS_HELD", "orders_held"),
    )


KEPT_SQL = CUSTOMER_SQL + (
    "SELECT c_custkey AS acct_key, c_mktsegment AS segment, CAST(n AS BIGINT) AS orders_held FROM records WHERE "
)


@query(KEPT_SQL + "n IN (2, 3, 6)")
def include_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.customers(spark, sf_dir))
    return _kept_customers(
        rules.include(records, lay.ACCOUNT, "ORDERS-HELD=2:ORDERS-HELD=3:ORDERS-HELD=6")
    )


@query(KEPT_SQL + "NOT (n = 6 OR (n = 1 AND c_mktsegment = 'BUILDING'))")
def exclude_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.customers(spark, sf_dir))
    spec = "ORDERS-HELD=6:ORDERS-HELD=1,SEGMENT=building"
    return _kept_customers(rules.exclude(records, lay.ACCOUNT, spec))


@query(KEPT_SQL + "c_mktsegment IN ('BUILDING', 'MACHINERY') AND NOT n = 6")
def include_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.customers(spark, sf_dir))
    return _kept_customers(
        rules.select_records(
            records,
            lay.ACCOUNT,
            include="SEGMENT=BUILDING:SEGMENT=MACHINERY",
            exclude="ORDERS-HELD=6",
        )
    )


@query(KEPT_SQL + "n = 6 AND c_mktsegment = 'BUILDING'")
def include_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.customers(spark, sf_dir))
    spec = "ORDERS-HELD=6,SEGMENT=BUILDING"
    return _kept_customers(rules.include(records, lay.ACCOUNT, spec, strict=True))


@query(KEPT_SQL + "n = 3")
def record_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.customers(spark, sf_dir))
    return _kept_customers(rules.record_length(records, 56 + 3 * 45))


@query(
    LINES_SQL
    + """SELECT o_orderkey AS order_key, CAST(block AS BIGINT) AS block_no, o_orderstatus AS status,
    CAST(40 + sum(stride) AS BIGINT) AS rec_len FROM lines WHERE o_orderstatus <> 'P' GROUP BY ALL
    UNION ALL SELECT o_orderkey, 0, o_orderstatus, 40 FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
)
def skip_record_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.composite(spark, sf_dir))
    kept = rules.skip_records(records, lay.HEADER, "HOLD-FLAG", "A7")
    return _headers(kept)


def _headers(records: DataFrame) -> DataFrame:
    return d.decode_flat(records, lay.HEADER, keep=("rec_len",)).select(
        big("ORDER_KEY", "order_key"), big("BLOCK_NO", "block_no"), F.col("ORDER_STATUS").alias("status"), big("rec_len")
    )


@query(
    LINES_SQL
    + """SELECT o_orderkey AS order_key, CAST(block AS BIGINT) AS block_no, o_orderstatus AS status,
    CAST(40 + sum(stride) AS BIGINT) AS rec_len FROM lines GROUP BY ALL"""
)
def header_only_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _headers(rules.drop_header_only(read_vb(spark, fx.composite(spark, sf_dir)), lay.HEADER_LEN))


@query(
    """SELECT 'customer' AS rec_type, 'customer' AS rec_variant, count(*) AS records FROM customer
    UNION ALL SELECT 'order', CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END, count(*) FROM orders GROUP BY 2
    UNION ALL SELECT 'part', 'part', count(*) FROM part"""
)
def route_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = r.route(read_vb(spark, fx.mixed(spark, sf_dir)), lay.mixed_catalog(excludes=False))
    return routed.groupBy("rec_type", "rec_variant").agg(F.count("*").alias("records"))


ROUTED_SQL = """SELECT 'customer' AS rec_type, c_custkey AS key, c_name AS label, c_acctbal AS amount FROM customer
  UNION ALL SELECT 'order', o_orderkey, o_orderpriority, o_totalprice FROM orders{orders}
  UNION ALL SELECT 'part', p_partkey, p_brand, p_size FROM part{parts}"""


@query(
    """SELECT 'part' AS rec_type, p_brand || ' ' || p_size AS rec_variant, count(*) AS records FROM part GROUP BY p_brand, p_size
    UNION ALL SELECT 'order', CASE WHEN o_orderpriority = '5-LOW' THEN 'low' ELSE 'order' END, count(*) FROM orders GROUP BY ALL
    UNION ALL SELECT 'customer', 'customer', count(*) FROM customer"""
)
def route_many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog with a rule for each brand and size, looked up by hash; the first rule that holds wins."""
    base = lay.mixed_catalog(excludes=False)
    brands = [f"Brand#{n}" for n in range(1, 61)]
    each = tuple((f"{brand} {size}", (("PART-SIZE", str(size)), ("PART-BRAND", brand))) for size in range(1, 61) for brand in brands)
    low = ("low", (("KIND-CODE", "20"), ("ORDER-PRIORITY", "5-LOW")))
    customer, order, part = base.types
    repeated = tuple((f"again {v}", rule) for v, rule in each)  # never the first
    types = (customer, r.RecordType("order", order.layout, (low, ("order", (("KIND-CODE", "20"),)))), r.RecordType("part", part.layout, each + repeated))
    routed = r.route(read_vb(spark, fx.mixed(spark, sf_dir), chunk_bytes=CHUNK), r.Catalog(types))
    return routed.groupBy("rec_type", "rec_variant").agg(F.count("*").alias("records"))


SHAPES = {
    "customer": ("CUST_KEY", "CUST_NAME", "CUST_BALANCE"),
    "order": ("ORDER_KEY", "ORDER_PRIORITY", "ORDER_PRICE"),
    "part": ("PART_KEY", "PART_BRAND", "PART_SIZE"),
}


def _one_table(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, (key, label, amount) in SHAPES.items():
        shaped = parts[name].select(
            F.lit(name).alias("rec_type"), big(key, "key"), F.rtrim(label).alias("label"), num(amount, "amount")
        )
        out = shaped if out is None else out.unionByName(shaped)
    return out


@query(ROUTED_SQL.format(orders="", parts=""))
def route_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All types from one scan."""
    catalog = lay.mixed_catalog(excludes=False)
    routed = r.route(read_vb(spark, fx.mixed(spark, sf_dir), chunk_bytes=CHUNK), catalog)
    both = r.decode_routed(routed, catalog, "flat")
    return both.select(
        "rec_type",
        F.coalesce(*(big(f"{t}.{key}") for t, (key, _, _) in SHAPES.items())).alias("key"),
        F.coalesce(*(F.rtrim(f"{t}.{label}") for t, (_, label, _) in SHAPES.items())).alias("label"),
        F.coalesce(*(F.col(f"{t}.{amount}").cast("double") for t, (_, _, amount) in SHAPES.items())).alias("amount"),
    )


@query(ROUTED_SQL.format(orders=" WHERE o_orderpriority <> '5-LOW'", parts=" WHERE p_brand <> 'Brand#13'"))
def route_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = lay.mixed_catalog()
    routed = r.route(read_vb(spark, fx.mixed(spark, sf_dir)), catalog)
    return _one_table(r.decode_types(routed, catalog, "flat"))


@query("SELECT '40' AS ident, s_suppkey AS key FROM supplier")
def route_unrouted(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = r.unrouted(read_vb(spark, fx.mixed(spark, sf_dir)), lay.mixed_catalog(excludes=False))
    with java_charsets(spark):
        return left.select(
            codec.decode("substring(rec, 1, 2)", "text", 2).alias("ident"),
            codec.decode("substring(rec, 3, 12)", "zoned", 12).cast("bigint").alias("key"),
        )


# --- segments -------------------------------------------------------------------------


def _lines(segments: DataFrame, *more: str) -> DataFrame:
    layout = lay.HEADER + lay.PREFIX + lay.LINE
    decoded = d.decode_flat(segments, layout, keep=more)
    return decoded.select(
        *(big(c) for c in more),
        big("ORDER_KEY", "order_key"),
        big("LINE_NO", "line_no"),
        big("PART_KEY", "part_key"),
        big("SUPP_KEY", "supp_key"),
        num("QUANTITY", "quantity"),
        num("PRICE", "price"),
    )


@query(LINES_SQL + f"SELECT {LINE_FIELDS_SQL}, CAST(40 + stride - 1 AS BIGINT) AS rec_len FROM lines")
def split_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.composite(spark, sf_dir), chunk_bytes=CHUNK)
    return _lines(s.split_segments(records, lay.HEADER_LEN, lay.PREFIX, "LINE-BYTES"), "rec_len")


@query(LINES_SQL + f"SELECT {LINE_FIELDS_SQL} FROM lines")
def split_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length in the segment leaves out the four bytes of its prefix."""
    records = read_vb(spark, fx.composite(spark, sf_dir, offset=fx.OFFSET))
    return _lines(
        s.split_segments(records, lay.HEADER_LEN, lay.PREFIX, "LINE-BYTES", length_offset=fx.OFFSET)
    )


@query(LINES_SQL + f"SELECT {LINE_FIELDS_SQL}, CAST(pos + 1 AS BIGINT) AS seg_no FROM lines")
def split_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.composite(spark, sf_dir))
    return _lines(s.split_segments(records, lay.HEADER_LEN, lay.PREFIX, "LINE-BYTES"), "seg_no")


MARKED = {"length_offset": fx.OFFSET, "skip_marker": fx.MARKER}


@query(LINES_SQL + f"SELECT {LINE_FIELDS_SQL}, CAST(pos + 1 AS BIGINT) AS seg_no FROM lines")
def split_skip_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines hold their length behind a marker."""
    records = read_vb(spark, fx.composite(spark, sf_dir, offset=fx.OFFSET, marked=True))
    return _lines(s.split_segments(records, lay.HEADER_LEN, lay.PREFIX, "LINE-BYTES", **MARKED), "seg_no")


@query(
    LINES_SQL
    + """SELECT o_orderkey AS order_key, CAST(block AS BIGINT) AS block_no, CAST(40 + sum(stride) + 1 AS BIGINT) AS error_at,
    CASE o_orderpriority WHEN '5-LOW' THEN 'segment longer than its record'
      WHEN '4-NOT SPECIFIED' THEN 'zero segment length without marker' ELSE 'segment prefix cut off' END AS error
    FROM lines WHERE o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED', '3-MEDIUM')
    GROUP BY o_orderkey, block, o_orderpriority
    UNION ALL SELECT o_orderkey, 0, 41, 'no segment behind the header' FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
)
def split_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_vb(spark, fx.composite(spark, sf_dir, offset=fx.OFFSET, marked=True, broken=True))
    rejects = s.split_rejects(records, lay.HEADER_LEN, lay.PREFIX, "LINE-BYTES", **MARKED)
    back = rejects.select(F.unhex("rec_hex").alias("rec"), "rec_len", "error", "error_at")
    return d.decode_flat(back, lay.HEADER, keep=("error", "error_at")).select(
        big("ORDER_KEY", "order_key"), big("BLOCK_NO", "block_no"), big("error_at"), "error"
    )


@query(LINES_SQL + f"SELECT {LINE_FIELDS_SQL} FROM lines")
def split_before_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments in front of a bad one are kept."""
    records = read_vb(spark, fx.composite(spark, sf_dir, offset=fx.OFFSET, marked=True, broken=True))
    return _lines(s.split_segments(records, lay.HEADER_LEN, lay.PREFIX, "LINE-BYTES", **MARKED))


# --- sinks ----------------------------------------------------------------------------

LOADED = dt.date(2016, 4, 5)

PERSON_SQL = CUSTOMER_SQL + (
    f"SELECT c_custkey AS acct_key, c_name AS holder_name, {NATION_SQL} AS nation_code{{extra}} FROM records"
)


def _people(spark: SparkSession, sf_dir: str, mode: str = "flat") -> DataFrame:
    records = read_vb(spark, fx.customers(spark, sf_dir))
    decoded = d.decode(records, lay.ACCOUNT, mode, keep=())
    return decoded.select(
        F.col("ACCT_KEY").cast("bigint" if mode == "flat" else "string").alias("acct_key"),
        F.rtrim("HOLDER_NAME").alias("holder_name"),
        F.col("NATION_CODE").alias("nation_code"),
    )


@query(
    CUSTOMER_SQL
    + f"SELECT c_custkey || chr(9) || c_name || chr(9) || {NATION_SQL} || chr(9) AS value FROM records"
)
def sink_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tables.write(_people(spark, sf_dir, "text"), scratch_path(spark, "tsv"))
    return spark.read.text(out)


def _written(spark: SparkSession, sf_dir: str, fmt: str, **options) -> DataFrame:
    out = tables.write(_people(spark, sf_dir), scratch_path(spark, fmt), fmt, **options)
    return spark.read.format(fmt).load(out)


@query(PERSON_SQL.format(extra=""))
def sink_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "orc")


@query(PERSON_SQL.format(extra=""))
def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "parquet")


@query(PERSON_SQL.format(extra=", 'north' AS region, 'a1' AS batch"))
def sink_partition_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "parquet", partition="region=north,batch=a1").select(
        "acct_key", "holder_name", "nation_code", "region", "batch"
    )


@query(PERSON_SQL.format(extra=', 2016 AS "LOAD_YEAR", 4 AS "LOAD_MONTH", 5 AS "LOAD_DAY"'))
def sink_partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "orc", load_date="day", on=LOADED)


@query(PERSON_SQL.format(extra=", load") + " CROSS JOIN (VALUES (1), (2)) AS loads(load)")
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load adds a partition to the root that is there."""
    out = scratch_path(spark, "append")
    for load in ("1", "2"):
        tables.write(_people(spark, sf_dir), out, "parquet", partition={"load": load})
    return spark.read.parquet(out)


@query(
    """SELECT 'customer' AS rec_type, '10' || chr(9) || c_custkey || chr(9) || c_name || chr(9)
      || CAST(c_acctbal AS DECIMAL(11,2)) || chr(9) AS value FROM customer
    UNION ALL SELECT 'order', '20' || chr(9) || o_orderkey || chr(9) || o_orderstatus || chr(9)
      || CAST(o_totalprice AS DECIMAL(11,2)) || chr(9) || o_orderpriority || chr(9)
      FROM orders WHERE o_orderpriority <> '5-LOW'
    UNION ALL SELECT 'part', '30' || chr(9) || p_partkey || chr(9) || p_brand || chr(9) || p_size || chr(9)
      FROM part WHERE p_brand <> 'Brand#13'"""
)
def sink_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text, one folder per record type, in one pass."""
    catalog = lay.mixed_catalog()
    out = scratch_path(spark, "by_type")
    tables.write_by_type(r.route(read_vb(spark, fx.mixed(spark, sf_dir)), catalog), catalog, out)
    return spark.read.text(out).select("rec_type", "value")


@query(ROUTED_SQL.format(orders=" WHERE o_orderpriority <> '5-LOW'", parts=" WHERE p_brand <> 'Brand#13'"))
def sink_by_type_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, one parquet table per record type."""
    catalog = lay.mixed_catalog()
    out = scratch_path(spark, "by_type")
    routed = r.route(read_vb(spark, fx.mixed(spark, sf_dir)), catalog)
    folders = tables.write_by_type(routed, catalog, out, "parquet", mode="flat")
    return _one_table({name: tables.read_type(spark, folder, name) for name, folder in folders.items()})


@query(
    """SELECT 'customer' AS rec_type, c_custkey AS key, 'KIND_CODE,CUST_KEY,CUST_NAME,CUST_BALANCE,_bad_fields' AS columns, CAST(NULL AS VARCHAR) AS rank FROM customer
    UNION ALL SELECT 'order', o_orderkey, 'KIND_CODE,ORDER_KEY,ORDER_STATUS,ORDER_PRICE,ORDER_PRIORITY,PRIORITY_PARTS,ORDER_END,_bad_fields',
      substr(o_orderpriority, 1, 1) FROM orders
    UNION ALL SELECT 'part', p_partkey, 'KIND_CODE,PART_KEY,PART_BRAND,PART_SIZE,_bad_fields', NULL FROM part"""
)
def sink_by_type_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested columns, one ORC table per record type with that type's columns only."""
    catalog = lay.mixed_catalog(excludes=False, overlay=True)
    routed = r.route(read_vb(spark, fx.mixed(spark, sf_dir), chunk_bytes=CHUNK), catalog)
    folders = tables.write_by_type(routed, catalog, scratch_path(spark, "by_type"), "orc", mode="typed")
    out = None
    for name, (key, _, _) in SHAPES.items():
        table = tables.read_type(spark, folders[name], name, "orc")
        rank = F.col("PRIORITY_PARTS.PRIORITY_RANK") if name == "order" else F.lit(None).cast("string")
        shaped = table.select(F.lit(name).alias("rec_type"), big(key, "key"), F.lit(",".join(table.columns)).alias("columns"), rank.alias("rank"))
        out = shaped if out is None else out.unionByName(shaped)
    return out


@query(
    """SELECT CAST(l_orderkey AS VARCHAR) AS order_ref, CAST(l_linenumber AS BIGINT) AS line_pos, l_extendedprice AS net_price, TRUE AS blocked FROM lineitem"""
)
def sink_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records packed into blocks with descriptors, read again as blocks; read as records, they are blocks."""
    out = scratch_path(spark, "blocks")
    records = read_fb(spark, fx.sales(spark, sf_dir), lay.SALES.max_length, chunk_bytes=CHUNK)
    write_vb(records, out, block=4096)
    fewer = read_vb(spark, out).count() * 40 < read_vb(spark, out, bdw=True).count() + 4000
    back = d.decode_flat(read_vb(spark, out, bdw=True, chunk_bytes=CHUNK), lay.SALES)
    return back.select(F.rtrim("ORDER_REF").alias("order_ref"), big("LINE_POS", "line_pos"), num("NET_PRICE", "net_price"), F.lit(fewer).alias("blocked"))


@query(LINES_SQL + f"SELECT {LINE_FIELDS_SQL} FROM lines WHERE o_orderstatus <> 'P'")
def sink_vb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole split job: segments written as variable-length files and read again."""
    out = scratch_path(spark, "segments")
    jobs.split(
        spark,
        fx.composite(spark, sf_dir, offset=fx.OFFSET, marked=True),
        out,
        header_layout=lay.HEADER,
        header_len=lay.HEADER_LEN,
        segment_layout=lay.PREFIX,
        length_field="LINE-BYTES",
        length_offset=fx.OFFSET,
        skip_marker=fx.MARKER,
        skip_field="HOLD-FLAG",
        skip_hex="a7",
    )
    return _lines(read_vb(spark, out))


@query(
    CUSTOMER_SQL
    + f"""SELECT CAST(c_custkey AS VARCHAR) AS acct_key, c_name AS holder_name, {NATION_SQL} AS nation_code,
    CAST(n AS VARCHAR) AS orders_held, '2016' AS load_year FROM records WHERE n IN (2, 3, 6)"""
)
def register_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole convert job into a partitioned text table, read by name."""
    out = scratch_path(spark, "table")
    include = "ORDERS-HELD=2:ORDERS-HELD=3:ORDERS-HELD=6"
    app = "app_" + out.rsplit("-", 1)[-1]
    jobs.convert(
        spark,
        fx.customers(spark, sf_dir),
        out,
        layout=lay.ACCOUNT,
        include=include,
        load_date="year",
        on=LOADED,
        app=app,
        table="customers",
        register=True,
    )
    return spark.table(tables.table_name(app, "customers")).select(
        F.col("ACCT_KEY").alias("acct_key"),
        F.col("HOLDER_NAME").alias("holder_name"),
        F.col("NATION_CODE").alias("nation_code"),
        F.col("ORDERS_HELD").alias("orders_held"),
        F.col("LOAD_YEAR").alias("load_year"),
    )


# --- whole catalog jobs, read through the tables they register -----------------------


def _catalog_tables(spark: SparkSession, paths: str, fmt: str = "tsv", *, overlay: bool = False, **options) -> dict[str, DataFrame]:
    """Convert a mixed file by catalog and open its tables by name."""
    out = scratch_path(spark, "catalog")
    app = "own_" + out.rsplit("-", 1)[-1]
    catalog = lay.mixed_catalog(excludes=False, tables=app, overlay=overlay)
    jobs.convert(spark, paths, out, catalog=catalog, fmt=fmt, register=True, chunk_bytes=CHUNK, **options)
    return {t.name: spark.table(t.table) for t in catalog.types}


@query(
    """SELECT 'customer' AS rec_type, CAST(c_custkey AS VARCHAR) AS key, c_name AS label,
      replace(CAST(CAST(c_acctbal AS DECIMAL(11,2)) AS VARCHAR), '.', ',') AS amount FROM customer
    UNION ALL SELECT 'order', CAST(o_orderkey AS VARCHAR), o_orderpriority,
      replace(CAST(CAST(o_totalprice AS DECIMAL(11,2)) AS VARCHAR), '.', ',') FROM orders
    UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), p_brand, CAST(p_size AS VARCHAR) FROM part"""
)
def catalog_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comma dialect reaches the text tables of a catalog."""
    parts = _catalog_tables(spark, fx.mixed(spark, sf_dir), filetype="MFDVB")
    out = None
    for name, (key, label, amount) in SHAPES.items():
        shaped = parts[name].select(F.lit(name).alias("rec_type"), F.col(key).alias("key"), F.col(label).alias("label"), F.col(amount).alias("amount"))
        out = shaped if out is None else out.unionByName(shaped)
    return out


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS priority, 'BAD_FIELD_RECORD' AS order_end,
    'KIND_CODE,ORDER_KEY,ORDER_STATUS,ORDER_PRICE,ORDER_PRIORITY,ORDER_END' AS columns FROM orders"""
)
def catalog_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without overlays, the field behind one is found in the data and in the table alike."""
    orders = _catalog_tables(spark, fx.mixed(spark, sf_dir), overlay=True, split="redefine")["order"]
    return orders.select(
        F.col("ORDER_KEY").alias("key"),
        F.col("ORDER_PRIORITY").alias("priority"),
        F.col("ORDER_END").alias("order_end"),
        F.lit(",".join(orders.columns)).alias("columns"),
    )


@query(ROUTED_SQL.format(orders="", parts=""))
def catalog_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of different lengths in a file of one record length, typed."""
    return _one_table(_catalog_tables(spark, fx.mixed(spark, sf_dir, fixed=True), "parquet", filetype="MFFB", record_len=fx.MIXED_LENGTH))


@query(
    LINES_SQL
    + """SELECT o_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line_no, NULL AS error FROM lines
    UNION ALL SELECT o_orderkey, NULL, CASE o_orderpriority WHEN '5-LOW' THEN 'segment longer than its record'
      WHEN '4-NOT SPECIFIED' THEN 'zero segment length without marker' ELSE 'segment prefix cut off' END
    FROM (SELECT DISTINCT o_orderkey, block, o_orderpriority FROM lines WHERE o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED', '3-MEDIUM'))
    UNION ALL SELECT o_orderkey, NULL, 'no segment behind the header' FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
)
def split_job_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments and rejects of the split job account for every record."""
    out, rejects = scratch_path(spark, "segments"), scratch_path(spark, "rejects")
    jobs.split(
        spark,
        fx.composite(spark, sf_dir, offset=fx.OFFSET, marked=True, broken=True),
        out,
        header_layout=lay.HEADER,
        header_len=lay.HEADER_LEN,
        segment_layout=lay.PREFIX,
        length_field="LINE-BYTES",
        rejects=rejects,
        on_corrupt="reject",
        chunk_bytes=CHUNK,
        **MARKED,
    )
    lines = d.decode_flat(read_vb(spark, out), lay.HEADER + lay.PREFIX + lay.LINE, keep=())
    bad = spark.read.parquet(rejects).select(F.unhex("rec_hex").alias("rec"), "rec_len", "error")
    return lines.select(big("ORDER_KEY", "order_key"), big("LINE_NO", "line_no"), F.lit(None).cast("string").alias("error")).unionByName(
        d.decode_flat(bad, lay.HEADER, keep=("error",)).select(big("ORDER_KEY", "order_key"), F.lit(None).cast("bigint").alias("line_no"), "error")
    )


# --- names and unset numbers ------------------------------------------------------------


@query(
    """SELECT form, s_name AS name, '<>' AS name_2, CAST(s_suppkey AS VARCHAR) AS number, CAST(s_nationkey - 12 AS VARCHAR) AS name_3
    FROM supplier CROSS JOIN (VALUES ('text'), ('flat'), ('table')) AS forms(form)"""
)
def column_names_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names used twice, and names of scan columns, in text, typed and table form."""
    records = read_fb(spark, fx.suppliers(spark, sf_dir), lay.REPEATED.max_length)
    out = scratch_path(spark, "repeated")
    app = "own_" + out.rsplit("-", 1)[-1]
    jobs.convert(spark, fx.suppliers(spark, sf_dir), out, layout=lay.REPEATED, filetype="MFFB", app=app, table="repeated", register=True)
    forms = {
        "text": (d.decode_text(records, lay.REPEATED), "FILE_2"),
        "flat": (d.decode_flat(records, lay.REPEATED), "FILE_2"),
        "table": (spark.table(f"{app}_repeated"), "FILE"),
    }
    found = None
    for form, (df, number) in forms.items():
        one = df.select(F.lit(form).alias("form"), F.rtrim("NAME").alias("name"), F.col("NAME_2").alias("name_2"), F.col(number).cast("string").alias("number"), F.col("NAME_3").cast("string").alias("name_3"))
        found = one if found is None else found.unionByName(one)
    return found


@query(
    """SELECT l_orderkey AS order_key,
    CASE l_linenumber % 4 WHEN 2 THEN CAST(l_linenumber AS VARCHAR) WHEN 3 THEN 'BAD_FIELD_RECORD' ELSE 'NULL' END AS line_pos,
    CASE WHEN l_linenumber % 4 < 2 THEN 'NULL' ELSE CAST(-l_linenumber AS VARCHAR) END AS line_signed,
    CASE WHEN l_linenumber % 4 = 3 THEN 'LINE_POS' ELSE '' END AS bad FROM lineitem"""
)
def zoned_unset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank and low-value numbers are empty, not zero; a blank behind a digit is bad."""
    records = read_vb(spark, fx.unset(spark, sf_dir), chunk_bytes=CHUNK)
    typed = d.decode_typed(records, lay.UNSET, keep=("rec_len", "rec"))
    checked = typed.select("rec_len", "rec", F.array_join("_bad_fields", ",").alias("bad"))
    both = d.decode_text(checked, lay.UNSET, keep=("bad",))  # of the same row, so there is nothing to join
    return both.select(big("ORDER_KEY", "order_key"), F.col("LINE_POS").alias("line_pos"), F.col("LINE_SIGNED").alias("line_signed"), "bad")


# --- flagship -------------------------------------------------------------------------


@query(
    CUSTOMER_SQL
    + """SELECT c_custkey AS acct_key, c_name AS holder_name, CAST(n AS BIGINT) AS orders_held, pos,
    o_orderkey AS order_key, o_totalprice AS amount
    FROM sized JOIN customer ON c_custkey = o_custkey WHERE n IN (2, 3, 6)"""
)
def convert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan, keep records by transaction count, decode typed, one row per transaction."""
    records = read_vb(spark, fx.customers(spark, sf_dir))
    kept = rules.include(records, lay.ACCOUNT, "ORDERS-HELD=2:ORDERS-HELD=3:ORDERS-HELD=6")
    typed = d.decode_typed(kept, lay.ACCOUNT)
    each = typed.select(
        "ACCT_KEY",
        "HOLDER.HOLDER_NAME",
        "ORDERS_HELD",
        F.posexplode("BOOK.PLACED").alias("pos", "t"),
    )
    return each.select(
        big("ACCT_KEY", "acct_key"),
        F.rtrim("HOLDER_NAME").alias("holder_name"),
        big("ORDERS_HELD", "orders_held"),
        big("pos"),
        big("t.ORDER_KEY", "order_key"),
        num("t.PRICE", "amount"),
    )
