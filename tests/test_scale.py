"""What keeps queries from growing faster than their tables, on rows made here."""

import datetime as dt

import pytest

from mainspool.plans import queries
from mainspool.sources.variable import read_vb
from mainspool.testsupport import encode
from mainspool.testsupport import fixtures as fx

LINES = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
DAY = dt.datetime(1996, 1, 2)


@pytest.fixture
def tables(spark, tmp_path):
    """Four orders, one without lines and one with 250, the same line twice."""
    lines = [(1, 5000, 3, 1, 2.0, 10.5, 0.0, 0.02, "R", "F", DAY)] * 2
    lines += [(2, n * 97 % 9000, 1, n % 7 + 1, 1.0, 5.25, 0.01, 0.0, "N", "O", DAY) for n in range(250)]
    lines += [(3, 7, 1, n, 1.0, 5.25, 0.01, 0.0, "N", "O", DAY) for n in (1, 2, 3)]
    orders = [(k, 1, "O", 99.5, DAY, "1-URGENT") for k in (1, 2, 3, 4)]
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, ORDERS).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_unset_numbers_need_no_join(spark, tables):
    """The text and the checks of a record are made from the same row."""
    found = queries.zoned_unset(spark, tables)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 255
    third = sorted((r["line_pos"], r["line_signed"], r["bad"]) for r in found.filter("order_key = 3").collect())
    assert third == [("2", "-2", ""), ("BAD_FIELD_RECORD", "-3", "LINE_POS"), ("NULL", "NULL", "")]


@pytest.mark.parametrize("made", ["composite", "baskets"])
def test_inputs_rank_lines_once_in_fine_shuffles(spark, tables, monkeypatch, made):
    seen = {}
    write = fx.write_vb

    def spy(df, path, **options):
        seen["plan"] = df._jdf.queryExecution().optimizedPlan().toString()
        seen["size"] = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
        return write(df, path, **options)

    monkeypatch.setattr(fx, "write_vb", spy)
    path = getattr(fx, made)(spark, tables)
    assert seen["size"] == "16m"
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) is None
    assert "LeftAnti" not in seen["plan"] and "array_join" not in seen["plan"]
    sizes = sorted(r["rec_len"] for r in read_vb(spark, path).collect())
    if made == "composite":  # header only, two long lines, three lines, and 250 lines in three records
        assert sizes == [40, 40 + 2 * 56, 40 + 3 * 46, 40 + 50 * 46, 40 + 100 * 46, 40 + 100 * 46]
    else:  # 1 + 63 + 1 + 1 baskets of up to four lines, three a record
        assert len(sizes) == 22


def test_baskets_sort_lines_once(spark, tables, tmp_path, monkeypatch):
    """A key's rows are ranked and joined to runs in the order of one sort; keys of many rows give the same records."""
    lines = [(5, None, 3, 1, 2.0, 1.5, 0.0, 0.0, "R", "F", DAY)] * 3 + [(None, 1, 3, 1, 2.0, 1.5, 0.0, 0.0, "R", "F", DAY), (5, 9, 3, None, 2.0, 1.5, 0.0, 0.0, "R", "F", DAY), (5, 9, 3, 2, 2.0, 1.5, 0.0, 0.0, "R", "F", DAY)]
    orders = [(5, 2, "F", 1.0, DAY, "x"), (None, 2, "F", 1.0, DAY, "x"), (None, 2, "F", 1.0, DAY, "x"), (6, None, "F", 1.0, DAY, "x"), (70_000, 2, "F", 1.0, DAY, "x")]
    folder = tmp_path / "more"
    for name, rows, ddl in (("lineitem", lines, LINES), ("orders", orders, ORDERS)):
        spark.read.parquet(f"{tables}/{name}.parquet").unionByName(spark.createDataFrame(rows, ddl)).write.parquet(f"{folder}/{name}.parquet")
    seen = []
    write = fx.write_vb

    def spy(df, path, **options):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, path, **options)

    monkeypatch.setattr(fx, "write_vb", spy)

    def made():
        monkeypatch.setattr(fx, "_written", {})
        return sorted(r["rec"].hex() for r in read_vb(spark, fx.baskets(spark, str(folder))).collect())

    few = made()
    assert "Join" not in seen[0] and "collect_list" not in seen[0]
    monkeypatch.setattr(encode, "MANY", 0)
    assert made() == few
    assert "Join" in seen[1]
    monkeypatch.setattr(encode, "MANY", 100)  # the order of 250 lines only, and no customer
    assert made() == few
    # 66 baskets, three a record; what has no salt is left out but keeps its rank, so that order 5 and customer 2 have two runs
    assert len(few) == 22 + 2 and sum(r.startswith("f0" * 11 + "f2") for r in few) == 2
