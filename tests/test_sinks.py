"""Sinks: files, partitions, types, tables and whole jobs."""

import datetime as dt
import glob
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mainspool.layout import Layout
from mainspool.operators import decode as d
from mainspool.operators import route as r
from mainspool.plans import jobs
from mainspool.sinks import tables
from mainspool.sinks.vb import write_vb
from mainspool.sources.files import list_files
from mainspool.sources.variable import read_vb

AB = Layout.parse("          05 A-KEY PIC X(2).\n          05 B PIC 9(2).\n          05 FILLER PIC X(1).\n")
DAY = dt.date(2016, 4, 5)


def ebcdic(*texts):
    return [t.encode("cp037").hex() for t in texts]


@pytest.fixture
def two(records):
    return records(*ebcdic("a 01x", "b 02 "))


def lines(path):
    return sorted(line for f in glob.glob(f"{path}/**/part-*", recursive=True) for line in open(f).read().splitlines())


def test_tsv(two, tmp_path):
    out = f"{tmp_path}/out"
    tables.write_tsv(two, AB, out)
    assert lines(out) == ["a\t1\tx\t", "b\t2\tNULL\t"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_tsv(two, AB, out)
    tables.write_tsv(two, AB, f"{tmp_path}/bare", trailing_tab=False)
    assert lines(f"{tmp_path}/bare") == ["a\t1\tx", "b\t2\tNULL"]


def test_partitions(two, tmp_path):
    out = f"{tmp_path}/out"
    decoded = d.decode_text(two, AB, keep=())
    tables.write(decoded, out, partition="SITE=n,LOT=7", load_date="month", on=DAY)
    assert os.path.isdir(f"{out}/SITE=n/LOT=7/LOAD_YEAR=2016/LOAD_MONTH=04")
    # a partitioned root may be added to
    tables.write(decoded, out, partition="SITE=m,LOT=7", load_date="month", on=DAY)
    assert len(lines(out)) == 4
    bare = f"{tmp_path}/bare"
    assert tables.write(decoded, bare, load_date="day", on=DAY, bare_partition=True) == f"{bare}/2016/04/05"
    assert len(lines(f"{bare}/2016/04/05")) == 2
    assert tables.partition_values(None, "year", DAY) == {"LOAD_YEAR": "2016"}


@pytest.mark.parametrize("fmt", ["orc", "parquet"])
def test_typed_formats(spark, two, tmp_path, fmt):
    out = f"{tmp_path}/out"
    tables.write(d.decode_flat(two, AB, keep=()), out, fmt)
    assert sorted(tuple(x) for x in spark.read.format(fmt).load(out).collect()) == [("a ", 1, "x"), ("b ", 2, " ")]


CATALOG = {
    "header_layout": "h",
    "records": [
        {"record": f"t{i}", "copy_layout": f"l{i}", "include_records": [{"name": f"t{i}", "entries": {"H": f"{i}"}}]}
        for i in (1, 2, 3)
    ],
}
LAYOUTS = {
    "h": "          05 H PIC X.\n",
    "l1": "          05 X PIC X(2).\n",
    "l2": "          05 N PIC 9(2).\n          05 M PIC X.\n",
    "l3": "          05 Z PIC X.\n",
}


@pytest.fixture
def mixed(records):
    return records(*ebcdic("1ab", "207c", "3z", "1q ", "9no"))


def test_by_type(spark, mixed, tmp_path):
    catalog = r.Catalog.from_json(CATALOG, LAYOUTS)
    folders = tables.write_by_type(r.route(mixed, catalog), catalog, f"{tmp_path}/tsv")
    assert {t: lines(f) for t, f in folders.items()} == {
        "t1": ["1\tab\t", "1\tq\t"],
        "t2": ["2\t7\tc\t"],
        "t3": ["3\tz\t"],
    }
    folders = tables.write_by_type(r.route(mixed, catalog), catalog, f"{tmp_path}/pq", "parquet")
    assert sorted(tuple(x) for x in tables.read_type(spark, folders["t2"], "t2").drop("_bad_fields").collect()) == [("2", 7, "c")]
    dated = r.Catalog.from_json({**CATALOG, "appendCurrentDate": True}, LAYOUTS)
    folders = tables.write_by_type(r.route(mixed, dated), dated, f"{tmp_path}/bare", on=DAY, bare_partition=True)
    assert folders["t1"] == f"{tmp_path}/bare/2016/04/05/rec_type=t1"
    assert lines(folders["t1"]) == ["1\tab\t", "1\tq\t"]


def test_by_type_to_so_many_files(spark, mixed, tmp_path):
    catalog = r.Catalog.from_json(CATALOG, LAYOUTS)
    routed = r.route(mixed.repartition(5), catalog)
    folders = tables.write_by_type(routed, catalog, f"{tmp_path}/few", tasks_per_type=1)
    assert all(len(glob.glob(f"{f}/part-*")) == 1 for f in folders.values())
    assert lines(folders["t1"]) == ["1\tab\t", "1\tq\t"]


def test_all_types_come_from_one_scan(spark, mixed):
    catalog = r.Catalog.from_json(CATALOG, LAYOUTS)
    for mode in ("text", "flat", "typed"):
        frame = r.decode_routed(r.route(mixed, catalog), catalog, mode, keep=("rec_no",))
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
        got = {x["rec_no"]: (x["rec_type"], [n for n in ("t1", "t2", "t3") if x[n] is not None]) for x in frame.collect()}
        assert got == {1: ("t1", ["t1"]), 2: ("t2", ["t2"]), 3: ("t3", ["t3"]), 4: ("t1", ["t1"])}
    assert [tuple(x["t2"])[:3] for x in frame.collect() if x["t2"]] == [("2", 7, "c")]


def _many_types(n):
    spec = {
        "header_layout": "h",
        "records": [
            {"record": f"k{i}", "copy_layout": f"l{i}", "include_records": [{"name": f"k{i}", "entries": {"H": f"{i:02d}"}}]}
            for i in range(n)
        ],
    }
    layouts = {"h": "          05 H PIC X(2).\n"}
    layouts |= {f"l{i}": f"          05 N{i} PIC 9(3).\n          05 G{i}.\n             10 T{i} PIC X(2) OCCURS 2.\n" for i in range(n)}
    return r.Catalog.from_json(spec, layouts)


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_thirty_types_have_thirty_schemas_from_one_scan(spark, records, tmp_path, fmt):
    catalog = _many_types(30)
    rows = records(*ebcdic(*(f"{i % 29:02d}{i:03d}ab{i % 10}z" for i in range(200)))).repartition(3)
    routed = r.route(rows, catalog)
    plan = r.decode_routed(routed, catalog, "typed")._jdf.queryExecution().analyzed().toString()
    assert plan.count("LogicalRDD") == 1
    # rules take three projections, decoding three and one for names, however many types there are
    assert plan.count("Project [") <= 12
    folders = tables.write_by_type(routed, catalog, f"{tmp_path}/out", fmt, keep=("rec_no",), partition="S=1")
    got = []
    for i in range(30):
        table = tables.read_type(spark, folders[f"k{i}"], f"k{i}", fmt)
        assert table.columns == ["rec_no", "H", f"N{i}", f"G{i}", "_bad_fields", "S"]
        got += [(x["rec_no"], x["H"], int(x[f"N{i}"]), x[f"G{i}"][f"T{i}"], x["S"]) for x in table.collect()]
    assert sorted(got) == [(i + 1, f"{i % 29:02d}", i, ["ab", f"{i % 10}z"], 1) for i in range(200)]
    with pytest.raises(FileExistsError):
        tables.write_by_type(routed, catalog, f"{tmp_path}/out", fmt)
    tables.write_by_type(routed, catalog, f"{tmp_path}/out", fmt, keep=("rec_no",), partition="S=2")
    assert {x["S"] for x in tables.read_type(spark, folders["k3"], "k3", fmt).select("S").distinct().collect()} == {1, 2}


def test_small_row_groups_and_names_that_clash(spark, records, tmp_path, monkeypatch):
    from mainspool.sinks import typed

    monkeypatch.setattr(typed, "ROW_GROUP", 1)
    monkeypatch.setattr(typed, "HELD", 0)
    layouts = {"h": "          05 REC-TYPE PIC X.\n", "l1": "          05 REC-NO PIC X(2).\n", "l2": "          05 SITE PIC 9(2).\n", "l3": "          05 Z PIC X.\n"}
    spec = {**CATALOG, "records": [{**t, "include_records": [{"name": "n", "entries": {"REC-TYPE": f"{i + 1}"}}]} for i, t in enumerate(CATALOG["records"])]}
    catalog = r.Catalog.from_json(spec, layouts)
    routed = r.route(records(*ebcdic("1ab", "207c", "1cd")), catalog)
    folders = tables.write_by_type(routed, catalog, f"{tmp_path}/out", "parquet", mode="flat", keep=("rec_no",), partition={"SITE": "x"})
    first = tables.read_type(spark, folders["t1"], "t1")
    assert first.columns == ["rec_no", "REC_TYPE_2", "REC_NO_2", "SITE"]
    assert sorted(tuple(x) for x in first.collect()) == [(1, "1", "ab", "x"), (3, "1", "cd", "x")]
    assert [tuple(x) for x in tables.read_type(spark, folders["t2"], "t2").collect()] == [(2, "2", 7, "x")]
    assert tables.read_type(spark, folders["t3"], "t3").count() == 0


def test_a_failing_task_leaves_no_typed_files(spark, mixed, tmp_path):
    catalog = r.Catalog.from_json(CATALOG, LAYOUTS)
    routed = r.route(mixed, catalog).withColumn("rec", F.when(F.col("rec_no") < 4, F.col("rec")).otherwise(F.raise_error(F.lit("torn")).cast("binary")))
    with pytest.raises(Exception, match="torn"):
        tables.write_by_type(routed, catalog, f"{tmp_path}/out", "parquet")
    assert not glob.glob(f"{tmp_path}/out/**/*.parquet", recursive=True) and not glob.glob(f"{tmp_path}/out/_*")


def test_write_vb(spark, mixed, tmp_path):
    out = f"{tmp_path}/vb"
    frame = mixed.coalesce(1).withColumn("file", mixed.file).selectExpr("concat('/in/it''s ', rec_no % 2) file", "rec_no", "rec")
    write_vb(frame.orderBy("file", "rec_no"), out)
    assert sorted(x for x in os.listdir(out) if not x.startswith((".", "_manifest-"))) == ["_SUCCESS", "its 0", "its 1"]
    back = read_vb(spark, out)
    assert sorted(bytes(x["rec"]) for x in back.collect()) == sorted(bytes(x["rec"]) for x in mixed.collect())
    with pytest.raises(FileExistsError):
        write_vb(frame, out)


def test_write_vb_refuses_two_inputs_of_one_name(mixed, tmp_path):
    frame = mixed.selectExpr("concat('/in', rec_no % 2, '/a.vb') file", "rec_no", "rec")
    with pytest.raises(ValueError, match="both be written to a.vb"):
        write_vb(frame, f"{tmp_path}/out dir")
    assert not glob.glob(f"{tmp_path}/out dir/**/*.vb", recursive=True)
    write_vb(frame.filter("rec_no % 2 = 1"), f"{tmp_path}/out dir")
    assert len(glob.glob(f"{tmp_path}/out dir/a.vb/*.vb")) >= 1


def test_a_failing_commit_takes_back_all_parts(mixed, tmp_path, monkeypatch):
    from mainspool.sinks import vb

    def broken(self, files):
        raise OSError("disk gone")

    monkeypatch.setattr(vb._RecordWriter, "check", broken)
    frame = mixed.selectExpr("concat('/in/', rec_no) file", "rec_no", "rec")
    with pytest.raises(Exception, match="disk gone"):
        write_vb(frame, f"{tmp_path}/out")
    assert not glob.glob(f"{tmp_path}/out/**/*.vb", recursive=True)
    assert not glob.glob(f"{tmp_path}/out/_*")


def _record_batches(*runs):
    return [pa.record_batch({"file": [f"/in/{name}"] * len(records), "rec_no": list(range(len(records))), "rec": [b"r" * n for n in records]}) for name, records in runs]


@pytest.fixture
def attempt(tmp_path, monkeypatch):
    """Write batches as an attempt of a task; gives its commit message."""
    from types import SimpleNamespace

    from mainspool.sinks import vb

    schema = T.StructType.fromDDL("file string, rec_no bigint, rec binary")
    writer = vb._RecordWriter({"path": f"{tmp_path}/out", "write_id": "w1", "descriptors": "true", "block": "0"}, schema)

    def run(task, number, batches):
        context = SimpleNamespace(partitionId=lambda: task, taskAttemptId=lambda: number)
        monkeypatch.setattr("pyspark.TaskContext.get", staticmethod(lambda: context))
        return writer.write(iter(batches))

    run.writer = writer
    return run


def test_failed_killed_and_repeated_attempts_leave_one_copy(spark, tmp_path, attempt):
    def failing():
        yield from _record_batches(("a", [3, 4]), ("b", [5]))
        raise OSError("gone")

    with pytest.raises(OSError, match="gone"):
        attempt(0, 1, failing())
    assert not glob.glob(f"{tmp_path}/out/*/*.vb")
    attempt(0, 2, _record_batches(("a", [3, 4])))  # killed behind its first file: no message
    whole = _record_batches(("a", [3, 4]), ("b", [5]))
    attempt(0, 3, whole)  # a second copy of the task, whose message is not taken
    messages = [attempt(0, 4, whole), attempt(1, 5, _record_batches(("b", [7, 9]))), None]
    assert len(glob.glob(f"{tmp_path}/out/*/*.vb")) == 6
    # readers that follow the manifest see what was committed even with strays about
    attempt.writer.commit(messages)
    assert len(glob.glob(f"{tmp_path}/out/*/*.vb")) == 3
    attempt(1, 6, _record_batches(("b", [7, 9])))  # a late one
    assert sorted(x["rec_len"] for x in read_vb(spark, f"{tmp_path}/out").collect()) == [3, 4, 5, 7, 9]
    assert list_files(spark, f"{tmp_path}/out").count() == 3
    rows = list_files(spark, [f"{tmp_path}/out", f"{tmp_path}/out/b"]).collect()
    assert len(rows) == 3 + 3 and all(r["length"] == os.path.getsize(r["path"].removeprefix("file:")) and r["modificationTime"] for r in rows)


def test_an_aborted_write_leaves_nothing(tmp_path, attempt):
    message = attempt(0, 1, _record_batches(("a", [3])))
    attempt(0, 2, _record_batches(("a", [3])))
    attempt.writer.abort([message, None])
    assert not glob.glob(f"{tmp_path}/out/*/*") and not glob.glob(f"{tmp_path}/out/_*")


@pytest.mark.parametrize("block, sizes", [(8, [0, 0, 0]), (30, [1, 22, 0, 9, 9, 22, 3, 4, 5, 6, 7]), (65535, [40_000, 30_000, 20_000, 65_527, 1]), (100, [])])
def test_blocks_hold_whole_records(spark, records, tmp_path, block, sizes, monkeypatch):
    from mainspool.sinks import vb

    monkeypatch.setattr(vb, "BLOCKED", 64)
    frame = records(*("40" * n for n in sizes)) if sizes else records("40").limit(0)
    write_vb(frame.coalesce(1), f"{tmp_path}/out", block=block)
    back = read_vb(spark, f"{tmp_path}/out", bdw=True).orderBy("rec_no").collect()
    assert [(x["rec_no"], x["rec_len"]) for x in back] == [(i + 1, n) for i, n in enumerate(sizes)]
    blocks = [x["rec_len"] + 4 for x in read_vb(spark, f"{tmp_path}/out").collect()]
    want, left = [], 0
    for n in sizes:  # first fit in order
        if left < n + 4:
            want.append(4)
            left = block - 4
        want[-1] += n + 4
        left -= n + 4
    assert sorted(blocks) == sorted(want)


def test_blocks_must_fit(records, tmp_path):
    with pytest.raises(Exception, match="does not fit a block of 20"):
        write_vb(records("40" * 13), f"{tmp_path}/out", block=20)
    for wrong in ({"block": 7}, {"block": 70_000}, {"block": 100, "descriptors": False}):
        with pytest.raises(ValueError, match="a block holds"):
            write_vb(records("40"), f"{tmp_path}/other", **wrong)


def test_a_cluster_must_name_the_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from mainspool.session import shared_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session)


def test_write_vb_rejects_long_records(records, tmp_path):
    with pytest.raises(Exception, match="does not fit"):
        write_vb(records("40" * 65532), f"{tmp_path}/long")


def test_table_names():
    assert tables.table_name("app", "t") == "app_t"
    assert tables.table_name("app", include="A.B=1,C=2:D=3") == "app_AB1C2D3"


def test_convert_job(spark, two, tmp_path):
    write_vb(two, f"{tmp_path}/in")
    out = jobs.convert(
        spark,
        f"{tmp_path}/in",
        f"{tmp_path}/out",
        layout=AB,
        include="A-KEY=a:A-KEY=b",
        partition="SITE=n",
        app="job",
        table="two",
        register=True,
    )
    assert out == {"job_two": f"{tmp_path}/out"}
    table = spark.table("job_two")
    assert table.columns == ["A_KEY", "B", "FILLER_1", "SITE"]
    assert sorted(tuple(x) for x in table.collect()) == [("a", "1", "x", "n"), ("b", "2", "NULL", "n")]
    # schema only: no input is read
    jobs.convert(spark, "/nowhere", f"{tmp_path}/later", layout=AB, fmt="parquet", app="job", table="later", schema_only=True)
    assert [f.dataType.simpleString() for f in spark.table("job_later").schema] == ["string", "decimal(2,0)", "string"]


def test_convert_catalog_job(spark, mixed, tmp_path):
    write_vb(mixed, f"{tmp_path}/in")
    catalog = r.Catalog.from_json(CATALOG, LAYOUTS)
    for fmt in ("tsv", "orc"):
        jobs.convert(spark, f"{tmp_path}/in", f"{tmp_path}/{fmt}", catalog=catalog, fmt=fmt, app=f"cat_{fmt}", register=True)
    assert sorted(tuple(x) for x in spark.table("cat_tsv_t1").collect()) == [("1", "ab"), ("1", "q")]
    assert [tuple(x) for x in spark.table("cat_orc_t2").collect()] == [("2", 7, "c")]


UNEQUAL = {
    "records": [
        {"record": "short", "copy_layout": "s", "hive_table": "own_short", "include_records": [{"name": "s", "entries": {"H": "1"}}]},
        {"record": "long", "copy_layout": "l", "include_records": [{"name": "l", "entries": {"H": "2"}}]},
    ],
}
SIGNED = {
    "s": "          05 H PIC X.\n          05 N PIC S9(3)V99.\n          05 D PIC X(2).\n          05 E REDEFINES D PIC 9(2).\n          05 Z PIC X(1).\n",
    "l": "          05 H PIC X.\n          05 N PIC S9(3)V99.\n          05 T PIC X(4).\n",
}


@pytest.mark.parametrize("fmt", ["tsv", "parquet", "orc"])
def test_catalog_options_reach_data_and_table(spark, records, tmp_path, fmt):
    catalog = r.Catalog.from_json(UNEQUAL, SIGNED)
    write_vb(records("f1f0f0f1f5d0c1c2a9", "f2f0f0f1f5d0c1c2c3c4"), f"{tmp_path}/in")
    app, own = f"opt_{fmt}", f"own_short_{fmt}"
    catalog = r.Catalog((r.RecordType("short", catalog.types[0].layout, catalog.types[0].include, (), own), catalog.types[1]))
    jobs.convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", catalog=catalog, filetype="MFDVB", fmt=fmt, split="redefine", app=app, register=True)
    short = spark.table(own)
    assert short.columns == ["H", "N", "D", "Z"]
    assert [str(v) for v in short.first()] == ["1", "-1,50" if fmt == "tsv" else "-1.50", "AB", "z"]
    assert [str(v) for v in spark.table(f"{app}_long").first()] == ["2", "-1,50" if fmt == "tsv" else "-1.50", "ABCD"]


def test_fixed_length_catalog(spark, records, tmp_path):
    catalog = r.Catalog.from_json(UNEQUAL, SIGNED)
    data = bytes.fromhex("f1f0f0f1f5f0c1c2a940" + "f2f0f0f1f5f0c1c2c3c4")
    (tmp_path / "in.fb").write_bytes(data)
    with pytest.raises(Exception, match="record_len"):
        jobs.convert(spark, f"{tmp_path}/in.fb", f"{tmp_path}/no", catalog=catalog, filetype="MFFB")
    out = jobs.convert(spark, f"{tmp_path}/in.fb", f"{tmp_path}/out", catalog=catalog, filetype="MFFB", record_len=10)
    assert lines(out["short"]) == ["1\t1.50\tAB\t12\tz\t"]
    assert lines(out["long"]) == ["2\t1.50\tABCD\t"]


@pytest.mark.parametrize("mix", [{"include": "H=9"}, {"exclude": "H=9"}, {"strict": True}, {"table": "t"}])
def test_a_catalog_refuses_rules_of_the_job(spark, tmp_path, mix):
    catalog = r.Catalog.from_json(UNEQUAL, SIGNED)
    with pytest.raises(ValueError, match="catalog"):
        jobs.convert(spark, "/nowhere", f"{tmp_path}/out", catalog=catalog, **mix)


@pytest.mark.parametrize("fmt", ["tsv", "parquet"])
def test_catalog_schema_only(spark, tmp_path, fmt):
    catalog = r.Catalog.from_json(CATALOG, LAYOUTS)
    jobs.convert(spark, "/nowhere", f"{tmp_path}/later", catalog=catalog, fmt=fmt, app=f"later_{fmt}", schema_only=True)
    assert spark.table(f"later_{fmt}_t2").columns == ["H", "N", "M"]
    assert spark.table(f"later_{fmt}_t2").count() == 0


def test_corrupt_files_in_jobs(spark, records, tmp_path):
    write_vb(records(*ebcdic("a 01x", "b 02 ")), f"{tmp_path}/in/good")
    (tmp_path / "in/bad.vb").write_bytes(b"\x00\x09\x00\x00" + "c 03y".encode("cp037") + b"\0\0\0\0")
    with pytest.raises(Exception, match="bad record descriptor"):
        jobs.convert(spark, f"{tmp_path}/in", f"{tmp_path}/fails", layout=AB)
    jobs.convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", layout=AB, on_corrupt="reject", rejects=f"{tmp_path}/rejects", chunk_bytes=4)
    assert lines(f"{tmp_path}/out") == ["a\t1\tx\t", "b\t2\tNULL\t", "c\t3\ty\t"]
    assert [(x["rec_no"], x["error"]) for x in spark.read.parquet(f"{tmp_path}/rejects").collect()] == [(2, "bad record descriptor at byte 9")]


def test_split_job_accounts_for_every_record(spark, tmp_path):
    prefix = Layout.parse("          05 ID PIC X(2).\n          05 LEN PIC 9(4) COMP.\n")
    good = b"H" + b"AB\x00\x07xyz" * 2
    data = [good, b"H", b"H" + b"AB\x00\x07xyz" + b"AB\x7f\xff"]
    framed = b"".join((len(x) + 4).to_bytes(2, "big") + b"\0\0" + x for x in data)
    (tmp_path / "in.vb").write_bytes(framed + b"\0\1\0\0")
    header = Layout.parse("          05 K PIC X.\n")
    jobs.split(spark, f"{tmp_path}/in.vb", f"{tmp_path}/out", header_layout=header, header_len=1, segment_layout=prefix,
               length_field="LEN", on_corrupt="reject", rejects=f"{tmp_path}/rejects", skip_field="K", skip_hex="00")
    assert sorted(bytes(x["rec"]) for x in read_vb(spark, f"{tmp_path}/out").collect()) == [b"HAB\x00\x07xy"] * 3
    rejects = spark.read.parquet(f"{tmp_path}/rejects").collect()
    assert sorted((x["rec_no"], x["error"], x["error_at"]) for x in rejects) == [
        (2, "no segment behind the header", 2),
        (3, "segment longer than its record", 9),
        (4, f"bad record descriptor at byte {len(framed)}", None),
    ]


def test_bare_partition_job(spark, two, tmp_path):
    write_vb(two, f"{tmp_path}/in")
    jobs.convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", layout=AB, partition="SITE=n", bare_partition=True, app="bare", table="two", register=True)
    assert len(lines(f"{tmp_path}/out/n")) == 2
    assert sorted(tuple(x) for x in spark.table("bare_two").collect()) == [("a", "1", "x", "n"), ("b", "2", "NULL", "n")]


def test_comma_dialect_job(spark, records, tmp_path):
    layout = Layout.parse("          05 N PIC S9(3)V99.\n")
    write_vb(records("f0f0f1f5d0"), f"{tmp_path}/in")
    jobs.convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", layout=layout, filetype="MFDVB")
    assert lines(f"{tmp_path}/out") == ["-1,50\t"]
