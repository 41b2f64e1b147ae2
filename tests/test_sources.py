"""Scans: any cut of a file into ranges gives the same records."""

import os
import random

import pytest

from mainspool.sources import framing
from mainspool.sources.files import TASK_BYTES, TASKS_A_CORE, list_files, split_paths, tasks_for
from mainspool.sources.fixed import read_fb, spread
from mainspool.sources.variable import keep_index, read_vb, tagged_vb, vb_ranges, vb_rejects


def framed(records):
    return b"".join((len(r) + 4).to_bytes(2, "big") + b"\0\0" + r for r in records)


def rows(df):
    return sorted((r["rec_no"], r["rec_len"], bytes(r["rec"])) for r in df.collect())


def expected(records):
    return [(i + 1, len(r), r) for i, r in enumerate(records)]


def random_records(seed, n, longest):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        size = rng.randrange(longest)
        # many zero bytes and embedded descriptors, to look like record starts
        kind = rng.randrange(3)
        if kind == 0:
            out.append(rng.randbytes(size))
        elif kind == 1:
            out.append(bytes(size))
        else:
            out.append((b"\x00\x08\x00\x00" * size)[:size])
    return out


@pytest.mark.parametrize("chunk", [64, 1000, 1 << 20])
def test_variable_split_invariance(spark, record_file, chunk):
    records = random_records(1, 700, 90)
    path = record_file(framed(records))
    assert rows(read_vb(spark, path, chunk_bytes=chunk)) == expected(records)


def test_records_longer_than_chunks(spark, record_file):
    records = random_records(2, 12, 5000) + [bytes(65531)] + random_records(3, 5, 100)
    path = record_file(framed(records))
    assert rows(read_vb(spark, path, chunk_bytes=500)) == expected(records)


def _set_time(path, seconds):
    os.utime(path, (seconds, seconds))


@pytest.mark.parametrize("chunk", [700, 1 << 20])
def test_an_index_by_any_name_reads_what_is_there(spark, record_file, tmp_path, chunk):
    """Old, grown, replaced, shortened, touched, removed and new files, and a path the index does not know."""
    made = {name: random_records(20 + i, 60, 80) for i, name in enumerate(["old", "grown", "replaced", "grown and other", "short", "touched", "gone", "torn"])}
    for name, records in made.items():
        _set_time(record_file(framed(records), f"in/{name}"), 1000)
    root, kept = f"{tmp_path}/in", f"{tmp_path}/index"
    first = keep_index(spark, root, kept, chunk_bytes=chunk)
    same = keep_index(spark, root, kept, chunk_bytes=chunk)
    assert sorted(os.listdir(kept)) == ["v=00000001"] and rows_of(first) == rows_of(same)
    more = random_records(30, 40, 90)
    _set_time(record_file(framed(made["grown"] + more), "in/grown"), 2000)
    _set_time(record_file(framed(made["replaced"][::-1]), "in/replaced"), 2000)  # same length, other time
    _set_time(record_file(framed(made["grown and other"][::-1] + more), "in/grown and other"), 2000)
    _set_time(record_file(framed(made["short"][:30]), "in/short"), 2000)
    _set_time(f"{root}/touched", 3000)
    os.remove(f"{root}/gone")
    _set_time(record_file(framed(made["torn"]) + b"\0\x50\0\0half", "in/torn"), 2000)
    record_file(framed(random_records(31, 50, 90)), "in/new")
    record_file(framed(random_records(32, 50, 90)), "elsewhere/other")
    for paths, indexes in (([root, f"{tmp_path}/elsewhere"], (first, first.drop("mark"), first.limit(0))), (f"{root}/grown", (first,))):
        fresh = rows_of(tagged_vb(spark, paths))
        for index in indexes:
            assert rows_of(tagged_vb(spark, paths, chunk_bytes=chunk, index=index)) == fresh
    second = keep_index(spark, root, kept, chunk_bytes=chunk)
    assert sorted(os.listdir(kept)) == ["v=00000001", "v=00000002"]
    assert rows_of(read_vb(spark, root, on_corrupt="reject", index=second, checked=True)) == rows_of(read_vb(spark, root, on_corrupt="reject"))
    grown = sorted((r["start"], r["end"]) for r in second.collect() if r["file"].endswith("/grown"))
    assert grown[0][0] == 0 and grown[-1][1] == os.path.getsize(f"{root}/grown") and all(a[1] <= b[0] + 94 for a, b in zip(grown, grown[1:]))


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_only_new_and_grown_parts_are_scanned(spark, record_file, tmp_path, monkeypatch):
    from mainspool.sources import variable

    records = random_records(40, 200, 80)
    _set_time(record_file(framed(records), "in/a"), 1000)
    index = keep_index(spark, f"{tmp_path}/in", f"{tmp_path}/index", chunk_bytes=500).cache()
    scanned = []
    whole = variable._ranges
    monkeypatch.setattr(variable, "_ranges", lambda spark, files, *a: scanned.extend((r["file"].rsplit("/", 1)[1], r["base"], r["n0"]) for r in files.collect()) or whole(spark, files, *a))
    read_vb(spark, f"{tmp_path}/in", index=index, chunk_bytes=500).count()
    assert scanned == []
    _set_time(record_file(framed(records + records), "in/a"), 2000)
    record_file(framed(records), "in/b")
    read_vb(spark, f"{tmp_path}/in", index=index, chunk_bytes=500).count()
    last = max(index.collect(), key=lambda r: r["start"])
    assert sorted(scanned) == [("a", last["start"], last["first_rec_no"] - 1), ("b", 0, 0)]


def test_an_index_of_blocks(spark, record_file, tmp_path):
    def blocks(records):
        return b"".join((len(b) + 4).to_bytes(2, "big") + b"\0\0" + b for b in (framed(records[i : i + 5]) for i in range(0, len(records), 5)))

    _set_time(record_file(blocks(random_records(50, 60, 80)), "in/a"), 1000)
    record_file(blocks(random_records(51, 60, 80)), "in/b")
    index = keep_index(spark, f"{tmp_path}/in", f"{tmp_path}/index", chunk_bytes=600, bdw=True)
    record_file(blocks(random_records(50, 60, 80) + random_records(52, 9, 80)), "in/a")
    got = read_vb(spark, f"{tmp_path}/in", index=index, chunk_bytes=600, bdw=True)
    assert rows_of(got) == rows_of(read_vb(spark, f"{tmp_path}/in", bdw=True))


def test_a_file_of_many_chunks(spark, record_file):
    """More than 4,096 ranges in one file, full of what looks like record starts."""
    records = [b"\x00\x08\x00\x00" * 4, b"\x00\x08\x00\x00" * 9 + b"x"] * 3000
    path = record_file(framed(records))
    ranges = vb_ranges(spark, path, chunk_bytes=40)
    assert ranges.count() > 4096
    assert rows(read_vb(spark, path, index=ranges)) == expected(records)


def test_small_chunks_share_tasks(spark, record_file, monkeypatch):
    """The number of tasks does not grow with the number of chunks, in no step of a scan."""
    blocks = [framed([b"abcdef"] * 4)] * 2000
    path = record_file(framed(blocks))
    monkeypatch.setattr("mainspool.sources.fixed.FEW_RANGES", 100)
    dealt = []
    for module in ("fixed", "variable"):
        counted = lambda ranges, by, tasks: dealt.append(tasks) or spread(ranges, by, tasks)
        monkeypatch.setattr(f"mainspool.sources.{module}.spread", counted)
    found = read_vb(spark, path, chunk_bytes=100, bdw=True)
    assert rows(found) == expected([b"abcdef"] * 8000)
    assert len(dealt) == 3 and max(dealt) <= TASKS_A_CORE * spark.sparkContext.defaultParallelism
    assert tasks_for(spark, 1 << 40, 1 << 18) == (1 << 40) // TASK_BYTES and tasks_for(spark, 100, 64 << 20) == 1


def test_records_of_few_ranges_are_not_taken_for_few(spark, record_file):
    """Ranges are a few bytes, their records are not: a join of two scans is not planned as a broadcast."""
    path = record_file(framed([b"ab", b"c"]))
    left, right = (read_vb(spark, path).select("rec_no", "rec") for _ in range(2))
    assert "Broadcast" not in left.join(right, "rec_no")._jdf.queryExecution().executedPlan().toString()


def test_one_scan_gives_records_and_rejects(spark, record_file):
    path = record_file(framed([b"ab", b"c"]) + b"\0\0\0\0")
    found = tagged_vb(spark, path, chunk_bytes=8).collect()
    assert sorted((r["rec_no"], r["rec"], r["error"]) for r in found) == [(1, b"ab", None), (2, b"c", None), (3, None, "bad record descriptor at byte 11")]


@pytest.mark.parametrize("chunk", [50, 1000, 1 << 20])
def test_blocks_with_descriptors(spark, record_file, chunk):
    rng = random.Random(14)
    records = random_records(13, 300, 40)
    blocks, at = [], 0
    while at < len(records):
        n = rng.randrange(0, 9)
        blocks.append(framed(records[at : at + n]))
        at += n
    path = record_file(framed(blocks))
    assert rows(read_vb(spark, path, chunk_bytes=chunk, bdw=True)) == expected(records)
    broken = record_file(framed([*blocks, framed([b"last"]) + b"\0\1\0\0"]) + framed([framed([b"unseen"])]), "broken.vb")
    kept = read_vb(spark, broken, chunk_bytes=chunk, bdw=True, on_corrupt="reject")
    assert rows(kept) == expected([*records, b"last"])
    where = len(framed(blocks)) + 4 + 8
    assert [(r["rec_no"], r["error"]) for r in vb_rejects(spark, broken, chunk_bytes=chunk, bdw=True).collect()] == [
        (302, f"bad record descriptor in a block at byte {where}")
    ]


def test_paths_with_odd_characters(spark, record_file):
    path = record_file(framed([b"ab"]), "a b%20c/d#e?f+.vb")
    assert rows(read_vb(spark, path.rsplit("/", 1)[0])) == [(1, 2, b"ab")]
    system, inner = framing.filesystem("file:///x y/%41#z")
    assert inner == "/x y/%41#z"


def test_several_files_and_numbers(spark, record_file):
    a, b = random_records(5, 300, 50), random_records(6, 20, 50)
    pa, pb = record_file(framed(a), "x/a.vb"), record_file(framed(b), "y/b b.vb")
    df = read_vb(spark, f"{pa}, {pb}", chunk_bytes=1000)
    for name, want in (("a.vb", a), ("b b.vb", b)):
        assert rows(df.filter(df.file.endswith(name))) == expected(want)
    manifest = {r["path"].rsplit("/", 1)[-1]: r["length"] for r in list_files(spark, [pa, pb]).collect()}
    assert manifest == {"a.vb": len(framed(a)), "b b.vb": len(framed(b))}
    assert split_paths(["a,b", "c"]) == ["a", "b", "c"]


def test_empty_file(spark, record_file):
    path = record_file(b"")
    assert read_vb(spark, path).count() == 0
    assert read_fb(spark, path, 5).count() == 0


CORRUPT = [
    (b"\x00\x03\x00\x00abc", "bad record descriptor"),
    (b"\x00\x08\x01\x00abcd" + framed([b"later"]), "bad record descriptor"),
    (b"\x00\x50\x00\x00abc", "record cut off by the end of the file"),
    (b"\x00\x08", "record cut off by the end of the file"),
]


@pytest.mark.parametrize("chunk", [64, 1 << 20])
@pytest.mark.parametrize("tail, reason", CORRUPT)
def test_corrupt_file(spark, record_file, tail, reason, chunk):
    good = random_records(7, 60, 40)
    start = len(framed(good))
    path = record_file(framed(good) + tail)
    assert rows(read_vb(spark, path, on_corrupt="reject", chunk_bytes=chunk)) == expected(good)
    rejects = vb_rejects(spark, path, chunk_bytes=chunk).collect()
    assert [(r["rec_no"], r["error"]) for r in rejects] == [(61, f"{reason} at byte {start}")]
    with pytest.raises(Exception, match=reason):
        read_vb(spark, path, chunk_bytes=chunk).collect()


@pytest.mark.parametrize("chunk", [7, 64, 1 << 20])
def test_fixed(spark, record_file, chunk):
    data = random.Random(8).randbytes(27 * 101 + 5)
    want = [data[i : i + 27] for i in range(0, len(data), 27)]
    path = record_file(data)
    assert rows(read_fb(spark, path, 27, chunk_bytes=chunk)) == expected(want)


@pytest.mark.parametrize("chunk", [70_000, 333_333, 1 << 20])
@pytest.mark.parametrize("longest", [65_531, 300])
def test_ranges_of_several_blocks(record_file, monkeypatch, chunk, longest):
    """Ranges larger than a block, without Spark: chains, true entries and records."""
    monkeypatch.setattr(framing, "BLOCK", 66_000)
    records = random_records(9, 60 if longest > 1000 else 6000, longest)
    data = framed(records)
    path = record_file(data)
    chains = [framing.chunk_chains(path, i, chunk, len(data)) for i in range(-(-len(data) // chunk))]
    ranges, got, pos, number = [], [], 0, 1
    while pos < len(data):  # hop on from the start
        row = chains[pos // chunk].to_pylist()[0]
        ranges.append({"start": pos, "end": min((pos // chunk + 1) * chunk, len(data)), "length": len(data), "first_rec_no": number})
        i = row["entries"].index(pos)
        pos, number = row["exits"][i], number + row["records"][i]
    for r in ranges:
        batches = framing.variable_records(path, r["start"], r["end"], r["length"], r["first_rec_no"])
        got += [(x["rec_no"], x["rec_len"], x["rec"]) for b in batches for x in b.to_pylist()]
    assert got == expected(records)
    starts = {0}
    for rec in records:
        starts.add(max(starts) + len(rec) + 4)
    assert {r["start"] for r in ranges} <= starts


def test_false_starts_do_not_pile_up(record_file):
    """Of the positions that look like a start only those are kept whose chain leaves the
    chunk; a false chain may do so by running into the true one."""
    rng = random.Random(10)
    records = [bytes(rng.choice((0, 0, 0, rng.randrange(16))) for _ in range(48)) for _ in range(3000)]
    data = framed(records)
    chains = framing.chunk_chains(record_file(data), 1, 60_000, len(data)).to_pylist()[0]
    true = {52 * i for i in range(3001)}
    here = range(60_000, 120_000)
    alike = [p for p in here if data[p : p + 2] >= b"\0\4" and data[p + 2 : p + 4] == b"\0\0"]
    assert true & set(here) <= set(chains["entries"]) <= set(alike)
    assert len(chains["entries"]) < len(alike) / 4
    for entry, exit_, count in zip(chains["entries"], chains["exits"], chains["records"]):
        if entry in true:
            assert exit_ == 120_016 and count == (exit_ - entry) // 52
