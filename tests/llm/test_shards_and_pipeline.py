"""Sharding, training order and the pipeline."""

import base64
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken

import corpus_pipeline
from mainspool.llm import decontaminate, ordinal, sharding, simhash, training_order
from mainspool.llm.queries import PATTERN, QUERIES, RANKS, grades


def _brute_shards(rows, n):
    """(key, size) in order to shard and slot."""
    total, before, out, count = sum(s for _, s in rows), 0, [], {}
    for key, size in rows:
        shard = min(n - 1, (2 * before + size) * n // (2 * total))
        out.append((key, size, shard, count.get(shard, 0)))
        count[shard] = count.get(shard, 0) + 1
        before += size
    return out


def test_shards_like_brute_force(spark):
    rng = random.Random(3)
    texts = ["é" * rng.randint(0, 300) for _ in range(500)] + [None, "", "big " * 2000]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(7, "again", "x")] * 300 + [(None, "no id", "x")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    got = sharding.shard(sharding.sizes(df).select("doc_id", "size", "text_crc32", "shard"), 8, ties=["text_crc32"]).collect()
    sizes = sorted((i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    want = _brute_shards([((i if known else None, c), s) for known, i, s, c in sizes], 8)
    mine = sorted(((r.doc_id, r.text_crc32), r.size, r.shard, r.slot) for r in got if r.doc_id is not None)
    assert mine == sorted(x for x in want if x[0][0] is not None)
    assert sorted(r.position for r in got) == list(range(len(rows)))


def test_shards_of_nothing_and_of_one_large_row(spark):
    df = spark.createDataFrame([(1, 10_000), (2, 1), (3, 1)], "doc_id long, size long")
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.shard(df, 4).collect()}
    assert got == {1: (1, 0), 2: (3, 0), 3: (3, 1)} or got == {1: (2, 0), 2: (3, 0), 3: (3, 1)}
    assert sharding.shard(df.limit(0), 4).count() == 0


def test_written_shards_read_back(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    sharded = sharding.shard(sharding.sizes(df), 5)
    sharding.write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.shard, r.slot) for r in back.collect()) == sorted((r.doc_id, r.shard, r.slot) for r in sharded.collect())


# training order


@pytest.mark.parametrize("domain", [1, 2, 3, 5, 64, 1000, 4097])
def test_feistel_is_a_permutation(domain):
    out = training_order.feistel(np.arange(domain, dtype=np.uint64), domain, 9)
    assert sorted(out.tolist()) == list(range(domain))
    if domain >= 1000:
        assert (out != training_order.feistel(np.arange(domain, dtype=np.uint64), domain, 10)).mean() > 0.9
        assert np.corrcoef(np.arange(domain), out.astype(float))[0, 1] < 0.1


def test_large_domains_stay_inside():
    domain = 13 << training_order.ROW_BITS
    out = training_order.feistel(np.arange(1000, dtype=np.uint64) << np.uint64(33), domain, 1)
    assert len(set(out.tolist())) == 1000 and int(out.max()) < domain


def test_training_order_round_trip(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "δ"]) for _ in range(rng.randint(0, 400)))) for i in range(300)]
    rows += [(900, None), (901, ""), (5, rows[5][1]), (902, "long " * 30_000), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    vocabulary = training_order.load(RANKS)
    path, length = str(tmp_path / "order"), 64
    got = training_order.write_order(df, path, vocabulary, PATTERN, key=4, length=length, shard_bytes=4096).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    firsts = {}
    for r in got:
        firsts[r.shard] = min(firsts.get(r.shard, r.slot), r.slot)
        assert r.byte_offset == (r.slot - min(q.slot for q in got if q.shard == r.shard)) * 2 * length
        with open(f"{path}/shard-{r.shard:08d}.bin", "rb") as f:
            f.seek(r.byte_offset)
            assert zlib.crc32(f.read(2 * length)) == r.crc32
    read = {r.slot: r.ids for r in training_order.read_order(spark, path, firsts, length=length).collect()}
    assert sorted(read) == list(range(len(got)))
    middle = len(got) // 2
    assert sorted(r.slot for r in training_order.read_order(spark, path, firsts, middle, length).collect()) == list(range(middle, len(got)))
    # undo the permutation by brute force: sequences in order are the partitions' texts in order
    parts = df.rdd.glom().collect()
    numbers = []
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for p, part in enumerate(parts):
        ids = [x for r in part if r.text is not None for x in (*library.encode_ordinary(r.text), 50256)]
        count = -(-len(ids) // length)
        numbers += [(p << training_order.ROW_BITS) + k for k in range(count)]
        want += [(ids + [50256] * (count * length - len(ids)))[k * length : (k + 1) * length] for k in range(count)]
    place = training_order.feistel(np.array(numbers, np.uint64), training_order.PARTITIONS << training_order.ROW_BITS, 4)
    order = np.argsort(place)
    assert [read[s] for s in range(len(got))] == [want[i] for i in order]
    whole = {i for r in got for i in r.doc_ids}
    assert whole == {i for i, t in rows if t is not None}
    assert sum(r.n_tokens for r in got) == sum(len(library.encode_ordinary(t)) + 1 for _, t in rows if t is not None)


def _records(shards):
    """Batches of records as a writing task gets them: (shard, number of records)."""
    for shard, n in shards:
        data = [bytes([shard, k]) * 4 for k in range(n)]
        yield pa.record_batch({"shard": pa.array([shard] * n, pa.int32()), "place": list(range(n)), "doc_ids": [[k] for k in range(n)], "n_tokens": pa.array([4] * n, pa.int32()), "record": data})


def test_failed_killed_and_repeated_attempts_leave_whole_shards(tmp_path):
    def failing():
        yield from _records([(1, 3), (2, 2)])
        raise OSError("gone")

    write = training_order._write(str(tmp_path))
    with pytest.raises(OSError, match="gone"):
        list(write(failing()))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["shard-00000001.bin"]  # the second has no end
    killed = write(_records([(1, 3), (2, 5)]))
    next(killed)
    next(killed)
    killed.close()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["shard-00000001.bin"]
    slow = write(_records([(1, 3), (2, 5)]))  # one attempt stands still while another does it all
    next(slow)
    for _ in range(2):
        assert sum(b.num_rows for b in write(_records([(1, 3), (2, 5)]))) == 8
    list(slow)
    whole = {f"shard-{s:08d}.bin": b"".join(bytes([s, k]) * 4 for k in range(n)) for s, n in ((1, 3), (2, 5))}
    assert {p.name: p.read_bytes() for p in tmp_path.iterdir()} == whole
    with pytest.raises(RuntimeError, match="holds 24 bytes, not the 16"):
        list(write(_records([(1, 2)])))
    assert {p.name: p.read_bytes() for p in tmp_path.iterdir()} == whole


def test_training_order_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert training_order.write_order(df, str(tmp_path / "none"), training_order.load(RANKS), PATTERN, key=1).count() == 0


def test_ids_are_the_library_ids(spark):
    vocabulary = training_order.load(RANKS)
    encoder = training_order.Encoder(vocabulary, PATTERN, "<u2")
    odd = ["", " ", "a  b\n\n c ", "it's we'll", "naïve ß 漢字 🜚 é", "x1 22 ###$%", "\t tabs\r\n", "a" * 200, "\u00a0 x\u2003y"]
    for text in odd + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]:
        assert encoder.encode(text).tolist() == [*encoder.library.encode_ordinary(text), 50256]


# the pipeline


def test_stages_keep_columns_and_whole_texts(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns, name
        assert not Counter(map(tuple, kept.collect())) - Counter(map(tuple, docs.collect())), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()


def test_pipeline_like_its_operators_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = [r for r in rows if any(c.isalpha() for c in r.text or "")]  # every declared language is known here
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = ordinal.train(docs, grades(spark, sf), "grade")
    places = ordinal.Places()
    rows = [r for r in rows if model.tails(np.array([model.weights[ordinal.features(r.text, places)].sum()]))[0, -1] >= 0.5]
    rows.sort(key=lambda r: r.doc_id)
    classes: list[list] = []
    for r in rows:
        fp = simhash.fingerprint(r.text)
        near = [c for c in classes if any((fp ^ f).bit_count() <= 4 for _, f in c)]
        merged = [(r, fp)] + [x for c in near for x in c]
        classes = [c for c in classes if c not in near] + [merged]
    rows = [min((r for r, _ in c), key=lambda r: r.doc_id) for c in classes]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    index = decontaminate.build(items)
    lookup = decontaminate.Lookup(index.vocabulary)
    rows = [r for r in rows if not decontaminate.leaks_of(index, lookup, [r.text])[0]]
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf).collect()) == sorted(r.doc_id for r in rows)


def test_pipeline_with_nulls_repeats_and_nothing(spark, tmp_path):
    sf = tmp_path / "sf"
    docs = spark.createDataFrame(
        [(1, None, "en", "s", None), (2, "", "en", "s", 0), (None, "words without an id " * 9, "en", None, None), (3, "plain words of a text " * 9, None, "s", 1)] + [(4, "the same row of words " * 9, "en", "s", 5)] * 5,
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for k, df in enumerate((docs, docs.limit(0))):
        df.write.parquet(f"{sf}{k}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}{k}/labels.parquet")
        spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{sf}{k}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"{sf}0").collect()
    assert sorted(str(r.doc_id) for r in got) == ["3", "4", "None"]
    assert corpus_pipeline.run(spark, f"{sf}1").count() == 0


def test_every_query_runs_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op1_sharding", "op2_sentencepiece", "op3_language_id", "op5_decision_list", "op6_simhash", "op7_quality_classifier"):
        assert QUERIES[name](spark, sf).count() == docs, name
    assert QUERIES["op9_html_text"](spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()
