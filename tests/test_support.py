"""Test-input helpers."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mainspool.testsupport import encode


def test_ranks_with_a_hot_key(spark):
    """Salted ranking equals one window, with a third of the rows on one key."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).alias("k"), "id", (F.col("id") % 7).alias("salt")
    )
    whole = F.row_number().over(W.partitionBy("k").orderBy("salt", "id"))
    ranked = encode.rank_in_key(df, "k", ["id"], "salt")
    assert ranked.join(df.select("id", whole.alias("want")), "id").filter("rn != want").count() == 0
    assert ranked.count() == 3000


def test_tasks_open_buckets_with_sparks_settings(spark, monkeypatch):
    from mainspool.sources import framing

    settings = {
        "fs.s3a.access.key": "general",
        "fs.s3a.secret.key": "secret",
        "fs.s3a.endpoint": "http://store.example:9000",
        "fs.s3a.endpoint.region": "here",
        "fs.s3a.bucket.own.access.key": "own",
        "fs.s3a.bucket.own.endpoint": "other.example",
        "fs.s3a.bucket.own.session.token": "token",
    }
    assert framing.store_settings(settings.get, "any") == {"access_key": "general", "secret_key": "secret", "endpoint_override": "store.example:9000", "region": "here", "scheme": "http"}
    own = framing.store_settings({**settings, "fs.s3a.connection.ssl.enabled": "false"}.get, "own")
    assert own == {"access_key": "own", "secret_key": "secret", "session_token": "token", "endpoint_override": "other.example", "region": "here", "scheme": "http"}
    assert framing.store_settings({}.get, "any") == {}
    monkeypatch.setattr(framing, "STORES", {})
    conf = spark._jsc.hadoopConfiguration()
    try:
        for name, value in settings.items():
            conf.set(name, value)
        framing.remember_stores(spark, ["s3a://any/x", "/local", "file:/y", "hdfs://host/z"])
        assert list(framing.STORES) == ["any"]

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                system, inner = framing.filesystem("s3a://any/a b/c#d")
                yield pa.RecordBatch.from_pydict({"path": [f"{type(system).__name__} {system.region} {inner}"] * batch.num_rows})

        assert spark.range(1).mapInArrow(run, "path string").first()["path"] == "S3FileSystem here any/a b/c#d"
    finally:
        for name in settings:
            conf.unset(name)
