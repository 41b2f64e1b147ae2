"""Time the headline operators over encoded test tables.

Record files are encoded from the tables first; that is not part of the times. Each
operator runs once to warm up and is then timed. Prints one JSON line.

    BENCH_SF_DIR   table folder, default /root/testdata/sf0.1
    BENCH_CPUS     local cores, default 8
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from mainspool.operators import decode as d
from mainspool.operators import route as r
from mainspool.operators import rules
from mainspool.operators import segments as s
from mainspool.functions import codec
from mainspool.session import scratch_path
from mainspool.sinks import tables
from mainspool.sinks.vb import write_vb
from mainspool.sources.fixed import read_fb
from mainspool.sources.variable import read_vb
from mainspool.testsupport import fixtures as fx
from mainspool.testsupport import layouts as lay

# The test files are small: smaller ranges than the default, so that all cores read.
CHUNK = 4 << 20


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")

    sales, sales_vb = fx.sales(spark, sf_dir), fx.sales_vb(spark, sf_dir)
    people, mixed = fx.customers(spark, sf_dir), fx.mixed(spark, sf_dir)
    composite = fx.composite(spark, sf_dir, offset=fx.OFFSET, marked=True)
    catalog = lay.mixed_catalog()
    marked = {"length_offset": fx.OFFSET, "skip_marker": fx.MARKER}

    def vb(path: str) -> DataFrame:
        return read_vb(spark, path, chunk_bytes=CHUNK)

    def fb() -> DataFrame:
        return read_fb(spark, sales, lay.SALES.max_length, chunk_bytes=CHUNK)

    def split() -> DataFrame:
        return s.split_segments(vb(composite), lay.HEADER_LEN, lay.PREFIX, "LINE-BYTES", **marked)

    def run(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    include = "ORDERS-HELD=2:ORDERS-HELD=3:ORDERS-HELD=6"
    jobs = {
        "scan_fb": lambda: run(fb()),
        "scan_vb": lambda: run(vb(sales_vb)),
        "fb_decode_one_field": lambda: run(d.decode_flat(fb(), lay.SALES, keep=()).select("NET_PRICE")),
        "fb_decode_flat": lambda: run(d.decode_flat(fb(), lay.SALES)),
        "fb_decode_typed": lambda: run(d.decode_typed(fb(), lay.SALES)),
        "vb_decode_text": lambda: run(d.decode_text(vb(sales_vb), lay.SALES)),
        "vb_decode_occurs": lambda: run(d.decode_typed(vb(people), lay.ACCOUNT)),
        "vb_include": lambda: run(rules.include(vb(people), lay.ACCOUNT, include)),
        "route_first_match": lambda: run(r.route(vb(mixed), catalog)),
        "split_segments": lambda: run(split()),
        "clean_text": lambda: run(fx.table(spark, sf_dir, "documents").selectExpr(codec.clean("text"))),
        "convert_tsv": lambda: tables.write_tsv(vb(sales_vb), lay.SALES, scratch_path(spark, "tsv")),
        "write_by_type": lambda: tables.write_by_type(r.route(vb(mixed), catalog), catalog, scratch_path(spark, "type")),
        "split_write_vb": lambda: write_vb(split(), scratch_path(spark, "vb")),
    }
    times = {}
    for name, job in jobs.items():
        job()
        start = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total of warm operator times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
