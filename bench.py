"""Headline timings on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stowline.functions.codec import record_size
from stowline.plans import queries
from stowline.plans.archive import archive_records
from stowline.sources.lines import scan_lines
from stowline.sources.parquet import scan_parquet_physical
from stowline.sources.segments import scan_segments
from stowline.streaming.line_source import tail_lines

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def spend(df):
    """Compute every column of every row and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stowline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    base = tempfile.mkdtemp(prefix="stowline-bench-")
    table = f"{base}/records"
    queries._records(spark, folder).write.parquet(table)
    records = spark.read.parquet(table)
    count, size = records.agg(F.count("*"), F.sum(record_size())).first()
    stored = f"{base}/stored"
    archive_records(records, stored)
    text = queries._text_files(spark, folder)
    text_bytes = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(
        text
    ).agg(F.sum("length")).first()[0]
    vectors = f"{folder}/embeddings.parquet"
    runs = iter(range(10**6))

    def archive(cap):
        archive_records(records, f"{base}/archive-{next(runs)}", cap=cap)

    named = {
        "archive_5MiB": (lambda: archive(5 << 20), count, size),
        "archive_64KiB": (lambda: archive(1 << 16), count, size),
        "segment_summary": (lambda: spend(queries.segment_summary(spark, folder)), count, size),
        "restore": (lambda: spend(scan_segments(spark, stored)), count, size),
        "encode_record": (lambda: spend(queries.encode_record(spark, folder)), count, size),
        "scan_lines": (
            lambda: spend(scan_lines(spark, directory=text, recursive=True)), None, text_bytes,
        ),
        "tail_lines": (
            lambda: queries._to_table(tail_lines(spark, directory=text, recursive=True)).count(),
            None,
            text_bytes,
        ),
        "parquet_physical": (
            lambda: spend(scan_parquet_physical(spark, vectors)),
            spark.read.parquet(vectors).count(),
            None,
        ),
        "parquet_progress": (lambda: spend(queries.parquet_progress(spark, folder)), count, None),
        "out_of_order": (lambda: spend(queries.out_of_order(spark, folder)), None, None),
        "latency_ms": (lambda: spend(queries.latency_ms(spark, folder)), count, None),
        "unfinished_files": (lambda: spend(queries.unfinished_files(spark, folder)), None, None),
    }
    seconds, rates = {}, {}
    for name, (run, rows, amount) in named.items():
        run()
        taken = []
        for _ in range(RUNS):
            began = time.perf_counter()
            run()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(taken), 3)
        rates[name] = {
            "rows_per_s": rows and round(rows / seconds[name]),
            "mb_per_s": amount and round(amount / seconds[name] / 1e6, 2),
        }
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rates": rates,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
