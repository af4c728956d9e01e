"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from isohyet import catalog
    from isohyet.operators import observations as obs
    from isohyet.operators.convert import Converter

    times: dict[str, float] = {}

    def timed(name: str, f, runs: int = 3) -> None:
        took = []
        for _ in range(runs):
            began = time.perf_counter()
            f()
            took.append(time.perf_counter() - began)
        times[name] = round(statistics.median(took), 3)

    run = lambda df: df.write.format("noop").mode("overwrite").save()
    with tempfile.TemporaryDirectory(prefix="bench-") as folder:
        root, out = catalog._plain_tree(spark, sf_dir), f"file://{folder}/rain.parquet"
        stats = []
        timed("convert", lambda: stats.append(Converter(spark, root, out).run()))
        df = spark.read.parquet(out)
        station = df.select("station_id").first()[0]
        timed("station_query", lambda: run(obs.of_station(df, station)))
        timed("time_range_query", lambda: run(obs.after(df, "ob_end_ctime", catalog.START)))
        timed("station_time_query", lambda: run(obs.after(obs.of_station(df, station), "ob_end_ctime", catalog.START)))
        timed("station_counts", lambda: run(obs.station_counts(df, "station_id")))
        timed("monthly_mean", lambda: run(obs.monthly(df, "station_id", "ob_end_ctime", "prcp_amt")))
        names = ["monthly_sum", "dedup_rec_status", "registry_join", "long_view", "date_span_years"]
        for name in names:
            timed(name, lambda name=name: run(catalog.QUERIES[name](spark, sf_dir)))
        try:
            from isohyet.llm import queries as corpus
        except ImportError:
            corpus = None
        if corpus:
            for name, f in corpus.queries().items():
                timed(name, lambda f=f: run(f(spark, sf_dir)), 1)
        rows_per_s = round(stats[-1].total_rows / times["convert"]) if stats and times["convert"] else None
    print(json.dumps({"metric": "total seconds of headline queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "converted_rows_per_s": rows_per_s}))


if __name__ == "__main__":
    main()
