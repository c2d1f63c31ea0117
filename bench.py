"""Headline queries, timed end to end into a no-op sink.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Prints one JSON line. Each query is planned and run ``BENCH_RUNS`` times (default
2) and the best time is reported; ``value`` is their sum.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

HEADLINE = [
    "parse_watch_json",
    "validate_watch_valid",
    "pseudonymize_users",
    "user_high_water_mark",
    "window_membership_counts",
    "user_features",
    "user_features_day",
    "genre_weights",
    "dedup_feature_rows",
    "online_features_latest",
    "features_as_of_request",
    "consent_current",
    "consent_gate",
    "audit_retained",
    "split_stats",
    "feature_matrix",
    "auc_score",
    "recommend_top_n",
    "recommendations_all_users",
    "latency_percentiles",
    "slo_report",
    "processing_lag",
]


def stream_lag(spark, sf_dir: str, batches: int = 6) -> dict:
    """All watch events through the stateful stream into the log and the online view, cut into micro-batches in arrival order.

    ``online`` is the time from the start of a micro-batch until its feature rows are
    online, ``batch`` until they are logged and committed too. The first batch starts
    the workers and is reported apart.
    """
    from datetime import datetime

    from pyspark.sql import functions as F

    from pulsefeed.schemas import ARRIVAL
    from pulsefeed.sources import adapters
    from pulsefeed.streaming.features import both_writer, stream_features
    from pulsefeed.streaming.online import online_table

    # A cluster names its shared folder; without one this is a local run.
    shared = spark.conf.get("spark.checkpoint.dir", None)
    work = f"{shared}/bench-stream-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="bench-stream-")
    events = adapters.watch_events(spark, sf_dir)
    bounds = [q / batches for q in range(1, batches)]
    edges = events.agg(F.percentile_approx("arrival_us", bounds, 100_000)).first()[0]
    part = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < F.col("arrival_us")))
    cut = events.withColumn("part", part).persist()
    for i in range(batches):
        cut.filter(F.col("part") == i).drop("part").sortWithinPartitions(*ARRIVAL).coalesce(1).write.parquet(f"{work}/in/{i}")
    schema = cut.drop("part").schema
    cut.unpersist()
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/in/*")
    table = online_table(spark, f"{work}/online")
    upsert, online_at = table.upsert, {}

    def timed(batch, batch_id, run):
        upsert(batch, batch_id, run)
        online_at[batch_id] = time.time()

    table.upsert = timed
    writer = both_writer(stream_features(source), f"{work}/log", table, f"{work}/checkpoint")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    done = [p for p in query.recentProgress if p["numInputRows"]]
    seconds = [p["batchDuration"] / 1000.0 for p in done]
    later = seconds[1:] or seconds
    online = [online_at[p["batchId"]] - datetime.fromisoformat(p["timestamp"]).timestamp() for p in done]
    online_later = sorted(online[1:] or online)
    return {
        "rows": sum(p["numInputRows"] for p in done),
        "batches": len(done),
        "first_batch_sec": round(seconds[0], 3),
        "median_later_online_sec": round(online_later[len(online_later) // 2], 3),
        "max_later_online_sec": round(online_later[-1], 3),
        "median_later_batch_sec": round(sorted(later)[len(later) // 2], 3),
        "max_later_batch_sec": round(max(later), 3),
        "rows_per_sec": round(sum(p["numInputRows"] for p in done[1:]) / sum(later)) if len(done) > 1 else None,
    }


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from pulsefeed.plans.queries import all_queries
    from pulsefeed.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        timings[name] = round(best, 3)
    report = {
        "metric": "headline queries, total of best runs",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "events": events,
        "runs": runs,
    }
    if "user_features" in timings:
        report["feature_rows_per_sec"] = round(events / timings["user_features"])
    if not sys.argv[1:]:
        report["stream"] = stream_lag(spark, sf_dir)
        report["event_to_online"] = stream_lag(spark, sf_dir, 24)
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
