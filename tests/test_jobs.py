"""From topic messages to recommendations through the job entry points."""

import datetime as dt
import json

from pyspark.sql import functions as F

from pulsefeed.__main__ import main
from pulsefeed.functions.pseudonym import pseudonymize
from pulsefeed.operators import retention
from pulsefeed.schemas import FEATURE_ROW
from pulsefeed.sources import adapters as ad
from pulsefeed.sources import feature_log as log
from pulsefeed.streaming import consent as sc
from pulsefeed.streaming import online as so
from pulsefeed.streaming.dedup import drop_replays


def test_messages_to_recommendations(spark, sf_dir, tmp_path):
    at = lambda name: str(tmp_path / name)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    events = ad.watch_events(spark, sf_dir)
    raw = ad.watch_input(spark, sf_dir).withColumn("arrival_seq", F.col("event_id")).withColumn(
        "timestamp", F.concat(F.date_format(F.timestamp_micros("event_us"), "yyyyMMdd'T'HHmmss.SSSSSS"), F.lit("+00"))
    )
    raw.select("user_id", "content_id", "watch_pct", "timestamp", "genre", "timezone", "arrival_us", "arrival_seq").coalesce(2).write.json(at("raw"))
    main(["ingest", "--events", at("raw"), "--messages", at("topic"), "--rejects", at("bad"), "--checkpoint", at("cp0"), "--once"])
    assert spark.read.parquet(at("bad")).count() == raw.count() - events.count() > 0
    spark.createDataFrame([("broken", 0, -1)], "value string, arrival_us long, arrival_seq long").write.mode("append").json(at("topic2"))
    try:
        main(["features", "--messages", at("topic*"), "--log", at("log"), "--checkpoint", at("cp1"), "--rejects", at("bad2"), "--once"])
    finally:
        spark.conf.set(provider, before)
    assert [r["reject_reason"] for r in spark.read.parquet(at("bad2")).collect()] == ["not_json"]
    assert log.read_log(spark, at("log"), "2024-01-01", "2024-01-31").count() == events.count()
    main(["online", "--log", at("log"), "--table", at("online"), "--checkpoint", at("cp2"), "--once"])
    main(["train", "--log", at("log"), "--registry", at("models"), "--as-of", "2024-01-30", "--rounds", "2"])

    users = events.select("pseudo_user_id").distinct()
    users.unionByName(spark.range(1).select(pseudonymize(F.lit("new"), "k").alias("pseudo_user_id"))).write.parquet(at("users"))
    known = sorted(r[0] for r in users.collect())
    decisions = [(u, i > 0, None, dt.datetime(2024, 1, 1), i) for i, u in enumerate(known)]
    schema = "user_pseudo_id string, consent_granted boolean, reason string, ts timestamp, seq long"
    spark.createDataFrame(decisions, schema).coalesce(1).write.json(at("changes"))
    table = sc.consent_table(spark, at("consent"))
    main(["consent", "--changes", at("changes"), "--table", at("consent"), "--audit", at("audit"), "--checkpoint", at("cp3"), "--once"])

    args = ["recommend", "--users", at("users"), "--consent", at("consent"), "--online", at("online"), "--registry", at("models"),
            "--out", at("recs"), "--top-n", "4"]
    main(args)
    first = spark.read.parquet(at("recs")).filter("rank = 1")
    reasons = {r["fallback_reason"]: r["n"] for r in first.groupBy("fallback_reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {None: len(known) - 1, "consent_denied": 2}
    assert first.filter("personalized and model_version = '1'").count() == len(known) - 1
    assert spark.read.parquet(at("recs")).count() == 4 * (len(known) + 1)
    # Two hours later every feature row has expired.
    main([*args, "--as-of-epoch", str(dt.datetime.now().timestamp() + 7200)])
    late = spark.read.parquet(at("recs")).filter("rank = 1")
    assert late.filter("fallback_reason = 'cold_start'").count() == len(known) - 1
    # No consent table: everybody is denied.
    main([*args[:4], at("nothing"), *args[5:]])
    assert spark.read.parquet(at("recs")).filter("fallback_reason <> 'consent_denied' or personalized").count() == 0
    main(["retention", "--audit", at("audit"), "--as-of", "2024-09-01", "--archive", at("cold")])
    assert retention.stored_months(spark, at("audit")) == []
    assert table.read().count() == len(known)


def test_unix_times_reach_the_online_view(spark, sf_dir, tmp_path):
    """Events with times in every accepted form, through the boundary and one stream into the log and the online view."""
    at = lambda name: str(tmp_path / name)
    raw = ad.raw_watch_input(spark, sf_dir, ad.boundary_stamps())
    raw.select("user_id", "content_id", "watch_pct", "timestamp", "genre", "timezone").coalesce(2).write.json(at("raw"))
    main(["ingest", "--events", at("raw"), "--messages", at("topic"), "--rejects", at("bad"), "--checkpoint", at("cp0"), "--once"])
    accepted = raw.count() - spark.read.parquet(at("bad")).count()
    main(["features", "--messages", at("topic"), "--log", at("log"), "--online", at("online"), "--checkpoint", at("cp1"), "--rejects", at("bad2"), "--once"])
    assert spark.read.schema("reject_reason string").parquet(at("bad2")).count() == 0
    assert log.read_log(spark, at("log"), "2023-12-31", "2024-02-28").count() == accepted > 0
    assert so.online_table(spark, at("online")).read().count() > 0


def test_session_job(spark, sf_dir, tmp_path):
    at = lambda name: str(tmp_path / name)
    sessions = ad.session_input(spark, sf_dir)
    sessions.drop("event_id").coalesce(1).write.json(at("raw"))
    main(["sessions", "--events", at("raw"), "--messages", at("topic"), "--rejects", at("bad"), "--checkpoint", at("cp"), "--once"])
    sent, bad = spark.read.json(at("topic")), spark.read.parquet(at("bad"))
    assert sent.count() + bad.count() == sessions.count() and bad.count() > 0 and "user_id" not in bad.columns
    body = json.loads(sent.first()["value"])
    assert set(body) == {"pseudo_user_id", "session_id", "device", "start_time"}


def test_slo_job(spark, tmp_path):
    ad_log = spark.createDataFrame([("a", 5.0, True, dt.datetime(2026, 1, 1))], "endpoint string, latency_ms double, ok boolean, ts timestamp")
    ad_log.write.parquet(str(tmp_path / "log"))
    main(["slo", "--requests", str(tmp_path / "log"), "--out", str(tmp_path / "out")])
    rows = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert len(rows) == 5 and all(r["passed"] for r in rows)
    assert rows[0]["endpoints"] == [{"endpoint": "a", "requests": 1, "errors": 0, "error_pct": 0.0, "p50_ms": 5.0, "p95_ms": 5.0, "p99_ms": 5.0}]
    assert set(rows[0]["thresholds"]) == {"max_p95_ms", "max_error_pct"}


def test_stream_drops_replays(spark, tmp_path):
    def row(user, epoch, computed):
        return (user, 1, 0.5, 60.0, "night", 0.7, "{}", float(epoch), float(computed), "2026-05-01")

    data = [row("a", 1, 10), row("a", 1, 11), row("a", 2, 12), row("b", 1, 13), row("a", 1, 14)]
    for i, r in enumerate(data):
        spark.createDataFrame([r], FEATURE_ROW).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    stream = spark.readStream.schema(FEATURE_ROW).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in" / "*"))
    q = drop_replays(stream).writeStream.format("memory").queryName("unique_rows").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((r["pseudo_user_id"], r["last_event_epoch"]) for r in spark.table("unique_rows").collect())
    assert got == [("a", 1.0), ("a", 2.0), ("b", 1.0)]
