import random

import pytest

from pulsefeed.operators import evaluation as ev
from pulsefeed.operators import monitor
from pulsefeed.schemas import REQUEST_LOG
from pulsefeed.sources import reports


def rule(values, p):
    s = sorted(values)
    return s[min(int(len(s) * p / 100), len(s) - 1)]


def frame(spark, data):
    import datetime as dt

    return spark.createDataFrame([(e, float(v), ok, dt.datetime(2026, 5, 1)) for e, v, ok in data], REQUEST_LOG)


@pytest.mark.parametrize("n", [1, 2, 24, 25, 100, 333])
def test_index_percentiles(spark, n):
    rng = random.Random(n)
    values = [rng.choice([0.0, 5.0, round(rng.random() * 900, 1), rng.random() * 1e6, -3.0]) for _ in range(n)]
    df = frame(spark, [("a", v, True) for v in values])
    got = ev.index_percentiles(df, ["endpoint"], "latency_ms", [0, 1, 50, 95, 99, 100]).first()
    assert got["n"] == n
    for p in (0, 1, 50, 95, 99, 100):
        assert got[f"p{p}"] == rule(values, p)


def test_p95_of_25_is_index_23(spark):
    df = frame(spark, [("a", v, True) for v in range(25)])
    assert ev.index_percentiles(df, ["endpoint"], "latency_ms", [95]).first()["p95"] == 23.0


def test_slo_report(spark, tmp_path):
    data = [("a", v, v != 7) for v in range(1, 11)] + [("b", v * 10, True) for v in range(1, 11)] + [("c", 500.0, True)]
    suites = {"exact": (500.0, 100.0 / 21), "tight": (499.9, 1.0)}
    got = {r["suite"]: r for r in monitor.slo_report(frame(spark, data), suites).collect()}
    r = got["exact"]
    assert (r["requests"], r["errors"], r["p95_ms"], r["p99_ms"], r["p50_ms"]) == (21, 1, 500.0, 500.0, 60.0)
    assert r["error_pct"] == pytest.approx(100 / 21)
    assert r["passed"] and not got["tight"]["latency_passed"] and not got["tight"]["errors_passed"]
    reports.write_slo_snapshot(frame(spark, data), str(tmp_path / "out"), suites)
    assert reports.latest_snapshot(spark, str(tmp_path / "out"), "tight").first()["passed"] is False
    frame(spark, data).write.option("header", True).csv(str(tmp_path / "csv"))
    assert reports.read_request_log(spark, str(tmp_path / "csv"), "csv").count() == 21


def test_empty_and_failing_logs(spark):
    empty = monitor.slo_report(frame(spark, [("a", 1.0, True)]).filter("false"), {"s": (0.0, 0.0)}).first()
    assert (empty["requests"], empty["p95_ms"], empty["error_pct"], empty["passed"]) == (0, 0.0, 0.0, True)
    bad = monitor.slo_report(frame(spark, [("a", 1.0, False)]), {"s": (10.0, 5.0)}).first()
    assert bad["error_pct"] == 100.0 and bad["latency_passed"] and not bad["passed"]


def test_requests_without_a_latency_count(spark):
    import datetime as dt

    at = dt.datetime(2026, 5, 1)
    log = spark.createDataFrame([("a", 5.0, True, at), ("a", None, False, at), ("b", None, False, at), (None, 7.0, None, at)], REQUEST_LOG)
    got = {r["endpoint"]: (r["requests"], r["errors"], r["p95"]) for r in monitor.endpoint_stats(log).collect()}
    assert got == {"a": (2, 1, 5.0), "b": (1, 1, None), None: (1, 1, 7.0)}
    report = monitor.slo_report(log, {"s": (10.0, 5.0)}).first()
    assert (report["requests"], report["errors"], report["passed"]) == (4, 3, False)


def test_one_scan_of_the_log(spark, tmp_path):
    frame(spark, [(f"e{i % 3}", i, True) for i in range(50)]).write.parquet(str(tmp_path / "log"))
    log = reports.read_request_log(spark, str(tmp_path / "log"))
    stats = monitor.endpoint_stats(log)
    stats.collect()
    plan = stats._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 1 or plan.count("FileScan") == 1


def test_histogram_and_stability(spark):
    df = spark.createDataFrame([("t", x / 10) for x in range(11)] + [("v", 0.05)] * 4, "split string, score double")
    h = ev.score_histogram(df, by=["split"])
    assert {(r["split"], r["bin"]): r["n"] for r in h.collect()}[("t", 9)] == 2
    assert ev.stability_index(h, "split", "t", "t").first()["psi"] == 0.0
    assert ev.stability_index(h, "split", "t", "v").first()["psi"] > 1.0
