"""The stream equals the batch plan for the same arrival order, across cuts and restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsefeed.operators import consent as co
from pulsefeed.operators import window_features as wf
from pulsefeed.schemas import ARRIVAL, FEATURE_COLUMNS, USER_STATE
from pulsefeed.sources import adapters as ad
from pulsefeed.sources.feature_log import read_log
from pulsefeed.streaming import consent as sc
from pulsefeed.streaming import features as sf_
from pulsefeed.streaming import online as so

EVENT = T.StructType(
    [
        T.StructField("pseudo_user_id", T.StringType()), T.StructField("content_id", T.StringType()),
        T.StructField("watch_pct", T.DoubleType()), T.StructField("genre", T.StringType()),
        T.StructField("timezone", T.StringType()), T.StructField("event_us", T.LongType()),
        T.StructField("event_date", T.StringType()), T.StructField("arrival_us", T.LongType()),
        T.StructField("arrival_seq", T.LongType()),
    ]
)


def _batches(spark, sf_dir, path, cuts):
    """The events as one file per micro-batch, cut along the arrival order."""
    events = ad.watch_events(spark, sf_dir).select(*EVENT.fieldNames())
    pdf = events.orderBy(*ARRIVAL).toPandas()
    size = -(-len(pdf) // cuts)
    for i in range(cuts):
        part = pdf.iloc[i * size:(i + 1) * size]
        spark.createDataFrame(part.sample(frac=1.0, random_state=i), EVENT).coalesce(1).write.json(f"{path}/{i:03d}")
    return events


def _read(spark, path):
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(f"{path}/*")


def _close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for c in FEATURE_COLUMNS:
            if c == "computed_at_epoch":
                continue
            if isinstance(x[c], float):
                assert x[c] == pytest.approx(y[c], abs=1e-9), (c, x, y)
            elif c != "session_genre_vector":
                assert x[c] == y[c], (c, x, y)
        import json

        assert json.loads(x["session_genre_vector"]) == pytest.approx(json.loads(y["session_genre_vector"]), abs=1e-9)


@pytest.mark.parametrize("cuts,seconds", [(1, 600), (5, 86_400)])
def test_stream_equals_batch(spark, sf_dir, tmp_path, cuts, seconds):
    spec = wf.WindowSpec(seconds=seconds)
    events = _batches(spark, sf_dir, str(tmp_path / "in"), cuts)
    rows = sf_.stream_features(_read(spark, str(tmp_path / "in")), spec)
    q = sf_.log_writer(rows, str(tmp_path / "log"), str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    streamed = spark.read.parquet(str(tmp_path / "log")).orderBy(*ARRIVAL).collect()
    batch = wf.feature_rows(events, F.lit(0.0), spec).orderBy(*ARRIVAL).collect()
    _close(streamed, batch)


def test_restart_continues_from_the_checkpoint(spark, sf_dir, tmp_path):
    spec = wf.WindowSpec(seconds=86_400)
    whole = str(tmp_path / "whole")
    events = _batches(spark, sf_dir, whole, 4)
    live = tmp_path / "live"
    live.mkdir()
    for half in (["000", "001"], ["002", "003"]):
        for name in half:
            spark.read.schema(EVENT).json(f"{whole}/{name}").coalesce(1).write.json(str(live / name))
        rows = sf_.stream_features(_read(spark, str(live)), spec)
        q = sf_.log_writer(rows, str(tmp_path / "log"), str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(240)
    streamed = spark.read.parquet(str(tmp_path / "log")).orderBy(*ARRIVAL).collect()
    _close(streamed, wf.feature_rows(events, F.lit(0.0), spec).orderBy(*ARRIVAL).collect())


def test_state_takes_a_new_field_over_a_restart(spark, sf_dir, tmp_path):
    """State written before a field was added is read with it null, and nothing is recomputed or lost."""
    spec = wf.WindowSpec(seconds=86_400)
    whole = str(tmp_path / "whole")
    events = _batches(spark, sf_dir, whole, 2)
    live = tmp_path / "live"
    live.mkdir()
    wider = T.StructType([*USER_STATE.fields, T.StructField("seen_in", T.StringType(), True)])
    for name, state in (("000", USER_STATE), ("001", wider)):
        spark.read.schema(EVENT).json(f"{whole}/{name}").coalesce(1).write.json(str(live / name))
        rows = sf_.stream_features(_read(spark, str(live)), spec, state, evolving=True)
        sf_.log_writer(rows, str(tmp_path / "log"), str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(240)
    streamed = spark.read.parquet(str(tmp_path / "log")).orderBy(*ARRIVAL).collect()
    _close(streamed, wf.feature_rows(events, F.lit(0.0), spec).orderBy(*ARRIVAL).collect())


def test_one_stream_keeps_the_online_view_and_the_log(spark, sf_dir, tmp_path):
    events = _batches(spark, sf_dir, str(tmp_path / "in"), 4)
    rows = sf_.stream_features(_read(spark, str(tmp_path / "in")))
    log, table = str(tmp_path / "log"), so.online_table(spark, str(tmp_path / "online"))
    sf_.both_writer(rows, log, table, str(tmp_path / "cp"), compact_every=2).trigger(availableNow=True).start().awaitTermination(240)
    last = {}
    for r in events.orderBy(*ARRIVAL).collect():
        last[r["pseudo_user_id"]] = r
    got = {r["pseudo_user_id"]: r for r in table.read().collect()}
    assert {u: r["arrival_seq"] for u, r in got.items()} == {u: r["arrival_seq"] for u, r in last.items()}
    logged = read_log(spark, log, "2024-01-01", "2024-01-31")
    assert logged.count() == events.count()
    batch = wf.feature_rows(events, F.lit(0.0))
    assert logged.agg(F.sum("watch_count_10min")).first() == batch.agg(F.sum("watch_count_10min")).first()
    # A log that is compacted in place is not followed file by file.
    with pytest.raises(ValueError, match="compacted"):
        so.log_stream(spark, log)


def test_a_repeated_batch_changes_neither_table(spark, sf_dir, tmp_path):
    """The commit of the last batch is taken back, as if the driver had died before it: the batch runs again."""
    events = _batches(spark, sf_dir, str(tmp_path / "in"), 2)
    log, table = str(tmp_path / "log"), so.online_table(spark, str(tmp_path / "online"))
    for _ in range(2):
        rows = sf_.stream_features(_read(spark, str(tmp_path / "in")))
        sf_.both_writer(rows, log, table, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(240)
        commits = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
        for p in [commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")]:
            p.unlink(missing_ok=True)
    assert read_log(spark, log, "2024-01-01", "2024-01-31").count() == events.count()
    assert table.read().count() == events.select("pseudo_user_id").distinct().count()


def test_online_view_follows_the_log(spark, sf_dir, tmp_path):
    events = _batches(spark, sf_dir, str(tmp_path / "in"), 3)
    rows = sf_.stream_features(_read(spark, str(tmp_path / "in")))
    log = str(tmp_path / "log")
    sf_.log_writer(rows, log, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(240)
    table = so.online_table(spark, str(tmp_path / "online"))
    stream = so.log_stream(spark, log, max_files=20)
    so.online_writer(stream, table, str(tmp_path / "cp2"), compact_every=2).trigger(availableNow=True).start().awaitTermination(240)
    got = {r["pseudo_user_id"]: r for r in table.read().collect()}
    last = {}
    for r in events.orderBy(*ARRIVAL).collect():
        last[r["pseudo_user_id"]] = r
    assert set(got) == set(last)
    assert all(got[u]["arrival_seq"] == r["arrival_seq"] for u, r in last.items())
    assert all(r["expires_at"] == pytest.approx(r["computed_at_epoch"] + 3600) for r in got.values())
    # The files the stream wrote are a readable feature log.
    assert read_log(spark, log, "2024-01-01", "2024-01-31").count() == events.count()


def test_latest_table_repeats_and_compacts(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("at", T.LongType()), T.StructField("v", T.StringType())])
    from pulsefeed.sources.latest_table import LatestTable

    table = LatestTable(spark, str(tmp_path / "t"), schema, "k", ["at"])
    assert table.read().count() == 0
    batch = lambda rows: spark.createDataFrame(rows, schema)
    table.upsert(batch([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")]), 0)
    table.upsert(batch([("a", 3, "w")]), 1)
    table.upsert(batch([("a", 3, "w")]), 1)
    want = [("a", 3, "w"), ("b", 1, "z")]
    assert sorted(map(tuple, table.read().collect())) == want
    assert table.compact() == 0 and table.compact() == 0
    assert sorted(map(tuple, table.read().collect())) == want
    table.upsert(batch([("c", 1, "n")]), 2)
    assert table.compact() == 1
    table.upsert(batch([("b", 9, "later")]), 3)
    assert sorted(map(tuple, table.read().collect())) == [("a", 3, "w"), ("b", 9, "later"), ("c", 1, "n")]


@pytest.mark.parametrize("compacted", [False, True])
def test_a_new_checkpoint_loses_no_writes(spark, tmp_path, compacted):
    """Batch numbers start again in a new run; replays still replace themselves, before and after compaction."""
    from pulsefeed.sources.latest_table import LatestTable

    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("at", T.LongType())])
    table = LatestTable(spark, str(tmp_path / "t"), schema, "k", ["at"])
    batch = lambda *rows: spark.createDataFrame(list(rows), schema)
    table.upsert(batch(("a", 1)), 0, "one")
    table.upsert(batch(("b", 1)), 1, "one")
    if compacted:
        table.compact()
    table.upsert(batch(("c", 5)), 0, "two")
    table.upsert(batch(("b", 1)), 1, "one")
    assert sorted(map(tuple, table.read().collect())) == [("a", 1), ("b", 1), ("c", 5)]
    table.compact()
    table.upsert(batch(("a", 9)), 1, "two")
    table.compact()
    assert sorted(map(tuple, table.read().collect())) == [("a", 9), ("b", 1), ("c", 5)]


def test_audit_survives_a_new_checkpoint(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    schema = "user_pseudo_id string, consent_granted boolean, reason string, ts timestamp, seq long"
    table = sc.consent_table(spark, str(tmp_path / "consent"))
    for run in range(2):
        rows = [(f"u{run}{i}", True, None, t0, 10 * run + i) for i in range(3)]
        spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / f"in{run}"))
        changes = spark.readStream.schema(schema).json(str(tmp_path / f"in{run}"))
        sc.consent_writer(changes, table, str(tmp_path / "audit"), str(tmp_path / f"cp{run}")).trigger(availableNow=True).start().awaitTermination(240)
    assert sc.read_audit_log(spark, str(tmp_path / "audit")).count() == 6 and table.read().count() == 6


def test_consent_stream_keeps_both_tables_in_step(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("u1", True, None, t0, 1), ("u1", False, "no", t0 + dt.timedelta(days=40), 2), ("u2", True, None, t0, 3),
            ("u2", True, None, t0 + dt.timedelta(minutes=1), 4)]
    schema = "user_pseudo_id string, consent_granted boolean, reason string, ts timestamp, seq long"
    for i, r in enumerate(rows):
        spark.createDataFrame([r], schema).coalesce(1).write.json(str(tmp_path / "in" / str(i)))
    changes = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).json(str(tmp_path / "in" / "*"))
    table = sc.consent_table(spark, str(tmp_path / "consent"))
    sc.consent_writer(changes, table, str(tmp_path / "audit"), str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(240)
    audit = sc.read_audit_log(spark, str(tmp_path / "audit"))
    assert audit.count() == 4
    state = {r["user_pseudo_id"]: r["consent_granted"] for r in table.read().collect()}
    assert state == {"u1": False, "u2": True}
    now = table.read().select("user_pseudo_id", "consent_granted", "updated_at")
    assert co.audit_mismatch(now, audit).count() == 0
