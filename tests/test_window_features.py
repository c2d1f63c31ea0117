"""Window features against a direct append-and-evict simulation."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from pulsefeed import settings as cfg
from pulsefeed.functions.times import known_zones, time_of_day
from pulsefeed.operators import window_features as wf
from pulsefeed.schemas import ARRIVAL, WATCH_EVENT

DAY0 = 1_767_225_600  # 2026-01-01


def frame(spark, rows):
    """rows: (user, content, pct, genre, event seconds, arrival seconds)."""
    data = [
        (u, c, float(p), g, None, round(t * 1_000_000), "2026-01-01", round(a * 1_000_000), i)
        for i, (u, c, p, g, t, a) in enumerate(rows)
    ]
    return spark.createDataFrame(data, WATCH_EVENT)


def simulate(rows, window, recency=cfg.RECENCY_LAMBDA, affinity=cfg.AFFINITY_LAMBDA):
    """State per user, one event at a time in arrival order."""
    out, state = {}, {}
    order = sorted(range(len(rows)), key=lambda i: (round(rows[i][5] * 1e6), i))
    for i in order:
        u, _, p, g, t, _ = rows[i]
        hwm, held = state.get(u, (0.0, []))
        hwm = max(hwm, t)
        held = [r for r in [*held, (t, p, g)] if round(r[0] * 1e6) >= round(hwm * 1e6) - window * 1_000_000]
        state[u] = (hwm, held)
        n = len(held)

        def decay(rate, rs):
            try:
                return min(sum(pp * math.exp(-rate * (t - tt)) for tt, pp, _ in rs) / (100.0 * n), 1.0) if n else 0.0
            except OverflowError:
                return 1.0

        genres = {}
        for tt, pp, gg in held:
            if gg:
                genres[gg] = genres.get(gg, 0.0) + pp / 100
        total = sum(genres.values())
        out[i] = (
            n,
            sum(pp for _, pp, _ in held) / n if n else 0.0,
            decay(recency, held),
            decay(affinity, [r for r in held if r[2] is not None]),
            {k: v / total for k, v in genres.items()} if total else {},
        )
    return out


def check(df, expected):
    got = {r["arrival_seq"]: r for r in df.collect()}
    assert set(got) == set(expected)
    for i, (n, avg, rec, aff, dist) in expected.items():
        r = got[i]
        assert r["watch_count_10min"] == n, i
        assert r["avg_watch_duration"] == pytest.approx(avg, abs=1e-9)
        assert r["recency_score"] == pytest.approx(rec, abs=1e-9)
        assert r["category_affinity_score"] == pytest.approx(aff, abs=1e-9)
        assert json.loads(r["session_genre_vector"]) == pytest.approx(dist, abs=1e-9)
        assert list(json.loads(r["session_genre_vector"])) == sorted(dist)


def disorder(seed, n, users=3, genres=("action", "drama", "", None), span=4000.0):
    """Bursts, ties, exact-edge times, late and far-late events."""
    rng = random.Random(seed)
    rows, clock = [], DAY0 + 0.0
    for i in range(n):
        clock += rng.choice([0.0, 0.0, 1.0, 30.0, 200.0, 600.0])
        t = clock - rng.choice([0.0, 0.0, 0.0, 600.0, 599.999999, 600.000001, rng.random() * span])
        pct = rng.choice([0.0, 0.0, 100.0, 33.3, 70.1, round(rng.random() * 100, 2)])
        rows.append((f"u{rng.randrange(users)}", f"c{i % 7}", pct, rng.choice(genres), t, clock))
    return rows


@pytest.mark.parametrize("hot_rows", [10_000, 0])
@pytest.mark.parametrize("window", [600, 86_400])
def test_random_streams(spark, hot_rows, window):
    """The ordinary path and the split path agree with the simulation."""
    rows = disorder(7, 500)
    spec = wf.WindowSpec(seconds=window, hot_user_rows=hot_rows)
    check(wf.feature_rows(frame(spark, rows), F.lit(0.0), spec), simulate(rows, window))


def test_mixed_load_splits_only_the_hot_user(spark):
    rows = disorder(11, 150, users=4) + [("hot", "c", 50.0, "drama", DAY0 + i * 3.0, DAY0 + i * 3.0) for i in range(200)]
    spec = wf.WindowSpec(hot_user_rows=100)
    events = frame(spark, rows)
    assert wf.hot_users(events, 100) == ["hot"]
    check(wf.feature_rows(events, F.lit(0.0), spec), simulate(rows, 600))


@pytest.mark.parametrize("hot_rows", [10_000, 60, 0])
def test_rows_without_a_user_are_one_group(spark, hot_rows):
    """Whatever the threshold, no row is lost: the null group may be the hot one."""
    rows = disorder(5, 150, users=4) + [("nobody", "c", 50.0, "drama", DAY0 + i * 3.0, DAY0 + i * 3.0) for i in range(80)]
    events = frame(spark, rows).withColumn("pseudo_user_id", F.nullif("pseudo_user_id", F.lit("nobody")))
    spec = wf.WindowSpec(hot_user_rows=hot_rows)
    got = wf.feature_rows(events, F.lit(0.0), spec)
    assert got.filter("pseudo_user_id IS NULL").count() == 80
    check(got.fillna("nobody", ["pseudo_user_id"]), simulate(rows, 600))
    assert wf.classify_late(events, spec).count() == len(rows)


def test_a_genre_beyond_the_list_is_an_error(spark):
    events = frame(spark, disorder(5, 30))
    with pytest.raises(Exception, match="not in the given list"):
        wf.feature_rows(events, F.lit(0.0), genres=["no such genre"]).collect()


def test_too_many_hot_users_to_list(spark, monkeypatch):
    monkeypatch.setattr(cfg, "MAX_LISTED_HOT_USERS", 1)
    rows = disorder(3, 120)
    events = frame(spark, rows)
    assert wf.hot_users(events, 0) is None
    check(wf.feature_rows(events, F.lit(0.0), wf.WindowSpec(hot_user_rows=0)), simulate(rows, 600))


@pytest.mark.parametrize("hot_rows", [10_000, 0])
def test_standing_high_water_mark(spark, hot_rows):
    """One event far ahead makes everything after it late for good."""
    rows = [("u", "c", 10.0, "drama", DAY0 + 1_000_000.0, DAY0 + 0.0)]
    rows += [("u", "c", float(i % 101), "drama", DAY0 + i * 10.0, DAY0 + 10.0 + i * 10.0) for i in range(100)]
    rows += [("u", "c", 40.0, "action", DAY0 + 1_000_000.0 - i, DAY0 + 2000.0 + i) for i in range(100)]
    spec = wf.WindowSpec(hot_user_rows=hot_rows)
    check(wf.feature_rows(frame(spark, rows), F.lit(0.0), spec), simulate(rows, 600))


@pytest.mark.parametrize("busy", [5, 40])
def test_bulk_load_shares_one_arrival(spark, busy):
    """All of a hot user's rows in one arrival minute, most at one instant."""
    rng = random.Random(2)
    rows = [("u", "c", round(rng.random() * 100, 1), rng.choice(["a", "b", None]), DAY0 + rng.randrange(3000), DAY0 + 1.0)
            for _ in range(150)]
    rows += [("u", "c", 20.0, "b", DAY0 + 3000.0 + i, DAY0 + 2.0 + i % 3) for i in range(50)]
    rows += [("v", "c", 20.0, "b", DAY0 + i * 90.0, DAY0 + i * 90.0) for i in range(40)]
    spec = wf.WindowSpec(hot_user_rows=0, busy_slice_rows=busy)
    check(wf.feature_rows(frame(spark, rows), F.lit(0.0), spec), simulate(rows, 600))


@pytest.mark.parametrize("busy", [1, 3, 40])
@pytest.mark.parametrize("window", [600, 86_400])
def test_pieces_of_hot_users(spark, busy, window):
    """Lives that end in their own piece, in a later one and many pieces on, on both sides of the epoch."""
    rows = [(u, c, p, g, t - DAY0 - 9_000, a) for u, c, p, g, t, a in disorder(17, 300)]
    # Seven rows a second for a minute: a window is many pieces.
    rows += [("dense", "c", i % 101 + 0.3, "ab"[i % 2], DAY0 + i / 7, DAY0 + i / 7) for i in range(400)]
    spec = wf.WindowSpec(seconds=window, hot_user_rows=0, busy_slice_rows=busy)
    events = frame(spark, rows)
    check(wf.feature_rows(events, F.lit(0.0), spec), simulate(rows, window))
    marks = lambda s: {r["arrival_seq"]: r["hwm_us"] for r in wf.mark_events(events, s).collect()}
    assert marks(spec) == marks(wf.WindowSpec(seconds=window))


@pytest.mark.parametrize("name", ["MAX_CUTS", "MAX_USER_CUTS"])
def test_fewer_cuts_than_pieces_asked_for(spark, monkeypatch, name):
    monkeypatch.setattr(cfg, name, 3)
    monkeypatch.setattr(cfg, "MAX_GENRE_COLUMNS", 2)
    rows = disorder(19, 250)
    spec = wf.WindowSpec(hot_user_rows=0, busy_slice_rows=2)
    assert max(len(r["_cuts"]) for r in wf._bounds(frame(spark, rows), 2).collect()) <= (3 if name == "MAX_USER_CUTS" else 99)
    check(wf.feature_rows(frame(spark, rows), F.lit(0.0), spec), simulate(rows, 600))


def test_wide_genres_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(cfg, "MAX_GENRE_COLUMNS", 3)
    rows = disorder(23, 200, genres=tuple(f"g{i}" for i in range(9)) + ("", None))
    spec = wf.WindowSpec(hot_user_rows=0, busy_slice_rows=4)
    check(wf.feature_rows(frame(spark, rows), F.lit(0.0), spec), simulate(rows, 600))


def _shuffled_bytes(spark, df):
    """Bytes of the shuffle files that a query leaves on local disks."""
    disks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disks.getAllFiles()
        return {f.getPath(): f.length() for f in (found.apply(i) for i in range(found.size())) if f.getName().endswith(".data")}

    before = files()
    df.write.format("noop").mode("overwrite").save()
    return sum(size for path, size in files().items() if path not in before)


def test_split_path_shuffles_each_event_once(spark):
    """Disk of the split path is of the order of the ordinary path's, not many times it."""
    rows = [(f"u{i % 97}", "c", i % 100 + 0.5, ["drama", "action", "", None][i % 4], DAY0 + i * 37.0, DAY0 + i * 37.0 + i % 5)
            for i in range(6000)]
    events = frame(spark, rows)
    specs = [wf.WindowSpec(seconds=86_400), wf.WindowSpec(seconds=86_400, hot_user_rows=0, busy_slice_rows=40)]
    plain, split = [_shuffled_bytes(spark, wf.feature_rows(events, F.lit(0.0), s)) for s in specs]
    assert 0 < split < 4 * plain


@pytest.mark.parametrize("hot_rows", [10_000, 0])
def test_vocabulary_wider_than_columns(spark, monkeypatch, hot_rows):
    """More genres than get a column: the long form gives the same vectors."""
    monkeypatch.setattr(cfg, "MAX_GENRE_COLUMNS", 3)
    rows = disorder(5, 250, genres=tuple(f"g{i}" for i in range(9)) + ("", None))
    events = frame(spark, rows)
    assert wf.distinct_genres(events, 3) is None
    spec = wf.WindowSpec(hot_user_rows=hot_rows)
    check(wf.feature_rows(events, F.lit(0.0), spec), simulate(rows, 600))


def test_before_the_epoch_the_window_is_empty(spark):
    rows = [("u", "c", 50.0, "drama", -1000.0, -1000.0), ("u", "c", 50.0, "drama", -500.0, -400.0)]
    want = simulate(rows, 600)
    assert want[0][0] == 0 and want[1][0] == 1
    for hot in (10, 0):
        check(wf.feature_rows(frame(spark, rows), F.lit(0.0), wf.WindowSpec(hot_user_rows=hot)), want)


def test_in_order_path(spark):
    rows = [("u", "c", 50.0, "drama", DAY0 + i * 100.0, DAY0 + i * 100.0) for i in range(30)]
    want = simulate(rows, 600)
    for hot in (10_000, 0):
        state = wf.window_state(frame(spark, rows), wf.WindowSpec(hot_user_rows=hot), in_order=True)
        assert {r["arrival_seq"]: r["watch_count"] for r in state.collect()} == {i: v[0] for i, v in want.items()}


N = 1_000_000.0


@pytest.mark.parametrize(
    "rows,last",
    [
        ([(50.0, N - 500, None), (30.0, N - 100, None), (70.0, N, None)], {"watch_count_10min": 3}),
        ([(100.0, N, None)], {"category_affinity_score": 0.0, "recency_score": 1.0, "session_genre_vector": "{}"}),
        ([(100.0, N, "action")], {"category_affinity_score": 1.0, "session_genre_vector": '{"action":1.0}'}),
        ([(100.0, N, "drama"), (100.0, N, "drama")], {"category_affinity_score": 1.0}),
        ([(0.0, N - 120, None), (50.0, N - 60, None), (100.0, N, None)], {"avg_watch_duration": 50.0}),
        ([(60.0, N - 1, "action"), (40.0, N, "drama")], {"session_genre_vector": '{"action":0.6,"drama":0.4}'}),
        ([(0.0, N, "drama")], {"session_genre_vector": "{}", "recency_score": 0.0, "category_affinity_score": 0.0}),
        ([(0.0, N, "drama"), (50.0, N, "action")], {"session_genre_vector": '{"action":1.0,"drama":0.0}'}),
        # An empty genre counts for affinity but not for the vector.
        ([(100.0, N, "")], {"category_affinity_score": 1.0, "session_genre_vector": "{}"}),
    ],
)
def test_hand_computed_rows(spark, rows, last):
    events = frame(spark, [("u", "c", p, g, t, t) for p, t, g in rows])
    row = wf.feature_rows(events, F.lit(0.0)).orderBy(F.desc("arrival_seq")).first()
    for name, value in last.items():
        assert row[name] == (pytest.approx(value, abs=1e-12) if isinstance(value, float) else value)


def test_decay_over_a_longer_window(spark):
    events = frame(spark, [("u", "c", 100.0, "action", N - 1000, N - 1000), ("u", "c", 0.0, "action", N, N)])
    spec = wf.WindowSpec(seconds=2000, affinity_lambda=0.001)
    row = wf.feature_rows(events, F.lit(0.0), spec).orderBy(F.desc("arrival_seq")).first()
    assert row["category_affinity_score"] == pytest.approx(math.exp(-1) / 2, abs=1e-12)


def test_late_event_does_not_move_the_window(spark):
    rows = [("u", "c1", 50.0, None, 900.0, 1.0), ("u", "c2", 50.0, None, 1000.0, 2.0), ("u", "c3", 50.0, None, 200.0, 3.0)]
    marked = {r["arrival_seq"]: r for r in wf.classify_late(frame(spark, rows)).collect()}
    assert marked[2]["hwm_us"] == 1000 * 1_000_000
    assert marked[2]["late"] and marked[2]["beyond_window"]
    assert not marked[1]["late"]
    got = {r["arrival_seq"]: r["watch_count"] for r in wf.window_state(frame(spark, rows), with_genres=False).collect()}
    assert got[2] == 2


def test_lower_edge_is_inclusive(spark):
    rows = [("u", "c", 50.0, None, t, t) for t in (100.0, 200.0, 700.0, 800.0)]
    got = {r["arrival_seq"]: r["watch_count"] for r in wf.window_state(frame(spark, rows), with_genres=False).collect()}
    assert got[3] == 3


def test_short_zone_names_are_known(spark):
    known_zones.cache_clear()
    at = 16 * 3600 * 1_000_000
    df = spark.createDataFrame([(at, "EST"), (at, "MST"), (at, "HST"), (at, "PST")], "us long, tz string")
    # 11, 9 and 6 o'clock; PST is no IANA name, so UTC.
    assert [r[0] for r in df.select(time_of_day(F.col("us"), "tz")).collect()] == ["morning"] * 3 + ["afternoon"]


@pytest.mark.parametrize(
    "when,zone,bucket",
    [
        ("2026-04-19 00:00:00", None, "night"), ("2026-04-19 02:00:00", None, "night"),
        ("2026-04-19 06:00:00", None, "morning"), ("2026-04-19 08:00:00", None, "morning"),
        ("2026-04-19 12:00:00", None, "afternoon"), ("2026-04-19 14:00:00", None, "afternoon"),
        ("2026-04-19 17:00:00", None, "evening"), ("2026-04-19 19:00:00", None, "evening"),
        ("2026-04-19 21:00:00", None, "night"),
        ("2026-04-19 16:30:00", "Asia/Kolkata", "night"), ("2026-04-19 16:30:00", None, "afternoon"),
        ("2026-07-01 06:00:00", "America/New_York", "night"), ("2026-04-19 08:00:00", "Not/ATimezone", "morning"),
        ("2026-04-19 08:00:00", "", "morning"), ("2026-04-19 08:00:00", "+05:30", "morning"),
        ("2026-04-19 16:00:00", "EST", "morning"), ("2026-04-19 08:00:00", "ROC", "afternoon"),
        ("1969-12-31 23:30:00", None, "night"), ("1969-12-31 08:30:00", None, "morning"),
    ],
)
def test_time_of_day(spark, when, zone, bucket):
    import datetime as dt

    us = int((dt.datetime.fromisoformat(when) - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    df = spark.createDataFrame([(us, zone)], "us long, tz string")
    for session_zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        try:
            assert df.select(time_of_day(F.col("us"), "tz")).first()[0] == bucket
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_ordinary_path_shuffles_the_events_once(spark, sf_dir):
    from pulsefeed.sources import adapters as ad

    rows = wf.feature_rows(ad.watch_events(spark, sf_dir), F.lit(0.0), genres=["action", "drama"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert _exchanges(rows) == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_arrival_columns_survive(spark, sf_dir):
    from pulsefeed.sources import adapters as ad

    assert wf.feature_rows(ad.watch_events(spark, sf_dir), F.lit(0.0)).columns[-2:] == ARRIVAL
