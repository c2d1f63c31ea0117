import datetime as dt
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from pulsefeed.functions import times
from pulsefeed.functions.pseudonym import pseudonymize
from pulsefeed.functions.times import epoch_us, local_event_date, parse_iso
from pulsefeed.operators import ingest
from pulsefeed.schemas import SESSION_INPUT, WATCH_INPUT
from pulsefeed.sources import messages

OK = {"user_id": "u", "content_id": "c", "watch_pct": "50.0", "timestamp": "2026-04-19T10:00:00Z"}


def watch(spark, **change):
    row = {**OK, **change}
    return spark.createDataFrame([tuple(row.get(c) for c in WATCH_INPUT.fieldNames())], WATCH_INPUT)


@pytest.mark.parametrize(
    "change,reason",
    [
        ({}, None), ({"watch_pct": "0.0"}, None), ({"watch_pct": "100.0"}, None), ({"watch_pct": "75"}, None),
        ({"watch_pct": "-1.0"}, "watch_pct_out_of_range"), ({"watch_pct": "100.1"}, "watch_pct_out_of_range"),
        ({"watch_pct": "150.0"}, "watch_pct_out_of_range"), ({"watch_pct": "NaN"}, "watch_pct_out_of_range"),
        ({"watch_pct": "abc"}, "watch_pct_not_a_number"),
        ({"user_id": None}, "missing_user_id"), ({"content_id": None}, "missing_content_id"),
        ({"watch_pct": None}, "missing_watch_pct"), ({"timestamp": None}, "missing_timestamp"),
        ({"timestamp": "not-a-date"}, "bad_timestamp"), ({"timestamp": "2026-13-01T00:00:00Z"}, "bad_timestamp"),
    ],
)
def test_watch_boundary(spark, change, reason):
    checked = ingest.check_watch(watch(spark, **change))
    assert checked.first()[ingest.REASON] == reason
    assert ingest.accepted(checked).count() + ingest.rejected(checked).count() == 1


@pytest.mark.parametrize(
    "row,reason",
    [
        (("u", "s", "tv", "2026-04-19T10:00:00Z"), None),
        (("u", None, "tv", "2026-04-19T10:00:00Z"), "missing_session_id"),
        (("u", "s", None, "2026-04-19T10:00:00Z"), "missing_device"),
        (("u", "s", "tv", "soon"), "bad_start_time"),
    ],
)
def test_session_boundary(spark, row, reason):
    assert ingest.check_session(spark.createDataFrame([row], SESSION_INPUT)).first()[ingest.REASON] == reason


@pytest.mark.parametrize("secret", ["s", "k" * 64, "k" * 65, "schlüssel"])
def test_pseudonym_is_hmac_sha256(spark, secret):
    ids = ["", "user-1", "ünïcode-用户", "x" * 500]
    df = spark.createDataFrame([(i,) for i in ids], "id string").select("id", pseudonymize(F.col("id"), secret).alias("p"))
    for r in df.collect():
        assert r["p"] == hmac.new(secret.encode(), r["id"].encode(), hashlib.sha256).hexdigest()


def test_raw_id_does_not_leave_the_boundary(spark):
    payload = ingest.watch_payload(watch(spark, user_id="raw-secret-id"), "k")
    assert "user_id" not in payload.columns
    out = messages.keyed_messages(payload).first()
    assert "raw-secret-id" not in out["value"] and len(out["key"]) == 64
    assert f'"pseudo_user_id":"{out["key"]}"' in out["value"]
    assert '"genre":null' in out["value"]
    session = ingest.session_payload(
        spark.createDataFrame([("raw-secret-id", "s", "tv", "2026-04-19T10:00:00Z")], SESSION_INPUT), "k"
    )
    assert "raw-secret-id" not in str(session.first())


GOOD = '{"pseudo_user_id":"t","content_id":"m","watch_pct":75.0,"timestamp":"2026-04-19T10:00:00Z","genre":"action"}'


@pytest.mark.parametrize(
    "text,reason",
    [
        (GOOD, None),
        ("not json", "not_json"), ("", "not_json"), ("[1, 2]", "not_an_object"), ("42", "not_an_object"),
        ('"text"', "not_an_object"), ("null", "not_an_object"),
        (GOOD.replace('"pseudo_user_id":"t",', ""), "missing_field"),
        (GOOD.replace('"content_id":"m",', ""), "missing_field"),
        (GOOD.replace('"watch_pct":75.0,', ""), "missing_field"),
        (GOOD.replace('"timestamp":"2026-04-19T10:00:00Z",', ""), "missing_field"),
        (GOOD.replace('"t"', "null"), "null_key"),
        (GOOD.replace('"m"', "null"), None),
        (GOOD.replace("75.0", '"75"'), "bad_watch_pct"), (GOOD.replace("75.0", "true"), "bad_watch_pct"),
        (GOOD.replace("75.0", "null"), "bad_watch_pct"), (GOOD.replace("75.0", "-1"), "bad_watch_pct"),
        (GOOD.replace("75.0", "101"), "bad_watch_pct"), (GOOD.replace("75.0", "75"), None),
        (GOOD.replace("75.0", "0"), None), (GOOD.replace("75.0", "100"), None), (GOOD.replace("75.0", "1e2"), None),
        (GOOD.replace("2026-04-19T10:00:00Z", "yesterday"), "bad_timestamp"),
        (GOOD.replace('"2026-04-19T10:00:00Z"', "1776592800"), "bad_timestamp"),
        (GOOD.replace('"2026-04-19T10:00:00Z"', "null"), "bad_timestamp"),
        (GOOD.replace("2026-04-19T10:00:00Z", "20260419T100000Z"), None),
        (GOOD.replace("2026-04-19T10:00:00Z", "2026-02-30T10:00:00Z"), "bad_timestamp"),
        (GOOD.replace("Z", ""), None),
    ],
)
def test_message_parser(spark, text, reason):
    df = spark.createDataFrame([(text,)], "value string")
    assert ingest.check_messages(df).first()[ingest.REASON] == reason
    assert ingest.parse_messages(df).count() == (reason is None)


def test_bare_nan_is_dropped(spark):
    df = spark.createDataFrame([(GOOD.replace("75.0", "NaN"),)], "value string")
    assert ingest.parse_messages(df).count() == 0


def test_event_date_is_local_to_the_offset(spark):
    text = GOOD.replace("2026-04-19T10:00:00Z", "2026-05-01T23:30:00-05:00")
    row = ingest.parse_messages(spark.createDataFrame([(text,)], "value string")).first()
    assert row["event_date"] == "2026-05-01"
    assert row["event_us"] == 1_777_696_200_000_000  # 2026-05-02T04:30:00Z


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_iso_forms(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = [
            "2026-05-01", "2026-05-01T10", "2026-05-01T10:30", "2026-05-01 10:30:15", "2026-05-01T10:30:15.5Z",
            "2026-05-01T10:30:15,25+02:00", "2026-05-01T10:30:15.123456789Z",
        ]
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [r[0] for r in df.select(epoch_us(parse_iso(F.col("t")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    day = 1_777_593_600_000_000
    h, m, s = 3_600_000_000, 60_000_000, 1_000_000
    assert got == [
        day, day + 10 * h, day + 10 * h + 30 * m, day + 10 * h + 30 * m + 15 * s,
        day + 10 * h + 30 * m + 15 * s + 500_000, day + 8 * h + 30 * m + 15 * s + 250_000,
        day + 10 * h + 30 * m + 15 * s + 123_456,
    ]


def test_every_form_reads_as_the_standard_library_reads_it(spark):
    dates = ["2026-05-01", "20260501", "2026-W18-5", "2026W185", "2026-W18", "2026-02-30", "2026-W54-1", "2026-W53-1", "2027-W53-1", "2026-W00-1"]
    clocks = ["", "T10", "T10:05", "T10:05:07", "T1005", "T100507", "T10:05:07.25", "T100507,123456", " 10:05", "T25:00"]
    offsets = ["", "Z", "+05", "+0530", "-05:30", "+05:30:15"]
    forms = [d + c + (o if c else "") for d in dates for c in clocks for o in offsets]
    df = spark.createDataFrame([(f,) for f in sorted(set(forms))], "stamp string")
    got = df.select("stamp", epoch_us(parse_iso(F.col("stamp"))).alias("us"), local_event_date(F.col("stamp")).alias("day")).collect()
    for r in got:
        try:
            want = dt.datetime.fromisoformat(r["stamp"])
        except ValueError:
            assert r["us"] is None, r["stamp"]
            continue
        day = want.date().isoformat()
        want = want if want.tzinfo else want.replace(tzinfo=dt.timezone.utc)
        assert (r["us"], r["day"]) == ((want - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1), day), r["stamp"]


def test_unix_times_at_the_boundary(spark):
    from pulsefeed.functions.times import parse_boundary_time

    df = spark.createDataFrame([("1704067200",), ("1704067200.5",), ("1704067200000",), ("20240101",), ("x1",), (None,)], "t string")
    got = [r[0] for r in df.select(epoch_us(parse_boundary_time(F.col("t")))).collect()]
    at = 1704067200_000_000
    assert got == [at, at + 500_000, at, at, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("text,published", [
    ("2026-05-01T10:00:00Z", "2026-05-01T10:00:00Z"), ("2026-05-01 10:00:00,25", "2026-05-01T10:00:00.25"),
    ("20260501T100000+0530", "2026-05-01T10:00:00+05:30"), ("2026-W18-5T10Z", "2026-05-01T10:00:00Z"),
    ("2026-05-01T10:00:00-05:30:15", "2026-05-01T10:00:00-05:30:15"), ("1777629600", "2026-05-01T10:00:00.000000+00:00"),
    ("1777629600.5", "2026-05-01T10:00:00.500000+00:00"), ("1777629600123", "2026-05-01T10:00:00.123000+00:00"),
    ("-1.5", "1969-12-31T23:59:58.500000+00:00"), ("20260501", "2026-05-01T00:00:00"), ("2026-05-01T10+01", "2026-05-01T10:00:00+01:00"),
])
def test_times_are_published_in_one_form_and_read_back(spark, zone, text, published):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        t = spark.createDataFrame([(text,)], "t string")
        got = t.select(
            times.iso_text(F.col("t")).alias("out"), times.epoch_us(times.parse_boundary_time(F.col("t"))).alias("at"),
            times.epoch_us(times.parse_iso(times.iso_text(F.col("t")))).alias("back"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got["out"] == published and got["at"] == got["back"] is not None


def test_publish_and_read_back(spark, tmp_path):
    payload = ingest.watch_payload(watch(spark, genre="drama"), "k").withColumns(
        {"arrival_us": F.lit(5).cast("bigint"), "arrival_seq": F.lit(1).cast("bigint")}
    )
    fields = [c for c in payload.columns if not c.startswith("arrival")]
    messages.publish_batch(payload, str(tmp_path / "topic"), fields)
    stream = ingest.parse_messages(messages.file_messages(spark, str(tmp_path / "topic")))
    q = stream.writeStream.format("memory").queryName("parsed").trigger(availableNow=True).start()
    q.awaitTermination(120)
    row = spark.table("parsed").first()
    assert (row["genre"], row["watch_pct"], row["arrival_us"], row["arrival_seq"]) == ("drama", 50.0, 5, 1)


def test_stream_publishes_keyed_messages(spark, tmp_path):
    ingest.watch_payload(watch(spark, genre="drama"), "k").coalesce(1).write.json(str(tmp_path / "in"))
    schema = "pseudo_user_id string, content_id string, watch_pct double, timestamp string, genre string, timezone string"
    payload = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    for _ in range(2):  # a restart publishes nothing twice
        q = messages.publish_stream(payload, str(tmp_path / "cp"), path=str(tmp_path / "topic")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    rows = spark.read.json(str(tmp_path / "topic")).collect()
    assert len(rows) == 1 and rows[0]["key"] in rows[0]["value"]
    parsed = ingest.parse_messages(spark.createDataFrame([(rows[0]["value"],)], "value string"))
    assert parsed.first()["genre"] == "drama"
