"""Named queries: every operator over the whole interaction tables.

Floating-point results are rounded to six decimals so that engines summing in a
different order agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsefeed import settings as cfg
from pulsefeed.functions.pseudonym import pseudonymize
from pulsefeed.functions.times import epoch_us, local_event_date, parse_iso, time_of_day
from pulsefeed.operators import consent as co
from pulsefeed.operators import dedup, ingest, matrix, monitor, online, recommend, registry, retention
from pulsefeed.operators import evaluation as ev
from pulsefeed.operators import window_features as wf
from pulsefeed.sources import adapters as ad
from pulsefeed.sources import feature_log as log
from pulsefeed.sources.messages import keyed_messages

Query = Callable[[SparkSession, str], DataFrame]

USER = "pseudo_user_id"
# Parameters of the queries (the reference point in time of each report).
ONLINE_AS_OF = 1_706_702_400.0  # 2024-01-31 12:00:00 UTC
SERVING_TTL = 86_400
TRAIN_AS_OF = "2024-01-28"
TRAIN_FROM = "2023-12-29"
AUDIT_AS_OF = "2024-01-30"
PROMOTION_MINIMUMS = {"auc": 0.7, "precision_at_10": 0.5}
DAY_WINDOW = 86_400
WIDE_GENRES = 80
SPARSE_GENRES = 5_000
SPARSE_VOCABULARY = 4_000
MEAN = "_mean"
CATALOG_GENRES = sorted({genre for _, genre, _ in cfg.CATALOG})

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _spec(seconds: int = cfg.WINDOW_SECONDS) -> wf.WindowSpec:
    return wf.WindowSpec(seconds=seconds)


def _state(spark: SparkSession, sf: str, seconds: int = cfg.WINDOW_SECONDS, with_genres: bool = False) -> DataFrame:
    return wf.window_state(
        ad.watch_events(spark, sf), _spec(seconds), with_genres=with_genres
    )


def _rows(spark: SparkSession, sf: str, seconds: int = cfg.WINDOW_SECONDS) -> DataFrame:
    return wf.feature_rows(ad.watch_events(spark, sf), ad.computed_at(), _spec(seconds))


def _training(spark: SparkSession, sf: str) -> DataFrame:
    """Feature rows of the training range, deduplicated, scores rounded; ``MEAN`` is the mean as it was computed."""
    return _training_rows(_rows(spark, sf))


def _training_rows(rows: DataFrame) -> DataFrame:
    rows = dedup.dedup_feature_rows(log.rows_in_range(rows, TRAIN_FROM, TRAIN_AS_OF)).withColumn(MEAN, F.col("avg_watch_duration"))
    return rows.withColumns({c: r6(c) for c in ("category_affinity_score", "avg_watch_duration", "recency_score")})


_held: list[DataFrame] = []


def _hold(rows: DataFrame) -> DataFrame:
    """Rows that a query reads twice, kept until the next query holds some: features are computed once."""
    while _held:
        old = _held.pop()
        if old.sparkSession.sparkContext._jsc is not None:
            old.unpersist()
    _held.append(rows.persist(StorageLevel.MEMORY_AND_DISK))
    return _held[0]


def _training_cutoff(spark: SparkSession, sf: str) -> str:
    """Split date from the events: every event has a row of its own date, so no features are computed."""
    dates = ad.watch_events(spark, sf).select("event_date")
    return matrix.find_cutoff(log.rows_in_range(dates, TRAIN_FROM, TRAIN_AS_OF))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Training rows with a stand-in score and their split."""
    return _training(spark, sf).select(
        USER,
        "last_event_epoch",
        F.round(0.6 * F.col("recency_score") + 0.4 * F.col("category_affinity_score"), 4).alias("score"),
        "recency_score",
        "category_affinity_score",
        matrix.label(mean=MEAN).alias(cfg.LABEL),
        matrix.split_column(F.lit(_training_cutoff(spark, sf))).alias("split"),
    )


def _latest(spark: SparkSession, sf: str, ttl: int = cfg.ONLINE_TTL_SECONDS) -> DataFrame:
    return online.latest_rows(_rows(spark, sf), ttl)


def _feature_view(rows: DataFrame, *keep: str) -> DataFrame:
    """Comparable form of feature rows: rounded floats, genre shares as integer millionths."""
    shares = F.from_json("session_genre_vector", "map<string,double>")
    text = F.array_join(
        F.transform(
            F.map_entries(shares),
            lambda e: F.concat(e["key"], F.lit(":"), F.round(e["value"] * 1_000_000.0, 0).cast("bigint").cast("string")),
        ),
        ",",
    )
    return rows.select(
        USER,
        *keep,
        "watch_count_10min",
        r6("category_affinity_score").alias("category_affinity_score"),
        r6("avg_watch_duration").alias("avg_watch_duration"),
        "time_of_day_bucket",
        r6("recency_score").alias("recency_score"),
        text.alias("genre_shares"),
        r6("last_event_epoch").alias("last_event_epoch"),
        r6("computed_at_epoch").alias("computed_at_epoch"),
        "event_date",
    )


# --- ingest ------------------------------------------------------------------------


@query
def validate_watch_valid(spark, sf):
    valid = ingest.accepted(ingest.check_watch(ad.raw_watch_input(spark, sf)))
    payload = ingest.watch_payload(valid, cfg.pseudonym_secret(), ["event_id"])
    return payload.select("event_id", USER, "content_id", "watch_pct", "timestamp")


@query
def validate_watch_rejects(spark, sf):
    return ingest.rejects_by_reason(ingest.check_watch(ad.raw_watch_input(spark, sf)))


@query
def validate_session(spark, sf):
    checked = ingest.check_session(ad.session_input(spark, sf))
    return checked.groupBy(F.coalesce(ingest.REASON, F.lit("valid")).alias("outcome"), "device").agg(
        F.count("*").alias("n")
    )


@query
def sessions_per_device(spark, sf):
    valid = ingest.accepted(ingest.check_session(ad.session_input(spark, sf)))
    return ingest.sessions_per_device(ingest.session_payload(valid, cfg.pseudonym_secret()))


@query
def parse_watch_json(spark, sf):
    parsed = ingest.parse_messages(ad.raw_messages(spark, sf))
    return parsed.select("event_id", USER, "content_id", "watch_pct", "genre", "event_us", "event_date")


@query
def rejects_by_reason(spark, sf):
    return ingest.rejects_by_reason(ingest.check_messages(ad.raw_messages(spark, sf)))


@query
def boundary_to_parser(spark, sf):
    """Events with times of every accepted form, published by the boundary and read back by the message parser."""
    valid = ingest.accepted(ingest.check_watch(ad.raw_watch_input(spark, sf, ad.boundary_stamps())))
    payload = ingest.watch_payload(valid, cfg.pseudonym_secret(), ["event_id"])
    fields = [c for c in payload.columns if c != "event_id"]
    messages = keyed_messages(payload, fields=fields).select("event_id", "value")
    return ingest.parse_messages(messages).select("event_id", USER, "watch_pct", "event_us", "event_date")


@query
def iso_forms(spark, sf):
    """Event times written in every form of ISO-8601, read back as instant and local date."""
    form, at = F.col("event_id") % 12, F.timestamp_seconds(F.floor(F.col("t_us") / 1_000_000))
    text = lambda pattern: F.date_format(at, pattern)
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), at).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(at).cast("string"), 2, "0"))
    day = (F.weekday(at) + 1).cast("string")
    forms = [
        text("yyyy-MM-dd'T'HH:mm:ss'Z'"), text("yyyyMMdd'T'HHmmss"), text("yyyy-MM-dd'T'HH:mm:ss'+0530'"),
        text("yyyy-MM-dd'T'HH:mm:ss'+05'"), text("yyyy-MM-dd'T'HH:mm:ss'-05:30:15'"), text("yyyyMMdd HH:mm:ss,25'Z'"),
        F.concat(week, F.lit("-"), day, text("'T'HH:mm:ss")), F.concat(F.translate(week, "-", ""), day, text("'T'HHmmss'Z'")),
        F.concat(week, F.lit("")), text("yyyy-MM-dd'T'HH"), text("yyyy-MM-dd'T'HHmm'+01:00'"), F.concat(F.substring(week, 1, 4), F.lit("-W54-1")),
    ]
    stamp = F.element_at(F.array(*forms), (form + 1).cast("int"))
    events = ad.read_events(spark, sf).select("event_id", stamp.alias("stamp"))
    return events.select(
        "event_id", epoch_us(parse_iso(F.col("stamp"))).alias("at_us"), local_event_date(F.col("stamp")).alias("local_date")
    )


@query
def event_date_local(spark, sf):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("-05:00"))
    events = ad.read_events(spark, sf).withColumn("text", text)
    return events.groupBy(local_event_date(F.col("text")).alias("event_date")).agg(
        F.count("*").alias("n"),
        F.min(epoch_us(parse_iso(F.col("text")))).alias("first_us"),
        F.max(epoch_us(parse_iso(F.col("text")))).alias("last_us"),
    )


@query
def pseudonymize_users(spark, sf):
    ids = ad.read_events(spark, sf).select("user_id").distinct()
    return ids.select("user_id", pseudonymize(F.col("user_id"), cfg.pseudonym_secret()).alias(USER))


# --- window features -----------------------------------------------------------------


@query
def user_high_water_mark(spark, sf):
    marked = wf.mark_events(ad.watch_events(spark, sf), _spec())
    return marked.select(USER, "arrival_seq", "event_us", "hwm_us")


@query
def late_events(spark, sf):
    flagged = wf.classify_late(ad.watch_events(spark, sf), _spec())
    return flagged.groupBy("event_date").agg(
        F.count("*").alias("n"),
        F.sum(F.col("late").cast("bigint")).alias("late"),
        F.sum(F.col("beyond_window").cast("bigint")).alias("beyond_window"),
    )


@query
def window_membership_counts(spark, sf):
    state = _state(spark, sf, DAY_WINDOW)
    return state.groupBy("watch_count").agg(F.count("*").alias("n_events"))


@query
def watch_count_inorder(spark, sf):
    # Arrival as the event time: a stream without late events.
    events = ad.watch_events(spark, sf).withColumn("arrival_us", F.col("event_us"))
    state = wf.window_state(events, _spec(DAY_WINDOW), in_order=True, with_genres=False)
    return state.select(USER, "arrival_seq", "watch_count")


@query
def watch_count_10min(spark, sf):
    return _state(spark, sf).select(USER, "arrival_seq", F.col("watch_count").cast("int").alias("watch_count_10min"))


@query
def avg_watch_duration(spark, sf):
    return _state(spark, sf, DAY_WINDOW).select(
        USER, "arrival_seq", r6("avg_watch_duration").alias("avg_watch_duration")
    )


@query
def recency_score(spark, sf):
    return _state(spark, sf, DAY_WINDOW).select(USER, "arrival_seq", r6("recency_score").alias("recency_score"))


@query
def category_affinity_score(spark, sf):
    return _state(spark, sf, DAY_WINDOW).select(
        USER, "arrival_seq", r6("category_affinity_score").alias("category_affinity_score")
    )


@query
def genre_weights(spark, sf):
    weights = wf.genre_weights(ad.watch_events(spark, sf), _spec(DAY_WINDOW))
    return weights.select(USER, "arrival_seq", "genre", r6("weight").alias("weight"))


@query
def session_genre_distribution(spark, sf):
    weights = wf.genre_weights(ad.watch_events(spark, sf), _spec(DAY_WINDOW))
    return weights.filter(F.col("share").isNotNull()).select(USER, "arrival_seq", "genre", r6("share").alias("share"))


@query
def time_of_day_bucket(spark, sf):
    return ad.watch_events(spark, sf).select(
        "arrival_seq", time_of_day(F.col("event_us"), "timezone").alias("time_of_day_bucket")
    )


@query
def user_features(spark, sf):
    return _feature_view(_rows(spark, sf), "arrival_seq")


@query
def user_features_day(spark, sf):
    return _feature_view(_rows(spark, sf, DAY_WINDOW), "arrival_seq")


@query
def user_features_split(spark, sf):
    """Every user on the split path, one row in eleven without a user."""
    users = F.when(F.col("arrival_seq") % 11 != 0, F.col(USER))
    events = ad.watch_events(spark, sf).withColumn(USER, users)
    rows = wf.feature_rows(events, ad.computed_at(), wf.WindowSpec(seconds=DAY_WINDOW, hot_user_rows=0, busy_slice_rows=40))
    return _feature_view(rows, "arrival_seq")


@query
def user_features_wide_genres(spark, sf):
    """More genres than columns are made for."""
    wide = F.concat(F.lit("g"), (F.col("arrival_seq") % WIDE_GENRES).cast("string"))
    events = ad.watch_events(spark, sf).withColumn("genre", F.when(F.col("genre") != "", wide).otherwise(F.col("genre")))
    return _feature_view(wf.feature_rows(events, ad.computed_at(), _spec(DAY_WINDOW)), "arrival_seq")


# --- stores --------------------------------------------------------------------------


@query
def feature_log_partitions(spark, sf):
    return log.partition_counts(_rows(spark, sf))


@query
def training_rows_in_range(spark, sf):
    rows = log.rows_in_range(_rows(spark, sf), TRAIN_FROM, TRAIN_AS_OF)
    return rows.groupBy("event_date").agg(
        F.count("*").alias("n"), r6(F.sum("recency_score")).alias("recency_sum")
    )


@query
def dedup_feature_rows(spark, sf):
    # A replay: every row again with a later compute time, two in three of them a third time.
    delay = F.explode(
        F.when(F.col("arrival_seq") % 3 != 0, F.array(F.lit(0.0), F.lit(60.0), F.lit(60.0)))
        .otherwise(F.array(F.lit(0.0), F.lit(60.0)))
    )
    replayed = _rows(spark, sf).withColumn("_delay", delay).withColumn(
        "computed_at_epoch", F.col("computed_at_epoch") + F.col("_delay")
    )
    return _feature_view(dedup.dedup_feature_rows(replayed.drop("_delay")), "arrival_seq")


@query
def online_features_latest(spark, sf):
    latest = _latest(spark, sf)
    return _feature_view(latest.withColumn("expires_at", r6("expires_at")), "expires_at")


@query
def online_features_decoded(spark, sf):
    stored = online.encode_hash(online.live(_latest(spark, sf, SERVING_TTL), F.lit(ONLINE_AS_OF)))
    # One user in three has damaged numbers in the store.
    bad = F.conv(F.substring(USER, 1, 6), 16, 10).cast("bigint") % 3 == 0
    damaged = F.map_from_arrays(
        F.array(F.lit("watch_count_10min"), F.lit("recency_score")), F.array(F.lit("n/a"), F.lit("oops"))
    )
    merged = F.map_zip_with("fields", damaged, lambda k, a, b: F.when(bad, F.coalesce(b, a)).otherwise(a))
    decoded = online.decode_hash(stored.withColumn("fields", merged))
    return decoded.select(
        "key", USER, "watch_count_10min", r6("avg_watch_duration").alias("avg_watch_duration"),
        r6("recency_score").alias("recency_score"), "time_of_day_bucket", "event_date",
    )


@query
def cold_start_users(spark, sf):
    return online.cold_start(ad.users(spark, sf), _latest(spark, sf), F.lit(ONLINE_AS_OF))


@query
def features_as_of_request(spark, sf):
    # A user is hot by writes and requests together.
    both = ad.watch_events(spark, sf).select(USER).unionByName(ad.recommendation_requests(spark, sf).select(USER))
    return _as_of(spark, sf, wf.hot_users(both, cfg.HOT_USER_ROWS))


@query
def features_as_of_split(spark, sf):
    """Every user's time axis cut into hours, and hours of more than a few rows again."""
    return _as_of(spark, sf, None, busy_rows=3)


def _as_of(spark, sf, hot: list[str] | None, **rule) -> DataFrame:
    rows = _rows(spark, sf).withColumn("written_us", (F.col("computed_at_epoch") * 1_000_000.0).cast("bigint"))
    found = online.features_as_of(ad.recommendation_requests(spark, sf), rows, SERVING_TTL, hot, **rule)
    return found.select(
        "request_id", USER, "has_features", "watch_count_10min",
        r6("last_event_epoch").alias("last_event_epoch"), r6("avg_watch_duration").alias("avg_watch_duration"),
    )


# --- consent ---------------------------------------------------------------------------


@query
def consent_current(spark, sf):
    now = co.current_consent(ad.consent_changes(spark, sf))
    return now.select("user_pseudo_id", "consent_granted", epoch_us(F.col("updated_at")).alias("updated_us"))


@query
def consent_audit_log(spark, sf):
    entries = co.audit_entries(ad.consent_changes(spark, sf))
    return entries.select("id", "user_pseudo_id", "action", epoch_us(F.col("timestamp")).alias("at_us"), "reason")


@query
def consent_audit_mismatch(spark, sf):
    changes = ad.consent_changes(spark, sf)
    bad = co.audit_mismatch(co.current_consent(changes), co.audit_entries(changes))
    return bad.agg(F.count("*").alias("mismatches"))


@query
def consent_gate(spark, sf):
    gate = co.consent_gate(ad.users(spark, sf), co.current_consent(ad.consent_changes(spark, sf)), USER)
    return gate.select(USER, "granted")


@query
def audit_history(spark, sf):
    entries = co.audit_entries(ad.consent_changes(spark, sf))
    return co.audit_history(entries).select(
        "user_pseudo_id", epoch_us(F.col("timestamp")).alias("at_us"), "action", "id"
    )


@query
def consent_revocations(spark, sf):
    return co.revocations(co.audit_entries(ad.consent_changes(spark, sf)))


@query
def audit_month_bounds(spark, sf):
    months = retention.with_month(co.audit_entries(ad.consent_changes(spark, sf))).select(retention.MONTH).distinct()
    return retention.month_bounds(months)


@query
def audit_expired_months(spark, sf):
    entries = co.audit_entries(ad.consent_changes(spark, sf))
    return retention.expired_months(entries, F.lit(AUDIT_AS_OF).cast("date"))


@query
def audit_retained(spark, sf):
    entries = co.audit_entries(ad.consent_changes(spark, sf))
    kept = retention.retained(entries, F.lit(AUDIT_AS_OF).cast("date"))
    return kept.groupBy(retention.MONTH, "action").agg(F.count("*").alias("entries"))


@query
def consent_after_retention(spark, sf):
    changes = ad.consent_changes(spark, sf)
    kept = retention.retained(co.audit_entries(changes), F.lit(AUDIT_AS_OF).cast("date"))
    in_log = kept.groupBy("user_pseudo_id").agg(F.count("*").alias("kept_entries"))
    # The snapshot is its own table: users whose whole history expired keep their decision.
    return co.current_consent(changes).join(in_log, "user_pseudo_id", "left").select(
        "user_pseudo_id", "consent_granted", F.coalesce("kept_entries", F.lit(0).cast("bigint")).alias("kept_entries")
    )


# --- training ---------------------------------------------------------------------------


@query
def known_genres(spark, sf):
    train = _training(spark, sf).filter(F.col("event_date") < _training_cutoff(spark, sf))
    return matrix.genre_keys(train)


@query
def split_cutoff(spark, sf):
    rows = log.rows_in_range(ad.watch_events(spark, sf).select("event_date"), TRAIN_FROM, TRAIN_AS_OF)
    return matrix.split_cutoff(rows)


@query
def split_stats(spark, sf):
    stats = matrix.split_stats(_training(spark, sf), _training_cutoff(spark, sf), mean=MEAN)
    return stats.withColumn("positive_rate", r6("positive_rate"))


@query
def chronological_split(spark, sf):
    cutoff = F.lit(_training_cutoff(spark, sf))
    rows = _training(spark, sf).select("event_date", matrix.split_column(cutoff).alias("split"))
    return rows.groupBy("split", "event_date").agg(F.count("*").alias("n"))


def _train_genres(training: DataFrame, spark, sf) -> list[str]:
    return matrix.known_genres(training.filter(F.col("event_date") < _training_cutoff(spark, sf)))


@query
def genre_matrix(spark, sf):
    training = _hold(_training(spark, sf))
    genres = _train_genres(training, spark, sf)
    rows = training.select(USER, r6("last_event_epoch").alias("last_event_epoch"), *matrix.genre_columns(genres))
    return rows.select(USER, "last_event_epoch", *[r6(F.col(f"`genre_{g}`")).alias(f"genre_{g}") for g in genres])


@query
def time_bucket_index(spark, sf):
    return _training(spark, sf).groupBy("time_of_day_bucket", matrix.time_bucket_index().alias("idx")).agg(
        F.count("*").alias("n")
    )


@query
def engaged_label(spark, sf):
    return _training(spark, sf).select(
        USER, r6("last_event_epoch").alias("last_event_epoch"), matrix.label(mean=MEAN).alias(cfg.LABEL)
    )


@query
def feature_matrix(spark, sf):
    training = _hold(_training(spark, sf))
    genres = _train_genres(training, spark, sf)
    x = matrix.feature_matrix(training, genres, keep=[USER, "last_event_epoch"], mean=MEAN)
    floats = [c for c, t in x.dtypes if t == "double"]
    return x.select([r6(F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`") for c in x.columns])


@query
def feature_matrix_sparse(spark, sf):
    """Thousands of genres in one sparse column; the vocabulary is bounded by how many training rows hold a genre."""
    wide = F.concat(F.lit("g"), F.lpad((F.col("arrival_seq") * 7 % SPARSE_GENRES).cast("string"), 4, "0"))
    events = ad.watch_events(spark, sf).withColumn("genre", F.when(F.col("genre") != "", wide).otherwise(F.col("genre")))
    training = _hold(_training_rows(wf.feature_rows(events, ad.computed_at(), _spec())))
    train = training.filter(F.col("event_date") < _training_cutoff(spark, sf))
    x = matrix.sparse_matrix(training, matrix.known_genres(train, SPARSE_VOCABULARY), keep=[USER, "last_event_epoch"], mean=MEAN)
    weights = F.col("genre_weights")
    millionths = F.transform(weights["values"], lambda v: F.round(v * 1_000_000.0, 0).cast("bigint").cast("string"))
    return x.select(
        USER, r6("last_event_epoch").alias("last_event_epoch"), "watch_count_10min", "time_of_day_index", cfg.LABEL,
        weights["size"].alias("size"),
        F.array_join(weights["indices"].cast("array<string>"), ",").alias("indices"), F.array_join(millionths, ",").alias("millionths"),
    )


@query
def schema_contract_rows(spark, sf):
    train = _hold(_training(spark, sf)).filter(F.col("event_date") < _training_cutoff(spark, sf))
    contract = matrix.schema_contract(matrix.known_genres(train))
    features = F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(f["name"]).alias("name"), F.lit(f["dtype"]).alias("dtype"))
        for i, f in enumerate(contract["features"])
    ])
    # The contract next to what the training rows hold for it.
    return train.agg(F.count("*").alias("train_rows")).select("train_rows", F.inline(features))


@query
def serving_vectors(spark, sf):
    rows = _hold(_rows(spark, sf))
    contract = matrix.schema_contract(_train_genres(_training_rows(rows), spark, sf))
    latest = online.latest_rows(rows, cfg.ONLINE_TTL_SECONDS)
    # One user in four lacks its bucket and count, as after a partial write.
    gap = F.conv(F.substring(USER, 1, 6), 16, 10).cast("bigint") % 4 == 0
    holes = latest.withColumns(
        {c: F.when(~gap, F.col(c)) for c in ("time_of_day_bucket", "watch_count_10min", "recency_score")}
    )
    x = matrix.serving_vectors(holes, contract, keep=[USER])
    floats = [c for c, t in x.dtypes if t == "double"]
    return x.select([r6(F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`") for c in x.columns])


@query
def auc_score(spark, sf):
    result = ev.auc(_scored(spark, sf).filter(F.col("split") == "validation"))
    return result.withColumn("auc", r6("auc"))


@query
def precision_at_k(spark, sf):
    validation = _scored(spark, sf).filter(F.col("split") == "validation")
    best = ev.precision_at_k(validation, [USER, "last_event_epoch"])
    return best.withColumn("precision_at_k", r6("precision_at_k"))


@query
def score_histogram(spark, sf):
    return ev.score_histogram(_scored(spark, sf), by=["split"])


@query
def feature_drift(spark, sf):
    rows = _scored(spark, sf)
    names = ["recency_score", "category_affinity_score", "score"]
    values = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("x")) for n in names]))
    long = rows.select("split", values.alias("f")).select("split", "f.feature", "f.x")
    histogram = ev.score_histogram(long, score="x", by=["feature", "split"])
    psi = ev.stability_index(histogram, "split", "train", "validation", ["feature"])
    return psi.withColumn("psi", r6("psi"))


@query
def registry_alias_current(spark, sf):
    return registry.current_aliases(ad.model_assignments(spark, sf))


@query
def registry_resolve(spark, sf):
    return registry.resolve(ad.model_assignments(spark, sf))


@query
def promotion_candidates(spark, sf):
    return registry.promotion_candidates(ad.model_assignments(spark, sf), PROMOTION_MINIMUMS).select(
        "name", "version", "alias", "auc", "precision_at_10"
    )


# --- recommendations ----------------------------------------------------------------------


def _engagement() -> Column:
    """Stand-in for a model: a probability from the row itself."""
    return F.col("avg_watch_duration") / 100.0


@query
def trending_items(spark, sf):
    feed = recommend.resolve_trending(recommend.trending_frame(spark), recommend.catalog_frame(spark))
    views = ad.watch_events(spark, sf).groupBy("content_id").agg(F.count("*").alias("views"))
    # The feed is the configured list: a handful of rows.
    return views.join(F.broadcast(feed), "content_id").select(
        "feed_pos", "content_id", "genre", "title", "views"
    ).orderBy("feed_pos")


@query
def recommend_top_n(spark, sf):
    latest = _latest(spark, sf).withColumn("engagement", _engagement())
    ranked = recommend.rank_items(latest, recommend.catalog_frame(spark), top_n=5)
    return recommend.explode_items(ranked, [USER])


@query
def recommend_large_catalog(spark, sf):
    """The parts as catalog, joined on genre; repeated users, and one in five without an engagement."""
    unknown = F.conv(F.substring(USER, 1, 6), 16, 10).cast("bigint") % 5 == 0
    latest = _latest(spark, sf).withColumn("engagement", F.when(~unknown, _engagement()))
    parts = spark.read.parquet(f"{sf}/part.parquet")
    genres = F.array(*[F.lit(g) for g in [*CATALOG_GENRES, "other", None]])
    catalog = parts.select(
        F.col("p_partkey").cast("int").alias("pos"),
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("content_id"),
        F.get(genres, (F.col("p_partkey") % (len(CATALOG_GENRES) + 2)).cast("int")).alias("genre"),
        F.col("p_name").alias("title"),
    )
    ranked = recommend.rank_items(latest.unionByName(latest), catalog, top_n=5, inline_limit=0)
    return recommend.explode_items(ranked, [USER])


def _routed(spark, sf) -> DataFrame:
    return recommend.route(
        ad.users(spark, sf),
        co.current_consent(ad.consent_changes(spark, sf)),
        _latest(spark, sf, SERVING_TTL),
        F.lit(ONLINE_AS_OF),
    )


@query
def recommendations_all_users(spark, sf):
    return recommend.recommendations(
        _routed(spark, sf),
        recommend.catalog_frame(spark),
        recommend.trending_frame(spark),
        _engagement(),
        F.lit("1"),
    )


@query
def fallback_rate(spark, sf):
    rates = recommend.fallback_rate(_routed(spark, sf))
    return rates.withColumn("share", r6("share"))


# --- reports ------------------------------------------------------------------------------


@query
def latency_percentiles(spark, sf):
    return ev.index_percentiles(ad.request_log(spark, sf), ["endpoint"], "latency_ms", [50, 66, 75, 90, 95, 99])


@query
def slo_report(spark, sf):
    report = monitor.slo_report(ad.request_log(spark, sf))
    return report.withColumn("error_pct", r6("error_pct"))


@query
def slo_endpoints(spark, sf):
    """The endpoints' part of a report snapshot, with the thresholds of one suite."""
    snapshot = monitor.slo_snapshot(ad.request_log(spark, sf)).filter("suite = 'baseline'")
    rows = snapshot.select("thresholds.*", F.inline("endpoints"))
    return rows.withColumn("error_pct", r6("error_pct"))


@query
def feature_freshness(spark, sf):
    report = monitor.freshness_report(_latest(spark, sf), F.lit(ONLINE_AS_OF))
    return report.withColumns({c: r6(c) for c in ("min_age", "avg_age", "max_age")})


@query
def processing_lag(spark, sf):
    rows = _rows(spark, sf).withColumn("computed_at_epoch", r6("computed_at_epoch"))
    report = monitor.processing_lag(rows)
    return report.withColumns({c: F.round(c, 3) for c in ("p50", "p95", "p99")})
