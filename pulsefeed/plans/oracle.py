"""SQL twins of the named queries, written from the definitions.

The window features use the plain inequality self-join that defines a window's
survivors, a different route to the answer than the sweep in
``operators.window_features``.
"""

from __future__ import annotations

from pulsefeed import settings as cfg
from pulsefeed.functions.pseudonym import hmac_pads
from pulsefeed.plans.queries import (
    AUDIT_AS_OF,
    CATALOG_GENRES,
    DAY_WINDOW,
    ONLINE_AS_OF,
    PROMOTION_MINIMUMS,
    SERVING_TTL,
    TRAIN_AS_OF,
    TRAIN_FROM,
    SPARSE_GENRES,
    SPARSE_VOCABULARY,
    WIDE_GENRES,
)

H = 3_600_000_000


def _values(rows: list[tuple]) -> str:
    def lit(v: object) -> str:
        return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


def _hmac(column: str) -> str:
    inner, outer = (p.hex() for p in hmac_pads(cfg.pseudonym_secret()))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({column}))))"


def _day(us: str) -> str:
    return f"strftime(make_timestamp({us}), '%Y-%m-%d')"


_GENRE_CASE = (
    "CASE WHEN e.event_type = 'error' THEN NULL WHEN e.event_type = 'signup' THEN '' ELSE c.genre END"
)

# name -> (definition, names it needs)
_CTE: dict[str, tuple[str, list[str]]] = {
    "ev": (
        "SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, user_id AS uid, ts, epoch_us(ts) AS t_us, "
        "event_type, value FROM events",
        [],
    ),
    "ids": (f"SELECT user_id, {_hmac('user_id')} AS pid FROM (SELECT DISTINCT user_id FROM ev)", ["ev"]),
    "catalog": (
        "SELECT * FROM (VALUES " + _values([(i, *c) for i, c in enumerate(cfg.CATALOG)])
        + ") AS t(pos, content_id, genre, title)",
        [],
    ),
    "trending": (
        "SELECT * FROM (VALUES " + _values(list(enumerate(cfg.TRENDING))) + ") AS t(feed_pos, content_id)", []
    ),
    "w": (
        f"""SELECT i.pid AS u, e.event_id AS seq, c.content_id, e.value AS pct,
            CAST(CAST(e.value AS VARCHAR) AS DECIMAL(21,18)) AS dpct, {_GENRE_CASE} AS genre,
            CASE e.uid % 5 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'Asia/Kolkata' WHEN 4 THEN 'Europe/London'
              ELSE 'UTC' END AS zone,
            e.t_us AS t, e.t_us + (e.event_id % 7) * {6 * H} AS arr, {_day('e.t_us')} AS event_date
        FROM ev e JOIN ids i ON i.user_id = e.user_id JOIN catalog c ON c.pos = e.event_id % {len(cfg.CATALOG)}
        WHERE e.value >= 0 AND e.value <= 100""",
        ["ev", "ids", "catalog"],
    ),
    "hw": (
        "SELECT *, greatest(0, max(t) OVER (PARTITION BY u ORDER BY arr, seq ROWS UNBOUNDED PRECEDING)) AS hwm FROM w",
        ["w"],
    ),
    "messages": (
        f"""SELECT e.event_id, CASE e.event_id % 16 WHEN 0 THEN 'not json {{' WHEN 1 THEN '[1,2]' WHEN 10 THEN '42' ELSE
            '{{"pseudo_user_id":' || CASE WHEN e.event_id % 16 = 3 THEN 'null' ELSE '"u' || e.user_id || '"' END
            || CASE e.event_id % 16 WHEN 2 THEN '' WHEN 8 THEN ',"content_id":null'
                 ELSE ',"content_id":"' || c.content_id || '"' END
            || ',"watch_pct":' || CASE e.event_id % 16 WHEN 4 THEN '"' || CAST(value AS VARCHAR) || '"' WHEN 5 THEN 'true'
                 ELSE CAST(value AS VARCHAR) END
            || ',"timestamp":' || CASE e.event_id % 16 WHEN 6 THEN '"not-a-date"' WHEN 9 THEN '1704067200'
                 WHEN 7 THEN strftime(ts, '"%Y-%m-%dT%H:%M:%S.%f-05:00"') ELSE strftime(ts, '"%Y-%m-%dT%H:%M:%S.%fZ"') END
            || ',"genre":"drama"}}' END AS value
        FROM ev e JOIN catalog c ON c.pos = e.event_id % {len(cfg.CATALOG)}""",
        ["ev", "catalog"],
    ),
    "checked": (
        """SELECT *, CASE WHEN NOT json_valid(value) THEN 'not_json'
              WHEN json_type(value) <> 'OBJECT' THEN 'not_an_object'
              WHEN NOT (list_contains(json_keys(value), 'pseudo_user_id') AND list_contains(json_keys(value), 'content_id')
                AND list_contains(json_keys(value), 'watch_pct') AND list_contains(json_keys(value), 'timestamp'))
                THEN 'missing_field'
              WHEN json_type(value, '$.pseudo_user_id') = 'NULL' THEN 'null_key'
              WHEN json_type(value, '$.watch_pct') NOT IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN 'bad_watch_pct'
              WHEN NOT (CAST(json_extract(value, '$.watch_pct') AS DOUBLE) BETWEEN 0 AND 100) THEN 'bad_watch_pct'
              WHEN json_type(value, '$.timestamp') <> 'VARCHAR'
                OR TRY_CAST(json_extract_string(value, '$.timestamp') AS TIMESTAMPTZ) IS NULL THEN 'bad_timestamp'
              END AS reject_reason FROM messages""",
        ["messages"],
    ),
    "raw_watch": (
        f"""SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN user_id END AS user_id,
            CASE WHEN event_id % 89 <> 0 THEN c.content_id END AS content_id,
            CASE WHEN event_id % 83 = 0 THEN 'abc' WHEN event_id % 79 <> 0 THEN CAST(value AS VARCHAR) END AS watch_pct,
            CASE WHEN event_id % 73 = 0 THEN 'not-a-date' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS stamp
        FROM ev JOIN catalog c ON c.pos = event_id % {len(cfg.CATALOG)}""",
        ["ev", "catalog"],
    ),
    "watch_checked": (
        """SELECT *, CASE WHEN user_id IS NULL THEN 'missing_user_id' WHEN content_id IS NULL THEN 'missing_content_id'
              WHEN watch_pct IS NULL THEN 'missing_watch_pct'
              WHEN TRY_CAST(watch_pct AS DOUBLE) IS NULL THEN 'watch_pct_not_a_number'
              WHEN NOT (TRY_CAST(watch_pct AS DOUBLE) BETWEEN 0 AND 100) THEN 'watch_pct_out_of_range'
              WHEN TRY_CAST(stamp AS TIMESTAMPTZ) IS NULL THEN 'bad_timestamp' END AS reject_reason FROM raw_watch""",
        ["raw_watch"],
    ),
    "session_checked": (
        """SELECT event_id, user_id, CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'smart-tv' ELSE 'web' END AS device,
            CASE WHEN event_id % 7 = 3 THEN 'missing_session_id' WHEN event_id % 11 = 5 THEN 'bad_start_time'
              ELSE 'valid' END AS outcome FROM ev""",
        ["ev"],
    ),
    "changes": (
        f"""SELECT e.event_id AS seq, i.pid AS user_pseudo_id, event_type = 'signup' AS consent_granted,
            CASE WHEN event_type = 'error' THEN 'user request' END AS reason,
            t_us - (event_id % 8) * {30 * 24 * H} AS at_us
        FROM ev e JOIN ids i ON i.user_id = e.user_id WHERE event_type IN ('signup', 'error')""",
        ["ev", "ids"],
    ),
    "consent": (
        """SELECT user_pseudo_id, consent_granted, at_us AS updated_us FROM (SELECT *, row_number() OVER (
            PARTITION BY user_pseudo_id ORDER BY at_us DESC, seq DESC) AS rn FROM changes) WHERE rn = 1""",
        ["changes"],
    ),
    "audit": (
        """SELECT seq AS id, user_pseudo_id, CASE WHEN consent_granted THEN 'GRANT' ELSE 'REVOKE' END AS action, at_us,
            reason, strftime(make_timestamp(at_us), '%Y-%m') AS audit_month FROM changes""",
        ["changes"],
    ),
    "assignments": (
        """SELECT 'model-' || CAST(uid % 40 AS VARCHAR) AS name, event_id AS version,
            CASE WHEN event_id % 3 = 0 THEN 'production' ELSE 'staging' END AS alias, t_us AS assigned_at,
            (event_id % 101) / 100.0::DOUBLE AS auc, (event_id % 11) / 10.0::DOUBLE AS precision_at_10
        FROM ev WHERE event_type = 'purchase'""",
        ["ev"],
    ),
    "aliases": (
        """SELECT name, alias, version FROM (SELECT *, row_number() OVER (PARTITION BY name, alias
            ORDER BY assigned_at DESC, version DESC) AS rn FROM assignments) WHERE rn = 1""",
        ["assignments"],
    ),
    "requests": (
        f"""SELECT event_id AS request_id, i.pid AS u, t_us + {12 * H} AS request_us
        FROM ev e JOIN ids i ON i.user_id = e.user_id WHERE event_type = 'view'""",
        ["ev", "ids"],
    ),
    "log": (
        """SELECT CASE WHEN event_id % 31 <> 0 THEN event_type END AS endpoint, CASE WHEN event_id % 50 <> 0 OR event_id % 100 = 0
            THEN value END AS latency_ms, event_id % 50 <> 0 AS ok FROM ev""",
        ["ev"],
    ),
    "ranked_log": (
        """SELECT *, row_number() OVER (PARTITION BY endpoint ORDER BY latency_ms NULLS LAST) - 1 AS pos,
            count(latency_ms) OVER (PARTITION BY endpoint) AS n FROM log""",
        ["log"],
    ),
}


def _window_ctes(seconds: int, kind: str = "") -> None:
    """Survivor pairs, per-event aggregates, genre weights and feature rows of one window length and kind of events."""
    us = seconds * 1_000_000
    s = f"{kind}_{seconds}"
    w, hw = "w" + kind, "hw" + kind
    _CTE["pairs" + s] = (
        f"""SELECT n.u, n.seq, n.t AS now_t, i.seq AS iseq, i.t AS it, i.pct, i.dpct, i.genre
        FROM {hw} n JOIN {w} i ON i.u = n.u AND (i.arr < n.arr OR (i.arr = n.arr AND i.seq <= n.seq))
          AND i.t >= n.hwm - {us}""",
        [hw, w],
    )
    age = "((now_t - it) / 1000000.0::DOUBLE)"
    _CTE["agg" + s] = (
        f"""SELECT u, seq, count(*) AS n, CAST(sum(dpct) AS DOUBLE) / count(*) AS avg_pct,
            least(sum(pct * exp(-{cfg.RECENCY_LAMBDA} * {age})) / (100.0::DOUBLE * count(*)), 1.0) AS recency,
            least(sum(CASE WHEN genre IS NOT NULL THEN pct * exp(-{cfg.AFFINITY_LAMBDA} * {age}) ELSE 0.0 END)
              / (100.0::DOUBLE * count(*)), 1.0) AS affinity
        FROM pairs{s} GROUP BY u, seq""",
        ["pairs" + s],
    )
    _CTE["gw" + s] = (
        f"""SELECT u, seq, genre, CAST(sum(dpct) AS DOUBLE) AS g_pct,
            CAST(sum(sum(dpct)) OVER (PARTITION BY u, seq) AS DOUBLE) AS total
        FROM pairs{s} WHERE genre IS NOT NULL AND genre <> '' GROUP BY u, seq, genre""",
        ["pairs" + s],
    )
    _CTE["shares" + s] = (
        f"""SELECT u, seq, string_agg(genre || ':' || CAST(CAST(round(g_pct / total * 1000000.0) AS BIGINT) AS VARCHAR), ','
            ORDER BY genre) AS genre_shares FROM gw{s} WHERE total > 0 GROUP BY u, seq""",
        ["gw" + s],
    )
    hour = "extract(hour FROM timezone(h.zone, timezone('UTC', make_timestamp(h.t))))"
    _CTE["feat" + s] = (
        f"""SELECT h.u, h.seq, h.arr, h.t, CAST(coalesce(a.n, 0) AS INTEGER) AS watch_count_10min,
            coalesce(a.affinity, 0.0) AS category_affinity_score, coalesce(a.avg_pct, 0.0) AS avg_watch_duration,
            CASE WHEN {hour} >= 6 AND {hour} < 12 THEN 'morning' WHEN {hour} >= 12 AND {hour} < 17 THEN 'afternoon'
              WHEN {hour} >= 17 AND {hour} < 21 THEN 'evening' ELSE 'night' END AS time_of_day_bucket,
            coalesce(a.recency, 0.0) AS recency_score, coalesce(g.genre_shares, '') AS genre_shares,
            h.t / 1000000.0::DOUBLE AS last_event_epoch, h.arr / 1000000.0::DOUBLE + (h.seq % 9) AS computed_at_epoch,
            h.event_date
        FROM {hw} h LEFT JOIN agg{s} a ON a.u = h.u AND a.seq = h.seq
          LEFT JOIN shares{s} g ON g.u = h.u AND g.seq = h.seq""",
        [hw, "agg" + s, "shares" + s],
    )


for _seconds in (cfg.WINDOW_SECONDS, DAY_WINDOW):
    _window_ctes(_seconds)

# Events without a user are one group; a name stands in for the null.
_CTE["w_null"] = ("SELECT * REPLACE (CASE WHEN seq % 11 = 0 THEN '' ELSE u END AS u) FROM w", ["w"])
_CTE["w_wide"] = (
    f"SELECT * REPLACE (CASE WHEN genre <> '' THEN 'g' || (seq % {WIDE_GENRES}) ELSE genre END AS genre) FROM w", ["w"]
)
_CTE["w_sparse"] = (
    f"SELECT * REPLACE (CASE WHEN genre <> '' THEN 'g' || lpad(CAST(seq * 7 % {SPARSE_GENRES} AS VARCHAR), 4, '0') ELSE genre END AS genre) FROM w",
    ["w"],
)
for _kind, _length in (("_null", DAY_WINDOW), ("_wide", DAY_WINDOW), ("_sparse", cfg.WINDOW_SECONDS)):
    _CTE["hw" + _kind] = (_CTE["hw"][0].replace("FROM w", f"FROM w{_kind}"), ["w" + _kind])
    _window_ctes(_length, _kind)

_F = f"feat_{cfg.WINDOW_SECONDS}"
_G = f"gw_{cfg.WINDOW_SECONDS}"
_AD, _GD, _FD = f"agg_{DAY_WINDOW}", f"gw_{DAY_WINDOW}", f"feat_{DAY_WINDOW}"

_CTE |= {
    "latest": (
        f"""SELECT *, computed_at_epoch + {cfg.ONLINE_TTL_SECONDS}.0 AS expires_at,
            computed_at_epoch + {SERVING_TTL}.0 AS serving_expires_at
        FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY arr DESC, seq DESC) AS rn FROM {_F}) WHERE rn = 1""",
        [_F],
    ),
    # Two events of one user at the same microsecond: the later computed one stays.
    "train_rows": (
        f"""SELECT u, seq, last_event_epoch, watch_count_10min, round(category_affinity_score, 6) AS category_affinity_score,
            round(avg_watch_duration, 6) AS avg_watch_duration, round(recency_score, 6) AS recency_score,
            time_of_day_bucket, event_date, avg_watch_duration AS mean
        FROM (SELECT *, row_number() OVER (PARTITION BY u, t ORDER BY computed_at_epoch DESC, watch_count_10min DESC,
            arr DESC, seq DESC) AS rn FROM {_F} WHERE event_date BETWEEN '{TRAIN_FROM}' AND '{TRAIN_AS_OF}') WHERE rn = 1""",
        [_F],
    ),
    "train_dates": (
        f"SELECT DISTINCT event_date FROM w WHERE event_date BETWEEN '{TRAIN_FROM}' AND '{TRAIN_AS_OF}'", ["w"]
    ),
    "cut": (
        f"""SELECT min(event_date) AS cutoff FROM (SELECT event_date FROM train_dates ORDER BY event_date DESC
            LIMIT {cfg.VALIDATION_DAYS})""",
        ["train_dates"],
    ),
    "split": (
        f"""SELECT r.*, CASE WHEN event_date < cutoff THEN 'train' ELSE 'validation' END AS split,
            CAST(mean >= {cfg.ENGAGED_THRESHOLD} AS INTEGER) AS engaged,
            round(0.6 * recency_score + 0.4 * category_affinity_score, 4) AS score
        FROM train_rows r, cut""",
        ["train_rows", "cut"],
    ),
    "train_genres": (
        f"""SELECT DISTINCT g.genre FROM split s JOIN {_G} g ON g.u = s.u AND g.seq = s.seq
        WHERE s.split = 'train' AND g.total > 0""",
        ["split", _G],
    ),
    "train_sparse": (
        f"""SELECT u, seq, last_event_epoch, watch_count_10min, time_of_day_bucket, event_date, avg_watch_duration AS mean
        FROM (SELECT *, row_number() OVER (PARTITION BY u, t ORDER BY computed_at_epoch DESC, watch_count_10min DESC,
            arr DESC, seq DESC) AS rn FROM feat_sparse_{cfg.WINDOW_SECONDS} WHERE event_date BETWEEN '{TRAIN_FROM}' AND '{TRAIN_AS_OF}')
        WHERE rn = 1""",
        [f"feat_sparse_{cfg.WINDOW_SECONDS}"],
    ),
    "vocabulary": (
        f"""SELECT genre, row_number() OVER (ORDER BY genre) - 1 AS place FROM (SELECT g.genre FROM train_sparse s JOIN cut
              ON s.event_date < cut.cutoff JOIN gw_sparse_{cfg.WINDOW_SECONDS} g ON g.u = s.u AND g.seq = s.seq
            WHERE g.total > 0 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {SPARSE_VOCABULARY})""",
        ["train_sparse", "cut", f"gw_sparse_{cfg.WINDOW_SECONDS}"],
    ),
    "routed": (
        f"""SELECT i.pid AS u, l.seq, l.avg_watch_duration, CASE WHEN NOT coalesce(c.consent_granted, false) THEN 'consent_denied'
              WHEN l.u IS NULL THEN 'cold_start' END AS fallback_reason
        FROM ids i LEFT JOIN consent c ON c.user_pseudo_id = i.pid
          LEFT JOIN latest l ON l.u = i.pid AND l.serving_expires_at > {ONLINE_AS_OF}""",
        ["ids", "consent", "latest"],
    ),
    "feature_hist": (
        """SELECT split, feature, CAST(least(floor(x * 10), 9) AS INTEGER) AS bin, count(*) AS n FROM (
            SELECT split, unnest(['recency_score', 'category_affinity_score', 'score']) AS feature,
              unnest([recency_score, category_affinity_score, score]) AS x FROM split) GROUP BY ALL""",
        ["split"],
    ),
}


def _sql(body: str, *names: str) -> str:
    """The query with the definitions it needs, in dependency order."""
    order: list[str] = []

    def need(name: str) -> None:
        for dep in _CTE[name][1]:
            need(dep)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    # Materialized: the self-join must not be recomputed for each reader.
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({_CTE[n][0]})" for n in order)
    return f"WITH {ctes}\n{body}" if order else body


_VIEW = """watch_count_10min, round(category_affinity_score, 6) AS category_affinity_score,
    round(avg_watch_duration, 6) AS avg_watch_duration, time_of_day_bucket, round(recency_score, 6) AS recency_score,
    genre_shares, round(last_event_epoch, 6) AS last_event_epoch, round(computed_at_epoch, 6) AS computed_at_epoch,
    event_date"""


def _genre_pivot(table: str, key: str) -> str:
    """One column per catalog genre from the long genre weights."""
    return ", ".join(
        f"round(coalesce(max(CASE WHEN g.genre = '{g}' THEN g.g_pct / g.total END), 0.0), 6) AS \"genre_{g}\""
        for g in CATALOG_GENRES
    )


def _percentiles(percents: list[int]) -> str:
    return ", ".join(
        f"min(CASE WHEN pos = least(CAST(floor(n * {p} / 100.0::DOUBLE) AS BIGINT), n - 1) THEN latency_ms END) AS p{p}"
        for p in percents
    )


def _top_items(table: str, engagement: str, top_n: int) -> str:
    """Ranked catalog items of every row of ``table`` (u, seq)."""
    return f"""SELECT u, rank, content_id, genre, title, round(score, 6) AS score FROM (
        SELECT x.u, c.content_id, c.genre, c.title, {engagement} * coalesce(g.g_pct / g.total, 0.0) AS score,
          CAST(row_number() OVER (PARTITION BY x.u ORDER BY {engagement} * coalesce(g.g_pct / g.total, 0.0) DESC, c.pos)
            AS INTEGER) AS rank
        FROM {table} x CROSS JOIN catalog c
          LEFT JOIN {_G} g ON g.u = x.u AND g.seq = x.seq AND g.genre = c.genre AND g.total > 0)
        WHERE rank <= {top_n}"""


def all_sql() -> dict[str, str]:
    suites = _values([(name, *limits) for name, limits in cfg.SLO_SUITES.items()])
    contract = [("watch_count_10min", "int32"), *[(c, "float64") for c in cfg.BASE_FEATURES[1:]],
                ("time_of_day_bucket", "categorical")]
    month = f"strftime(date_trunc('month', DATE '{AUDIT_AS_OF}') - INTERVAL {cfg.AUDIT_RETENTION_MONTHS} MONTH, '%Y-%m')"
    hole = "(CAST(('0x' || substr(l.u, 1, 6)) AS BIGINT) % 4 = 0)"
    damaged = "(CAST(('0x' || substr(u, 1, 6)) AS BIGINT) % 3 = 0)"
    as_of = _sql(
        f"""SELECT request_id, u AS pseudo_user_id, has_features,
            CASE WHEN has_features THEN watch_count_10min END AS watch_count_10min,
            CASE WHEN has_features THEN round(last_event_epoch, 6) END AS last_event_epoch,
            CASE WHEN has_features THEN round(avg_watch_duration, 6) END AS avg_watch_duration
        FROM (SELECT q.request_id, q.u, f.watch_count_10min, f.last_event_epoch, f.avg_watch_duration,
            coalesce(f.computed_at_epoch + {SERVING_TTL}.0 > q.request_us / 1000000.0::DOUBLE, false) AS has_features,
            row_number() OVER (PARTITION BY q.request_id ORDER BY CAST(f.computed_at_epoch * 1000000 AS BIGINT) DESC NULLS LAST,
              f.arr DESC, f.seq DESC) AS rn
          FROM requests q LEFT JOIN {_F} f ON f.u = q.u
            AND CAST(f.computed_at_epoch * 1000000 AS BIGINT) <= q.request_us) WHERE rn = 1""",
        "requests", _F,
    )
    return {
        # ingest
        "validate_watch_valid": _sql(
            f"""SELECT event_id, {_hmac('user_id')} AS pseudo_user_id, content_id, CAST(watch_pct AS DOUBLE) AS watch_pct,
                stamp AS timestamp FROM watch_checked WHERE reject_reason IS NULL""",
            "watch_checked",
        ),
        "validate_watch_rejects": _sql(
            "SELECT reject_reason, count(*) AS n FROM watch_checked WHERE reject_reason IS NOT NULL GROUP BY 1",
            "watch_checked",
        ),
        "validate_session": _sql("SELECT outcome, device, count(*) AS n FROM session_checked GROUP BY 1, 2", "session_checked"),
        "sessions_per_device": _sql(
            """SELECT device, count(*) AS sessions, count(DISTINCT user_id) AS users FROM session_checked
            WHERE outcome = 'valid' GROUP BY 1""",
            "session_checked",
        ),
        "parse_watch_json": _sql(
            """SELECT event_id, json_extract_string(value, '$.pseudo_user_id') AS pseudo_user_id,
                json_extract_string(value, '$.content_id') AS content_id,
                CAST(json_extract(value, '$.watch_pct') AS DOUBLE) AS watch_pct, json_extract_string(value, '$.genre') AS genre,
                epoch_us(CAST(json_extract_string(value, '$.timestamp') AS TIMESTAMPTZ)) AS event_us,
                substr(json_extract_string(value, '$.timestamp'), 1, 10) AS event_date
            FROM checked WHERE reject_reason IS NULL""",
            "checked",
        ),
        "rejects_by_reason": _sql(
            "SELECT reject_reason, count(*) AS n FROM checked WHERE reject_reason IS NOT NULL GROUP BY 1", "checked"
        ),
        "boundary_to_parser": _sql(
            f"""SELECT event_id, {_hmac('w.user_id')} AS pseudo_user_id, CAST(watch_pct AS DOUBLE) AS watch_pct,
                CASE event_id % 5 WHEN 2 THEN t_us - t_us % 1000 WHEN 3 THEN t_us - 19800000000 ELSE t_us END AS event_us,
                {_day('t_us')} AS event_date
            FROM watch_checked w JOIN (SELECT event_id, t_us FROM ev) USING (event_id) WHERE reject_reason IS NULL""",
            "watch_checked", "ev",
        ),
        # The instant follows from the event's time and what its form keeps of it; nothing is parsed.
        "iso_forms": _sql(
            """SELECT event_id, CASE event_id % 12 WHEN 2 THEN s - 19800000000 WHEN 3 THEN s - 18000000000 WHEN 4 THEN s + 19815000000
                  WHEN 5 THEN s + 250000 WHEN 8 THEN week WHEN 9 THEN s - s % 3600000000 WHEN 10 THEN s - s % 60000000 - 3600000000
                  WHEN 11 THEN NULL ELSE s END AS at_us,
                CASE event_id % 12 WHEN 11 THEN NULL WHEN 8 THEN strftime(make_timestamp(week), '%Y-%m-%d')
                  ELSE strftime(make_timestamp(s), '%Y-%m-%d') END AS local_date
            FROM (SELECT event_id, t_us - t_us % 1000000 AS s, epoch_us(CAST(date_trunc('week', ts) AS TIMESTAMP)) AS week FROM ev)""",
            "ev",
        ),
        "event_date_local": _sql(
            f"""SELECT {_day('t_us')} AS event_date, count(*) AS n, min(t_us) + {5 * H} AS first_us, max(t_us) + {5 * H} AS last_us
            FROM ev GROUP BY 1""",
            "ev",
        ),
        "pseudonymize_users": _sql("SELECT user_id, pid AS pseudo_user_id FROM ids", "ids"),
        # window features
        "user_high_water_mark": _sql("SELECT u AS pseudo_user_id, seq AS arrival_seq, t AS event_us, hwm AS hwm_us FROM hw", "hw"),
        "late_events": _sql(
            f"""SELECT event_date, count(*) AS n, CAST(sum(CAST(t < hwm AS INTEGER)) AS BIGINT) AS late,
                CAST(sum(CAST(t < hwm - {cfg.WINDOW_SECONDS * 1_000_000} AS INTEGER)) AS BIGINT) AS beyond_window
            FROM hw GROUP BY 1""",
            "hw",
        ),
        "window_membership_counts": _sql(
            f"""SELECT n AS watch_count, count(*) AS n_events FROM (SELECT coalesce(a.n, 0) AS n FROM hw h
                LEFT JOIN {_AD} a ON a.u = h.u AND a.seq = h.seq) GROUP BY 1""",
            "hw", _AD,
        ),
        "watch_count_inorder": _sql(
            f"""SELECT n.u AS pseudo_user_id, n.seq AS arrival_seq, count(*) AS watch_count FROM w n JOIN w i ON i.u = n.u
                AND (i.t < n.t OR (i.t = n.t AND i.seq <= n.seq)) AND i.t >= n.t - {DAY_WINDOW * 1_000_000} GROUP BY 1, 2""",
            "w",
        ),
        "watch_count_10min": _sql(f"SELECT u AS pseudo_user_id, seq AS arrival_seq, watch_count_10min FROM {_F}", _F),
        "avg_watch_duration": _sql(
            f"SELECT u AS pseudo_user_id, seq AS arrival_seq, round(avg_watch_duration, 6) AS avg_watch_duration FROM {_FD}", _FD
        ),
        "recency_score": _sql(
            f"SELECT u AS pseudo_user_id, seq AS arrival_seq, round(recency_score, 6) AS recency_score FROM {_FD}", _FD
        ),
        "category_affinity_score": _sql(
            f"""SELECT u AS pseudo_user_id, seq AS arrival_seq, round(category_affinity_score, 6) AS category_affinity_score
            FROM {_FD}""",
            _FD,
        ),
        "genre_weights": _sql(
            f"SELECT u AS pseudo_user_id, seq AS arrival_seq, genre, round(g_pct / 100.0, 6) AS weight FROM {_GD}", _GD
        ),
        "session_genre_distribution": _sql(
            f"""SELECT u AS pseudo_user_id, seq AS arrival_seq, genre, round(g_pct / total, 6) AS share FROM {_GD}
            WHERE total > 0""",
            _GD,
        ),
        "time_of_day_bucket": _sql(f"SELECT seq AS arrival_seq, time_of_day_bucket FROM {_F}", _F),
        "user_features": _sql(f"SELECT u AS pseudo_user_id, seq AS arrival_seq, {_VIEW} FROM {_F}", _F),
        "user_features_split": _sql(
            f"SELECT nullif(u, '') AS pseudo_user_id, seq AS arrival_seq, {_VIEW} FROM feat_null_{DAY_WINDOW}", f"feat_null_{DAY_WINDOW}"
        ),
        "user_features_wide_genres": _sql(
            f"SELECT u AS pseudo_user_id, seq AS arrival_seq, {_VIEW} FROM feat_wide_{DAY_WINDOW}", f"feat_wide_{DAY_WINDOW}"
        ),
        "user_features_day": _sql(f"SELECT u AS pseudo_user_id, seq AS arrival_seq, {_VIEW} FROM {_FD}", _FD),
        # stores
        "feature_log_partitions": _sql(
            """SELECT substr(event_date, 1, 4) AS year, substr(event_date, 6, 2) AS month, substr(event_date, 9, 2) AS day,
                count(*) AS n FROM w GROUP BY 1, 2, 3""",
            "w",
        ),
        "training_rows_in_range": _sql(
            f"""SELECT event_date, count(*) AS n, round(sum(recency_score), 6) AS recency_sum FROM {_F}
            WHERE event_date BETWEEN '{TRAIN_FROM}' AND '{TRAIN_AS_OF}' GROUP BY 1""",
            _F,
        ),
        "dedup_feature_rows": _sql(
            f"""SELECT u AS pseudo_user_id, seq AS arrival_seq, {_VIEW} FROM (
                SELECT * REPLACE (computed_at_epoch + 60.0 AS computed_at_epoch), row_number() OVER (PARTITION BY u, t
                  ORDER BY computed_at_epoch DESC, watch_count_10min DESC) AS rn FROM {_F}) WHERE rn = 1""",
            _F,
        ),
        "online_features_latest": _sql(
            f"SELECT u AS pseudo_user_id, round(expires_at, 6) AS expires_at, {_VIEW} FROM latest", "latest"
        ),
        "online_features_decoded": _sql(
            f"""SELECT 'user:' || u || ':features' AS key, u AS pseudo_user_id,
                CASE WHEN {damaged} THEN 0 ELSE watch_count_10min END AS watch_count_10min,
                round(avg_watch_duration, 6) AS avg_watch_duration,
                CASE WHEN {damaged} THEN 0.0 ELSE round(recency_score, 6) END AS recency_score,
                time_of_day_bucket, event_date FROM latest WHERE serving_expires_at > {ONLINE_AS_OF}""",
            "latest",
        ),
        "cold_start_users": _sql(
            f"""SELECT pid AS pseudo_user_id FROM ids WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.u = pid
                AND l.expires_at > {ONLINE_AS_OF})""",
            "ids", "latest",
        ),
        "features_as_of_request": as_of,
        "features_as_of_split": as_of,
        # consent
        "consent_current": _sql("SELECT * FROM consent", "consent"),
        "consent_audit_log": _sql("SELECT id, user_pseudo_id, action, at_us, reason FROM audit", "audit"),
        "consent_audit_mismatch": _sql(
            """SELECT count(*) AS mismatches FROM consent c WHERE NOT EXISTS (SELECT 1 FROM audit a
                WHERE a.user_pseudo_id = c.user_pseudo_id AND a.at_us = c.updated_us
                  AND (a.action = 'GRANT') = c.consent_granted)""",
            "consent", "audit",
        ),
        "consent_gate": _sql(
            """SELECT pid AS pseudo_user_id, coalesce(consent_granted, false) AS granted FROM ids
                LEFT JOIN consent ON user_pseudo_id = pid""",
            "ids", "consent",
        ),
        "audit_history": _sql(
            "SELECT user_pseudo_id, at_us, action, id FROM audit ORDER BY user_pseudo_id, at_us DESC, id DESC", "audit"
        ),
        "consent_revocations": _sql(
            f"""SELECT {_day('at_us')} AS day, count(*) AS revocations, count(DISTINCT user_pseudo_id) AS users FROM audit
            WHERE action = 'REVOKE' GROUP BY 1""",
            "audit",
        ),
        "audit_month_bounds": _sql(
            f"""SELECT DISTINCT strftime(d, '%Y-%m') AS audit_month, strftime(d, '%Y-%m-%d') AS from_date,
                strftime(d + INTERVAL 1 MONTH, '%Y-%m-%d') AS to_date
            FROM (SELECT CAST(audit_month || '-01' AS DATE) + to_months(k) AS d
              FROM (SELECT DISTINCT audit_month FROM audit), (SELECT unnest(range({cfg.AUDIT_LOOKAHEAD_MONTHS + 1}))::INTEGER AS k))""",
            "audit",
        ),
        "audit_expired_months": _sql(
            f"SELECT audit_month, count(*) AS entries FROM audit WHERE audit_month < {month} GROUP BY 1", "audit"
        ),
        "audit_retained": _sql(
            f"SELECT audit_month, action, count(*) AS entries FROM audit WHERE audit_month >= {month} GROUP BY 1, 2", "audit"
        ),
        "consent_after_retention": _sql(
            f"""SELECT c.user_pseudo_id, c.consent_granted, count(a.id) AS kept_entries FROM consent c LEFT JOIN audit a
                ON a.user_pseudo_id = c.user_pseudo_id AND a.audit_month >= {month} GROUP BY 1, 2""",
            "consent", "audit",
        ),
        # training
        "known_genres": _sql("SELECT genre FROM train_genres", "train_genres"),
        "split_cutoff": _sql("SELECT cutoff, (SELECT count(*) FROM train_dates) AS n_dates FROM cut", "cut"),
        "split_stats": _sql(
            """SELECT split, count(*) AS n_rows, round(avg(engaged), 6) AS positive_rate, min(event_date) AS first_date,
                max(event_date) AS last_date FROM split GROUP BY 1""",
            "split",
        ),
        "chronological_split": _sql("SELECT split, event_date, count(*) AS n FROM split GROUP BY 1, 2", "split"),
        "genre_matrix": _sql(
            f"""SELECT s.u AS pseudo_user_id, round(s.last_event_epoch, 6) AS last_event_epoch, {_genre_pivot('s', 'seq')}
            FROM split s LEFT JOIN {_G} g ON g.u = s.u AND g.seq = s.seq AND g.total > 0 GROUP BY 1, 2""",
            "split", _G,
        ),
        "time_bucket_index": _sql(
            """SELECT time_of_day_bucket, CAST(list_position(['morning', 'afternoon', 'evening', 'night'], time_of_day_bucket) - 1
                AS INTEGER) AS idx, count(*) AS n FROM split GROUP BY 1, 2""",
            "split",
        ),
        "engaged_label": _sql(
            "SELECT u AS pseudo_user_id, round(last_event_epoch, 6) AS last_event_epoch, engaged FROM split", "split"
        ),
        "feature_matrix": _sql(
            f"""SELECT s.u AS pseudo_user_id, round(s.last_event_epoch, 6) AS last_event_epoch, s.watch_count_10min,
                s.category_affinity_score, s.avg_watch_duration, s.recency_score, s.time_of_day_bucket,
                CAST(list_position(['morning', 'afternoon', 'evening', 'night'], s.time_of_day_bucket) - 1 AS INTEGER)
                  AS time_of_day_index, {_genre_pivot('s', 'seq')}, s.engaged
            FROM split s LEFT JOIN {_G} g ON g.u = s.u AND g.seq = s.seq AND g.total > 0
            GROUP BY s.u, s.last_event_epoch, s.watch_count_10min, s.category_affinity_score, s.avg_watch_duration,
                s.recency_score, s.time_of_day_bucket, s.engaged""",
            "split", _G,
        ),
        "feature_matrix_sparse": _sql(
            f"""SELECT s.u AS pseudo_user_id, round(s.last_event_epoch, 6) AS last_event_epoch, s.watch_count_10min,
                CAST(list_position(['morning', 'afternoon', 'evening', 'night'], s.time_of_day_bucket) - 1 AS INTEGER) AS time_of_day_index,
                CAST(s.mean >= {cfg.ENGAGED_THRESHOLD} AS INTEGER) AS engaged,
                (SELECT CAST(count(*) AS INTEGER) FROM vocabulary) AS size,
                coalesce(string_agg(CAST(v.place AS VARCHAR), ',' ORDER BY v.place) FILTER (v.place IS NOT NULL), '') AS indices,
                coalesce(string_agg(CAST(CAST(round(g.g_pct / g.total * 1000000.0) AS BIGINT) AS VARCHAR), ',' ORDER BY v.place)
                  FILTER (v.place IS NOT NULL), '') AS millionths
            FROM train_sparse s LEFT JOIN gw_sparse_{cfg.WINDOW_SECONDS} g ON g.u = s.u AND g.seq = s.seq AND g.total > 0
              LEFT JOIN vocabulary v ON v.genre = g.genre GROUP BY s.u, s.seq, 2, 3, 4, 5""",
            "train_sparse", "vocabulary",
        ),
        "schema_contract_rows": _sql(
            f"""SELECT (SELECT count(*) FROM split WHERE split = 'train') AS train_rows, pos, name, dtype FROM (
                SELECT CAST(row_number() OVER (ORDER BY part, name_order) - 1 AS INTEGER) AS pos, name, dtype FROM (
                  SELECT 0 AS part, lpad(CAST(i AS VARCHAR), 4, '0') AS name_order, name, dtype
                  FROM (VALUES {_values([(i, *c) for i, c in enumerate(contract)])}) AS t(i, name, dtype)
                  UNION ALL SELECT 1, genre, 'genre_' || genre, 'float64' FROM train_genres))""",
            "train_genres",
        ),
        "serving_vectors": _sql(
            f"""SELECT l.u AS pseudo_user_id, CASE WHEN {hole} THEN 0 ELSE l.watch_count_10min END AS watch_count_10min,
                round(l.category_affinity_score, 6) AS category_affinity_score,
                round(l.avg_watch_duration, 6) AS avg_watch_duration,
                CASE WHEN {hole} THEN 0.0 ELSE round(l.recency_score, 6) END AS recency_score,
                CASE WHEN {hole} THEN 'morning' ELSE l.time_of_day_bucket END AS time_of_day_bucket,
                {_genre_pivot('l', 'seq')}
            FROM latest l LEFT JOIN {_G} g ON g.u = l.u AND g.seq = l.seq AND g.total > 0
            GROUP BY l.u, l.watch_count_10min, l.category_affinity_score, l.avg_watch_duration, l.recency_score,
                l.time_of_day_bucket""",
            "latest", _G,
        ),
        "auc_score": _sql(
            """SELECT round(sum(CASE WHEN engaged = 1 THEN below + ties / 2.0 ELSE 0 END)
                  / (CAST(sum(engaged) AS DOUBLE) * sum(1 - engaged)), 6) AS auc,
                CAST(sum(engaged) AS BIGINT) AS n_pos, CAST(sum(1 - engaged) AS BIGINT) AS n_neg
            FROM (SELECT engaged, coalesce(sum(1 - engaged) OVER (ORDER BY score RANGE BETWEEN UNBOUNDED PRECEDING
                    AND CURRENT ROW EXCLUDE GROUP), 0)::DOUBLE AS below,
                  sum(1 - engaged) OVER (PARTITION BY score)::DOUBLE AS ties FROM split WHERE split = 'validation')""",
            "split",
        ),
        "precision_at_k": _sql(
            f"""SELECT round(avg(engaged), 6) AS precision_at_k, count(*) AS k FROM (SELECT engaged FROM split
                WHERE split = 'validation' ORDER BY score DESC, u, last_event_epoch LIMIT {cfg.PRECISION_K})""",
            "split",
        ),
        "score_histogram": _sql(
            "SELECT split, CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, count(*) AS n FROM split GROUP BY 1, 2", "split"
        ),
        "feature_drift": _sql(
            """SELECT feature, round(sum((pb - pa) * ln(pb / pa)), 6) AS psi FROM (SELECT feature,
                greatest(a / sum(a) OVER (PARTITION BY feature), 1e-6) AS pa,
                greatest(b / sum(b) OVER (PARTITION BY feature), 1e-6) AS pb
              FROM (SELECT feature, bin, sum(CASE WHEN split = 'train' THEN n ELSE 0 END)::DOUBLE AS a,
                  sum(CASE WHEN split = 'validation' THEN n ELSE 0 END)::DOUBLE AS b FROM feature_hist GROUP BY 1, 2))
            GROUP BY 1""",
            "feature_hist",
        ),
        "registry_alias_current": _sql("SELECT * FROM aliases", "aliases"),
        "registry_resolve": _sql(
            """SELECT name, alias, version FROM (SELECT *, row_number() OVER (PARTITION BY name
                ORDER BY CASE alias WHEN 'production' THEN 0 ELSE 1 END) AS rn FROM aliases) WHERE rn = 1""",
            "aliases",
        ),
        "promotion_candidates": _sql(
            "SELECT name, version, alias, auc, precision_at_10 FROM assignments WHERE "
            + " AND ".join(f"{m} > {v}" for m, v in PROMOTION_MINIMUMS.items()),
            "assignments",
        ),
        # recommendations
        "trending_items": _sql(
            """SELECT CAST(t.feed_pos AS INTEGER) AS feed_pos, c.content_id, c.genre, c.title, count(*) AS views
            FROM trending t JOIN catalog c ON c.content_id = t.content_id JOIN w ON w.content_id = c.content_id
            GROUP BY ALL ORDER BY feed_pos""",
            "trending", "catalog", "w",
        ),
        "recommend_top_n": _sql(
            f"""SELECT u AS pseudo_user_id, * EXCLUDE (u) FROM ({_top_items('latest', 'x.avg_watch_duration / 100.0', 5)})""",
            "latest", "catalog", _G,
        ),
        "recommendations_all_users": _sql(
            f"""SELECT u AS pseudo_user_id, true AS personalized, NULL::VARCHAR AS fallback_reason, '1' AS model_version,
                rank, content_id, genre, title, score
            FROM ({_top_items("(SELECT * FROM routed WHERE fallback_reason IS NULL)", 'x.avg_watch_duration / 100.0', cfg.TOP_N_DEFAULT)})
            UNION ALL
            SELECT r.u, false, r.fallback_reason, NULL, CAST(row_number() OVER (PARTITION BY r.u ORDER BY t.feed_pos) AS INTEGER),
                c.content_id, c.genre, c.title, NULL
            FROM routed r, trending t JOIN catalog c ON c.content_id = t.content_id
            WHERE r.fallback_reason IS NOT NULL AND t.feed_pos < {cfg.TOP_N_DEFAULT}""",
            "routed", "catalog", "trending", _G,
        ),
        "fallback_rate": _sql(
            """SELECT coalesce(fallback_reason, 'personalized') AS reason, count(*) AS n,
                round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM routed GROUP BY 1""",
            "routed",
        ),
        # reports
        "recommend_large_catalog": _sql(
            f"""SELECT u AS pseudo_user_id, rank, content_id, genre, title, round(score, 6) AS score FROM (
              SELECT x.u, c.content_id, c.genre, c.title, e * coalesce(g.g_pct / g.total, 0.0) AS score,
                CAST(row_number() OVER (PARTITION BY x.u, x.copy ORDER BY e * coalesce(g.g_pct / g.total, 0.0) DESC, c.pos) AS INTEGER) AS rank
              FROM (SELECT u, seq, copy, CASE WHEN CAST('0x' || substr(u, 1, 6) AS BIGINT) % 5 <> 0 THEN avg_watch_duration / 100.0 END AS e
                    FROM latest, range(2) AS r(copy)) x
                CROSS JOIN (SELECT p_partkey AS pos, 'p' || p_partkey AS content_id, p_name AS title,
                    [{", ".join(f"'{g}'" for g in CATALOG_GENRES)}, 'other', NULL][CAST(p_partkey % {len(CATALOG_GENRES) + 2} AS INTEGER) + 1] AS genre FROM part) c
                LEFT JOIN {_G} g ON g.u = x.u AND g.seq = x.seq AND g.genre = c.genre AND g.total > 0)
            WHERE rank <= 5""",
            "latest", _G,
        ),
        "latency_percentiles": _sql(
            f"SELECT endpoint, n, {_percentiles([50, 66, 75, 90, 95, 99])} FROM ranked_log GROUP BY endpoint, n", "ranked_log"
        ),
        "slo_report": _sql(
            f"""SELECT suite, requests, errors, p50_ms, p95_ms, p99_ms, round(error_pct, 6) AS error_pct,
                p95_ms <= max_p95 AS latency_passed, error_pct <= max_err AS errors_passed,
                p95_ms <= max_p95 AND error_pct <= max_err AS passed
            FROM (SELECT CAST(sum(requests) AS BIGINT) AS requests, CAST(sum(errors) AS BIGINT) AS errors, median(p50) AS p50_ms,
                max(p95) AS p95_ms, max(p99) AS p99_ms, sum(errors) / CAST(sum(requests) AS DOUBLE) * 100.0 AS error_pct
              FROM (SELECT endpoint, n, count(*) AS requests, sum(CAST(NOT ok AS INTEGER)) AS errors, {_percentiles([50, 95, 99])}
                FROM ranked_log GROUP BY endpoint, n)),
              (VALUES {suites}) AS t(suite, max_p95, max_err)""",
            "ranked_log",
        ),
        "slo_endpoints": _sql(
            f"""SELECT {cfg.SLO_SUITES['baseline'][0]}::DOUBLE AS max_p95_ms, {cfg.SLO_SUITES['baseline'][1]}::DOUBLE AS max_error_pct, endpoint,
                count(*) AS requests, CAST(sum(CAST(NOT ok AS INTEGER)) AS BIGINT) AS errors,
                round(sum(CAST(NOT ok AS INTEGER)) / CAST(count(*) AS DOUBLE) * 100.0, 6) AS error_pct, p50_ms, p95_ms, p99_ms
            FROM ranked_log JOIN (SELECT endpoint AS e, {_percentiles([50, 95, 99]).replace(' AS p50', ' AS p50_ms').replace(' AS p95', ' AS p95_ms').replace(' AS p99', ' AS p99_ms')}
              FROM ranked_log GROUP BY 1) ON e IS NOT DISTINCT FROM endpoint GROUP BY endpoint, p50_ms, p95_ms, p99_ms""",
            "ranked_log",
        ),
        "feature_freshness": _sql(
            f"""SELECT count(*) AS n, round(min({ONLINE_AS_OF} - computed_at_epoch), 6) AS min_age,
                round(avg({ONLINE_AS_OF} - computed_at_epoch), 6) AS avg_age,
                round(max({ONLINE_AS_OF} - computed_at_epoch), 6) AS max_age,
                CAST(sum(CAST({ONLINE_AS_OF} - computed_at_epoch >= {cfg.FRESHNESS_LIMIT_SECONDS} AS INTEGER)) AS BIGINT)
                  AS breaches FROM latest""",
            "latest",
        ),
        "processing_lag": _sql(
            """SELECT event_date, n, """
            + ", ".join(
                f"round(min(CASE WHEN pos = least(CAST(floor(n * {p} / 100.0::DOUBLE) AS BIGINT), n - 1) THEN lag_s END), 3) AS p{p}"
                for p in (50, 95, 99)
            )
            + f""" FROM (SELECT event_date, lag_s, row_number() OVER (PARTITION BY event_date ORDER BY lag_s) - 1 AS pos,
                count(*) OVER (PARTITION BY event_date) AS n
              FROM (SELECT event_date, computed_at_epoch - last_event_epoch AS lag_s FROM {_F})) GROUP BY 1, 2""",
            _F,
        ),
    }
