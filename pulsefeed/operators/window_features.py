"""Per-event features over a trailing event-time window that late data cannot move.

Rule, per user in arrival order: the high-water mark ``hwm`` is the largest
event time seen so far (at least 0); after each event exactly the events with
``event time >= hwm - W`` survive, and one feature row is emitted.

Because ``cutoff = hwm - W`` never falls, an event that survives its own
arrival enters at position ``cutoff at arrival`` of the cutoff axis and leaves
just after position ``its own event time``. So each aggregate over the
survivors is a running sum of entries minus exits along that one axis. No
event is ever paired with another: the cost is one sort, O(n log n), however
dense the window is.

The axis is cut into slices several windows long. A life spans at most W, so
it touches at most two slices, and each slice is summed on its own:

* kind 0: lives carried in from the previous slice, at the slice start;
* kind 1: the events themselves, at their cutoff (queries, and entries if alive);
* kind 2: exits, at the event time, after any query with that same cutoff.

Percentages are summed as decimals, so taking exits away is exact; decayed
weights are anchored at the slice start, which bounds their exponents.

Hot users are cut into pieces of consecutive arrivals (see ``_placed``). Events are
still shuffled once; those that leave in a later piece send a narrow row there.
"""

from __future__ import annotations

import json
import math
import time
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsefeed import settings as cfg
from pulsefeed.functions.times import floor_div, time_of_day, us_to_seconds
from pulsefeed.operators.scan import sliced_running
from pulsefeed.schemas import ARRIVAL, FEATURE_COLUMNS

USER = "pseudo_user_id"
_EXACT = "decimal(21,18)"
_SUM = "decimal(38,18)"
_GENRES = f"array<struct<genre:string,n:bigint,pct:{_SUM}>>"
_AXIS_CELLS = 64
# What a row is to the piece it is sent to: the sum of lives that reach into it, an arrival, the
# exit of an earlier piece's arrival, an arrival whose exit belongs to a later piece.
_CARRIED, _ARRIVES, _EXITS, _OUTLIVES = range(4)
_MAX_EXPONENT = 60.0


@dataclass(frozen=True)
class WindowSpec:
    """Window length, decay rates and the sizes at which work is split."""

    seconds: int = cfg.WINDOW_SECONDS
    recency_lambda: float = cfg.RECENCY_LAMBDA
    affinity_lambda: float = cfg.AFFINITY_LAMBDA
    hot_user_rows: int = cfg.HOT_USER_ROWS
    busy_slice_rows: int = cfg.BUSY_SLICE_ROWS
    max_windows_per_slice: int = 16

    @property
    def us(self) -> int:
        return self.seconds * cfg.MICROS

    @property
    def slice_us(self) -> int:
        """Axis slice: as many windows as keep decayed weights in double range."""
        rate = max(self.recency_lambda, self.affinity_lambda, 1e-9)
        windows = int(_MAX_EXPONENT / (rate * self.seconds)) - 1
        return self.us * max(1, min(self.max_windows_per_slice, windows))


# --- high-water mark and lateness -------------------------------------------


def _mark(df: DataFrame, spec: WindowSpec) -> DataFrame:
    cutoff = F.col("hwm_us") - F.lit(spec.us)
    return df.withColumn("cutoff_us", cutoff).withColumn("alive", F.col("event_us") >= F.col("cutoff_us"))


def _sizes(events: DataFrame, spec: WindowSpec) -> tuple[int, int]:
    """Rows per piece, and the number of tasks that the pieces are dealt over."""
    rows = events.count()
    every = max(1, min(spec.busy_slice_rows, cfg.PIECE_ROWS), math.ceil(rows / cfg.MAX_CUTS))
    return every, max(events.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / cfg.PIECE_ROWS))


def _up_to(values: str, at: str) -> str:
    """How many entries of a sorted array are at most ``at``, by halving; none of a missing array."""
    steps = ", ".join(str(1 << bit) for bit in reversed(range(cfg.MAX_USER_CUTS.bit_length())))
    return f"aggregate(array({steps}), 0, (n, step) -> IF(get({values}, n + step - 1) <= {at}, n + step, n))"


def _bounds(events: DataFrame, every: int) -> DataFrame:
    """Per cut user: where its pieces begin (the first at its first arrival), and the high-water mark before each.

    One arrival in ``every`` begins a piece, chosen by a hash of its key: no sort, no
    count per slice, and every reading of the events chooses the same ones. There are
    about MAX_CUTS at most, and MAX_USER_CUTS of one user, so the result is broadcast.
    """
    chosen = F.pmod(F.xxhash64(USER, *ARRIVAL), F.lit(every).cast("bigint")) == 0
    step = f"CAST(ceil(size(_all) / {cfg.MAX_USER_CUTS}D) AS INT)"
    cuts = (
        events.filter(chosen)
        .groupBy(USER)
        .agg(F.array_sort(F.collect_set(F.struct(*ARRIVAL))).alias("_all"))
        .selectExpr(USER, f"filter(_all, (c, i) -> i % {step} = 0) AS _cuts")
    )
    top = (
        events.join(F.broadcast(cuts), USER, "inner")
        .withColumn("_piece", F.expr(_up_to("_cuts", f"struct({', '.join(ARRIVAL)})")))
        .groupBy(USER, "_piece")
        .agg(F.max("event_us").alias("_top"))
    )
    earlier = Window.partitionBy(USER).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = F.greatest(F.max("_top").over(earlier), F.lit(0).cast("bigint"))
    marks = (
        top.withColumn("_before", before)
        .filter("_piece > 0")
        .groupBy(USER)
        .agg(F.array_sort(F.collect_list(F.struct("_piece", "_before"))).getField("_before").alias("_marks"))
    )
    return cuts.join(marks, USER, "inner")


def _placed(events: DataFrame, bounds: DataFrame, spec: WindowSpec) -> DataFrame:
    """The events with _piece, the mark before it (_start_us) and the piece of their exit (_last).

    A piece is a run of one user's arrivals. No cutoff before a piece is above ``mark before
    it - W`` and none from there on is below, so an exit belongs to the last piece
    whose ``mark - W`` it has reached. If that is a later piece than the arrival's, the event
    survived its arrival; if it is an earlier one, it did not. So the small table of
    bounds tells where each event is needed, and events are shuffled once.
    """
    at = f"struct({', '.join(ARRIVAL)})"
    found = events.join(F.broadcast(bounds), USER, "left").selectExpr(
        *events.columns, "_marks", f"{_up_to('_cuts', at)} AS _piece"
    )
    return found.selectExpr(
        *events.columns,
        "_piece",
        "coalesce(get(_marks, _piece - 1), 0L) AS _start_us",
        f"{_up_to('_marks', f'event_us + {spec.us}L')} AS _last",
    )


# Rows without a user are one group. A name no pseudonym can have stands in for the
# null inside the operators, so that every comparison and join is safe.
_NOBODY = "\u0001nobody"
_OTHER = "\u0001other"


def named_users(events: DataFrame) -> DataFrame:
    return events.withColumn(USER, F.coalesce(F.col(USER).cast("string"), F.lit(_NOBODY)))


def unnamed_users(rows: DataFrame) -> DataFrame:
    return rows.withColumn(USER, F.nullif(F.col(USER), F.lit(_NOBODY)))


def high_water_mark(events: DataFrame, spec: WindowSpec = WindowSpec(), split: bool = False) -> DataFrame:
    """Add hwm_us, cutoff_us and alive (survives its own arrival).

    ``split`` goes piece by piece instead of sorting each user's history in one task.
    """
    if split:
        every, tasks = _sizes(events, spec)
        placed = _placed(events, _bounds(events, every), spec).repartition(tasks, USER, "_piece")
        so_far = Window.partitionBy(USER, "_piece").orderBy(*ARRIVAL).rowsBetween(Window.unboundedPreceding, 0)
        marked = placed.withColumn("hwm_us", F.greatest(F.max("event_us").over(so_far), "_start_us"))
        marked = marked.drop("_piece", "_start_us", "_last")
    else:
        so_far = Window.partitionBy(USER).orderBy(*ARRIVAL).rowsBetween(Window.unboundedPreceding, 0)
        marked = events.withColumn(
            "hwm_us", F.greatest(F.max("event_us").over(so_far), F.lit(0).cast("bigint"))
        )
    return _mark(marked, spec)


_HOT_CACHE: dict[tuple, tuple[float, list[str] | None]] = {}
_HOT_CACHE_SECONDS = 600
_HOT_CACHE_ENTRIES = 64


def hot_users(events: DataFrame, threshold: int) -> list[str] | None:
    """Users with more than ``threshold`` rows; None when they are too many to list.

    One map-side combined count over a single column. At most rows/threshold
    users can qualify, and the list is cut off one past its bound. The answer
    only chooses between two exact plans, so queries over the same events share
    it for a few minutes.
    """
    limit = cfg.MAX_LISTED_HOT_USERS
    users = named_users(events.select(USER))
    key = (events.sparkSession.sparkContext.applicationId, users.semanticHash(), threshold, limit)
    known = _HOT_CACHE.get(key)
    if known is not None and time.monotonic() - known[0] < _HOT_CACHE_SECONDS:
        return known[1]
    found = users.groupBy(USER).count().filter(F.col("count") > threshold).select(USER).limit(limit + 1).collect()
    hot = None if len(found) > limit else [r[0] for r in found]
    if len(_HOT_CACHE) >= _HOT_CACHE_ENTRIES:
        _HOT_CACHE.clear()
    _HOT_CACHE[key] = (time.monotonic(), hot)
    return hot


def by_load(events: DataFrame, threshold: int) -> list[tuple[DataFrame, bool]]:
    """The events, of named users, as disjoint (part, needs splitting) pieces.

    A part to split has no rows without an arrival time: they have no place in its order.
    """
    hot = hot_users(events, threshold)
    arrived = events.filter(F.col("arrival_us").isNotNull())
    if hot is None:
        return [(arrived, True)]
    if not hot:
        return [(events, False)]
    listed = F.col(USER).isin(hot)
    return [(events.filter(~listed), False), (arrived.filter(listed), True)]


def mark_events(events: DataFrame, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """high_water_mark over ordinary and hot users alike."""
    parts = [
        high_water_mark(part, spec, split).select(*events.columns, "hwm_us", "cutoff_us", "alive")
        for part, split in by_load(named_users(events), spec.hot_user_rows)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return unnamed_users(out)


def classify_late(events: DataFrame, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """late: behind the high-water mark; beyond_window: behind the cutoff as well."""
    return mark_events(events, spec).select(
        *events.columns,
        "hwm_us",
        (F.col("event_us") < F.col("hwm_us")).alias("late"),
        (~F.col("alive")).alias("beyond_window"),
    )


# --- the sweep ----------------------------------------------------------------
#
# Written as SQL text: with a column per genre that is one call into the JVM per
# expression instead of dozens.


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sweep(marked: DataFrame, spec: WindowSpec, pieces: bool = False) -> DataFrame:
    """Entries, carried-in entries and exits on the cutoff axis, with their signed contributions.

    Adds slice, axis, kind, sign and d_n, d_pct, d_recency, d_affinity. With ``pieces`` the rows
    are those of ``_piece_rows``.
    """
    width = spec.slice_us
    home = floor_div(F.col("cutoff_us"), width)
    leaves = floor_div(F.col("event_us"), width)

    def step(slice_: str, axis: str, kind: int, sign: str) -> str:
        return f"struct({slice_} AS slice, {axis} AS axis, {kind} AS kind, CAST({sign} AS INT) AS sign)"

    entry = step("_home", "cutoff_us", 1, "alive")
    carry = step("_leaves", f"_leaves * {width}L", 0, "1")
    leave = step("_leaves", "event_us", 2, "-1")
    held = step("_carried.slice", f"_carried.slice * {width}L", 0, "1")
    elsewhere = f"""WHEN _role = {_CARRIED} THEN array({held}) WHEN _role = {_EXITS} THEN array({leave})
        WHEN _role = {_OUTLIVES} THEN IF(_leaves = _home, array({entry}), array({entry}, {carry}))"""
    steps = f"""explode(CASE {elsewhere if pieces else ""} WHEN NOT alive THEN array({entry})
        WHEN _leaves = _home THEN array({entry}, {leave}) ELSE array({entry}, {carry}, {leave}) END) AS _step"""
    # Ages count from the slice start, so exponents stay small.
    age = f"((event_us - _step.slice * {width}L) / {float(cfg.MICROS)}D)"
    moves = {
        "n": "CAST(_step.sign AS BIGINT)",
        "pct": f"CAST(CAST(watch_pct AS {_EXACT}) * _step.sign AS {_EXACT})",
        "recency": f"_step.sign * watch_pct * exp({spec.recency_lambda}D * {age})",
        "affinity": f"_step.sign * watch_pct * exp({spec.affinity_lambda}D * {age})",
    }
    if pieces:
        moves = {name: f"IF(_role = {_CARRIED}, _carried.{name}, {expr})" for name, expr in moves.items()}
    placed = marked.withColumns({"_home": home, "_leaves": leaves}).selectExpr(*marked.columns, steps)
    return placed.selectExpr(*marked.columns, "_step.*", *[f"{expr} AS d_{name}" for name, expr in moves.items()])


def _measures(genres: list[str]) -> dict[str, str]:
    """What each running sum adds up, per sweep row."""
    zero = f"CAST(0 AS {_EXACT})"
    out = {
        "n": "d_n",
        "pct": "d_pct",
        "recency": "d_recency",
        # A null genre carries no preference; an empty one counts for affinity only.
        "tagged_pct": f"IF(genre IS NOT NULL, d_pct, {zero})",
        "affinity": "IF(genre IS NOT NULL, d_affinity, 0D)",
        "named_pct": f"IF(genre <> '', d_pct, {zero})",
    }
    for i, g in enumerate(genres):
        hit = f"genre = {_quoted(g)}"
        out[f"gn_{i}"] = f"IF({hit}, d_n, 0L)"
        out[f"gp_{i}"] = f"IF({hit}, d_pct, {zero})"
    return out


def _running(swept: DataFrame, keys: list[str], genres: list[str]) -> DataFrame:
    """The running sums at the events themselves: one sort inside the partitioning that the rows have."""
    along = (
        f"PARTITION BY {', '.join([*keys, 'slice'])} ORDER BY axis, kind, {', '.join(ARRIVAL)} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    )
    sums = [f"sum({expr}) OVER ({along}) AS w_{name}" for name, expr in _measures(genres).items()]
    return swept.selectExpr("*", *sums).filter("kind = 1")


def _running_split(events: DataFrame, spec: WindowSpec, genres: list[str]) -> DataFrame:
    """The same sums for users too large for one task, piece by piece."""
    every, tasks = _sizes(events, spec)
    rows = _piece_rows(events, _bounds(events, every), spec, genres).repartition(tasks, USER, "_piece")
    arrived = F.when(F.col("_role").isin(_ARRIVES, _OUTLIVES), F.col("event_us"))
    so_far = Window.partitionBy(USER, "_piece").orderBy(*ARRIVAL).rowsBetween(Window.unboundedPreceding, 0)
    marked = _mark(rows.withColumn("hwm_us", F.greatest(F.max(arrived).over(so_far), "_start_us")), spec)
    return _running(_sweep(marked, spec, pieces=True), [USER, "_piece"], genres)


def _piece_rows(events: DataFrame, bounds: DataFrame, spec: WindowSpec, genres: list[str]) -> DataFrame:
    """What each piece needs, _role telling what a row is: its arrivals, exits of earlier ones, carried sums."""
    placed = _placed(events, bounds, spec)
    sent = f"""explode(IF(_last > _piece,
        array(struct(_piece AS to, {_OUTLIVES} AS role), struct(_last AS to, {_EXITS} AS role)),
        array(struct(_piece AS to, {_ARRIVES} AS role)))) AS _sent"""
    # An exit is told by its time, percentage and genre.
    whole = {USER, "event_us", "watch_pct", "genre"}
    columns = [c if c in whole else f"IF(_sent.role = {_EXITS}, NULL, {c}) AS {c}" for c in [*events.columns, "_start_us"]]
    own = placed.selectExpr(*events.columns, "_start_us", sent).selectExpr(
        *columns, "_sent.to AS _piece", "_sent.role AS _role"
    )
    return own.unionByName(_carried(placed, bounds, spec, genres), allowMissingColumns=True)


def _carried(placed: DataFrame, bounds: DataFrame, spec: WindowSpec, genres: list[str]) -> DataFrame:
    """Sums over the lives that began before a piece and last into it, for the slices of it that they reach.

    A life counts from the piece after its own up to that of its exit: changes per piece, combined
    map-side, then their running sum, which is repeated for pieces without a change. One
    row per (piece, slice of exit, genre), and a life reaches at most two slices of a piece.
    """
    width = spec.slice_us
    age = f"((event_us - slice * {width}L) / {float(cfg.MICROS)}D)"
    listed = ", ".join(["''", *map(_quoted, genres)])
    # Genres without a column of their own are alike to every sum.
    change = "explode(array(struct(_piece + 1 AS piece, 1 AS sign), struct(_last + 1 AS piece, -1 AS sign))) AS _at"
    changes = (
        placed.filter("_last > _piece")
        .withColumn("slice", floor_div(F.col("event_us"), width))
        .selectExpr(
            USER, "slice", f"IF(genre IS NULL OR genre IN ({listed}), genre, {_quoted(_OTHER)}) AS genre", change,
            f"CAST(watch_pct AS {_EXACT}) AS pct",
            f"watch_pct * exp({spec.recency_lambda}D * {age}) AS recency",
            f"watch_pct * exp({spec.affinity_lambda}D * {age}) AS affinity",
        )
        .groupBy(USER, "slice", "genre", F.col("_at.piece").alias("_from"))
        .agg(
            F.expr("sum(_at.sign) AS n"),
            *[F.expr(f"sum(IF(_at.sign > 0, {c}, -{c})) AS {c}") for c in ("pct", "recency", "affinity")],
        )
    )
    along = f"(PARTITION BY {USER}, slice, genre ORDER BY _from ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    lasting = changes.selectExpr(
        USER, "slice", "genre", "_from", f"lead(_from) OVER (PARTITION BY {USER}, slice, genre ORDER BY _from) - 1 AS _to",
        *[f"sum({c}) OVER {along} AS {c}" for c in ("n", "pct", "recency", "affinity")],
    ).filter("n > 0")
    at_start = (
        lasting.selectExpr(USER, "slice", "genre", "n", "pct", "recency", "affinity", "explode(sequence(_from, _to)) AS _piece")
        .join(F.broadcast(bounds), USER, "inner")
        .withColumn("_first", floor_div(F.expr(f"get(_marks, _piece - 1) - {spec.us}L"), width))
        .selectExpr("*", "explode(IF(_first < slice, array(slice, _first), array(slice))) AS _in")
    )
    # Weights count from the start of the slice they are added in.
    shift = f"((slice - _in) * {width // cfg.MICROS}D)"
    return at_start.selectExpr(
        USER, "genre", "_piece", f"{_CARRIED} AS _role",
        f"struct(_in AS slice, n, CAST(pct AS {_SUM}) AS pct, recency * exp({spec.recency_lambda}D * {shift}) AS recency, "
        f"affinity * exp({spec.affinity_lambda}D * {shift}) AS affinity) AS _carried",
    )


def _score(weight: str, exact_pct: str, rate: float, spec: WindowSpec) -> str:
    """min(decayed sum / (100 n), 1), seen from the event's own time.

    Exactly zero percent in the window is exactly zero, never rounding noise.
    """
    shift = f"((slice * {spec.slice_us}L - event_us) / {float(cfg.MICROS)}D)"
    raw = f"greatest({weight}, 0D) * exp({rate}D * {shift}) / (100D * w_n)"
    return f"IF(w_n > 0 AND {exact_pct} > 0, least({raw}, 1D), 0D)"


def _genre_entries(genres: list[str]) -> str:
    entries = [
        f"struct({_quoted(g)} AS genre, w_gn_{i} AS n, CAST(w_gp_{i} AS {_SUM}) AS pct)" for i, g in enumerate(genres)
    ]
    return f"filter(CAST(array({', '.join(entries)}) AS {_GENRES}), e -> e.n > 0)"


def _vector_json(genres: list[str]) -> str:
    """The normalized genre weights as compact JSON with sorted keys, straight from the sums.

    Plain string functions stay inside generated code; a map built per row would not.
    """
    if not genres:
        return "'{}'"
    entries = [
        f"IF(w_gn_{i} > 0, concat({_quoted(json.dumps(g, ensure_ascii=False) + ':')}, "
        f"CAST(CAST(w_gp_{i} AS DOUBLE) / CAST(w_named_pct AS DOUBLE) AS STRING)), NULL)"
        for i, g in enumerate(genres)
    ]
    return f"IF(w_named_pct > 0, concat('{{', concat_ws(',', {', '.join(entries)}), '}}'), '{{}}')"


def distinct_genres(events: DataFrame, limit: int = cfg.MAX_GENRE_COLUMNS) -> list[str] | None:
    """Sorted non-empty genres of the events; None when there are more than ``limit``."""
    found = (
        events.filter(F.col("genre").isNotNull() & (F.col("genre") != ""))
        .select("genre").distinct().limit(limit + 1).collect()
    )
    return None if len(found) > limit else sorted(r[0] for r in found)


def window_state(
    events: DataFrame,
    spec: WindowSpec = WindowSpec(),
    genres: list[str] | None = None,
    in_order: bool = False,
    with_genres: bool = True,
) -> DataFrame:
    """Every event with the aggregates of its surviving window.

    Adds watch_count, avg_watch_duration, recency_score, category_affinity_score,
    named_pct (percent over non-empty genres) and, with_genres, the same weights
    by genre as genre_counts (array of (genre, n, pct), sorted) and as the JSON
    session_genre_vector. Columns a caller does not select are not computed.

    ``genres`` lists the genres to sum if the caller knows them all; a genre beyond it fails the query. ``in_order``
    promises that no event is late: the high-water mark is then the event time
    itself, and rows go straight to (user, slice).
    """
    wide: list[str] = []
    long_form = False
    if with_genres:
        known = sorted(set(genres)) if genres is not None else distinct_genres(events)
        long_form = known is None or len(known) > cfg.MAX_GENRE_COLUMNS
        wide = [] if long_form else known

    if genres is not None:
        events = _only_listed(events, sorted(set(genres)))
    parts = []
    for part, split in by_load(named_users(events), spec.hot_user_rows):
        if in_order:
            marked = _mark(part.withColumn("hwm_us", F.greatest("event_us", F.lit(0).cast("bigint"))), spec)
        elif long_form or not split:
            marked = high_water_mark(part, spec, split)
        running = _running_split(part, spec, wide) if split else _running(_sweep(marked, spec), [USER], wide)
        state = running.selectExpr(
            *events.columns,
            "hwm_us",
            "cutoff_us",
            "alive",
            "w_n AS watch_count",
            "IF(w_n > 0, CAST(w_pct AS DOUBLE) / w_n, 0D) AS avg_watch_duration",
            _score("w_recency", "w_pct", spec.recency_lambda, spec) + " AS recency_score",
            _score("w_affinity", "w_tagged_pct", spec.affinity_lambda, spec) + " AS category_affinity_score",
            "w_named_pct AS named_pct",
            _genre_entries(wide) + " AS genre_counts",
            _vector_json(wide) + " AS session_genre_vector",
        )
        if long_form:
            state = _with_long_genres(state, marked, spec)
        parts.append(state)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return unnamed_users(out)


def _only_listed(events: DataFrame, genres: list[str]) -> DataFrame:
    """The events; a genre that a caller's list lacks is an error, not a row that sums miss."""
    stray = F.col("genre").isNotNull() & (F.col("genre") != "") & ~F.col("genre").isin(genres)
    message = F.concat(F.lit("genre not in the given list: "), F.col("genre"))
    return events.withColumn("genre", F.when(stray, F.raise_error(message).cast("string")).otherwise(F.col("genre")))


def _with_long_genres(state: DataFrame, marked: DataFrame, spec: WindowSpec) -> DataFrame:
    """genre_counts for vocabularies too wide for a column each.

    The sweep runs per (user, slice, genre). A query is asked once for each
    genre alive in its slice, so the extra rows are proportional to the vectors
    being produced, not to pairs of events.
    """
    # No exponents here, so slices as short as a window: a query then meets
    # hardly more genres than its vector lists.
    spec = replace(spec, max_windows_per_slice=1)
    width = spec.slice_us
    rows = _sweep(marked, spec)
    tagged = F.col("genre").isNotNull() & (F.col("genre") != "")
    moves = rows.filter(tagged & (F.col("sign") != 0)).select(
        USER, "slice", "genre", "axis", "kind", *ARRIVAL, F.lit(False).alias("asks"), "sign", "d_pct",
    )
    present = moves.select(USER, "slice", "genre").distinct()
    asks = (
        rows.filter(F.col("kind") == 1)
        .select(USER, "slice", "axis", "kind", *ARRIVAL)
        .join(present, [USER, "slice"], "inner")
        .select(
            USER, "slice", "genre", "axis", "kind", *ARRIVAL,
            F.lit(True).alias("asks"), F.lit(0).alias("sign"), F.lit(0).cast(_EXACT).alias("d_pct"),
        )
    )
    cells = moves.unionByName(asks).withColumn("axis_cell", floor_div(F.col("axis"), width // _AXIS_CELLS))
    summed = sliced_running(
        cells,
        [USER, "slice", "genre"],
        ["axis_cell"],
        ["axis", "kind", *ARRIVAL, "asks"],
        {"n": ("sum", F.col("sign")), "pct": ("sum", F.col("d_pct"))},
    )
    vectors = (
        summed.filter(F.col("asks") & (F.col("n") > 0))
        .groupBy(USER, *ARRIVAL)
        .agg(
            F.array_sort(
                F.collect_list(F.struct("genre", F.col("n").cast("bigint").alias("n"), F.col("pct").cast(_SUM).alias("pct")))
            ).alias("genre_counts")
        )
    )
    none = F.array().cast(_GENRES)
    return (
        state.drop("genre_counts", "session_genre_vector")
        .join(vectors, [USER, *ARRIVAL], "left")
        .withColumn("genre_counts", F.coalesce("genre_counts", none))
        .withColumn("session_genre_vector", _vector_from_counts(F.col("genre_counts"), F.col("named_pct").cast("double")))
    )


# --- feature rows ---------------------------------------------------------------


def _vector_from_counts(counts: Column, total: Column) -> Column:
    shares = F.map_from_entries(
        F.transform(counts, lambda e: F.struct(e["genre"].alias("k"), (e["pct"].cast("double") / total).alias("v")))
    )
    return F.when(total > 0, F.to_json(shares)).otherwise(F.lit("{}"))


def feature_rows(
    events: DataFrame,
    computed_at: Column | None = None,
    spec: WindowSpec = WindowSpec(),
    genres: list[str] | None = None,
) -> DataFrame:
    """One feature row per event, with its arrival position.

    ``computed_at`` is epoch seconds as an expression over the events; the
    default is the wall clock of the run.
    """
    clock = computed_at if computed_at is not None else F.unix_micros(F.current_timestamp()) / float(cfg.MICROS)
    state = window_state(events.withColumn("_computed_at", clock.cast("double")), spec, genres)
    return state.select(
        USER,
        F.col("watch_count").cast("int").alias("watch_count_10min"),
        "category_affinity_score",
        "avg_watch_duration",
        time_of_day(F.col("event_us"), "timezone").alias("time_of_day_bucket"),
        "recency_score",
        "session_genre_vector",
        us_to_seconds(F.col("event_us")).alias("last_event_epoch"),
        F.col("_computed_at").alias("computed_at_epoch"),
        "event_date",
        *ARRIVAL,
    ).select(*FEATURE_COLUMNS, *ARRIVAL)


def genre_weights(events: DataFrame, spec: WindowSpec = WindowSpec(), genres: list[str] | None = None) -> DataFrame:
    """Long form of the session genre counts: one row per (event, surviving genre)."""
    state = window_state(events, spec, genres)
    return state.select(
        USER, *ARRIVAL, F.col("named_pct").cast("double").alias("_total"), F.explode("genre_counts").alias("e")
    ).select(
        USER,
        *ARRIVAL,
        F.col("e.genre").alias("genre"),
        (F.col("e.pct").cast("double") / 100.0).alias("weight"),
        F.when(F.col("_total") > 0, F.col("e.pct").cast("double") / F.col("_total")).alias("share"),
    )
