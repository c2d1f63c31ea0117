"""The feature rows of ``operators.window_features`` as a keyed stateful stream."""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulsefeed import settings as cfg
from pulsefeed.functions.times import time_of_day, us_to_seconds
from pulsefeed.operators.window_features import WindowSpec
from pulsefeed.schemas import ARRIVAL, FEATURE_COLUMNS, FEATURE_ROW, USER_STATE
from pulsefeed.sources.batch_log import BatchLog
from pulsefeed.sources.feature_log import PARTITIONS, batch_log, with_partitions
from pulsefeed.sources.latest_table import LatestTable, stream_run

USER = "pseudo_user_id"
# A column costs every group the same whatever its rows, so a user's events come in three.
_NUMBERS = ["event_us", *ARRIVAL]
_TEXTS = ["genre", "timezone", "event_date"]
_OUTPUT = T.StructType(
    [
        T.StructField(USER, T.StringType()),
        T.StructField("watch_count_10min", T.IntegerType()),
        T.StructField("category_affinity_score", T.DoubleType()),
        T.StructField("avg_watch_duration", T.DoubleType()),
        T.StructField("recency_score", T.DoubleType()),
        # Shares of the named genres, no number for those without an event in the window.
        T.StructField("genres", T.ArrayType(T.StringType())),
        T.StructField("shares", T.ArrayType(T.DoubleType())),
        T.StructField("event_us", T.LongType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("computed_at_epoch", T.DoubleType()),
        T.StructField("event_date", T.StringType()),
        T.StructField("arrival_us", T.LongType()),
        T.StructField("arrival_seq", T.LongType()),
    ]
)
_COLUMNS = pd.Index(_OUTPUT.fieldNames())


def _limbs(pct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A percentage as two integers (units of 2^-20 and 2^-60), so sums subtract exactly."""
    high = np.floor(pct * 2.0**20)
    low = np.rint((pct * 2.0**20 - high) * 2.0**40)
    return high.astype(np.int64), low.astype(np.int64)


def _exact(sums: np.ndarray, at: int) -> np.ndarray:
    return sums[:, at] / 2.0**20 + sums[:, at + 1] / 2.0**60


def _score(weight, exact_pct, n, shift, rate) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        raw = np.maximum(weight, 0.0) * np.exp(rate * shift) / (100.0 * n)
    return np.where((n > 0) & (exact_pct > 0), np.minimum(raw, 1.0), 0.0)


def _window_values(
    t: np.ndarray, pct: np.ndarray, genre_at: np.ndarray, genres: list[str], cutoff: np.ndarray, alive: np.ndarray, held: int, spec: WindowSpec
) -> dict[str, object]:
    """Feature values of the events after the first ``held``, which are earlier survivors.

    The same sweep as the batch plan: entries, carried-in entries and exits on
    the cutoff axis, summed slice by slice.
    """
    width = spec.slice_us
    home, leaves = cutoff // width, t // width
    crossing = np.flatnonzero(alive & (leaves > home))
    exits = np.flatnonzero(alive)
    every = np.arange(len(t))
    src = np.concatenate([every, crossing, exits])
    kind = np.repeat([1, 0, 2], [len(every), len(crossing), len(exits)])
    slice_ = np.concatenate([home, leaves[crossing], leaves[exits]])
    axis = np.concatenate([cutoff, leaves[crossing] * width, t[exits]])
    sign = np.concatenate([alive.astype(np.int64), np.ones(len(crossing), np.int64), -np.ones(len(exits), np.int64)])
    order = np.lexsort((src, kind, axis, slice_))
    src, kind, slice_, sign = src[order], kind[order], slice_[order], sign[order]

    missing = genre_at < 0
    names = sorted((g, at) for at, g in enumerate(genres) if g)
    high, low = _limbs(pct)
    columns = [np.ones(len(t), np.int64), high, low, np.where(missing, 0, high), np.where(missing, 0, low)]
    for _, at in names:
        hit = genre_at == at
        columns += [hit.astype(np.int64), np.where(hit, high, 0), np.where(hit, low, 0)]
    counts = np.stack(columns, axis=1)[src] * sign[:, None]
    age = np.where(alive[src], (t[src] - slice_ * width) / 1e6, 0.0)
    decayed = np.stack(
        [
            sign * pct[src] * np.exp(spec.recency_lambda * age),
            sign * np.where(missing, 0.0, pct)[src] * np.exp(spec.affinity_lambda * age),
        ],
        axis=1,
    )
    starts = np.flatnonzero(np.r_[True, slice_[1:] != slice_[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], len(src)]):
        np.cumsum(counts[a:b], axis=0, out=counts[a:b])
        np.cumsum(decayed[a:b], axis=0, out=decayed[a:b])

    # Rows of the new events, back in arrival order.
    asks = np.flatnonzero((kind == 1) & (src >= held))
    asks = asks[np.argsort(src[asks])]
    sums, decayed, now = counts[asks], decayed[asks], src[asks]
    shift = (slice_[asks] * width - t[now]) / 1e6
    n, total_pct = sums[:, 0], _exact(sums, 1)
    weights = np.stack([_exact(sums, 6 + 3 * i) for i in range(len(names))] or [np.zeros(len(now))], axis=1)
    total = weights.sum(axis=1, keepdims=True)
    present = sums[:, 5::3] > 0 if names else np.zeros((len(now), 1), bool)
    with np.errstate(invalid="ignore", divide="ignore"):
        shares = np.where(present & (total > 0), weights / total, np.nan)
    return {
        "watch_count_10min": n.astype(np.int32),
        "category_affinity_score": _score(decayed[:, 1], _exact(sums, 3), n, shift, spec.affinity_lambda),
        "avg_watch_duration": np.where(n > 0, total_pct / np.maximum(n, 1), 0.0),
        "recency_score": _score(decayed[:, 0], total_pct, n, shift, spec.recency_lambda),
        "genres": [g for g, _ in names],
        "shares": shares[:, : len(names)],
    }


def _step(key: tuple, rows: Iterator[pd.DataFrame], found: tuple | None, spec: WindowSpec) -> tuple[tuple, pd.DataFrame]:
    """One user's new state and feature rows. State and window are columns: an event is handled by itself only on the way in and out."""
    frames = list(rows)
    frame = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    numbers = np.array(frame["numbers"].tolist(), np.int64)
    # A shuffle loses arrival order within the batch: restore it first.
    order = np.lexsort((numbers[:, 2], numbers[:, 1]))
    numbers = numbers[order]
    pct = frame["watch_pct"].to_numpy(float)[order]
    texts = np.array(frame["texts"].tolist(), object)[order]
    hwm, times, pcts, places, genres = found[:5] if found else (0, b"", b"", b"", [])
    genres = list(genres)
    place_of = {g: k for k, g in enumerate(genres)}
    fresh = np.empty(len(order), np.int32)
    for k, g in enumerate(texts[:, 0].tolist()):
        if g is None:
            fresh[k] = -1
            continue
        if g not in place_of:
            place_of[g] = len(genres)
            genres.append(g)
        fresh[k] = place_of[g]
    t = np.concatenate([np.frombuffer(times, np.int64), numbers[:, 0]])
    pct = np.concatenate([np.frombuffer(pcts, float), pct])
    genre_at = np.concatenate([np.frombuffer(places, np.int32), fresh])
    held = len(t) - len(order)
    marks = np.maximum.accumulate(np.maximum(t[held:], hwm))
    cutoff = np.concatenate([np.full(held, hwm - spec.us), marks - spec.us])
    alive = t >= cutoff
    values = _window_values(t, pct, genre_at, genres, cutoff, alive, held, spec)

    kept = alive & (t >= cutoff[-1])
    used, compact = np.unique(genre_at[kept], return_inverse=True)
    if len(used) and used[0] < 0:
        used, compact = used[1:], compact - 1
    state = (int(marks[-1]), t[kept].tobytes(), pct[kept].tobytes(), compact.astype(np.int32).tobytes(), [genres[i] for i in used])
    values |= {c: numbers[:, k] for k, c in enumerate(_NUMBERS)}
    values |= {"timezone": texts[:, 1], "event_date": texts[:, 2], USER: key[0], "computed_at_epoch": time.time()}
    # One block of objects: a frame of typed columns costs a small group more than its window.
    block = np.empty((len(order), len(_COLUMNS)), object)
    for k, c in enumerate(_COLUMNS):
        if c in ("genres", "shares"):
            continue
        block[:, k] = values[c]
    at_genres, at_shares = _COLUMNS.get_loc("genres"), _COLUMNS.get_loc("shares")
    for i in range(len(order)):
        block[i, at_genres], block[i, at_shares] = values["genres"], values["shares"][i]
    return state, pd.DataFrame(block, columns=_COLUMNS, dtype=object)


class WindowState(StatefulProcessor):
    """The window as a processor whose state, in Avro, may gain fields over a restart."""

    def __init__(self, spec: WindowSpec, state: T.StructType = USER_STATE):
        self.spec, self.schema = spec, state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("window", self.schema)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new, out = _step(key, rows, self.state.get(), self.spec)
        # Fields added after these are null until they are filled.
        self.state.update(new + (None,) * (len(self.schema) - len(new)))
        yield out

    def close(self) -> None:
        pass


def _group_state(spec: WindowSpec):
    """The window as group state: handed over with the rows, in one exchange a batch with the worker."""

    def update(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new, out = _step(key, rows, state.get if state.exists else None, spec)
        state.update(new)
        yield out

    return update


def _vector_text(genres: Column, shares: Column) -> Column:
    """The genre vector as compact JSON, without absent genres."""
    pairs = F.filter(F.arrays_zip(genres.alias("g"), shares.alias("s")), lambda p: p["s"].isNotNull() & ~F.isnan(p["s"]))
    return F.to_json(F.map_from_entries(pairs))


def stream_features(
    events: DataFrame, spec: WindowSpec = WindowSpec(), state: T.StructType = USER_STATE, evolving: bool = False
) -> DataFrame:
    """Feature rows of a stream of parsed watch events, one per event.

    No watermark and no state expiry: late events are absorbed by the
    high-water mark. A user's state is the events of the last window, in RocksDB.
    With ``evolving`` it is encoded in Avro by ``transformWithState``, and a restart
    may add fields to it; that asks the state store once per user and batch, which
    costs more than the group state handed over with the rows. A checkpoint stays
    with the form it was begun in. The size of a micro-batch, and so of one user's
    share of it, is bounded by the source's rate options. Zone and vector text are
    made after the operator, in the JVM.
    """
    use_rocksdb(events.sparkSession, evolving)
    numbers = F.array(*[F.col(c).cast("long") for c in _NUMBERS]).alias("numbers")
    users = events.select(USER, "watch_pct", numbers, F.array(*_TEXTS).alias("texts")).groupBy(USER)
    if evolving:
        rows = users.transformWithStateInPandas(WindowState(spec, state), _OUTPUT, "append", "none")
    else:
        rows = users.applyInPandasWithState(_group_state(spec), _OUTPUT, USER_STATE, "append", GroupStateTimeout.NoTimeout)
    return rows.select(
        USER,
        "watch_count_10min",
        "category_affinity_score",
        "avg_watch_duration",
        time_of_day(F.col("event_us"), "timezone").alias("time_of_day_bucket"),
        "recency_score",
        _vector_text(F.col("genres"), F.col("shares")).alias("session_genre_vector"),
        us_to_seconds(F.col("event_us")).alias("last_event_epoch"),
        "computed_at_epoch",
        "event_date",
        *ARRIVAL,
    ).select(*FEATURE_COLUMNS, *ARRIVAL)


def log_writer(rows: DataFrame, path: str, checkpoint: str, max_rows: int | None = None) -> DataStreamWriter:
    """File sink for feature rows: date-partitioned Parquet, each batch exactly once.

    State, offsets and the sink's commit log advance together, so a restart
    from the checkpoint neither loses nor repeats rows.
    """
    writer = (
        with_partitions(rows)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*PARTITIONS)
        .outputMode("append")
    )
    return writer if max_rows is None else writer.option("maxRecordsPerFile", max_rows)


def flush_trigger(writer: DataStreamWriter) -> DataStreamWriter:
    """The cadence of a log alone: a micro-batch at least every flush interval."""
    return writer.trigger(processingTime=f"{cfg.LOG_FLUSH_SECONDS} seconds")


def online_trigger(writer: DataStreamWriter) -> DataStreamWriter:
    """The cadence of the online view: a micro-batch as soon as the one before is done, at most one a second."""
    return writer.trigger(processingTime=f"{cfg.ONLINE_TRIGGER_SECONDS} seconds")


def both_writer(
    rows: DataFrame, log_path: str, table: LatestTable, checkpoint: str, ttl_seconds: int = cfg.ONLINE_TTL_SECONDS,
    compact_every: int = cfg.COMPACT_EVERY_BATCHES,
) -> DataStreamWriter:
    """One stream into the online view and the feature log, so a feature is online when its batch is done.

    Both writes are named after the stream run and the batch and replace
    themselves when a batch is repeated: after a failure in between the retry
    brings them back in step. Many small batches leave many directories: the
    writes of every ``compact_every`` batches are folded into one.
    """
    log: BatchLog = batch_log(rows.sparkSession, log_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        run = stream_run(batch)
        # The state is stepped once; both writes read its rows from here.
        batch.persist()
        try:
            table.upsert(batch.withColumn("expires_at", F.col("computed_at_epoch") + F.lit(float(ttl_seconds))), batch_id, run)
            log.append(with_partitions(batch), batch_id, run)
        finally:
            batch.unpersist()
        if batch_id and batch_id % compact_every == 0:
            table.compact()
            log.compact(compact_every // 2)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def use_rocksdb(spark: SparkSession, evolving: bool = False) -> None:
    """State on local disk instead of the heap, with only changes uploaded per batch; if ``evolving``, in an encoding that may gain fields.

    A query takes these settings when it starts: start it before another kind of stateful stream is built in the session.
    """
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.encodingFormat", "avro" if evolving else "unsaferow")
