"""Jobs, for spark-submit: ``python -m pulsefeed <job> --help``.

Paths may be on any Hadoop file system; checkpoints belong on shared storage.
Restarting a failed stream is left to the job runner: it resumes from its
checkpoint.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from pulsefeed import settings as cfg
from pulsefeed.operators import ingest, recommend, retention
from pulsefeed.operators.consent import read_consent
from pulsefeed.plans.serving import recommend_users
from pulsefeed.plans.training import TrainingConfig, train_and_register
from pulsefeed.schemas import ARRIVAL
from pulsefeed.session import build_session
from pulsefeed.sources import messages, reports
from pulsefeed.sources.artifacts import ModelRegistry
from pulsefeed.streaming import consent as consent_stream
from pulsefeed.sources.latest_table import stream_run
from pulsefeed.streaming import features, online, scoring


def _run(writer: DataStreamWriter, once: bool) -> None:
    """Until stopped, or until everything available has been processed."""
    writer = writer.trigger(availableNow=True) if once else features.flush_trigger(writer)
    writer.start().awaitTermination()


def _start(writer: DataStreamWriter, once: bool):
    return (writer.trigger(availableNow=True) if once else features.flush_trigger(writer)).start()


def _rejects_writer(rejects: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Rejected input as it came, with its reason, through the exactly-once file sink."""
    return rejects.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)


def _publish(checked: DataFrame, payload: DataFrame, args: argparse.Namespace) -> None:
    """Publish what passed the boundary and store what did not, without the user id."""
    fields = [c for c in payload.columns if c not in ARRIVAL]
    out = messages.publish_stream(
        payload, f"{args.checkpoint}/published", servers=args.kafka, topic=args.topic, path=args.messages, fields=fields
    )
    rejects = _rejects_writer(ingest.rejected(checked).drop("user_id"), args.rejects, f"{args.checkpoint}/rejects")
    for query in [_start(out, args.once), _start(rejects, args.once)]:
        query.awaitTermination()


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Check raw watch events, replace the user ids, publish what passes and store what does not."""
    checked = ingest.check_watch(messages.raw_watch(spark, args.events, args.max_files))
    _publish(checked, ingest.watch_payload(ingest.accepted(checked), cfg.pseudonym_secret(), extra=ARRIVAL), args)


def run_sessions(spark: SparkSession, args: argparse.Namespace) -> None:
    """The same for session starts."""
    checked = ingest.check_session(messages.raw_sessions(spark, args.events, args.max_files))
    _publish(checked, ingest.session_payload(ingest.accepted(checked), cfg.pseudonym_secret(), extra=ARRIVAL), args)


def run_features(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.kafka:
        source = messages.kafka_messages(spark, args.kafka, args.topic)
    else:
        source = messages.file_messages(spark, args.messages, args.max_files)
    rows = features.stream_features(ingest.parse_messages(source), evolving=args.evolving)
    if args.online:
        table = online.online_table(spark, args.online)
        writer = features.both_writer(rows, args.log, table, args.checkpoint, args.ttl)
        writer = writer.trigger(availableNow=True) if args.once else features.online_trigger(writer)
        queries = [writer.start()]
    else:
        queries = [_start(features.log_writer(rows, args.log, args.checkpoint), args.once)]
    if args.rejects:
        rejected = ingest.rejected(ingest.check_messages(source)).select(*source.columns, ingest.REASON)
        queries.append(_start(_rejects_writer(rejected, args.rejects, f"{args.checkpoint}-rejects"), args.once))
    for query in queries:
        query.awaitTermination()


def run_consent(spark: SparkSession, args: argparse.Namespace) -> None:
    """Keep the current consent and the audit log from a stream of changes."""
    changes = consent_stream.change_stream(spark, args.changes, args.max_files)
    table = consent_stream.consent_table(spark, args.table)
    _run(consent_stream.consent_writer(changes, table, args.audit, args.checkpoint), args.once)


def run_online(spark: SparkSession, args: argparse.Namespace) -> None:
    table = online.online_table(spark, args.table)
    _run(online.online_writer(online.log_stream(spark, args.log, args.max_files), table, args.checkpoint, args.ttl), args.once)


def run_score(spark: SparkSession, args: argparse.Namespace) -> None:
    """Score feature rows as they are logged, with the model that is current at each batch."""

    def store(scored: DataFrame, version: int, batch_id: int) -> None:
        out = scored.select("pseudo_user_id", "last_event_epoch", "engagement", F.lit(version).alias("model_version"))
        out.write.mode("overwrite").parquet(f"{args.out}/batch={stream_run(scored)}.{batch_id}")

    rows = online.log_stream(spark, args.log, args.max_files)
    _run(scoring.scoring_writer(rows, scoring.CurrentModel(ModelRegistry(spark, args.registry)), store, args.checkpoint), args.once)


def run_train(spark: SparkSession, args: argparse.Namespace) -> None:
    config = TrainingConfig(
        range_days=args.days, validation_days=args.validation_days, model_type=args.model_type, alias=args.alias,
        params={} if args.rounds is None else {"maxIter": args.rounds},
    )
    version = train_and_register(spark, args.log, ModelRegistry(spark, args.registry), args.as_of, config)
    print(f"registered version {version} as {args.alias}")


def run_recommend(spark: SparkSession, args: argparse.Namespace) -> None:
    registry = ModelRegistry(spark, args.registry)
    version = registry.resolve()
    model = None if version is None else (*registry.load(version), version)
    table = consent_stream.consent_table(spark, args.consent)
    out = recommend_users(
        spark.read.parquet(args.users).select("pseudo_user_id").distinct(),
        read_consent(spark, table.read),
        online.online_table(spark, args.online).read(),
        F.lit(args.as_of_epoch) if args.as_of_epoch is not None else F.unix_micros(F.current_timestamp()) / 1e6,
        recommend.catalog_frame(spark),
        recommend.trending_frame(spark),
        model,
        args.top_n,
    )
    out.write.mode("overwrite").parquet(args.out)


def run_retention(spark: SparkSession, args: argparse.Namespace) -> None:
    months = retention.drop_expired(spark, args.audit, args.as_of, args.keep_months, args.archive, args.dry_run)
    print(("would drop " if args.dry_run else "dropped ") + (", ".join(months) or "nothing"))


def run_slo(spark: SparkSession, args: argparse.Namespace) -> None:
    reports.write_slo_snapshot(reports.read_request_log(spark, args.requests, args.format), args.out)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pulsefeed")
    jobs = top.add_subparsers(dest="job", required=True)
    day = dt.date.fromisoformat

    def job(name: str, run, *paths: str, stream: bool = False) -> argparse.ArgumentParser:
        p = jobs.add_parser(name)
        p.set_defaults(run=run)
        for path in paths:
            p.add_argument(f"--{path}", required=True)
        if stream:
            p.add_argument("--checkpoint", required=True)
            p.add_argument("--once", action="store_true", help="process what is available, then stop")
            p.add_argument("--max-files", type=int, default=cfg.MAX_FILES_PER_BATCH, help="most input files of a micro-batch")
        return p

    for name, run, topic in (("ingest", run_ingest, cfg.WATCH_TOPIC), ("sessions", run_sessions, cfg.SESSION_TOPIC)):
        p = job(name, run, "events", "rejects", stream=True)
        target = p.add_mutually_exclusive_group(required=True)
        target.add_argument("--kafka", help="bootstrap servers")
        target.add_argument("--messages", help="directory of message files")
        p.add_argument("--topic", default=topic)
    job("consent", run_consent, "changes", "table", "audit", stream=True)
    p = job("features", run_features, "log", stream=True)
    p.add_argument("--rejects", help="directory for rejected messages")
    p.add_argument("--evolving", action="store_true", help="keep state in a form that may gain fields over a restart")
    p.add_argument("--online", help="online table to keep from the same stream, a micro-batch a second")
    p.add_argument("--ttl", type=int, default=cfg.ONLINE_TTL_SECONDS)
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", help="bootstrap servers")
    source.add_argument("--messages", help="directory of message files")
    p.add_argument("--topic", default=cfg.WATCH_TOPIC)
    p = job("online", run_online, "log", "table", stream=True)
    p.add_argument("--ttl", type=int, default=cfg.ONLINE_TTL_SECONDS)
    job("score", run_score, "log", "registry", "out", stream=True)
    p = job("train", run_train, "log", "registry")
    p.add_argument("--as-of", type=day, default=dt.date.today())
    p.add_argument("--days", type=int, default=cfg.TRAINING_RANGE_DAYS)
    p.add_argument("--validation-days", type=int, default=cfg.VALIDATION_DAYS)
    p.add_argument("--model-type", default="gbt")
    p.add_argument("--rounds", type=int)
    p.add_argument("--alias", default="staging")
    p = job("recommend", run_recommend, "users", "consent", "online", "registry", "out")
    p.add_argument("--top-n", type=int, default=cfg.TOP_N_DEFAULT)
    p.add_argument("--as-of-epoch", type=float)
    p = job("retention", run_retention, "audit")
    p.add_argument("--as-of", type=day, default=dt.date.today())
    p.add_argument("--keep-months", type=int, default=cfg.AUDIT_RETENTION_MONTHS)
    p.add_argument("--archive")
    p.add_argument("--dry-run", action="store_true")
    p = job("slo", run_slo, "requests", "out")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(f"pulsefeed-{args.job}"), args)


if __name__ == "__main__":
    main()
