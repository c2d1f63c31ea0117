import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pulsefeed import settings as cfg
from pulsefeed.operators import evaluation as ev
from pulsefeed.operators import matrix, recommend, registry
from pulsefeed.plans import serving, training
from pulsefeed.schemas import FEATURE_ROW
from pulsefeed.sources import feature_log as log
from pulsefeed.sources.artifacts import ModelRegistry
from pulsefeed.streaming.scoring import CurrentModel, scoring_writer


def row(user="u", epoch=0.0, avg=60.0, vector="{}", date="2026-05-01", count=3, bucket="evening", recency=0.7, affinity=0.5):
    return (user, count, affinity, avg, bucket, recency, vector, float(epoch), float(epoch), date)


def rows(spark, data):
    return spark.createDataFrame(data, FEATURE_ROW)


def many(n=600, days=20, seed=1):
    """Label depends on avg_watch_duration; recency follows it loosely."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        avg = rng.random() * 100
        vector = rng.choice(["{}", '{"drama":1.0}', '{"action":0.4,"sci-fi":0.6}'])
        day = dt.date(2026, 5, 1) + dt.timedelta(days=i % days)
        out.append(row(f"u{i % 50}", i, avg, vector, day.isoformat(), rng.randrange(1, 9), rng.choice(cfg.TIME_OF_DAY),
                       min(1.0, avg / 100 * rng.random() * 1.5)))
    return out


def test_known_genres(spark):
    df = rows(spark, [row(vector='{"drama":0.5,"action":0.5}'), row(vector='{"action":0.0,"zebra":0.0}'), row(vector="not-json"),
                      row(vector="[1]"), row(vector="{}")])
    assert matrix.known_genres(df) == ["action", "drama", "zebra"]


def test_matrix_expands_labels_and_orders(spark):
    df = rows(spark, [row("a", avg=75.0, vector='{"drama":0.6,"other":0.4}'), row("b", avg=50.0), row("c", avg=70.0, vector="not-json"),
                      row("d", avg=69.999999, bucket="noon")])
    x = matrix.feature_matrix(df, ["action", "drama"], keep=["pseudo_user_id"])
    assert [c for c in x.columns if c.startswith("genre_")] == ["genre_action", "genre_drama"]
    got = {r["pseudo_user_id"]: r for r in x.collect()}
    assert (got["a"]["genre_drama"], got["a"]["genre_action"], got["c"]["genre_drama"]) == (0.6, 0.0, 0.0)
    assert [got[u][cfg.LABEL] for u in "abcd"] == [1, 0, 1, 0]
    assert (got["a"]["time_of_day_index"], got["d"]["time_of_day_index"]) == (2, None)


def test_contract(spark):
    c = matrix.schema_contract(["action", "drama"])
    assert [f["name"] for f in c["features"]] == cfg.BASE_FEATURES + ["time_of_day_bucket", "genre_action", "genre_drama"]
    assert {f["name"]: f["dtype"] for f in c["features"]}["watch_count_10min"] == "int32"
    assert c["label_definition"] == "avg_watch_duration >= 70.0"
    assert matrix.contract_differences(FEATURE_ROW, c) == []
    wrong = StructType([StructField("watch_count_10min", StringType()) if f.name == "watch_count_10min" else f
                        for f in FEATURE_ROW.fields if f.name != "recency_score"])
    assert matrix.contract_differences(wrong, c) == [("recency_score", "missing"), ("watch_count_10min", "expected int, found string")]
    with pytest.raises(ValueError):
        matrix.serving_columns({"features": []})


def test_split_is_by_observed_date(spark):
    df = rows(spark, [row(date=f"2026-05-{d:02d}") for d in (1, 2, 5, 9, 10)])
    train, val = matrix.chronological_split(df, 2)
    assert sorted(r["event_date"] for r in val.collect()) == ["2026-05-09", "2026-05-10"]
    assert train.count() == 3
    with pytest.raises(ValueError):
        matrix.chronological_split(df, 5)


def _auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def test_auc_and_precision_are_exact(spark):
    rng = random.Random(3)
    pairs = [(rng.choice([0.0, 1.0, 0.5, round(rng.random(), 2), rng.random() ** 8]), rng.randrange(2)) for _ in range(400)]
    df = spark.createDataFrame([(s, y, i) for i, (s, y) in enumerate(pairs)], "score double, engaged int, id long")
    assert ev.auc(df).first()["auc"] == pytest.approx(_auc(pairs), abs=1e-12)
    assert training.evaluate(df, ["id"])["auc"] == pytest.approx(_auc(pairs), abs=1e-9)
    top = sorted(range(400), key=lambda i: (-pairs[i][0], i))[:10]
    assert ev.precision_at_k(df, ["id"]).first()["precision_at_k"] == pytest.approx(sum(pairs[i][1] for i in top) / 10)
    few = df.limit(3)
    assert ev.precision_at_k(few, ["id"]).first()["k"] == 3
    assert ev.auc(df.filter("engaged = 1")).first()["auc"] is None


def test_trainers_by_name():
    assert sorted(training.TRAINERS) == ["gbt", "logistic", "random_forest"]
    with pytest.raises(ValueError, match="gbt"):
        training.make_trainer("nope")


@pytest.mark.parametrize("kind,params", [("gbt", {"maxIter": 3}), ("random_forest", {"numTrees": 5}), ("logistic", {"maxIter": 5})])
def test_train_each_type(spark, kind, params):
    result = training.train(rows(spark, many(300)), training.TrainingConfig(model_type=kind, params=params))
    names = [f["name"] for f in result.contract["features"]]
    assert result.metrics["auc"] > 0.9
    assert {f"importance_{n}" for n in names} < set(result.metrics)
    assert result.params["train_rows"] + result.params["val_rows"] == 300
    assert "genre_sci-fi" in names


def test_label_source_can_be_dropped(spark):
    result = training.train(rows(spark, many(300)), training.TrainingConfig(params={"maxIter": 2}, drop_label_source=True))
    assert "avg_watch_duration" not in [f["name"] for f in result.contract["features"]]


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("models")
    path = str(root / "log")
    log.write_log(rows(spark, many()), path)
    reg = ModelRegistry(spark, str(root / "registry"))
    config = training.TrainingConfig(params={"maxIter": 3})
    first = training.train_and_register(spark, path, reg, dt.date(2026, 5, 25), config)
    return reg, first, path, config


def test_register_resolve_promote(spark, trained):
    reg, first, path, config = trained
    assert first == 1 and reg.resolve() == 1
    second = training.train_and_register(spark, path, reg, dt.date(2026, 5, 25), config)
    assert second == 2 and reg.resolve() == 2
    assert not reg.promote(1, {"auc": 1.1})
    assert reg.promote(1, {"auc": 0.5, "precision_at_10": 0.1})
    assert reg.resolve() == 1 and reg.resolve(["staging"]) == 2
    assert {(r["alias"], r["version"]) for r in reg.aliases().collect()} == {("production", 1), ("staging", 2)}
    _, contract = reg.load(1)
    assert contract["label"] == "engaged" and contract["genres"] == ["action", "drama", "sci-fi"]
    with pytest.raises(ValueError):
        reg.set_alias(99, "production")


def test_two_trainings_at_once_get_two_versions(spark, trained, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    model, contract = trained[0].load(1)
    registries = [ModelRegistry(spark, str(tmp_path / "models")) for _ in range(2)]
    one = lambda r: r.register(model, contract | {"by": id(r)}, "staging", "gbt", {}, {"auc": 0.5})
    with ThreadPoolExecutor(2) as pool:
        versions = list(pool.map(one, registries))
    assert sorted(versions) == [1, 2]
    for r, v in zip(registries, versions):
        assert r.load(v)[1]["by"] == id(r)
    assert registries[0].register(model, contract, "staging", "gbt", {}, {}) == 3
    with pytest.raises(ValueError, match="no version"):
        registries[0].load(9)


def test_wide_vocabularies_train_and_serve_as_one_vector(spark, monkeypatch):
    """The same model comes out of a column per genre and of one sparse column."""
    data = rows(spark, many())
    narrow = training.train(data, training.TrainingConfig(model_type="logistic"))
    monkeypatch.setattr(cfg, "MAX_GENRE_FEATURES", 1)
    wide = training.train(data, training.TrainingConfig(model_type="logistic"))
    assert wide.contract == narrow.contract and wide.metrics["auc"] == pytest.approx(narrow.metrics["auc"], abs=1e-6)
    assert set(wide.metrics) == set(narrow.metrics)
    scored = serving.engagement_scores(data, wide.model, wide.contract).select("pseudo_user_id", "last_event_epoch", "engagement")
    monkeypatch.setattr(cfg, "MAX_GENRE_FEATURES", 100)
    same = serving.engagement_scores(data, narrow.model, narrow.contract).select("pseudo_user_id", "last_event_epoch", "engagement")
    a, b = ({r["last_event_epoch"]: r["engagement"] for r in df.collect()} for df in (scored, same))
    assert a == pytest.approx(b, abs=1e-6)


def test_sparse_weights_and_the_bounded_vocabulary(spark):
    df = rows(spark, [row("a", 1, vector='{"z":0.25,"m":0.75}'), row("b", 2, vector='{"m":1.0,"x":0.0}'), row("c", 3, vector="broken"), row("d", 4)])
    assert [(r["genre"], r["n_rows"]) for r in matrix.vocabulary(df).collect()] == [("m", 2), ("x", 1), ("z", 1)]
    assert matrix.known_genres(df, 2) == ["m", "x"]
    got = {r["pseudo_user_id"]: r["w"] for r in df.select("pseudo_user_id", matrix.sparse_weights(["m", "x"]).alias("w")).collect()}
    assert (got["a"]["size"], got["a"]["indices"], got["a"]["values"]) == (2, [0], [0.75])
    assert (got["b"]["indices"], got["b"]["values"]) == ([0, 1], [1.0, 0.0]) and got["c"]["indices"] == got["d"]["indices"] == []


def test_routing_is_one_pass(spark):
    users, consent, latest = _stores(spark)
    routed = recommend.route(users, consent, latest, F.lit(10.0))
    out = recommend.recommendations(routed, recommend.catalog_frame(spark), recommend.trending_frame(spark), F.lit(0.5), F.lit("1"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("LogicalRDD") + plan.count("LocalRelation") <= 3


def test_the_label_is_of_the_mean_as_computed(spark):
    df = rows(spark, [row("a", 1, avg=69.9999996), row("b", 2, avg=70.0)])
    shown = df.withColumn("mean", F.col("avg_watch_duration")).withColumn("avg_watch_duration", F.round("avg_watch_duration", 6))
    got = matrix.feature_matrix(shown, [], keep=["pseudo_user_id"], mean="mean").collect()
    assert {r["pseudo_user_id"]: r[cfg.LABEL] for r in got} == {"a": 0, "b": 1}


def test_empty_registry_resolves_to_nothing(spark, tmp_path):
    assert ModelRegistry(spark, str(tmp_path / "none")).resolve() is None


def _stores(spark):
    users = spark.createDataFrame([("granted",), ("denied",), ("unknown",), ("cold",), ("expired",)], "pseudo_user_id string")
    consent = spark.createDataFrame(
        [("granted", True), ("denied", False), ("cold", True), ("expired", True)], "user_pseudo_id string, consent_granted boolean"
    )
    latest = rows(spark, [row(u, vector='{"drama":0.7,"horror":0.3}', avg=90.0) for u in ("granted", "denied", "unknown", "expired")])
    return users, consent, latest.withColumn("expires_at", F.when(F.col("pseudo_user_id") == "expired", 50.0).otherwise(200.0))


def test_recommendations_for_every_gate(spark, trained):
    reg, version, *_ = trained
    users, consent, latest = _stores(spark)
    catalog, trending = recommend.catalog_frame(spark), recommend.trending_frame(spark)
    model = (*reg.load(1), 1)
    out = serving.recommend_users(users, consent, latest, F.lit(100.0), catalog, trending, model, 10)
    got = {}
    for r in out.orderBy("pseudo_user_id", "rank").collect():
        got.setdefault(r["pseudo_user_id"], []).append(r)
    assert {u: v[0]["fallback_reason"] for u, v in got.items()} == {
        "granted": None, "denied": "consent_denied", "unknown": "consent_denied", "cold": "cold_start", "expired": "cold_start"
    }
    best = got["granted"]
    assert [r["content_id"] for r in best[:5]] == ["c004", "c005", "c006", "c018", "c019"]
    assert len(best) == 10 and best[0]["personalized"] and best[0]["model_version"] == "1"
    scores = [r["score"] for r in best]
    assert scores == sorted(scores, reverse=True) and scores[5:] == [0.0] * 5
    assert [r["content_id"] for r in got["denied"]] == cfg.TRENDING
    assert all(r["score"] is None and r["model_version"] is None for r in got["cold"])
    # No model: everybody granted with features falls back last.
    none = serving.recommend_users(users, consent, latest, F.lit(100.0), catalog, trending, None, 3)
    reasons = {r["pseudo_user_id"]: r["fallback_reason"] for r in none.collect()}
    assert reasons["granted"] == "model_unavailable" and reasons["denied"] == "consent_denied"
    assert none.count() == 15


@pytest.mark.parametrize("n", [0, 101, -1])
def test_top_n_bounds(spark, n):
    with pytest.raises(ValueError):
        recommend.check_top_n(n)
    assert recommend.check_top_n(1) == 1 and recommend.check_top_n(100) == 100


@pytest.mark.parametrize("inline", [2000, 0])
@pytest.mark.parametrize("top_n", [1, 4, 10, 100])
def test_ranking_matches_a_stable_sort(spark, monkeypatch, inline, top_n):
    """Inline array and join give the stable order of a full sort of a larger catalog."""
    monkeypatch.setattr(recommend, "MAX_INLINE_ITEMS", inline)
    rng = random.Random(9)
    genres = ["action", "drama", "comedy", "noir", "western"]
    items = [(f"i{i:03d}", rng.choice(genres), f"t{i}") for i in range(120)]
    vectors = {"a": '{"drama":0.5,"noir":0.5}', "b": "{}", "c": "bad", "d": '{"action":0.2,"comedy":0.8,"absent":0.0}', "e": '{"western":0.0}'}
    users = spark.createDataFrame([(u, v, 0.8) for u, v in vectors.items()], "pseudo_user_id string, session_genre_vector string, engagement double")
    out = recommend.explode_items(recommend.rank_items(users, recommend.catalog_frame(spark, items), top_n=top_n), ["pseudo_user_id"])
    got = {}
    for r in out.orderBy("pseudo_user_id", "rank").collect():
        got.setdefault(r["pseudo_user_id"], []).append((r["content_id"], r["score"]))
    import json

    for u, v in vectors.items():
        weights = json.loads(v) if v.startswith("{") else {}
        scored = [(cid, 0.8 * weights.get(g, 0.0)) for cid, g, _ in items]
        want = sorted(scored, key=lambda x: x[1], reverse=True)[:top_n]
        assert got[u] == [(c, round(s, 6)) for c, s in want], (u, top_n)


def test_both_rankings_agree_on_odd_rows(spark):
    """Equal rows, null engagements and vectors, items without a genre, columns that cannot be compared."""
    items = [(f"i{i}", [None, "drama", "noir"][i % 3], f"t{i}") for i in range(12)]
    rows = [("a", '{"drama":0.5}', 0.8), ("a", '{"drama":0.5}', 0.8), ("b", '{"noir":1.0}', None), ("c", None, 0.5), ("d", "{}", 0.0)]
    users = spark.createDataFrame(rows, "pseudo_user_id string, session_genre_vector string, engagement double").withColumn("extra", F.create_map(F.lit("k"), F.lit(1)))
    ranked = lambda limit: sorted(map(str, recommend.explode_items(recommend.rank_items(users, recommend.catalog_frame(spark, items), top_n=4, inline_limit=limit), ["pseudo_user_id"]).collect()))
    assert ranked(0) == ranked(100) and len(ranked(0)) == 20


def test_columns_beyond_the_contract_are_reported(spark):
    contract = matrix.schema_contract(["drama"])
    extra = rows(spark, [row()]).withColumn("surprise", F.lit(1)).withColumn("recency_score", F.lit("x"))
    known = rows(spark, [row()]).columns
    assert matrix.contract_differences(extra.schema, contract, known=known) == [
        ("recency_score", "expected double, found string"), ("surprise", "not in the contract")
    ]
    with pytest.raises(ValueError, match="recency_score"):
        matrix.require_contract(extra.schema, contract)


def test_trending_skips_unknown_ids(spark):
    catalog = recommend.catalog_frame(spark)
    known = recommend.resolve_trending(recommend.trending_frame(spark, ["c004", "zzz", "c001"]), catalog).collect()
    assert [r["content_id"] for r in known] == ["c004", "c001"]
    assert recommend.resolve_trending(recommend.trending_frame(spark, ["zzz"]), catalog).count() == 0


def test_serving_vector_defaults(spark):
    contract = matrix.schema_contract(["drama", "sci-fi"])
    df = rows(spark, [row(vector='{"sci-fi":0.25}')]).withColumns(
        {"time_of_day_bucket": F.lit(None).cast("string"), "watch_count_10min": F.lit(None).cast("int"), "recency_score": F.lit(None).cast("double")}
    )
    x = matrix.serving_vectors(df, contract)
    assert x.columns == [f["name"] for f in contract["features"]]
    r = x.first()
    assert (r["time_of_day_bucket"], r["watch_count_10min"], r["recency_score"], r["genre_drama"], r["genre_sci-fi"]) == ("morning", 0, 0.0, 0.0, 0.25)


def test_probability_is_the_positive_class(spark, trained):
    reg, *_ = trained
    model, contract = reg.load(1)
    df = rows(spark, [row("hi", avg=99.0), row("lo", avg=1.0)])
    got = {r["pseudo_user_id"]: r["engagement"] for r in serving.engagement_scores(df, model, contract).collect()}
    assert 0.0 <= got["lo"] < 0.5 < got["hi"] <= 1.0


def test_stream_scoring_swaps_models_between_batches(spark, trained, tmp_path):
    reg, _, path, config = trained
    source = str(tmp_path / "rows")
    rows(spark, [row("a", avg=90.0)]).coalesce(1).write.parquet(source + "/0")
    current, seen = CurrentModel(reg), []
    start = reg.resolve()

    def write(scored, version, batch_id):
        seen.append((version, scored.count()))
        if batch_id == 0:
            training_version = reg.next_version()
            model, contract = reg.load(start)
            assert reg.register(model, contract, "production", "gbt", {}, {"auc": 1.0}) == training_version

    stream = spark.readStream.schema(FEATURE_ROW).option("maxFilesPerTrigger", 1).parquet(source + "/*")
    for i in range(2):
        if i:
            rows(spark, [row("b", avg=10.0)]).coalesce(1).write.parquet(source + f"/{i}")
        scoring_writer(stream, current, write, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(240)
    assert seen[0] == (start, 1) and seen[1][0] == reg.resolve() != start
    # A failing registry keeps the model in use.
    broken = CurrentModel(reg)
    broken.refresh()
    broken.registry = None
    assert broken.refresh()[2] == broken.version


def test_registry_operators(spark):
    df = spark.createDataFrame(
        [("m", 1, "staging", 1, 0.9), ("m", 2, "staging", 2, 0.6), ("m", 1, "production", 3, 0.9), ("n", 1, "staging", 1, 0.5), ("o", 1, "other", 1, 0.9)],
        "name string, version long, alias string, assigned_at long, auc double",
    )
    assert {(r["name"], r["alias"], r["version"]) for r in registry.resolve(df).collect()} == {("m", "production", 1), ("n", "staging", 1)}
    assert registry.promotion_candidates(df, {"auc": 0.6}).count() == 3
