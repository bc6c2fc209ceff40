"""Models find planted attacks, survive storage, and refuse to learn from one class."""

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tidegauge.operators import ensemble, iforest, ml, rolling, rules, windows
from tidegauge.schema import ML_FEATURES, ModelConfig

SMALL = ModelConfig(trees=20, depth=5, boost_iter=5)


@pytest.fixture(scope="module")
def planted(spark):
    """Benign sources and one that sends 600 requests to one URL in five minutes, 90 % answered 503."""
    from datetime import datetime, timedelta

    from tidegauge.sources.logs import normalize_logs

    rng, rows = random.Random(11), []
    for ip in range(40):
        for _ in range(40):
            rows.append((rng.random() * 3600, f"10.0.0.{ip}", f"/p{rng.randrange(12)}", 200 if rng.random() < 0.95 else 404,
                         rng.random()))
    for i in range(600):
        rows.append((1200 + i * 0.5, "203.0.113.10", "/login", 503 if i % 10 else 200, 5 + rng.random() * 10))
    full = [(i, datetime(2024, 1, 1) + timedelta(seconds=t), ip, "GET", url, s, 500, rt, "Mozilla/5.0")
            for i, (t, ip, url, s, rt) in enumerate(rows)]
    schema = ("event_id bigint, event_timestamp timestamp, source_ip string, method string, url string, "
              "status_code int, bytes_sent int, response_time double, user_agent string")
    return normalize_logs(spark.createDataFrame(full, schema)).cache()


@pytest.fixture(scope="module")
def requests(planted):
    return rolling.pseudo_labels(rolling.rolling_ml(planted)).cache()


@pytest.fixture(scope="module")
def fitted(requests):
    return ensemble.fit_ensemble(requests, SMALL)


ATTACKER, OTHERS = "source_ip = '203.0.113.10'", "source_ip <> '203.0.113.10'"


def test_rules_find_the_attack(planted):
    alerts = rules.rule_alerts(rolling.rolling_basic(planted))
    assert alerts.filter(ATTACKER).count() > 500
    assert windows.windowed_alerts(planted).filter(ATTACKER).count() > 0
    assert windows.attack_windows(planted).select("source_ip").distinct().collect()[0][0] == "203.0.113.10"


def test_ensemble_finds_the_attack(requests, fitted):
    assert fitted.classifier is not None
    scored = ensemble.score_ensemble(fitted, requests)
    attack, benign = scored.filter(ATTACKER).filter("is_attack = 1"), scored.filter(OTHERS)
    assert attack.filter("vote = 1").count() > 0.95 * attack.count()
    assert benign.filter("vote = 1").count() == 0
    alerts = ensemble.ensemble_alerts(scored)
    row = alerts.filter(ATTACKER).orderBy(F.desc("models_used")).first()
    assert row.models_used == len(row.alerts)
    assert row.confidence == pytest.approx(np.mean([a.confidence for a in row.alerts]))
    assert all(0 <= a.confidence <= 100 for a in row.alerts)


def test_ensemble_round_trip(spark, requests, fitted, tmp_path):
    fitted.save(spark, str(tmp_path))
    again = ensemble.Ensemble.load(spark, str(tmp_path))
    columns = ["event_id", "cluster", "distance", "decision", "vote", "attack_probability"]
    a, b = (ensemble.score_ensemble(m, requests).select(columns).orderBy("event_id").toPandas() for m in (fitted, again))
    assert np.allclose(a, b)


def test_ensemble_guards(requests):
    calm = ensemble.fit_ensemble(requests.filter(OTHERS).filter("is_attack = 0").limit(60), SMALL)
    assert calm.classifier is None and calm.forest.offset is not None
    scored = ensemble.score_ensemble(calm, requests)
    assert scored.filter("vote IS NOT NULL OR attack_probability IS NOT NULL").count() == 0
    assert ensemble.ensemble_alerts(scored).filter("exists(alerts, a -> a.type = 'random_forest_classification')").count() == 0


def test_forest_ranks_planted_outliers_first(spark):
    rng = np.random.default_rng(5)
    rows = [(i, *map(float, rng.normal(0, 1, 3))) for i in range(2000)]
    rows += [(2000 + i, *map(float, rng.normal(9, 0.5, 3))) for i in range(20)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double").repartition(3)
    forest = iforest.fit_iforest(df, ["a", "b", "c"], ["id"], trees=50)
    assert len(forest.nodes) <= 50 * 511
    scored = forest.score(df)
    top = {r.id for r in scored.orderBy(F.desc("score")).limit(20).collect()}
    assert top == set(range(2000, 2020))
    assert scored.filter("decision < 0").count() == pytest.approx(202, abs=3)
    other = iforest.fit_iforest(df.repartition(7), ["a", "b", "c"], ["id"], trees=50)
    assert other.offset == forest.offset


@pytest.mark.parametrize("rows", [500, 5000])
def test_tree_samples_have_the_wanted_size(spark, rows):
    df = spark.range(rows).withColumn("x", F.rand(1))
    sizes = iforest.tree_samples(df, ["id"], rows, 10, 64, 1).groupBy("tree").count().collect()
    assert len(sizes) == 10 and all(r["count"] == 64 for r in sizes)


def test_average_path_length():
    assert iforest.average_path([0, 1, 2]).tolist() == [0, 0, 1]
    assert float(iforest.average_path(256)) == pytest.approx(10.2448, abs=1e-3)


@pytest.fixture(scope="module")
def labelled(planted):
    return windows.window_features_v1(planted, "1 minute", min_rate=1.5, min_error_rate=0.05).cache()


def test_classifiers_and_metrics(labelled):
    for fit in (ml.fit_random_forest, ml.fit_boosting):
        model = fit(labelled, cfg=SMALL)
        scored = model.transform(labelled)
        ours = ml.classification_metrics(ml.confusion(scored)).first()
        for name, value in (("accuracy", ours.accuracy), ("weightedPrecision", ours.weighted_precision),
                            ("weightedRecall", ours.weighted_recall)):
            theirs = MulticlassClassificationEvaluator(labelCol="is_attack", metricName=name).evaluate(scored)
            assert value == pytest.approx(theirs)
        assert 0 <= ml.score(model, labelled).agg(F.min("attack_probability")).first()[0] <= 1


def test_metrics_of_a_mixed_table(spark):
    rows = [(0.0, 0.0, 50), (0.0, 1.0, 10), (1.0, 0.0, 5), (1.0, 1.0, 35)]
    m = ml.classification_metrics(spark.createDataFrame(rows, "label double, prediction double, count bigint")).first()
    precision = (60 * 50 / 55 + 40 * 35 / 45) / 100
    assert m.accuracy == m.weighted_recall == pytest.approx(0.85)
    assert m.weighted_precision == pytest.approx(precision)
    assert m.f1 == pytest.approx(2 * precision * 0.85 / (precision + 0.85))


def test_one_class_is_refused(planted):
    calm = windows.window_features_v1(planted.filter(OTHERS))
    with pytest.raises(ValueError):
        ml.fit_random_forest(calm)
    models, failures = ml.train_all(calm, {**ml.TRAINERS, "kmeans": lambda f: ml.fit_kmeans(f, k=2)})
    assert set(models) == {"kmeans", "bisecting_kmeans"}
    assert set(failures) == {"random_forest", "gradient_boosting"}


def test_split_ignores_partitioning(labelled):
    parts = [ml.split(df)[0].select("window_start", "source_ip") for df in (labelled, labelled.repartition(9))]
    assert parts[0].exceptAll(parts[1]).count() == 0 and parts[0].count() == parts[1].count()
    train, test = ml.split(labelled)
    assert train.count() + test.count() == labelled.count()


def test_clusters_find_the_attack(planted):
    features = windows.window_features_v2(planted)
    scored = ml.score(ml.fit_kmeans(features, ml.WINDOW_V2_FEATURES, k=3), features).cache()
    attack = {r.cluster for r in scored.filter(ATTACKER).filter("requests_per_minute > 30").collect()}
    assert attack <= {r.cluster for r in ml.anomaly_clusters(scored).collect()}
    assert 0 < ml.silhouette(ml.fit_kmeans(features, ml.WINDOW_V2_FEATURES, k=3), features) <= 1
    assert ml.cluster_distribution(scored).agg(F.sum("count")).first()[0] == scored.count()


def test_saved_model_predicts_the_same(spark, planted, tmp_path):
    features = windows.window_features_v2(planted)
    model = ml.fit_kmeans(features, ml.WINDOW_V2_FEATURES, k=3)
    ml.save_model(spark, model, str(tmp_path), "km", ml.WINDOW_V2_FEATURES)
    direct = ml.score(model, features).select("source_ip", "window_start", F.col("cluster").alias("prediction"))
    loaded = ml.batch_predict(str(tmp_path), "km", planted).select(direct.columns)
    assert direct.exceptAll(loaded).count() == 0
    assert spark.read.json(f"{tmp_path}/km_metadata").first().stages[-1] == "KMeansModel"


def test_outlier_distance_is_to_the_own_centre(requests):
    model = ensemble.fit_outlier_kmeans(requests, SMALL)
    far = ensemble.kmeans_outliers(model, requests, 4.0)
    assert far.filter("distance <= 4.0").count() == 0
    row = ensemble.with_distance(model, requests).first()
    centre = model.stages[-1].clusterCenters()[row.cluster]
    assert row.distance == pytest.approx(float(np.linalg.norm(row.features.toArray() - centre)))
    assert len(ML_FEATURES) == 19


def test_bisecting_clusters(logs):
    features = windows.window_features_v1(logs)
    model = ml.fit_bisecting(features)
    assert ml.cluster_distribution(ml.score(model, features)).count() == 3
    assert -1 <= ml.silhouette(model, features) <= 1


def test_relations_agree_with_the_fitted_clusters(spark, planted):
    """Assignment, distance and silhouette by expressions over stored centres, against MLlib."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import vector_to_array

    from tidegauge.operators import clusters

    features = windows.window_features_v2(planted)
    model = ml.fit_kmeans(features, ml.WINDOW_V2_FEATURES, k=3)
    scored = model.transform(features).withColumn("x", vector_to_array("features")).withColumnRenamed("cluster", "own").cache()
    names = [f"x{i}" for i in range(9)]
    points = scored.select("*", *[F.col("x")[i].alias(n) for i, n in enumerate(names)])
    centres = clusters.centres_of(spark, model)
    centres.write.parquet(path := f"{spark.sparkContext.getCheckpointDir() or '/tmp'}/centres-{random.random()}")
    found = clusters.assign(points, spark.read.parquet(path), names)
    assert found.filter("cluster <> own").count() == 0
    row = found.first()
    assert row.distance == pytest.approx(float(np.linalg.norm(np.array(row.x) - model.stages[-1].clusterCenters()[row.own])))
    mean = clusters.silhouettes(found, names).agg(F.avg("silhouette")).first()[0]
    theirs = ClusteringEvaluator(featuresCol="features", predictionCol="own").evaluate(scored)
    assert mean == pytest.approx(theirs, abs=1e-9)


def test_forest_walk_in_expressions(requests, fitted):
    """The same scores as the vectorised walk, and no Python worker in the plan."""
    z = ensemble._with_z(fitted.clusters.transform(requests)).select("event_id", *ensemble.Z).cache()
    both = iforest.score_by_nodes(fitted.forest.score(z).withColumnRenamed("score", "theirs"), ensemble.Z, fitted.forest.nodes, fitted.forest.sample)
    assert both.filter("abs(score - theirs) > 1e-12").count() == 0
    plan = iforest.score_by_nodes(z, ensemble.Z, fitted.forest.nodes, fitted.forest.sample)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_training_guards(requests):
    calm = requests.filter(OTHERS)
    few = calm.limit(99)
    assert ensemble.train_ensemble(few, SMALL) is None
    check = ensemble.training_check(calm.limit(200).unionByName(requests.filter("is_attack = 1").limit(10)), SMALL).first()
    assert check.rows == 210 and check.attacks == 10 and check.enough_rows and not check.enough_attacks
    more = ensemble.training_check(requests, SMALL).first()
    assert more.enough_attacks and more.attacks + more.others == more.rows


def test_ensemble_reads_labelled_requests_from_a_written_table(spark):
    from tidegauge.plans.queries import QUERIES

    plan = QUERIES["ensemble_alerts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
