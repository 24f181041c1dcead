"""Model operators by invariants: output of a fit depends on row layout."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from conftest import as_dicts, by_key
from tallyloom.models import forecast, per_series, recommend, segments
from tallyloom.models.indexing import dense_index
from tallyloom.models.pruned import top_items
from tallyloom.plans.catalog import MODEL_QUERIES, Sample, all_queries

SMALL = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ indexing


@pytest.mark.parametrize("buckets", [1, 16])
def test_dense_index_is_dense_and_independent_of_layout(spark, buckets):
    df = spark.range(500).selectExpr("concat('id', id % 123) as name")
    first = by_key(dense_index(df, "name", "idx", buckets), "name")
    again = by_key(dense_index(df.repartition(13), "name", "idx", buckets), "name")
    assert first == again
    assert sorted(r["idx"] for r in first.values()) == list(range(123))


# ------------------------------------------------------------------ segments


def test_cluster_names():
    centroids = [(0.1, 0.2, 0.1), (-1.0, 2.0, 2.0), (1.5, -0.4, -0.5), (-0.2, -0.6, -0.4)]
    assert segments.name_clusters(centroids) == {0: "Loyal", 1: "VIP", 2: "At Risk", 3: "New"}
    assert segments.name_clusters(centroids[:2]) == {0: "At Risk", 1: "VIP"}
    assert segments.name_clusters([(0.0, 0.0, 0.0)] * 5) == {
        0: "VIP",
        1: "At Risk",
        2: "New",
        3: "Loyal",
        4: "Loyal",
    }


@pytest.fixture(scope="module")
def features(spark):
    return Sample(spark, SMALL).features().cache()


@pytest.fixture(scope="module")
def segment_model(features):
    return segments.fit_segments(features)


def test_every_customer_gets_its_nearest_centroid(features, segment_model):
    assigned = segments.assign_segments(segment_model, features)
    assert dict(assigned.dtypes)["cluster_id"] == "smallint"
    points = segments.standard_points(features, segment_model.means, segment_model.deviations)
    rows = assigned.join(points, "customer_unique_id").collect()
    assert len(rows) == features.count() == segment_model.customers
    for row in rows:
        z = [row[f"z{i}"] / segments.PARTS for i in range(3)]
        distances = [math.dist(z, c) for c in segment_model.centroids]
        assert row.distance_to_centroid == pytest.approx(min(distances), abs=1e-9)
        assert row.distance_to_centroid == pytest.approx(distances[row.cluster_id], abs=1e-9)
        assert row.segment_label == segment_model.labels[row.cluster_id]
    assert -1.0 <= segment_model.silhouette <= 1.0
    sizes = as_dicts(segments.segment_sizes(assigned))
    assert sum(s["customers"] for s in sizes) == len(rows)


@pytest.mark.parametrize("partitions", [3, 17])
def test_the_fit_does_not_depend_on_layout(features, segment_model, partitions):
    again = segments.fit_segments(features.repartition(partitions))
    assert again == segment_model


def test_standardised_like_the_vector_scaler(features, segment_model):
    ours = by_key(segments.standard_points(features, segment_model.means, segment_model.deviations), "customer_unique_id")
    for row in segments.standardized_features(features).collect():
        z = [row[f"{name}_z"] for name in segments.FEATURES]
        assert [ours[row.customer_unique_id][f"z{i}"] / segments.PARTS for i in range(3)] == pytest.approx(z, abs=1e-8)


def test_silhouette_equals_the_evaluator(features, segment_model):
    points = segments.standard_points(features, segment_model.means, segment_model.deviations)
    placed = points.withColumn("prediction", segments._nearest(segment_model.centroids)).select(
        "prediction", array_to_vector(F.array(*(F.col(f"z{i}") / segments.PARTS for i in range(3)))).alias("features")
    )
    expected = ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(placed)
    assert segment_model.silhouette == pytest.approx(expected, abs=1e-7)


def test_the_fit_is_as_tight_as_the_library_one(features, segment_model):
    points = segments.standard_points(features, segment_model.means, segment_model.deviations).select(
        array_to_vector(F.array(*(F.col(f"z{i}") / segments.PARTS for i in range(3)))).alias("features")
    )
    library = KMeans(k=segments.CLUSTERS, seed=segments.SEED, maxIter=30).fit(points)
    rows = segments.assign_segments(segment_model, features)
    cost = rows.agg(F.sum(F.col("distance_to_centroid") ** 2)).first()[0]
    assert cost <= 1.1 * library.summary.trainingCost


def test_few_different_customers_make_few_clusters(spark):
    rows = [(f"c{i}", i % 2, 1, 5.0) for i in range(10)]
    alike = spark.createDataFrame(rows, "customer_unique_id string, recency_days int, frequency int, monetary double")
    model = segments.fit_segments(alike)
    assert len(model.centroids) == 2 and model.silhouette == pytest.approx(1.0)
    assert segments.assign_segments(model, alike).agg(F.max("distance_to_centroid")).first()[0] < 1e-8
    assert math.isnan(segments.fit_segments(alike.limit(1)).silhouette)


def test_original_centroids_are_in_feature_units(features, segment_model):
    assigned = segments.assign_segments(segment_model, features).join(features, "customer_unique_id")
    means = assigned.groupBy("cluster_id").agg(*(F.avg(F.col(f).cast("double")).alias(f) for f in segments.FEATURES))
    for row in means.collect():
        expected = [row[f] for f in segments.FEATURES]
        assert segment_model.original_centroids[row.cluster_id] == pytest.approx(expected, rel=1e-6)


def test_no_customers_is_an_error(features):
    with pytest.raises(ValueError):
        segments.fit_segments(features.limit(0))


# ----------------------------------------------------------- recommendations


@pytest.fixture(scope="module")
def bought(spark):
    return Sample(spark, SMALL).interactions().cache()


def test_split_is_complete_disjoint_and_keeps_cold_users_in_training(spark):
    rows = [(f"u{i % 40}", f"p{i}", 1.0) for i in range(400)] + [("cold", "p1", 1.0)]
    pairs = spark.createDataFrame(rows, "customer_unique_id string, product_id string, rating float")
    split = recommend.split_interactions(pairs)
    assert split.count() == 401
    assert split.select("customer_unique_id", "product_id").distinct().count() == 401
    parts = {r["part"]: r["count"] for r in split.groupBy("part").count().collect()}
    assert 15 <= parts["holdout"] <= 70
    assert {r.part for r in split.filter("customer_unique_id = 'cold'").collect()} == {"train"}
    again = recommend.split_interactions(pairs.repartition(9))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, split.collect()))


def test_precision_counts_users_without_recommendations(spark):
    holdout = spark.createDataFrame(
        [("a", "p1"), ("a", "p2"), ("b", "p1"), ("c", "p3")],
        "customer_unique_id string, product_id string",
    )
    given = spark.createDataFrame(
        [("a", "p1"), ("a", "p9"), ("b", "p2"), ("z", "p3")],
        "customer_unique_id string, product_id string",
    )
    assert as_dicts(recommend.precision_at_k(given, holdout, 2)) == [
        {"users": 3, "hits": 1, "precision_at_k": pytest.approx(1 / 6)}
    ]
    (none,) = as_dicts(recommend.precision_at_k(given, holdout.limit(0), 2))
    assert none["precision_at_k"] == 0.0


def test_recommender(spark, bought):
    settings = recommend.AlsSettings(max_iterations=3, rank=4, top_k=5)
    fitted = recommend.fit_recommender(bought, settings)
    assert 0.0 <= fitted.precision_at_k <= 1.0 and fitted.rmse >= 0.0
    recs = recommend.recommend_all(fitted)
    assert dict(recs.dtypes)["rank"] == "smallint" and dict(recs.dtypes)["score"] == "float"
    rows = recs.collect()
    users = {r.customer_unique_id for r in rows}
    trained = recommend.split_interactions(bought, settings).filter("part = 'train'")
    assert users == {r[0] for r in trained.select("customer_unique_id").distinct().collect()}
    assert len(rows) == len(users) * 5
    per_user = {}
    for row in rows:
        per_user.setdefault(row.customer_unique_id, []).append((row["rank"], row.score))
    unseen = recommend.recommend_all(fitted, exclude_seen=bought)
    pairs = {(r[0], r[1]) for r in unseen.select("customer_unique_id", "product_id").collect()}
    assert not pairs & {(r[0], r[1]) for r in bought.collect()}
    assert len(pairs) == len(users) * 5
    lists = unseen.groupBy("customer_unique_id").agg(F.max("rank"), F.count("*"))
    assert {(r[1], r[2]) for r in lists.collect()} == {(5, 5)}
    for ranked in per_user.values():
        ranked.sort()
        assert [r for r, _ in ranked] == [1, 2, 3, 4, 5]
        assert [s for _, s in ranked] == sorted((s for _, s in ranked), reverse=True)


def factors(spark, vectors):
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id int, features array<float>")


def test_pruned_lists_equal_all_scores_and_score_few_pairs(spark):
    import numpy as np

    pick = np.random.default_rng(3)
    users = pick.random((300, 6)).astype(np.float32)
    # Few products have large norms, as popular ones do.
    items = (pick.random((900, 6)) * (1 / (1 + np.arange(900))[:, None]) ** 0.7).astype(np.float32)
    users[7] = 0
    had = {(int(u), int(i)) for u, i in zip(pick.integers(0, 300, 4000), pick.integers(0, 60, 4000))}
    had |= {(5, i) for i in range(895)}
    pairs = spark.createDataFrame(sorted(had), "user_idx int, item_idx int")
    scores = users.astype(np.float64) @ items.T.astype(np.float64)
    for taken in (None, pairs):
        found = top_items(factors(spark, users).repartition(4), factors(spark, items), 10, taken, 50, 40)
        allowed = scores.copy()
        if taken is not None:
            for u, i in had:
                allowed[u, i] = -np.inf
        lists = {}
        for row in found.lists.collect():
            assert taken is None or (row.user_idx, row.item_idx) not in had
            lists.setdefault(row.user_idx, []).append((row["rank"], row.score))
        assert len(lists) == 300
        for u, ranked in lists.items():
            best = np.sort(allowed[u][np.isfinite(allowed[u])])[::-1][:10]
            assert [s for _, s in sorted(ranked)] == pytest.approx(best, rel=1e-5, abs=1e-7)
            assert sorted(r for r, _ in ranked) == list(range(1, len(best) + 1))
        scored = found.pairs.agg(F.sum(F.col("users") * F.col("items"))).first()[0]
        assert 300 * 40 <= scored < 0.6 * 300 * 900


def test_pruned_lists_without_rows(spark):
    some, none = factors(spark, [[1.0, 2.0]]), factors(spark, [])
    for users, items in ((some, none), (none, some), (none, none)):
        assert top_items(users, items, 3).lists.count() == 0
    assert [tuple(r) for r in top_items(some, some, 3).lists.collect()] == [(0, 0, 1, 5.0)]


def test_lists_equal_those_of_the_library(spark, bought):
    fitted = recommend.fit_recommender(bought, recommend.AlsSettings(max_iterations=2, rank=4), evaluate=False)
    nested = fitted.model.recommendForAllUsers(10).select("user_idx", F.posexplode("recommendations").alias("p", "x"))
    theirs = {(r.user_idx, r.p + 1): r.x.rating for r in nested.collect()}
    found = top_items(fitted.model.userFactors, fitted.model.itemFactors, 10).lists.collect()
    assert {(r.user_idx, r["rank"]) for r in found} == set(theirs)
    for row in found:
        assert row.score == pytest.approx(theirs[row.user_idx, row["rank"]], rel=1e-4, abs=1e-6)


def test_no_interactions_is_an_error(bought):
    with pytest.raises(ValueError):
        recommend.fit_recommender(bought.limit(0))


# ------------------------------------------------------------------ forecast


def series(spark, name, values, start=dt.date(2018, 1, 1)):
    rows = [(name, start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "series string, date date, revenue double")


def test_gaps_are_filled_between_own_bounds(spark):
    both = series(spark, "a", [1, None, None, 4]).union(series(spark, "b", [2], dt.date(2019, 1, 1)))
    filled = sorted((r.series, r.date.isoformat(), r.revenue) for r in forecast.fill_gaps(both).collect())
    assert filled == [
        ("a", "2018-01-01", 1.0),
        ("a", "2018-01-02", 0.0),
        ("a", "2018-01-03", 0.0),
        ("a", "2018-01-04", 4.0),
        ("b", "2019-01-01", 2.0),
    ]


def test_features_leave_the_day_itself_out(spark):
    rows = by_key(forecast.forecast_features(series(spark, "a", range(10))), "date")
    assert min(rows) == dt.date(2018, 1, 8) and len(rows) == 3
    assert rows[dt.date(2018, 1, 8)] == {
        "series": "a",
        "date": dt.date(2018, 1, 8),
        "revenue": 7.0,
        "trend": 7,
        "dow": 0,
        "month": 1,
        "lag_1": 6.0,
        "lag_7": 0.0,
        "roll_mean_7": 3.0,
    }


def recursion(history, predict, start, trend, horizon):
    """Plain loop: every prediction becomes the next day's lag."""
    values, out = list(history), []
    for ahead in range(1, horizon + 1):
        day = start + dt.timedelta(days=ahead)
        week = values[-7:]
        values.append(predict((trend + ahead, day.weekday(), day.month, week[-1], week[0], sum(week) / 7)))
        out.append(values[-1])
    return out


def test_linear_recursion_equals_a_plain_loop(spark):
    class Line:
        coefficients = [0.3, -0.2, 0.1, 0.5, 0.2, 0.1]
        intercept = 2.0

    def predict(x):
        return Line.intercept + sum(w * v for w, v in zip(Line.coefficients, x))

    history = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0]
    states = spark.createDataFrame(
        [("a", dt.date(2018, 1, 28), 40, history)],
        "series string, last_date date, last_trend int, history array<double>",
    )
    rows = forecast._predict_linear(states, Line, 12).orderBy("forecast_date").collect()
    assert [r.forecast_date for r in rows] == [dt.date(2018, 1, 28) + dt.timedelta(days=i) for i in range(1, 13)]
    expected = recursion(history, predict, dt.date(2018, 1, 28), 40, 12)
    assert [r.prediction for r in rows] == pytest.approx(expected)


def wave(i):
    return 100 + i + 20 * math.sin(i * 2 * math.pi / 7)


def test_stepwise_recursion_equals_the_single_expression(spark):
    data = series(spark, "a", map(wave, range(90))).union(series(spark, "b", (2 * wave(i) for i in range(80))))
    vectors = forecast._assembler().transform(forecast.forecast_features(data))
    model = forecast._estimator("linreg", 1, 1, 1).fit(vectors)
    states = forecast._last_states(vectors)
    at_once = by_key(
        forecast._predict_linear(states, model, 7).withColumn("k", F.struct("series", "forecast_date")), "k"
    )
    stepwise = by_key(
        forecast._predict_stepwise(states, model, 7).withColumn("k", F.struct("series", "forecast_date")), "k"
    )
    assert len(at_once) == 14 and set(at_once) == set(stepwise)
    for key, row in at_once.items():
        assert stepwise[key]["prediction"] == pytest.approx(row["prediction"])


def test_forest_recursion_equals_the_library_step_by_step(spark):
    data = series(spark, "a", map(wave, range(120))).union(series(spark, "b", (3 * wave(i * i) for i in range(80))))
    vectors = forecast._assembler().transform(forecast.forecast_features(data))
    model = forecast._estimator("randomforest", 12, 7, 6).fit(vectors)
    states = forecast._last_states(vectors)
    at_once = forecast._predict_forest(states, model, 9, 6)
    stepwise = forecast._predict_stepwise(states, model, 9)
    key = F.concat_ws(" ", "series", "forecast_date")
    expected = by_key(stepwise.withColumn("k", key), "k")
    found = by_key(at_once.withColumn("k", key), "k")
    assert len(found) == 18 and set(found) == set(expected)
    for k, row in found.items():
        assert row["prediction"] == pytest.approx(expected[k]["prediction"], rel=1e-12)


def test_every_series_gets_the_model_of_its_own_rows(spark):
    import numpy as np

    names = ("a", "b", "flat", "c")
    data = None
    for name, scale in zip(names, (1, 3, 0, 0.5)):
        one = series(spark, name, (round(scale * wave(i * (1 + scale)) + scale * (i % 5), 2) for i in range(90)))
        data = one if data is None else data.union(one)
    run = per_series.forecast_each(data.union(series(spark, "short", range(10))).repartition(5), horizon=6)
    assert [tuple(r) for r in run.short_series.collect()] == [("short", 10)]
    features = forecast.mark_holdout(forecast.forecast_features(forecast.fill_gaps(data))).orderBy("date").collect()
    quality = by_key(run.quality, "series")
    rows = run.forecasts.orderBy("forecast_date").collect()
    assert len(rows) == 24
    for name in names:
        own = [r for r in features if r.series == name]
        x = np.array([[1.0, *(r[c] for c in forecast.FEATURES)] for r in own])
        y = np.array([r.revenue for r in own])
        held = np.array([r.is_holdout for r in own])
        trained = np.linalg.lstsq(x[~held], y[~held], rcond=None)[0]
        rmse = math.sqrt(np.mean((x[held] @ trained - y[held]) ** 2))
        assert quality[name]["rmse"] == pytest.approx(rmse, rel=1e-2, abs=1e-2)
        whole = np.linalg.lstsq(x, y, rcond=None)[0]
        history = list(y[-7:])
        expected = recursion(history, lambda v: whole[0] + sum(w * u for w, u in zip(whole[1:], v)), own[-1].date, own[-1].trend, 6)
        shown = [r.predicted_revenue for r in rows if r.series == name]
        assert shown == pytest.approx(expected, rel=1e-2, abs=0.02)
        sigma = np.std(y - x @ whole)
        width = [r.upper_bound - r.predicted_revenue for r in rows if r.series == name]
        assert width == pytest.approx([1.96 * sigma] * 6, rel=1e-2, abs=0.02)
    assert quality["flat"]["r2"] is None


@pytest.mark.parametrize("kind", ["linreg", "randomforest"])
def test_forecast_run(spark, kind):
    data = series(spark, "a", map(wave, range(100)))
    run = forecast.run_forecast(data, kind, horizon=10, trees=10)
    rows = run.forecasts.orderBy("forecast_date").collect()
    assert [r.forecast_date for r in rows] == [dt.date(2018, 4, 10) + dt.timedelta(days=i) for i in range(1, 11)]
    for row in rows:
        assert 0.0 <= row.lower_bound <= row.predicted_revenue <= row.upper_bound
        assert row.model_name == forecast.MODEL_NAMES[kind]
    if kind == "linreg":
        assert run.r2 > 0.9
        assert rows[0].predicted_revenue == pytest.approx(wave(100), rel=0.05)


def test_short_series_are_reported_and_long_ones_forecast(spark):
    data = series(spark, "long", map(wave, range(100))).union(series(spark, "short", range(10)))
    run = forecast.run_forecast(data, "linreg", horizon=5)
    assert {r.series for r in run.forecasts.collect()} == {"long"} and run.forecasts.count() == 5
    assert [tuple(r) for r in run.short_series.collect()] == [("short", 10)]


def test_short_series_and_unknown_models_are_errors(spark):
    with pytest.raises(ValueError, match="44"):
        forecast.run_forecast(series(spark, "a", range(43)))
    with pytest.raises(ValueError, match="unknown model"):
        forecast.run_forecast(series(spark, "a", range(60)), "prophecy")


# ------------------------------------------------------- registered queries


@pytest.mark.parametrize("name", sorted(MODEL_QUERIES))
def test_every_model_query_returns_rows(spark, name):
    assert all_queries()[name](spark, SMALL).take(1)
