"""Customer segments: standardised K-Means with named clusters.

The fit does not depend on how rows are laid out.  Features are whole
hundredths, so their sums are exact; standardised values are rounded to
nine decimals and summed as whole numbers; starting customers are drawn by
hashes of their ids.  One pass of the data gives one small row per cluster.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Features and training parameters.
FEATURES = ("recency_days", "frequency", "monetary")
CLUSTERS = 4
SEED = 42
MAX_ITERATIONS = 30
# Standardised values are whole numbers of this many parts.
PARTS = 10**9
WHOLE = "decimal(19,0)"
# Sums of such numbers are kept in two 64-bit parts, of so many low bits and the rest.
LOW_BITS = 30
PERSON = "customer_unique_id"


@dataclass(frozen=True)
class SegmentModel:
    """Means and deviations are those of the features in hundredths."""

    means: list[float]
    deviations: list[float]
    centroids: list[list[float]]
    labels: dict[int, str]
    silhouette: float
    customers: int
    iterations: int

    @property
    def original_centroids(self) -> list[list[float]]:
        """Centroids in the units of the features."""
        return [
            [(z * s + m) / 100 for z, s, m in zip(center, self.deviations, self.means)]
            for center in self.centroids
        ]


def name_clusters(centroids: Sequence[Sequence[float]]) -> dict[int, str]:
    """Names from standardised (recency, frequency, monetary) centroids.

    VIP has the highest frequency plus monetary minus recency; of the others
    At Risk has the highest recency; of the rest New has the lowest frequency;
    whatever is left is Loyal.  The lower id wins a tie.
    """
    left = dict(enumerate(centroids))
    names: dict[int, str] = {}

    def claim(name: str, score) -> None:
        if left:
            best = min(left, key=lambda cid: (-score(left[cid]), cid))
            names[best] = name
            del left[best]

    claim("VIP", lambda c: c[1] + c[2] - c[0])
    claim("At Risk", lambda c: c[0])
    claim("New", lambda c: -c[1])
    names.update({cid: "Loyal" for cid in left})
    return dict(sorted(names.items()))


def feature_vectors(features: DataFrame) -> DataFrame:
    """Features as doubles and as one vector per customer."""
    doubles = features.select(
        "customer_unique_id", *[F.col(name).cast("double").alias(name) for name in FEATURES]
    )
    return VectorAssembler(inputCols=list(FEATURES), outputCol="raw_features").transform(doubles)


def fit_scaler(vectors: DataFrame) -> StandardScalerModel:
    """Zero mean and unit sample standard deviation."""
    return StandardScaler(
        inputCol="raw_features", outputCol="features", withMean=True, withStd=True
    ).fit(vectors)


def standardized_features(features: DataFrame) -> DataFrame:
    vectors = feature_vectors(features)
    scaled = vector_to_array(F.col("features"))
    named = [F.get(scaled, F.lit(i)).alias(f"{name}_z") for i, name in enumerate(FEATURES)]
    return fit_scaler(vectors).transform(vectors).select("customer_unique_id", *named)


def _hundredths(name: str) -> Column:
    return F.round(F.col(name).cast("double") * 100).cast(WHOLE)


def fit_scale(features: DataFrame) -> tuple[list[float], list[float], int]:
    """Means and sample deviations of the features in hundredths, and the number of customers."""
    columns = [_hundredths(name) for name in FEATURES]
    wide = "decimal(38,0)"
    row = features.agg(
        F.count("*").alias("n"),
        *(F.sum(c).cast(wide).alias(f"s{i}") for i, c in enumerate(columns)),
        *(F.sum((c * c).cast(wide)).alias(f"q{i}") for i, c in enumerate(columns)),
    ).first()
    n = row["n"]
    if n == 0:
        raise ValueError("no customer features to segment")
    sums = [int(row[f"s{i}"]) for i in range(len(FEATURES))]
    squares = [int(row[f"q{i}"]) for i in range(len(FEATURES))]
    means = [float(s) / float(n) for s in sums]
    spreads = [float(n * q - s * s) for s, q in zip(sums, squares)]
    deviations = [math.sqrt(x / (float(n) * float(n - 1))) if n > 1 else 0.0 for x in spreads]
    return means, deviations, n


def standard_points(features: DataFrame, means: list[float], deviations: list[float]) -> DataFrame:
    """(customer, z0, z1, ...): standardised features as whole numbers of 1/PARTS.

    A feature that never changes is 0 everywhere.
    """

    def whole(i: int, name: str) -> Column:
        if not deviations[i]:
            return F.lit(0).cast("long")
        z = (_hundredths(name).cast("double") - F.lit(means[i])) / F.lit(deviations[i])
        return F.floor(z * PARTS + 0.5)

    return features.select(PERSON, *(whole(i, name).alias(f"z{i}") for i, name in enumerate(FEATURES)))


def _squared(center: Sequence[float]) -> Column:
    """Squared distance of a point from a centre."""
    total = F.lit(0.0)
    for i, value in enumerate(center):
        part = F.col(f"z{i}") / F.lit(float(PARTS)) - F.lit(float(value))
        total = total + part * part
    return total


def _nearest(centers: list[list[float]]) -> Column:
    """Number of the nearest centre, the lower one of equally near ones."""
    distances = F.array(*(_squared(c) for c in centers))
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def _draw(seed: int, turn: int) -> Column:
    """A number above 0 and at most 1 from a hash of the customer, the seed and the turn."""
    digest = F.md5(F.concat_ws("|", F.col(PERSON).cast("string"), F.lit(seed), F.lit(turn)))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 1) / float(1 << 32)


def starting_centers(points: DataFrame, clusters: int, seed: int) -> list[list[float]]:
    """Customers drawn one after another, in proportion to the squared distance from those before.

    The one with the least -ln(draw) / distance is such a draw, and a minimum takes
    one number from each task.  There are fewer centres if there are fewer
    different customers.
    """
    centers: list[list[float]] = []
    values = [F.col(f"z{i}") for i in range(len(FEATURES))]
    for turn in range(clusters):
        chance = -F.log(_draw(seed, turn))
        rows = points
        if centers:
            apart = F.least(*(_squared(c) for c in centers)) if len(centers) > 1 else _squared(centers[0])
            rows = points.withColumn("apart", apart).filter("apart > 0")
            chance = chance / F.col("apart")
        first = rows.agg(F.min(F.struct(chance.alias("chance"), PERSON, *values)).alias("first")).first()
        if first["first"] is None:
            break
        centers.append([first["first"][f"z{i}"] / PARTS for i in range(len(FEATURES))])
    return centers


def _cluster_sums(
    points: DataFrame, centers: list[list[float]], squares: bool = False
) -> dict[int, dict[str, int]]:
    """Number and sums of the points of every cluster that has some, and if asked for the sum of squares.

    The decimals of the squares take longer than all the rest, and only the silhouette reads them.
    """
    span, low = range(len(FEATURES)), F.lit((1 << LOW_BITS) - 1)
    sums = [F.count("*").alias("n")]
    sums += [F.sum(F.col(f"z{i}").bitwiseAND(low)).alias(f"low{i}") for i in span]
    sums += [F.sum(F.shiftright(f"z{i}", LOW_BITS)).alias(f"high{i}") for i in span]
    if squares:
        values = [F.col(f"z{i}").cast(WHOLE) for i in span]
        square = values[0] * values[0]
        for value in values[1:]:
            square = square + value * value
        sums.append(F.sum(square.cast("decimal(38,0)")).alias("squares"))
    rows = points.groupBy(_nearest(centers).alias("cluster")).agg(*sums)
    found = {}
    for row in rows.collect():  # one row for each cluster
        found[row["cluster"]] = {"n": row["n"]} | {
            f"s{i}": (row[f"high{i}"] << LOW_BITS) + row[f"low{i}"] for i in span
        }
        if squares:
            found[row["cluster"]]["squares"] = int(row["squares"])
    return found


def _moved(centers: list[list[float]], sums: dict[int, dict[str, int]]) -> list[list[float]]:
    """The clusters' means; a cluster without points stays where it is."""
    return [
        [float(sums[k][f"s{i}"]) / float(sums[k]["n"]) / PARTS for i in range(len(center))]
        if k in sums
        else center
        for k, center in enumerate(centers)
    ]


def mean_silhouette(points: DataFrame, centers: list[list[float]]) -> float:
    """Mean silhouette by squared distances, in closed form.

    The mean squared distance from a point to a cluster is the point's square plus
    the cluster's mean square minus twice the product with the cluster's mean, so
    one pass for the clusters' sums and one over the points are enough.  A point
    alone in its cluster counts 0; with a single cluster there is no silhouette.
    """
    sums = _cluster_sums(points, centers, squares=True)
    if len(sums) < 2:
        return float("nan")
    z = [F.col(f"z{i}") / F.lit(float(PARTS)) for i in range(len(FEATURES))]
    square = z[0] * z[0]
    for value in z[1:]:
        square = square + value * value
    means = {}
    for k, row in sums.items():
        n = float(row["n"])
        product = F.lit(0.0)
        for i, value in enumerate(z):
            product = product + value * F.lit(float(row[f"s{i}"]) / n / PARTS)
        mean_square = float(row["squares"]) / n / PARTS / PARTS
        means[k] = square + F.lit(mean_square) - F.lit(2.0) * product
    own, other, alone = F.lit(None), [], F.lit(False)
    cluster = F.col("cluster")
    for k, mean in means.items():
        n = float(sums[k]["n"])
        own = F.when(cluster == k, mean * F.lit(n / (n - 1)) if n > 1 else F.lit(0.0)).otherwise(own)
        alone = F.when(cluster == k, F.lit(n == 1)).otherwise(alone)
        other.append(F.when(cluster != k, mean))
    # A minimum needs two columns; null ones do not count.
    a, b = F.col("own"), F.least(*other) if len(other) > 1 else other[0]
    rows = points.withColumn("cluster", _nearest(centers)).withColumns({"own": own, "other": b, "alone": alone})
    larger = F.greatest(a, F.col("other"))
    value = F.when(~F.col("alone") & (larger > 0), (F.col("other") - a) / larger).otherwise(0.0)
    total, n = rows.agg(F.sum(F.floor(value * PARTS + 0.5).cast(WHOLE)), F.count("*")).first()
    return float(int(total)) / float(n) / PARTS


def fit_segments(
    features: DataFrame,
    clusters: int = CLUSTERS,
    seed: int = SEED,
    max_iterations: int = MAX_ITERATIONS,
) -> SegmentModel:
    """Train on customer features until no centroid moves, or for so many passes."""
    means, deviations, customers = fit_scale(features)
    points = standard_points(features, means, deviations).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centers = starting_centers(points, clusters, seed)
        iterations = 0
        while iterations < max_iterations:
            moved = _moved(centers, _cluster_sums(points, centers))
            iterations += 1
            if moved == centers:
                break
            centers = moved
        silhouette = mean_silhouette(points, centers)
    finally:
        points.unpersist()
    labels = name_clusters(centers)
    return SegmentModel(means, deviations, centers, labels, silhouette, customers, iterations)


def assign_segments(model: SegmentModel, features: DataFrame) -> DataFrame:
    """Cluster, name and distance to the own centroid for every customer."""
    points = standard_points(features, model.means, model.deviations)
    names = F.array(*[F.lit(model.labels[i]) for i in range(len(model.labels))])
    distances = F.array(*(_squared(c) for c in model.centroids))
    placed = points.withColumn("cluster_id", _nearest(model.centroids))
    return placed.select(
        PERSON,
        F.col("cluster_id").cast("short").alias("cluster_id"),
        F.get(names, F.col("cluster_id")).alias("segment_label"),
        F.sqrt(F.array_min(distances)).alias("distance_to_centroid"),
        F.current_timestamp().alias("assigned_at"),
    )


def centroid_rows(spark: SparkSession, model: SegmentModel) -> DataFrame:
    """One row per cluster: its name and its centroid, standardised and in the features' units."""
    rows = [
        (k, model.labels[k], *z, *x)
        for k, (z, x) in enumerate(zip(model.centroids, model.original_centroids))
    ]
    columns = ", ".join(f"{name}{end} double" for end in ("_z", "") for name in FEATURES)
    return spark.createDataFrame(rows, f"cluster_id int, segment_label string, {columns}")


def segment_sizes(segments: DataFrame) -> DataFrame:
    return (
        segments.groupBy("segment_label")
        .agg(F.count("*").alias("customers"))
        .orderBy(F.col("customers").desc(), "segment_label")
    )
