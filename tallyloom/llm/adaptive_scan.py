"""Approximate nearest neighbours by adaptive dimension scans of inverted lists.

Largest inner product becomes smallest distance by one more component that
gives all candidates the same norm.  A fixed random rotation spreads every
difference evenly over the dimensions, so that the distance over the first d
of D dimensions estimates the whole one.  Rows lie in inverted lists of k-means
centres; a query goes to the lists nearest to it and to no others.  A list is
scanned in blocks of columns, and after each block a hypothesis test abandons
the candidates whose partial distance is too large for the query's k-th best
distance so far.  Some rows of the sample lie in a common list that every query
scans first and whole, so that there is such a distance from the start; then
come the nearest list, a few more, and the others, each round with the distance
that the round before has found.

Centres are fitted on a bounded sample, drawn and ordered by hash; every row is
in one list, or in the common one.  How many lists a query probes is measured: on queries from the
sample, against exact answers, so many that the wanted share is found.  Lists
are dealt to tasks by their counted sizes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import written
from tallyloom.llm.vectors import best_ranked, matrix, usable_vectors

SAMPLE = 16384
# Rows of the sample for each centre, at least.
SAMPLE_A_LIST = 16
TRIAL_QUERIES = 512
COMMON_ROWS = 4096
ROWS_AT_ONCE = 8192
SCAN_ROWS = 2048
QUERY_BLOCK = 4096
COLUMN_BLOCK = 16
STRICTNESS = 2.6
SPARE = 12
ROUNDS = 10


@dataclass
class Index:
    """What all tasks need: rotation, common squared norm, centres and some rows, of bounded size."""

    rotation: np.ndarray
    norm2: float
    centres: np.ndarray
    probes: int
    common_ids: np.ndarray
    common: np.ndarray

    def candidates(self, x: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.norm2 - (x * x).sum(axis=1), 0))
        return np.column_stack([x, extra]) @ self.rotation

    def queries(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, np.zeros(len(x))]) @ self.rotation

    def closeness(self, rotated: np.ndarray) -> np.ndarray:
        return rotated @ self.centres.T - 0.5 * (self.centres**2).sum(axis=1)

    def first_best(self, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Each query's k best places in the common list and their scores, minus infinity for its own id."""
        scores = x @ self.common.T
        scores[ids[:, None] == self.common_ids] = -np.inf
        place = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        best = np.einsum("qd,qkd->qk", x, self.common[place])
        return place, np.where(np.isfinite(np.take_along_axis(scores, place, axis=1)), best, -np.inf)

    def bounds(self, x: np.ndarray, best: np.ndarray, k: int) -> np.ndarray:
        """Squared distance of a k-th best score; infinite where there are not so many."""
        if best.shape[1] < k:
            return np.full(len(x), np.inf)
        return ((x * x).sum(axis=1) + self.norm2 - 2 * best[:, k - 1]) * (1 + 1e-9) + 1e-9


def fit_index(
    ids: np.ndarray, sample: np.ndarray, norm2: float, rows: int, k: int, recall: float, seed: int
) -> Index:
    rng = np.random.default_rng(seed)
    d = sample.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
    common = common_rows(len(sample), k)
    index = Index(rotation, norm2, np.zeros((1, d)), 1, ids[:common], sample[:common])
    x = index.candidates(sample)
    lists = max(1, min(int(np.sqrt(rows)), len(x) // SAMPLE_A_LIST))
    index.centres = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(ROUNDS):
        near = index.closeness(x).argmax(axis=1)
        order = np.argsort(near, kind="stable")
        found, first = np.unique(near[order], return_index=True)
        sums = np.add.reduceat(x[order], first, axis=0)
        index.centres[found] = sums / np.diff(np.append(first, len(x)))[:, None]
    index.probes = measured_probes(index, ids, sample, x, k, recall)
    return index


def common_rows(sample: int, k: int) -> int:
    """Rows of the common list: an eighth of the sample, and more where that were hardly enough for k."""
    return min(sample, COMMON_ROWS, max(4 * k, sample // 8))


def measured_probes(index: Index, ids: np.ndarray, sample: np.ndarray, x: np.ndarray, k: int, recall: float) -> int:
    """The least number of lists in which the wanted share of exact neighbours lies, on trial queries."""
    near = index.closeness(x).argmax(axis=1)
    trial = slice(0, TRIAL_QUERIES)
    scores = sample[trial] @ sample.T
    scores[ids[trial, None] == ids] = -np.inf
    k = min(k, scores.shape[1])
    best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    rank = np.argsort(np.argsort(-index.closeness(index.queries(sample[trial])), axis=1, kind="stable"), axis=1)
    needed = np.sort(np.take_along_axis(rank, near[best], axis=1).reshape(-1)) + 1
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])


class Scan:
    """The nearest candidates found so far for a block of queries."""

    def __init__(self, queries: np.ndarray, bounds: np.ndarray, k: int):
        self.queries, self.bounds, self.k = queries, bounds, k
        self.distance = np.full((len(queries), k + SPARE), np.inf)
        self.place = np.full((len(queries), k + SPARE), -1)

    def scan(self, who: np.ndarray, rows: np.ndarray, places: np.ndarray, own) -> None:
        """Compare some queries with the rows of one list; `own` marks pairs to leave out."""
        d = rows.shape[1]
        reach = np.minimum(self.distance[who, self.k - 1], self.bounds[who])
        q = self.queries[who]
        q_at, r_at = np.nonzero(~own)
        part = np.zeros(len(q_at))
        for low in range(0, d, COLUMN_BLOCK):
            high = min(low + COLUMN_BLOCK, d)
            if low == 0:
                a, b = q[:, :high], rows[:, :high]
                near = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
                part = near[q_at, r_at]
            else:
                for at in range(0, len(q_at), 1 << 16):
                    some = slice(at, at + (1 << 16))
                    gap = q[q_at[some], low:high] - rows[r_at[some], low:high]
                    part[some] += np.einsum("ij,ij->i", gap, gap)
            # Abandon what is too far to be explained by the dimensions not yet seen.
            test = 1.0 if high == d else high / d * (1 + STRICTNESS / np.sqrt(high)) ** 2
            alive = part <= reach[q_at] * test
            q_at, r_at, part = q_at[alive], r_at[alive], part[alive]
        self._merge(who, q_at, places[r_at], part)

    def _merge(self, who, q_at, places, distances) -> None:
        if not len(q_at):
            return
        hit, counts = np.unique(q_at, return_counts=True)
        width = int(counts.max())
        starts = np.cumsum(counts) - counts
        order = np.argsort(q_at, kind="stable")
        column = np.arange(len(order)) - np.repeat(starts, counts)
        near = np.full((len(hit), width), np.inf)
        spot = np.full((len(hit), width), -1)
        line = np.repeat(np.arange(len(hit)), counts)
        near[line, column], spot[line, column] = distances[order], places[order]
        own = who[hit]
        near = np.concatenate([self.distance[own], near], axis=1)
        spot = np.concatenate([self.place[own], spot], axis=1)
        best = np.argsort(near, axis=1, kind="stable")[:, : self.k + SPARE]
        self.distance[own] = np.take_along_axis(near, best, axis=1)
        self.place[own] = np.take_along_axis(spot, best, axis=1)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    recall: float = 0.98,
    seed: int = 7,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score double): the k nearest found by inner product.

    A query probes as many lists as hold `recall` of the exact neighbours of
    trial queries; on vectors without any clusters these are many.  The scans
    then lose about one neighbour in a hundred.

    Null, empty, zero and non-finite vectors take no part, rows with the query's id
    are not its candidates, and ties go to the smaller vec_id.  Rows equal in id
    and vector are one candidate; rows of one id with different vectors are
    candidates of their own, each with its rank, and as a query such an id is
    answered once, for the vector that sorts first.  The score is the double inner
    product of the original vectors.  The result does not depend on the layout
    of the rows.  Other columns are left alone, whatever they are called.  Empty
    tables give no rows.
    """
    spark = vectors.sparkSession
    rows = usable_vectors(vectors, vec_id, vector, zeros=False).dropDuplicates(["vec_id", "v"])
    asked = usable_vectors(queries, vec_id, vector, zeros=False)
    asked = asked.groupBy("vec_id").agg(F.min("v").alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, norm2 = rows.agg(F.count("*"), F.max(square)).first()
    m = asked.count()
    if not n or not m:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # At most SAMPLE rows come to the driver, in an order that only depends on the rows.
    draw = F.xxhash64(F.lit(seed), "vec_id", "v")
    few = F.pmod(draw, F.lit(n)) < 2 * SAMPLE
    sample = rows.where(few).withColumn("draw", draw).orderBy("draw").limit(SAMPLE).toArrow()
    # The last row of the common list, in the sample's order.
    mark = sample.column("draw")[common_rows(len(sample), k) - 1].as_py()
    fitted = fit_index(
        sample.column("vec_id").to_numpy(), matrix(sample.column("v")), norm2, n, k, recall, seed
    )
    index = spark.sparkContext.broadcast(fitted)

    def assign(batches):
        for batch in batches:
            x = matrix(pa.chunked_array([batch.column(1)]))
            if len(x):
                near = index.value.closeness(index.value.candidates(x)).argmax(axis=1)
                yield pa.record_batch(
                    [*batch.columns, pa.array(near, pa.int32())], ["vec_id", "v", "list"]
                )

    def choose(batches):
        for batch in batches:
            x = matrix(pa.chunked_array([batch.column(1)]))
            if len(x):
                plan = index.value
                near = np.argsort(-plan.closeness(plan.queries(x)), axis=1, kind="stable")[:, : plan.probes]
                place, best = plan.first_best(batch.column(0).to_numpy(), x, k)
                arrays = (near.astype(np.int32), plan.common_ids[place], best)
                columns = [
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(x) + 1, dtype=np.int32) * values.shape[1]),
                        pa.array(values.reshape(-1)),
                    )
                    for values in arrays
                ]
                yield pa.record_batch(
                    [*batch.columns, pa.array(plan.bounds(x, best, k)), *columns],
                    ["vec_id", "v", "bound", "lists", "near", "scores"],
                )

    others = rows.where(~(few & (draw <= mark)))
    listed = written(others.mapInArrow(assign, "vec_id long, v array<double>, list int"), "listed")
    schema = "vec_id long, v array<double>, bound double, lists array<int>, near array<long>, scores array<double>"
    answered = written(asked.mapInArrow(choose, schema), "probing")
    first = answered.select(
        F.col("vec_id").alias("query_id"), F.explode(F.arrays_zip("near", "scores")).alias("x")
    ).select("query_id", F.col("x.near").alias("vec_id"), F.col("x.scores").alias("score"))
    best = first.where(F.col("score") > float("-inf"))
    answered = answered.select("vec_id", "v", "bound", "lists")
    # One number for each list: its rows.
    sizes = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}

    def search(asked: pa.Table, there: pa.Table) -> pa.Table:
        empty = np.zeros(0, np.int64)
        if not len(asked) or not len(there):
            return pa.table({"query_id": empty, "vec_id": empty, "score": np.zeros(0)})
        plan = index.value
        there = there.take(pa.array(np.argsort(there.column("vec_id").to_numpy(), kind="stable")))
        query, x = asked.column("vec_id").to_numpy(), matrix(asked.column("v"))
        ids, y = there.column("vec_id").to_numpy(), matrix(there.column("v"))
        rotated = plan.candidates(y)
        found = Scan(plan.queries(x), asked.column("bound").to_numpy(), k)
        everyone = np.arange(len(query))
        for at in range(0, len(ids), SCAN_ROWS):
            part = np.arange(at, min(at + SCAN_ROWS, len(ids)))
            for low in range(0, len(query), 512):
                who = everyone[low : low + 512]
                found.scan(who, rotated[part], part, query[who, None] == ids[part][None, :])
        line, column = np.nonzero(found.place >= 0)
        place = found.place[line, column]
        scores = np.einsum("ij,ij->i", x[line], y[place])
        best = np.lexsort((ids[place], -scores, line))
        turn = np.arange(len(best)) - np.searchsorted(line[best], line[best])
        best = best[turn < k]
        return pa.table({"query_id": query[line[best]], "vec_id": ids[place[best]], "score": scores[best]})

    def scanned(probing: DataFrame) -> DataFrame:
        """What (vec_id, v, bound, list) rows find; lists of many rows or queries meet in parts."""
        callers = {r["list"]: r["count"] for r in probing.groupBy("list").count().collect()}
        span = range(len(fitted.centres))
        shares = [max(1, -(-sizes.get(i, 0) // ROWS_AT_ONCE)) for i in span]
        blocks = [-(-callers.get(i, 0) // QUERY_BLOCK) for i in span]
        shares, blocks = (
            F.get(F.array(*map(F.lit, counts)), F.col("list")).cast("long") for counts in (shares, blocks)
        )
        zero = F.lit(0).cast("long")
        there = listed.where(blocks > 0).select(
            "vec_id",
            "v",
            "list",
            F.pmod(F.xxhash64("vec_id", "v"), shares).alias("share"),
            F.explode(F.sequence(zero, blocks - 1)).alias("block"),
        )
        own = probing.select(
            "vec_id",
            "v",
            "bound",
            "list",
            F.pmod(F.xxhash64("vec_id"), blocks).alias("block"),
            F.explode(F.sequence(zero, shares - 1)).alias("share"),
        )
        keys = ("list", "share", "block")
        pairs = own.groupBy(*keys).cogroup(there.groupBy(*keys))
        return pairs.applyInArrow(search, "query_id long, vec_id long, score double")

    ends = sorted({1, -(-fitted.probes // 8), fitted.probes})
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    for start, end in zip([0, *ends[:-1]], ends, strict=True):
        few_lists = answered.withColumn("list", F.explode(F.slice("lists", start + 1, end - start)))
        found = scanned(few_lists.select("vec_id", "v", "bound", "list"))
        best = written(best_ranked(best.union(found), k).drop("rank"), "best")
        if end < fitted.probes:
            worst = best.groupBy("query_id").agg(F.count("*").alias("found"), F.min("score").alias("worst"))
            reach = (square + F.lit(float(norm2)) - 2 * F.col("worst")) * (1 + 1e-9) + 1e-9
            answered = written(
                answered.join(worst, answered["vec_id"] == worst["query_id"], "left").select(
                    "vec_id", "v", F.when(F.col("found") >= k, reach).otherwise(F.col("bound")).alias("bound"), "lists"
                ),
                "probing",
            )
    return best_ranked(best, k)
