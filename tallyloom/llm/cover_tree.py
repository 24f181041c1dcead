"""Exact top-k inner products with a dual-tree search over cover trees.

Candidates and queries are dealt into blocks of bounded size, and each block
becomes a cover tree once.  A task takes one block of queries and a few blocks
of candidates and walks both trees together: a pair of nodes is given up when
no inner product between their balls can reach the worst k-th score of the
queries below the query node.  What the tasks find is ranked per query.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import written
from tallyloom.llm.vectors import best_ranked, matrix, usable_vectors

BASE = 1.3
LEAF = 32
BLOCK = 4096
QUERY_BLOCK = 512
BLOCKS_AT_ONCE = 4
POINTS_AT_ONCE = 512
ID_BITS = 15  # numbers of the candidates of one task
NOTHING = -np.iinfo(np.int64).max


@dataclass
class CoverTree:
    """Rows in tree order; a node covers the rows low to high around its centre."""

    ids: np.ndarray
    points: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray
    child: np.ndarray
    children: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, points: np.ndarray) -> CoverTree:
        """Each level is a farthest-first net: centres lie further apart than they cover."""
        spots = np.arange(len(points))
        rows = []  # centre, radius, low, high, first child, number of children
        rows.append([0, 0.0, 0, len(points), 0, 0])
        at = 0
        while at < len(rows):
            centre, _, low, high = rows[at][:4]
            own = spots[low:high]
            distance = np.sqrt(((points[own] - points[centre]) ** 2).sum(axis=1))
            rows[at][1] = radius = float(distance.max(initial=0.0))
            if len(own) > LEAF and radius > 0:
                label = np.zeros(len(own), np.int64)
                centres = [centre]
                while distance.max() > radius / BASE:
                    far = own[int(distance.argmax())]
                    other = np.sqrt(((points[own] - points[far]) ** 2).sum(axis=1))
                    closer = other < distance
                    label[closer] = len(centres)
                    distance[closer] = other[closer]
                    centres.append(far)
                order = np.argsort(label, kind="stable")
                spots[low:high] = own[order]
                ends = low + np.cumsum(np.bincount(label, minlength=len(centres)))
                rows[at][4:] = len(rows), len(centres)
                starts = [low, *ends[:-1].tolist()]
                rows += [
                    [c, 0.0, a, b, 0, 0] for c, a, b in zip(centres, starts, ends, strict=True)
                ]
            at += 1
        place = np.empty(len(spots), np.int64)
        place[spots] = np.arange(len(spots))
        columns = [np.array(c) for c in zip(*rows, strict=True)]
        columns[0] = place[columns[0].astype(np.int64)] if len(spots) else columns[0]
        return cls(ids[spots], points[spots], *columns)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.__dict__)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CoverTree:
        with np.load(io.BytesIO(data)) as parts:
            return cls(**{k: parts[k] for k in parts.files})

    @property
    def norms(self) -> np.ndarray:
        if "_norms" not in self.__dict__:
            self._norms = np.sqrt((self.points**2).sum(axis=1))
        return self._norms


class DualSearch:
    """Best k candidates of each query; `keys` order by score, then by smaller number."""

    def __init__(self, queries: CoverTree, k: int, numbers: np.ndarray):
        self.queries, self.k, self.numbers = queries, k, numbers
        self.keys = np.full((len(queries.ids), k), NOTHING)

    def worst(self, node: int) -> float:
        """Least score that can still enter a list of the node's queries."""
        rows = self.keys[self.queries.low[node] : self.queries.high[node], -1]
        least = int(rows.min())
        return -np.inf if least == NOTHING else least >> ID_BITS

    def bounds(self, node: int, tree: CoverTree, nodes: np.ndarray) -> np.ndarray:
        """Largest possible inner product between the balls of a query node and of others."""
        own = self.queries
        centre, radius = own.centre[node], own.radius[node]
        others, reach = tree.centre[nodes], tree.radius[nodes]
        dot = tree.points[others] @ own.points[centre]
        slack = radius * tree.norms[others] + reach * (own.norms[centre] + radius)
        return dot + slack * (1 + 1e-9) + 1e-6

    def walk(self, node: int, tree: CoverTree, nodes: np.ndarray) -> None:
        own = self.queries
        nodes = nodes[self.bounds(node, tree, nodes) >= self.worst(node)]
        if not own.children[node]:
            self.scan(node, tree, nodes)
            return
        wide = (tree.children[nodes] > 0) & (tree.radius[nodes] >= own.radius[node])
        nodes = np.concatenate([nodes[~wide], self.below(tree, nodes[wide])])
        first = own.child[node]
        for child in range(first, first + own.children[node]):
            self.walk(child, tree, nodes)

    @staticmethod
    def below(tree: CoverTree, nodes: np.ndarray) -> np.ndarray:
        many = tree.children[nodes]
        ends = np.cumsum(many)
        return np.repeat(tree.child[nodes] - (ends - many), many) + np.arange(many.sum())

    def scan(self, node: int, tree: CoverTree, nodes: np.ndarray) -> None:
        """Base case: nodes in order of their bounds, opened or compared point by point."""
        bounds = self.bounds(node, tree, nodes)
        while len(nodes):
            fits = bounds >= self.worst(node)
            order = np.argsort(-bounds[fits], kind="stable")
            nodes, bounds = nodes[fits][order], bounds[fits][order]
            sizes = np.cumsum(tree.high[nodes] - tree.low[nodes])
            take = max(1, int(np.searchsorted(sizes, POINTS_AT_ONCE, side="right")))
            now, nodes, bounds = nodes[:take], nodes[take:], bounds[take:]
            inner = tree.children[now] > 0
            if inner.any():
                opened = self.below(tree, now[inner])
                nodes = np.concatenate([nodes, opened])
                bounds = np.concatenate([bounds, self.bounds(node, tree, opened)])
            self.compare(node, tree, now[~inner])

    def compare(self, node: int, tree: CoverTree, leaves: np.ndarray) -> None:
        if not len(leaves):
            return
        sizes = tree.high[leaves] - tree.low[leaves]
        ends = np.cumsum(sizes)
        spots = np.repeat(tree.low[leaves] - (ends - sizes), sizes) + np.arange(ends[-1])
        low, high = self.queries.low[node], self.queries.high[node]
        scores = self.queries.points[low:high] @ tree.points[spots].T
        keys = (scores.astype(np.int64) << ID_BITS) + ((1 << ID_BITS) - 1 - self.numbers[spots + tree.first])
        keys[self.queries.ids[low:high, None] == tree.ids[spots][None, :]] = NOTHING
        both = np.concatenate([self.keys[low:high], keys], axis=1)
        both = -np.partition(-both, self.k - 1, axis=1)[:, : self.k]
        self.keys[low:high] = -np.sort(-both, axis=1)


def trees_of(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """(block, tree) of rows (vec_id, v), dealt evenly."""

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tree = CoverTree.build(table.column("vec_id").to_numpy(), matrix(table.column("v")))
        return pa.table(
            {"block": pa.array([key[0].as_py()], pa.int32()), "tree": pa.array([tree.dump()], pa.binary())}
        )

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    trees = dealt.groupBy("block").applyInArrow(build, "block int, tree binary")
    return written(trees, name)


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    scale: float = 64.0,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score long): each query's k best of all other rows.

    Components become floor(scale * x); the score is the integer inner product,
    ties go to the smaller vec_id.  Null vectors and those with null or
    non-finite components take no part, rows with the query's id are not its
    candidates, and a repeated query id is answered once.  Rows equal in id and
    scaled vector are one candidate; rows of one id with different scaled
    vectors are candidates of their own, each with its rank.  Scores must stay
    below 2^47, which the search checks.
    """
    floor = F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("double"))
    rows = usable_vectors(vectors, vec_id, vector, zeros=True).withColumn("v", floor)
    rows = rows.dropDuplicates(["vec_id", "v"])
    asked = usable_vectors(queries, vec_id, vector, zeros=True).withColumn("v", floor)
    asked = asked.dropDuplicates(["vec_id"])
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, top = rows.agg(F.count("*"), F.max(square)).first()
    m = asked.count()
    if top and top >= 2.0**47:
        raise ValueError("inner products of the scaled vectors may reach 2^47")
    blocks, parts = -(-n // BLOCK) or 1, -(-m // QUERY_BLOCK) or 1
    tasks = -(-blocks // BLOCKS_AT_ONCE)
    some = trees_of(rows, blocks, "candidate-trees").select(
        F.pmod("block", F.lit(tasks)).alias("task"),
        "tree",
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
    )
    own = trees_of(asked, parts, "query-trees").select(
        F.col("block").alias("part"),
        "tree",
        F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"),
    )

    def search(asked: pa.Table, there: pa.Table) -> pa.Table:
        empty = np.zeros(0, np.int64)
        if not len(asked) or not len(there):
            return pa.table({"query_id": empty, "vec_id": empty, "score": empty})
        trees = [CoverTree.load(x) for x in there.column("tree").to_pylist()]
        ids, numbers = np.unique(np.concatenate([t.ids for t in trees]), return_inverse=True)
        if len(ids) > 1 << ID_BITS:
            raise ValueError("a task's candidates exceed its numbers")
        found = DualSearch(CoverTree.load(asked.column("tree")[0].as_py()), k, numbers)
        first = 0
        for tree in trees:
            tree.first = first
            first += len(tree.ids)
            found.walk(0, tree, np.zeros(1, np.int64))
        used = found.keys != NOTHING
        keys = found.keys[used]
        number = (1 << ID_BITS) - 1 - (keys & (1 << ID_BITS) - 1)
        return pa.table(
            {
                "query_id": np.repeat(found.queries.ids, used.sum(axis=1)),
                "vec_id": ids[number],
                "score": keys >> ID_BITS,
            }
        )

    pairs = own.groupBy("part", "task").cogroup(some.groupBy("part", "task"))
    found = pairs.applyInArrow(search, "query_id long, vec_id long, score long")
    return best_ranked(found, k)
