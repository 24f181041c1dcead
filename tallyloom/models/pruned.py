"""Top products by inner product, without scoring every pair.

A score is at most the product of the two norms.  Products are sorted by norm
and cut into large blocks.  Inside a block they lie by direction in small
steps, each with its largest norm and the box around its vectors; customers
whose score to beat, the k-th so far, is out of reach of a step leave it out,
for the others it is one matrix product.  The block at the top goes to all
customers and ends the search of most; the others only meet the blocks whose
norms can still beat their score.  Vectors are copied once for each large block
that is met, not for each step.  Products that a customer has already are
masked inside the pair they fall in.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage

USER_BLOCK = 4096
ITEM_BLOCK = 262144
# Products of one matrix product inside a pair of blocks.
ITEM_STEP = 1024
# Tasks that share the customers of one later block of products.
LANES = 8
# Single precision may round a score just above its bound, by this share of the norms.
ROUNDING = 1e-5
SLACK = 1 + ROUNDING
PACKED = "block long, ids array<int>, vectors array<float>"


@dataclass(frozen=True)
class TopItems:
    # (user_idx, item_idx, rank, score)
    lists: DataFrame
    # (users, items) of every pair of blocks that met; not all of its steps were scored.
    pairs: DataFrame


def packed(rows: DataFrame, size: int, schema: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows (id, features, ...) in their present order, `size` of them as one row with a block number.

    Block numbers ascend with the partitions and inside of them.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        waiting: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            waiting = table if waiting is None else pa.concat_tables([waiting, table])
            while len(waiting) >= size:
                yield block(waiting.slice(0, size), number)
                waiting, number = waiting.slice(size), number + 1
        if waiting is not None and len(waiting):
            yield block(waiting, number)

    def block(table: pa.Table, number: int) -> pa.RecordBatch:
        vectors = pa.concat_arrays([chunk.flatten() for chunk in table["features"].chunks])
        lists = [table["id"].combine_chunks(), vectors, *(table[c].combine_chunks() for c in extra)]
        columns = [pa.array([number], pa.int64())]
        for values in lists:
            flat = pa.concat_arrays(values.chunks) if isinstance(values, pa.ChunkedArray) else values
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
        return pa.record_batch(columns, ["block", "ids", "vectors", *extra])

    return rows.select("id", "features", *extra).mapInArrow(run, schema)


def by_norm(items: DataFrame, size: int) -> DataFrame:
    """Blocks of products from the largest norm to the smallest."""
    square = F.aggregate("features", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    normed = items.select("id", "features", F.sqrt(square).alias("norm"))
    tasks = max(1, -(-items.count() // (4 * size)))
    order = (F.desc("norm"), F.asc("id"))
    return packed(normed.repartitionByRange(tasks, *order).sortWithinPartitions(*order), size, PACKED)


def _matrix(batch: pa.RecordBatch, column: str, row: int) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column(f"{column}_ids")[row].values.to_numpy()
    flat = batch.column(f"{column}_vectors")[row].values.to_numpy()
    return ids, flat.reshape(len(ids), -1) if len(ids) else flat.reshape(0, 0)


@dataclass(frozen=True)
class Steps:
    """Products of a block by direction and norm, with the largest norm of each step and its box."""

    ids: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    high: np.ndarray
    low: np.ndarray


def steps(ids: np.ndarray, v: np.ndarray) -> Steps:
    lead = np.abs(v).argmax(axis=1)
    negative = v[np.arange(len(v)), lead] < 0
    norms = np.linalg.norm(v.astype(np.float64), axis=1)
    order = np.lexsort((-norms, negative, lead))
    ids, v, norms = ids[order], v[order], norms[order]
    starts = np.arange(0, len(v), ITEM_STEP)
    return Steps(
        ids,
        v,
        np.maximum.reduceat(norms, starts),
        np.maximum.reduceat(v, starts, axis=0),
        np.minimum.reduceat(v, starts, axis=0),
    )


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray, Steps]]:
    """Batch, row, users' ids and vectors, and products of each pair; pairs of a block of products mostly follow each other."""
    number, block = None, None
    for batch in batches:
        for row in range(len(batch)):
            if block is None or batch.column("item_block")[row].as_py() != number:
                number = batch.column("item_block")[row].as_py()
                block = steps(*_matrix(batch, "item", row))
            yield batch, row, *_matrix(batch, "user", row), block


def _had(batch: pa.RecordBatch, row: int, users: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (user, item) inside a pair of blocks of the products had already, by place of the item."""
    had = batch.column("had")[row].values
    if had is None or not len(had):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    who, what = (had.field(k).to_numpy() for k in (0, 1))
    by_user, by_item = np.argsort(users), np.argsort(items)
    who = by_user[np.searchsorted(users, who, sorter=by_user)]
    what = by_item[np.searchsorted(items, what, sorter=by_item)]
    order = np.argsort(what)
    return who[order], what[order]


def walk(
    u: np.ndarray, block: Steps, k: int, beat: np.ndarray, had: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each user's k largest scores above `beat`, their places in the block, and the score to beat afterwards.

    Missing scores are minus infinity.
    """
    values = np.full((len(u), k), -np.inf, np.float32)
    places = np.zeros((len(u), k), np.int64)
    beat = beat.copy()
    wide = u.astype(np.float64)
    reach = block.norms[:, None] * np.linalg.norm(wide, axis=1)
    box = block.high @ np.maximum(wide, 0).T + block.low @ np.minimum(wide, 0).T
    bound = np.minimum(box + ROUNDING * reach, SLACK * reach)
    who, what = had
    for step in np.argsort(-block.norms, kind="stable"):
        rows = np.flatnonzero(bound[step] > beat)
        if not len(rows):
            continue
        first = step * ITEM_STEP
        scores = u[rows] @ block.vectors[first : first + ITEM_STEP].T
        here = slice(*np.searchsorted(what, [first, first + ITEM_STEP]))
        if here.start < here.stop:
            at = np.minimum(np.searchsorted(rows, who[here]), len(rows) - 1)
            met = rows[at] == who[here]
            scores[at[met], what[here][met] - first] = -np.inf
        hit = scores.max(axis=1) > beat[rows]
        better = rows[hit]
        scores = scores[hit]
        scores[scores <= beat[better, None]] = -np.inf
        both = np.concatenate([values[better], scores], axis=1)
        place = np.argpartition(-both, k - 1, axis=1)[:, :k]
        kept = np.take_along_axis(places[better], np.minimum(place, k - 1), axis=1)
        values[better] = np.take_along_axis(both, place, axis=1)
        places[better] = np.where(place < k, kept, place - k + first)
        beat[better] = np.maximum(beat[better], values[better].min(axis=1))
    return values, places, beat


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def first_lists(pairs: DataFrame, k: int, norms: np.ndarray) -> DataFrame:
    """Every customer's best products of the top block, best first, and how many blocks may hold better ones.

    Only customers for whom that is more than the top block keep their features.
    """
    shared = pairs.sparkSession.sparkContext.broadcast(norms)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, users, u, block in _pairs(batches):
            had = _had(batch, row, users, block.ids)
            values, places, beat = walk(u, block, k, np.full(len(u), -np.inf), had)
            length = np.linalg.norm(u.astype(np.float64), axis=1) * SLACK
            # Norms descend, so the blocks that may beat a score come first.
            need = np.array([np.searchsorted(-shared.value * n, -b) for n, b in zip(length, beat)])
            ids = block.ids[places]
            order = np.lexsort((ids, -values), axis=1)
            ids, values = (np.take_along_axis(x, order, axis=1) for x in (ids, values))
            kept, open_ = np.isfinite(values), need > 1
            yield pa.record_batch(
                [
                    pa.array(users),
                    _lists(u[open_].reshape(-1), open_ * u.shape[1], pa.float32()),
                    pa.array(beat),
                    pa.array(need.astype(np.int32)),
                    _lists(ids[kept], kept.sum(axis=1), pa.int32()),
                    _lists(values[kept], kept.sum(axis=1), pa.float32()),
                ],
                ["id", "features", "beat", "need", "items", "scores"],
            )

    schema = "id int, features array<float>, beat double, need int, items array<int>, scores array<float>"
    return pairs.mapInArrow(run, schema)


def later_lists(pairs: DataFrame, k: int) -> DataFrame:
    """(user_idx, item_idx, score): products of a pair of blocks that beat a customer's score so far."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, users, u, block in _pairs(batches):
            beat = batch.column("beat")[row].values.to_numpy()
            values, places, _ = walk(u, block, k, beat, _had(batch, row, users, block.ids))
            who, at = np.nonzero(np.isfinite(values))
            yield pa.record_batch(
                [pa.array(users[who]), pa.array(block.ids[places[who, at]]), pa.array(values[who, at])],
                ["user_idx", "item_idx", "score"],
            )

    return pairs.mapInArrow(run, "user_idx int, item_idx int, score float")


def _with_had(pairs: DataFrame, had: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """The pairs with the (user, item) ids in them that are not to be recommended.

    Pairs come as numbers of blocks; with their vectors they would be shuffled whole.
    """
    where_users = users.select(F.col("user_block"), F.explode("user_ids").alias("user_idx"))
    where_items = items.select(F.col("item_block"), F.explode("item_ids").alias("item_idx"))
    # A pair of blocks holds what its customers bought.
    inside = (
        had.join(where_items, "item_idx")
        .join(where_users, "user_idx")
        .groupBy("user_block", "item_block")
        .agg(F.collect_list(F.struct("user_idx", "item_idx")).alias("had"))
    )
    return pairs.join(inside, ["user_block", "item_block"], "left").withColumn("had", F.coalesce("had", _nothing()))


def _nothing() -> Column:
    return F.array().cast("array<struct<user_idx:int,item_idx:int>>")


def _meeting(users: DataFrame, numbers: Column, had: DataFrame | None, items: DataFrame) -> DataFrame:
    """Blocks of users, once for each number of a block of items they meet, with what they have of it."""
    met = users.withColumn("item_block", F.explode(numbers))
    if had is None:
        return met.withColumn("had", _nothing())
    return _with_had(met.select("user_block", "item_block"), had, users, items).join(users, "user_block")


def _named(blocks: DataFrame, prefix: str) -> DataFrame:
    return blocks.withColumnsRenamed({c: f"{prefix}_{c}" for c in ("block", "ids", "vectors")})


def top_items(
    users: DataFrame,
    items: DataFrame,
    k: int,
    had: DataFrame | None = None,
    user_block: int = USER_BLOCK,
    item_block: int = ITEM_BLOCK,
) -> TopItems:
    """Each user's k items of largest inner product, from factors (id, features).

    ``had`` holds (user_idx, item_idx) pairs to leave out; a list still has k
    items while others remain.  Equal scores rank by item, of those that
    were scored.  Without users or items there are no lists.
    """
    session = users.sparkSession
    item_blocks = cut_lineage(_named(by_norm(items, item_block), "item"))
    known = None if had is None else cut_lineage(had.select("user_idx", "item_idx").distinct())
    # One number for each block of products.
    width = F.size("item_vectors") / F.size("item_ids")
    head = F.slice("item_vectors", F.lit(1), width.cast("int"))
    tops = item_blocks.select(
        "item_block",
        F.sqrt(F.aggregate(head, F.lit(0.0), lambda total, x: total + x.cast("double") * x)).alias("norm"),
    )
    known_tops = sorted((r["item_block"], r["norm"]) for r in tops.collect())
    empty = session.createDataFrame([], "user_idx int, item_idx int, rank int, score float")
    if not known_tops:
        return TopItems(empty, session.createDataFrame([], "users int, items int"))
    numbers, norms = (list(x) for x in zip(*known_tops))

    parts = max(1, -(-users.count() // (4 * user_block)))
    spread = users.select("id", "features").repartition(parts, "id")
    first_users = cut_lineage(_named(packed(spread, user_block, PACKED), "user"))
    # The one block of the largest norms, of at most item_block products.
    top = item_blocks.filter(F.col("item_block") == numbers[0])
    first_pairs = _meeting(first_users, F.array(F.lit(numbers[0])), known, top).join(F.broadcast(top), "item_block")
    firsts = cut_lineage(first_lists(first_pairs, k, np.array(norms)))
    zipped = F.arrays_zip(F.col("items").alias("item_idx"), F.col("scores").alias("score"))
    # Lists are complete, and in order, where no other block may hold a better product.
    done = (
        firsts.filter("need <= 1")
        .select(F.col("id").alias("user_idx"), F.posexplode(zipped).alias("place", "x"))
        .select("user_idx", "x.item_idx", (F.col("place") + 1).alias("rank"), "x.score")
    )

    # Customers who need about as many blocks meet them together.
    open_ = firsts.filter("need > 1")
    tasks = max(1, -(-open_.count() // (4 * user_block)))
    grouped = open_.select("id", "features", "beat", "need").repartitionByRange(tasks, "need", "id")
    schema = f"{PACKED}, beat array<double>, need array<int>"
    extra = ("beat", "need")
    later_users = cut_lineage(
        _named(packed(grouped.sortWithinPartitions("need", "id"), user_block, schema, extra), "user")
    )
    needed = F.slice(F.lit(numbers), F.lit(2), F.array_max("need") - 1)
    last = later_users.agg(F.max(F.array_max("need"))).first()[0] or 1
    others = item_blocks.filter(F.col("item_block").isin(numbers[1:last]))
    # A block of products goes to a few tasks, each with a share of its customers.
    lanes = F.explode(F.sequence(F.lit(0), F.lit(LANES - 1)))
    later_pairs = (
        _meeting(later_users, needed, known, others)
        .withColumn("lane", F.pmod(F.xxhash64("user_block"), F.lit(LANES)).cast("int"))
        # Blocks are large rows, which a sort would spill.
        .join(others.withColumn("lane", lanes).hint("shuffle_hash"), ["item_block", "lane"])
    )
    found = (
        open_.select(F.col("id").alias("user_idx"), F.explode(zipped).alias("x"))
        .select("user_idx", "x.item_idx", "x.score")
        .union(later_lists(later_pairs, k))
    )

    order = Window.partitionBy("user_idx").orderBy(F.desc("score"), "item_idx")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    sizes = (F.size("user_ids").alias("users"), F.size("item_ids").alias("items"))
    return TopItems(
        done.union(ranked.select("user_idx", "item_idx", "rank", "score")),
        first_pairs.select(*sizes).union(later_pairs.select(*sizes)),
    )
