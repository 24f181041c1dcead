"""Best-two-fit packing of token sequences.

Only a piece's length matters for packing, and there are at most `capacity`
lengths.  So one small histogram is packed instead of the rows: each step fills
one bin greedily (longest document first), then replaces the bin's smallest
document by the two unpacked ones that fill the enlarged gap best, and repeats
the finished bin as often as the counts allow.  The steps become rank ranges
for every length; rows find their bin by their rank among equal lengths.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.bpe import encoded_batches
from tallyloom.llm.shared import written

RANK_BITS = 48


@dataclass(frozen=True)
class Runs:
    """Rank ranges of lengths and where they go, sorted by (length, first rank)."""

    keys: np.ndarray
    per_bin: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def pack_histogram(counts: dict[int, int], capacity: int) -> Runs:
    """Best-two-fit of all documents given as {length: count}; lengths are 1 to capacity."""
    left = {n: c for n, c in counts.items() if c}
    sizes = sorted(left)
    taken = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int]] = []
    sequence = 0
    while sizes:
        uses, room = _greedy(sizes, left, capacity)
        if room:
            _best_two(uses, room, sizes, left)
        repeats = min(left[n] // u for n, u in uses.items())
        offset = 0
        for n, u in sorted(uses.items(), reverse=True):
            rows.append(((n << RANK_BITS) + taken[n], u, sequence, offset))
            offset += n * u
            taken[n] += u * repeats
            left[n] -= u * repeats
            if not left[n]:
                del sizes[bisect_left(sizes, n)]
        sequence += repeats
    keys, per_bin, sequences, offsets = (
        np.array([r[k] for r in sorted(rows)], np.int64) for k in range(4)
    )
    return Runs(keys, per_bin, sequences, offsets)


def _greedy(sizes: list[int], left: dict[int, int], room: int) -> tuple[dict[int, int], int]:
    uses: dict[int, int] = {}
    at = len(sizes)
    while room and (at := bisect_right(sizes, room, hi=at) - 1) >= 0:
        n = sizes[at]
        uses[n] = min(room // n, left[n])
        room -= n * uses[n]
    return uses, room


def _best_two(uses: dict[int, int], room: int, sizes: list[int], left: dict[int, int]) -> None:
    """Replace the smallest document of the bin if two others fill its gap more tightly."""
    smallest = min(uses)
    gap = room + smallest
    open_ = np.array([n for n in sizes[: bisect_left(sizes, gap)] if left[n] > uses.get(n, 0)])
    if not len(open_):
        return
    places = np.searchsorted(open_, np.minimum(gap - open_, open_), side="right") - 1
    alone = [left[n] - uses.get(n, 0) < 2 for n in open_.tolist()]
    # A document that is the last of its length cannot be its own partner.
    places -= np.array(alone) & (open_[places] == open_) & (places >= 0)
    totals = np.where(places >= 0, open_ + open_[places], 0)
    best = int(np.argmax(totals))
    if totals[best] > smallest:
        uses[smallest] -= 1
        if not uses[smallest]:
            del uses[smallest]
        for n in (int(open_[best]), int(open_[places[best]])):
            uses[n] = uses.get(n, 0) + 1


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of at most `capacity` tokens of every document, its end id included.

    A null or empty text is the end id alone.  `part` and `place` number the
    pieces of each length within a task, so that the written table fixes ranks.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for rows, ids, offsets in encoded_batches(batches, vocabulary, 1):
            ids = np.insert(ids, offsets[1:], end_id).astype("<u4")
            offsets = offsets + np.arange(len(offsets))
            sizes = np.diff(offsets)
            n = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(sizes[row] - start, capacity)
            begin = offsets[row] + start
            crc = [zlib.crc32(ids[a : a + k]) for a, k in zip(begin, length, strict=True)]
            order = np.argsort(length, kind="stable")
            found, first = np.unique(length[order], return_index=True)
            place = np.empty(len(length), np.int64)
            many = np.diff(np.append(first, len(length)))
            place[order] = np.arange(len(length)) - np.repeat(first - seen[found], many)
            seen[found] += many
            columns = [
                rows.column(0).take(pa.array(row)),
                *(pa.array(x, pa.int32()) for x in (piece,)),
                *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                pa.array(np.full(len(row), part), pa.int32()),
                pa.array(place),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]
            if keep_ids:
                ends = np.append(begin, begin[-1:] + length[-1:])
                columns.append(
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                )
                names.append("ids")
            yield pa.record_batch(columns, names)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, place long"
    )
    return rows.mapInArrow(run, schema + (", ids array<int>" if keep_ids else ""))


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 4096,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Pack every document into sequences of at most `capacity` tokens.

    Returns (doc_id, piece, start, length, ids_crc32, sequence_id, offset), and
    the ids of each piece if asked for.  Longer documents are cut into pieces of
    `capacity` tokens; the rest of such a document is packed like any other.
    Null ids and repeated rows are packed as rows of their own; an empty table
    gives no sequences.  Only the histogram of lengths (at most `capacity`
    rows) reaches the driver.
    """
    spark = docs.sparkSession
    pieces = written(
        token_pieces(docs, vocabulary, capacity, end_id, doc_id, text, keep_ids), "pieces"
    )
    by_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    runs = spark.sparkContext.broadcast(
        pack_histogram({r["length"]: r["n"] for r in counts}, capacity)
    )

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = runs.value
        for batch in batches:
            length, rank = (batch.column(k).to_numpy() for k in ("length", "rank"))
            key = (length << RANK_BITS) + rank
            run = np.searchsorted(plan.keys, key, side="right") - 1
            turn, slot = np.divmod(key - plan.keys[run], plan.per_bin[run])
            columns = {c: batch.column(c) for c in batch.schema.names if c != "rank"}
            columns["sequence_id"] = pa.array(plan.sequence[run] + turn)
            columns["offset"] = pa.array(plan.offset[run] + slot * length)
            yield pa.record_batch(list(columns.values()), list(columns))

    ranked = (
        pieces.join(bases.drop("n"), ["length", "part"])
        .withColumn("rank", F.col("base") + F.col("place"))
        .drop("base", "part", "place")
    )
    kinds = {f.name: f.dataType.simpleString() for f in ranked.schema if f.name != "rank"}
    schema = ", ".join(f"`{k}` {v}" for k, v in kinds.items())
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, `offset` long")
