"""Ranked lexical search by bag deduplication.

Documents are cut down to the terms of the items.  What is left of a document
is its bag: (term, count) for every item term it holds, and its length class m.
Documents with equal bags and equal m score alike, so they are one class: they
meet by a hash of both, and the grouping compares the bags themselves.  Every
class is scored once against the items, and the best classes of an item are
expanded to their members by ascending doc_id.

Only the k members with the smallest doc_id of a class can appear in any
result, and a task passes on at most so many of each class, however many
documents are copies.  Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.arrays import row_slices, text_buffers, word_hashes
from tallyloom.llm.shared import bounded_batches, written

# Terms are runs of letters, digits and everything beyond ASCII.
TERM_BYTES = np.zeros(256, np.uint8)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    TERM_BYTES[_first : _last + 1] = 1
# Bytes of item texts that one pass over the documents looks for.
BLOCK_BYTES = 16 << 20
# Class and item scores that a task holds at once.
SCORES = 1 << 22
BAG = np.dtype([("term", "<u4"), ("tf", "<u4")])
FILTER_BITS = 20


class Terms:
    """The sorted term hashes of a block of items, and which items hold each term."""

    def __init__(self, texts: list[str]):
        data, offsets = text_buffers(pa.array(texts, pa.large_string()))
        hashes, at = word_hashes(data, offsets, TERM_BYTES)
        item = np.repeat(np.arange(len(at) - 1), np.diff(at))
        self.items = len(texts)
        self.hashes, term = np.unique(hashes, return_inverse=True)
        pairs = np.unique(term.astype(np.int64) * self.items + item)
        self.item = pairs % self.items
        self.starts = np.searchsorted(pairs // self.items, np.arange(len(self.hashes) + 1))
        # Most words of a document fail a look at a few bits of their hash.
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self.hashes >> np.uint64(64 - FILTER_BITS)] = True

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, term number) of the hashes that are terms."""
        place = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - FILTER_BITS)])
        wanted = hashes[place]
        term = np.searchsorted(self.hashes, wanted)
        term[term == len(self.hashes)] = 0
        good = self.hashes[term] == wanted
        return place[good], term[good]


def bags_of(batch_text: pa.Array, terms: Terms) -> tuple[np.ndarray, pa.Array]:
    """Number of terms of every text, and its bag as bytes."""
    data, offsets = text_buffers(batch_text)
    sizes, counted, lengths = [], [], []
    for a, b in row_slices(offsets):
        begin = offsets[a]
        hashes, at = word_hashes(data[begin : offsets[b]], offsets[a : b + 1] - begin, TERM_BYTES)
        sizes.append(np.diff(at))
        if not len(terms):
            lengths.append(np.zeros(b - a, np.int64))
            continue
        place, term = terms.find(hashes)
        row = np.searchsorted(at, place, side="right") - 1
        keys, tf = np.unique(row * len(terms) + term, return_counts=True)
        bag = np.empty(len(keys), BAG)
        bag["term"], bag["tf"] = keys % len(terms), tf
        counted.append(bag)
        lengths.append(np.bincount(keys // len(terms), minlength=b - a))
    if not sizes:
        return np.zeros(0, np.int64), pa.array([], pa.large_binary())
    ends = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]) * BAG.itemsize
    pool = np.concatenate(counted) if counted else np.zeros(0, BAG)
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(pool.tobytes())]
    return np.concatenate(sizes), pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, buffers)


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a column of bags, and the row of each."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(BAG), np.repeat(np.arange(len(column)), np.diff(at) // BAG.itemsize)


def bags(docs: DataFrame, terms) -> DataFrame:
    """(doc_id, n, bag) of every document; `terms` is a broadcast Terms."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, bag = bags_of(batch.column(1), terms.value)
            yield pa.record_batch(
                [batch.column(0), pa.array(n.astype(np.int64)), bag.cast(pa.binary())],
                ["doc_id", "n", "bag"],
            )

    return docs.mapInArrow(run, f"doc_id {docs.dtypes[0][1]}, n long, bag binary")


def document_frequencies(found: DataFrame, size: int) -> np.ndarray:
    """Number of documents that hold each term; every task hands on one sum for each."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            entries, _ = unpacked(batch.column(0))
            total += np.bincount(entries["term"], minlength=size)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], ["term", "df"])

    df = np.zeros(size, np.int64)
    if size:
        parts = found.select("bag").mapInArrow(count, "term long, df long")
        sums = parts.groupBy("term").agg(F.sum("df").alias("df")).toArrow()
        df[sums["term"].to_numpy()] = sums["df"].to_numpy()
    return df


def term_weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def classes(found: DataFrame, k: int, b: int, n: int, total: int) -> DataFrame:
    """(bag, m, members): each class once, with its k smallest doc_ids in order, nulls last."""
    wide = "decimal(20,0)"
    length = (F.lit(b * n).cast(wide) * F.col("n").cast(wide)).cast("decimal(38,0)")
    m = F.lit(100 - b) + F.expr("length div total")
    sized = found.where(F.length("bag") > 0).withColumn("length", length)
    sized = sized.withColumn("total", F.lit(max(total, 1)).cast(wide)).withColumn("m", m)
    sized = sized.select(F.xxhash64("bag", "m").alias("key"), "m", "bag", "doc_id")
    by_id = Window.partitionBy("key", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last())
    few = sized.withColumn("turn", F.row_number().over(by_id)).where(F.col("turn") <= k)
    listed = F.array_sort(F.collect_list(F.struct("turn", "doc_id")))
    return few.groupBy("key", "m", "bag").agg(listed.alias("members")).select(
        "bag", "m", F.transform("members", lambda x: x["doc_id"]).alias("members")
    )


def scored(found: DataFrame, terms, weights, k: int, id_type: str) -> DataFrame:
    """(item, score, members) of the k best classes of every item in each task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, w = terms.value, weights.value
        step = max(SCORES // t.items, 1)
        degree = np.diff(t.starts)
        best = None
        for batch in batches:
            first = batch.column(2)
            for a in range(0, len(batch), step):
                part = batch.slice(a, step)
                entries, row = unpacked(part.column(0))
                m = part.column(1).to_numpy()[row]
                term = entries["term"].astype(np.int64)
                tf = entries["tf"].astype(np.int64)
                gain = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                scores = np.zeros(len(part) * t.items, np.int64)
                # An entry adds to all items that hold its term, few entries at a time.
                ends = np.cumsum(degree[term])
                at = 0
                while at < len(term):
                    base = ends[at - 1] if at else 0
                    stop = max(at + 1, int(np.searchsorted(ends, base + SCORES, side="right")))
                    n = degree[term[at:stop]]
                    skip = np.repeat(np.cumsum(n) - n, n)
                    item = t.item[np.repeat(t.starts[term[at:stop]], n) + np.arange(n.sum()) - skip]
                    place = np.repeat(row[at:stop], n) * t.items + item
                    value = np.repeat(gain[at:stop], n)
                    # Sums in two halves: doubles add integers below 2^53 exactly.
                    for half, unit in ((value >> 24, 1 << 24), (value & 0xFFFFFF, 1)):
                        sums = np.bincount(place, half.astype(np.float64), len(scores))
                        scores += sums.astype(np.int64) * unit
                    at = stop
                hit = np.flatnonzero(scores)
                fresh = pa.table(
                    {
                        "item": pa.array(hit % t.items),
                        "score": pa.array(scores[hit]),
                        "members": first.slice(a, step).take(pa.array(hit // t.items)),
                    }
                )
                best = leading(fresh if best is None else pa.concat_tables([best, fresh]), k)
        if best is not None:
            yield from best.combine_chunks().to_batches()

    return found.select("bag", "m", "members").mapInArrow(
        run, f"item long, score long, members array<{id_type}>"
    )


def leading(table: pa.Table, k: int) -> pa.Table:
    """The k best rows of every item by score, then by the first member, null ones last."""
    first = table["members"].combine_chunks()
    if isinstance(first, pa.ChunkedArray):
        first = pa.concat_arrays(first.chunks) if first.num_chunks else pa.array([], table["members"].type)
    heads = first.flatten().take(pa.array(first.offsets.to_numpy()[:-1] - first.offsets.to_numpy()[0]))
    keyed = pa.table(
        {
            "item": table["item"],
            "score": table["score"],
            "head": heads,
            "row": pa.array(np.arange(len(table))),
        }
    ).sort_by([("item", "ascending"), ("score", "descending"), ("head", "ascending")])
    item = keyed["item"].to_numpy()
    turn = np.arange(len(item)) - np.searchsorted(item, item)
    return table.take(keyed["row"].filter(pa.array(turn < k)))


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    b: int = 90,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0.

    Terms are runs of ASCII letters and digits and of anything beyond ASCII, A-Z
    lower-cased.  With N documents that hold a term, L terms in all, and df
    documents that hold a term, the weight w of a term is
    floor(1000 ln((2 N + 2) / (2 df + 1))); a document of n terms has
    m = 100 - b + (b n N div L), and its score sums w (10^9 tf div (1000 tf + 8 m))
    over the item's terms, once each.  Equal scores rank by ascending doc_id.

    Items may be many: they are searched in blocks of about `block_bytes` bytes
    of text, and only a block's terms are broadcast.  Rows with one item id are one
    item that holds the terms of all of them; a null id is an item too.  Null
    and empty texts have no terms: such documents count nowhere and such items
    find nothing.  Every document row is a document of its own, so rows that
    repeat are ranked next to each other; a null doc_id ranks after others.
    Texts of any length count whole.  Other columns are left alone, whatever
    they are called.  Empty tables give no rows.
    """
    spark = bounded_batches(docs.sparkSession)
    asked = written(
        items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item_text"))
        .where(F.length("item_text") > 0)
        .distinct(),
        "items",
    )
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    size = asked.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))
    context = spark.sparkContext
    id_type = rows.dtypes[0][1]
    found_in = []
    for part in range(blocks):
        # At most about block_bytes of item texts come to the driver at a time.
        texts: dict = {}
        for row in asked.where(block == part).orderBy("item_id", "item_text").toLocalIterator():
            texts.setdefault(row["item_id"], []).append(row["item_text"])
        names = list(texts)
        if not names:
            continue
        terms = Terms([" ".join(texts[name]) for name in names])
        shared = context.broadcast(terms)
        found = written(bags(rows, shared), "bags")
        n, total = found.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        weights = context.broadcast(term_weights(n, document_frequencies(found, len(terms))))
        kinds = classes(found, k, b, n, total or 0)
        number = spark.createDataFrame(
            list(enumerate(names)), f"item long, item_id {asked.dtypes[0][1]}"
        )
        best = scored(kinds, shared, weights, k, id_type)
        best = best.select("item", "score", F.explode("members").alias("doc_id"))
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found_in.append(ranked.join(number, "item").select("item_id", "rank", "doc_id", "score"))
    if not found_in:
        schema = f"item_id {asked.dtypes[0][1]}, rank int, doc_id {id_type}, score long"
        return spark.createDataFrame([], schema)
    result = found_in[0]
    for more in found_in[1:]:
        result = result.union(more)
    return result


TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def oracle(k: int = 10, b: int = 90) -> str:
    """The same ranking of documents for the items of benchmark, as SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    terms = f"unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '{TERM_PATTERN}'))"
    return f"""
WITH words AS (SELECT doc_id, {terms} AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY ALL),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {terms} AS term FROM benchmark)),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, whole WHERE term IN (SELECT term FROM asked) GROUP BY term
),
scores AS (
  SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * ({100 - b} + ({b} * n * docs) // terms)))) AS BIGINT)
    AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id), whole
  GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
  doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {k}
"""
