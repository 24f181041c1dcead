"""Exact Jaccard self-join of word shingles with adaptive multi-match prefixes.

Documents with equal shingle sets form one node.  All shingles have one global
order: an estimate of how many documents hold them (a sketch of fixed size
counted over all documents), then their hash.  If two sets overlap enough, the
prefixes that leave out the last (overlap - l) shingles share at least l of
them.  Each node picks the l between 1 and `most_matches` with the lowest cost:
a longer prefix reads more lists, but a candidate needs l common shingles, of
which there are at most (entries read / l).

Entries of one shingle are joined if it is in few prefixes.  Prefix shingles
in more than `hot_list` prefixes link their nodes to one family without making
pairs.  Candidates and families are then verified in blocks: each block pair
compares its sets exactly and returns a spanning forest of its links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.arrays import chain64, row_slices, shingle_hashes, text_buffers, word_hashes
from tallyloom.llm.components import connected_components
from tallyloom.llm.shared import written

SKETCH_BITS = 20
SLICES = 64
FILTER_BITS = 23
BLOCK_NODES = 256
BUCKET_NODES = 1024
COLUMNS_AT_ONCE = 4096


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a shorter text is one shingle as a whole."""
    data, offsets = text_buffers(column)
    for a, b in row_slices(offsets):
        begin = offsets[a]
        words, at = word_hashes(data[begin : offsets[b]], offsets[a : b + 1] - begin)
        for k in range(b - a):
            own = words[at[k] : at[k + 1]]
            if len(own) >= size:
                yield np.unique(shingle_hashes(own, size))
            elif len(own):
                whole = own[:1] ^ np.uint64(len(own))
                for word in own[1:]:
                    whole = chain64(whole, np.array([word]))
                yield whole
            else:
                yield own


def node_of(shingles: np.ndarray) -> int:
    """Number of a shingle set: 64 bits of its digest."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def members_and_sketch(rows: DataFrame, size: int) -> DataFrame:
    """One row for every document, and the counters of each task's shingles in slices."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = ["doc_id", "n", "node", "slice", "counters"]
        ids = None
        for batch in batches:
            ids = batch.column(0)
            n, nodes = [], []
            for shingles in shingle_sets(batch.column(1), size):
                n.append(len(shingles))
                nodes.append(node_of(shingles) if len(shingles) else None)
                np.add.at(counters, shingles >> np.uint64(64 - SKETCH_BITS), np.uint32(1))
            empty = pa.nulls(len(batch))
            yield pa.record_batch(
                [
                    ids,
                    pa.array(n, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    empty.cast(pa.int32()),
                    empty.cast(pa.binary()),
                ],
                names,
            )
        if ids is not None:
            parts = [c.tobytes() for c in counters.reshape(SLICES, -1)]
            yield pa.record_batch(
                [
                    pa.nulls(SLICES, ids.type),
                    pa.nulls(SLICES, pa.int64()),
                    pa.nulls(SLICES, pa.int64()),
                    pa.array(range(SLICES), pa.int32()),
                    pa.array(parts, pa.binary()),
                ],
                names,
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n long, node long, slice int, counters binary")


def merged_sketch(parts: DataFrame) -> np.ndarray:
    """Sums of all tasks' counters; 2^SKETCH_BITS numbers for any input."""

    def add(key: tuple[pa.Scalar, ...], blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << SKETCH_BITS) // SLICES, np.int64)
        for block in blocks:
            for counters in block.column("counters").to_pylist():
                total += np.frombuffer(counters, np.uint32)
        yield pa.record_batch(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
            ["slice", "counters"],
        )

    sums = (
        parts.where("slice is not null")
        .select("slice", "counters")
        .groupBy("slice")
        .applyInArrow(add, "slice int, counters binary")
        .collect()
    )
    out = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), np.int64)
    for row in sums:
        out[row["slice"]] = np.frombuffer(row["counters"], np.int64)
    return out.reshape(-1)


def adaptive_prefix(
    shingles: np.ndarray, sketch: np.ndarray, usual: float, percent: int, most_matches: int
) -> tuple[np.ndarray, int, int]:
    """Shingles of the longest prefix in global order, of which `plain` make up the 1-prefix; l."""
    n = len(shingles)
    overlap = -(-percent * n // 100)
    plain = n - overlap + 1
    most = min(most_matches, overlap)
    frequency = sketch[shingles >> np.uint64(64 - SKETCH_BITS)]
    # Sets are in hash order already, so a stable sort leaves ties in that order.
    order = np.argsort(frequency, kind="stable")[: plain + most - 1]
    entries = 1 + np.cumsum(np.maximum(frequency[order] - usual, 0))[plain - 1 :]
    matches = np.arange(1, most + 1)
    chosen = int(np.argmin(entries * (1 + n / 8 / matches))) + 1
    return shingles[order], plain, chosen


def prefix_entries(
    rows: DataFrame, sketch: np.ndarray, size: int, percent: int, most_matches: int
) -> DataFrame:
    """(shingle, node, n, level, need): level l entries belong to prefixes of l or more matches."""
    shared = rows.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        usual = counts.mean() + 4 * counts.std()
        seen: set[int] = set()
        for batch in batches:
            found = []
            for shingles in shingle_sets(batch.column(1), size):
                if not len(shingles) or (node := node_of(shingles)) in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(node)
                tokens, plain, need = adaptive_prefix(
                    shingles, counts, usual, percent, most_matches
                )
                level = np.maximum(np.arange(len(tokens)) - plain + 2, 1)
                found.append((tokens, node, len(shingles), level, need))
            if found:
                sizes = [len(f[0]) for f in found]
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate([f[0] for f in found]).view(np.int64)),
                        pa.array(np.repeat([f[1] for f in found], sizes)),
                        pa.array(np.repeat([f[2] for f in found], sizes).astype(np.int32)),
                        pa.array(np.concatenate([f[3] for f in found]).astype(np.int16)),
                        pa.array(np.repeat([f[4] for f in found], sizes).astype(np.int16)),
                    ],
                    ["shingle", "node", "n", "level", "need"],
                )

    return rows.mapInArrow(run, "shingle long, node long, n int, level short, need short")


def candidate_edges(entries: DataFrame, percent: int, hot_list: int) -> DataFrame:
    """Pairs of nodes with enough common prefix shingles, and stars over hot shingles."""
    lists = entries.groupBy("shingle").agg(
        F.count("*").alias("length"), F.min("node").alias("hub")
    )
    sized = entries.join(lists, "shingle")
    stars = sized.where(F.col("length") > hot_list).select(
        F.col("node").alias("a"), F.col("hub").alias("b")
    )
    cold = sized.where(F.col("length") <= hot_list).select(
        "shingle", "node", "n", "level", "need"
    )
    probe = cold.where("level <= need").select(
        "shingle", F.col("node").alias("a"), F.col("n").alias("an"), F.col("need").alias("needed")
    )
    index = cold.select(
        "shingle", F.col("node").alias("b"), F.col("n").alias("bn"), F.col("level").alias("at")
    )
    smaller = (F.col("bn") < F.col("an")) | (
        (F.col("bn") == F.col("an")) & (F.col("b") < F.col("a"))
    )
    pairs = (
        probe.join(index, "shingle")
        .where(smaller & (F.col("at") <= F.col("needed")))
        .where(F.col("bn") * 100 >= F.col("an") * percent)
        .groupBy("a", "b")
        .agg(F.count("*").alias("matches"), F.first("needed").alias("needed"))
        .where("matches >= needed")
    )
    return pairs.select("a", "b").union(stars)


def node_filter(nodes: DataFrame) -> np.ndarray:
    """Bitmap of fixed size over the nodes' numbers; it may only let too many pass."""
    bits = F.shiftrightunsigned("node", 64 - FILTER_BITS) + 1
    maps = (
        nodes.select(
            F.bitmap_bucket_number(bits).alias("bucket"), F.bitmap_bit_position(bits).alias("bit")
        )
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in maps:
        part = np.frombuffer(bytes(row["bits"]), np.uint8)
        out[(row["bucket"] - 1) * len(part) :][: len(part)] = part
    return np.unpackbits(out, bitorder="little").astype(bool)


def node_sets(rows: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the given nodes, computed again from the texts.

    A node may come once from every task, and a few other nodes may pass.
    """
    passing = rows.sparkSession.sparkContext.broadcast(node_filter(nodes))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = passing.value, set()
        for batch in batches:
            found = {}
            for shingles in shingle_sets(batch.column(1), size):
                if len(shingles) and (node := node_of(shingles)) not in seen:
                    if wanted[(node & (1 << 64) - 1) >> (64 - FILTER_BITS)]:
                        found[node] = shingles.tobytes()
                        if len(seen) < 1_000_000:
                            seen.add(node)
            yield pa.record_batch(
                [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())],
                ["node", "shingles"],
            )

    return rows.mapInArrow(run, "node long, shingles binary")


def links_of_block(nodes: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Smallest node linked to each node of a block, directly or over others."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
    many = np.bincount(column) > 1
    shared = np.flatnonzero(many[column])
    number = np.cumsum(many) - 1
    overlap = np.zeros((len(sets), len(sets)), np.float32)
    order = shared[np.argsort(column[shared], kind="stable")]
    columns = number[column[order]]
    for low in range(0, int(many.sum()), COLUMNS_AT_ONCE):
        part = order[np.searchsorted(columns, low) : np.searchsorted(columns, low + COLUMNS_AT_ONCE)]
        matrix = np.zeros((len(sets), COLUMNS_AT_ONCE), np.float32)
        matrix[owner[part], number[column[part]] - low] = 1
        overlap += matrix @ matrix.T
    inter = overlap.astype(np.int64)
    linked = 100 * inter >= percent * (sizes[:, None] + sizes[None, :] - inter)
    labels = nodes.copy()
    while True:
        reach = np.where(linked, labels[None, :], np.iinfo(np.int64).max).min(axis=1)
        reach = np.minimum(labels, reach)
        if (reach == labels).all():
            return labels
        labels = reach


def verified_links(families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that span the same classes as all links between nodes of one family."""
    spark = families.sparkSession
    count = families.groupBy("root").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK_NODES).cast("int")
    placed = (
        families.join(count, "root")
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node",
            "root",
            F.least("own", "other").cast("int").alias("i"),
            F.greatest("own", "other").cast("int").alias("j"),
        )
    )
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, families.count() // BUCKET_NODES + 1)
    work = sets.join(placed, "node").withColumn(
        "bucket", F.pmod(F.xxhash64("root", "i", "j"), F.lit(buckets))
    )

    def compare(table: pa.Table) -> pa.Table:
        node, root, i, j = (table.column(c).to_numpy() for c in ("node", "root", "i", "j"))
        order = np.lexsort((node, j, i, root))
        keys = np.stack([root[order], i[order], j[order], node[order]])
        # Copies of a set that several tasks have sent count once.
        once = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        order, keys = order[once], keys[:3, once]
        heads = np.flatnonzero(
            np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        )
        raw = table.column("shingles")
        left, right = [], []
        for own in np.split(order, heads[1:]):
            sets = [np.frombuffer(raw[int(k)].as_buffer(), np.uint64) for k in own]
            labels = links_of_block(node[own], sets, percent)
            moved = labels != node[own]
            left.append(node[own][moved])
            right.append(labels[moved])
        return pa.table({"a": np.concatenate(left), "b": np.concatenate(right)})

    return work.groupBy("bucket").applyInArrow(compare, "a long, b long")


def jaccard_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = 4,
    percent: int = 85,
    most_matches: int = 8,
    hot_list: int = 128,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Two rows link when 100 * intersection >= percent * union of their shingle
    sets; component_id is the smallest doc_id reachable.  Texts without words
    have an empty set and link with nothing: such a row's component is its own
    id.  A null id stays null, and repeated rows come back as often as given.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    texts = rows.select("doc_id", "text")
    first = written(members_and_sketch(texts, shingle_words), "shingle-members")
    members = first.where("slice is null").select("doc_id", "n", "node")
    sketch = merged_sketch(first)
    entries = prefix_entries(texts, sketch, shingle_words, percent, most_matches)
    by_shingle = Window.partitionBy("shingle")
    several = (
        entries.withColumn("low", F.min("node").over(by_shingle))
        .withColumn("high", F.max("node").over(by_shingle))
        .where("low <> high")
        .drop("low", "high")
        .dropDuplicates(["shingle", "node"])
    )
    candidates = candidate_edges(written(several, "prefix-entries"), percent, hot_list)
    families = written(connected_components(candidates), "families")
    sets = node_sets(texts, families.select("node"), shingle_words)
    links = verified_links(families, sets, percent)
    roots = connected_components(links)
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = (
        placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    )
    return placed.join(lowest, "root", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
