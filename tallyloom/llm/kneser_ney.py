"""Interpolated modified Kneser-Ney language model of word pairs.

Counting runs in Spark in two passes.  The first counts words and writes them
as sorted arrays of 64-bit word hashes; a word's number is its position there.
The second counts pairs under the key (number of the word before, number of the
word), sums them by shard and writes sorted key arrays with their counts, and
then the measures of every word as a context and as a continuation.  All files
lie in the shared folder and are memory-mapped by the workers that score.

Tasks add up their own counts before the shuffle.  A pair's shard follows the
range of its context; contexts that hold more than a shard's share of the
tokens are dealt by the whole pair instead, so that no shard gets a hot word.
A model holds up to 2^32 - 2 distinct words; beyond that training raises.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.arrays import (
    crc_remainder,
    local_path,
    mix64,
    row_slices,
    text_buffers,
    word_hashes,
)
from tallyloom.llm.shared import shared_folder, written

END = mix64(np.array([0x454E44], np.uint64))[0]
TASK_LIMIT = 6_000_000
LOW = np.uint64(0xFFFFFFFF)
BLOCK_SCHEMA = "shard int, keys binary, counts binary"


# Blocks of sorted keys with counts, as shuffled


def pack_block(keys: np.ndarray) -> bytes:
    """Bytes of equal weight together, which the shuffle's compression shortens."""
    return np.ascontiguousarray(keys.view(np.uint8).reshape(len(keys), -1).T).tobytes()


def unpack_block(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and their summed counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    joined, weights = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(joined, kind="stable")
    joined, weights = joined[order], weights[order]
    heads = np.flatnonzero(np.concatenate([[True], joined[1:] != joined[:-1]])[: len(joined)])
    return joined[heads], np.add.reduceat(weights, heads) if len(heads) else weights


class TaskCounter:
    """Counts of one task; full tables are handed on before they grow further."""

    def __init__(self, shards_of):
        self.shards_of, self.keys, self.counts, self.held = shards_of, [], [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        found, n = np.unique(keys, return_counts=True)
        self.keys.append(found)
        self.counts.append(n)
        self.held += len(found)
        if self.held > TASK_LIMIT:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        keys, counts = add_up(self.keys, self.counts)
        self.keys, self.counts, self.held = [], [], 0
        if not len(keys):
            return
        shards = self.shards_of(keys)
        order = np.argsort(shards, kind="stable")
        found, first = np.unique(shards[order], return_index=True)
        for shard, part in zip(found, np.split(order, first[1:]), strict=True):
            yield pa.record_batch(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([pack_block(keys[part])], pa.binary()),
                    pa.array([pack_block(counts[part].astype(np.uint64))], pa.binary()),
                ],
                ["shard", "keys", "counts"],
            )


def block_sums(blocks: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return add_up(
        [unpack_block(x, np.uint64) for x in blocks.column("keys").to_pylist()],
        [unpack_block(x, np.uint64).astype(np.int64) for x in blocks.column("counts").to_pylist()],
    )


# Files of the model


def save(path: str, array: np.ndarray) -> None:
    """Whole file or none: a task that is run again replaces it by the same content."""
    part = f"{path}.{os.getpid()}"
    with open(part, "wb") as file:
        np.save(file, array)
    os.replace(part, path)


def hash_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a hash; shards hold ascending ranges."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


@dataclass
class KneserNey:
    """A trained model: its folder, sizes and discounts.  Workers map its files."""

    folder: str
    shards: int
    bases: np.ndarray  # number of the first word of each shard, and the number of words
    tokens: int
    hot: np.ndarray  # contexts whose pairs are dealt by the whole pair
    pair_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    word_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    pair_types: int = 0
    word_types_mass: float = 1.0
    # Shards of each kind that have a file; a missing one is an error and not an empty shard.
    filled: dict[str, frozenset[int]] = field(default_factory=dict)

    def __getstate__(self):
        hidden = {"_files", "starts"}
        return {k: v for k, v in self.__dict__.items() if k not in hidden}

    @property
    def words(self) -> int:
        return int(self.bases[-1])

    @cached_property
    def _files(self) -> dict[str, np.ndarray]:
        return {}

    def mapped(self, name: str, shard: int) -> np.ndarray:
        key = f"{name}-{shard:06d}.npy"
        if key not in self._files:
            there = shard in self.filled[name]
            path = f"{self.folder}/{key}"
            self._files[key] = np.load(path, mmap_mode="r") if there else np.zeros(0, np.uint64)
        return self._files[key]

    def word_numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1 if unknown) and counts of sorted word hashes."""
        numbers, counts = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        for shard, a, b in runs(hash_shard(hashes, self.shards)):
            keys = self.mapped("words", shard)
            at, hit = find(keys, hashes[a:b])
            numbers[a:b][hit] = at[hit] + self.bases[shard]
            counts[a:b][hit] = self.mapped("word-counts", shard)[at[hit]]
        return numbers, counts

    def pair_shard(self, keys: np.ndarray) -> np.ndarray:
        context = keys >> np.uint64(32)
        by_range = (context * np.uint64(self.shards) // np.uint64(self.words + 1)).astype(np.int64)
        if not len(self.hot):
            return by_range
        return np.where(np.isin(context, self.hot), hash_shard(mix64(keys), self.shards), by_range)

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of pairs; keys are sorted."""
        counts = np.zeros(len(keys), np.int64)
        shards = self.pair_shard(keys)
        order = np.argsort(shards, kind="stable")
        for shard, a, b in runs(shards[order]):
            own = order[a:b]
            at, hit = find(self.mapped("pairs", shard), keys[own])
            counts[own[hit]] = self.mapped("pair-counts", shard)[at[hit]]
        return counts

    def measures(self, numbers: np.ndarray) -> np.ndarray:
        """(total, backoff weight, continuations) of words by sorted number."""
        out = np.zeros((len(numbers), 3))
        for shard, a, b in runs(numbers * self.shards // (self.words + 1)):
            lowest = -(-shard * (self.words + 1) // self.shards)
            there = self.mapped("measures", shard)
            if len(there):
                out[a:b] = there[numbers[a:b] - lowest]
        return out

    def lower_probability(self, continuations: np.ndarray) -> np.ndarray:
        """Probability by the number of different words before; 0 stands for unknown words."""
        if not self.pair_types:
            return np.full(len(continuations), 1.0 / (self.words + 1))
        kept = np.maximum(continuations - discount(continuations, self.word_discounts), 0)
        return kept / self.pair_types + self.word_types_mass / (self.words + 1)


def runs(shards: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, first, end) of each run of equal numbers."""
    if not len(shards):
        return
    heads = np.flatnonzero(np.concatenate([[True], np.diff(shards) != 0]))
    for a, b in zip(heads, np.append(heads[1:], len(shards)), strict=True):
        yield int(shards[a]), int(a), int(b)


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a sorted array and whether the key is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def discount(counts: np.ndarray, steps: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *steps])[np.minimum(counts, 3).astype(np.int64)]


def modified_discounts(n: list[int]) -> tuple[float, float, float]:
    """Discounts for counts 1, 2 and 3 or more from the numbers of types with counts 1 to 4."""
    if not all(n):
        return (0.5, 1.0, 1.5)
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
    return tuple(min(max(d, 0.05), k + 1 - 0.05) for k, d in enumerate(raw))


# Training


def training_words(
    batches: Iterable[pa.RecordBatch], modulus: int, held_out: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes and row offsets of the slices' training rows."""
    for batch in batches:
        keep = crc_remainder(batch.column(0), modulus) != held_out
        data, offsets = text_buffers(batch.column(1).filter(pa.array(keep)))
        for a, b in row_slices(offsets):
            begin, end = offsets[a], offsets[b]
            yield word_hashes(data[begin:end], offsets[a : b + 1] - begin)


def train(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    modulus: int = 7,
    held_out: int = 2,
) -> KneserNey:
    """Train on all rows whose crc32(doc_id as text) mod `modulus` is not `held_out`.

    Rows with a null id are training rows; a null text is empty.  An empty
    table gives a model that knows no word.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shards = max(48, 2 * rows.rdd.getNumPartitions())
    target = local_path(shared_folder(spark, "kneser-ney"))
    os.makedirs(target)

    def count_words(batches):
        counter = TaskCounter(lambda keys: hash_shard(keys, shards))
        for words, offsets in training_words(batches, modulus, held_out):
            if len(offsets) > 1:
                yield from counter.add(np.insert(words, offsets[1:], END))
        yield from counter.flush()

    def write_words(key: tuple[pa.Scalar, ...], blocks: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        words, counts = block_sums(blocks)
        save(f"{target}/words-{shard:06d}.npy", words)
        save(f"{target}/word-counts-{shard:06d}.npy", counts)
        return pa.table({"shard": [shard], "n": [len(words)], "total": [int(counts.sum())]})

    sizes = (
        rows.mapInArrow(count_words, BLOCK_SCHEMA)
        .groupBy("shard")
        .applyInArrow(write_words, "shard long, n long, total long")
        .collect()
    )
    per_shard = np.zeros(shards, np.int64)
    per_shard[[r["shard"] for r in sizes]] = [r["n"] for r in sizes]
    model = KneserNey(
        target,
        shards,
        np.concatenate([[0], np.cumsum(per_shard)]),
        sum(r["total"] for r in sizes),
        np.zeros(0, np.uint64),
    )
    if model.words >= 1 << 32:
        raise ValueError("more distinct words than 32-bit word numbers")
    model.filled = dict.fromkeys(("words", "word-counts"), frozenset(r["shard"] for r in sizes))
    model.hot = hot_contexts(spark, model, [r["shard"] for r in sizes])
    return add_pairs(rows, model, modulus, held_out)


def hot_contexts(spark, model: KneserNey, shards: list[int]) -> np.ndarray:
    """Words with more than a shard's share of all tokens (fewer than there are shards)."""
    if not shards:
        return model.hot
    least = model.tokens / model.shards

    def search(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                at = np.flatnonzero(model.mapped("word-counts", shard) > least)
                yield pa.record_batch([pa.array(at + model.bases[shard])], ["number"])

    found = (
        spark.createDataFrame([(s,) for s in shards], "shard int")
        .mapInArrow(search, "number long")
        .collect()
    )
    return np.array([model.words, *(r["number"] for r in found)], np.uint64)


def pair_keys(numbers: np.ndarray, offsets: np.ndarray, start: int) -> np.ndarray:
    """Keys of all (word before, word) of rows that include their end; the start has its own number."""
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[offsets[:-1]] = start
    return before.astype(np.uint64) << np.uint64(32) | numbers.astype(np.uint64)


def with_ends(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(words, offsets[1:], END), offsets + np.arange(len(offsets))


STATS_SCHEMA = (
    "shard int, kind string, ids binary, a binary, b binary, n1 long, n2 long, n3 long, n4 long"
)


def add_pairs(rows: DataFrame, model: KneserNey, modulus: int, held_out: int) -> KneserNey:
    target, shards, words = model.folder, model.shards, model.words

    def count_pairs(batches):
        counter = TaskCounter(model.pair_shard)
        for found, offsets in training_words(batches, modulus, held_out):
            if len(offsets) > 1:
                tokens, offsets = with_ends(found, offsets)
                distinct, back = np.unique(tokens, return_inverse=True)
                numbers = model.word_numbers(distinct)[0][back]
                yield from counter.add(pair_keys(numbers, offsets, words))
        yield from counter.flush()

    def write_pairs(key: tuple[pa.Scalar, ...], blocks: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        pairs, counts = block_sums(blocks)
        save(f"{target}/pairs-{shard:06d}.npy", pairs)
        small = np.uint32 if not len(counts) or counts.max() < 1 << 32 else np.int64
        save(f"{target}/pair-counts-{shard:06d}.npy", counts.astype(small))
        types = np.bincount(np.minimum(counts, 5), minlength=6)[1:5]
        out = [(shard, "types", b"", b"", b"", *map(int, types))]
        contexts = (pairs >> np.uint64(32)).astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], np.diff(contexts) != 0])[: len(contexts)])
        if len(heads):
            totals = np.add.reduceat(counts, heads)
            # Numbers of followers seen once, twice and more often, in one integer each.
            followers = np.stack(
                [np.add.reduceat((np.minimum(counts, 3) == k).astype(np.int64), heads) for k in (1, 2, 3)]
            )
            ids = contexts[heads]
            out += stat_rows("context", ids, totals, followers, shards, words)
            after, before = np.unique(pairs & LOW, return_counts=True)
            out += stat_rows("follower", after.astype(np.int64), before, None, shards, words)
        return pa.Table.from_pylist(
            [dict(zip(STATS_NAMES, r, strict=True)) for r in out], schema=STATS_ARROW
        )

    stats = written(
        rows.mapInArrow(count_pairs, BLOCK_SCHEMA)
        .groupBy("shard")
        .applyInArrow(write_pairs, STATS_SCHEMA),
        "pair-stats",
    )
    # At most a few numbers for each shard.
    listed = stats.select("shard", (F.col("kind") == "types").alias("pairs")).distinct().collect()
    of_pairs, of_measures = (frozenset(r["shard"] for r in listed if r["pairs"] == p) for p in (True, False))
    model.filled = model.filled | {"pairs": of_pairs, "pair-counts": of_pairs, "measures": of_measures}
    types = [F.coalesce(F.sum(f"n{k}"), F.lit(0)) for k in range(1, 5)]
    model.pair_discounts = modified_discounts(
        list(stats.where("kind = 'types'").agg(*types).first())
    )

    def write_measures(key: tuple[pa.Scalar, ...], blocks: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        lowest = -(-shard * (words + 1) // shards)
        size = -(-(shard + 1) * (words + 1) // shards) - lowest
        out, many = np.zeros((size, 3)), np.zeros((3, size))
        for row in blocks.select(["kind", "ids", "a", "b"]).to_pylist():
            ids = unpack_block(row["ids"], np.uint32).astype(np.int64)
            column = 0 if row["kind"] == "context" else 2
            np.add.at(out[:, column], ids, unpack_block(row["a"], np.uint64).astype(float))
            if row["kind"] == "context":
                many[:, ids] += unpack_block(row["b"], np.uint32).reshape(3, -1)
        mass = np.array(model.pair_discounts) @ many
        out[:, 1] = np.divide(mass, out[:, 0], out=np.ones(size), where=out[:, 0] > 0)
        save(f"{target}/measures-{shard:06d}.npy", out)
        types = np.bincount(np.minimum(out[:, 2], 5).astype(np.int64), minlength=6)
        return pa.table(
            {f"n{k}": [int(types[k])] for k in range(1, 5)}
            | {"more": [int(types[5])], "total": [int(out[:, 2].sum())]}
        )

    sums = (
        stats.where("kind <> 'types'")
        .groupBy("shard")
        .applyInArrow(
            write_measures, "n1 long, n2 long, n3 long, n4 long, more long, total long"
        )
        .agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n1", "n2", "n3", "n4", "more", "total")))
        .first()
    )
    model.word_discounts = d = modified_discounts(list(sums[:4]))
    model.pair_types = sums[5]
    if model.pair_types:
        mass = d[0] * sums[0] + d[1] * sums[1] + d[2] * (sums[2] + sums[3] + sums[4])
        model.word_types_mass = mass / model.pair_types
    return model


STATS_NAMES = ("shard", "kind", "ids", "a", "b", "n1", "n2", "n3", "n4")
STATS_ARROW = pa.schema(
    [("shard", pa.int32()), ("kind", pa.string())]
    + [(k, pa.binary()) for k in ("ids", "a", "b")]
    + [(f"n{k}", pa.int64()) for k in range(1, 5)]
)


def stat_rows(kind, ids, totals, followers, shards: int, words: int) -> list[tuple]:
    """One row for each range of word numbers; ids count from the range's first number."""
    rows = []
    for shard, a, b in runs(ids * shards // (words + 1)):
        own = (ids[a:b] - -(-shard * (words + 1) // shards)).astype(np.uint32)
        extra = b"" if followers is None else pack_block(followers[:, a:b].astype(np.uint32).reshape(-1))
        a_sum = pack_block(totals[a:b].astype(np.uint64))
        rows.append((shard, kind, pack_block(own), a_sum, extra, 0, 0, 0, 0))
    return rows


# Scoring


SCORE_FIELDS = (
    "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score_slice(model: KneserNey, words: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """n_tokens, n_known, base_score and score of every row of a slice."""
    tokens, offsets = with_ends(words, offsets)
    distinct, back = np.unique(tokens, return_inverse=True)
    numbers, counts = model.word_numbers(distinct)
    base = np.log10((counts + 1) / (model.tokens + model.words + 1))
    known = numbers >= 0
    lower = np.empty(len(distinct))
    order = np.argsort(numbers)
    there = order[np.searchsorted(numbers[order], 0) :]
    found = model.measures(numbers[there])
    measures = np.zeros((len(distinct), 3))
    measures[there] = found
    lower = model.lower_probability(measures[:, 2])

    place = np.concatenate([[-1], back[:-1]])
    place[offsets[:-1]] = -1
    begin = model.measures(np.array([model.words]))[0]
    total = np.where(place >= 0, measures[place, 0], begin[0])
    weight = np.where(place >= 0, measures[place, 1], begin[1])
    context = np.where(place >= 0, numbers[place], model.words)
    own = numbers[back]
    usable = np.flatnonzero((context >= 0) & (own >= 0) & (total > 0))
    keys = context[usable].astype(np.uint64) << np.uint64(32) | own[usable].astype(np.uint64)
    pairs, again = np.unique(keys, return_inverse=True)
    seen = model.pair_counts(pairs)
    kept = np.maximum(seen - discount(seen, model.pair_discounts), 0)[again]
    probability = lower[back]
    followed = (context >= 0) & (total > 0)
    probability[followed] *= weight[followed]
    probability[usable] += kept / total[usable]
    logs = np.log10(probability)
    heads = offsets[:-1]
    return [
        np.diff(offsets),
        np.add.reduceat(known[back].astype(np.int64), heads),
        np.add.reduceat(base[back], heads),
        np.add.reduceat(logs, heads),
    ]


def score(
    docs: DataFrame,
    model: KneserNey,
    doc_id: str = "doc_id",
    text: str = "text",
    modulus: int = 7,
    held_out: int = 2,
) -> DataFrame:
    """log10 probability of every text, its end included, and its perplexity's parts.

    A null or empty text is its end alone.  Unknown words get the model's
    uniform share.  Repeated rows are scored alike; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            out = crc_remainder(batch.column(0), modulus) == held_out
            for a, b in row_slices(offsets):
                begin = offsets[a]
                words, at = word_hashes(data[begin : offsets[b]], offsets[a : b + 1] - begin)
                n, known, base, logs = score_slice(shared.value, words, at)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(a, b - a),
                        *map(pa.array, (out[a:b], n, known)),
                        pa.array(np.full(b - a, shared.value.tokens)),
                        pa.array(base),
                        pa.array(logs),
                    ],
                    ["doc_id", *(f.split()[0] for f in SCORE_FIELDS.split(", "))],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {SCORE_FIELDS}")
