"""Quality classifier by importance resampling.

Every text is a set of hashed n-grams: words and runs of punctuation, the first
bytes of longer ones, pairs of neighbouring tokens, and runs of one token or pair of tokens by their
length.  Each n-gram has two buckets.  Two generative models over the buckets are counted, from
the documents labelled as good (target) and from all documents (raw).  The log
importance weight of a text is the sum of log(target / raw) over its n-grams;
n-grams whose two rates differ by less than a factor of two, or not
significantly, say nothing, and a document counts as one over the estimated
number of its copies, exact and near: neither length nor copies add up.  Weights become log odds on the
labelled rows, and the sample is drawn without replacement by Gumbel top-k.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.arrays import (
    WORDS_AND_MARKS,
    chain64,
    mix64,
    row_slices,
    text_buffers,
    word_hashes,
)
from tallyloom.llm.shared import written

BUCKET_BITS = 20
SLICE_BITS = 7
SIGNIFICANT = 3.0
LEAST_RATIO = 0.7
WEIGHT_BINS = 400
WEIGHT_STEP = 0.25
BINS = 1024
FEW = 1000
COPY_BITS = 22
COPY_SHINGLE = 4
STEM_BYTES = 4
LONGEST_RUN = 8
REPEATED = mix64(np.arange(2 * (LONGEST_RUN + 1), dtype=np.uint64) + np.uint64(0x5245)).reshape(2, -1)


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first bucket, second bucket) of the distinct n-grams of every row."""
    tokens, at = word_hashes(data, offsets, WORDS_AND_MARKS)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    pairs = chain64(tokens[:-1], tokens[1:])
    within = row[1:] == row[:-1]
    runs = [np.zeros(0, np.uint64)]
    run_rows = [row[:0]]
    for lag in (1, 2):
        same = tokens[lag:] == tokens[:-lag]
        same &= row[lag:] == row[:-lag]
        ends = np.flatnonzero(same & ~np.append(same[1:], False))
        length = ends - np.maximum.accumulate(np.where(same, -1, np.arange(len(same))))[ends]
        runs.append(REPEATED[lag - 1, np.minimum(length, LONGEST_RUN)])
        run_rows.append(row[lag:][ends])
    stems, _ = word_hashes(data, offsets, WORDS_AND_MARKS, STEM_BYTES)
    longer = stems != tokens
    grams = np.concatenate([tokens, mix64(stems[longer]), pairs[within], *runs])
    grams >>= np.uint64(64 - 2 * BUCKET_BITS)
    rows = np.concatenate([row, row[longer], row[1:][within], *run_rows]).astype(np.uint64)
    both = np.unique(rows << np.uint64(2 * BUCKET_BITS) | grams)
    mask = np.uint64((1 << BUCKET_BITS) - 1)
    return (
        (both >> np.uint64(2 * BUCKET_BITS)).astype(np.int64),
        (both >> np.uint64(BUCKET_BITS) & mask).astype(np.int64),
        (both & mask).astype(np.int64) + (1 << BUCKET_BITS),
    )


def slice_features(column: pa.Array) -> Iterator[tuple]:
    data, offsets = text_buffers(column)
    for a, b in row_slices(offsets):
        begin = offsets[a]
        yield a, b, *text_features(data[begin : offsets[b]], offsets[a : b + 1] - begin)


def copy_keys(column: pa.Array) -> np.ndarray:
    """Smallest hash of each text's word shingles, which near copies mostly share."""
    data, offsets = text_buffers(column)
    found = []
    for a, b in row_slices(offsets):
        begin = offsets[a]
        words, at = word_hashes(data[begin : offsets[b]], offsets[a : b + 1] - begin)
        at = np.minimum(at, len(words))
        padded = np.concatenate([words, np.zeros(COPY_SHINGLE, np.uint64)])
        grams = padded[: len(words) + 1]
        for k in range(1, COPY_SHINGLE):
            # Shingles end with their text, so a short text has some of its own.
            end = np.arange(len(words) + 1) + k < np.append(np.repeat(at[1:], np.diff(at)), 0)
            grams = chain64(grams, np.where(end, padded[k : len(words) + 1 + k], np.uint64(0)))
        least = np.minimum.reduceat(grams, at[:-1])
        found.append(np.where(np.diff(at) > 0, least, np.uint64(0)))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def sliced_sums(texts: DataFrame, bits: int, values, kind: type) -> np.ndarray:
    """Sums over all tasks of 2^bits numbers; `values` adds a batch's numbers to an array."""
    size = 1 << (bits - SLICE_BITS)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, kind)
        some = False
        for batch in batches:
            some = some or len(batch) > 0
            values(batch, total)
        if some:
            parts = total.reshape(-1, size)
            used = [np.flatnonzero(part) for part in parts]
            yield pa.record_batch(
                [
                    pa.array(range(1 << SLICE_BITS), pa.int32()),
                    pa.array([u.astype(np.uint16).tobytes() for u in used], pa.binary()),
                    pa.array([p[u].tobytes() for p, u in zip(parts, used, strict=True)], pa.binary()),
                ],
                ["slice", "used", "sums"],
            )

    def add(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, kind)
        for part in parts:
            used, sums = (part.column(k).to_pylist() for k in ("used", "sums"))
            for u, x in zip(used, sums, strict=True):
                total[np.frombuffer(u, np.uint16)] += np.frombuffer(x, kind)
        yield pa.record_batch(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
            ["slice", "sums"],
        )

    # Every task hands on one table, so partitions are read several to a task.
    parts = texts.rdd.getNumPartitions()
    tasks = min(parts, max(texts.sparkSession.sparkContext.defaultParallelism, parts // 8))
    parts = texts.coalesce(max(tasks, 1)).mapInArrow(count, "slice int, used binary, sums binary")
    out = np.zeros((1 << SLICE_BITS, size), kind)
    for row in parts.groupBy("slice").applyInArrow(add, "slice int, sums binary").collect():
        out[row["slice"]] = np.frombuffer(row["sums"], kind)
    return out.reshape(-1)


def copy_sketch(texts: DataFrame) -> np.ndarray:
    """Numbers of documents by hashed copy key: a fixed size that only overestimates copies."""

    def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
        keys = copy_keys(batch.column(0))
        np.add.at(total, keys >> np.uint64(64 - COPY_BITS), np.uint32(1))

    return sliced_sums(texts, COPY_BITS, add, np.uint32)


def bucket_counts(rows: DataFrame, copies, target_ids) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Weighted documents that hold each bucket, among all and among the target, and their sums.

    `rows` has the text and then the id; sizes are the same for any input.
    """
    size = 2 << BUCKET_BITS

    def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
        keys = copy_keys(batch.column(0))
        weight = 1 / np.maximum(copies.value[keys >> np.uint64(64 - COPY_BITS)], 1)
        good = weight * np.isin(batch.column(1).fill_null(-1).to_numpy(), target_ids.value)
        for a, b, row, first, second in slice_features(batch.column(0)):
            hit = good[a + row] > 0
            for buckets in (first, second):
                total[:size] += np.bincount(buckets, weight[a + row], minlength=size)
                some = np.bincount(buckets[hit], good[a + row[hit]], minlength=size)
                total[2 * size : 3 * size] += some
        total[size] += weight.sum()
        total[3 * size] += good.sum()

    # The second and fourth quarter only hold the numbers of documents.
    sums = sliced_sums(rows, BUCKET_BITS + 3, add, np.float32)
    return sums[:size], sums[2 * size : 3 * size], float(sums[size]), float(sums[3 * size])


def log_ratios(target: np.ndarray, raw: np.ndarray, n_target: float, n_raw: float) -> np.ndarray:
    """log(target / raw) of every bucket; 0 where they do not differ clearly and significantly."""
    if not n_target or not n_raw:
        return np.zeros(len(raw), np.float32)
    expected = raw * (n_target / n_raw)
    surprise = (target - expected) / np.sqrt(expected + 1)
    ratio = np.log((target + 1) / (expected + 1))
    clear = (np.abs(surprise) >= SIGNIFICANT) & (np.abs(ratio) >= LEAST_RATIO)
    return np.where(clear, ratio, 0).astype(np.float32)


def calibrated(good: np.ndarray, bad: np.ndarray, middles: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the log odds by weight, from labelled counts in weight bins."""
    slope, intercept = 1.0, 0.0
    if not good.sum() or not bad.sum():
        return slope, 20.0 if good.sum() or not bad.sum() else -20.0
    total = good + bad
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * middles + intercept, -30, 30)))
        v = total * p * (1 - p)
        gradient = np.array([((good - total * p) * middles).sum(), (good - total * p).sum()])
        gradient -= 1e-2 * np.array([slope - 1, 0])
        hessian = np.array(
            [[(v * middles**2).sum() + 1e-2, (v * middles).sum()], [(v * middles).sum(), v.sum() + 1e-6]]
        )
        step = np.linalg.solve(hessian, gradient)
        step *= min(1, 2 / np.abs(step).max()) if np.abs(step).max() else 0
        slope, intercept = slope + step[0], intercept + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(np.clip(slope, 0.05, 10)), float(intercept)


def weighted(rows: DataFrame, ratios: np.ndarray) -> DataFrame:
    """The rows with log_weight; the text comes last and is dropped."""
    shared = rows.sparkSession.sparkContext.broadcast(ratios)
    kept = rows.columns[:-1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, row, *buckets in slice_features(batch.column(len(kept))):
                one, two = (shared.value[k] for k in buckets)
                # An n-gram counts as the milder of its two buckets says: collisions cancel.
                mild = np.where(np.abs(one) < np.abs(two), one, two) * (one * two > 0)
                weights = np.bincount(row, weights=mild, minlength=b - a)
                part = batch.slice(a, b - a)
                yield pa.record_batch(
                    [*part.columns[:-1], pa.array(weights)], [*kept, "log_weight"]
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(run, f"{schema}, log_weight double")


def kth_largest(keys: DataFrame, k: int) -> float:
    """Exact k-th largest key, by counting in ever smaller ranges."""
    if k <= 0:
        return float("inf")
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k >= n:
        return float("-inf")
    above = 0
    while True:
        inside = keys.where((F.col("key") >= low) & (F.col("key") <= high))
        width = (high - low) / BINS
        bins = F.least(F.floor((F.col("key") - low) / width), F.lit(BINS - 1)) if width else F.lit(0)
        counts = (
            inside.groupBy(bins.alias("bin"))
            .agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
            .orderBy(F.desc("bin"))
            .collect()
        )
        for row in counts:
            if above + row["n"] >= k:
                break
            above += row["n"]
        if row["low"] == row["high"]:
            return row["low"]
        if row["n"] <= FEW:
            rest = keys.where(F.col("key").between(row["low"], row["high"])).select("key").collect()
            return sorted((r["key"] for r in rest), reverse=True)[k - above - 1]
        low, high = row["low"], row["high"]


def importance_sample(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_rows: int = 20_000,
    share: float | None = None,
    temperature: float = 0.25,
    seed: int = 7,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Every row with (doc_id, log_weight, probability, key, kept), and `carry` as carry_0 and so on.

    `labels` has doc_id, quality and toxic; target rows have quality 1 and toxic
    0.  About `target_rows` of them, drawn by their ids' hash, fit the target
    model; all labelled rows calibrate it.  `kept` marks the k rows with
    the largest key, log odds over `temperature` plus Gumbel noise; k is the
    number of rows that are more likely target than not, or `share` of all.  A null or empty text has no n-grams
    and weight 0.  Noise depends on id and text, so equal rows go together;
    rows that tie at the cut are all kept.  Without labels every row is kept.
    """
    spark = docs.sparkSession
    label = labels.select(
        F.col("doc_id").alias("label_id"),
        ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("good"),
    )
    label = label.where("good is not null").groupBy("label_id").agg(F.min("good").alias("good"))
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        *(F.col(c).alias(f"carry_{k}") for k, c in enumerate(carry)),
        F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("draw"),
        F.col(text).alias("text"),
    )
    texts = docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("doc_id"))
    share_drawn = F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) / (1 << 30)
    many = label.where("good = 1").count()
    drawn = label.where(F.col("good") == 1).where(share_drawn * max(many, 1) < target_rows)
    ids = np.sort(drawn.select("label_id").toArrow().column(0).to_numpy().astype(np.int64))
    context = docs.sparkSession.sparkContext
    copies = context.broadcast(copy_sketch(texts.select("text")))
    raw, target, n_raw, n_target = bucket_counts(texts, copies, context.broadcast(ids))
    scored = written(weighted(base, log_ratios(target, raw, n_target, n_raw)), "weights")

    most = WEIGHT_BINS * WEIGHT_STEP / 2
    clipped = F.greatest(F.least("log_weight", F.lit(most)), F.lit(-most))
    bins = F.floor(clipped / WEIGHT_STEP)
    counts = (
        scored.join(label, scored["doc_id"] == label["label_id"])
        .groupBy(bins.alias("bin"), "good")
        .count()
        .collect()
    )
    tally = np.zeros((2, WEIGHT_BINS + 1))
    for row in counts:
        tally[row["good"], row["bin"] + WEIGHT_BINS // 2] += row["count"]
    middles = (np.arange(WEIGHT_BINS + 1) - WEIGHT_BINS // 2 + 0.5) * WEIGHT_STEP
    slope, intercept = calibrated(tally[1], tally[0], middles)

    uniform = ((F.col("draw") / F.lit(2.0**64)) + 0.5) * (1 - 1e-12) + 5e-13
    odds = F.lit(slope) * clipped + F.lit(intercept)
    keyed = (
        scored.withColumn("probability", 1 / (1 + F.exp(-odds)))
        .withColumn("key", odds / temperature - F.log(-F.log(uniform)))
        .drop("draw")
    )
    likely, n = keyed.agg(F.count_if(F.col("probability") >= 0.5), F.count("*")).first()
    k = round(share * n) if share is not None else likely
    cut = kth_largest(keyed.select("key"), k)
    return keyed.withColumn("kept", F.col("key") >= F.lit(cut))


def sampled_rows(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of the sample with exactly their own columns, whatever these are called."""
    drawn = importance_sample(docs, labels, carry=tuple(docs.columns), **options).where("kept")
    return drawn.select(*(F.col(f"carry_{k}").alias(c) for k, c in enumerate(docs.columns)))
