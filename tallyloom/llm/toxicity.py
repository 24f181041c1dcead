"""Toxicity by a linear classifier over character n-grams with naive Bayes ratios.

A text is the set of its character n-grams, hashed to a fixed number of buckets.
Labelled texts give every bucket a naive Bayes log-count ratio: the log of the
share of toxic texts that hold it over the share of other texts that do.
Buckets whose two shares differ significantly are the features; a feature's
value is its ratio, or 0 where the text lacks it.  Logistic regression with a
quadratic penalty weighs them, and its probability is the score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.arrays import row_slices, text_buffers
from tallyloom.llm.shared import bounded_batches, written

SIZES = (4, 5, 6)
BUCKET_BITS = 22
SLICE_BITS = 6
TRAIN_ROWS = 30_000
SLICE_BYTES = 1 << 19
FEATURES = 1 << 14
SIGNIFICANT = 3.0
PENALTY = 1e-4
ITERATIONS = 30

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32
_BASE = np.uint64(0xD1342543DE82EF95)
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class ToxicityModel:
    """Buckets in ascending order, the weight of a text that holds each, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, A-Z and spaces folded, and the texts' offsets into them."""
    folded = _FOLD[data].tobytes()
    try:
        codes = np.frombuffer(folded.decode().encode("utf-32-le"), np.uint32)
        starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return codes, starts[offsets]
    except UnicodeDecodeError:  # bytes that are no UTF-8 become replacement characters
        texts = [
            folded[a:b].decode(errors="replace").encode("utf-32-le")
            for a, b in zip(offsets[:-1], offsets[1:], strict=True)
        ]
        sizes = np.cumsum([0] + [len(t) // 4 for t in texts])
        return np.frombuffer(b"".join(texts), np.uint32), sizes


def gram_buckets(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(size, bucket of the n-gram of that size at every place) over the joined texts."""
    hashes = codes.astype(np.uint64)
    for size in range(2, max(SIZES) + 1):
        if len(codes) < size:
            return
        hashes = hashes[:-1] * _BASE + codes[size - 1 :]
        if size in SIZES:
            yield size, (hashes * _ODD) >> np.uint64(64 - BUCKET_BITS)


def held(column: pa.Array, wanted: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row, bucket) for the distinct buckets of every text, slice by slice.

    `wanted` marks the buckets of interest; without it all are given.
    """
    data, offsets = text_buffers(column)
    for a, b in row_slices(offsets, SLICE_BYTES):
        begin = offsets[a]
        codes, at = code_points(data[begin : offsets[b]], offsets[a : b + 1] - begin)
        found = [np.zeros(0, np.uint64)]
        for size, buckets in gram_buckets(codes):
            place = np.arange(len(buckets)) if wanted is None else np.flatnonzero(wanted[buckets])
            row = np.searchsorted(at, place, side="right") - 1
            inside = place + size <= at[row + 1]
            found.append(row[inside].astype(np.uint64) << np.uint64(BUCKET_BITS) | buckets[place[inside]])
        both = np.unique(np.concatenate(found))
        yield (
            a,
            b,
            (both >> np.uint64(BUCKET_BITS)).astype(np.int64),
            (both & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64),
        )


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """Numbers of clean and of toxic texts that hold each bucket, from (toxic int, text)."""
    width = 1 << (BUCKET_BITS - SLICE_BITS)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BUCKET_BITS), np.int32)
        for batch in batches:
            toxic = batch.column(0).to_numpy()
            for a, _, row, bucket in held(batch.column(1)):
                for kind in (0, 1):
                    np.add.at(total[kind], bucket[toxic[a + row] == kind], 1)
        for part in range(1 << SLICE_BITS):
            slice_ = total[:, part * width : (part + 1) * width]
            used = np.flatnonzero(slice_.any(axis=0))
            if len(used):
                columns = [part, used.astype(np.uint16).tobytes(), *(s[used].tobytes() for s in slice_)]
                types = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.record_batch(
                    [pa.array([c], t) for c, t in zip(columns, types, strict=True)],
                    ["part", "used", "clean", "toxic"],
                )

    def add(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width), np.int32)
        for part in parts:
            for k in range(len(part)):
                used = np.frombuffer(part.column(1)[k].as_py(), np.uint16)
                for kind in (0, 1):
                    total[kind, used] += np.frombuffer(part.column(2 + kind)[k].as_py(), np.int32)
        yield pa.record_batch(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
            ["part", "sums"],
        )

    parts = rows.mapInArrow(count, "part int, used binary, clean binary, toxic binary")
    out = np.zeros((2, 1 << BUCKET_BITS), np.int32)
    for row in parts.groupBy("part").applyInArrow(add, "part int, sums binary").collect():
        sums = np.frombuffer(row["sums"], np.int32).reshape(2, width)
        out[:, row["part"] * width : (row["part"] + 1) * width] = sums
    return out


def log_count_ratios(
    clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int
) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed naive Bayes log ratio of every bucket, and how many deviations its shares are apart."""
    ratio = np.log((toxic + 1) / (n_toxic + 2)) - np.log((clean + 1) / (n_clean + 2))
    share = (clean + toxic) / (n_clean + n_toxic)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n_clean + 1 / n_toxic))
    return ratio, np.abs(toxic / n_toxic - clean / n_clean) / spread


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    train_rows: int = TRAIN_ROWS,
    features: int = FEATURES,
) -> ToxicityModel:
    """A model of `labels` (doc_id, toxic) on the texts of `docs`.

    It is fitted on about `train_rows` labelled rows at most, drawn by their
    ids' hash, with the `features` most significant n-gram buckets at most.  A null
    label says nothing; of several labels of a document the highest counts; rows
    that repeat count again.  Null texts have no n-grams.  Without labels of both
    kinds every text gets the smoothed share of toxic ones, 0.5 without any.
    """
    spark = bounded_batches(docs.sparkSession)
    label = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    label = label.where("label_id is not null and toxic in (0, 1)")
    label = label.groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    share = train_rows / max(label.count(), 1)
    if share < 1:
        drawn = F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) / (1 << 30)
        label = label.where(drawn < share)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # The sample of labels has about train_rows rows of two numbers.
    rows = rows.join(F.broadcast(label), F.col("doc_id") == F.col("label_id"))
    rows = written(rows.select("toxic", "text"), "labelled")
    n_clean, n_toxic = rows.agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)).first()
    none = np.zeros(0, np.int64), np.zeros(0)
    if not n_clean or not n_toxic:
        return ToxicityModel(*none, float(np.log((n_toxic + 1) / (n_clean + 1))))
    clean, toxic = bucket_counts(rows)
    ratio, apart = log_count_ratios(clean, toxic, n_clean, n_toxic)
    chosen = np.flatnonzero(apart >= SIGNIFICANT)
    order = np.lexsort((chosen, -apart[chosen]))[:features]
    chosen = np.sort(chosen[order])
    if not len(chosen):
        return ToxicityModel(*none, float(np.log((n_toxic + 1) / (n_clean + 1))))

    vectors = CountVectorizerModel.from_vocabulary(
        [str(c) for c in chosen], inputCol="held", outputCol="sets", binary=True, minTF=1.0
    )
    scale = ElementwiseProduct(
        scalingVec=Vectors.dense(ratio[chosen]), inputCol="sets", outputCol="features"
    )
    texts = scale.transform(vectors.transform(chosen_buckets(rows, chosen)))
    texts = texts.select("toxic", "features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = LogisticRegression(
            labelCol="toxic",
            regParam=PENALTY,
            standardization=False,
            maxIter=ITERATIONS,
        ).fit(texts)
    finally:
        texts.unpersist()
    weights = fitted.coefficients.toArray() * ratio[chosen]
    used = weights != 0
    return ToxicityModel(chosen[used], weights[used], float(fitted.intercept))


def marked(buckets: np.ndarray) -> np.ndarray:
    wanted = np.zeros(1 << BUCKET_BITS, bool)
    wanted[buckets] = True
    return wanted


def chosen_buckets(rows: DataFrame, chosen: np.ndarray) -> DataFrame:
    """(toxic, held array<string>): the chosen buckets that each text holds."""
    shared = rows.sparkSession.sparkContext.broadcast(chosen)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = marked(shared.value)
        for batch in batches:
            for a, b, row, bucket in held(batch.column(1), wanted):
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=b - a))])
                names = pa.array(bucket).cast(pa.string())
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), names)
                yield pa.record_batch([batch.column(0).slice(a, b - a), lists], ["toxic", "held"])

    return rows.mapInArrow(run, "toxic int, held array<string>")


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, the columns of `carry`, score) of every row: the probability of label 1.

    Only the text decides: equal texts score alike, and a null or empty one
    gets the score of a text without features.  Texts of any length count whole.
    Rows that repeat are scored again; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [doc_id, *carry]
    places = [f"column_{k}" for k in range(len(kept))]
    rows = docs.select(
        *(F.col(c).alias(p) for c, p in zip(kept, places, strict=True)), F.col(text).alias("text")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        wanted = marked(fitted.buckets)
        for batch in batches:
            for a, b, row, bucket in held(batch.column(len(kept)), wanted):
                weight = fitted.weights[np.searchsorted(fitted.buckets, bucket)]
                total = fitted.intercept + np.bincount(row, weight, minlength=b - a)
                score = 1 / (1 + np.exp(-np.clip(total, -700, 700)))
                part = batch.slice(a, b - a)
                yield pa.record_batch([*part.columns[:-1], pa.array(score)], [*places, "score"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:-1])
    scored = rows.mapInArrow(run, f"{schema}, score double")
    names = ["doc_id", *carry]
    return scored.select(*(F.col(p).alias(c) for p, c in zip(places, names, strict=True)), "score")
