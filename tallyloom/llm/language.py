"""Language identification with character models.

Every language gets an interpolated Kneser-Ney model of the characters of its
words, word ends included, with n-grams of up to four characters.  The n-grams
of all languages lie in one sorted hash array for each order, with one column
for each language.  A text's language is the one with the lowest cross-entropy
per character.  Models are fitted on a bounded sample of labelled rows, and so
is the calibration: how sharply a difference in cross-entropy decides, and the
cross-entropy above which a text is rejected as none of the languages.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.arrays import gather_ragged, mix64, row_slices, span_hashes, text_buffers
from tallyloom.llm.bpe import LETTER, character_classes

ORDER = 4
BEGIN, END, RARE = 1, 2, 3  # codes that no letter has
CODE_BITS = 16
SLICE_BYTES = 1 << 20
CACHE_BITS = 19
UNDETERMINED = "und"
LETTER_CODES = mix64(np.arange(1 << CODE_BITS, dtype=np.uint64) + np.uint64(0x4C4944))


def text_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letter codes of the lower-cased texts, spans of their words, n + 1 offsets into the words."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer(("\n".join(low) + "\n").encode("utf-32-le"), np.uint32)
    letter = character_classes()[codes] == LETTER
    edge = np.diff(np.concatenate([[0], letter.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sizes = np.fromiter(map(len, low), np.int64, len(low)) + 1
    rows = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    return np.where(codes < 1 << CODE_BITS, codes, RARE).astype(np.int64), starts, ends, rows


def word_grams(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Keys of the up-to-four-character windows that end at each character and word end.

    A key holds the characters in 16 bits each, the last one lowest; words begin
    with BEGIN, so that shorter windows show that they are whole.
    """
    sizes = ends - starts + 2
    out = np.full(int(sizes.sum()), END, np.uint64)
    heads = np.cumsum(sizes) - sizes
    out[heads] = BEGIN
    inner = np.ones(len(out), bool)
    inner[heads] = inner[heads + sizes - 1] = False
    out[inner] = gather_ragged(codes, starts, ends - starts)
    grams = out.copy()
    place = np.arange(len(out)) - np.repeat(heads, sizes)
    for back in range(1, ORDER):
        there = np.flatnonzero(place >= back)
        grams[there] |= out[there - back] << np.uint64(CODE_BITS * back)
    return grams[place > 0]


def lower(keys: np.ndarray, order: int) -> np.ndarray:
    """The last `order` characters of the windows."""
    return keys & np.uint64((1 << CODE_BITS * order) - 1)


@dataclass
class Table:
    """One order's n-grams or contexts: sorted hashes and a column for each language."""

    hashes: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Table:
        hashes = mix64(keys)
        order = np.argsort(hashes)
        return cls(hashes[order], values[order])

    def get(self, keys: np.ndarray, missing: float) -> np.ndarray:
        out = np.full((len(keys), self.values.shape[1]), missing, np.float32)
        if len(self.hashes):
            wanted = mix64(keys)
            at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
            hit = self.hashes[at] == wanted
            out[hit] = self.values[at[hit]]
        return out


@dataclass
class LanguageModels:
    languages: list[str]
    kept: list[Table] = field(default_factory=list)  # discounted probabilities by order
    backoff: list[Table] = field(default_factory=list)  # weight of the lower order by context
    floor: float = 1.0
    sharpness: float = 1.0
    limit: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_cache"}

    @property
    def cache(self) -> dict[str, np.ndarray]:
        if "_cache" not in self.__dict__:
            self.__dict__["_cache"] = {
                "keys": np.zeros(1 << CACHE_BITS, np.uint64),
                "logs": np.zeros((1 << CACHE_BITS, len(self.languages)), np.float32),
            }
        return self.__dict__["_cache"]

    def gram_logs(self, grams: np.ndarray) -> np.ndarray:
        """Natural logs of the last character's probability in every language."""
        p = np.full((len(grams), len(self.languages)), self.floor, np.float32)
        for order in range(1, ORDER + 1):
            keys = lower(grams, order)
            context = keys >> np.uint64(CODE_BITS)
            # A window that begins with its word has no longer form.
            whole = (keys >> np.uint64(CODE_BITS * (order - 1))) > 0
            longer = self.kept[order - 1].get(keys, 0)
            weight = self.backoff[order - 1].get(context, 1)
            p = np.where(whole[:, None], longer + weight * p, p)
        return np.log(p)

    def word_logs(self, codes, starts, ends) -> np.ndarray:
        """Log probability of every word in every language; each task keeps words it has met."""
        keys = span_hashes(LETTER_CODES[codes], starts, ends) | np.uint64(1)
        slots = (keys >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        cache = self.cache
        logs = cache["logs"][slots]
        missing = np.flatnonzero(cache["keys"][slots] != keys)
        if len(missing):
            new, first, back = np.unique(keys[missing], return_index=True, return_inverse=True)
            some = missing[first]
            grams = self.gram_logs(word_grams(codes, starts[some], ends[some]))
            sizes = ends[some] - starts[some] + 1
            sums = np.add.reduceat(grams, np.cumsum(sizes) - sizes, axis=0)
            logs[missing] = sums[back]
            cache["keys"][slots[some]] = new
            cache["logs"][slots[some]] = sums
        return logs

    def entropies_in_parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts that are large together."""
        parts, at = [], 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= SLICE_BYTES // 2):
                size += len(texts[stop])
                stop += 1
            parts.append(self.entropies(texts[at:stop]))
            at = stop
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character in every language, and characters, of every text."""
        codes, starts, ends, rows = text_words(texts)
        logs = self.word_logs(codes, starts, ends)
        sums = np.concatenate([np.zeros((1, logs.shape[1])), np.cumsum(logs, axis=0, dtype=float)])
        chars = np.concatenate([[0], np.cumsum(ends - starts + 1)])
        n = chars[rows[1:]] - chars[rows[:-1]]
        total = sums[rows[1:]] - sums[rows[:-1]]
        return -total / np.maximum(n, 1)[:, None], n


def fit(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> LanguageModels:
    """Interpolated Kneser-Ney models from each language's distinct top-order windows."""
    models = LanguageModels(sorted(counts))
    size = len(models.languages)
    letters = {int(k) for keys, _ in counts.values() for k in lower(keys, 1)}
    models.floor = 1.0 / (len(letters) + 1)
    per_order: list[list] = [[] for _ in range(ORDER)]
    for language, (keys, n) in sorted(counts.items()):
        column = models.languages.index(language)
        grams, weights = keys, n.astype(float)
        for order in range(ORDER, 0, -1):
            found, at = np.unique(lower(grams, order), return_inverse=True)
            full = (found >> np.uint64(CODE_BITS * (order - 1))) > 0
            sums = np.bincount(at, weights, len(found))
            per_order[order - 1].append((column, found[full], sums[full]))
            # Lower orders count different longer windows; one that begins a word keeps its count.
            begins = found >> np.uint64(CODE_BITS * (order - 1)) == np.uint64(BEGIN)
            shorter = ~full
            grams = np.concatenate([found[full & ~begins], found[shorter]])
            weights = np.concatenate([np.ones((full & ~begins).sum()), sums[shorter]])
    for order in range(1, ORDER + 1):
        parts = per_order[order - 1]
        keys = np.unique(np.concatenate([k for _, k, _ in parts]))
        contexts = np.unique(keys >> np.uint64(CODE_BITS))
        kept = np.zeros((len(keys), size), np.float32)
        weight = np.ones((len(contexts), size), np.float32)
        for column, own, n in parts:
            once, twice = (n == 1).sum(), (n == 2).sum()
            cut = once / (once + 2 * twice) if once and twice else 0.5
            context, at = np.unique(own >> np.uint64(CODE_BITS), return_inverse=True)
            total = np.bincount(at, n)
            kept[np.searchsorted(keys, own), column] = np.maximum(n - cut, 0) / total[at]
            weight[np.searchsorted(contexts, context), column] = (
                np.bincount(at, np.minimum(n, cut)) / total
            )
        models.kept.append(Table.of(keys, kept))
        models.backoff.append(Table.of(contexts, weight))
    return models


def calibrate(models: LanguageModels, rows: list[tuple[str, str]], reject_share: float) -> None:
    """Sharpness by the labelled rows' likelihood; limit that `reject_share` of them exceed."""
    models.limit = np.full(len(models.languages), np.inf)
    if not rows:
        return
    entropies, n = models.entropies_in_parts([t for _, t in rows])
    truth = np.array([models.languages.index(lang) for lang, _ in rows])
    used = n > 0
    entropies, truth = entropies[used], truth[used]
    if not len(truth):
        return
    gap = entropies - entropies.min(axis=1, keepdims=True)
    best = None
    for sharpness in np.geomspace(1, 64, 19):
        log_p = -sharpness * gap - np.log(np.exp(-sharpness * gap).sum(axis=1, keepdims=True))
        loss = -log_p[np.arange(len(truth)), truth].mean()
        if best is None or loss < best:
            best, models.sharpness = loss, float(sharpness)
    for k in range(len(models.languages)):
        own = entropies[truth == k, k]
        if len(own):
            models.limit[k] = np.quantile(own, 1 - reject_share) + 4 * own.std() + 0.1


def train_languages(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    rows_per_language: int = 3000,
    calibration_rows: int = 500,
    reject_share: float = 0.001,
) -> LanguageModels:
    """Fit models on at most about `rows_per_language` labelled rows of each language.

    Rows are drawn at random with a fixed seed; a language with fewer rows gives
    all of them.  The windows are counted in Spark; their distinct values, bounded
    by the sample, and `calibration_rows` texts of each language reach the driver.
    """
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    sizes = rows.groupBy("lang").count().collect()  # one row for each column of the model
    if not sizes:
        return LanguageModels([])
    known = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], r["count"])))
    drawn = rows.withColumn("draw", F.rand(17) * F.element_at(known, F.col("lang")))
    sample = drawn.where(F.col("draw") < rows_per_language).select("lang", "text")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for a, b in row_slices(text_buffers(batch.column(1))[1], SLICE_BYTES):
                part = batch.column(1).slice(a, b - a).to_pylist()
                for language in sorted(set(langs[a:b])):
                    own = [t for t, k in zip(part, langs[a:b], strict=True) if k == language]
                    codes, starts, ends, _ = text_words(own)
                    if len(starts):
                        keys, n = np.unique(word_grams(codes, starts, ends), return_counts=True)
                        yield pa.record_batch(
                            [
                                pa.array([language] * len(keys)),
                                pa.array(keys.view(np.int64)),
                                pa.array(n.astype(np.int64)),
                            ],
                            ["lang", "key", "n"],
                        )

    grams = (
        sample.mapInArrow(count, "lang string, key long, n long")
        .groupBy("lang", "key")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    langs = grams.column("lang").to_numpy()
    keys = grams.column("key").to_numpy().view(np.uint64)
    n = grams.column("n").to_numpy()
    models = fit({k: (keys[langs == k], n[langs == k]) for k in sorted(set(langs))})
    if models.languages:
        some = drawn.where(F.col("draw") < calibration_rows).select("lang", "text").collect()
        calibrate(models, [(r[0], r[1]) for r in some if r[0] in models.languages], reject_share)
    return models


def identify(
    docs: DataFrame, models: LanguageModels, text: str = "text"
) -> DataFrame:
    """The given columns, then lang_pred, score, cross_entropy and rejected of every row.

    `score` is the best language's share, from 0 to 1.  A null text or one
    without letters is `und` with score 0 and rejected, as is any text if no
    language was learned.  `rejected` also marks texts whose cross-entropy
    exceeds what the language's own texts reach; their best language is kept.
    Columns of the input must not have these four names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    at = docs.columns.index(text)
    names = [*docs.columns, "lang_pred", "score", "cross_entropy", "rejected"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        languages = np.array([*own.languages, UNDETERMINED], object)
        for batch in batches:
            for a, b in row_slices(text_buffers(batch.column(at))[1], SLICE_BYTES):
                part = batch.slice(a, b - a)
                texts = [t or "" for t in part.column(at).to_pylist()]
                best = np.full(b - a, -1)
                score, entropy = np.zeros(b - a), np.full(b - a, np.nan)
                rejected = np.ones(b - a, bool)
                if own.languages:
                    entropies, n = own.entropies(texts)
                    some = np.flatnonzero(n > 0)
                    found = entropies[some]
                    best[some] = found.argmin(axis=1)
                    entropy[some] = found.min(axis=1)
                    gap = found - found.min(axis=1, keepdims=True)
                    score[some] = 1 / np.exp(-own.sharpness * gap).sum(axis=1)
                    rejected[some] = entropy[some] > own.limit[best[some]]
                yield pa.record_batch(
                    [
                        *part.columns,
                        pa.array(languages[best].tolist(), pa.string()),
                        pa.array(score),
                        pa.array(entropy, from_pandas=True),
                        pa.array(rejected),
                    ],
                    names,
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(
        run, f"{schema}, lang_pred string, score double, cross_entropy double, rejected boolean"
    )
