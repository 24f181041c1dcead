"""Spelling variants by blocked Gram matrices.

Two words are near if one inserted, deleted or replaced letter turns one into
the other.  Then the squared distance of their letter counts is at most two,
and their lengths differ by at most one.  Words lie in blocks of one length; a
NumPy product of two blocks' letter counts gives all squared distances at once,
and pairs at a distance of at most two are verified letter by letter.

So that products stay small however many words there are, letters are dealt to
a few groups, and a block holds the words with the same count in every group.
One edit moves a count from one group to another or adds to one group, so a
block meets itself, the blocks that such a move leads to, and those one letter
longer.  The number of groups grows with the logarithm of the number of words,
and a block of too many words is cut into parts that all meet.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.arrays import gather_ragged, row_slices, text_buffers
from tallyloom.llm.shared import bounded_batches, written

LEAST_LETTERS = 7
LEAST_COUNT = 2
DROP_EVERY = 31
RATIO = 10
PART_WORDS = 1024
# Letters beyond a to z share these dimensions; that only adds pairs to verify.
SHARED_DIMENSIONS = 6
CANDIDATES = 1 << 16
LONG_RUN = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
# U+00C0 to U+00FF are this byte and a continuation byte.
_LEAD = 0xC3


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_table()


def crc_of_spans(states: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of each span of bytes after a prefix whose crc32 is given."""
    out = np.empty(len(starts), np.uint32)
    far = lengths > LONG_RUN
    for k in np.flatnonzero(far):
        out[k] = zlib.crc32(data[starts[k] : starts[k] + lengths[k]].tobytes(), int(states[k]))
    order = np.flatnonzero(~far)
    order = order[np.argsort(-lengths[order], kind="stable")]
    size, at = lengths[order], starts[order]
    crc = states[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -k))  # spans longer than k bytes come first
        byte = data[at[:n] + k]
        crc[:n] = _CRC[(crc[:n] ^ byte) & np.uint32(0xFF)] ^ (crc[:n] >> np.uint32(8))
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def slice_words(
    data: np.ndarray, offsets: np.ndarray, ids: list[str | None], least: int, drop_every: int
) -> list[pa.Array]:
    """The words of a slice of texts: runs of letters, lower-cased, some without one letter."""
    lead = data == _LEAD
    letter = _ASCII_LETTER[data] | lead
    letter[1:] |= lead[:-1]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    last = letter.copy()
    last[:-1] &= ~letter[1:]
    edges = offsets[1:-1][(offsets[1:-1] < len(data)) & (offsets[1:-1] > 0)]
    first[edges] = letter[edges]
    last[edges - 1] = letter[edges - 1]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) + 1 - starts
    leads = np.concatenate([[0], np.cumsum(lead)])
    letters = lengths - (leads[starts + lengths] - leads[starts])
    kept = letters >= least
    starts, lengths, letters = starts[kept], lengths[kept], letters[kept]
    lower = _LOWER[data]
    row = np.searchsorted(offsets, starts, side="right") - 1
    known = np.array([i is not None for i in ids], bool)
    prefix = np.array([0 if i is None else zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
    h = crc_of_spans(prefix[row], lower, starts, lengths)
    hit = (h % np.uint32(drop_every) == 0) & known[row]
    shorter = []
    for k in np.flatnonzero(hit & (letters > least)):
        run = lower[starts[k] : starts[k] + lengths[k]].tobytes().decode()
        place = int(h[k]) % len(run)
        shorter.append(run[:place] + run[place + 1 :])
    starts, lengths = starts[~hit], lengths[~hit]
    pool = gather_ragged(lower, starts, lengths)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    whole = pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(pool.tobytes())]
    )
    return [whole, pa.array(shorter, pa.large_string())]


def count_words(
    docs: DataFrame, least: int = LEAST_LETTERS, drop_every: int = DROP_EVERY
) -> DataFrame:
    """(word, n) of the words in (doc_id string, text); batches count theirs before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = text_buffers(batch.column(1))
            found = []
            for a, b in row_slices(offsets):
                begin = offsets[a]
                found += slice_words(
                    data[begin : offsets[b]], offsets[a : b + 1] - begin, ids[a:b], least, drop_every
                )
            if found:
                counts = pc.value_counts(pa.chunked_array(found))
                yield pa.record_batch(
                    [counts.field("values").cast(pa.string()), counts.field("counts")], ["word", "n"]
                )

    parts = docs.mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def latin_bytes(words: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """One byte for each letter of all words, and the words' lengths."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    return np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw], np.int64)


def letter_counts(words: DataFrame) -> np.ndarray:
    """How often each of the 256 letters stands in all words together."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            total += np.bincount(latin_bytes(batch.column(0))[0], minlength=256)
        yield pa.record_batch([pa.array(np.arange(256)), pa.array(total)], ["letter", "n"])

    out = np.zeros(256, np.int64)
    sums = words.select("word").mapInArrow(count, "letter long, n long").groupBy("letter")
    for row in sums.agg(F.sum("n").alias("n")).collect():  # 256 rows
        out[row["letter"]] = row["n"]
    return out


def letter_groups(counts: np.ndarray, groups: int) -> np.ndarray:
    """The group of each letter: dealt in turns, there and back, from the commonest letter on."""
    turn = np.empty(256, np.int64)
    turn[np.argsort(-counts, kind="stable")] = np.arange(256) % (2 * groups)
    return np.where(turn < groups, turn, 2 * groups - 1 - turn)


def number_of_groups(words: int) -> int:
    """Four groups for half a million words, and one more for each further factor of about 2.8."""
    return max(2, 4 + math.floor((math.log2(max(words, 1)) - 19) / 1.5 + 0.5))


def keyed_words(words: DataFrame, group: np.ndarray, weights: np.ndarray) -> DataFrame:
    """(key, word, n); the key is a sum over the word's letters, so an edit adds a known number."""
    value = weights[group]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, lengths = latin_bytes(batch.column(0))
            sums = np.concatenate([[0], np.cumsum(value[letters])])
            ends = np.cumsum(lengths)
            keys = sums[ends] - sums[ends - lengths]
            yield pa.record_batch([pa.array(keys), *batch.columns], ["key", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key long, word string, n long")


def blocks_of(words: DataFrame, part_words: int) -> DataFrame:
    """(key, part, words, counts): blocks of about `part_words` words at most."""
    sizes = words.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > part_words)
    parts = F.ceil(F.col("size") / part_words).cast("int")
    part = F.coalesce(F.pmod(F.xxhash64("word"), parts), F.lit(0)).cast("int")
    # Dealt anew, since a hot key's parts must not meet in the task that counted them.
    dealt = words.join(sizes, "key", "left").withColumn("part", part).repartition("key", "part")
    listed = F.sort_array(F.collect_list(F.struct("word", "n")))
    return dealt.groupBy("key", "part").agg(listed.alias("entries")).select(
        "key",
        "part",
        F.transform("entries", lambda e: e["word"]).alias("words"),
        F.transform("entries", lambda e: e["n"]).alias("counts"),
    )


class Block:
    """Words of one length as a matrix of letters and one of letter counts."""

    def __init__(self, words: pa.Array, counts: pa.Array):
        self.words, self.n = words, counts.to_numpy()
        letters, lengths = latin_bytes(words)
        self.length = int(lengths[0])
        self.letters = letters.reshape(-1, self.length)
        dimension = np.where(
            (letters >= 97) & (letters < 123), letters.astype(np.int64) - 97, 26 + letters % SHARED_DIMENSIONS
        )
        size = 26 + SHARED_DIMENSIONS
        row = np.repeat(np.arange(len(words)), self.length)
        vectors = np.bincount(row * size + dimension, minlength=len(words) * size).reshape(-1, size)
        # Whole numbers and their halves are exact in single precision for all but very long words.
        self.vectors = vectors.astype(np.float32 if self.length < 2000 else np.float64)
        self.half = (self.vectors * self.vectors).sum(1, keepdims=True) / 2

    def near(self, other: Block, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row here, row there) one edit apart; `other` has the same length or one letter more."""
        one = np.ones_like(self.half)
        left = np.hstack([self.vectors, self.half, one])
        right = np.hstack([other.vectors, -np.ones_like(other.half), -other.half])
        # Minus half the squared distance of all pairs.
        a, b = np.divmod(np.flatnonzero(left @ right.T >= -1), len(other.letters))
        if same:
            a, b = a[a < b], b[a < b]
        kept = [np.zeros(0, bool)]
        step = max(CANDIDATES // self.length, 1)
        for at in range(0, len(a), step):
            kept.append(self.verified(other, a[at : at + step], b[at : at + step]))
        good = np.concatenate(kept)
        return a[good], b[good]

    def verified(self, other: Block, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = self.letters[a], other.letters[b]
        if self.length == other.length:
            return (x != y).sum(1) == 1
        # The letters before the added one agree, and those after it.
        before = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(1)
        after = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
        return before + after >= self.length


def summed(block: Block, other: Block, mine: np.ndarray, theirs: np.ndarray) -> tuple:
    """Number and best of the near words of every word of a block that has some."""
    if not len(mine):
        return None
    n = other.n[theirs]
    order = np.lexsort((theirs, -n, mine))  # words of a block are in order
    mine, theirs, n = mine[order], theirs[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
    counts = np.diff(np.append(first, len(mine)))
    return (
        block.words.take(pa.array(mine[first])),
        pa.array(counts),
        pa.array(n[first]),
        other.words.take(pa.array(theirs[first])),
    )


def near_words(words: DataFrame, groups: int | None = None, part_words: int = PART_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of every word that has near ones, from (word, n).

    The best near word has the largest n, and of these the first in code-point order.
    """
    if groups is None:
        groups = number_of_groups(words.count())
    weights = np.random.default_rng(11).integers(1 << 20, 1 << 31, groups)
    group = letter_groups(letter_counts(words), groups)
    blocks = written(blocks_of(keyed_words(words, group, weights), part_words), "blocks")
    moves = [0, *(int(w) for w in weights)]
    moves += [int(weights[j] - weights[i]) for i in range(groups) for j in range(i + 1, groups)]
    meets = F.explode(F.array(*(F.col("key") + F.lit(m) for m in moves)))
    left = blocks.select(
        "key",
        meets.alias("target"),
        F.col("part").alias("left_part"),
        F.col("words").alias("left_words"),
        F.col("counts").alias("left_counts"),
    )
    right = blocks.withColumnRenamed("key", "target")
    same = F.col("key") == F.col("target")
    met = left.join(right, "target").where(~same | (F.col("left_part") <= F.col("part")))
    met = met.select(
        (same & (F.col("left_part") == F.col("part"))).alias("same"),
        "left_words",
        "left_counts",
        "words",
        "counts",
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for k in range(len(batch)):
                one, ones, two, twos = (batch.column(c)[k].values for c in range(1, 5))
                a = Block(one, ones)
                same_block = batch.column(0)[k].as_py()
                b = a if same_block else Block(two, twos)
                if a.length > b.length:
                    a, b = b, a
                # Blocks whose keys agree by chance may be of any length.
                if b.length - a.length > 1:
                    continue
                mine, theirs = a.near(b, same_block)
                found += [summed(a, b, mine, theirs), summed(b, a, theirs, mine)]
            found = [f for f in found if f is not None]
            if found:
                columns = [pa.concat_arrays(list(parts)) for parts in zip(*found, strict=True)]
                yield pa.record_batch(columns, ["word", "n_near", "best_n", "best"])

    parts = met.mapInArrow(run, "word string, n_near long, best_n long, best string")
    return (
        parts.withColumn("less", -F.col("best_n"))
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "best")).alias("first"))
        .select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))
    )


def follow_forms(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last word on the way; every round doubles the way's length.

    A form is more frequent than its word, so ways end.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.select(F.col("word").alias("via"), F.col("root").alias("ahead"))
        step = roots.join(ahead, roots["root"] == ahead["via"], "left")
        step = written(
            step.select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")),
            "roots",
        )
        roots = step.drop("moved")
        if step.where("moved").isEmpty():
            return roots


def group_variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    drop_every: int = DROP_EVERY,
    groups: int | None = None,
    part_words: int = PART_WORDS,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least `least_letters` letters.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, that stand at
    least `least_count` times.  Where `drop_every` divides the crc32 of
    "<doc_id>:<run>", the run loses the letter at that number modulo its length.
    A word's form is its near word of largest n (ties: the first in code-point
    order) if that n is at least `ratio` times its own; its root is the last
    word that forms lead to, or itself.

    A null text has no words, and in a text without doc_id no run loses a letter.
    Rows that repeat count again.  Texts and runs of any length count whole.
    Other columns are left alone, whatever they are called.  An empty table
    gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    counted = count_words(rows, least_letters, drop_every).where(F.col("n") >= least_count)
    words = written(counted, "words")
    near = near_words(words, groups, part_words)
    is_form = F.col("best_n") >= ratio * F.col("n")
    linked = written(
        words.join(near, "word", "left").select(
            "word",
            F.when(is_form, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "linked",
    )
    roots = follow_forms(linked.where("form is not null").select("word", "form"))
    return linked.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
