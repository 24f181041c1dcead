"""Removal of long byte strings that occur more than once, with suffix arrays.

Every window of `length` bytes has an anchor: the smallest hash of the 64-byte
strings that lie in it, found without regard to what surrounds the window.
Equal windows have equal anchors, so windows meet by their anchor's hash.  The
windows of one anchor make up one segment of a document.  Segments that occur
twice as a whole repeat in all their windows; this is counted first.  Segments
that differ from the others at their anchor go through a suffix array over
blocks of 32 bytes aligned to the anchor: suffixes that share enough blocks are
neighbours, and only their windows are compared.

The suffix array is built in linear time by grouping: groups of suffixes with
equal Lyndon prefix are processed in descending order and, over pointers to the
previous smaller suffix, split the groups before them; then each group's order
is emitted from the order of the smaller suffixes, without renaming.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.arrays import BYTE_CODES, _powers, gather_ragged, mix64, text_buffers
from tallyloom.llm.shared import written

ANCHOR = 64
SAMPLE = 120
BLOCK = 32
PIECE = 1 << 20
PLACE_BITS = 22
FILTER_BITS = 24
HOT_SEGMENTS = 4096
BUCKET_BYTES = 2 << 20
SKIPPED = np.uint64(2**64 - 1)


# Suffix array by grouping


def suffix_array(text: list[int]) -> list[int]:
    """Order of all suffixes; the end of the text is smaller than any symbol."""
    n = len(text)
    values = np.array(text, np.int64)
    first = np.argsort(values, kind="stable")
    heads = np.flatnonzero(np.diff(values[first], prepend=values[first[0]] - 1 if n else 0))
    size = np.zeros(n + 1, np.int64)
    size[heads] = np.diff(np.append(heads, n))
    start = np.empty(n, np.int64)
    start[first] = np.repeat(heads, size[heads])
    place = np.empty(n, np.int64)
    place[first] = np.arange(n)
    order, start, place, size = first.tolist(), start.tolist(), place.tolist(), size.tolist()
    previous = _lyndon_groups(order, start, place, size)
    return _emit(start, previous, n)


def _lyndon_groups(order, start, place, size) -> list[int]:
    """Refine the groups (intervals of `order`) by Lyndon prefix; pointers to previous smaller ones."""
    previous = [-1] * len(order)
    end = len(order)
    while end:
        low = start[order[end - 1]]
        members = order[low:end]
        if end - low > 1:
            members.sort()
        times: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and start[j] >= low:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        end = low
        if not times:
            continue
        levels = set(times.values())
        for level in sorted(levels, reverse=True):
            moved: dict[int, int] = {}
            for p, many in times.items():
                if many == level:
                    # Swap to the end of its group, behind the rest and before earlier splits.
                    group = start[p]
                    done = moved.get(group, 0)
                    tail = group + size[group] - 1 - done
                    moved[group] = done + 1
                    at, other = place[p], order[tail]
                    order[at], order[tail] = other, p
                    place[other], place[p] = at, tail
            for group, many in moved.items():
                stop = group + size[group]
                split = stop - many
                if split > group:
                    size[group] -= many
                    size[split] = many
                    for k in range(split, stop):
                        start[order[k]] = split
    return previous


def _emit(start: list[int], previous: list[int], n: int) -> list[int]:
    out = [-1] * n
    free = list(range(n))
    placed = bytearray(n)
    at, i = -1, n
    while True:
        j = i - 1
        while j >= 0 and not placed[j]:
            placed[j] = 1
            slot = free[start[j]]
            free[start[j]] = slot + 1
            out[slot] = j
            j = previous[j]
        at += 1
        if at >= n:
            return out
        i = out[at]


# Anchors and segments


def window_hashes(codes_sum: np.ndarray, down: np.ndarray, starts: np.ndarray, size: int):
    return mix64((codes_sum[starts + size] - codes_sum[starts]) * down[starts])


def code_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * up[: len(data)], out=sums[1:])
    return sums, down


def window_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` neighbours."""
    padded = np.full(-(-len(keys) // width) * width, SKIPPED)
    padded[: len(keys)] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = len(keys) - width + 1
    return np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])


def anchored_segments(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, anchor, first window, end of windows, segment hash) of a text."""
    width = length - ANCHOR + 1
    parts = []
    for begin in range(0, len(data) - length + 1, PIECE):
        piece = data[begin : begin + PIECE + length - 1]
        sums, down = code_sums(piece)
        n = len(piece) - ANCHOR + 1
        hashes = window_hashes(sums, down, np.arange(n), ANCHOR)
        low = np.uint64(PLACE_BITS)
        windows = n - width + 1
        least = window_least(hashes >> low << low | np.arange(n, dtype=np.uint64), width)
        anchor = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        end = np.append(first[1:], windows)
        anchor = anchor[first]
        stops = end - 1 + length
        segment = (sums[stops] - sums[first]) * down[first]
        shape = (anchor - first).astype(np.uint64) << np.uint64(32) | (end - first).astype(np.uint64)
        parts.append(
            (hashes[anchor], anchor + begin, first + begin, end + begin, mix64(segment ^ mix64(shape)))
        )
    if not parts:
        kinds = (np.uint64, np.int64, np.int64, np.int64, np.uint64)
        return tuple(np.zeros(0, kind) for kind in kinds)
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def each_text(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, np.ndarray]]:
    data, offsets = text_buffers(batch.column(at))
    for k in range(len(offsets) - 1):
        yield k, data[offsets[k] : offsets[k + 1]]


def all_segments(rows: DataFrame, length: int) -> DataFrame:
    """(doc_id, mark, anchor, segment, first, windows) of every segment of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, *anchored_segments(x, length)) for k, x in each_text(batch, 2)]
            if not found:
                continue
            sizes = [len(f[1]) for f in found]
            row = pa.array(np.repeat([f[0] for f in found], sizes).astype(np.int64))
            anchor, _, first, end, segment = (
                np.concatenate([f[c] for f in found]) for c in range(1, 6)
            )
            yield pa.record_batch(
                [
                    batch.column(0).take(row),
                    batch.column(1).take(row),
                    pa.array(anchor.view(np.int64)),
                    pa.array(segment.view(np.int64)),
                    pa.array(first),
                    pa.array((end - first).astype(np.int32)),
                ],
                ["doc_id", "mark", "anchor", "segment", "first", "windows"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, mark long, anchor long, segment long, first long, windows int"
    return rows.mapInArrow(run, schema)


def anchor_filter(anchors: DataFrame) -> np.ndarray:
    """Bitmap of fixed size over anchor hashes; it may only let too many pass."""
    # The lowest bits: an anchor is the smallest of many hashes.
    bits = F.col("anchor").bitwiseAND((1 << FILTER_BITS) - 1) + 1
    maps = (
        anchors.select(
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


def segment_bytes(rows: DataFrame, anchors: DataFrame, length: int) -> DataFrame:
    """(anchor, segment, lead, data) of the distinct segments at the given anchors."""
    passing = rows.sparkSession.sparkContext.broadcast(anchor_filter(anchors))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = passing.value, set()
        for batch in batches:
            out = []
            for _, data in each_text(batch, 0):
                anchor, at, first, end, segment = anchored_segments(data, length)
                if not len(anchor):
                    continue
                for k in np.flatnonzero(wanted[anchor & np.uint64((1 << FILTER_BITS) - 1)]):
                    key = int(segment[k])
                    if key not in seen:
                        if len(seen) < 500_000:
                            seen.add(key)
                        part = data[first[k] : end[k] - 1 + length].tobytes()
                        out.append((int(anchor[k].view(np.int64)), int(segment[k].view(np.int64)), int(at[k] - first[k]), part))
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.record_batch(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int32()),
                    pa.array(columns[3], pa.binary()),
                ],
                ["anchor", "segment", "lead", "data"],
            )

    found = rows.select("text").mapInArrow(
        run, "anchor long, segment long, lead int, data binary"
    )
    return found.join(anchors, "anchor", "left_semi").dropDuplicates(["anchor", "segment"])


def repeated_windows(table: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, window) of the windows of the segments that another window equals."""
    lead = table.column("lead").to_numpy()
    parts = [np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("data")]
    data = np.concatenate(parts)
    sizes = np.array([len(p) for p in parts])
    begin = np.cumsum(sizes) - sizes
    sums, down = code_sums(data)
    # Blocks aligned to the anchor, as symbols; a zero ends each segment.
    shift = lead % BLOCK
    blocks = (sizes - shift) // BLOCK
    ends = np.cumsum(blocks + 1)
    row = np.repeat(np.arange(len(parts)), blocks + 1)
    turn = np.arange(ends[-1]) - np.repeat(ends - blocks - 1, blocks + 1)
    real = turn < blocks[row]
    spot = begin[row] + shift[row] + turn * BLOCK
    symbols = np.zeros(len(row), np.int64)
    hashes = window_hashes(sums, down, spot[real], BLOCK)
    symbols[real] = np.unique(hashes, return_inverse=True)[1] + 1
    order = np.array(suffix_array(symbols.tolist()))
    need = (length - BLOCK + 1) // BLOCK
    order = order[turn[order] + need <= blocks[row[order]]]
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in range(need):
        same &= symbols[order[1:] + k] == symbols[order[:-1] + k]
    near = np.zeros(len(order), bool)
    near[1:] |= same
    near[:-1] |= same
    chosen = order[near]
    # Windows that start in the block's length before a chosen suffix.
    start = (spot[chosen] - begin[row[chosen]])[:, None] - np.arange(BLOCK)[None, :]
    whose = np.broadcast_to(row[chosen][:, None], start.shape)
    fits = (start >= 0) & (start + length <= sizes[whose])
    start, whose = start[fits], whose[fits]
    found = window_hashes(sums, down, begin[whose] + start, length)
    _, back, many = np.unique(found, return_inverse=True, return_counts=True)
    hit = many[back] > 1
    return whose[hit], start[hit]


def window_runs(row: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first, end) of the runs of neighbouring windows."""
    order = np.lexsort((window, row))
    row, window = row[order], window[order]
    head = np.ones(len(row), bool)
    head[1:] = (row[1:] != row[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(row)) - 1
    return row[first], window[first], window[last] + 1 if len(row) else window


def compared_segments(segments: DataFrame, length: int) -> DataFrame:
    """(anchor, segment, low, high): runs of repeated windows within segments, by suffix array."""
    spark = segments.sparkSession
    total = segments.agg(F.coalesce(F.sum(F.length("data")), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES + 1)

    def compare(table: pa.Table) -> pa.Table:
        row, low, high = window_runs(*repeated_windows(table, length))
        take = pa.array(row)
        return pa.table(
            {
                "anchor": table.column("anchor").take(take),
                "segment": table.column("segment").take(take),
                "low": low,
                "high": high,
            }
        )

    return (
        segments.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInArrow(compare, "anchor long, segment long, low long, high long")
    )


def spread_segments(segments: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many segments: each window meets its equals by its own hash."""

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                data = np.frombuffer(batch.column("data")[k].as_buffer(), np.uint8)
                sums, down = code_sums(data)
                starts = np.arange(len(data) - length + 1)
                n = len(starts)
                yield pa.record_batch(
                    [
                        *(pa.array(np.full(n, batch.column(c)[k].as_py())) for c in ("anchor", "segment")),
                        pa.array(starts),
                        pa.array(window_hashes(sums, down, starts, length).view(np.int64)),
                    ],
                    ["anchor", "segment", "low", "window"],
                )

    windows = segments.mapInArrow(spread, "anchor long, segment long, low long, window long")
    many = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    return windows.join(many, "window", "left_semi").select(
        "anchor", "segment", "low", (F.col("low") + 1).alias("high")
    )


def repeated_runs(rows: DataFrame, length: int) -> DataFrame:
    """(doc_id, mark, low, high): runs of window starts that repeat elsewhere, by row."""
    segments = written(all_segments(rows, length), "segments")
    counts = segments.groupBy("anchor", "segment").agg(F.count("*").alias("n"))
    per_anchor = counts.groupBy("anchor").agg(
        F.count("*").alias("kinds"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    counts = written(
        counts.join(per_anchor.where("kinds > 1 or most > 1"), "anchor"), "segment-counts"
    )
    unclear = counts.where("kinds > 1 and least = 1").select("anchor", "kinds").distinct()
    data = written(segment_bytes(rows, unclear.select("anchor"), length), "segment-bytes")
    hot = unclear.where(F.col("kinds") > HOT_SEGMENTS).select("anchor")
    found = compared_segments(data.join(hot, "anchor", "left_anti"), length).union(
        spread_segments(data.join(hot, "anchor", "left_semi"), length)
    )
    single = segments.join(
        counts.where("n = 1").select("anchor", "segment"), ["anchor", "segment"], "left_semi"
    )
    whole = segments.join(
        counts.where("n > 1").select("anchor", "segment"), ["anchor", "segment"], "left_semi"
    )
    return whole.select(
        "doc_id", "mark", F.col("first").alias("low"), (F.col("first") + F.col("windows")).alias("high")
    ).union(
        single.join(found, ["anchor", "segment"]).select(
            "doc_id",
            "mark",
            (F.col("first") + F.col("low")).alias("low"),
            (F.col("first") + F.col("high")).alias("high"),
        )
    )


# Strings shared with other rows, too short to be removed


def sampled_strings(data: np.ndarray, length: int) -> np.ndarray:
    """Hashes of strings of SAMPLE bytes, one or more from every `length` bytes, told by these alone."""
    parts = [np.zeros(0, np.uint64)]
    for begin in range(0, len(data) - length + 1, PIECE):
        sums, down = code_sums(data[begin : begin + PIECE + length - 1])
        hashes = window_hashes(sums, down, np.arange(len(sums) - SAMPLE), SAMPLE)
        parts.append(np.unique(window_least(hashes, length - SAMPLE + 1)))
    return np.unique(np.concatenate(parts))


def shared_samples(rows: DataFrame, length: int) -> DataFrame:
    """(doc_id, mark, shared): how many sampled strings of a row another row has among its own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sampled_strings(data, length) for _, data in each_text(batch, 2)]
            row = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]).astype(np.int64))
            sample = np.concatenate([np.zeros(0, np.uint64), *found])
            yield pa.record_batch(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(sample.view(np.int64))],
                ["doc_id", "mark", "sample"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    samples = written(rows.mapInArrow(run, f"doc_id {kind}, mark long, sample long"), "samples")
    many = samples.groupBy("sample").agg(F.count("*").alias("n")).where("n > 1").select("sample")
    return (
        samples.join(many, "sample", "left_semi")
        .groupBy("doc_id", "mark")
        .agg(F.count_distinct("sample").alias("shared"))
    )


# Removal


def removed_spans(runs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans covered by the windows of the runs (rows of low, high)."""
    if not len(runs):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    ends = np.maximum.accumulate(runs[:, 1] - 1 + length)
    head = np.ones(len(runs), bool)
    head[1:] = runs[1:, 0] > ends[:-1]
    first = np.flatnonzero(head)
    return runs[first, 0], ends[np.append(first[1:], len(runs)) - 1]


def remove_repeats(
    docs: DataFrame,
    length: int = 400,
    doc_id: str = "doc_id",
    text: str = "text",
    also: tuple[int, ...] = (),
    shared: int | None = None,
) -> DataFrame:
    """Every row's columns, with `kept` (bytes that stay), n_bytes, n_removed and n_spans.

    For every other length in `also`, n_removed_<length> counts the bytes that strings
    of that length would remove; they stay in `kept`.  With `shared`, a length, n_shared
    counts strings of 120 bytes that another row has too, of a sample that takes one or
    more from every `shared` bytes: above 0 wherever two rows share so long a string.

    A byte goes if a string of `length` bytes that covers it also starts
    anywhere else in the table, in the same text included; strings are judged
    on the input.  A null text is empty.  Repeated rows repeat each other.  Texts of
    any length count whole, and an empty table gives no rows.  Columns of the
    input must not have the names that are added; others may have any.  Equal
    strings are told by 64-bit hashes.
    """
    mark = F.xxhash64(F.col(text))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), mark.alias("mark"), F.col(text).alias("text")
    )
    runs = repeated_runs(rows, length).withColumn("length", F.lit(length))
    for other in also:
        runs = runs.unionByName(repeated_runs(rows, other).withColumn("length", F.lit(other)))
    found = runs.select("doc_id", "mark", F.array("low", "high", "length").alias("run"))
    if shared is not None:
        found = found.unionByName(shared_samples(rows, shared), allowMissingColumns=True)
    sums = [F.max("shared").alias("shared")] if shared is not None else []
    per_row = written(
        found.groupBy("doc_id", "mark").agg(F.collect_list("run").alias("runs"), *sums), "runs"
    )
    # Names that no column of the input has.
    run_id, run_mark, *run_columns = (max(docs.columns, key=len) + "_" + c for c in per_row.columns)
    per_row = per_row.toDF(run_id, run_mark, *run_columns)
    joined = docs.join(
        per_row,
        docs[doc_id].eqNullSafe(per_row[run_id]) & (F.xxhash64(docs[text]) == per_row[run_mark]),
        "left",
    ).select(*(docs[c] for c in docs.columns), *(per_row[c] for c in run_columns))
    kept = docs.columns
    at = kept.index(text)
    counted = ["n_bytes", "n_removed", "n_spans", *(f"n_removed_{other}" for other in also)]
    if shared is not None:
        counted.append("n_shared")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, sizes, removed, spans = [], [], [], []
            others = [[] for _ in also]
            all_runs = batch.column(len(kept)).to_pylist()
            for k, data in each_text(batch, at):
                found = np.array(all_runs[k] or [], np.int64).reshape(-1, 3)
                low, high = removed_spans(found[found[:, 2] == length, :2], length)
                for other, counts in zip(also, others, strict=True):
                    begin, end = removed_spans(found[found[:, 2] == other, :2], other)
                    counts.append(int((end - begin).sum()))
                starts, stops = np.append(0, high), np.append(low, len(data))
                out.append(gather_ragged(data, starts, stops - starts).tobytes())
                sizes.append(len(data))
                removed.append(int((high - low).sum()))
                spans.append(len(low))
            if shared is not None:
                others.append(batch.column(len(kept) + 1).fill_null(0).to_pylist())
            yield pa.record_batch(
                [
                    *batch.columns[: len(kept)],
                    pa.array(out, pa.binary()),
                    *(pa.array(x, pa.int64()) for x in (sizes, removed, spans, *others)),
                ],
                [*kept, "kept", *counted],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return joined.mapInArrow(cut, f"{schema}, kept binary, " + ", ".join(f"{c} long" for c in counted))


