"""BPE encoding and decoding with forced-boundary splitting.

A merge can only join two neighbouring bytes if some vocabulary token holds
this byte pair.  Wherever the pair occurs inside no token there is a certain
cut: the fragments on both sides are encoded independently and their ids are
concatenated.  Fragments repeat much more than texts, so each task encodes a
fragment once (all new fragments of a batch together, one merge round for all
of them at a time) and keeps it in a table of fixed size.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.arrays import BYTE_CODES, gather_ragged, mix64, row_slices, span_hashes, text_buffers

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
END_OF_WORD = "</w>"
NO_RANK = np.int64(1 << 40)
CACHE_BITS = 20
POOL_LIMIT = 1 << 23

# The contractions that the vocabulary's splitting pattern takes first.
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")


@functools.cache
def character_classes() -> np.ndarray:
    """Letter, number, white space or other for every code point."""
    classes = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for code in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            classes[code] = LETTER
        elif kind == "N":
            classes[code] = NUMBER
        elif kind == "Z":
            classes[code] = SPACE
    classes[[9, 10, 11, 12, 13, 0x85]] = SPACE
    return classes


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class ForcedBoundaryBpe:
    """Encoder and decoder for a byte-level BPE vocabulary with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        names = byte_characters()
        values = {c: b for b, c in names.items()}
        self.byte_ids = np.array([vocab[names[b]] for b in range(256)], np.int64)
        self.end_ids = np.array([vocab[names[b] + END_OF_WORD] for b in range(256)], np.int64)
        self._read_merges(spec["model"]["merges"], vocab)
        self.inside = np.zeros((256, 256), bool)
        for token in vocab:
            raw = [values[c] for c in token.removesuffix(END_OF_WORD) or token]
            self.inside[raw[:-1], raw[1:]] = True
        tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            tokens[i] = token
        self.tokens = tokens
        self._forget()

    def _read_merges(self, merges: list, vocab: dict[str, int]) -> None:
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        bits = int(np.ceil(np.log2(len(pairs)))) + 3
        self.shift = np.uint64(64 - bits)
        keys = (left << 32 | right).astype(np.uint64)
        self.rank_keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.ranks = np.full(1 << bits, NO_RANK)
        open_, slot, self.probes = np.arange(len(keys)), mix64(keys) >> self.shift, 0
        while len(open_):
            free = self.rank_keys[slot[open_]] == np.uint64(2**64 - 1)
            take = open_[free]
            # Of several pairs that want one free slot the last one written gets it.
            self.rank_keys[slot[take]] = keys[take]
            won = take[self.rank_keys[slot[take]] == keys[take]]
            self.ranks[slot[won]] = won
            open_ = np.setdiff1d(open_, won)
            slot[open_] = (slot[open_] + np.uint64(1)) & np.uint64((1 << bits) - 1)
            self.probes += 1

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32 | right).astype(np.uint64)
        slot = mix64(keys) >> self.shift
        found = np.where(self.rank_keys[slot] == keys, self.ranks[slot], NO_RANK)
        unsure = np.flatnonzero(
            (self.rank_keys[slot] != keys) & (self.rank_keys[slot] != np.uint64(2**64 - 1))
        )
        for _ in range(1, self.probes):
            if not len(unsure):
                break
            slot[unsure] = (slot[unsure] + np.uint64(1)) & np.uint64(len(self.ranks) - 1)
            there = self.rank_keys[slot[unsure]]
            hit = there == keys[unsure]
            found[unsure[hit]] = self.ranks[slot[unsure[hit]]]
            unsure = unsure[~hit & (there != np.uint64(2**64 - 1))]
        return found

    def _forget(self) -> None:
        self.cache_keys = np.zeros(1 << CACHE_BITS, np.uint64)
        self.cache_at = np.zeros(1 << CACHE_BITS, np.int64)
        self.cache_n = np.zeros(1 << CACHE_BITS, np.int64)
        self.pool = np.zeros(1 << 16, np.int32)
        self.pooled = 0

    # Encoding

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, joined, and the n + 1 offsets of the texts."""
        pieces: list[str] = []
        owners: list[int] = []
        specials: dict[int, int] = {}
        for k, text in enumerate(texts):
            if "<|" in text:
                for part in self.special_split.split(text):
                    if part in self.special:
                        specials[len(pieces)] = self.special[part]
                        part = ""
                    pieces.append(part)
                    owners.append(k)
            else:
                pieces.append(text)
                owners.append(k)
        ids, counts = self._encode_pieces(pieces)
        if specials:
            at = np.concatenate([[0], np.cumsum(counts)])[list(specials)]
            ids = np.insert(ids, at, list(specials.values()))
            counts[list(specials)] += 1
        totals = np.bincount(owners, weights=counts, minlength=len(texts)).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(totals)])

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data, starts, ends, piece_at = self._words(pieces)
        starts, ends, closed, order = self._fragments(data, starts, ends)
        at, n = self._fragment_ids(data, starts, ends, closed)
        ids = gather_ragged(self.pool, at, n)
        before = np.concatenate([[0], np.cumsum(n)])
        first = np.searchsorted(order, piece_at)
        return ids, np.diff(before[first])

    def _words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of the normalised pieces, spans of their words, first word of each piece."""
        clean = [p.lower() if p.isascii() else lower_composed(p) for p in pieces]
        joined = "\n".join(clean) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kinds = character_classes()[codes]
        first = kinds != SPACE
        first[1:] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == NUMBER)
        self._contractions(codes, kinds, first)
        inside = kinds != SPACE
        last = inside.copy()
        last[:-1] &= first[1:] | ~inside[1:]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        lengths = np.fromiter(map(len, clean), np.int64, len(clean)) + 1
        piece_at = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
        if joined.isascii():
            return codes.astype(np.uint8), starts, ends, piece_at
        width = 1 + (codes >= 0x80) + (codes >= 0x800).astype(np.int64) + (codes >= 0x10000)
        place = np.concatenate([[0], np.cumsum(width)])
        return np.frombuffer(joined.encode(), np.uint8), place[starts], place[ends], piece_at

    @staticmethod
    def _contractions(codes: np.ndarray, kinds: np.ndarray, first: np.ndarray) -> None:
        """An apostrophe that starts a word takes the letters of a contraction with it."""
        marks = np.flatnonzero((codes == ord("'")) & first)
        # The last code is a line end, so that two letters never reach beyond it.
        marks = marks[marks + 2 < len(codes)]
        one = marks[np.isin(codes[marks + 1], [ord(c) for c in ONE_LETTER])]
        two = np.concatenate(
            [
                marks[(codes[marks + 1] == ord(a)) & (codes[marks + 2] == ord(b))]
                for a, b in TWO_LETTERS
            ]
        )
        for found, size in ((one, 2), (two, 3)):
            first[found + 1] = False
            first[(found + size)[kinds[found + size] == LETTER]] = True

    def _fragments(self, data, starts, ends):
        """Words cut where no token holds both bytes: spans, word ended, word's number."""
        cut = np.zeros(len(data), bool)
        cut[1:] = ~self.inside[data[:-1], data[1:]]
        cut[starts] = True
        within = np.zeros(len(data) + 1, np.int8)
        within[starts] += 1
        within[ends] -= 1
        cut &= np.cumsum(within[:-1], dtype=np.int8) > 0
        parts = np.flatnonzero(cut)
        order = np.searchsorted(starts, parts, side="right") - 1
        stops = ends[order]
        inner = order[:-1] == order[1:]
        stops[:-1][inner] = parts[1:][inner]
        return parts, stops, stops == ends[order], order

    def _fragment_ids(self, data, starts, ends, closed) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of each fragment's ids in the pool."""
        if self.pooled > POOL_LIMIT:
            self._forget()
        if not len(starts):
            return starts, starts
        keys = span_hashes(BYTE_CODES[data], starts, ends) ^ (
            closed.astype(np.uint64) * np.uint64(0xA5A5A5A5A5A5A5A5)
        )
        keys |= np.uint64(1)  # zero means an empty slot
        slots = (keys >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        at, n = self.cache_at[slots], self.cache_n[slots]
        missing = np.flatnonzero(self.cache_keys[slots] != keys)
        if len(missing):
            new, first, back = np.unique(keys[missing], return_index=True, return_inverse=True)
            sample = missing[first]
            ids, counts = self._merge(data, starts[sample], ends[sample], closed[sample])
            places = self.pooled + np.cumsum(counts) - counts
            self._add_to_pool(ids)
            at[missing], n[missing] = places[back], counts[back]
            own = slots[sample]
            self.cache_keys[own], self.cache_at[own], self.cache_n[own] = new, places, counts
        return at, n

    def _add_to_pool(self, ids: np.ndarray) -> None:
        need = self.pooled + len(ids)
        if need > len(self.pool):
            grown = np.zeros(max(need, 2 * len(self.pool)), np.int32)
            grown[: self.pooled] = self.pool[: self.pooled]
            self.pool = grown
        self.pool[self.pooled : need] = ids
        self.pooled = need

    def _merge(self, data, starts, ends, closed) -> tuple[np.ndarray, np.ndarray]:
        """BPE of all fragments: each round applies every fragment's first-ranked pair."""
        sizes = ends - starts
        raw = gather_ragged(data, starts, sizes)
        symbols = self.byte_ids[raw]
        tails = np.cumsum(sizes) - 1
        symbols[tails[closed]] = self.end_ids[raw[tails[closed]]]
        owner = np.repeat(np.arange(len(starts)), sizes)
        done_owner, done_symbols = [], []
        while len(symbols):
            rank = np.full(len(symbols), NO_RANK)
            same = owner[1:] == owner[:-1]
            rank[:-1][same] = self._rank(symbols[:-1][same], symbols[1:][same])
            heads = np.flatnonzero(np.concatenate([[True], ~same]))
            best = np.repeat(
                np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(symbols)))
            )
            ended = best == NO_RANK
            done_owner.append(owner[ended])
            done_symbols.append(symbols[ended])
            symbols, owner, rank, best = (x[~ended] for x in (symbols, owner, rank, best))
            if not len(symbols):
                break
            chosen = np.flatnonzero(rank == best)
            # Overlapping pairs such as in "aaa" merge from the left.
            new_run = np.concatenate([[True], np.diff(chosen) != 1])
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(chosen)), 0))
            chosen = chosen[(np.arange(len(chosen)) - run_start) % 2 == 0]
            symbols[chosen] = self.merged[rank[chosen]]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        owners, ids = np.concatenate(done_owner), np.concatenate(done_symbols)
        order = np.argsort(owners, kind="stable")
        return ids[order], np.bincount(owners, minlength=len(starts))

    # Decoding

    @functools.cached_property
    def _shown(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _byte_table([t.encode() for t in self.tokens])

    @functools.cached_property
    def _decimals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _byte_table([b"%d" % i for i in range(len(self.tokens))])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 text of each row of ids: the tokens joined by one space (there is no decoder)."""
        return _spelled(self._shown, ids, offsets)

    def decimal(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Decimal ids of each row joined by one space."""
        return _spelled(self._decimals, ids, offsets)


def _byte_table(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words followed by one space each, with their places and lengths."""
    sizes = np.array([len(w) + 1 for w in words])
    data = np.frombuffer(b"".join(w + b" " for w in words), np.uint8)
    return data, np.cumsum(sizes) - sizes, sizes


def _spelled(table, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    data, places, sizes = table
    lengths = sizes[ids]
    joined = gather_ragged(data, places[ids], lengths).tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths)])[offsets]
    return [joined[a : b - 1] if b > a else b"" for a, b in zip(ends[:-1], ends[1:], strict=True)]


def lower_composed(text: str) -> str:
    """NFC, then every character lower-cased by itself (no final sigma)."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


@functools.cache
def encoder(path: str) -> ForcedBoundaryBpe:
    """One encoder for each Python worker."""
    return ForcedBoundaryBpe(path)


def encoded_batches(
    batches: Iterable[pa.RecordBatch], path: str, text_at: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the ids of their texts; a null text is empty."""
    bpe = encoder(path)
    for batch in batches:
        for a, b in row_slices(text_buffers(batch.column(text_at))[1]):
            part = batch.slice(a, b - a)
            yield part, *bpe.encode([t or "" for t in part.column(text_at).to_pylist()])


def round_trip(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, ids, decoded) of every document.

    A null or empty text has no ids and decodes to an empty text.  Repeated
    rows stay, ids may be null, other columns are ignored.
    """

    def run(batches):
        bpe = encoder(vocabulary)
        for part, ids, offsets in encoded_batches(batches, vocabulary, 1):
            yield pa.record_batch(
                [
                    part.column(0),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)),
                    pa.array(bpe.decode(ids, offsets), pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "ids", "decoded"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def round_trip_digests(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, as round_trip gives them.

    The digests are taken in the task that encodes, so that neither ids nor
    decoded texts are handed back to Spark.
    """

    def run(batches):
        bpe = encoder(vocabulary)
        for part, ids, offsets in encoded_batches(batches, vocabulary, 1):
            yield pa.record_batch(
                [
                    part.column(0),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array([_sha(x) for x in bpe.decimal(ids, offsets)]),
                    pa.array([_sha(x) for x in bpe.decode(ids, offsets)]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
