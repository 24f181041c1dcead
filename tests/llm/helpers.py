"""Small tables and plain Python versions of the operators."""

from __future__ import annotations

import collections
import math
import re
import zlib

import public_tokenizers

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

COPY = "the quick brown fox jumps over the lazy dog and runs away from the old house " * 2
PASSAGE = " ".join(f"word{k} of passage{k * 7 % 13}" for k in range(60))
ROWS = [
    (1, COPY, "en"),
    (2, COPY, "en"),
    (3, COPY + "x", "en"),
    (3, COPY + "x", "en"),
    (4, None, None),
    (5, "", "en"),
    (None, "kein Name für diesen Text", "de"),
    (6, "12 !! 34", None),
    (7, "début " + PASSAGE + " fin", "fr"),
    (8, "Anfang " + PASSAGE + " Ende über", "de"),
    (9, "é" * 5000 + " " + "lang " * 9000, "fr"),
    (10, "one two", "en"),
    (11, "ONE two", "en"),
]
DDL = "doc_id long, text string, lang string"


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def components(rows, size=4, percent=85):
    """{row number: (set size, smallest doc_id reachable)} by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = words(text)
        whole = [tuple(w)] if w else []
        sets.append(frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) or frozenset(whole))
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    lowest = {}
    for k, (doc_id, _) in enumerate(rows):
        if sets[k] and doc_id is not None:
            lowest[find(k)] = min(doc_id, lowest.get(find(k), doc_id))
    return [
        (doc_id, len(sets[k]), lowest.get(find(k), doc_id) if sets[k] else doc_id)
        for k, (doc_id, _) in enumerate(rows)
    ]


def without_repeats(texts, length):
    """(bytes, removed, spans, kept bytes) of each text by counting all windows."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[p : p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), spans, kept))
    return out


def kneser_ney_scores(rows, discounts):
    """{doc_id: (tokens, known, base, score)} of an interpolated modified Kneser-Ney pair model."""
    tokens = lambda t: [*words(t), "\0end"]
    single, pairs = collections.Counter(), collections.Counter()
    for doc_id, text in rows:
        if doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2:
            t = tokens(text)
            single.update(t)
            pairs.update(zip(["\0start", *t], t))
    total, followers, before = collections.Counter(), collections.defaultdict(list), collections.Counter()
    for (a, b), n in pairs.items():
        total[a] += n
        followers[a].append(n)
        before[b] += 1
    n_of = lambda values: [sum(v == k for v in values) for k in (1, 2, 3, 4)]
    d, e = discounts(n_of(pairs.values())), discounts(n_of(before.values()))
    size, n = len(single), sum(single.values())
    mass = sum(e[min(c, 3) - 1] for c in before.values()) / max(len(pairs), 1)

    def probability(a, b):
        p = mass / (size + 1)
        if before[b]:
            p += max(before[b] - e[min(before[b], 3) - 1], 0) / len(pairs)
        if total[a]:
            p *= sum(d[min(c, 3) - 1] for c in followers[a]) / total[a]
            if pairs[a, b]:
                p += max(pairs[a, b] - d[min(pairs[a, b], 3) - 1], 0) / total[a]
        return p

    out = {}
    for doc_id, text in rows:
        t = tokens(text)
        base = sum(math.log10((single[w] + 1) / (n + size + 1)) for w in t)
        log = sum(math.log10(probability(a, b)) for a, b in zip(["\0start", *t], t))
        out[doc_id] = (len(t), sum(single[w] > 0 for w in t), base, log)
    return out
