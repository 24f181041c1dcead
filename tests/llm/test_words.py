"""Spelling variants, lexical search and toxicity against plain Python."""

from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm.helpers import LOWER, ROWS
from tallyloom.llm import toxicity, variants
from tallyloom.llm.catalog import held_out_by_crc
from tallyloom.llm.lexical import rank_documents
from tallyloom.llm.toxicity import score_toxicity, train_toxicity
from tallyloom.llm.variants import group_variants

# ---------------------------------------------------------- spelling variants


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_of(rows, least=7, drop_every=31):
    """{word: (form, root, n, n_near, form_n)} by comparing all pairs of words."""
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= 2}
    forms, near = {}, {}
    for w, n in words.items():
        near[w] = [v for v in words if one_edit(v, w)]
        best = min(((-words[v], v) for v in near[w]), default=(0, None))
        forms[w] = best[1] if -best[0] >= 10 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None)
    return out


def found_variants(df, **options):
    rows = group_variants(df, **options).collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r)[1:] for r in rows}


WORDS = (
    ["kitchen"] * 400 + ["kitchem"] * 30 + ["kitchens", "kitcheem", "kitchem"] * 2 + ["Éclairée"] * 3
    + ["éclairé"] * 2 + ["ÉCLAIRÉE"] * 40 + ["anagrams", "anagrasm"] * 3 + ["abcdefghij"] * 30
)


def test_variants_on_chains_and_accents(spark):
    rows = [(k, w + " " + w) for k, w in enumerate(WORDS)] + [(None, "kitchen kitchan kitchan"), (1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = variants_of(rows)
    assert expected["kitcheem"][0] == "kitchem" and expected["kitcheem"][1] == "kitchen"
    for options in ({}, {"groups": 2, "part_words": 2}, {"groups": 6}):
        assert found_variants(df, **options) == expected


def test_variants_equal_all_pairs_on_documents(some_docs):
    rows = [tuple(r) for r in some_docs.where("doc_id < 60").select("doc_id", "text").collect()]
    expected = variants_of(rows)
    assert len(expected) > 400
    assert found_variants(some_docs.where("doc_id < 60")) == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abCéÿZ -ł’", max_size=90), min_size=1, max_size=6), st.integers(2, 5))
def test_words_of_any_text(texts, drop_every):
    import pyarrow as pa

    from tallyloom.llm.arrays import text_buffers

    ids = [None if k == 2 else str(k) for k in range(len(texts))]
    data, offsets = text_buffers(pa.array(texts))
    found = variants.slice_words(data, offsets, ids, 3, drop_every)
    expected = collections.Counter()
    for i, text in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            expected[run] += 1
    assert collections.Counter(found[0].to_pylist() + found[1].to_pylist()) == collections.Counter(
        {w: n for w, n in expected.items() if len(w) >= 3}
    )


def test_blocks_compare_less_than_all_pairs(spark, some_docs, monkeypatch):
    words = variants.count_words(some_docs.select(F.col("doc_id").cast("string"), "text"))
    few = variants.keyed_words(words, variants.letter_groups(np.arange(256), 5), 1 + np.arange(5) ** 9)
    blocks = variants.blocks_of(few, 50)
    assert blocks.agg(F.sum(F.size("words"))).first()[0] == words.count()
    # Parts are dealt by hash, so they are near the wanted size.
    assert blocks.agg(F.max(F.size("words"))).first()[0] <= 100


def test_variants_of_odd_rows(odd_docs, no_docs):
    found = found_variants(odd_docs)
    assert found == variants_of([(r[0], r[1]) for r in ROWS])
    assert group_variants(no_docs).count() == 0


# ------------------------------------------------------------ lexical search


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranking(docs, items, k=10):
    """[(item_id, rank, doc_id, score)] by scoring every document for every item."""
    bags = [(doc_id, collections.Counter(terms_of(text))) for doc_id, text in docs]
    bags = [(doc_id, bag) for doc_id, bag in bags if bag]
    n, total = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = collections.Counter(t for _, bag in bags for t in bag)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(terms_of(text))
    out = []
    for item_id, terms in asked.items():
        scores = []
        for doc_id, bag in bags:
            m = 10 + (90 * sum(bag.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in terms
                if t in bag
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:k], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=str)


ITEMS = [
    (1, "The quick FOX"),
    (2, None),
    (2, "lang lang word7"),
    (2, "word9"),
    (3, ""),
    (None, "one"),
    (4, "dog, house! ééé nothing-here"),
    (4, "dog, house! ééé nothing-here"),
    (5, "kein Name für 12"),
]
ITEM_DDL = "item_id long, text string"


@pytest.mark.parametrize("block_bytes", [1 << 20, 30])
def test_ranking_of_odd_rows(spark, odd_docs, no_docs, block_bytes):
    items = spark.createDataFrame(ITEMS, ITEM_DDL)
    found = rank_documents(odd_docs, items.withColumn("score", F.lit("clash")), block_bytes=block_bytes)
    expected = ranking([(r[0], r[1]) for r in ROWS], ITEMS)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert rank_documents(no_docs, items).count() == 0
    nothing = rank_documents(odd_docs, items.limit(0))
    assert nothing.count() == 0 and nothing.columns == ["item_id", "rank", "doc_id", "score"]


def test_copies_share_a_class_and_rank_by_id(spark):
    docs = [(k, "alpha beta") for k in range(300, 0, -1)] + [(k, "beta alpha gamma delta") for k in range(400, 420)]
    docs += [(k, f"filler{k} text") for k in range(1000, 2000)]
    items = [(1, "alpha"), (2, "beta gamma"), (3, "absent")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    found = rank_documents(df, spark.createDataFrame(items, ITEM_DDL))
    rows = sorted(map(tuple, found.collect()), key=str)
    assert rows == ranking(docs, items)
    assert [r[2] for r in sorted(r for r in rows if r[0] == 1)] == list(range(1, 11))


# -------------------------------------------------------------------- toxicity


def test_ratios_equal_counted_sets(spark):
    texts = ["you idiot there", "fine words here", "such an IDIOT", "you are here", "", "x"]
    toxic = [1, 0, 1, 0, 0, 1]
    rows = spark.createDataFrame(list(zip(toxic, texts)), "toxic int, text string").repartition(2)
    clean, bad = toxicity.bucket_counts(rows)
    sets = [
        {t.lower()[k : k + n] for n in toxicity.SIZES for k in range(len(t) - n + 1)} for t in texts
    ]
    assert clean.sum() == sum(len(s) for s, y in zip(sets, toxic) if not y)
    assert bad.sum() == sum(len(s) for s, y in zip(sets, toxic) if y)
    held_by = collections.Counter((g, y) for s, y in zip(sets, toxic) for g in s)
    assert held_by["idiot", 1] == 2 and bad.max() == 2
    ratio, _ = toxicity.log_count_ratios(np.array([1.0]), np.array([2.0]), 3, 3)
    assert ratio[0] == pytest.approx(math.log(3 / 5) - math.log(2 / 5))


def test_toxicity_on_held_out_documents(spark, sample_folder):
    folder = sample_folder.replace("sf0.01", "sf0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    held_out = held_out_by_crc(3, 1)
    model = train_toxicity(docs, labels.where(~held_out))
    rows = docs.where(held_out).join(labels, "doc_id").select("doc_id", "toxic", "text")
    found = score_toxicity(rows, model, carry=("toxic",)).collect()
    scores = {y: np.sort([r["score"] for r in found if r["toxic"] == y]) for y in (0, 1)}
    assert len(scores[1]) > 100
    # Share of pairs (toxic, clean) in the right order, and what a limit of 0.7 marks.
    assert np.searchsorted(scores[0], scores[1]).mean() / len(scores[0]) > 0.98
    assert (scores[1] >= 0.7).mean() > 0.7 and (scores[0] >= 0.7).mean() < 0.005


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 0), (2, 0), (3, 0), (7, 1), (7, 0), (8, 1), (9, None), (None, 1)], "doc_id long, toxic int"
    )
    model = train_toxicity(odd_docs, labels)
    rows = score_toxicity(odd_docs, model, carry=("lang", "kept")).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    by_id = {r["doc_id"]: r["score"] for r in rows}
    assert by_id[4] == by_id[5] and by_id[1] == by_id[2]
    assert {r["kept"] for r in rows} == {"clash"}
    assert score_toxicity(no_docs, model).count() == 0
    one_kind = train_toxicity(odd_docs, labels.where("toxic = 0"))
    for r in score_toxicity(odd_docs, one_kind).collect():
        assert r["score"] == pytest.approx(1 / 7)  # five clean rows, smoothed
    nothing = train_toxicity(no_docs, labels.limit(0))
    assert {r["score"] for r in score_toxicity(odd_docs, nothing).collect()} == {0.5}


def test_toxicity_of_bytes_that_are_no_text():
    data = np.frombuffer(b"idiot \xff\xfe fool" + "é".encode(), np.uint8)
    codes, at = toxicity.code_points(data, np.array([0, 7, len(data)]))
    assert at[-1] == len(codes) and chr(codes[-1]) == "é"
