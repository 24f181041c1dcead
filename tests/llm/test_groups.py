"""Joins, suffix arrays, searches, licences and the pipeline against plain Python or SQL."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from llm.helpers import DDL, PASSAGE, ROWS, components, without_repeats
from tallyloom.llm.adaptive_scan import nearest
from tallyloom.llm.catalog import FILES_SQL, as_files, llm_queries
from tallyloom.llm.components import connected_components
from tallyloom.llm.cover_tree import exact_top_k
from tallyloom.llm.jaccard_join import jaccard_components
from tallyloom.llm.licenses import oracle, scan_licenses
from tallyloom.llm import suffix_dedup
from tallyloom.llm.suffix_dedup import remove_repeats, spread_segments, suffix_array
from tallyloom.llm.suffix_dedup import compared_segments, segment_bytes


def edited_copies(seed, groups=6, copies=30):
    """Groups of near copies with more or fewer edited words, far and near the threshold."""
    draw, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{draw.randrange(400)}" for _ in range(draw.choice([4, 30, 120]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(draw.randrange(4)):
                own[draw.randrange(len(own))] = f"e{draw.randrange(9)}"
            rows.append((len(rows) * 3 % 997, " ".join(own)))
    return rows


@pytest.mark.parametrize("hot_list", [4, 128])
def test_jaccard_components_equal_all_pairs(spark, hot_list):
    rows = edited_copies(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = jaccard_components(docs, hot_list=hot_list).collect()
    assert sorted(map(tuple, found)) == sorted(components(rows))


def test_jaccard_odd_rows(spark, odd_docs, no_docs):
    found = jaccard_components(odd_docs).collect()
    expected = components([(r[0], r[1]) for r in ROWS])
    order = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, found), key=order) == sorted(expected, key=order)
    assert jaccard_components(no_docs).count() == 0


def test_components_of_chains_loops_and_repeats(spark):
    edges = [(k, k + 1) for k in range(60)] + [(70, 70), (81, 80), (80, 81), (82, 81)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    expected = {k: 0 for k in range(61)} | {80: 80, 81: 80, 82: 80}
    assert dict(map(tuple, found.collect())) == expected


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array_by_grouping(text):
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_removed_bytes_equal_all_windows(spark):
    draw = random.Random(2)
    texts = ["".join(draw.choice("abç d") for _ in range(draw.randrange(1500))) for _ in range(30)]
    for k in range(1, 30):
        part = texts[draw.randrange(k)]
        begin = draw.randrange(len(part) + 1)
        texts[k] += part[begin : begin + draw.choice([350, 399, 400, 401, 900])]
    texts += ["ab" * 500, "x" * 401, texts[3], texts[3], "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = remove_repeats(docs, also=(200,)).orderBy("doc_id").collect()
    got = [(r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found]
    assert got == without_repeats(texts, 400)
    assert [r["n_removed_200"] for r in found] == [r[1] for r in without_repeats(texts, 200)]


def test_passages_too_short_to_go_are_counted_as_shared(spark):
    draw = random.Random(5)

    def noise(size):
        return "".join(draw.choice("abcdé fghij") for _ in range(size))

    inside, passage, short = noise(400), noise(300), noise(110)
    texts = [noise(700) + passage + noise(90), passage + noise(20), noise(500) + short, short + noise(800)]
    texts += [inside + "-" + inside, "", None, noise(239), "y" * 300, "y" * 240 + "z"]
    texts += [noise(1000)] * 2
    docs = spark.createDataFrame([(k // 2, t) for k, t in enumerate(texts)], "doc_id long, text string")
    rows = remove_repeats(docs.repartition(3), shared=240).collect()
    found = {r["text"]: r["n_shared"] for r in rows}
    assert [found[t] > 0 for t in texts] == [True] * 2 + [False] * 6 + [True] * 4
    assert {r["text"]: (r["n_bytes"], bytes(r["kept"])) for r in rows} == {
        t: (n, kept) for t, (n, _, _, kept) in zip(texts, without_repeats(texts, 400), strict=True)
    }
    # A row counts its own strings once, however often it is there.
    assert 1 <= found[texts[-1]] <= 1200


def test_sampled_strings_do_not_depend_on_the_pieces(monkeypatch):
    data = np.random.default_rng(3).integers(97, 101, 5000).astype(np.uint8)
    whole = suffix_dedup.sampled_strings(data, 240)
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    assert suffix_dedup.sampled_strings(data, 240).tolist() == whole.tolist()
    every = {h for k in range(0, 4761) for h in suffix_dedup.sampled_strings(data[k : k + 240], 240).tolist()}
    assert every == set(whole.tolist())


def test_hot_segments_spread_like_compared_ones(spark):
    rows = [(k, f"{k} " * 30 + PASSAGE + f" {k}" * 60) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rows = docs.withColumn("mark", F.xxhash64("text")).select("doc_id", "mark", "text")
    from tallyloom.llm.suffix_dedup import all_segments

    anchors = all_segments(rows, 400).select("anchor").distinct()
    data = segment_bytes(rows, anchors, 400)

    def windows(found):
        return {
            (r["anchor"], r["segment"], w) for r in found.collect() for w in range(r["low"], r["high"])
        }

    assert windows(compared_segments(data, 400)) == windows(spread_segments(data, 400)) != set()


def test_remove_repeats_odd_rows(odd_docs, no_docs):
    clashing = (F.lit(f"clash {c}").alias(c) for c in ("segment", "run_id", "run_mark", "runs", "mark"))
    plain = odd_docs.select("doc_id", "text", *clashing)
    found = remove_repeats(plain).collect()
    assert {(r["run_id"], r["runs"], r["mark"]) for r in found} == {("clash run_id", "clash runs", "clash mark")}
    expected = without_repeats([r[1] for r in ROWS], 400)
    assert sorted(bytes(r["kept"]) for r in found) == sorted(e[3] for e in expected)
    assert remove_repeats(no_docs).count() == 0


def vectors(spark, n=700, d=8, seed=1):
    draw = np.random.default_rng(seed)
    rows = [(k, draw.standard_normal(d).round(1).tolist()) for k in range(n)]
    rows += [(n + k, rows[k][1]) for k in range(40)]  # ties
    odd = [(9001, None), (9002, [None] * d), (9003, [float("nan")] * d), (9004, [float("inf")] * d)]
    odd += [(9005, [1.0]), (None, [1.0] * d), (9010, [0.0] * d)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    return dict(rows), df.withColumn("score", F.lit("clash")).repartition(3)


def brute_top(rows, queries, k, score):
    out = []
    for q in sorted(queries):
        best = sorted(((-score(rows[q], v), i) for i, v in rows.items() if i != q))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def test_exact_top_k_equals_brute_force(spark):
    rows, df = vectors(spark)
    rows[9010] = [0.0] * 8
    scaled = {i: np.floor(64 * np.array(v)) for i, v in rows.items()}
    expected = brute_top(scaled, [i for i in rows if i % 20 == 0], 20, lambda a, b: int(a @ b))
    found = exact_top_k(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()
    assert list(map(tuple, found)) == expected


def test_adaptive_scan_recall_and_scores(spark):
    rows, df = vectors(spark)
    arrays = {i: np.array(v) for i, v in rows.items()}
    expected = brute_top(arrays, [i for i in rows if i % 20 == 0], 20, lambda a, b: float(a @ b))
    found = nearest(df, df.where("vec_id % 20 = 0")).collect()
    assert len(found) == len(expected)
    hits = {(r["query_id"], r["vec_id"]) for r in found} & {(e[0], e[2]) for e in expected}
    assert len(hits) >= 0.9 * len(expected)
    for r in found:
        assert r["score"] == pytest.approx(float(arrays[r["query_id"]] @ arrays[r["vec_id"]]), abs=1e-12)


@pytest.mark.parametrize("folder, least", [("sf0.001", 0.95), ("sf0.01", 0.95), ("sf0.1", 0.95)])
def test_adaptive_scan_recall_on_given_vectors(spark, sample_folder, folder, least):
    df = spark.read.parquet(f"{sample_folder.replace('sf0.01', folder)}/embeddings.parquet")
    rows = df.select("vec_id", "embedding").toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(np.float64)
    asked = np.flatnonzero(ids % 20 == 0)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :20]
    expected = {(ids[q], ids[b]) for q, line in zip(asked, best) for b in line}
    found = nearest(df, df.where("vec_id % 20 = 0")).collect()
    pairs = {(r["query_id"], r["vec_id"]) for r in found}
    assert len(found) == len(expected) and len(pairs & expected) >= least * len(expected)
    if folder == "sf0.01":
        again = nearest(df.repartition(13), df.where("vec_id % 20 = 0").repartition(5)).collect()
        assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def with_copies(spark, seed=3):
    """Rows with a near candidate repeated 60 times and one id with three vectors."""
    draw = np.random.default_rng(seed)
    rows = [(k, draw.standard_normal(8).round(1).tolist()) for k in range(200)]
    rows += [(0, rows[0][1])] * 60 + [(1, [4.0] * 8), (1, [3.0] * 8)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)


@pytest.mark.parametrize("search, scale", [(exact_top_k, 64), (nearest, 1)])
def test_repeated_candidates_take_one_place(spark, search, scale):
    rows, df = with_copies(spark)
    cut = np.floor if scale > 1 else np.array
    candidates = {(i, tuple(cut(scale * np.array(v)))) for i, v in rows}
    queries = spark.createDataFrame([(900, rows[0][1])], "vec_id long, embedding array<double>")
    query = cut(scale * np.array(rows[0][1]))
    expected = sorted(((-float(query @ np.array(v)), i) for i, v in candidates))[:20]
    more = {} if search is exact_top_k else {"recall": 1.0}
    found = search(df, queries, **more).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in found] == [(n + 1, i) for n, (_, i) in enumerate(expected)]
    assert [r["score"] for r in found] == pytest.approx([-s for s, _ in expected])


def test_searches_without_rows_or_with_few(spark):
    _, df = vectors(spark)
    empty = df.limit(0)
    few = df.where("vec_id in (0, 1, 2)")
    for search in (exact_top_k, nearest):
        assert search(empty, empty).count() == 0
        assert search(df, empty).count() == 0
        assert search(few, few.where("vec_id = 0")).count() == 2


def test_licences_equal_their_sql(sample_docs):
    files = as_files(sample_docs)
    connection = duckdb.connect()
    documents = sample_docs.select("doc_id", "source", "text").toPandas()  # noqa: F841
    expected = connection.sql(oracle(FILES_SQL)).fetchall()
    assert sorted(map(tuple, scan_licenses(files).collect()), key=str) == sorted(expected, key=str)
    assert {e[3] for e in expected} == {"header", "inherited", "none"}


def test_nearest_licence_file_counts(spark, no_docs):
    files = [
        (1, "a/LICENSE", "Released under the MIT License."),
        (2, "a/b/COPYING", "Licensed under the Apache License, Version 2.0.\nmore"),
        (3, "a/x.txt", "text"),
        (4, "a/b/c/d/y.txt", "text"),
        (5, "a/b/z.txt", "Licensed under CC BY-NC 4.0."),
        (6, "q/x.txt", None),
        (7, None, "text"),
        (8, "a/x.txt", ""),
        (8, "a/x.txt", ""),
    ]
    df = spark.createDataFrame(files, "doc_id long, path string, text string")
    found = sorted((r["doc_id"], r["license"] or "", r["origin"]) for r in scan_licenses(df).collect())
    assert found == [
        (1, "MIT", "header"),
        (2, "Apache-2.0", "header"),
        (3, "MIT", "inherited"),
        (4, "Apache-2.0", "inherited"),
        (5, "CC-BY-NC-4.0", "header"),
        (6, "", "none"),
        (7, "", "none"),
        (8, "MIT", "inherited"),
        (8, "MIT", "inherited"),
    ]
    assert scan_licenses(df.limit(0)).count() == 0


def test_licence_plan_is_native(sample_docs):
    plan = scan_licenses(as_files(sample_docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_stages_take_effect(spark, sample_folder):
    docs = spark.read.parquet(f"{sample_folder}/documents.parquet")
    kinds, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sample_folder).cache()
        assert docs.columns == kinds, name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[1] < sizes[0] and sizes[3] < sizes[2]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sample_folder)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in rows}


def test_pipeline_stages_survive_odd_rows(spark, odd_docs, no_docs, sample_folder):
    for docs in (odd_docs, no_docs):
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, sample_folder)
            assert found.columns == docs.columns, name
            found.count()
        corpus_pipeline.packing(spark, docs, sample_folder).count()


def test_one_document_of_each_group_stays(spark, sample_folder):
    docs = spark.createDataFrame([r for r in ROWS if r[0] is not None], DDL)
    kept = corpus_pipeline.near_duplicates(spark, docs, sample_folder).collect()
    expected = {c for _, _, c in components([(r[0], r[1]) for r in ROWS if r[0] is not None])}
    assert sorted(r["doc_id"] for r in kept) == sorted(expected)


def test_every_operator_has_its_query():
    names = {int(name[2:].split("_")[0]) for name in llm_queries()}
    assert names == set(range(1, 11))
