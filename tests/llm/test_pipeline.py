"""The pipeline's own lengths and thresholds against plain Python."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline
from llm.helpers import components


def test_repeated_passage_of_51_words_goes_from_different_surroundings(spark, sample_folder):
    passage = " ".join(f"w{k:04d}" for k in range(51))
    assert 250 < len(passage) < 320
    around = [[" ".join(f"{k}{side}{i}x{k}" for i in range(40)) for side in "ab"] for k in range(3)]
    rows = [(k, f"{before} {passage} {after}") for k, (before, after) in enumerate(around)]
    rows += [(9, "nothing of this repeats")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    found = {r["doc_id"]: r for r in corpus_pipeline.repeated_strings(spark, docs, sample_folder).collect()}
    assert sorted(found) == [0, 1, 2, 9]
    for k in range(3):
        text = found[k]["text"]
        assert not any(f"w{i:04d}" in text for i in range(51))
        assert text == "".join(around[k])  # the spaces around the passage repeat with it
        assert found[k]["n_chars"] == len(text)
    assert found[9]["text"] == "nothing of this repeats"


def test_near_copies_at_five_words_and_four_in_five_go(spark, sample_folder):
    draw, rows = random.Random(8), []
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(100)]
        rows.append((len(rows), " ".join(base)))
        for edits in (1, 2, 3, 4):
            own = list(base)
            for at in draw.sample(range(0, 100, 7), edits):
                own[at] = f"e{len(rows)}"
            rows.append((len(rows), " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, sample_folder).collect())
    expected = {c for _, _, c in components(rows, 5, 80)}
    assert kept == sorted(expected)
    assert expected != {c for _, _, c in components(rows)}
