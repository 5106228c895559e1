"""Pipeline stages on repeated rows, nulls, clashing names and empty tables; vectors of any size."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from fleetgauge.llm import mixing, quality_qda, vector_search

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_mixing_keeps_as_many_equal_rows_as_it_takes(spark):
    rows = [(1, "one two three four five", "en", "src1", 0)] * 40
    docs = spark.createDataFrame(rows, DDL)
    taken = mixing.mix_sources(docs, mixing.STAGE_PERCENT, 1).where("copies = 1").count()
    kept = bag(mixing.keep_mixed(docs))
    assert taken == 36 and kept == Counter({rows[0]: 36})


def test_mixing_tells_rows_of_one_id_apart(spark):
    rows = [(i % 7 if i % 5 else None, f"text {i % 11} " * (i % 9), ["en", None][i % 2], f"src{i % 3}", i) for i in range(60)]
    rows += rows[:10]
    kept = bag(mixing.keep_mixed(spark.createDataFrame(rows, DDL)))
    whole = Counter(rows)
    assert all(n <= whole[r] for r, n in kept.items())
    left, all_words = sum(len(r[1].split()) * n for r, n in kept.items()), sum(len(r[1].split()) for r in rows)
    assert left >= all_words * mixing.STAGE_PERCENT // 100
    assert left < all_words


def test_classifier_judges_rows_not_ids(spark):
    rng = random.Random(2)
    good = lambda: " ".join(f"word{rng.randrange(300)}" for _ in range(80)) + ".\n"
    bad = lambda: "BUY NOW!!! $$$ " * 30
    rows = [(i, good() if i % 2 else bad(), "en", "s", 0) for i in range(200)]
    mixed = [(1_000, good(), "en", "s", 0), (1_000, bad(), "en", "s", 0), (None, good(), "en", "s", 0), (None, bad(), "en", "s", 0)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    kept = bag(quality_qda.keep_good(spark.createDataFrame(rows + mixed + mixed[:1], DDL), labels))
    assert kept[mixed[0]] == 2 and kept[mixed[2]] == 1
    assert mixed[1] not in kept and mixed[3] not in kept


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stages_on_nulls_repeats_and_empty_tables(spark, tmp_path, number):
    name, stage = corpus_pipeline.STAGES[number]
    text = "alpha beta gamma delta epsilon zeta eta theta " * 3
    rows = [(1, text, "en", "s1", 9), (1, text, "en", "s1", 9), (1, "another text with other words", None, None, None)]
    rows += [(None, None, None, None, None), (2, "", "en", "s1", 0), (3, " \n ", "de", "s2", 3), (4, "x " * 20_000, "de", "s2", 1), (5, "five\n" * 9, "de", "s2", 1)]
    spark.createDataFrame([(i, 1, 0) for i in range(6)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = stage(spark, spark.createDataFrame(rows, DDL), str(tmp_path))
    empty = stage(spark, spark.createDataFrame([], DDL), str(tmp_path))
    assert found.schema == empty.schema and empty.count() == 0
    if number < len(corpus_pipeline.STAGES) - 1:
        assert [f.simpleString() for f in found.schema] == [f.simpleString() for f in spark.createDataFrame([], DDL).schema]
    assert 0 < found.count() <= len(rows)


def test_large_components_rank_exactly(spark):
    """Components far beyond 32 bits; scores beyond 64 bits are the nearest 64-bit integer."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 6, 12]) for _ in range(6)]) for i in range(300)]
    rows += [(1_000, [3e6] * 6), (1_001, [1e15] * 6), (1_002, [3e6 + 1] * 6), (1_003, [float("inf")] + [0.0] * 5)]
    found = vector_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    whole = {i: [int(np.floor(1024 * c)) for c in v] for i, v in rows if all(map(np.isfinite, v))}
    clip = lambda s: max(-(2**63 - 1), min(2**63 - 1, s))
    want = set()
    for q in (i for i in whole if i % 100 == 0):
        scored = sorted((-clip(sum(a * b for a, b in zip(whole[q], v))), i) for i, v in whole.items() if i != q)[:10]
        want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)}
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found} == want
