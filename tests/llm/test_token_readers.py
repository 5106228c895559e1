"""Selective reads of token files, what the footers say, and pieces by either expression."""

from __future__ import annotations

import glob
import random

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetgauge.llm import token_files


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    rng = random.Random(3)
    words = ["alpha", "beta", "Ünï", "don't", "12", "  ", "\n", "中文", "…", "x" * 30]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(3_000)]
    rows += [(7, "second text of seven"), (7, "second text of seven"), (None, "no id"), (3_001, None)]
    out = f"{tmp_path_factory.mktemp('tokens')}/t"
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), out, token_files.vocabulary_path())
    return rows, out


def whole_ids(text):
    return [*token_files.Encoder(token_files.vocabulary_path()).whole.encode(text or "", add_special_tokens=False).ids, 0]


def test_chosen_documents(spark, written):
    rows, out = written
    chosen = [5, 7, 2_999, 9_999]
    for ids in (chosen, spark.createDataFrame([(i,) for i in chosen], "id long")):
        got = sorted((r["doc_id"], r["tokens"]) for r in token_files.read_tokens(spark, out, ids).collect())
        assert got == sorted((i, whole_ids(t)) for i, t in rows if i in chosen)
    plan = token_files.read_tokens(spark, out, chosen)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id, [" in plan


def test_lengths_without_tokens(spark, written):
    rows, out = written
    df = token_files.read_lengths(spark, out)
    assert "tokens:array" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == len(rows)


def test_footers(written):
    for path in glob.glob(f"{written[1]}/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
        tokens = next(c for name, c in columns.items() if name.startswith("tokens"))
        assert "RLE_DICTIONARY" in tokens.encodings
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and "DELTA_BINARY_PACKED" in columns["n_tokens"].encodings
        assert all(c.has_offset_index for c in columns.values()) and columns["doc_id"].has_column_index


def test_starts_follow_the_files(spark, written):
    """Rows of one id with different texts: each start is the sum of what lies before the row in the files."""
    _, out = written
    starts, place = {}, 0
    for r in sorted(spark.read.parquet(out).collect(), key=lambda r: (r["shard"], r["row"])):
        starts.setdefault(place, len(r["tokens"]))
        assert len(r["tokens"]) == r["n_tokens"]
        place += r["n_tokens"]
    found = token_files.read_digests(spark, out).collect()
    assert {r["start"]: r["n_tokens"] for r in found} == starts and len(found) == len(starts)


ENCODER = token_files.Encoder(token_files.vocabulary_path())


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=token_files.NARROW - 1), max_size=60))
def test_both_expressions_cut_the_same_pieces(text):
    assert ENCODER.narrow(text) == ENCODER.wide(text)
    assert not ENCODER.beyond(text)


def test_every_narrow_character():
    for i in range(token_files.NARROW):
        for text in (chr(i), f"a{chr(i)}1", f" {chr(i)} {chr(i)}", f"{chr(i)}{chr(i)}\n"):
            assert ENCODER.narrow(text) == ENCODER.wide(text) and ENCODER.ids(text).tolist() == ENCODER.whole.encode(text).ids
    assert ENCODER.beyond("a中")
