"""The text operators against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from compare import compare, connect
from fleetgauge.llm import components, html_main_text, line_dedup, minhash, mixing, packing, pitman_yor, quality_qda, quality_rules, token_files, vector_search

DDL = "doc_id long, text string, lang string, source string, n_chars long, node string, removed int, token int, n int, `key` string"
SF = "/root/testdata/sf0.001"


def documents():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choices(words, k=60) for _ in range(6)]
    texts = [None, "", " \n\t ", "one two", "ONE two", "a b c d e f\na b c d e f", "x " * 30_000, "é ß 漢 <|endoftext|> !!"]
    for b in base:
        for _ in range(5):
            copy = list(b)
            for i in rng.sample(range(60), rng.choice([0, 0, 1, 2, 6])):
                copy[i] = rng.choice(words)
            texts.append(" ".join(copy[:30]) + "\n" + " ".join(copy[30:]))
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "src1", "src2"][i % 3], 0, "n", 1, 2, 3, "k") for i, t in enumerate(texts)]
    return rows + [rows[-1], (None, "null id text here " * 20, "en", "src1", 0, "n", 1, 2, 3, "k")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DDL).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DDL)


def low(text):
    return (text or "").encode().lower().split()


def roots(n, links):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_near_duplicates(docs, none):
    rows = sorted({r[:2] for r in documents() if r[0] is not None})
    sets = [{tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if (w := low(t)) else set() for _, t in rows]
    linked = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and sets[b]]
    expected = roots(len(rows), linked)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(documents())
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), expected[r.doc_id], r.doc_id == expected[r.doc_id])
    assert minhash.near_duplicates(none).count() == 0


def test_components_stop_at_stars(spark, monkeypatch):
    """Stars take one round: on many partitions each round is thousands of tasks. Repeats, loops and both directions do not matter."""
    made = []
    write = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, name: made.append(name) or write(df, name))
    edges = [(1, n) for n in range(2, 40)] + [(50, 50), (60, 61), (61, 60), (60, 61)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 1 for n in range(1, 40)} | {60: 60, 61: 60}
    assert len(made) == 1


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}


def test_line_dedup(docs, none):
    lines = [(i, j, set(w)) for i, t in sorted({r[:2] for r in documents() if r[0] is not None and r[1]}) for j, x in enumerate(t.split("\n")) if len(set(w := low(x))) >= 5]
    later = {b[:2] for k, b in enumerate(lines) if any(100 * len(a[2] & b[2]) >= 90 * len(a[2] | b[2]) for a in lines[:k])}
    assert {tuple(r) for r in line_dedup.later_matches(docs).collect()} == later and later
    kept = line_dedup.drop_later_matches(docs, length_col="n_chars").collect()
    gone = {i for i, t, *_ in documents() if t and {(i, j) for j in range(len(t.split("\n")))} <= later}
    assert {r.doc_id for r in kept} == {r[0] for r in documents()} - gone and kept[0].node == "n"
    assert line_dedup.later_matches(none).count() == 0


def test_line_dedup_query_removes_short_repeats(spark, tmp_path):
    rows = [(1, "Home About\nx\n\na b c d e f g h i"), (2, "about home\n \na b c d e f g h i j"), (3, "a b c d " * 25 + "\nhome\nX x"), (4, "d c b a")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.removed for r in line_dedup.query(spark, str(tmp_path)).collect()}
    assert got == {1: [], 2: [0, 2], 3: [2], 4: [0]}


def test_quality_discriminant(spark, docs, none):
    labels = spark.createDataFrame([(i, int(i > 20)) for i in range(38)] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = quality_qda.classify(docs, labels).collect()
    assert len(got) == len(documents())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert {r.score for r in quality_qda.classify(docs, labels.limit(0)).collect()} == {1.0}
    assert quality_qda.classify(none, labels).count() == 0


def test_discriminant_is_the_density_ratio():
    rng = np.random.default_rng(0)
    x = [rng.normal(c, 1 + c, (400, 3)) for c in (0, 1)]
    model = quality_qda.discriminant(np.array([400.0, 400.0]), np.array([v.sum(0) for v in x]), np.array([v.T @ v for v in x]))
    p = np.array([[0.2, -0.4, 1.0]])
    logs = []
    for m, f in zip(model.means, model.factors):
        cov = np.linalg.inv(f.T @ f)
        logs.append(-0.5 * (p - m) @ np.linalg.inv(cov) @ (p - m).T - 0.5 * np.linalg.slogdet(cov)[1])
    assert model.scores(p)[0] == pytest.approx(1 / (1 + math.exp(float(logs[0][0, 0] - logs[1][0, 0]))))


def test_quality_rules(docs, none):
    for r in quality_rules.cascade(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        w = [x.decode() for x in (r.text or "").encode().split()]
        threes = Counter(zip(w, w[1:], w[2:]))
        covered = {i + d for i, x in enumerate(zip(w, w[1:], w[2:])) if threes[x] > 1 for d in range(3)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and r.kept == (r.rejected_by is None)
    backwards = quality_rules.cascade(docs, found=quality_rules.rules()[::-1])
    assert sorted(map(str, backwards.select("doc_id", "kept").collect())) == sorted(map(str, quality_rules.cascade(docs).select("doc_id", "kept").collect()))
    assert quality_rules.cascade(none).count() == 0


def test_vector_search(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.integers(-3, 4, 6) / 4], 7) for i in range(300)]
    rows += [(300, None, 7), (400, [float("nan")] * 6, 7), (500, [None] + [1.0] * 5, 7), (None, [1.0] * 6, 7), rows[5], (600, [0.0] * 6, 7), (700, [1.0], 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    x = {i: np.floor(1024 * np.array(v)).astype(int) for i, v, _ in rows if i is not None and i not in (300, 400, 500, 700)}
    expected = {(q, n + 1, i, s) for q in x if q % 100 == 0 for n, (s, i) in enumerate(sorted(((-int(x[q] @ x[i]), i) for i in x if i != q))[:10]) for s in [-s]}
    for sizes in ({}, {"group_rows": 40, "query_rows": 1}):
        assert {tuple(r) for r in vector_search.top_k(df, **sizes).collect()} == expected
    assert vector_search.top_k(df.limit(0)).count() == 0 and vector_search.top_k(df.where("vec_id IN (0, 1)")).count() == 1


def test_mixing_fills_siblings_first(spark, docs, none):
    rows = [("d0", "en", "a", 10), ("d0", "en", "b", 1000), ("d0", "de", "a", 30), ("d1", "en", "c", 5)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
    got = {tuple(r)[:3]: r.budget for r in mixing.budgets(leaves, 50, 1, mixing.LEVELS, {}).collect()}
    # of 522 tokens d1 can use 5 and its shortage goes to d0; de can use 30; a can use 10; b takes what is left
    assert got == {("d1", "en", "c"): 5, ("d0", "de", "a"): 30, ("d0", "en", "a"): 10, ("d0", "en", "b"): 477}
    taken = mixing.mix_sources(docs).collect()
    assert len(taken) == len(documents()) and {r.lang for r in taken} == {"~", "en", "de"}
    assert mixing.mix_sources(none).count() == 0


def test_packing(docs, none):
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        size, rows, k = np.sort(rng.choice(30, n, replace=False) + 1.0), rng.integers(1, 9, n) * 1.0, int(rng.integers(1, 5))
        cost = lambda ends: sum(c * min(e for e in ends if e >= s) for s, c in zip(size, rows))  # noqa: B023, E731
        best = min(cost([*e, size[-1]]) for m in range(min(k, n)) for e in itertools.combinations(size[:-1], m))
        ends = packing.bounds(size, rows, k)
        assert cost(ends) == best and len(ends) <= k
    got = packing.pack(docs, buckets=3, token_budget=200).collect()
    assert len(got) == len(documents()) == len({(r.bucket, r.batch, r.slot) for r in got})
    assert all(r.padding >= 0 and (r.slot + 1) * r.bucket_length <= max(200, r.bucket_length) for r in got)
    assert packing.pack(none).count() == 0


def test_packing_of_long_texts_is_exact(spark):
    sizes = [8200, 8300, 8330, 9000, 9090, 12000, 12200, 16000]
    rows = [(10 * i + j, "x " * (n - 1)) for i, n in enumerate(sizes) for j in range(2)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), buckets=8).collect()
    assert sorted({r.bucket_length for r in got}) == sizes and sum(r.padding for r in got) == 0


def test_language_model(docs, none):
    got = pitman_yor.lm_scores(docs, block_bytes=2_000).collect()
    rows = documents()
    train = Counter(w for i, t, *_ in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1 for w in [*low(t), 0])
    total, distinct = sum(train.values()), len(train)
    texts = dict(r[:2] for r in rows)
    assert len(got) == len(rows)
    for r in got:
        w = [*low(texts[r.doc_id]), 0]
        assert r.base_score == pytest.approx(sum(math.log10((train[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(train[x] > 0 for x in w), total) and r.score < 0
    assert pitman_yor.lm_scores(none).count() == 0


def test_language_model_tells_rare_words_of_one_class_apart(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    free = iter([i for i in range(200) if zlib.crc32(str(i).encode()) % 5 != 1])
    rows = [(i, t) for i, t in zip(held, ("pa_end qa_end", "pa_end qb_end", "new_end qb_end"))]
    rows += [(next(free), " ".join(f"w{j}" for j in range(400))) for _ in range(12)]
    rows += [(next(free), f"p{x}_end q{x}_end") for x in "ab" for _ in range(8)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got, whole = ({r.doc_id: r.score for r in pitman_yor.lm_scores(table, block_bytes=b).collect()} for b in (2_000, 1 << 20))
    assert got[held[0]] > got[held[1]] + 0.3 and got == pytest.approx(whole)


def test_language_model_keeps_few_files_and_joins_rare_words_alike(spark, monkeypatch):
    texts = [" ".join(f"w{(i * j * j + j) % 97 if j % 3 else j % 5}" for j in range(40 + i)) for i in range(60)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stored, gone, put, drop = [], [], pitman_yor.materialize, pitman_yor.discard

    def keep(df, name, **how):
        stored.append((name, put(df, name, **how)))
        return stored[-1][1]

    monkeypatch.setattr(pitman_yor, "materialize", keep)
    monkeypatch.setattr(pitman_yor, "discard", lambda *frames: (gone.extend(f.stored_at for f in frames), drop(*frames)))
    got, rare = [], []
    for frequent in (1 << 19, 20):
        monkeypatch.setattr(pitman_yor, "FREQUENT", frequent)
        stored.clear()
        got.append({r.doc_id: r.score for r in pitman_yor.lm_scores(table, block_bytes=2_000).collect()})
        rare.append(sum(name == "excess" for name, _ in stored))
        # every sweep works on cells written once, and only the answers are left when documents are scored
        assert sum(name == "cells" for name, _ in stored) == 1
        assert {name for name, f in stored if f.stored_at not in gone} == {"answers", "asked-tokens"}
    assert rare == [0, 1 + pitman_yor.BURN_IN + pitman_yor.SAMPLES] and got[0] == pytest.approx(got[1], rel=1e-12)


def test_language_model_tells_a_zero_character_from_the_end(spark):
    table = spark.createDataFrame([(i, "a \0 b") for i in range(20)], "doc_id long, text string")
    train = sum(zlib.crc32(str(i).encode()) % 5 != 1 for i in range(20))
    for r in pitman_yor.lm_scores(table).collect():
        assert r.base_score == pytest.approx(4 * math.log10((train + 0.5) / (4 * train + 0.5 * 5)))


def test_line_dedup_leaves_only_its_result_on_disk(spark, monkeypatch):
    stored, gone, put, drop = [], [], line_dedup.materialize, line_dedup.discard
    monkeypatch.setattr(line_dedup, "materialize", lambda df, name, **how: stored.append((name, how, put(df, name, **how))) or stored[-1][2])
    monkeypatch.setattr(line_dedup, "discard", lambda *frames: (gone.extend(f.stored_at for f in frames), drop(*frames)))
    line = " ".join(f"t{i}" for i in range(20))
    table = spark.createDataFrame([(1, line), (2, line), (3, line.replace("t3 ", "other ")), (4, "something else")], "doc_id long, text string")
    assert sorted(r.doc for r in line_dedup.later_matches(table).collect()) == [2, 3]
    assert all(how.get("free") for _, how, _ in stored)
    assert [name for name, _, f in stored if f.stored_at not in gone] == ["later"]


def test_class_predictions_add_up_to_one():
    counts = np.random.default_rng(3).poisson(0.02, (pitman_yor.CLASSES,) * 2) * 40
    assert np.allclose(pitman_yor.Contexts(counts).predictive().sum(axis=1), 1)


def test_token_files(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(token_files.vocabulary_path())
    token_files.write_tokens(docs, f"{tmp_path}/t", token_files.vocabulary_path())
    got = token_files.read_digests(spark, f"{tmp_path}/t").collect()
    texts, start = dict(r[:2] for r in documents()), 0
    for r in sorted(got, key=lambda r: (-1 if r.doc_id is None else r.doc_id, r.start)):
        ids = [*whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(documents())
    token_files.write_tokens(none, f"{tmp_path}/e", token_files.vocabulary_path())
    assert token_files.read_digests(spark, f"{tmp_path}/e").count() == 0


PAGE = """<html><body><header><h1>Site</h1><ul><li><a href=x>Home</a></ul></header><div class=cookie-notice>We use cookies, really.</div>
<div id="content"><h2>A  title</h2><p>First long paragraph with text, and more text. It goes on &amp; on for some time, so there.<script>var t="</p>";</script>
<p>Second one with a <b>bold</b> word; it also is fairly long and has sentences. Yes.</div><aside class="sidebar"><p>Related: a thing we wrote, once.
And again, and so on, with words.</aside><section class="comments"><p>I liked it very much, thanks for this. Great text, and so on.</section>
<form><input><label>Name</label></form><footer>Copyright &copy; us.</footer></body></html>"""
TEXT = "A title First long paragraph with text, and more text. It goes on & on for some time, so there. Second one with a bold word; it also is fairly long and has sentences. Yes."


def test_main_text(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = html_main_text.train(pages)
    assert html_main_text.main_text(PAGE, model) == TEXT
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>a &lt; b<br>c</p></article><nav><a>x</a></nav>"), (3, "u", "<p" + "<div>" * 500)]
    got = {r.page_id: (r.text, r.n_chars) for r in html_main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    assert got == {1: ("", 0), 2: ("", 0), None: ("a < b c", 7), 3: ("", 0)}
    assert html_main_text.extract(pages.limit(0), html_main_text.train(pages.limit(0))).count() == 0


def test_marginals_equal_enumeration():
    model = html_main_text.model_of({}, [[20.0, 1.0], [1.0, 20.0]])
    nodes = html_main_text.parse("<nav>a, b</nav><article><p>some text here.</p><div class=ad>x</div></article>")
    n, total, one = len(nodes), 0.0, np.zeros(len(nodes))
    for states in itertools.product((0, 1), repeat=n):
        log = model.root[states[0]]
        for i, node in enumerate(nodes):
            log += sum(model.feature[f][states[i]] for f in html_main_text.features(node) if f in model.feature)
            log += model.edge[states[node.parent]][states[i]] if node.parent >= 0 else 0
        total += math.exp(log)
        one += math.exp(log) * np.array(states)
    assert np.allclose(html_main_text.marginals(nodes, model), one / total)


@pytest.mark.parametrize("module", [mixing, quality_rules, vector_search])
def test_equals_sql(spark, module):
    for name, sql in module.ORACLE.items():
        assert compare(module.QUERIES[name](spark, SF), connect(SF), sql) is None


def test_pipeline(spark):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES][2] == "near-duplicate removal"
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    docs = whole
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "stage")
        assert docs.columns == whole.columns
    assert 0 < docs.count() < whole.count() and docs.where("n_chars <> length(text)").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
