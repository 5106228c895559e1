"""Repeated windows, filter interactions and source divergence against plain Python on small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from fleetgauge.llm import filter_audit, repeated_windows, source_divergence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- windows -----------------------------------------------------------------------------------------------------------


def plain_windows(rows, k=repeated_windows.WINDOW):
    """Every row's words that stay; a window goes if its words start earlier by (id, place)."""
    first: dict = {}
    key = lambda i: repeated_windows.NULL_ID if i is None else i
    split = [(key(i), WORD.findall(text or "")) for i, text in rows]
    for i, words in split:
        for at in range(len(words) - k + 1):
            window = tuple(words[at : at + k])
            first[window] = min(first.get(window, (i, at)), (i, at))
    out = []
    for (original, _), (i, words) in zip(rows, split):
        gone = set()
        for at in range(len(words) - k + 1):
            if first[tuple(words[at : at + k])] < (i, at):
                gone.update(range(at, at + k))
        out.append((original, len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone)))
    return Counter(out)


def window_rows(spark, rows, extra=False):
    schema = "doc_id long, text string" + (", tag string, windows int, packed int, bucket int" if extra else "")
    rows = [(*r, "x", 1, 2, 3) for r in rows] if extra else rows
    found = repeated_windows.drop_repeated_windows(spark.createDataFrame(rows, schema)).collect()
    return Counter(tuple(r) for r in found)


def sample_texts(seed=5, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Ünïcode", "中文", "A", "a"]
    passages = [[rng.choice(words) for _ in range(rng.choice([15, 20, 26, 60]))] for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randrange(30))] for _ in range(rng.randrange(5))]
        texts.append(rng.choice([" ", "  ", "\n", "\t "]).join(w for p in parts for w in p))
    return texts


def test_windows_equal_brute_force(spark):
    texts = sample_texts()
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i % 7]) for i in range(20)]  # copies
    rows += [(3, texts[4]), (3, texts[4]), (None, texts[2]), (None, texts[8]), (None, None), (-5, texts[1])]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "a " * 500), (204, " ".join(["b c"] * 300)), (205, "one two")]
    random.Random(1).shuffle(rows)
    assert window_rows(spark, rows, extra=True) == plain_windows(rows)


def test_windows_dealt_out_singly_and_in_small_blocks(spark, monkeypatch):
    """Hot minimisers, many blocks, slices within a text and uncompressed strings give the same rows."""
    monkeypatch.setattr(repeated_windows, "LEAST_HOT", 3)
    rows = [(i, t) for i, t in enumerate(sample_texts(6))] + [(70 + i, sample_texts(6)[i % 3]) for i in range(30)]
    assert window_rows(spark, rows) == plain_windows(rows)
    assert sum(plain_windows(rows).values()) == len(rows)


def test_long_text_in_slices(monkeypatch):
    """A text of several slices has the runs of a text of one slice, but for cuts at the borders of slices."""
    import pyarrow as pa

    words = [f"v{random.Random(2).randrange(10**6)}"] * 3 + [f"v{i % 211}" for i in range(1_000)]
    part = pa.RecordBatch.from_arrays([pa.array([b" ".join(w.encode() for w in words) + b"\n"])], names=["text"])

    def windows():
        return [int(s) + k for *_, starts, _, sizes in repeated_windows._runs(part) for s, n in zip(starts, sizes) for k in range(int(n))]

    whole = windows()
    monkeypatch.setattr(repeated_windows, "SLICE_WORDS", 64)
    assert windows() == whole == list(range(len(words) - repeated_windows.WINDOW + 1))


def test_equal_hashes_are_settled_by_the_bytes():
    hashes = np.array([7, 7, 7, 7, 9], np.uint64)
    content = [b"x", b"y", b"x", b"y", b"z"]
    flags = repeated_windows.later(hashes, np.array([1, 2, 3, 1, 0]), np.array([0, 0, 0, 5, 0]), content.__getitem__)
    assert flags.tolist() == [False, True, True, False, False]


def test_windows_of_an_empty_table(spark):
    assert window_rows(spark, []) == Counter()


# --- filters -----------------------------------------------------------------------------------------------------------


def plain_audit(docs, labels):
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1} for k in (0, 1))
    least: dict = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    judged = []
    for i, text, source in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = ""
        fails += "A" if len(words) < 50 else ""
        fails += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
        fails += "D" if re.search(r"[#$%&*|]", text) else ""
        fails += "E" if i is not None and least[text] < i else ""
        judged.append((source or "", fails, i is not None and i in good, i is not None and i in toxic))
    out = {}
    for part in {j[0] for j in judged}:
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                c = Counter()
                for source, fails, is_good, is_toxic in judged:
                    if source != part:
                        continue
                    gone = any(x in fails for x in order[: step - 1])
                    c["kept"] += not gone and letter not in fails
                    c["removed"] += not gone and letter in fails
                    c["redundant"] += gone and letter in fails
                    c["unique_fails"] += fails == letter
                    c["good_lost"] += not gone and letter in fails and is_good
                    c["toxic_lost"] += not gone and letter in fails and is_toxic
                out[part, "".join(order), step] = [c[m] for m in filter_audit.MEASURES]
    shapley = Counter()
    for (part, order, step), values in out.items():
        shapley[part, order[step - 1]] += values[1]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows(spark, docs, labels):
    left = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, source string, mask int, good int")
    right = spark.createDataFrame([(*x, "s") for x in labels], "doc_id long, quality int, toxic int, source string")
    rows = filter_audit.interactions(left, right).collect()
    found = {(r["part"], r["filter_order"], r["step"]): (*(r[m] for m in filter_audit.MEASURES), r["shapley"]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_filter_audit_equals_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(90)] + ["LOUD", "50%", "a|b"]
    docs = []
    for i in range(80):
        pool = vocabulary[: rng.choice([8, 60, 90, 93])]
        docs.append((i, " ".join(rng.choice(pool) for _ in range(rng.choice([10, 49, 50, 80]))), rng.choice(["s1", "s2", None, ""])))
    docs += [(100 + i, docs[i % 5][1], "s1") for i in range(12)]  # copies
    docs += [(7, docs[7][1], "s2"), (7, "other words", "s1"), (None, docs[3][1], "s1"), (None, None, "s2"), (200, "", "s3"), (201, None, "s3"), (202, "É" * 9, "s3")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 110, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    assert audit_rows(spark, docs, labels) == plain_audit(docs, labels)


def test_filter_audit_of_empty_tables(spark):
    assert audit_rows(spark, [], []) == {}
    found = audit_rows(spark, [(1, "x", "s")], [])
    assert len(found) == 600 and found["s", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


# --- divergence --------------------------------------------------------------------------------------------------------


def plain_divergence(docs, top=source_divergence.TOP):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}
    counts, holders, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = [t.translate(lower) for t in term.findall(text or "")]
        counts[lang, source].update(found)
        holders[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in holders[lang].items() if n >= 3]
        own = {g: counts[g] for g in groups if g[0] == lang}
        total = Counter()
        for c in own.values():
            total.update(c)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {g[1]: shares(c) for g, c in own.items()}, shares(total)
        f = lambda a, b: (a - b) * (a - b) // b
        for source in p:
            pairs = [(h, sum(f(p[source][t], p[h][t]) for t in kept)) for h in p if h != source]
            terms = [(t, f(p[source][t], q[t])) for t in kept if own[lang, source][t] and p[source][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(found[:most], 1)]
    return sorted(out)


def divergence_rows(spark, docs, **options):
    frame = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "lang string, source string, text string, term string, n int, block int")
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in source_divergence.divergence(frame, **options).collect())


def sample_docs(seed=3, sources=9):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("x", "Y", "é", "ß", "İ", "中")] + ["don't", "x-1y", "123"]
    docs = []
    for _ in range(150):
        lang, source = rng.choice(["en", "de", None]), f"s{rng.randrange(sources)}"
        low = rng.randrange(30)
        docs.append((lang, source, " ".join(rng.choice(words[low : low + 25]) for _ in range(rng.randrange(60)))))
    docs += [("en", None, "axe"), ("en", "empty", None), ("fr", "a", "un deux"), ("fr", "b", None), ("solo", "only", "x x x"), docs[0], docs[0]]
    return docs


def test_divergence_equals_brute_force(spark):
    docs = sample_docs()
    assert divergence_rows(spark, docs) == plain_divergence(docs)


@pytest.mark.parametrize("groups, terms", [(2, 7), (3, 1_000)])
def test_divergence_in_many_cells(spark, monkeypatch, groups, terms):
    monkeypatch.setattr(source_divergence, "GROUP_BLOCK", groups)
    monkeypatch.setattr(source_divergence, "TERM_BLOCK", terms)
    docs = sample_docs(4)
    assert divergence_rows(spark, docs, top=5) == plain_divergence(docs, top=5)


def test_divergence_of_an_empty_table(spark):
    assert divergence_rows(spark, []) == []
