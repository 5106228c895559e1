"""Near-duplicate documents by minima of universal hashes, banding and checks on full shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import GOLDEN, Memo, materialize, mix, table, words_of
from fleetgauge.llm.components import connected_components

WORDS, BANDS, ROWS = 5, 32, 4
#: A pair is dropped without a look at its sets if fewer than this share of its minima agree. At a similarity of 0.75
#: the share has a standard deviation of 0.04, so a true pair is over four deviations away from it.
AGREE = 0.58
#: Nodes of a mixed bucket that all others are compared with before what is left is looked at in full.
HEADS = 6
#: Shingles hashed at a time.
BLOCK = 1 << 15
SEED = 20_240_601


def universal(n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """``n`` functions x -> a*x + b over 64-bit words, a odd."""
    drawn = np.random.default_rng(seed).integers(0, 2**64, (2, n), dtype=np.uint64)
    return drawn[0] | np.uint64(1), drawn[1]


def shingles(words: np.ndarray, width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    width_now = min(width, len(words))
    last = len(words) - width_now + 1
    total = np.full(last, width_now, dtype=np.uint64)
    for i in range(width_now):
        total = total * GOLDEN + words[i : last + i]
    return np.unique(mix(total))


def word_hashes() -> Memo:
    return Memo(lambda w: xxhash.xxh3_64_intdigest(w))


def shingle_set(text: str | None, memo: Memo, width: int = WORDS) -> np.ndarray:
    words = words_of(text)
    return shingles(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)), width)


def minima(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest value of every function over every (non-empty) set; sets are taken in blocks."""
    out, first = np.empty((len(sets), len(a)), np.uint64), 0
    while first < len(sets):
        last, size = first + 1, len(sets[first])
        while last < len(sets) and size + len(sets[last]) <= BLOCK:
            size += len(sets[last])
            last += 1
        x = np.concatenate(sets[first:last])
        starts = np.cumsum([0] + [len(s) for s in sets[first : last - 1]])
        buffer = np.empty_like(x)
        for k in range(len(a)):
            np.multiply(x, a[k], out=buffer)
            np.add(buffer, b[k], out=buffer)
            out[first:last, k] = np.minimum.reduceat(buffer, starts)
        first = last
    return out


def _signatures(width: int, bands: int, rows: int):
    def run(batches):
        a, b = universal(bands * rows)
        memo = word_hashes()
        for batch in batches:
            sets = [shingle_set(t, memo, width) for t in batch.column("__text").to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            keys, signs = [None] * len(sets), [None] * len(sets)
            if full:
                values = minima([sets[i] for i in full], a, b)
                key = np.zeros((len(full), bands), np.uint64)
                for r in range(rows):
                    key = mix(key * GOLDEN + values[:, r::rows] + np.uint64(1))
                short = (values >> np.uint64(32)).astype(np.uint32)
                for j, i in enumerate(full):
                    keys[i], signs[i] = key[j].astype(np.int64), short[j].tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
                    pa.array([int.from_bytes(d[8:], "little", signed=True) for d in digests], pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(signs, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "bands", "signature"],
            )

    return run


def _sets(width: int):
    def run(batches):
        memo = word_hashes()
        for batch in batches:
            sets = [shingle_set(t, memo, width).tobytes() for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return run


def _exploded(batches):
    for batch in batches:
        sizes = [len(s.as_buffer()) // 8 for s in batch.column("shingles")]
        nodes = np.repeat(batch.column("node").to_numpy(), sizes)
        values = np.frombuffer(b"".join(batch.column("shingles").to_pylist()), np.int64)
        for at in range(0, len(nodes), 1 << 17):
            part = slice(at, at + (1 << 17))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[part]), pa.array(values[part]), pa.array(np.repeat(sizes, sizes)[part])], names=["node", "shingle", "n"]
            )


def _bitmaps(batches):
    for batch in batches:
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in batch.column("shingles")]
        odd = np.array([np.bincount((s & np.uint64(511)).astype(np.int64), minlength=512) & 1 for s in sets], np.uint8).reshape(len(sets), 512)
        bits = np.packbits(odd, axis=1).view(np.int64)
        columns = [batch.column("node"), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(np.ascontiguousarray(bits[:, i])) for i in range(8))]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "n", *(f"b{i}" for i in range(8))])


def _agreeing(least: float):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for c in ("s", "t"))
            keep = (x == y).mean(axis=1) >= least
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return run


def _confirmed(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for s, t in zip(batch.column("s"), batch.column("t")):
                x, y = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _with_both(pairs: DataFrame, side: DataFrame, column: str) -> DataFrame:
    """Pairs with the column of both ends."""
    s = side.select(F.col("node").alias("a"), F.col(column).alias("s"))
    t = side.select(F.col("node").alias("b"), F.col(column).alias("t"))
    return pairs.join(s, "a").join(t, "b").select("a", "b", "s", "t")


def _possible(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket's nodes in different components that counts do not rule out.

    Only shingles that some other node has too can be common, so the intersection is at most the smaller number of such
    shingles, and it must reach percent / (100 + percent) of the sum of sizes. And of bitmaps that hold the parity of the
    shingles of each of 512 cells, at most as many bits differ as shingles do. No linked pair is ruled out.
    """
    here = sets.join(left.select("node").distinct(), "node", "left_semi")
    exploded = here.mapInArrow(_exploded, "node long, shingle long, n long")
    alone = exploded.groupBy("shingle").agg(F.count("*").alias("__c"), F.min("node").alias("node")).where("__c = 1")
    unique = alone.groupBy("node").agg(F.count("*").alias("unique"))
    cells = [f"b{i}" for i in range(8)]
    counted = here.mapInArrow(_bitmaps, f"node long, n long, {', '.join(f'{c} long' for c in cells)}").join(unique, "node", "left")
    counted = counted.select("node", "n", (F.col("n") - F.coalesce("unique", F.lit(0))).alias("common"), *cells)
    rows = materialize(left.join(counted, "node"), "possible")
    x, y = rows.alias("x"), rows.alias("y")
    reach = F.least("x.common", "y.common") * (100 + percent) >= percent * (F.col("x.n") + F.col("y.n"))
    differ = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in cells), F.lit(0))
    near = differ * (100 + percent) <= (100 - percent) * (F.col("x.n") + F.col("y.n"))
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component")) & reach & near)
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, width: int = WORDS, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Groups of near-duplicate documents: one row per input row.

    Columns ``doc_id``, ``n_shingles``, ``component_id`` (smallest id of the group) and ``kept`` (the row has that id).
    Two documents are linked if 100 * |intersection| >= ``percent`` * |union| of their sets of ``width``-word shingles;
    links are found by ``bands`` bands of ``rows`` minima (a pair at 0.75 shares no band with a probability of 5e-6),
    thinned by the signatures and confirmed on the full sets.

    Hot groups: equal sets are one node from the start. A band bucket gives the pairs of its smallest node with all
    others; a bucket whose nodes are not yet one component gives the pairs with a few nodes drawn by a hash; then only
    pairs of nodes in *different* components are left, thinned by a count of shingles that another node has too. Nothing
    is capped, and a bucket that is one group never makes all its pairs.

    Null or blank texts have an empty set and stay alone. Rows with the same id are the same document. A row whose id is
    null stays alone, with a null component, and is kept. Other columns are ignored; an empty table gives no rows.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
    signed = materialize(
        slim.mapInArrow(
            _signatures(width, bands, rows),
            "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, signature binary",
        ),
        "signatures",
    )
    full = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"))
    members = full.select("doc_id", "d1", "d2").join(classes, ["d1", "d2"]).where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    nodes = full.join(classes.withColumnRenamed("node", "doc_id"), ["d1", "d2", "doc_id"], "left_semi").select(F.col("doc_id").alias("node"), "signature", "bands")
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key")).select("node", F.xxhash64("band", "key").alias("key"))
    heads = banded.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("__last")).where("head < __last").drop("__last")
    shared = materialize(banded.join(heads, "key"), "buckets")
    signs = nodes.select("node", "signature")
    needed = shared.select(F.col("node").alias("__id")).distinct()
    sets = materialize(slim.join(needed, "__id", "left_semi").mapInArrow(_sets(width), "node long, shingles binary"), "sets")

    def links(pairs: DataFrame) -> DataFrame:
        likely = _with_both(pairs, signs, "signature").mapInArrow(_agreeing(AGREE), "a long, b long").distinct()
        return _with_both(likely, sets, "shingles").mapInArrow(_confirmed(percent), "a long, b long")

    first = materialize(members.union(links(shared.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct())), "links")
    def placed(found: DataFrame) -> DataFrame:
        """Bucket rows with components, for buckets whose nodes are in several."""
        rows = shared.select("key", "node").join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
        several = rows.groupBy("key").agg(F.min("component").alias("__l"), F.max("component").alias("__h")).where("__l < __h").select("key")
        return rows.join(several, "key", "left_semi")

    found = materialize(connected_components(first), "components")
    left = materialize(placed(found), "mixed")
    if not left.isEmpty():
        rank = [F.xxhash64("node", F.lit(k)) for k in range(HEADS)]
        heads = left.groupBy("key").agg(*[F.min_by(F.struct("node", "component"), r).alias(f"h{k}") for k, r in enumerate(rank)])
        heads = heads.select("key", F.explode(F.array(*[f"h{k}" for k in range(HEADS)])).alias("h")).distinct()
        again = left.join(heads, "key").where("component <> h.component").select(F.col("node").alias("a"), F.col("h.node").alias("b")).distinct()
        more = materialize(links(again), "links")
        if not more.isEmpty():
            found = materialize(connected_components(found.union(more)), "components")
            left = materialize(placed(found), "mixed")
    if not left.isEmpty():
        rest = materialize(links(_possible(left, sets, percent)), "links")
        if not rest.isEmpty():
            found = materialize(connected_components(found.union(rest)), "components")
    return (
        signed.join(found.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the smallest id of every group, with all their columns. Rows with a null id stay."""
    gone = near_duplicates(docs, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[id_col] == F.col("__gone"), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op1_minhash_near_dedup": query}
ORACLE: dict[str, str] = {}
