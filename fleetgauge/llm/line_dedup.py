"""Removal of lines that match an earlier line: exact set-similarity join with prefix, position and length filters."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import discard, materialize, table, words_of

#: Lines match if 100 * |intersection| >= PERCENT * |union| of their sets of lower-case words.
PERCENT = 90
#: Floor of distinct words for callers that leave shorter lines alone, as a few words repeat by chance. The query has none.
MIN_WORDS = 5
#: Token counts (whole corpus) are kept by so many hash cells: a table of fixed size. Any order of tokens gives the exact result.
CELLS = 1 << 18
#: Distinct tokens counted at a time: a table that stays in the processor's cache.
COUNTED = 1 << 16
#: Tokens handled at a time, and lines of one token beyond which drawn lines are compared first.
BLOCK, HEAVY, HEADS = 1 << 18, 32, 6
#: Longs of the bitmap of a line.
LONGS = 3
#: Lines to verify whose numbers are broadcast by document.
WANTED_LINES = 400_000


def _counts(batches):
    """Occurrences of tokens in whole texts, by hash cell."""
    total, found = np.zeros(CELLS, np.int64), Counter()

    def add():
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
        np.add.at(total, (h & np.uint64(CELLS - 1)).astype(np.int64), np.fromiter(found.values(), np.int64, len(found)))
        found.clear()

    for batch in batches:
        for text in batch.column("__text").to_pylist():
            found.update(words_of(text))
            if len(found) >= COUNTED:
                add()
    add()
    cells = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total[cells])], names=["cell", "n"])


def _blocks(batches, least: int, ranks: np.ndarray):
    """Distinct tokens of lines, by line, rarity and hash: ids, line numbers, line of each token, hashes."""
    for batch in batches:
        ids, numbers, lengths, words = [], [], [], []

        def done():
            h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
            line = np.repeat(np.arange(len(ids), dtype=np.uint64), lengths)
            rank = ranks[(h & np.uint64(CELLS - 1)).astype(np.int64)]
            # one key of line, rank and upper hash bits sorts all; if it ties different hashes, all of them decide
            if len(ids) < 1 << 24:
                key = (line << np.uint64(40)) | (rank << np.uint64(22)) | (h >> np.uint64(42))
                order = np.argsort(key)
                tied = key[order[1:]] == key[order[:-1]]
            if len(ids) >= 1 << 24 or (tied & (h[order[1:]] != h[order[:-1]])).any():
                order = np.lexsort((h, rank, line))
            h, line = h[order], line[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
            return np.array(ids, np.int64), np.array(numbers, np.int32), line[new].astype(np.int64), h[new]

        for doc, text in zip(batch.column("__id").to_pylist(), batch.column("__text").to_pylist()):
            if doc is None or not text:
                continue
            for number, line in enumerate(text.encode("utf-8", "surrogatepass").lower().split(b"\n")):
                own = line.split()
                if len(own) >= least:
                    ids.append(doc)
                    numbers.append(number)
                    lengths.append(len(own))
                    words += own
            if len(words) >= BLOCK:
                yield done()
                ids, numbers, lengths, words = [], [], [], []
        if words:
            yield done()


def _prefixes(least: int, percent: int, shared):
    """Lines with size, digest, bitmap and those tokens of their prefix that occur more than once in the corpus.

    Tokens are the upper halves of their hashes: two words of equal half only make more candidates. Tokens that occur once
    come first in the order, so those kept are the end of the prefix and their places follow from the line's size.
    """

    def run(batches):
        counts = shared.value
        ranks = np.empty(CELLS, np.uint64)
        ranks[np.argsort(counts, kind="stable")] = np.arange(CELLS, dtype=np.uint64)
        for ids, numbers, line, h in _blocks(batches, least, ranks):
            n = np.bincount(line, minlength=len(ids))
            ends = np.cumsum(n)
            starts = ends - n
            raw = memoryview(h.tobytes())
            digests = [xxhash.xxh3_128_digest(raw[8 * s : 8 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
            digest = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            place = (h >> np.uint64(40)) % np.uint64(64 * LONGS)
            bit, part = np.uint64(1) << (place % np.uint64(64)), place // np.uint64(64)
            bits = [np.bitwise_xor.reduceat(np.where(part == i, bit, np.uint64(0)), starts).view(np.int64) for i in range(LONGS)]
            at = np.arange(len(h)) - starts[line]
            taken = n - (percent * n + 99) // 100 + 1
            # below this size one word more is too many: such a line matches equal sets alone, which are grouped by digest
            keep = (at < taken[line]) & (100 * n >= percent * (n + 1))[line] & (counts[(h & np.uint64(CELLS - 1)).astype(np.int64)] > 1)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(line[keep], minlength=len(ids)))]).astype(np.int32)
            use = n >= least
            columns = [
                pa.array(ids), pa.array(numbers), pa.array(n.astype(np.int32)), *(pa.array(np.ascontiguousarray(digest[:, i])) for i in range(2)),
                *map(pa.array, bits),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array((h[keep] >> np.uint64(32)).astype(np.uint32).view(np.int32))),
            ]
            names = ["doc", "line", "n", "d1", "d2", *(f"b{i}" for i in range(LONGS)), "tokens"]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(use))

    return run


def _sets(batches):
    for batch in batches:
        docs, lines, sets = [], [], []
        for doc, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("__id", "__text", "wanted"))):
            parts = text.split("\n")
            for i in wanted:
                if i < len(parts):
                    own = {xxhash.xxh3_64_intdigest(w) for w in words_of(parts[i])}
                    docs.append(doc)
                    lines.append(i)
                    sets.append(np.sort(np.fromiter(own, np.uint64, len(own))).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(lines, pa.int32()), pa.array(sets, pa.binary())], names=["doc", "line", "words"])


def _verified(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for s, t in zip(batch.column("s"), batch.column("t")):
                x, y = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("line")], names=["doc", "line"]).filter(pa.array(keep, pa.bool_()))

    return run


def _may_match(x: str, y: str, percent: int) -> Column:
    """``y`` is earlier than ``x``, and sizes, places of the common token and bitmaps allow a match."""

    def c(side: str, name: str) -> Column:
        column = F.col(f"{side}.{name}")
        return column.cast("long") if name == "n" else column

    sizes = c(x, "n") + c(y, "n")
    earlier = (c(y, "doc") < c(x, "doc")) | ((c(y, "doc") == c(x, "doc")) & (c(y, "line") < c(x, "line")))
    length = (100 * c(y, "n") >= percent * c(x, "n")) & (100 * c(x, "n") >= percent * c(y, "n"))
    rest = F.least(c(x, "n") - c(x, "place"), c(y, "n") - c(y, "place"))
    place = rest * (100 + percent) >= percent * sizes
    differ = sum((F.bit_count(c(x, f"b{i}").bitwiseXOR(c(y, f"b{i}"))) for i in range(LONGS)), F.lit(0))
    return earlier & length & place & (differ * (100 + percent) <= (100 - percent) * sizes)


def later_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, least: int = MIN_WORDS) -> DataFrame:
    """Lines (``doc``, ``line`` from 0) that match an earlier line, earlier meaning a smaller (id, line number).

    A line is a ``\\n``-separated part of a text; it is compared as the set of its lower-case words if they are at least
    ``least`` distinct ones. The comparison is exact: every line that has an earlier line with 100 * |intersection| >=
    ``percent`` * |union| is returned, whether that earlier line is itself removed or not.

    Equal sets collapse before the join. For the rest, tokens are ordered from rare to frequent; two matching lines share
    a token of their prefixes. A token that many lines share gives pairs with a few drawn lines first, and only lines that
    these do not settle meet all earlier lines, thinned by size, place and a bitmap inside the join. Nothing is capped.

    Null or empty texts and rows with a null id have no lines here. Rows with the same id are one document. Repeated rows
    do not remove each other. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
    cells = slim.select("__text").mapInArrow(_counts, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(CELLS, np.int64)
    counted = cells.toPandas()  # at most CELLS rows
    counts[counted["cell"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(np.minimum(counts, 2**31 - 1).astype(np.int32))

    bitmap = [f"b{i}" for i in range(LONGS)]
    schema = f"doc long, line int, n int, d1 long, d2 long, {', '.join(f'{b} long' for b in bitmap)}, tokens array<int>"
    lines = materialize(slim.mapInArrow(_prefixes(least, percent, shared), schema), "lines", free=True)
    # all that depends on the words alone is the same in every line of a set
    rest = [F.first(c).alias(c) for c in ("n", *bitmap, "tokens")]
    grouped = lines.groupBy("d1", "d2").agg(F.min(F.struct("doc", "line")).alias("f"), F.count("*").alias("copies"), *rest)
    sets = materialize(grouped.select("d1", "d2", "f.doc", "f.line", "copies", "n", *bitmap, "tokens"), "sets", free=True)
    repeated = sets.where("copies > 1").select("d1", "d2", F.col("doc").alias("doc2"), F.col("line").alias("line2"))
    copies = materialize(lines.join(repeated, ["d1", "d2"]).where("doc != doc2 or line != line2").select("doc", "line"), "copies", free=True)
    discard(lines)

    # a token that is in the prefix of one set only leads nowhere
    frequent = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("lines")).where("lines > 1")
    prefix = F.col("n") - F.expr(f"({percent} * n + 99) div 100").cast("int") + 1
    unfolded = sets.select("doc", "line", "n", *bitmap, (prefix - F.size("tokens")).alias("skipped"), F.posexplode("tokens").alias("at", "token"))
    unfolded = unfolded.select("token", "n", (F.col("skipped") + F.col("at")).alias("place"), "doc", "line", *bitmap)
    entries = materialize(unfolded.join(frequent, "token"), "entries", free=True)
    discard(sets)

    def settled(pairs: DataFrame) -> DataFrame:
        pairs = materialize(pairs, "pairs", free=True)
        ends = pairs.select("doc", "line").union(pairs.select(F.col("doc2").alias("doc"), F.col("line2").alias("line")))
        asked = wanted = materialize(ends.groupBy(F.col("doc").alias("__id")).agg(F.collect_set("line").alias("wanted")), "wanted", free=True)
        lines_wanted = wanted.agg(F.sum(F.size("wanted"))).first()[0] or 0
        if lines_wanted <= WANTED_LINES:  # some 10 MB at most; beyond that texts are shuffled by id
            wanted = F.broadcast(wanted)
        sets = materialize(slim.join(wanted, "__id").mapInArrow(_sets, "doc long, line int, words binary"), "words", free=True)
        s = sets.select("doc", "line", F.col("words").alias("s"))
        t = sets.select(F.col("doc").alias("doc2"), F.col("line").alias("line2"), F.col("words").alias("t"))
        both = pairs.join(s, ["doc", "line"]).join(t, ["doc2", "line2"])
        matched = materialize(both.mapInArrow(_verified(percent), "doc long, line int").distinct(), "settled", free=True)
        discard(pairs, asked, sets)
        return matched

    def ends(x: str, y: str) -> list[Column]:
        return [F.col(f"{x}.doc").alias("doc"), F.col(f"{x}.line").alias("line"), F.col(f"{y}.doc").alias("doc2"), F.col(f"{y}.line").alias("line2")]

    many = entries.where(F.col("lines") > HEAVY)
    whole = F.struct("doc", "line", "n", "place", *bitmap)
    rank = [F.min(whole).alias("h0")]
    rank += [F.min_by(whole, F.xxhash64("doc", "line", F.lit(k))).alias(f"h{k}") for k in range(1, HEADS)]
    drawn = many.groupBy("token").agg(*rank).select("token", F.explode(F.array(*[f"h{k}" for k in range(HEADS)])).alias("h")).select("token", "h.*").distinct()
    x, y = many.alias("x"), drawn.alias("y")
    met = settled(x.join(y, (F.col("x.token") == F.col("y.token")) & _may_match("x", "y", percent)).select(*ends("x", "y")).distinct())
    x, y = entries.join(met, ["doc", "line"], "left_anti").alias("x"), entries.alias("y")
    rest = settled(x.join(y, (F.col("x.token") == F.col("y.token")) & _may_match("x", "y", percent)).select(*ends("x", "y")).distinct())
    near = met.union(rest).distinct()
    # what holds for the first line of a set holds for its copies, and copies have the first line before them anyway
    later = materialize(copies.union(near).distinct(), "later", free=True)
    discard(copies, entries, met, rest)
    return later


def by_document(found: DataFrame) -> DataFrame:
    """Line numbers of each document in ascending order."""
    return found.groupBy(F.col("doc").alias("__doc")).agg(F.sort_array(F.collect_set("line")).alias("removed"))


def drop_later_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, least: int = MIN_WORDS) -> DataFrame:
    """Texts without the lines of ``later_matches``; rows that lose all their lines are dropped, all other rows stay.

    ``length_col``, where given, gets the new number of characters.
    """
    found = by_document(later_matches(docs, id_col, text_col, least=least)).withColumnRenamed("removed", "__removed")
    joined = docs.join(found, docs[id_col] == found["__doc"], "left")
    parts = F.split(F.col(text_col), "\n")
    left = F.filter(parts, lambda x, i: ~F.array_contains("__removed", i))
    joined = joined.where(F.col("__removed").isNull() | (F.size(left) > 0))
    joined = joined.withColumn(text_col, F.when(F.col("__removed").isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n")))
    if length_col:
        joined = joined.withColumn(length_col, F.when(F.col("__removed").isNull(), F.col(length_col)).otherwise(F.length(text_col).cast("long")))
    return joined.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_lines, removed (line numbers from 0), n_removed. All lines with a word are compared."""
    docs = table(spark, sf_dir, "documents")
    found = by_document(later_matches(docs, least=1))
    sizes = docs.select("doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return sizes.join(found, sizes["doc_id"] == found["__doc"], "left").select(
        "doc_id", "n_lines", removed.alias("removed"), F.size(removed).cast("long").alias("n_removed")
    )


QUERIES = {"op3_line_dedup": query}
ORACLE: dict[str, str] = {}
