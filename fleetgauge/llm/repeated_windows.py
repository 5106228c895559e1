"""Substring dedup: every window of 20 words is counted exactly in the bucket of its minimiser.

Windows that follow each other and share a minimiser travel as one packed string, so a word is shipped about three times
instead of twenty. A bucket sorts the windows of its strings, compares equal ones byte by byte and reports those that
start earlier elsewhere.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import mix, table

#: Words of a window and words of the sequences among which its minimiser is chosen.
WINDOW, GRAM = 20, 3
#: Windows of one packed string at most; only repetitive texts have longer runs.
RUN = 64
#: A minimiser with so many packed strings (and more than a 2^17th of all) has its windows dealt out one by one. Strings
#: are counted by the upper half of the minimiser, so a rare one may be taken for a hot one, never the reverse.
LEAST_HOT, HOT_SHARE = 4_096, 2**17
#: Text that is packed at a time, words that are hashed at a time, raw bytes of a partition, bundles and their buckets.
BLOCK_BYTES, SLICE_WORDS, PARTITION_BYTES, BUNDLES, BUCKETS = 8_000_000, 2**17, 64_000_000, 2, 8
#: Bundles shorter than this are shipped as they are; the others by this level of zstd.
LEAST_COMPRESSED, LEVEL = 2_048, 6
#: Base of the polynomial hash (an odd number) and the id that stands for a null id.
BASE, NULL_ID = 0x9E3779B97F4A7C15 | 1, 2**63 - 1

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_KEYS = "doc_id long, tag int"
_PACKED = "bundle long, ids array<long>, tags array<int>, starts array<int>, counts array<int>, packed binary"


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    made = []
    for base in (BASE, pow(BASE, -1, 2**64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    return tuple(made)


class Hasher:
    """Polynomial hashes of any byte ranges of one buffer."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(20, int(len(data)).bit_length())
        power, self.inverse = _powers(size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data * power[: len(data)], out=self.sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.inverse[begin])


def words_in(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts that each end with white space, as words that each end with one space.

    Returns the bytes, the places of the spaces and the number of words of each text.
    """
    space = _SPACE[data]
    again = np.ones(len(data), bool)
    again[1:] = space[:-1]
    keep = ~(space & again)
    clean = data[keep]
    clean[space[keep]] = 32
    closing = np.zeros(len(data) + 1, np.int64)
    np.cumsum(space & keep, out=closing[1:])
    return clean, np.flatnonzero(clean == 32), np.diff(closing[offsets])


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a binary column, without a copy."""
    width = np.int64 if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def _parts(batch: pa.RecordBatch):
    """The batch in row ranges of about BLOCK_BYTES of text."""
    sizes = _buffers(batch.column("text"))[0]
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(sizes, sizes[begin] + BLOCK_BYTES, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def _runs(part: pa.RecordBatch):
    """Runs of windows that share a minimiser, slice by slice.

    Yields bytes, word starts, word ends, hasher, minimiser, row and place (in its text) of each run's first window, the
    run's index in the slice and its number of windows.
    """
    clean, ends, counts = words_in(*_buffers(part.column("text")))
    row = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    span = WINDOW - GRAM + 1
    for low in range(0, len(ends) - WINDOW + 1, SLICE_WORDS):
        high = min(len(ends), low + SLICE_WORDS + WINDOW - 1)
        rows = row[low:high]
        valid = rows[: 1 - WINDOW] == rows[WINDOW - 1 :]
        if not valid.any():
            continue
        origin = ends[low - 1] + 1 if low else 0
        stop = ends[low:high] - origin
        begin = np.concatenate([[0], stop[:-1] + 1])
        data = clean[origin : origin + stop[-1] + 1]
        hasher = Hasher(data)
        least = hasher(begin[: len(begin) - GRAM + 1], stop[GRAM - 1 :])
        width = 1
        while width < span:  # least of ever wider spans
            step = min(width, span - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        fresh = np.ones(len(valid), bool)
        fresh[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
        fresh &= valid
        index = np.arange(len(valid))
        head = np.maximum.accumulate(np.where(fresh, index, 0))
        fresh |= valid & ((index - head) % RUN == 0)
        at = np.flatnonzero(fresh)
        size = np.diff(np.append(np.cumsum(valid)[at] - 1, valid.sum()))
        yield data, begin, stop, hasher, least[at], rows[at], low + at - first[rows[at]], at, size


def _upper(minimisers: np.ndarray) -> np.ndarray:
    return (minimisers >> np.uint64(32)).astype(np.uint32).view(np.int32)


def count_minimisers(batches):
    """Packed strings of each minimiser, block by block."""
    for batch in batches:
        for part in _parts(batch):
            found = [run[4] for run in _runs(part)]
            if found:
                keys, n = np.unique(_upper(np.concatenate(found)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int32))], names=["minimiser", "n"])


def later(hashes: np.ndarray, ids: np.ndarray, starts: np.ndarray, content) -> np.ndarray:
    """Which entries have an equal entry of a smaller id, or of the same id and a smaller start.

    Equal hashes are only candidates: ``content(i)`` gives the bytes that decide.
    """
    flags = np.zeros(len(hashes), bool)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    grouped = np.zeros(len(hashes), bool)
    grouped[1:] = same
    grouped[:-1] |= same
    order = order[grouped]
    if not len(order):
        return flags
    order = order[np.lexsort((starts[order], ids[order], hashes[order]))]
    value = hashes[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = value[1:] != value[:-1]
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    behind = (ids[order] != ids[order[head]]) | (starts[order] != starts[order[head]])
    held, text = -1, b""
    broken = set()
    for k in np.flatnonzero(~fresh):
        if head[k] != held:
            held = head[k]
            text = content(order[held])
        if content(order[k]) != text:
            broken.add(held)
    flags[order[behind]] = True
    for k in broken:  # different contents of one hash: settled by the contents alone
        members = order[head == k]
        least: dict = {}
        for i in members:  # in order of id and start
            place = (ids[i], starts[i])
            flags[i] = least.setdefault(content(i), place) != place
    return flags


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _rows(bundle, ids, tags, starts, counts, offsets, packed) -> pa.RecordBatch:
    """``counts`` are the strings of each bucket of a bundle or, in rows of marks, windows of each mark."""
    own = np.arange(len(bundle) + 1) * (len(counts) // len(bundle))
    columns = [
        pa.array(bundle, pa.int64()), _lists(ids, offsets, pa.int64()), _lists(tags, offsets, pa.int32()),
        _lists(starts, offsets, pa.int32()), _lists(counts, own, pa.int32()), pa.array(packed, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["bundle", "ids", "tags", "starts", "counts", "packed"])


def packer(bundles: int, hot: np.ndarray):
    """Map step: one row for each block and bundle of buckets, with the strings of one bucket after the other.

    Windows of hot minimisers are dealt out singly.

    Of equal strings in a block only the first is shipped; the windows of the others are known to start earlier there and
    go along as finished marks (rows without ``packed``).
    """

    codec = None

    def pack(part: pa.RecordBatch):
        nonlocal codec
        codec = codec or pa.Codec("zstd", compression_level=LEVEL)
        columns = [[] for _ in range(6)]  # minimiser or window hash, hash of the string, row, start, windows, bytes
        for data, begin, stop, hasher, key, rows, starts, at, size in _runs(part):
            single = np.isin(_upper(key), hot)
            lone = np.repeat(np.flatnonzero(single), size[single])
            step = np.arange(len(lone)) - np.repeat(np.cumsum(size[single]) - size[single], size[single])
            plain = ~single
            low = np.concatenate([at[plain], at[lone] + step])
            n = np.concatenate([size[plain], np.ones(len(lone), np.int64)])
            left, right = begin[low], stop[low + n + WINDOW - 2]
            whole = hasher(left, right)
            raw = data.tobytes()
            made = [
                np.concatenate([key[plain], whole[plain.sum() :]]), whole, np.concatenate([rows[plain], rows[lone]]),
                np.concatenate([starts[plain], starts[lone] + step]), n, [raw[a:b] for a, b in zip(left.tolist(), right.tolist())],
            ]
            for column, values in zip(columns, made):
                column.append(values)
        if not columns[0]:
            return
        key, whole, rows, starts, n = (np.concatenate(c) for c in columns[:5])
        strings = [s for c in columns[5] for s in c]
        ids = part.column("doc_id").to_numpy(zero_copy_only=False)[rows]
        tags = part.column("tag").to_numpy(zero_copy_only=False)[rows]
        known = later(whole, ids, starts, strings.__getitem__)
        if known.any():
            yield _rows([int(key[0] % np.uint64(bundles))], ids[known], tags[known], starts[known], n[known], [0, int(known.sum())], [None])
        spread = mix(key)
        bundle = (spread % np.uint64(bundles)).astype(np.int64)
        place = bundle * BUCKETS + (spread // np.uint64(bundles) % np.uint64(BUCKETS)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        order = order[~known[order]]
        bundle = bundle[order]
        cuts = np.flatnonzero(np.concatenate([[True], bundle[1:] != bundle[:-1]]))
        bounds = np.append(cuts, len(order))
        counts = np.bincount(place[order], minlength=bundles * BUCKETS).reshape(-1, BUCKETS)[bundle[cuts]].ravel()
        packed = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            text = b"\n".join([strings[i] for i in order[a:b].tolist()]) + b"\n"
            small = len(text) < LEAST_COMPRESSED
            packed.append(b"0" + text if small else b"%d\n" % len(text) + codec.compress(text, asbytes=True))
        yield _rows(bundle[cuts], ids[order], tags[order], starts[order], counts, bounds, packed)

    def run(batches):
        for batch in batches:
            for part in _parts(batch):
                yield from pack(part)

    return run


def _unpacked(packed: bytes) -> bytes:
    if packed[:1] == b"0":
        return packed[1:]
    size, body = packed.split(b"\n", 1)
    return pa.decompress(body, int(size), "zstd", asbytes=True)


def _marks(ids, tags, starts, windows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(tags, pa.int32()), pa.array(starts, pa.int32()), pa.array(windows, pa.int32())],
        names=["doc_id", "tag", "start", "windows"],
    )


def _bucket_marks(raw: bytes, ids: np.ndarray, tags: np.ndarray, starts: np.ndarray) -> pa.RecordBatch | None:
    """Runs of windows of one bucket that start earlier elsewhere. ``raw``: the strings, each ended by a line feed."""
    data = np.frombuffer(raw, np.uint8)
    stop = np.flatnonzero((data == 32) | (data == 10))
    begin = np.concatenate([[0], stop[:-1] + 1])
    words = np.diff(np.concatenate([[-1], np.flatnonzero(data[stop] == 10)]))
    string = np.repeat(np.arange(len(words)), words - WINDOW + 1)
    offset = np.arange(len(string)) - np.repeat(np.cumsum(words - WINDOW + 1) - (words - WINDOW + 1), words - WINDOW + 1)
    low = (np.cumsum(words) - words)[string] + offset
    left, right = begin[low], stop[low + WINDOW - 1]
    flags = later(Hasher(data)(left, right), ids[string], starts[string] + offset, lambda i: raw[left[i] : right[i]])
    found = np.flatnonzero(flags)
    if not len(found):
        return None
    fresh = np.ones(len(found), bool)
    fresh[1:] = (np.diff(found) != 1) | (string[found[1:]] != string[found[:-1]])
    head = found[fresh]
    size = np.diff(np.append(np.flatnonzero(fresh), len(found)))
    return _marks(ids[string[head]], tags[string[head]], starts[string[head]] + offset[head], size)


def _bundle_marks(held: list[dict]):
    """Marks of a bundle, one bucket at a time: its strings of all blocks are put together."""
    raw = [_unpacked(row["packed"].as_py()) for row in held]
    arrays = [{name: row[name].values.to_numpy() for name in ("ids", "tags", "starts", "counts")} for row in held]
    ends = []
    for text, row in zip(raw, arrays):
        lines = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
        ends.append((np.concatenate([[0], np.cumsum(row["counts"])]), np.concatenate([[0], lines])))
    for bucket in range(BUCKETS):
        texts, columns = [], ([], [], [])
        for text, row, (strings, bytes_) in zip(raw, arrays, ends):
            a, b = strings[bucket], strings[bucket + 1]
            if a < b:
                texts.append(text[bytes_[a] : bytes_[b]])
                for column, name in zip(columns, ("ids", "tags", "starts")):
                    column.append(row[name][a:b])
        if texts:
            ids, tags, starts = (np.concatenate(c) for c in columns)
            if found := _bucket_marks(b"".join(texts), ids, tags, starts.astype(np.int64)):
                yield found


def find_repeats(batches):
    """Reduce step over rows sorted by bundle: one bundle at a time is unpacked."""
    held, bundle = [], None
    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in names}
            if not row["packed"].is_valid:
                yield _marks(*(row[name].values for name in ("ids", "tags", "starts", "counts")))
                continue
            if row["bundle"].as_py() != bundle:
                yield from _bundle_marks(held)
                held, bundle = [], row["bundle"].as_py()
            held.append(row)
    yield from _bundle_marks(held)


def _keep_words(batches):
    """Texts without the marked words."""
    for batch in (part for whole in batches for part in _parts(whole)):
        offsets, data = _buffers(batch.column("text"))
        clean, ends, counts = words_in(offsets, data)
        first = np.concatenate([[0], np.cumsum(counts)])
        marks = batch.column("marks")
        owner = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(marks).to_numpy())
        flat = marks.flatten()
        low = first[owner] + flat.field("start").to_numpy(zero_copy_only=False)
        high = low + flat.field("windows").to_numpy(zero_copy_only=False) + WINDOW - 1
        edges = np.zeros(len(ends) + 1, np.int64)
        np.add.at(edges, low, 1)
        np.add.at(edges, high, -1)
        kept = np.cumsum(edges)[:-1] == 0
        keep = np.repeat(kept, np.diff(np.concatenate([[-1], ends])))
        left = np.concatenate([[0], np.cumsum(kept)])[first]  # kept words before each text
        at = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends + 1])[first]]
        last = at[1:][np.diff(left) > 0] - 1  # the space after a text's last word goes
        text = np.delete(clean[keep], last)
        at = at - np.concatenate([[0], np.cumsum(np.diff(left) > 0)])
        removed = counts - np.diff(left)
        texts = pa.LargeStringArray.from_buffers(batch.num_rows, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(text)).cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), texts],
            names=["doc_id", "n_words", "n_removed", "kept_text"],
        )


def _closed(text: Column) -> Column:
    return F.encode(F.concat(F.coalesce(text, F.lit("")), F.lit("\n")), "UTF-8")


def _tag(text: Column) -> Column:
    """Tells rows of one id apart by their text."""
    return F.hash(text, F.lit("tag"))


def drop_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by one space) of every row of ``docs``.

    A word goes if a window of 20 words of its text that covers it also starts earlier: in a row of a smaller id, or of
    the same id at an earlier place. Windows are judged on the input. Words are parted by ASCII white space and compared
    as they are.

    Ids are integers. Rows of one id, equal or not, are compared by the place alone: what starts at the same place in both
    stays in both. Null ids count as one id after all others. Null, empty and short texts have no windows and lose
    nothing; an empty table gives no rows; other columns are ignored, whatever their names.

    Nothing is held whole but one block of texts (8 MB, or a single longer text) and one bucket. Buckets grow in number
    with the text; a minimiser with many strings is spread over buckets by its single windows, of which each block ships
    one of each kind.
    """
    spark = docs.sparkSession
    ids, text = F.col(id_col).cast("long"), F.col(text_col)
    rows = docs.select(F.coalesce(ids, F.lit(NULL_ID)).alias("doc_id"), _tag(text).alias("tag"), _closed(text).alias("text"))
    counts = rows.select("text").mapInArrow(count_minimisers, "minimiser int, n int").groupBy("minimiser").agg(F.sum("n").alias("n"))
    # a string of n windows is about three times as long as the words it stands for; 190 bytes are the usual length
    counts = counts.persist()
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where(F.col("n") >= max(LEAST_HOT, total // HOT_SHARE)).select("minimiser").toArrow()  # 2^17 rows at most
    counts.unpersist()
    hot = found.column("minimiser").to_numpy()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total * 190 // PARTITION_BYTES)
    packed = rows.mapInArrow(packer(parts * BUNDLES, hot), _PACKED)
    dealt = packed.repartition(parts, "bundle").sortWithinPartitions("bundle")
    marks = dealt.mapInArrow(find_repeats, f"{_KEYS}, start int, windows int")
    marks = marks.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "windows")).alias("marks"))
    texts = docs.select(ids.alias("doc_id"), _closed(text).alias("text"), _tag(text).alias("__tag")).alias("t")
    joined = texts.join(
        marks.alias("m"), (F.coalesce("t.doc_id", F.lit(NULL_ID)) == F.col("m.doc_id")) & (F.col("t.__tag") == F.col("m.tag")), "left"
    ).select("t.doc_id", "t.text", F.coalesce("m.marks", F.array().cast("array<struct<start:int,windows:int>>")).alias("marks"))
    return joined.mapInArrow(_keep_words, "doc_id long, n_words long, n_removed long, kept_text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_windows(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


SQL = f"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS words FROM documents),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS w FROM texts, unnest(range(1, len(words) - {WINDOW - 2})) AS t(i)),
judged AS (SELECT doc_id, i, rank() OVER (PARTITION BY w ORDER BY doc_id, i) AS place FROM windows),
gone AS (SELECT doc_id, list(DISTINCT j) AS places FROM judged, unnest(range(i, i + {WINDOW})) AS t(j) WHERE place > 1 GROUP BY doc_id),
kept AS (SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
  list_filter(words, lambda x, i: NOT list_contains(coalesce(places, []), i)) AS words FROM texts LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(array_to_string(words, ' ')) AS kept_sha256 FROM kept
"""

QUERIES = {"op11_repeated_windows": query}
ORACLE = {"op11_repeated_windows": SQL}
