"""Language-model scores by a hierarchical Pitman-Yor model seated by Gibbs sampling."""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import GOLDEN, discard, fold, materialize, mix, table, words_of

#: Classes of tokens: the most frequent tokens each are one, all others share classes by their last three bytes.
OWN, ENDINGS = 384, 384
CLASSES = OWN + ENDINGS
#: Sweeps before the first kept seating, and kept seatings whose predictive probabilities are averaged.
BURN_IN, SAMPLES = 2, 3
#: Customers seated one by one; later ones are seated in doublings, see ``seat``.
EXACT = 24
#: Concentration of every restaurant. Discounts are estimated from counts of counts.
CONCENTRATION = 10.0
#: Characters of a block of documents, about, and blocks for each bucket of pairs.
BLOCK_BYTES, BLOCKS = 3 << 20, 2
#: The most frequent tokens, at most so many: their values are arrays of a bounded size that are broadcast. All others are joined.
FREQUENT = 1 << 19
#: Numbers of a dense vector that are added up by one task.
PART = 1 << 13
#: Tokens of a block scored at a time.
CHUNK = 1 << 18
#: No word is empty, so none is taken for the end.
END_WORD = b""


def token_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


END = token_hash(END_WORD)


def uniform(ids: np.ndarray, sweep: int, step: int) -> np.ndarray:
    """Repeatable uniform numbers: the same for a dish wherever it is computed."""
    with np.errstate(over="ignore"):
        x = mix(ids.astype(np.uint64) + np.uint64((sweep * 1009 + step + 1) & 0xFFFFFFFF) * GOLDEN)
    return (mix(x) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def seat(ids: np.ndarray, customers: np.ndarray, weight: np.ndarray, discount: float, sweep: int) -> np.ndarray:
    """Tables of every dish, drawn by seating its customers anew while all other dishes stay as they are.

    ``weight``: (concentration + discount * tables of the restaurant) * base probability of the dish. Customer number
    i + 1 opens a table with probability weight / (weight + i - discount * t), where t tables of the dish are open. The
    first ``EXACT`` customers are seated one by one; those after them in groups that double, whose expected number of new
    tables is rounded up or down at random.
    """
    order = np.argsort(-customers, kind="stable")  # dishes that still have customers to seat are the first ones
    ids, customers, weight = ids[order], customers[order], weight[order]
    t = np.minimum(customers, 1).astype(np.float64)
    for i in range(1, min(int(customers.max(initial=0)), EXACT)):
        on = slice(np.searchsorted(-customers, -i))
        t[on] += uniform(ids[on], sweep, i) < weight[on] / (weight[on] + i - discount * t[on])
    done, step = float(EXACT), EXACT
    while last := int(np.searchsorted(-customers, -done)):
        on = slice(last)
        until = np.minimum(customers[on], 2 * done)
        now = weight[on] - discount * t[on]
        expected = weight[on] * np.log((now + until) / np.maximum(now + done, 1e-9))
        t[on] += np.minimum(np.floor(expected + uniform(ids[on], sweep, step)), until - done)
        done, step = done * 2, step + 1
    tables = np.empty(len(t))
    tables[order] = np.minimum(t, customers)
    return tables


def discount_of(ones: float, twos: float) -> float:
    return float(np.clip(ones / (ones + 2 * twos), 0.05, 0.9)) if ones else 0.5


@dataclass
class Contexts:
    """Restaurants of classes: one for each class before, all below one root; a bounded number of cells.

    ``counts[u, k]``: how many tables of words of class u serve a word of class k. The root's customers are the tables of all contexts, its base is
    uniform. ``predictive`` averages over the kept seatings.
    """

    counts: np.ndarray

    def predictive(self) -> np.ndarray:
        c = self.counts.astype(np.float64)
        u, k = np.nonzero(c)
        cells = c[u, k]
        d = discount_of((cells == 1).sum(), (cells == 2).sum())
        ids, n, size = u * CLASSES + k, c.sum(axis=1), CLASSES
        root_t = np.zeros(size)
        tables = np.minimum(c, 1)
        base = np.full(size, 1 / size)
        total = np.zeros_like(c)
        for sweep in range(BURN_IN + SAMPLES):
            weight = (CONCENTRATION + d * tables.sum(axis=1))[u] * base[k]
            tables = np.zeros_like(c)
            tables[u, k] = seat(ids, cells, weight, d, sweep)
            root_c = tables.sum(axis=0)
            root_d = discount_of((root_c == 1).sum(), (root_c == 2).sum())
            root_t = seat(np.arange(size) + (1 << 40), root_c, np.full(size, (CONCENTRATION + root_d * root_t.sum()) / size), root_d, sweep)
            base = (np.maximum(root_c - root_d * root_t, 0) + (CONCENTRATION + root_d * root_t.sum()) / size) / (CONCENTRATION + root_c.sum())
            if sweep >= BURN_IN:
                t = tables.sum(axis=1)
                total += (np.maximum(c - d * tables, 0) + (CONCENTRATION + d * t)[:, None] * base[None]) / (CONCENTRATION + n)[:, None]
        return total / SAMPLES


def inside_of(customers: np.ndarray, t: np.ndarray, k: np.ndarray, stats: np.ndarray, discount: float) -> np.ndarray:
    """Probability of a token in its class; ``stats``: tokens, customers and tables of each class."""
    new = (CONCENTRATION + discount * stats[k, 2]) / (stats[k, 0] + 1)
    return (np.maximum(customers - discount * t, 0) + new) / (CONCENTRATION + stats[k, 1])


def token_tables(ids: np.ndarray, customers: np.ndarray, k: np.ndarray, stats: np.ndarray, discount: float, sweep: int) -> np.ndarray:
    """Tables of tokens in the restaurants of their classes."""
    return seat(ids, customers, (CONCENTRATION + discount * stats[k, 2]) / (stats[k, 0] + 1), discount, max(sweep, 0))


def place_in(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in an ascending array, -1 if it is not there."""
    if not len(ordered):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return np.where(ordered[at] == values, at, -1)


@dataclass
class Frequent:
    """The frequent tokens in ascending order; ``classes`` and ``n`` have one item more, read at the place -1 of any other token."""

    tokens: np.ndarray
    classes: np.ndarray
    n: np.ndarray


@dataclass
class State:
    """All restaurants after a sweep but those of rare tokens; ``opened`` and ``inside`` by place of a frequent token."""

    opened: np.ndarray
    inside: np.ndarray
    between: np.ndarray
    stats: np.ndarray
    discount: float


def _endings(words) -> np.ndarray:
    """Class of each word by its last three bytes."""
    known: dict[bytes, int] = {}
    ends = [w[-3:] for w in words]
    for e in set(ends):
        known[e] = OWN + xxhash.xxh3_64_intdigest(e) % ENDINGS
    return np.fromiter(map(known.__getitem__, ends), np.int64, len(ends))


def _hashes(words) -> np.ndarray:
    return np.fromiter(map(token_hash, words), np.uint64, len(words)).view(np.int64)


def _tokens(batches):
    """Distinct tokens of training texts with counts and classes among endings."""
    for batch in batches:
        found: Counter = Counter()
        for text in batch.column("__text"):
            found.update(words_of(text.as_py()))
        if batch.num_rows:
            found[END_WORD] = batch.num_rows
        columns = [pa.array(_hashes(found)), pa.array(np.fromiter(found.values(), np.int64, len(found))), pa.array(_endings(found))]
        yield pa.RecordBatch.from_arrays(columns, names=["token", "n", "ending"])


class Block:
    """Texts of a block as places among its distinct tokens (``tokens``, by hash, with their class ``k``).

    ``before`` and ``at``: words of all texts, each followed by an end; ``which``: their pair. ``u`` and ``w``: both places of
    the distinct pairs in ascending order, ``n`` times in training documents. ``order`` and ``bucket`` deal them over buckets, by the word before and, for a word that is a class
    of its own, the word itself. All this is the same whatever the order of the texts.
    """

    def __init__(self, block: pa.Table, top: np.ndarray, buckets: int):
        places: defaultdict = defaultdict()
        places.default_factory = places.__len__
        last = places[END_WORD]
        texts = []
        for text in block.column("__text").to_pylist():
            words = words_of(text)
            texts.append(np.fromiter(map(places.__getitem__, words), np.int32, len(words)))
            texts.append(np.array([last], np.int32))
        self.sizes = np.array([len(t) + 1 for t in texts[::2]])
        self.tokens, first, now = np.unique(_hashes(places), return_index=True, return_inverse=True)
        self.k = _endings(places)[first].astype(np.int32)
        del places
        own = place_in(self.tokens, top)
        self.k[own[own >= 0]] = np.flatnonzero(own >= 0)
        self.at = now.astype(np.int32)[np.concatenate(texts)]
        del texts
        self.before = np.concatenate([self.at[-1:], self.at[:-1]])  # every text ends with an end
        keys = self.before.astype(np.int64) << 32 | self.at
        order = np.argsort(keys)
        keys = keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        pairs = keys[new]
        del keys
        self.which = np.empty(len(order), np.int32)
        self.which[order] = np.cumsum(new, dtype=np.int32) - 1
        del order, new
        train = np.repeat(block.column("train").to_numpy(), self.sizes)
        self.n = np.bincount(self.which[train], minlength=len(pairs)).astype(np.int32)
        self.u, self.w = (pairs >> 32).astype(np.int32), pairs.astype(np.int32)
        del pairs, train
        hashes = mix(self.tokens.view(np.uint64))
        self.bucket = (hashes % np.uint64(buckets)).astype(np.int32)[self.u]
        own = np.flatnonzero(self.k[self.u] < OWN)
        self.bucket[own] = (mix(hashes[self.u[own]] ^ mix(hashes[self.w[own]])) % np.uint64(buckets)).astype(np.int32)
        self.order = np.argsort(self.bucket, kind="stable").astype(np.int32)


def _bundles(top: np.ndarray, buckets: int, shared):
    """Pairs of a block, a row for each bucket: words before (``us``) with the number of pairs of each (``runs``), the words
    after (``ws``) and training counts. A frequent token is its place, any other -1 and the next hash in ``rest_u`` or ``rest_w``.

    Bucket -1 has the counts of pairs of classes, buckets -2 and -3 the tokens that are not frequent (``rest_u``), the latter
    those with one occurrence in the block's training documents.
    """

    def run(table: pa.Table) -> pa.Table:
        b = Block(table, top, buckets)
        own = np.bincount(b.w, b.n, len(b.tokens))  # every occurrence of a token is after a word or an end
        b.which = b.at = b.before = None  # not needed here
        classes = np.bincount(b.k[b.u] * CLASSES + b.k[b.w], b.n, CLASSES * CLASSES).astype(np.int32)
        cells = np.flatnonzero(classes).astype(np.int32)
        place = place_in(shared.value.tokens, b.tokens).astype(np.int32)
        u, w, bucket, n = (x[b.order] for x in (b.u, b.w, b.bucket, b.n))
        new = np.ones(len(u), bool)
        new[1:] = (u[1:] != u[:-1]) | (bucket[1:] != bucket[:-1])
        starts = np.flatnonzero(new)
        found, first = np.unique(bucket, return_index=True)
        at_run, us, none = np.searchsorted(starts, first), u[starts], np.empty(0, np.int64)
        rare_u, rare_w = np.flatnonzero(place[us] < 0), np.flatnonzero(place[w] < 0)
        once, rest = (b.tokens[(place < 0) & at] for at in (own == 1, own != 1))

        def lists(firsts, values, *more):
            ends = [*firsts, *np.cumsum([len(values), *map(len, more)])]
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([values, *more])))

        def packs(firsts, values, more):
            return pa.array([*map(_packed, np.split(values, firsts[1:])), _packed(more), b"", b""], pa.binary())

        columns = [
            pa.array(np.full(len(found) + 3, table.column("block")[0].as_py()), pa.int64()),
            pa.array(np.append(found, [-1, -2, -3]), pa.int32()),
            packs(at_run, place[us], none), packs(at_run, np.diff(np.append(starts, len(u))).astype(np.int32), none),
            packs(first, place[w], cells), packs(first, n, classes[cells]),
            lists(np.searchsorted(rare_u, at_run), b.tokens[us[rare_u]], none, rest, once),
            lists(np.searchsorted(rare_w, first), b.tokens[w[rare_w]], none, none, none),
        ]
        return pa.table(columns, names=["block", "bucket", "us", "runs", "ws", "n", "rest_u", "rest_w"])

    return run


def _packed(values: np.ndarray) -> bytes:
    """Bytes of integers, all lowest bytes first, so that compression finds the empty ones."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""


def _unpacked(column, kind=np.int32) -> np.ndarray:
    """The integers of all rows, one row after the other."""
    rows = [np.frombuffer(x.as_buffer(), np.uint8).reshape(np.dtype(kind).itemsize, -1).T for x in column]
    return np.concatenate([np.empty((0, np.dtype(kind).itemsize), np.uint8), *rows]).view(kind).ravel()


def _flat(table: pa.Table, name: str) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *(c.flatten().to_numpy(zero_copy_only=False) for c in table.column(name).chunks)])


def _parts(total: np.ndarray):
    """A dense vector in parts, without parts that are all zero."""
    parts = [(i, total[i * PART : (i + 1) * PART]) for i in range(-(-len(total) // PART))]
    parts = [(i, x) for i, x in parts if x.any()]
    sums = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x) for _, x in parts)]), pa.int32()), pa.array(np.concatenate([np.empty(0), *(x for _, x in parts)])))
    return [pa.array([i for i, _ in parts], pa.int32()), sums]


def _add_parts(table: pa.Table) -> pa.Table:
    sums = np.sum([np.asarray(c.values) for c in table.column("sums")], axis=0)
    return pa.table([pa.array([table.column("part")[0].as_py()], pa.int32()), pa.array([sums], pa.list_(pa.float64()))], names=["part", "sums"])


def _added(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of the dense vectors of all tasks; ``size`` is bounded by constants."""
    found, total = parts.groupBy("part").applyInArrow(_add_parts, "part int, sums array<double>").toArrow(), np.zeros(size)
    for part, sums in zip(found.column("part").to_pylist(), found.column("sums")):
        total[part * PART : part * PART + len(sums)] = np.asarray(sums.values)
    return total


def _class_pairs(batches):
    total = np.zeros(CLASSES * CLASSES)
    for batch in batches:
        np.add.at(total, _unpacked(batch.column("ws")), _unpacked(batch.column("n")).astype(np.float64))
    yield pa.RecordBatch.from_arrays(_parts(total), names=["part", "sums"])


def _grouped(table: pa.Table, tokens: np.ndarray):
    """Pairs of a bucket as places of both words, their total counts, which of them each pair of each row is, and the tokens
    at the places: ``tokens``, then those of the bucket that are not frequent."""
    places = []
    us, ws, runs, times = (_unpacked(table.column(c)) for c in ("us", "ws", "runs", "n"))
    before, after = (_flat(table, c) for c in ("rest_u", "rest_w"))
    rare, at = np.unique(np.concatenate([before, after]), return_inverse=True)
    for codes, given in ((us, at[: len(before)]), (ws, at[len(before) :])):
        codes = codes.astype(np.int64)
        codes[codes < 0] = len(tokens) + given
        places.append(codes)
    keys = np.repeat(places[0] << 32, runs) | places[1]
    del us, ws, places
    order = np.argsort(keys)
    keys = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    keys = keys[first]
    which = np.empty(len(order), np.int32)
    which[order] = np.cumsum(first, dtype=np.int32) - 1
    n = np.add.reduceat(times[order].astype(np.int64), np.flatnonzero(first))
    return keys >> 32, keys & 0xFFFFFFFF, n, which, np.concatenate([tokens, rare])


def _cells(shared):
    """Pairs of a bucket that occur more than once in training documents."""

    def run(table: pa.Table) -> pa.Table:
        u, w, n, _, tokens = _grouped(table, shared.value.tokens)
        u, w, n = u[n > 1], w[n > 1], n[n > 1]
        size = len(shared.value.tokens)
        known = (u < size) & (w < size)
        columns = [pa.array(np.full(len(n), table.column("bucket")[0].as_py(), np.int32)), pa.array(tokens[u], mask=known), pa.array(tokens[w], mask=known), pa.array(n)]
        columns += [pa.array(np.where(x < size, x, -1).astype(np.int32)) for x in (u, w)]
        return pa.table(columns, names=["bucket", "token", "after", "n", "iu", "iw"])

    return run


def _cell_tables(frequent: Frequent, state: State, discount: float, sweep: int, u, w, iu, iw, n, rare=None):
    """Tables of cells of word restaurants, whose base is class by class and token in its class, and the classes of both words.

    ``rare``: classes of both words, tables below the first and probability of the second, for those not frequent.
    """
    ku, kw, opened, inside = frequent.classes[iu], frequent.classes[iw], state.opened[iu], state.inside[iw]
    if rare:
        ku, opened = np.where(iu < 0, rare[0], ku), np.where(iu < 0, rare[2], opened)
        kw, inside = np.where(iw < 0, rare[1], kw), np.where(iw < 0, rare[3], inside)
    if sweep < 0:
        return np.ones(len(n)), ku, kw
    weight = (CONCENTRATION + discount * opened) * state.between[ku, kw] * inside
    return seat(mix(u.view(np.uint64)) ^ w.view(np.uint64), n.astype(np.float64), weight, discount, sweep), ku, kw


def _columns(batch, names: str):
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names.split()]


def _triple(batch, name: str, i: int) -> np.ndarray:
    """Tables below, customers and tables of rare tokens in a sweep, counted from the end."""
    column = batch.column(name)
    return column.flatten().to_numpy().reshape(len(column), -1, 3)[:, -i].T


def _rare_of(batch, state: State, i: int):
    ku, kw = _columns(batch, "ku kw")
    after = _triple(batch, "hw", i)
    return ku, kw, _triple(batch, "hu", i)[0], inside_of(after[1], after[2], kw, state.stats, state.discount)


def _excess(shared, now, discount: float, sweep: int, joined: bool):
    """Customers less tables of all cells, added up by frequent token before, frequent token after and pair of classes.

    With ``joined``, cells have a token that is not frequent; what belongs to it is returned cell by cell.
    """

    def run(batches):
        f, state = shared.value, now.value
        size = len(f.tokens)
        total = np.zeros(2 * size + CLASSES * CLASSES)
        for batch in batches:
            iu, iw, n = _columns(batch, "iu iw n")
            rare = u = w = None
            if joined:
                rare = _rare_of(batch, state, 1)
                u, w = _columns(batch, "token after")
            else:
                u, w = f.tokens[iu], f.tokens[iw]
            t, ku, kw = _cell_tables(f, state, discount, sweep, u, w, iu, iw, n, rare)
            excess = n - t
            for at, start in ((iu, 0), (iw, size)):
                np.add.at(total, at[at >= 0] + np.int64(start), excess[at >= 0])
            np.add.at(total, 2 * size + ku.astype(np.int64) * CLASSES + kw, excess)
            if joined:
                tokens, eu, ew = np.concatenate([u[iu < 0], w[iw < 0]]), np.concatenate([excess[iu < 0], np.zeros((iw < 0).sum())]), np.concatenate([np.zeros((iu < 0).sum()), excess[iw < 0]])
                none = [pa.nulls(len(tokens), pa.int32()), pa.nulls(len(tokens), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*none, pa.array(tokens), pa.array(eu), pa.array(ew)], names=["part", "sums", "token", "eu", "ew"])
        parts, sums = _parts(total)
        none = [pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.float64()), pa.nulls(len(parts), pa.float64())]
        yield pa.RecordBatch.from_arrays([parts, sums, *(none if joined else ())], names=["part", "sums", *(("token", "eu", "ew") if joined else ())])

    return run


def _seated(stats: np.ndarray, discount: float, sweep: int):
    """Tables of tokens that are not frequent, added to their history once it is needed."""

    def run(batches):
        for batch in batches:
            token, k, n, eu, ew = _columns(batch, "token class n eu ew")
            opened, customers = n - eu, n - ew
            now = np.stack([opened, customers, token_tables(token, customers, k, stats, discount, sweep)], axis=1)
            if sweep >= BURN_IN and len(now):
                now = np.concatenate([batch.column("history").flatten().to_numpy().reshape(len(now), -1), now], axis=1)
            history = pa.ListArray.from_arrays(pa.array(np.arange(len(now) + 1) * now.shape[1], pa.int32()), pa.array(now.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("token", "class", "n")), history], names=["token", "class", "n", "history"])

    return run


def _kept_rare(shared, past, discount: float):
    """Tables of joined cells, added up over the kept seatings."""

    def run(batches):
        f, states = shared.value, past.value
        for batch in batches:
            iu, iw, n, u, w = _columns(batch, "iu iw n token after")
            kept = np.zeros(len(n))
            for i, state in enumerate(states):
                kept += _cell_tables(f, state, discount, BURN_IN + i, u, w, iu, iw, n, _rare_of(batch, state, SAMPLES + 1 - i))[0]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("bucket", "token", "after")), pa.array(kept)], names=["bucket", "token", "after", "kept"])

    return run


def _answers(shared, past, discount: float):
    """Customers of every pair of a bucket and its tables in all kept seatings, for each block in the order of its pairs."""

    def run(table: pa.Table, rare: pa.Table) -> pa.Table:
        f, states = shared.value, past.value
        u, w, n, which, tokens = _grouped(table, f.tokens)
        kept = np.full(len(n), float(SAMPLES))
        known = (u < len(f.tokens)) & (w < len(f.tokens))
        own = np.flatnonzero((n > 1) & known)
        iu, iw = u[own], w[own]
        kept[own] = sum(_cell_tables(f, s, discount, BURN_IN + i, tokens[iu], tokens[iw], iu, iw, n[own])[0] for i, s in enumerate(states))
        if rare.num_rows:
            token, after, tables = (rare.column(c).to_numpy() for c in ("token", "after", "kept"))
            joined = np.flatnonzero((n > 1) & ~known)
            joined, given = joined[np.lexsort((tokens[w[joined]], tokens[u[joined]]))], np.lexsort((after, token))
            kept[joined] = tables[given]  # the same cells on both sides
        ends = np.cumsum([len(x) // 4 if x else 0 for x in table.column("ws").to_pylist()])
        columns = [pa.array([_packed(x) for x in np.split(values[which], ends[:-1])], pa.binary()) for values in (n, kept.astype(np.int64))]
        return pa.table([table.column("block"), table.column("bucket"), *columns], names=["block", "bucket", "customers", "tables"])

    return run


def _scored(top: np.ndarray, buckets: int, shared, past, discount: float, tokens: int, distinct: int):
    """Scores of the documents of a block from the answers to its pairs and to its tokens that are not frequent."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        f, states = shared.value, past.value
        b = Block(left, top, buckets)
        paired = pa.compute.is_null(right.column("token"))
        pairs, rare = right.filter(paired).sort_by("bucket"), right.filter(pa.compute.invert(paired))
        seen = np.empty(len(b.n))
        customers, tables = (_unpacked(pairs.column(c), np.int64) for c in ("customers", "tables"))
        seen[b.order] = np.where(customers > 0, customers - discount * tables / SAMPLES, 0.0)

        at = place_in(f.tokens, b.tokens)
        # without an answer, a token that is not frequent occurs once, here, or never
        n = np.where(at < 0, np.bincount(b.w, b.n, len(b.tokens)).astype(np.int64), f.n[at])
        place = place_in(b.tokens, rare.column("token").to_numpy())
        n[place] = rare.column("n").to_numpy()
        # a token of one occurrence has one customer and one table on every level, one of none has nothing
        history = np.repeat((n[:, None] == 1).astype(np.float64), 3 * SAMPLES, axis=1).reshape(len(n), SAMPLES, 3)
        several = pa.compute.is_valid(rare.column("history"))
        rest = rare.filter(several)
        if rest.num_rows:
            history[place[several.to_numpy()]] = _flat(rest, "history").reshape(rest.num_rows, -1, 3)[:, -SAMPLES:]
        base = np.log10((n + 0.5) / (tokens + 0.5 * (distinct + 1)))
        values = []
        for i, state in enumerate(states):
            opened, customers, t = history[:, i].T
            opened = np.where(at < 0, opened, state.opened[at])
            inside = np.where(at < 0, inside_of(customers, t, b.k, state.stats, state.discount), state.inside[at])
            values.append(((CONCENTRATION + discount * opened) / (CONCENTRATION + n), state.between, inside))
        score = np.empty(len(b.at))
        for start in range(0, len(score), CHUNK):
            some = slice(start, start + CHUNK)
            u, w = b.before[some], b.at[some]
            p = seen[b.which[some]] / (CONCENTRATION + n[u])
            for parent, between, inside in values:
                p += parent[u] * between[b.k[u], b.k[w]] * inside[w] / SAMPLES
            score[some] = np.log10(p)
        starts = np.cumsum(b.sizes) - b.sizes
        figures = b.sizes, np.add.reduceat((n > 0).astype(np.int64)[b.at], starts), np.add.reduceat(base[b.at], starts), np.add.reduceat(score, starts)
        columns = [left.column("doc_id"), left.column("held_out"), *(pa.array(x, t) for x, t in zip(figures, (pa.int64(), pa.int64(), pa.float64(), pa.float64())))]
        return pa.table(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def _frequent_from(counted: DataFrame) -> int:
    """Least count of a frequent token: two at least, and so that there are at most ``FREQUENT``."""
    sizes = counted.groupBy(F.least("n", F.lit(1 << 20)).alias("n")).agg(F.count("*").alias("tokens")).collect()  # some ten thousand rows
    least, found = 1 << 62, 0
    for r in sorted(sizes, reverse=True):
        found += r.tokens
        if r.n < 2 or found > FREQUENT:
            break
        least = r.n
    return least


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Base and model scores of every row of ``docs``, learnt from those with a CRC-32 of the id not in fold ``held``.

    Columns ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known``, ``train_tokens``, ``base_score``
    (smoothed unigram) and ``score`` (log10 probability by the model). Every word is a context of its own: the next token
    comes from the restaurant of the word before it. Its tables are the customers of the parent level, which draws the
    class of the next token from the restaurant of the class before it (below a root restaurant that all classes share)
    and the token from the restaurant of its class, whose base is uniform over the class's tokens and one unknown token.
    All levels are seated by the same Gibbs sweeps; predictive probabilities are averaged over the kept seatings.
    Perplexity of a set of documents: 10 ** (-sum(score) / sum(n_tokens)).

    Counts cover all training texts and all pairs of words. Documents are dealt over blocks of bounded size; a block sends
    its distinct pairs in lists, one to each bucket, and gets their answers back in the same order. A bucket adds up the
    counts of its pairs. Cells seen more than once stay where they are while a sweep seats them: their tables follow from
    the values of both words, so a sweep returns only sums. Values of the ``FREQUENT`` most frequent tokens are broadcast
    as arrays; cells with any other token are joined with its values, which are few, as it is rare. Cells of frequent
    words before are dealt by both words. Sent whole are only arrays of fixed size: frequent tokens and pairs of classes.

    Null texts count as empty and have the end only. Rows with a null id are never held out. Repeated rows are counted
    and scored one by one. With no training rows every token is unknown. An empty table gives no rows; other columns are
    ignored.
    """
    sc = docs.sparkSession.sparkContext
    held_out = F.coalesce(fold(id_col, folds) == held, F.lit(False))
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"), held_out.alias("held_out"))
    kind = dict(slim.dtypes)["doc_id"]
    size = slim.agg(F.sum(F.length("__text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    buckets = -(-blocks // BLOCKS)
    text_block = F.pmod(F.xxhash64("doc_id", F.xxhash64("__text")), F.lit(blocks)).cast("long")
    blocked = slim.withColumns({"block": text_block, "train": ~F.col("held_out")})

    counted = slim.where(~F.col("held_out")).select("__text").mapInArrow(_tokens, "token long, n long, ending long")
    counted = materialize(counted.groupBy("token").agg(F.sum("n").alias("n"), F.min("ending").alias("ending")), "tokens", free=True)
    top = np.array([r.token for r in counted.orderBy(F.desc("n"), "token").limit(OWN).collect()], np.int64)
    totals = counted.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()
    tokens, distinct = int(totals["tokens"] or 0), int(totals["distinct"])
    least = _frequent_from(counted)
    sent = counted.where(F.col("n") >= least).toArrow().sort_by("token")  # at most FREQUENT rows
    ids, n, k = (sent.column(c).to_numpy().copy() for c in ("token", "n", "ending"))
    own = place_in(ids, top)
    k[own[own >= 0]] = np.flatnonzero(own >= 0)
    shared = sc.broadcast(Frequent(ids, np.append(k, 0), np.append(n, 0)))
    top_rows = F.broadcast(docs.sparkSession.createDataFrame([(int(t), i) for i, t in enumerate(top)], "token long, own long"))
    rare = counted.where(F.col("n") < least).join(top_rows, "token", "left").select("token", "n", F.coalesce("own", "ending").alias("class"))

    schema = "block long, bucket int, us binary, runs binary, ws binary, n binary, rest_u array<long>, rest_w array<long>"
    bundles = materialize(blocked.select("block", "__text", "train").groupBy("block").applyInArrow(_bundles(top, buckets, shared), schema), "bundles", free=True)
    counts = _added(bundles.where("bucket = -1").select("ws", "n").mapInArrow(_class_pairs, "part int, sums array<double>"), CLASSES * CLASSES)
    pairs = bundles.where("bucket >= 0")
    schema = "bucket int, token long, after long, n long, iu int, iw int"
    cells = materialize(pairs.select("bucket", "us", "runs", "ws", "n", "rest_u", "rest_w").groupBy("bucket").applyInArrow(_cells(shared), schema), "cells", free=True)
    repeated = cells.agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") == 2, 1)).alias("twos"), F.count("token").alias("joined")).first()
    discount = discount_of(tokens - (repeated["n"] or 0), repeated["twos"])

    def joined(seated: DataFrame, numbers: int) -> DataFrame:
        """Cells with a token that is not frequent, with the class and history of it; it has less than ``least`` cells."""
        none = F.lit(0).cast("long"), F.array_repeat(F.lit(0.0), numbers)
        of_u, of_w = (seated.select(F.col("token").alias(on), F.col("class").alias(k), F.col("history").alias(h)) for on, k, h in (("token", "ku", "hu"), ("after", "kw", "hw")))
        u, w = F.col("iu") < 0, F.col("iw") < 0
        with_u, with_w = ["bucket", "token", "after", "n", "iu", "iw", "ku", "hu"], ["kw", "hw"]
        both = others.where(u & w).join(of_u, "token").join(of_w, "after").select(*with_u, *with_w)
        first = others.where(u & ~w).join(of_u, "token").select(*with_u, none[0].alias("kw"), none[1].alias("hw"))
        second = others.where(~u & w).join(of_w, "after").select(*with_u[:6], none[0].alias("ku"), none[1].alias("hu"), *with_w)
        return both.union(first).union(second)

    # cells of one occurrence have a table each, so tables are occurrences less the excess n - t of repeated cells; the same
    # holds for tokens of one occurrence in the restaurants of their classes
    once = rare.where("n = 1").groupBy("class").agg(F.count("*").alias("v")).collect()  # one row for each class
    several = rare.where("n > 1").select("token", "class", "n", F.array(F.col("n").cast("double"), F.col("n").cast("double"), F.lit(0.0)).alias("history"))
    several = materialize(several, "seated", free=True)
    stats, inside_discount, size, n, k = np.zeros((CLASSES, 3)), 0.5, len(ids), n.astype(np.float64), k.astype(np.int64)
    state, past = State(np.zeros(size + 1), np.zeros(size + 1), np.zeros((CLASSES, CLASSES)), stats, inside_discount), []
    known, others = cells.where("token IS NULL").select("iu", "iw", "n"), materialize(cells.where("token IS NOT NULL"), "others", free=True)
    for sweep in range(-1, BURN_IN + SAMPLES):
        now = sc.broadcast(state)
        excess = _added(known.mapInArrow(_excess(shared, now, discount, sweep, False), "part int, sums array<double>"), 2 * size + CLASSES * CLASSES)
        seating = several.withColumns({"eu": F.lit(0.0), "ew": F.lit(0.0)})
        if repeated["joined"]:
            schema = "part int, sums array<double>, token long, eu double, ew double"
            out = joined(several, 3 * max(1, sweep - BURN_IN + 1)).mapInArrow(_excess(shared, now, discount, sweep, True), schema)
            out = materialize(out, "excess", free=True)
            excess += _added(out.where("part IS NOT NULL").select("part", "sums"), len(excess))
            ends = out.where("token IS NOT NULL").groupBy("token").agg(F.sum("eu").alias("eu"), F.sum("ew").alias("ew"))
            seating = several.join(ends, "token", "left").fillna(0.0, ["eu", "ew"])
        seating = seating.select("token", "class", "n", "history", "eu", "ew").mapInArrow(_seated(stats, inside_discount, sweep), "token long, class long, n long, history array<double>")
        before, several = several, materialize(seating, "seated", free=True)
        discard(before, *([out] if repeated["joined"] else []))
        now.destroy()

        opened, customers = n - excess[:size], n - excess[size : 2 * size]
        t = token_tables(ids, customers, k, stats, inside_discount, sweep)
        stats = np.stack([np.bincount(k, x, CLASSES) for x in (np.ones(size), customers, t)], axis=1)
        ones, twos = (customers == 1).sum(), (customers == 2).sum()
        for r in once:
            stats[r["class"]] += r.v
            ones += r.v
        c = F.element_at("history", -2)
        counts_of = [F.count(F.when(c == i, 1)).alias(name) for i, name in ((1, "ones"), (2, "twos"))]
        for r in several.groupBy("class").agg(F.count("*").alias("v"), F.sum(c).alias("c"), F.sum(F.element_at("history", -1)).alias("t"), *counts_of).collect():  # one row for each class
            stats[r["class"]] += (r.v, r.c, r.t)
            ones, twos = ones + r.ones, twos + r.twos
        inside_discount = discount_of(ones, twos)
        between = Contexts((counts - excess[2 * size :]).reshape(CLASSES, CLASSES)).predictive()
        state = State(np.append(opened, 0), np.append(inside_of(customers, t, k, stats, inside_discount), 0), between, stats, inside_discount)
        if sweep >= BURN_IN - 1:
            past.append(state)

    seatings = sc.broadcast(past[:-1])
    kept = joined(several, 3 * (SAMPLES + 1)).mapInArrow(_kept_rare(shared, seatings, discount), "bucket int, token long, after long, kept double")
    answers = pairs.groupBy("bucket").cogroup(kept.groupBy("bucket")).applyInArrow(_answers(shared, seatings, discount), "block long, bucket int, customers binary, tables binary")
    answers = materialize(answers, "answers", free=True)
    seatings.destroy()
    asked = bundles.where("bucket < -1").select("block", F.explode("rest_u").alias("token"), (F.col("bucket") == -3).alias("once"))
    histories = several.select("token", "n", "history").union(rare.where("n = 1").select("token", "n", F.lit(None)))
    about = asked.join(histories, "token").where("n > 1 OR NOT once")  # the block knows what occurs in it alone, once
    about = materialize(about.select("block", "token", "n", "history"), "asked-tokens", free=True)
    discard(bundles, cells, others, several, counted)
    samples = sc.broadcast(past[1:])
    none = F.lit(None)
    answers = answers.select("block", "bucket", "customers", "tables", none.cast("long").alias("token"), none.cast("long").alias("n"), none.cast("array<double>").alias("history")).union(
        about.select("block", none.cast("int"), none.cast("binary"), none.cast("binary"), "token", "n", "history")
    )
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    scored = blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scored(top, buckets, shared, samples, discount, tokens, distinct), schema)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


QUERIES = {"op8_pitman_yor_scores": query}
ORACLE: dict[str, str] = {}
