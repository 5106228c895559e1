"""Source divergence audit: a cube of (group block, group block, term block) cells.

A task owns one cell: it gets the slices of both group blocks that fall into its term block, computes what these terms add
to the divergence of every pair of groups, and the parts are added along the term axis.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import materialize, table

#: Probabilities are whole parts of this number.
UNIT = 1_000_000_000
#: Documents of a language that must hold a term; ranks kept in the term part.
LEAST_DOCS, TOP = 3, 200
#: Groups of a block and (about) kept terms of a block: a cell holds at most 2 * 32 * 4,096 counts, give or take chance.
GROUP_BLOCK, TERM_BLOCK = 32, 4_096
#: Terms by group in the counters of a task; fuller ones are passed on and started anew.
COUNTER = 800_000

#: A-Z in lower case; every other byte below 0x80 that is no letter parts terms.
_LETTERS = bytes(i + 32 if 65 <= i <= 90 else i if i >= 128 or 97 <= i <= 122 else 32 for i in range(256))


def _count(batches):
    """Occurrences of each term and documents that hold it, by language and source, pre-added in the task."""
    seen: dict = {}

    def flush():
        for (lang, source), (n, docs) in seen.items():
            terms = pa.array([t.decode("utf-8", "replace") for t in n])
            group = [pa.repeat(name, len(terms)) for name in (lang, source)]
            holders = pa.array([docs[t] for t in n], pa.int64())
            yield pa.RecordBatch.from_arrays([*group, terms, pa.array(n.values(), pa.int64()), holders], names=["lang", "source", "term", "n", "docs"])

    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            terms = text.translate(_LETTERS).split()  # only the space is left of the white space of bytes
            if terms:
                n, docs = seen.get((lang, source)) or seen.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                n.update(terms)
                docs.update(set(terms))
                size += len(n) - before
                if size > COUNTER:
                    yield from flush()
                    seen.clear()
                    size = 0
    yield from flush()


def term_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` and ``docs`` of every term of a group. Nulls are empty texts."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text("lang").alias("lang"), text("source").alias("source"), F.encode(text(text_col), "UTF-8").alias("text"))
    found = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + terms)), in decimals, so that no product overflows; 1 without terms."""
    top = (count.cast("decimal(20,0)") + 1) * UNIT
    return F.lit(1) + F.call_function("div", top, F.greatest(total + terms, F.lit(1)).cast("decimal(20,0)"))


def _excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); both are at most UNIT + 1, so the square fits 64 bits."""
    return (p - q) ** 2 // q


def cell_divergence(cell: pd.DataFrame) -> pd.DataFrame:
    """What the terms of one cell add to the divergence of its pairs, beyond terms that neither group holds.

    ``cell``: rows of a group (null ``term``, ``p`` of an absent term) and of its terms in this block (``p`` of the term). A
    term that neither group of a pair holds adds the same for every term of the language, so the caller adds that part;
    here its value is taken off wherever one of the groups holds the term.
    """
    groups = cell[cell["term"].isna()]
    names = pd.Index(groups["source"])
    base, side = groups["p"].to_numpy(), groups["block"].to_numpy()
    held = cell[cell["term"].notna()]
    column, terms = pd.factorize(held["term"])
    shares = np.repeat(base[:, None], len(terms), axis=1)
    own = np.zeros(shares.shape, bool)
    line = names.get_indexer(held["source"])
    shares[line, column] = held["p"].to_numpy()
    own[line, column] = True
    one, other = int(cell["a"].iloc[0]), int(cell["b"].iloc[0])
    pairs = []
    for g in range(len(names)):
        # a block meets the other block; within one block every ordered pair is made
        partners = np.flatnonzero(side == (other if side[g] == one else one))
        partners = partners[partners != g]
        if not len(partners) or not len(terms):
            continue
        some = own[g] | own[partners]
        extra = np.where(some, _excess(shares[g], shares[partners]) - _excess(base[g], base[partners])[:, None], 0).sum(axis=1)
        pairs.append(pd.DataFrame({"source": names[g], "item": names[partners], "extra": extra}))
    out = pd.concat(pairs) if pairs else pd.DataFrame({"source": [], "item": [], "extra": []})
    out.insert(0, "lang", cell["lang"].iloc[0])
    return out.astype({"lang": object, "source": object, "item": object, "extra": "int64"})


def _cells(rows: DataFrame, shape: DataFrame) -> DataFrame:
    """A copy of each row for every cell of its group block: all block pairs that hold it, smaller block first."""
    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = rows.join(shape.select("lang", "blocks"), "lang").withColumn("__other", blocks)
    return met.withColumns({"a": F.least("block", "__other"), "b": F.greatest("block", "__other")}).drop("blocks", "__other")


def divergence(docs: DataFrame, text_col: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang``, ``source``, ``part`` (``pair``, ``term``), ``item``, ``value`` and ``rank``.

    ``pair``: every other source of the language with the divergence of the group's terms from its terms, all ranks.
    ``term``: the group's terms that are more frequent than in the whole language, the first ``top``.

    A null language, source or text is an empty one. Repeated rows count as often as they occur. Groups without terms are
    part of all pairs; a language without kept terms has values of 0. A language with one source has no pair. An empty
    table gives no rows; other columns are ignored.

    Counts of terms are added in the tasks before they are shuffled, then by (language, source, term), so no language or
    source is one task. The only tables that are broadcast or sorted as a whole have one row for each group or language,
    and the result itself has one row for each pair of groups.
    """
    names = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    counts = materialize(term_counts(docs, text_col), "term-counts")
    groups = docs.select(names("lang").alias("lang"), names("source").alias("source")).distinct()
    totals = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = materialize(counts.join(totals.where(F.col("docs") >= least_docs).drop("docs"), ["lang", "term"]).drop("docs"), "kept-terms")

    # one row for each language and group
    by_lang = kept.groupBy("lang", "term").agg(F.max("lang_n").alias("n")).groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    shape = (
        groups.groupBy("lang")
        .agg(F.count("*").alias("n_groups"))
        .join(by_lang, "lang", "left")
        .select(
            "lang",
            F.coalesce("terms", F.lit(0)).alias("terms"),
            F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
            F.ceil(F.col("n_groups") / GROUP_BLOCK).cast("int").alias("blocks"),
            F.greatest(F.lit(1), F.ceil(F.coalesce("terms", F.lit(0)) / TERM_BLOCK)).cast("int").alias("slabs"),
        )
    )
    shape = materialize(shape, "shape")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(sums, ["lang", "source"], "left").join(shape, "lang").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), "terms", "lang_total", "slabs",
        F.pmod(F.xxhash64("source"), F.col("blocks").cast("long")).cast("int").alias("block"),
    )
    groups = groups.withColumn("base", _share(F.lit(0), F.col("total"), F.col("terms")))
    groups = materialize(groups, "groups")
    rows = kept.join(groups, ["lang", "source"])
    shares = rows.withColumns(
        {"p": _share(F.col("n"), F.col("total"), F.col("terms")), "q": _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))}
    )

    of_term = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    of_term = of_term.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    slab = F.pmod(F.xxhash64("term"), F.col("slabs").cast("long")).cast("int")
    slices = shares.select("lang", "source", "block", slab.alias("slab"), "term", "p")
    bases = groups.withColumn("slab", F.explode(F.sequence(F.lit(0), F.col("slabs") - 1))).select(
        "lang", "source", "block", "slab", F.lit(None).cast("string").alias("term"), F.col("base").alias("p")
    )
    cube = _cells(slices.unionByName(bases), shape)
    extra = cube.groupBy("lang", "a", "b", "slab").applyInPandas(cell_divergence, "lang string, source string, item string, extra long")
    extra = extra.groupBy("lang", "source", "item").agg(F.sum("extra").alias("extra"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("q"))
    pairs = groups.join(other, "lang").where("source <> item").join(extra, ["lang", "source", "item"], "left")
    value = F.coalesce(F.expr("terms * ((base - q) * (base - q) div q)"), F.lit(0)) + F.coalesce("extra", F.lit(0))
    of_pair = pairs.select("lang", "source", "item", value.alias("value")).withColumn("rank", F.row_number().over(best))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return of_pair.withColumn("part", F.lit("pair")).select(columns).unionByName(of_term.withColumn("part", F.lit("term")).select(columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
spelled AS (SELECT d, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT d) AS docs FROM spelled GROUP BY ALL),
langs AS (SELECT lang, term, sum(n) AS lang_n FROM counts GROUP BY ALL HAVING sum(docs) >= {LEAST_DOCS}),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM langs GROUP BY lang),
own AS (SELECT lang, source, sum(n) AS total FROM counts JOIN langs USING (lang, term) GROUP BY ALL),
grid AS (SELECT g.lang, g.source, l.term, coalesce(c.n, 0) AS n,
  1 + {UNIT} * (coalesce(c.n, 0) + 1)::HUGEINT // (coalesce(o.total, 0) + s.v)::HUGEINT AS p, 1 + {UNIT} * (l.lang_n + 1)::HUGEINT // (s.lang_total + s.v)::HUGEINT AS q
  FROM groups g JOIN langs l USING (lang) JOIN sizes s USING (lang) LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = l.term),
summed AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN summed s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM grid WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""

QUERIES = {"op13_source_divergence": query}
ORACLE = {"op13_source_divergence": SQL}
