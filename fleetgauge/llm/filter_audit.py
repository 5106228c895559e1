"""Filter interaction audit: what every order of five filters keeps and removes at every step, by higher-order functions.

Documents shrink to counted cells of one failure mask each. A cell folds over the array of all orders with ``aggregate``
and gives one weighted struct per order and step; the structs of a part's cells are added by position.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import materialize, table

#: Filters by letter; bit i of a mask is set where filter i fails.
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Thresholds: fewest words, percent of distinct words, percent of capital letters, marks that must not occur.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, MARKS = 50, 65, 5, "#$%&*|"

_SPACES = r"[ \t\n\x0B\f\r]+"
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def _mask(text: Column) -> Column:
    """Bits of the filters that look at one text only (A to D)."""
    words = F.array_remove(F.split(text, _SPACES), "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    marked = F.length(F.translate(text, MARKS, "")) < F.length(text)
    fails = [
        n < LEAST_WORDS,
        F.size(F.array_distinct(words)) * 100 < n * DISTINCT_PERCENT,
        capitals * 100 > F.length(text) * CAPITAL_PERCENT,
        marked,
    ]
    return sum((F.when(fail, F.lit(1 << i)).otherwise(F.lit(0)) for i, fail in enumerate(fails)), F.lit(0))


def failure_cells(
    docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counted cells ``part``, ``mask``, ``good``, ``toxic``, ``n``: documents of a part that fail the same filters.

    Texts are compared by their SHA-256. A text's smallest id meets its rows on (digest, id), so a text with very many
    copies is dealt out by the ids of the copies. The narrow rows are written once, as they are read twice.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("digest"),
        _mask(text).alias("mask"),
    )
    slim = materialize(slim, "masks")
    firsts = slim.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("__first", F.lit(True))
    marks = labels.groupBy(F.col("doc_id").alias("__id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    rows = slim.join(firsts, ["digest", "doc_id"], "left").join(marks, slim["doc_id"] == F.col("__id"), "left")
    copy = slim["doc_id"].isNotNull() & F.col("__first").isNull()
    mask = F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)
    no = F.lit(False)
    return rows.groupBy("part", mask.alias("mask"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")).agg(F.count("*").alias("n"))


def _folded() -> Column:
    """One cell's struct for each order and step, in the order of ORDERS, from ``mask``, ``good``, ``toxic`` and ``n``.

    The fold carries whether the cell is still there and the structs so far; the step is the number of structs.
    """
    nothing, n = F.lit(0).cast("long"), F.col("n")
    entry = "struct<kept:bigint,removed:bigint,redundant:bigint,unique_fails:bigint,good_lost:bigint,toxic_lost:bigint>"

    def along(order: Column) -> Column:
        def step(state: Column, bit: Column) -> Column:
            fails = F.col("mask").bitwiseAND(bit) != 0
            there = state["there"]
            goes = there & fails

            def when(c: Column) -> Column:
                return F.when(c, n).otherwise(nothing)

            made = F.struct(
                when(there & ~fails).alias("kept"),
                when(goes).alias("removed"),
                when(fails & ~there).alias("redundant"),
                when(F.col("mask") == bit).alias("unique_fails"),
                when(goes & F.col("good")).alias("good_lost"),
                when(goes & F.col("toxic")).alias("toxic_lost"),
            )
            return F.struct((there & ~fails).alias("there"), F.concat(state["made"], F.array(made)).alias("made"))

        start = F.struct(F.lit(True).alias("there"), F.array().cast(f"array<{entry}>").alias("made"))
        return F.aggregate(order, start, step, lambda state: state["made"])

    return F.flatten(F.transform("orders", along))


def audit(cells: DataFrame) -> DataFrame:
    """``part``, ``filter_order``, ``step``, the counts of MEASURES and ``shapley``: 600 rows for every part.

    ``cells``: see ``failure_cells``. The array of orders is a one-row table and is broadcast. Cells are at most 128 for a
    part, so what is added by position does not grow with the documents.
    """
    spark = cells.sparkSession
    bits = [[1 << FILTERS.index(letter) for letter in order] for order in ORDERS]
    orders = spark.createDataFrame([(bits,)], "orders array<array<int>>")
    folded = cells.join(F.broadcast(orders)).select("part", F.posexplode(_folded()).alias("at", "s"))
    summed = folded.groupBy("part", "at").agg(*[F.sum(f"s.{m}").alias(m) for m in MEASURES])
    place, steps = F.col("at"), len(FILTERS)
    name = F.get(F.array(*[F.lit(order) for order in ORDERS]), F.floor(place / steps).cast("int"))
    named = summed.select("part", name.alias("filter_order"), (place % steps + 1).cast("int").alias("step"), *MEASURES)
    own = Window.partitionBy("part", F.expr("substring(filter_order, step, 1)"))  # 120 rows
    return named.withColumn("shapley", F.sum("removed").over(own))


def interactions(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The audit of ``docs`` by ``part_col``.

    A null text is an empty text, a null part the empty part. A null id is no copy of any row and no row is a copy of it;
    it has no label. Rows of one id and one text are no copies of each other. A document with several labels is good or
    toxic if one of them says so; null labels say nothing. An empty table has no parts and gives no rows; other columns of
    either table are ignored.
    """
    return audit(failure_cells(docs, labels, part_col, id_col, text_col))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_CAPITALS = "length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))"
_ORDER_ROWS = ", ".join(f"('{o}')" for o in ORDERS)
SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM documents),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  {{'A': len(w) < {LEAST_WORDS}, 'B': 100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w), 'C': 100 * ({_CAPITALS}) > {CAPITAL_PERCENT} * length(t),
   'D': regexp_matches(t, '[{MARKS}]'), 'E': coalesce(texts.doc_id > min(texts.doc_id) OVER (PARTITION BY t), false)}} AS f
  FROM texts LEFT JOIN marks USING (doc_id)),
cells AS (SELECT part, good, toxic, f, count(*) AS n FROM judged GROUP BY ALL),
orders AS (SELECT * FROM (VALUES {_ORDER_ROWS}) AS v(filter_order)),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, substr(filter_order, s, 1) AS letter, substr(filter_order, 1, s - 1) AS before FROM orders, range(1, 6) AS r(s)),
failed AS (SELECT *, (CASE WHEN f.A THEN 'A' ELSE '' END) || (CASE WHEN f.B THEN 'B' ELSE '' END) || (CASE WHEN f.C THEN 'C' ELSE '' END)
  || (CASE WHEN f.D THEN 'D' ELSE '' END) || (CASE WHEN f.E THEN 'E' ELSE '' END) AS fails FROM cells),
met AS (SELECT *, contains(fails, letter) AS here, len(list_intersect(string_split(fails, ''), string_split(before, ''))) > 0 AND fails <> '' AND before <> '' AS gone
  FROM failed, steps),
counted AS (SELECT part, filter_order, step, letter, sum(CASE WHEN NOT gone AND NOT here THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN NOT gone AND here THEN n ELSE 0 END) AS removed, sum(CASE WHEN gone AND here THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN NOT gone AND here AND good THEN n ELSE 0 END) AS good_lost,
  sum(CASE WHEN NOT gone AND here AND toxic THEN n ELSE 0 END) AS toxic_lost FROM met GROUP BY ALL)
SELECT part, filter_order, step, {", ".join(f"CAST({m} AS BIGINT) AS {m}" for m in MEASURES)},
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM counted
"""

QUERIES = {"op12_filter_interactions": query}
ORACLE = {"op12_filter_interactions": SQL}
