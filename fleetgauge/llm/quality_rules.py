"""Quality rules as a short-circuit cascade ordered by measured rejection per cost. DataFrame functions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import table

WORD = r"[^ \t\n\x0B\f\r]+"
SYMBOL = r"[#*$%&|<>]"
#: Rows that cost and selectivity are estimated on. They only set the order of the rules, never a result.
SAMPLE_ROWS = 400


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a condition over ``__text``, ``__words``, ``__lines`` and the base columns."""

    name: str
    rejects: Column


def _matching(items: str, pattern: str) -> Column:
    return F.size(F.filter(items, lambda x: x.rlike(pattern)))


def rules() -> list[Rule]:
    n, lines = F.col("n_words"), F.size("__lines")
    return [
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        Rule("repeated_lines", 2 * F.col("n_dup_lines") > lines),
        Rule("exclamations", 5 * F.regexp_count("__text", F.lit("!")) > n),
        Rule(
            "upper_case",
            2 * F.regexp_count("__text", F.lit("[A-Z]")) > F.regexp_count("__text", F.lit("[A-Za-z]")),
        ),
        Rule("bullets", 10 * _matching("__lines", r"^\s*[-*•]") > 9 * lines),
        Rule("ellipses", 10 * _matching("__lines", r"(\.\.\.|…)\s*$") > 3 * lines),
        Rule("words_without_letters", 10 * _matching("__words", r"\p{L}") < 8 * n),
    ]


def with_base(docs: DataFrame) -> DataFrame:
    """Adds the base columns to ``doc_id`` and ``__text``.

    Repeated windows are found by 64-bit hashes of three words inside the row: only a text with equal hashes is sorted by
    them, neighbours in that order are the repeats, and the words they cover are counted once each. No rows are exploded
    or shuffled.
    """
    texts = docs.withColumn("__text", F.coalesce("__text", F.lit("")))
    parts = texts.withColumns(
        {"__words": F.regexp_extract_all("__text", F.lit(WORD), 0), "__lines": F.filter(F.split("__text", "\n"), lambda x: x.rlike(WORD))}
    )
    m = F.greatest(F.size("__words") - 2, F.lit(0))
    pair = F.zip_with(F.slice("__words", 1, m), F.slice("__words", 2, m), lambda a, b: F.xxhash64(a, b))
    windows = F.when(m > 1, F.zip_with(pair, F.slice("__words", 3, m), lambda h, c: F.xxhash64(h, c)))
    parts = parts.withColumn("__windows", windows)
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    parts = parts.withColumn("__sorted", F.when(repeats, F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    k = F.size("__sorted") - 1
    covered = F.zip_with(
        F.slice("__sorted", 1, k),
        F.slice("__sorted", 2, k),
        lambda a, b: F.when(a["h"] == b["h"], F.array(*[x["i"] + d for x in (a, b) for d in (0, 1, 2)])).otherwise(F.array().cast("array<int>")),
    )
    based = parts.select(
        "doc_id", "__text", "__words", "__lines",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("__sorted").isNull(), 0).otherwise(F.size(F.array_distinct(F.flatten(covered)))).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return based.withColumn("base_failed", failed)


def ordered(based: DataFrame, found: list[Rule]) -> list[Rule]:
    """The rules by rejected rows per second of their own time on the sample; the fastest way to reject comes first."""
    sample = based.persist()
    sample.count()
    rank = []
    for rule in found:
        began = time.perf_counter()
        rejected = sample.agg(F.count(F.when(rule.rejects, 1))).first()[0]
        rank.append((-(rejected + 0.5) / (time.perf_counter() - began), rule))
    sample.unpersist()
    return [rule for _, rule in sorted(rank, key=lambda x: x[0])]


def cascade(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", found: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Base columns, ``base_failed``, ``kept`` and ``rejected_by`` of every row.

    ``kept``: the base does not fail and no rule rejects. ``rejected_by``: the first rule that rejects, in the order taken;
    a later rule is not evaluated for that row. The order comes from the first ``sample_rows`` rows and changes only the
    time and ``rejected_by``, never ``kept``.

    Null, empty and blank texts have no words and fail the base. Repeated rows and null ids are rows like all others;
    an empty table gives no rows; other columns are ignored.
    """
    found = rules() if found is None else found
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    rows = slim.select("__text").limit(sample_rows).collect()
    if rows:
        some = slim.sparkSession.createDataFrame(rows, "__text string").withColumn("doc_id", F.lit(0))
        found = ordered(with_base(some), found)
    based = with_base(slim)
    first = F.when(F.col("base_failed"), F.lit("base"))
    for rule in found:
        first = first.when(rule.rejects, F.lit(rule.name))
    return based.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", first.alias("rejected_by")
    ).withColumn("kept", F.col("rejected_by").isNull())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade(table(spark, sf_dir, "documents")).drop("rejected_by")


SQL = f"""
WITH parts AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM documents),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM parts),
threes AS (SELECT doc_id, i, word AS a, lead(word) OVER w AS b, lead(word, 2) OVER w AS c FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
found AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM threes WHERE c IS NOT NULL),
covered AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM found, (VALUES (0), (1), (2)) AS v(d) WHERE n > 1 GROUP BY doc_id),
base AS (SELECT doc_id, t, words, lines, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '{SYMBOL}')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM parts LEFT JOIN covered USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR {" OR ".join(f"({r})" for r in [
    "10 * n_symbols > n_words", "word_chars < 2 * n_words OR word_chars > 15 * n_words", "2 * n_dup_lines > len(lines)",
    "5 * len(regexp_extract_all(t, '!')) > n_words", "2 * len(regexp_extract_all(t, '[A-Z]')) > len(regexp_extract_all(t, '[A-Za-z]'))",
    r"10 * len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•]'))) > 9 * len(lines)",
    r"10 * len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) > 3 * len(lines)",
    r"10 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) < 8 * n_words",
  ])}) AS kept
FROM failed
"""

QUERIES = {"op5_quality_rules": query}
ORACLE = {"op5_quality_rules": SQL}
