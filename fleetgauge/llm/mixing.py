"""Mixing sources to target weights: token budgets passed down a tree, documents taken as prefixes of seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import materialize, row_tag, running_total, seeded_order, small, table

LEVELS = ["domain", "lang", "source"]
SEED = 7
#: Share of all tokens that is asked for, and how often a document may be taken.
SHARE_PERCENT, EPOCHS = 60, 2
#: The pipeline keeps nine tenths of the tokens and takes no document twice.
STAGE_PERCENT, STAGE_EPOCHS = 90, 1
#: Weights of languages (fixed parameters of the registered query); every other node weighs DEFAULT_WEIGHT.
WEIGHTS = {("lang", "en"): 3, ("lang", "de"): 2, ("lang", "fr"): 2, ("lang", "es"): 2}
DEFAULT_WEIGHT = 1


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space; 0 for a null or blank text."""
    trimmed = F.regexp_replace(text, r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$", "")
    return F.when(F.coalesce(trimmed, F.lit("")) == "", 0).otherwise(F.size(F.split(trimmed, r"[ \t\n\x0B\f\r]+"))).cast("long")


def domain_of(source: Column) -> Column:
    """Sources have no domain in the tables; they form four by the last digit of their name."""
    return F.concat(F.lit("d"), F.coalesce(F.regexp_extract(source, "([0-9])$", 1).try_cast("int") % 4, F.lit(0)).cast("string"))


def _weight(level: str, weights: dict) -> Column:
    own = {name: w for (at, name), w in weights.items() if at == level}
    column = F.lit(DEFAULT_WEIGHT)
    for name, w in own.items():
        column = F.when(F.col(level) == name, w).otherwise(column)
    return column.cast("long")


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Splits each parent's ``budget`` over its children by ``weight``, none above its ``capacity``.

    Children that cannot use their part are filled, and what they leave goes to their siblings by weight, until the rest
    can use theirs. Children are taken by capacity per weight, so running totals decide which are filled. Parts are whole
    tokens, rounded down. Columns in: parent columns, ``name``, ``weight``, ``capacity``, ``budget`` (of the parent).
    """
    order = Window.partitionBy(*parent).orderBy((F.col("capacity") / F.col("weight")), name)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    weight = F.sum("weight").over(after)
    rows = nodes.withColumns({"__left": left, "__weight": weight})
    short = F.col("capacity") * F.col("__weight") <= F.col("__left") * F.col("weight")
    rows = rows.withColumn("__short", short)
    # from the first child that is not filled on, all share what was left there
    open_first = order.rowsBetween(Window.unboundedPreceding, 0)
    at = lambda c: F.first(F.when(~F.col("__short"), F.col(c)), ignorenulls=True).over(open_first)
    rows = rows.withColumns({"__l": at("__left"), "__w": at("__weight")})
    part = F.when(F.col("__l").isNull(), F.col("capacity")).otherwise(F.floor(F.expr("(__l * weight) div __w")))
    return rows.withColumn("part", part.cast("long")).drop("__left", "__weight", "__short", "__l", "__w")


def budgets(leaves: DataFrame, percent: int, epochs: int, levels: list[str], weights: dict) -> DataFrame:
    """Token budget of every leaf: ``leaves`` has the level columns and ``tokens``.

    The whole budget (``percent`` of all tokens) goes from the root to the leaves. A subtree can use ``epochs`` times its
    tokens. As a parent never gets more than its subtree can use, a leaf's shortage is made up by its siblings first and
    reaches the next higher level only when the whole subtree is short.
    """
    spent = leaves.agg(F.expr(f"sum(tokens) * {percent} div 100").alias("budget"))
    tree, parent = None, []
    for level in levels:
        own = [*parent, level]
        children = leaves.groupBy(*own).agg((F.sum("tokens") * epochs).alias("capacity")).withColumn("weight", _weight(level, weights))
        if tree is None:
            children = children.join(F.broadcast(spent))  # one row
        else:
            children = children.join(tree.select(*parent, F.col("part").alias("budget")), parent)
        tree, parent = share_out(children, parent or [F.lit(0)], level), own
    return tree.select(*levels, F.col("part").alias("budget"))


def mix_sources(
    docs: DataFrame, percent: int = SHARE_PERCENT, epochs: int = EPOCHS, weights: dict | None = None, seed: int = SEED,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """How often each document is taken: one row per row of ``docs``.

    Columns ``doc_id``, ``domain``, ``lang``, ``source``, ``n_tokens``, ``leaf_tokens``, ``leaf_budget``, ``copies``. A
    leaf's budget takes whole epochs of the leaf and then a prefix of one more: documents in the order of an MD5 of seed,
    epoch and id (ties by text order of the id) as long as they begin before the budget ends, so a leaf may exceed its
    budget by part of a document. A leaf with a third of all rows is cut into many ordered ranges.

    A null language, source or domain is a node of its own (named ``~``). Null and blank texts have no tokens: they are
    taken in every whole epoch and where the prefix reaches them. Repeated rows count and are ordered as often as they
    occur. Null ids are ordered as an empty id. An empty table gives no rows; other columns are ignored.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("~"))
    slim = docs.select(
        F.col(id_col).alias("doc_id"), name(lang_col).alias("lang"), name(source_col).alias("source"), n_tokens(F.col(text_col)).alias("n_tokens")
    ).withColumn("domain", domain_of(F.col("source")))
    slim = materialize(slim, "sizes")
    leaves = materialize(slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")), "leaves")
    rows = leaves.agg(F.sum("rows")).first()[0] or 0
    plan = budgets(leaves, percent, epochs, LEVELS, WEIGHTS if weights is None else weights)
    whole = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0))
    plan = plan.join(leaves, LEVELS).select(*LEVELS, "tokens", "budget", F.least(whole, F.lit(epochs)).cast("long").alias("whole"))
    plan = materialize(plan.withColumn("last", F.col("budget") - F.col("whole") * F.col("tokens")), "plan")
    marked = slim.join(small(plan), LEVELS)
    name = F.col("doc_id")
    if dict(marked.dtypes)["doc_id"].startswith("struct"):  # an id and what tells its rows apart
        name = F.col("doc_id.doc_id")
    order = seeded_order(seed, F.col("whole").cast("string"), F.coalesce(name.cast("string"), F.lit("")))
    placed = running_total(marked.withColumn("__order", order), LEVELS, "__order", "doc_id", "n_tokens", "__before", rows)
    copies = F.col("whole") + F.when((F.col("__before") < F.col("last")), 1).otherwise(0)
    return placed.select(
        "doc_id", "domain", "lang", "source", "n_tokens", F.col("tokens").alias("leaf_tokens"), F.col("budget").alias("leaf_budget"), copies.cast("long").alias("copies")
    )


def keep_mixed(docs: DataFrame, percent: int = STAGE_PERCENT) -> DataFrame:
    """The rows of ``docs`` that are taken, each once.

    Rows are told apart by their id and all their columns. Of equal rows as many stay as are taken, which is all or none
    unless the leaf's prefix ends among them. Rows with a null id take part like all others.
    """
    rows = docs.withColumn("__row", F.struct(F.col("doc_id"), row_tag(docs).alias("tag")))
    taken = mix_sources(rows, percent, STAGE_EPOCHS, id_col="__row").groupBy(F.col("doc_id").alias("__key"))
    short = materialize(taken.agg(F.count_if(F.col("copies") > 0).alias("__stay"), F.count("*").alias("__all")).where("__stay < __all"), "left-out")
    marked = rows.join(short, F.col("__row").eqNullSafe(F.col("__key")), "left")
    kept = marked.where("__key IS NULL").select(docs.columns)
    if short.where("__stay > 0").isEmpty():
        return kept
    place = F.row_number().over(Window.partitionBy("__row").orderBy(F.lit(0)))  # the rows are equal
    part = marked.where("__stay > 0").withColumn("__place", place).where("__place <= __stay").select(docs.columns)
    return kept.unionByName(part)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def _level_sql(level: str, parent: list[str], budget_from: str) -> str:
    """One level of the tree: the same filling as ``share_out``."""
    cases = " ".join(f"WHEN {at} = '{name}' THEN {w}" for (at, name), w in WEIGHTS.items() if at == level)
    weight = f"CASE {cases} ELSE {DEFAULT_WEIGHT} END" if cases else str(DEFAULT_WEIGHT)
    own, by = ", ".join([*parent, level]), f"PARTITION BY {', '.join(parent)}" if parent else ""
    join = f"JOIN {budget_from} p USING ({', '.join(parent)})" if parent else f"CROSS JOIN {budget_from} p"
    over = f"OVER ({by} ORDER BY capacity / weight, {level}"
    before, after = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)", "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"""
{level}_c AS (SELECT {own}, CAST(sum(tokens) * {EPOCHS} AS BIGINT) AS capacity, CAST({weight} AS BIGINT) AS weight FROM leaves GROUP BY {own}),
{level}_b AS (SELECT c.*, p.part AS budget FROM {level}_c c {join}),
{level}_w AS (SELECT *, budget - coalesce(sum(capacity) {over} {before}, 0) AS l, sum(weight) {over} {after} AS w FROM {level}_b),
{level}_f AS (SELECT *, min(CASE WHEN capacity * w > l * weight THEN capacity / weight END) OVER ({by}) AS cut FROM {level}_w),
{level}_s AS (SELECT *, first_value(CASE WHEN capacity * w > l * weight THEN l END IGNORE NULLS) {over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ll,
  first_value(CASE WHEN capacity * w > l * weight THEN w END IGNORE NULLS) {over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ww FROM {level}_f),
{level}_p AS (SELECT {own}, CAST(CASE WHEN ll IS NULL THEN capacity ELSE (ll * weight) // ww END AS BIGINT) AS part FROM {level}_s)"""


SQL = f"""
WITH sizes AS (SELECT doc_id, coalesce(lang, '~') AS lang, coalesce(source, '~') AS source,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS n_tokens FROM documents),
docs AS (SELECT *, 'd' || CAST(coalesce(TRY_CAST(regexp_extract(source, '([0-9])$', 1) AS INTEGER) % 4, 0) AS VARCHAR) AS domain FROM sizes),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM docs GROUP BY ALL),
root AS (SELECT sum(tokens) * {SHARE_PERCENT} // 100 AS part FROM leaves),
{_level_sql("domain", [], "root")},
{_level_sql("lang", ["domain"], "domain_p")},
{_level_sql("source", ["domain", "lang"], "lang_p")},
plan AS (SELECT domain, lang, source, tokens, part AS budget, CASE WHEN tokens > 0 THEN least(part // tokens, {EPOCHS}) ELSE 0 END AS whole
  FROM source_p JOIN leaves USING (domain, lang, source)),
placed AS (SELECT doc_id, domain, lang, source, n_tokens, tokens, budget, whole, budget - whole * tokens AS last,
  coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5(concat_ws(':', '{SEED}', CAST(CAST(whole AS BIGINT) AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), ''))), doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM docs JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, CAST(tokens AS BIGINT) AS leaf_tokens, CAST(budget AS BIGINT) AS leaf_budget,
  CAST(whole + CASE WHEN earlier < last THEN 1 ELSE 0 END AS BIGINT) AS copies FROM placed
"""

QUERIES = {"op7_source_mixing": query}
ORACLE = {"op7_source_mixing": SQL}
