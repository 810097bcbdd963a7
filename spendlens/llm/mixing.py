"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed per cell of source, language and topic. Raking scales the cells in turn until each of the
three margins has its target shares; a document's sampling probability is the ratio of its cell's raked tokens to its
natural ones, scaled so that the largest is 1 or to a given share of the tokens. A document is drawn by a hash of its
id, so a re-run draws the same ones. Everything is DataFrame functions; cells are far fewer than documents, and each
sweep is three windows over them. Every PLAN_SWEEPS sweeps the cells are written and read again.

Targets are natural shares raised to a power and normalised again (1 keeps them, 0 makes them equal), or tables of
(value, share). A value without a share in a given table has the target 0; shares need not add up to 1.

Cases: a null text has no tokens; a null source or language is the value "unknown". A cell without tokens has
probability 0 and draws nothing; its documents come back with all others. Rows without doc_id are drawn alike by the
hash of an empty id, repeated rows alike. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendlens.llm import common
from spendlens.session import apply_settings

DIMENSIONS = ("source", "lang", "topic")
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.8}
SWEEPS = 10
PLAN_SWEEPS = 2  # of one plan
SEED = 11
SHORT = 20  # words below which a text is a note

SPACES = r"[\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    """Number of words between white space."""
    return F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACES), "")).cast("long")


def topic_of(text: str = "text", words: str = "n_tokens") -> Column:
    """A text's kind by its marks: licence, table, symbols, note or prose."""
    t = F.coalesce(F.col(text), F.lit(""))
    return (
        F.when(t.rlike("(?i)licen[cs]e|all rights reserved"), "licence")
        .when(t.contains(" | "), "table")
        .when(t.rlike("[#$%&*]{3}"), "symbols")
        .when(F.col(words) < SHORT, "note")
        .otherwise("prose")
    )


def described(docs: DataFrame) -> DataFrame:
    """The rows with n_tokens, topic, and source and lang without nulls, as _n, _topic, _source, _lang."""
    rows = docs.withColumn("_n", n_words()).withColumn("_topic", topic_of("text", "_n"))
    for name in ("source", "lang"):
        rows = rows.withColumn(f"_{name}", F.coalesce(F.col(name).cast("string"), F.lit("unknown")))
    return rows


def rake(cells: DataFrame, targets: Mapping[str, DataFrame] | None = None, powers: Mapping[str, float] = POWERS, sweeps: int = SWEEPS) -> DataFrame:
    """Cells (_source, _lang, _topic, _n tokens) with ``_factor``: raked share by natural share, 0 without tokens."""
    rows = cells.where("_n > 0")
    grand = cells.agg(F.sum("_n").alias("_n")).select(F.col("_n").cast("double"))
    rows = rows.withColumn("_share", F.col("_n") / grand.scalar())
    for name in DIMENSIONS:
        if targets and name in targets:
            given = targets[name].select(F.col("value").alias(f"_{name}"), F.col("share").cast("double").alias(f"_t_{name}"))
            rows = rows.join(given, f"_{name}", "left").fillna(0.0, [f"_t_{name}"])
        else:
            natural = cells.where("_n > 0").groupBy(f"_{name}").agg((F.sum("_n") / grand.scalar()).alias("_p"))
            natural = natural.select(f"_{name}", F.pow("_p", F.lit(powers[name])).alias(f"_t_{name}"))
            rows = rows.join(natural, f"_{name}")
            rows = rows.withColumn(f"_t_{name}", F.col(f"_t_{name}") / natural.agg(F.sum(f"_t_{name}")).scalar())
    rows = rows.withColumn("_weight", F.col("_share"))
    for k in range(sweeps):
        if k % PLAN_SWEEPS == 0:
            rows = common.kept(rows)  # while a plan runs, the driver holds the metrics of every task of all its stages
        for name in DIMENSIONS:
            margin = F.sum("_weight").over(Window.partitionBy(f"_{name}"))
            rows = rows.withColumn("_weight", F.when(margin > 0, F.col("_weight") * F.col(f"_t_{name}") / margin).otherwise(0.0))
    return rows.select(*(f"_{d}" for d in DIMENSIONS), (F.col("_weight") / F.col("_share")).alias("_factor"))


def uniform(seed: int) -> Column:
    """A number from 0 to 1 fixed by the document's id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)


def scale_to(cells: DataFrame, share: float) -> DataFrame:
    """One row with the ``scale`` for which the tokens times min(1, scale * _factor) are ``share`` of all tokens.

    Cells (_n tokens, _factor) with the largest factors reach 1 first. If all cells that can be drawn hold less than
    the share, they are drawn whole.
    """
    by_factor = cells.groupBy("_factor").agg(F.sum("_n").cast("double").alias("_n"))  # at most one row for each cell
    order = Window.orderBy(F.desc("_factor")).rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum("_n").over(order), F.lit(0.0))
    rest = F.sum(F.col("_n") * F.col("_factor")).over(Window.orderBy(F.desc("_factor")).rowsBetween(0, Window.unboundedFollowing))
    wanted = F.lit(share) * F.sum("_n").over(Window.partitionBy())
    steps = by_factor.select("_factor", (wanted - full).alias("missing"), rest.alias("rest")).where("_factor > 0")
    fits = steps.select(F.when(F.col("missing") <= F.col("rest") / F.col("_factor"), F.col("missing") / F.col("rest")).alias("scale"), "_factor")
    first = F.max_by("scale", F.when(F.col("scale").isNotNull(), F.col("_factor")))
    return fits.agg(F.coalesce(first, 1 / F.min("_factor")).alias("scale"))


def sampled(
    docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, powers: Mapping[str, float] = POWERS, seed: int = SEED, share: float | None = None
) -> DataFrame:
    """The rows with _n, _topic, _factor, _probability and _drawn beside their own columns.

    Without ``share`` the largest probability is 1; with it the expected tokens are that share of all.
    """
    rows = described(docs)
    keys = [f"_{d}" for d in DIMENSIONS]
    cells = common.kept(rows.groupBy(*keys).agg(F.sum("_n").alias("_n")))
    factors = common.kept(rake(cells, targets, powers))
    if share is None:
        top = factors.agg(F.max("_factor").alias("top"))
        probability = F.col("_factor") / top.scalar()
    else:
        scale = scale_to(cells.join(factors, keys), share)
        probability = F.least(F.lit(1.0), F.col("_factor") * scale.scalar())
    scaled = factors.select(*keys, "_factor", probability.alias("_probability"))
    joined = rows.join(scaled, keys, "left").fillna(0.0, ["_factor", "_probability"])
    return joined.withColumn("_drawn", uniform(seed) < F.col("_probability"))


def report(docs: DataFrame) -> DataFrame:
    rows = sampled(docs.select("doc_id", "text", "source", "lang"))
    return rows.select(
        "doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_n").alias("n_tokens"),
        F.round("_factor", 6).alias("weight"), F.round("_probability", 6).alias("probability"), F.col("_drawn").alias("drawn"),
    )


def keep_drawn(docs: DataFrame, powers: Mapping[str, float] = POWERS, seed: int = SEED, share: float | None = None) -> DataFrame:
    """The drawn rows with their own columns."""
    rows, given = common.set_apart(docs, ["doc_id", "text", "source", "lang"])
    return sampled(rows, powers=powers, seed=seed, share=share).where("_drawn").select(*given)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    return report(common.read(spark, sf_dir, "documents"))


def sql(powers: Mapping[str, float] = POWERS, sweeps: int = SWEEPS, seed: int = SEED) -> str:
    """The same in SQL, one table per step of the raking."""
    head = r"""
WITH counted AS MATERIALIZED (
  SELECT doc_id, source, lang, coalesce(source, 'unknown') AS s, coalesce(lang, 'unknown') AS l, coalesce(text, '') AS text,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
  FROM documents
), docs AS MATERIALIZED (
  SELECT * EXCLUDE (text), CASE WHEN regexp_matches(text, '(?i)licen[cs]e|all rights reserved') THEN 'licence'
    WHEN contains(text, ' | ') THEN 'table' WHEN regexp_matches(text, '[#$%&*]{3}') THEN 'symbols'
    WHEN n < 20 THEN 'note' ELSE 'prose' END AS t
  FROM counted
), cells AS MATERIALIZED (
  SELECT s, l, t, sum(n) / (SELECT sum(n) FROM docs) AS p FROM docs GROUP BY ALL HAVING sum(n) > 0
)"""
    steps = []
    for short, name in zip("slt", DIMENSIONS):
        steps.append(f"""target_{short} AS MATERIALIZED (
  SELECT {short}, q / sum(q) OVER () AS q FROM (SELECT {short}, pow(sum(p), {powers[name]}) AS q FROM cells GROUP BY {short})
)""")
    last = "step_0"
    steps.append("step_0 AS MATERIALIZED (SELECT s, l, t, p, p AS w FROM cells)")
    for k in range(1, 3 * sweeps + 1):
        short = "slt"[(k - 1) % 3]
        steps.append(f"""step_{k} AS MATERIALIZED (
  SELECT s, l, t, p, w * q / sum(w) OVER (PARTITION BY {short}) AS w FROM {last} JOIN target_{short} USING ({short})
)""")
        last = f"step_{k}"
    return ",\n".join([head, *steps]) + f"""
SELECT doc_id, source, lang, t AS topic, n AS n_tokens, round(coalesce(w / p, 0), 6) AS weight,
  round(coalesce(w / p / top, 0), 6) AS probability,
  CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / pow(2, 52) < coalesce(w / p / top, 0) AS drawn
FROM docs LEFT JOIN {last} USING (s, l, t), (SELECT max(w / p) AS top FROM {last})
"""
