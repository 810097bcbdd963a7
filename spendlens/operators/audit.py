"""Text audit: choose contracts, write prompts, read replies, score."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import StringType, StructField, StructType

from spendlens.functions.columns import first_asc, first_desc
from spendlens.operators.lookup import sample_key, sample_rows
from spendlens.operators.skew import COPIES, collapse, expand

SORT_COLUMNS = ("amount", "bid_rate")
AUDIT_COLUMNS = ("project_name", "outline", "amount", "ministry")
FAILED = "no valid reply"
FENCE = "```"


def audit_selection(
    detail: DataFrame,
    ministry: str | None = None,
    sort_by: str | None = None,
    top_n: int | None = None,
    sample_size: int = 100,
    seed: int = 0,
) -> DataFrame:
    """Contracts to audit: the top n by an allowed column, or a random sample.

    Other sort columns are ignored. Without ``top_n`` the sample is random.
    """
    rows = detail.where(F.col("project_name").isNotNull() & F.col("outline").isNotNull())
    if ministry is not None:
        rows = rows.where(F.col("ministry") == F.lit(ministry))
    if top_n:
        order = first_desc(sort_by) if sort_by in SORT_COLUMNS else []
        return rows.orderBy(*order, *first_asc(*AUDIT_COLUMNS)).limit(top_n).select(*AUDIT_COLUMNS)
    return sample_rows(collapse(rows, AUDIT_COLUMNS), sample_size, seed)


def audit_prompt(name: str = "project_name", outline: str = "outline") -> Column:
    """The question put to a scorer for one pair."""
    return F.concat(
        F.lit("Rate from 1 (unrelated) to 5 (same subject) how well the contract fits the project.\nProject: "),
        F.coalesce(F.col(name), F.lit("")),
        F.lit("\nContract: "),
        F.coalesce(F.col(outline), F.lit("")),
        F.lit('\nAnswer with JSON only: {"score": number, "reason": text}'),
    )


class Scorer(Protocol):
    """Answers prompts with reply texts, for example through a hosted model."""

    def __call__(self, prompts: Sequence[str]) -> Sequence[str | None]: ...


def ask_scorer(df: DataFrame, scorer: Scorer, prompt: str = "prompt") -> DataFrame:
    """Add ``reply``: the scorer's text for each prompt, on the executors."""
    schema = StructType([*df.schema.fields, StructField("reply", StringType())])

    def replies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(reply=list(scorer(batch[prompt].tolist())))

    return df.mapInPandas(replies, schema)


def parse_reply(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Add ``score`` and ``reason`` from a reply in JSON, code fences removed.

    A reply that is no JSON object scores 0 with a fixed reason; an object
    without a score keeps a NULL score.
    """
    text = F.replace(F.replace(F.trim(F.col(reply)), F.lit(FENCE + "json"), F.lit("")), F.lit(FENCE), F.lit(""))
    parsed = F.try_parse_json(text)
    valid = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return (
        df.withColumn("_parsed", parsed)
        .withColumn("_valid", valid)
        .withColumn("score", F.when(F.col("_valid"), F.try_variant_get("_parsed", "$.score", "double")).otherwise(0.0))
        .withColumn(
            "reason", F.when(F.col("_valid"), F.try_variant_get("_parsed", "$.reason", "string")).otherwise(FAILED)
        )
        .drop("_parsed", "_valid")
    )


def bigrams(column: str) -> Column:
    """Distinct character pairs of a text."""
    last = F.greatest(F.length(column) - 1, F.lit(0))
    starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(column), i, F.lit(2))))


def overlap_score(left: str, right: str) -> Column:
    """1 to 5 by shared character pairs; a stand-in for a hosted model's score."""
    shared = F.size(F.array_intersect(bigrams(left), bigrams(right)))
    either = F.size(F.array_union(bigrams(left), bigrams(right)))
    return F.when(either == 0, 1).otherwise(1 + F.floor(shared * 4 / either)).cast("int")


def audit_score(selection: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Scored pairs, worst first."""
    if scorer is None:
        scored = selection.withColumn("score", overlap_score("project_name", "outline").cast("double")).withColumn(
            "reason", F.lit("shared character pairs")
        )
    else:
        scored = parse_reply(ask_scorer(selection.withColumn("prompt", audit_prompt()), scorer)).drop("prompt", "reply")
    return scored.orderBy(*first_asc("score", *selection.columns))


@dataclass(frozen=True)
class _Step:
    """What ``audit_selection`` takes, for one step of a scenario."""

    ministry: str | None = None
    sort_by: str | None = None
    top_n: int | None = None
    sample_size: int = 100
    seed: int = 0

    @property
    def rows(self) -> int:
        return self.top_n or self.sample_size

    def takes(self) -> Column:
        return F.lit(True) if self.ministry is None else F.coalesce(F.col("ministry") == F.lit(self.ministry), F.lit(False))

    def order(self, rows: DataFrame) -> tuple[Column, Column]:
        """The value to sort by, largest first, and the random key, smallest first; one of them is null."""
        if not self.top_n:
            return F.lit(None).cast("double"), sample_key(rows, AUDIT_COLUMNS, "_no", self.seed)
        by = F.col(self.sort_by).cast("double") if self.sort_by in SORT_COLUMNS else F.lit(None).cast("double")
        return by, F.lit(None).cast("string")



def scenario_report(detail: DataFrame, scenarios: Sequence[dict[str, Any]]) -> DataFrame:
    """The selections of all steps of all scenarios, tagged with scenario and step.

    A scenario is {"scenario_name", "steps": [{"description", "params"}]};
    ``params`` are those of ``audit_selection``. All steps share one pass: every
    row is tested against each of them, every task keeps the first rows of each
    step, and one shuffle of these few rows decides.
    """
    steps = [
        (scenario["scenario_name"], step["description"], _Step(**step.get("params", {})))
        for scenario in scenarios
        for step in scenario.get("steps", [])
    ]
    usable = detail.where(F.col("project_name").isNotNull() & F.col("outline").isNotNull())
    if not steps:
        return usable.limit(0).select(F.lit("").alias("scenario"), F.lit("").alias("step"), *AUDIT_COLUMNS)
    if all(step.ministry is not None for *_, step in steps):
        usable = usable.where(F.col("ministry").isin(sorted({step.ministry for *_, step in steps})))
    more = [c for c in SORT_COLUMNS if c not in AUDIT_COLUMNS and any(step.top_n and step.sort_by == c for *_, step in steps)]
    folded = collapse(usable, [*AUDIT_COLUMNS, *more])
    before = F.lit(0).cast("long")
    if more:  # copies are numbered over all rows that are equal in what a sample shows
        others = Window.partitionBy(*AUDIT_COLUMNS).orderBy(*more).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum(COPIES).over(others), before)
    rows = expand(folded.withColumn("_before", before), index="_no", spread=True).withColumn("_no", F.col("_no") + F.col("_before"))
    tests = []
    for number, (_, _, step) in enumerate(steps):
        by, key = step.order(rows)
        tests.append(F.when(step.takes(), F.struct(F.lit(number).alias("number"), by.alias("by"), key.alias("key"))))
    asked = rows.withColumn("_asked", F.explode(F.filter(F.array(*tests), lambda t: t.isNotNull()))).select("*", "_asked.*")
    order = [F.desc_nulls_last("by"), F.asc_nulls_last("key"), *first_asc(*AUDIT_COLUMNS)]
    place = F.row_number().over(Window.partitionBy("number").orderBy(*order))
    most = max(step.rows for *_, step in steps)
    first = asked.withColumn("place", place).where(F.col("place") <= most)
    names = F.array(*[F.struct(F.lit(a).alias("scenario"), F.lit(b).alias("step"), F.lit(step.rows).alias("rows")) for a, b, step in steps])
    named = first.withColumn("_step", F.get(names, F.col("number"))).where("place <= _step.rows")
    return named.select("_step.scenario", "_step.step", *AUDIT_COLUMNS)
