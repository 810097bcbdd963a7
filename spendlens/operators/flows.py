"""Money flows: edges from project to payee, the onward path of a top payee, and money passed on over many blocks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spendlens.functions.columns import first_desc, first_asc, money_sum, percent
from spendlens.sources.published import stored

MOST_HOPS = 4


def fund_flow_edges(detail: DataFrame, min_value: float = 0.0) -> DataFrame:
    """source = project name, target = payee, value = sum of amounts over the minimum."""
    return (
        detail.groupBy(F.col("project_name").alias("source"), F.col("payee").alias("target"))
        .agg(money_sum("amount").alias("value"))
        .where(F.col("value") > min_value)
    )


def agent_flow(budget: DataFrame, spend: DataFrame, block_edges: DataFrame) -> DataFrame:
    """Per project: top payee, its share of the budget, the roles and onward blocks of its blocks.

    The role is written on the summary rows of a block, the payee on the detail
    rows; edges lead from the payee's block to the blocks it pays on to.
    """
    paid = spend.where(F.col("amount").isNotNull() & F.col("payee").isNotNull())
    per_block = paid.groupBy("project_id", "payee", "block_no").agg(money_sum("amount").alias("block_spend"))
    per_payee = per_block.groupBy("project_id", "payee").agg(money_sum("block_spend").alias("payee_spend"))
    top = (
        per_payee.groupBy("project_id")
        .agg(F.max(F.struct("payee_spend", "payee")).alias("top"))
        .select("project_id", "top.payee", "top.payee_spend")
    )
    budgets = budget.groupBy("project_id").agg(money_sum("total_amt").alias("budget_total"))
    roles = (
        spend.where(F.col("amount").isNull() & F.col("role").isNotNull())
        .groupBy("project_id", "block_no")
        .agg(F.max("role").alias("role"))
    )
    edges = (
        block_edges.where(F.col("src_block").isNotNull())
        .select("project_id", F.col("src_block").alias("block_no"), "dst_block")
        .distinct()
    )
    return (
        top.join(budgets, "project_id")
        .join(per_block, ["project_id", "payee"])
        .join(roles, ["project_id", "block_no"], "left")
        .join(edges, ["project_id", "block_no"], "left")
        .select(
            "project_id",
            "payee",
            "payee_spend",
            "budget_total",
            percent(F.col("payee_spend"), F.col("budget_total")).alias("budget_pct"),
            "block_no",
            "block_spend",
            "role",
            "dst_block",
        )
        .orderBy(*first_desc("payee_spend"), *first_asc("project_id", "block_no", "dst_block"))
    )


def edge_weights(spend: DataFrame, block_edges: DataFrame) -> DataFrame:
    """project_id, block_no, dst_block, weight: the share of a block's money that goes on to each of its next blocks.

    Shares follow the payments of the next blocks; where those add up to nothing, next blocks get equal shares.
    """
    paid = spend.where(F.col("amount") > 0).groupBy("project_id", F.col("block_no").alias("dst_block")).agg(money_sum("amount").alias("paid"))
    edges = block_edges.where(F.col("src_block").isNotNull() & F.col("dst_block").isNotNull())
    edges = edges.select("project_id", F.col("src_block").alias("block_no"), "dst_block").distinct()
    weighed = edges.join(paid, ["project_id", "dst_block"], "left").withColumn("paid", F.coalesce("paid", F.lit(0.0)))
    siblings = W.partitionBy("project_id", "block_no")  # blocks of one project, few
    total = F.sum(F.col("paid").cast("decimal(38,10)")).over(siblings).cast("double")
    share = F.when(total > 0, F.col("paid") / total).otherwise(F.lit(1.0) / F.count(F.lit(1)).over(siblings))
    return weighed.select("project_id", "block_no", "dst_block", share.alias("weight"))


def onward_flow(spend: DataFrame, block_edges: DataFrame, max_hops: int = MOST_HOPS) -> DataFrame:
    """project_id, origin, block_no, hops, share, amount: what of a block's payments arrives where after how many hops.

    A frontier of (project, origin, block) moves along the edges and is summed after every hop, so it never holds more
    rows than pairs of blocks of a project, however many paths lead there. Cycles end with the last hop: money that
    comes back to a block arrives there again. Payments and edges are read once: weights, origins and each frontier are
    written, small as they are, and read back.
    """
    weights = stored(edge_weights(spend, block_edges), "weights")
    origins = spend.where(F.col("amount").isNotNull()).groupBy("project_id", F.col("block_no").alias("origin")).agg(money_sum("amount").alias("origin_spend"))
    origins = stored(origins, "origins")
    frontier = origins.where("origin IS NOT NULL").select("project_id", "origin", F.col("origin").alias("block_no"), F.lit(1.0).alias("share"))
    reached = [frontier.withColumn("hops", F.lit(0))]
    for hop in range(1, max_hops + 1):
        moved = frontier.join(weights, ["project_id", "block_no"])
        summed = moved.groupBy("project_id", "origin", F.col("dst_block").alias("block_no")).agg(F.sum(F.col("share") * F.col("weight")).alias("share"))
        frontier = stored(summed, "frontier")
        reached.append(frontier.withColumn("hops", F.lit(hop)))
    every = reduce(DataFrame.unionByName, reached).join(origins, ["project_id", "origin"])
    rows = every.select("project_id", "origin", "block_no", "hops", "share", (F.col("share") * F.col("origin_spend")).alias("amount"))
    return rows.orderBy(*first_asc("project_id", "origin", "hops", "block_no"))
