"""Folding, numbering and joins under hot keys and copies, against brute force."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from spendlens.operators import balance, lookup, reconcile, skew
from spendlens.operators.skew import spread_join
from tests.helpers import budget, org, overview, spend, tuples

LOW_SKEW_LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def split_skew(spark):
    """Limits so low that test data counts as skewed."""
    before = {k: spark.conf.get(k, None) for k in LOW_SKEW_LIMITS}
    for key, value in LOW_SKEW_LIMITS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("chunk", [2, 3, 100_000])
@pytest.mark.parametrize("spread", [False, True])
def test_collapse_and_expand_keep_every_copy(spark, monkeypatch, chunk, spread):
    monkeypatch.setattr(skew, "CHUNK", chunk)
    rows = [("a", 1.0)] * 7 + [("b", None)] * 2 + [(None, 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    folded = skew.collapse(df, ["k", "v"])
    assert folded.count() == 3
    assert Counter(tuples(skew.expand(folded, spread=spread))) == Counter(rows)
    numbers = tuples(skew.expand(folded, index="no", spread=spread))
    assert sorted(no for k, _, no in numbers if k == "a") == list(range(7))


@pytest.mark.parametrize("partitions", [1, 5])
def test_numbered_is_consecutive_and_independent_of_partitions(spark, monkeypatch, partitions):
    monkeypatch.setattr(skew, "NUMBER_BUCKET_DIGITS", 1)
    df = spark.range(200).select((F.col("id") % 3).alias("g"), F.col("id").alias("v")).repartition(partitions)
    out = {(g, v): n for g, v, n in tuples(skew.numbered(df, ["g"], ["v"], "n"), "g", "v", "n")}
    for group in range(3):
        assert sorted(n for (g, _), n in out.items() if g == group) == list(range(len([k for k in out if k[0] == group])))
    again = skew.numbered(df.repartition(7), ["g"], ["v"], "n")
    assert {(g, v): n for g, v, n in tuples(again, "g", "v", "n")} == out


def test_numbered_with_weights_leaves_room_for_copies(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 5)], "v string, copies long")
    out = sorted(tuples(skew.numbered(df, [], ["v"], "first", weight="copies"), "first", "copies"))
    assert [first for first, _ in out] == [0, out[0][1], out[0][1] + out[1][1]]


def test_spread_join_splits_a_hot_key(spark, split_skew):
    left = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("v")
    )
    # the right side is grouped by the key, so it has no shuffle of its own
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = skew.spread_join(left, right, ["k"])
    assert "skew=true" in executed_plan(joined)
    counts = Counter(k for (k,) in tuples(left, "k"))
    assert Counter(tuples(joined)) == Counter((k, v, counts[k]) for k, v in tuples(left))


def test_spread_join_matches_null_only_where_told(spark):
    left = spark.createDataFrame([(1, None), (1, "x"), (None, "x")], "a long, b string")
    right = spark.createDataFrame([(1, None, 10), (None, "x", 20)], "a long, b string, v long")
    assert tuples(skew.spread_join(left, right, ["a"], null_safe=["b"])) == [(1, None, 10)]


def test_spread_join_across_number_types(spark):
    left = spark.createDataFrame([(1, 5.0, "a"), (2, None, "b"), (3, 7.5, "c")], "k int, corp double, v string")
    right = spark.createDataFrame([(1, 5, 10), (2, None, 20), (3, 7, 30)], "k long, corp long, w int")
    joined = skew.spread_join(left, right, ["k"], null_safe=["corp"])
    assert sorted(tuples(joined, "v", "w")) == [("a", 10), ("b", 20)]
    with pytest.raises(TypeError):
        skew.spread_join(left, right.withColumn("k", F.col("k").cast("string")), ["k"])


def hot_world(spark):
    """One project holds a third of all payments, a third of those are copies."""
    rows = []
    for i in range(9000):
        hot = i % 3 == 0
        copy = hot and i % 9 == 0
        rows.append(
            {
                "project_id": 0 if hot else i % 300,
                "project_name": f"project {0 if hot else i % 300}",
                "ministry": "M",
                "block_no": "A",
                "payee": "copied" if copy else f"payee {i % 50}",
                "outline": "road repair" if copy else f"contract {i % 700}",
                "corp_no": None if copy else i % 11,
                "amount": 5.0 if copy else float(i % 97),
            }
        )
    payments = spend(spark, rows).repartition(6)
    budgets = budget(spark, [(p, f"project {p}", 100.0 * p, None, None, None) for p in range(300)] * 2)
    orgs = org(spark, [(p, f"project {p}", "M", 0) for p in range(300)] + [(0, "project 0", "M", 1)])
    return rows, payments, budgets, orgs


def test_reconcile_keeps_every_row_of_a_hot_contract(spark, split_skew):
    rows, payments, _, orgs = hot_world(spark)
    breakdown = payments.withColumn("amount", F.col("amount") - 2)
    result = reconcile.reconcile_detail_breakdown(payments, breakdown, orgs)
    sums, key = Counter(), lambda r: tuple(r[c] for c in ("project_id", "block_no", "payee", "corp_no", "outline"))
    for r in rows:
        sums[key(r)] += r["amount"] - 2
    want = Counter()
    for r in rows:
        if abs(r["amount"] - sums[key(r)]) > 1:
            want[(r["project_id"], r["payee"], r["outline"], r["amount"], sums[key(r)])] += 2 if r["project_id"] == 0 else 1
    got = Counter(tuples(result, "project_id", "payee", "outline", "contract_amount", "breakdown_sum"))
    assert got == want


def test_lookup_is_one_lazy_join_for_any_number_of_ids(spark, split_skew):
    rows, payments, budgets, _ = hot_world(spark)
    ids = balance.within_budget_ids(budgets, payments)
    wanted = {p for (p,) in tuples(ids)}
    last = payments.select(*[c for c in payments.columns if c != "project_id"], "project_id")
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    few = lookup.rows_of_projects(last, ids)
    many = lookup.rows_of_projects(last, payments.groupBy("project_id").count())
    as_doubles = lookup.rows_of_projects(last, ids.select(F.col("project_id").cast("double")))
    assert spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs() == jobs
    assert few.columns == many.columns == last.columns
    assert few.count() == as_doubles.count() == sum(r["project_id"] in wanted for r in rows)
    assert "skew=true" in executed_plan(many)
    assert many.count() == len(rows)


NUMBER_TYPES = (
    "tinyint", "int", "bigint", "float", "double", "decimal(5,2)", "decimal(12,4)", "decimal(20,0)", "decimal(38,10)",
)


@pytest.mark.parametrize("left", NUMBER_TYPES)
def test_spread_join_compares_number_types_as_a_plain_join(spark, left):
    values = [("0",), ("-0",), ("1",), ("1.5",), ("2.25",), ("100",), ("-7",), (None,)]
    texts = spark.createDataFrame(values, "t string").withColumn("d", F.col("t").cast("double"))
    for right in NUMBER_TYPES:
        a = texts.select(F.col("d").cast(left).alias("k"), F.col("t").alias("a"))
        b = texts.select(F.col("d").cast(right).alias("k"), F.col("t").alias("b"))
        for safe in (False, True):
            same = F.col("l.k").eqNullSafe(F.col("r.k")) if safe else F.col("l.k") == F.col("r.k")
            want = Counter(tuples(a.alias("l").join(b.alias("r"), same).select("a", "b")))
            keys = {"on": [], "null_safe": ["k"]} if safe else {"on": ["k"]}
            assert Counter(tuples(spread_join(a, b, **keys), "a", "b")) == want, (left, right, safe)


def test_keyword_rows_of_a_hot_project(spark, split_skew):
    lines = [(0, "road 0", float(i % 40), None, None, None) for i in range(3000)]
    lines += [(p, f"road {p}", float(p), None, None, None) for p in range(1, 300) for _ in range(20)]
    projects = overview(spark, [(p, f"road {p}", "M", "", "") for p in range(300)])
    orgs = org(spark, [(p, f"road {p}", "M", 0) for p in range(300)])
    result = lookup.keyword_projects(projects, orgs, budget(spark, lines), ["road"], [])
    want = Counter((p, total) for p, _, total, *_ in lines if total > 0)
    assert Counter(tuples(result, "project_id", "budget_amt")) == want


def test_sample_does_not_depend_on_partitions_and_takes_copies_fairly(spark):
    _, payments, _, orgs = hot_world(spark)
    one = tuples(lookup.text_sample(payments, orgs, 100, seed=3))
    two = tuples(lookup.text_sample(payments.repartition(13), orgs.repartition(2), 100, seed=3))
    assert one == two and len(one) == 100
    assert tuples(lookup.text_sample(payments, orgs, 100, seed=4)) != one
    copied = sum(payee == "copied" for _, payee, _ in one)
    assert 5 < copied < 40  # a fifth of the joined rows are copies
