"""Cases the registered queries do not reach."""

import json
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spendlens.functions import columns as c
from spendlens.operators import audit, balance, documents, dossier, flows, lookup, quality, reconcile, retrieval
from tests.helpers import BUDGET, ORG, OVERVIEW, SPEND, budget, fv, org, overview, spend, tuples


def test_causes_in_order(spark):
    # obligation and negative part together, negative part, zero, negative total, none
    lines = [(1, "a", -5.0, -5.0), (2, "b", -1.0, -1.0), (3, "c", 0.0, None), (4, "d", -9.0, None), (5, "e", 1.0, 1.0)]
    payments = spend(spark, [{"project_id": p, "amount": 10.0} for p in range(1, 6)])
    obligation = spark.createDataFrame([(1, 3.0)], "project_id long, contract_amt double")
    causes = balance.over_budget_cause(budget(spark, lines), payments, obligation)
    assert dict(tuples(causes, "project_id", "cause")) == {
        1: fv.CAUSE_OBLIGATION,
        2: fv.CAUSE_NEGATIVE_PART,
        3: fv.CAUSE_ZERO,
        4: fv.CAUSE_NEGATIVE_TOTAL,
        5: fv.CAUSE_UNKNOWN,
    }


def test_renamed_project_splits_and_projects_without_payments_drop_out(spark):
    lines = budget(spark, [(1, "old", 5.0), (1, "new", 50.0), (2, "idle", 1.0)])
    over = balance.over_budget(lines, spend(spark, [{"project_id": 1, "amount": 10.0}]))
    assert tuples(over, "project_id", "project_name", "excess") == [(1, "old", 5.0)]


def test_ratio_without_a_whole_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (-1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(c.percent(F.col("a"), F.col("b"))).collect()] == [None, None, None, -25.0]


def test_text_amounts(spark):
    texts = ["100", "1,000", "", "abc", "nan", None, " 7.5 ", "-3", "1e3", "1d", ".5"]
    df = spark.createDataFrame([(t,) for t in texts], "amount string")
    numbers = [r[0] for r in df.select(c.to_number("amount")).collect()]
    assert numbers == [100.0, None, None, None, None, None, 7.5, -3.0, 1000.0, None, 0.5]
    assert reconcile.split_summary(df).count() + reconcile.split_detail(df).count() == len(texts)


def test_ties_and_nulls_at_the_limit(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 1.0), (4, None)], "k int, v double")
    top = df.orderBy(*c.first_desc("v"), *c.first_asc("k")).limit(2)
    assert tuples(top, "k") == [(1,), (2,)]
    assert tuples(df.orderBy(*c.first_asc("v", "k")), "k")[-1] == (4,)


def test_rate_match_puts_missing_gaps_last(spark):
    lines = [(1, "a", 200.0, None, 50.0), (2, "b", 200.0, None, 10.0)]
    payments = spend(spark, [{"project_id": 1, "amount": 100.0}, {"project_id": 2, "amount": 100.0}])
    best = balance.rate_match_top(budget(spark, lines), payments, min_budget=100)
    assert tuples(best, "project_id", "rate_gap") == [(1, 0.0), (2, 40.0)]


def test_spend_vs_budget(spark):
    lines = budget(spark, [(1, "a", 100.0), (1, "a", 0.0), (1, "a", 100.0), (2, "b", 1000.0)])
    payments = spend(spark, [{"project_id": 1, "payee": "p", "block_no": "A", "amount": x} for x in (50.0, 50.0)])
    pairs = tuples(balance.spend_vs_budget_pairs(lines, payments, 1), "total_amt", "amount", "budget_pct")
    assert Counter(pairs) == Counter({(100.0, 50.0, 50.0): 4, (0.0, 50.0, None): 2})
    rows = tuples(balance.spend_vs_budget_rows(lines, payments), "amount", "budget_rows", "budget_total", "budget_pct")
    assert rows == [(50.0, 3, 200.0, 25.0)] * 2
    grouped = balance.spend_vs_budget_grouped(lines, payments, 1)
    assert tuples(grouped, "budget_total", "payee_spend", "budget_pct") == [(200.0, 100.0, 50.0)]


def test_null_safe_keys_in_reconciliation(spark):
    rows = [
        {"project_id": 1, "block_no": "A", "payee": "p", "corp_no": None, "outline": None, "amount": 10.0},
        {"project_id": 1, "block_no": "A", "payee": None, "corp_no": 1, "outline": "x", "amount": 10.0},
        {"project_id": 1, "block_no": "A", "payee": "q", "corp_no": 1, "outline": "x", "amount": 10.0},
    ]
    detail = spend(spark, rows)
    breakdown = detail.withColumn("amount", F.when(F.col("payee") == "q", 9.5).otherwise(1.0))
    gaps = reconcile.reconcile_detail_breakdown(detail, breakdown, org(spark, [(1, "n", "M", 0), (1, "n", "M", 1)]))
    # the missing payee matches nothing, half a unit is within tolerance, two organisation rows double the rest
    assert tuples(gaps, "payee", "gap") == [("p", 9.0)] * 2


def test_quality_report_is_the_rules_together(spark):
    payments = spend(
        spark,
        [
            {"project_id": 1, "amount": -5.0, "payee": "", "method": None, "outline": ""},
            {"project_id": 2, "amount": None, "block_total": 5.0},
            {"project_id": 3, "amount": 0.0, "block_total": 0.0},
            {"project_id": 4, "amount": 1.0, "payee": "p", "method": "m", "role": "r"},
        ],
    )
    projects = overview(spark, [(1, "a", "M", "", "o"), (2, "b", "M", None, "o"), (3, "c", "M", "p", "o")])
    lines = budget(spark, [(1, "a", 0.0), (2, "b", 5.0)])
    report = quality.quality_report(payments, projects, lines)
    single = [
        quality.payee_blank(payments), quality.contract_blank(payments), quality.negative_amount(payments),
        quality.no_amount(payments), quality.role_blank(payments), quality.purpose_blank(projects),
        quality.budget_not_positive(lines),
    ]
    for part in single:
        assert part.count() > 0
        rule = part.first()["rule"]
        assert Counter(tuples(report.where(F.col("rule") == rule), *part.columns)) == Counter(tuples(part))
    assert report.count() == sum(p.count() for p in single)
    assert sum(n for _, n in tuples(quality.quality_counts(report))) == report.count()


def test_ministry_summary_counts_rows_of_the_three_way_join(spark):
    orgs = org(spark, [(1, "a", "M", 0), (1, "a", "M", 1), (2, "b", "M", 0), (3, "c", "N", 0)])
    projects = overview(spark, [(1, "a", "M", "", ""), (1, "a", "M", "x", ""), (3, "c", "N", "", "")])
    lines = budget(spark, [(1, "a", 10.0), (1, "a", -4.0), (2, "b", 5.0), (3, "c", 1.0), (3, "c", None)])
    rows = tuples(lookup.ministry_summary(orgs, projects, lines))
    assert rows == [("M", 1, 45.0), ("N", 1, 1.0)]  # 10 x 2 x 2 + 5; project 2 has no overview


def test_keyword_total_counts_rows(spark):
    projects = overview(spark, [(1, "国道の整備", "M", "", ""), (2, "b", "M", "交通網", ""), (3, "c", "M", None, "")])
    lines = budget(spark, [(1, "a", 10.0), (1, "a", 5.0), (2, "b", 1.0), (3, "c", 9.0), (2, "b", -1.0)])
    assert tuples(lookup.keyword_total(projects, lines)) == [(3, 16.0)]
    none = lookup.keyword_total(projects, lines, ["%"], [])
    assert tuples(none) == [(0, None)]
    impact = lookup.impact_ratio(lookup.keyword_total(projects, lines), 4.0, 1.0)
    assert tuples(impact, "assumed_loss", "impact_pct") == [(4.0, 25.0)]


def test_related_projects_of_the_given_or_the_top_project(spark):
    related = spark.createDataFrame([(1, 9, "x"), (2, 8, "x"), (2, 7, None)], "project_id long, related_id long, relation string")
    lines = budget(spark, [(1, "a", 1.0), (2, "b", 5.0)])
    assert tuples(lookup.related_projects(related, lines, 1)) == [(1, 9, "x")]
    top = lookup.related_projects(related, lines)
    assert sorted(tuples(top, "related_id")) == [(7,), (8,)]
    assert tuples(lookup.value_counts(top, "relation")) == [("x", 1)]


def test_flow_edges_sum_to_the_details(spark):
    detail = spend(
        spark,
        [{"project_id": 1, "project_name": "a", "payee": p, "amount": x} for p, x in (("p", 2.0), ("p", 3.0), ("q", 1.0))],
    )
    edges = flows.fund_flow_edges(detail)
    assert sorted(tuples(edges)) == [("a", "p", 5.0), ("a", "q", 1.0)]
    assert tuples(flows.fund_flow_edges(detail, 1.0)) == [("a", "p", 5.0)]


def test_agent_flow_follows_the_block_of_the_top_payee(spark):
    payments = spend(
        spark,
        [
            {"project_id": 1, "block_no": "A", "payee": "agent", "amount": 60.0},
            {"project_id": 1, "block_no": "B", "payee": "shop", "amount": 30.0},
            {"project_id": 1, "block_no": "A", "role": "office", "block_total": 60.0},
        ],
    )
    edges = spark.createDataFrame([(1, "B", "A", False), (1, "A", None, True)], "project_id long, dst_block string, src_block string, from_ministry boolean")
    rows = tuples(flows.agent_flow(budget(spark, [(1, "a", 120.0)]), payments, edges))
    assert rows == [(1, "agent", 60.0, 120.0, 50.0, "A", 60.0, "office", "B")]


# --- dossiers -----------------------------------------------------------------


def dossier_views(spark):
    return {
        "one": spark.createDataFrame([(1, 'say "hi"\n', None)], "project_id long, note string, empty double"),
        "two": spark.createDataFrame([(1, 1.5), (1, 2.5), (2, 3.5)], "project_id long, amount double"),
        "other": spark.createDataFrame([("x",)], "note string"),
    }


def test_dossier_shapes(spark):
    views = dossier_views(spark)
    orgs = org(spark, [(1, "lead", "M", 0), (1, "later", "N", 1)])
    pages = dossier.project_dossier(views, orgs)
    texts = {(p, v): json.loads(t) for p, v, t in tuples(dossier.dossier_json(pages), "project_id", "view_name", "dossier")}
    lead = {"予算事業ID": 1, "事業名": "lead"}
    assert texts.pop((1, "one")) == {**lead, "one": {"project_id": 1, "note": 'say "hi"\n', "empty": None}}
    two = texts.pop((1, "two"))
    assert sorted(two.pop("two"), key=str) == [{"project_id": 1, "amount": 1.5}, {"project_id": 1, "amount": 2.5}]
    assert two == lead
    assert texts == {(2, "two"): {"予算事業ID": 2, "事業名": fv.UNKNOWN_PROJECT, "two": {"project_id": 2, "amount": 3.5}}}
    only = dossier.project_dossier(views, orgs, project_id=2)
    assert tuples(only, "project_id", "page") == [(2, 0)]
    renamed = {name: view.withColumnRenamed("project_id", "予算事業ID") for name, view in views.items()}
    other = dossier.project_dossier(renamed, orgs, id_column="予算事業ID")
    assert sorted(tuples(dossier.dossier_counts(other))) == sorted(tuples(dossier.dossier_counts(pages)))
    with pytest.raises(ValueError):
        dossier.project_dossier(renamed, orgs)


def test_dossier_flatten_works_for_one_and_many_records(spark):
    views = dossier_views(spark)
    orgs = org(spark, [(1, "lead", "M", 0), (1, "later", "N", 1)])
    flat = dossier.dossier_flatten(dossier.project_dossier(views, orgs), "two", views["two"].schema)
    for rows in (flat, dossier.with_lead_ministry(views["two"], orgs)):
        assert sorted(tuples(rows, "project_id", "amount", "lead_ministry"), key=str) == [
            (1, 1.5, "M"), (1, 2.5, "M"), (2, 3.5, None),
        ]


@pytest.mark.parametrize("copies", [60, 0, 345])
def test_dossiers_have_full_pages_without_gaps(spark, copies):
    rows = [(1, float(i)) for i in range(95)] + [(1, 7.0)] * copies + [(2, 1.0)] + [(3, 1.0)] * 10 + [(4, 1.0)] * 11
    views = {"v": spark.createDataFrame(rows, "project_id long, amount double")}
    pages = dossier.project_dossier(views, org(spark, [(1, "a", "M", 0)]), page_records=10).cache()
    sizes = {}
    for project, page, n in tuples(pages.select("project_id", "page", F.size("records").alias("n"))):
        sizes.setdefault(project, {})[page] = n
    for project, n in Counter(p for p, _ in rows).items():
        last = -(-n // 10) - 1
        assert sizes[project] == {i: 10 if i < last else n - 10 * last for i in range(last + 1)}
    flat = dossier.dossier_flatten(pages, "v", views["v"].schema)
    assert Counter(tuples(flat, "project_id", "amount")) == Counter(rows)
    for project, text in tuples(dossier.dossier_json(pages), "project_id", "dossier"):
        assert isinstance(json.loads(text)["v"], dict if project == 2 else list)


# --- documents and retrieval ---------------------------------------------------


def contracts(spark):
    detail = spend(
        spark,
        [
            {"project_id": 1, "payee": "p", "outline": "repair of a road", "amount": 5.0},
            {"project_id": 1, "payee": "p", "outline": "repair of a road", "amount": 5.0},
            {"project_id": 1, "payee": "q", "outline": "short", "amount": 5.0},
            {"project_id": 2, "payee": "q", "outline": "school meals", "amount": None},
            {"project_id": 3, "payee": "q", "outline": "no such project", "amount": 1.0},
            {"project_id": 2, "payee": None, "outline": "payee missing", "amount": 1.0},
            {"project_id": 2, "payee": "q", "outline": "その他", "amount": 1.0},
        ],
    )
    orgs = org(spark, [(1, "roads", "M", 0), (1, "roads", "M", 1), (2, "schools", "N", 0)])
    return detail, orgs, overview(spark, [(1, "roads", "M", "to drive", "all roads")])


def test_documents_spell_out_what_is_missing(spark):
    texts = Counter(t for (t,) in tuples(documents.rag_documents(*contracts(spark)), "document"))
    road = "事業名「roads」。この事業の目的は「to drive」であり、概要は「all roads」です。この事業において、支出先「p」に対し、「repair of a road」という内容で契約が行われました。"
    school = "事業名「schools」。この事業の目的は「目的の記述なし」であり、概要は「概要の記述なし」です。この事業において、支出先「q」に対し、「school meals」という内容で契約が行われました。"
    assert texts == Counter({road: 4, school: 1})


def test_store_rows_have_unique_ids_and_no_nulls(spark):
    store = documents.vector_store_rows(documents.folded_documents(*contracts(spark)))
    rows = store.collect()
    assert sorted(r["doc_id"] for r in rows) == [f"doc_{i}" for i in range(5)]
    assert all(value is not None for r in rows for value in r)
    school = next(r for r in rows if r["project_name"] == "schools")
    assert (school["amount"], school["purpose"]) == (0.0, "")
    assert abs(sum(x * x for x in school["embedding"]) - 1) < 1e-5


def test_trigram_embedder_against_plain_counting():
    embedder = documents.TrigramEmbedder(16)
    texts = ["", "ab", "abc", "road work 道路工事", "x" * 500]
    for text, vector in zip(texts, embedder(texts)):
        counts = np.zeros(16)
        for a, b, d in zip(text, text[1:], text[2:]):
            counts[(ord(a) * 961 + ord(b) * 31 + ord(d)) % 16] += 1
        norm = np.sqrt((counts**2).sum())
        assert np.allclose(vector, counts / norm if norm else counts)


class LengthEmbedder:
    name, dim = "length", 2

    def __call__(self, texts):
        assert len(texts) <= documents.EMBED_BATCH
        return np.array([[len(t), 1.0] for t in texts])


def test_other_embedders_are_asked_in_batches(spark):
    df = spark.range(250).select(F.repeat(F.lit("x"), F.col("id").cast("int")).alias("document"))
    out = documents.embed(df, LengthEmbedder())
    assert all(v == [float(len(d)), 1.0] for d, v in tuples(out, "document", "embedding"))
    assert {e for (e,) in tuples(out, "embedder")} == {"length"}


def test_ask_refuses_a_store_of_another_embedder(spark):
    store = documents.vector_store_rows(documents.folded_documents(*contracts(spark)))
    hits = retrieval.ask(store, "repair of a road by p", k=2)
    assert {p for (p,) in tuples(hits, "project_id")} == {1}
    with pytest.raises(PySparkException, match="length"):
        retrieval.ask(store, "road", LengthEmbedder()).collect()


@pytest.mark.parametrize("dim", [8, 300])
def test_nearest_against_brute_force(spark, dim):
    generator = np.random.default_rng(1)
    vectors = generator.normal(size=(200, dim)).round(3)
    store = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, embedding array<double>"
    )
    query = retrieval.query_vector(store, "id", 3)
    want = np.argsort(((vectors - vectors[3]) ** 2).sum(axis=1), kind="stable")[:10]
    assert [i for (i,) in tuples(retrieval.nearest(store, query, "id"), "id")] == list(want)
    with pytest.raises(ValueError):
        retrieval.query_vector(store, "id", -1)


def test_context_and_payees_of_hits(spark):
    hits = spark.createDataFrame([("doc_1", 5, "far", 2.0), ("doc_0", 3, "near", 1.0), ("doc_2", 3, "mid", 1.5)], "doc_id string, project_id long, document string, distance double")
    assert tuples(retrieval.context(hits, "project_id", "document", ["distance", "doc_id"])) == [
        ([3, 5], "- near\n- mid\n- far")
    ]
    detail = spend(spark, [{"project_id": p, "payee": n, "amount": a} for p, n, a in ((3, "p", 1234567.0), (5, "q", 2.0), (9, "r", 9e9))])
    assert tuples(retrieval.retrieved_top_payees(detail, hits)) == [("p", 1234567.0, "1,234,567"), ("q", 2.0, "2")]


# --- audit ---------------------------------------------------------------------


def test_audit_replies(spark):
    replies = [
        '{"score": 4, "reason": "ok"}',
        '```json\n{"score": 2, "reason": "道路"}\n```',
        "no json",
        None,
        '{"reason": "no score"}',
        "[1, 2]",
        "```\n{\"score\": 1.5}```",
    ]
    df = spark.createDataFrame(list(enumerate(replies)), "id int, reply string")
    parsed = {i: (s, r) for i, s, r in tuples(audit.parse_reply(df), "id", "score", "reason")}
    assert parsed == {
        0: (4.0, "ok"), 1: (2.0, "道路"), 2: (0.0, audit.FAILED), 3: (0.0, audit.FAILED),
        4: (None, "no score"), 5: (0.0, audit.FAILED), 6: (1.5, None),
    }


def audit_rows(spark):
    return spend(
        spark,
        [
            {"project_name": f"road {i}", "outline": f"road work {i}", "ministry": "MN"[i % 2], "amount": float(i % 5), "bid_rate": i / 10}
            for i in range(40)
        ]
        + [{"project_name": None, "outline": "x"}, {"project_name": "x", "outline": None}],
    )


def test_audit_selection(spark):
    rows = audit_rows(spark)
    assert audit.audit_selection(rows).count() == 40
    top = audit.audit_selection(rows, ministry="M", sort_by="amount", top_n=3)
    assert tuples(top, "amount", "ministry") == [(4.0, "M")] * 3
    sample = audit.audit_selection(rows, ministry="N", sort_by="amount", sample_size=5, seed=2)
    assert tuples(sample) == tuples(audit.audit_selection(rows.repartition(9), ministry="N", sample_size=5, seed=2))
    ignored = audit.audit_selection(rows, sort_by="payee", top_n=4)
    assert ignored.count() == 4
    assert audit.audit_selection(rows, ministry="' OR 1=1").count() == 0


def test_audit_score_with_a_scorer(spark):
    def scorer(prompts):
        return ['```json\n{"score": %d, "reason": "r"}\n```' % (1 if "road 1\n" in p else 5) for p in prompts]

    scored = audit.audit_score(audit.audit_selection(audit_rows(spark)), scorer)
    assert tuples(scored, "score")[0] == (1.0,)
    assert scored.columns == [*audit.AUDIT_COLUMNS, "score", "reason"]


def test_overlap_score_bounds(spark):
    df = spark.createDataFrame([("道路工事", "道路工事"), ("abc", "xyz"), ("", ""), ("a", "a")], "l string, r string")
    assert [r[0] for r in df.select(audit.overlap_score("l", "r")).collect()] == [5, 1, 1, 1]


def test_scenario_tags_every_step(spark):
    scenarios = [
        {"scenario_name": "s1", "steps": [{"description": "d1", "params": {"ministry": "M", "sample_size": 3}}]},
        {"scenario_name": "s2", "steps": [{"description": "d2", "params": {"sort_by": "amount", "top_n": 2}}]},
    ]
    report = audit.scenario_report(audit_rows(spark), scenarios)
    assert Counter(tuples(report, "scenario", "step")) == Counter({("s1", "d1"): 3, ("s2", "d2"): 2})


def test_empty_frames(spark):
    b, s, o, v = (spark.createDataFrame([], schema) for schema in (BUDGET, SPEND, ORG, OVERVIEW))
    obligation = spark.createDataFrame([], "project_id long, contract_amt double")
    assert tuples(balance.total_budget(b)) == [(None,)]
    assert tuples(balance.obligation_counts(b, s, obligation)) == [(0, 0, 0, True)]
    for df in (
        balance.over_budget_cause(b, s, obligation), balance.rate_gap_top(b, s), balance.spend_vs_budget_rows(b, s),
        reconcile.reconcile_detail_breakdown(s, s, o), reconcile.reconcile_summary_detail(s, s, o),
        lookup.keyword_projects(v, o, b), lookup.text_sample(s, o), lookup.ministry_summary(o, v, b),
        quality.quality_report(s, v, b), documents.rag_documents(s, o, v),
        documents.vector_store_rows(documents.folded_documents(s, o, v)), dossier.project_dossier({"s": s}, o),
        audit.audit_score(audit.audit_selection(s)),
    ):
        assert df.count() == 0


@pytest.mark.parametrize("dim", [2, 256, 257])
def test_vectors_of_another_length_are_refused(spark, dim):
    vectors = {0: [1.0] * dim, 1: [0.0] * dim, 2: None}
    store = spark.createDataFrame(list(vectors.items()), "id long, embedding array<float>")
    assert tuples(retrieval.nearest(store, [1.0] * dim, "id"), "id", "distance") == [(0, 0.0), (1, float(dim)), (2, None)]
    for other in (dim - 1, dim + 1):
        more = store.union(spark.createDataFrame([(3, [1.0] * other)], "id long, embedding array<float>"))
        with pytest.raises(PySparkException, match="dimensions"):
            retrieval.nearest(more, [1.0] * dim, "id").collect()


def test_close_vectors_are_told_apart(spark):
    store = spark.createDataFrame([(1, [1.0 + 2e-6]), (2, [1.0 + 1e-6])], "id long, embedding array<double>")
    assert [i for (i,) in tuples(retrieval.nearest(store, [1.0], "id"), "id")] == [2, 1]


def test_context_holds_k_hits(spark):
    hits = spark.createDataFrame([(i, f"t{i}", float(i)) for i in range(30)], "id long, text string, distance double")
    [(ids, text)] = tuples(retrieval.context(hits, "id", "text", ["distance"], k=3))
    assert ids == [0, 1, 2] and text == "- t0\n- t1\n- t2"


def test_money_is_summed_without_cuts(spark):
    def total(values):
        return spark.createDataFrame([(float(v),) for v in values], "v double").agg(c.money_sum("v")).first()[0]

    assert total([0.00003] * 10) == 0.0003
    assert total([1e16, 1.0, -1e16]) == 1.0
    assert total([9.5e17, 0.25]) == 9.5e17 + 0.25
    assert total([]) is None


def test_keyword_queries_start_no_job_while_they_are_built(spark):
    before = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    lines = budget(spark, [(1, "road", 5.0)])
    lookup.keyword_projects(overview(spark, [(1, "road", "m", "p", "o")]), org(spark, [(1, "road", "m", 0)]), lines, ["road"], [])
    assert spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs() == before


def test_scenario_steps_share_one_pass(spark):
    """The rows of every step as ``audit_selection`` gives them, from one scan, with copies and a sort column that is not shown."""
    rows = []
    for i in range(400):
        rows.append({
            "project_id": i % 9, "project_name": None if i % 31 == 0 else f"p{i % 9}", "ministry": ["m", "n", None][i % 3], "payee": "x",
            "outline": f"o{i % 5}", "amount": float(i % 7) if i % 11 else None, "bid_rate": float(i % 13),
        })
    rows += [rows[1]] * 60
    detail = spend(spark, rows)
    params = [
        {"ministry": "m", "sample_size": 20, "seed": 3}, {"sample_size": 15}, {"sort_by": "amount", "top_n": 30},
        {"sort_by": "bid_rate", "top_n": 10, "ministry": "n"}, {"sort_by": "payee", "top_n": 5}, {"ministry": "none"}, {},
    ]
    steps = [{"description": str(i), "params": p} for i, p in enumerate(params)]
    report = audit.scenario_report(detail, [{"scenario_name": "a", "steps": steps[:4]}, {"scenario_name": "b", "steps": steps[4:]}])
    got = {}
    for scenario, step, *row in tuples(report):
        got.setdefault((scenario, int(step)), []).append(tuple(row))
    for i, p in enumerate(params):
        want = tuples(audit.audit_selection(detail, **p))
        assert sorted(map(str, got.get(("a" if i < 4 else "b", i), []))) == sorted(map(str, want)), p
    plan = audit.scenario_report(detail, [{"scenario_name": "a", "steps": steps}])._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("LogicalRDD") == 1
    assert plan.executedPlan().toString().count("WindowGroupLimit") == 2  # per task, and over all
    assert audit.scenario_report(detail, [{"scenario_name": "none"}]).collect() == []


def test_onward_flow_passes_shares_on(spark):
    payments = spend(spark, [
        {"project_id": 1, "block_no": b, "payee": "p", "amount": a} for b, a in [("A", 100.0), ("B", 30.0), ("C", 10.0), ("D", None)]
    ])
    edges = spark.createDataFrame(
        [(1, "B", "A"), (1, "C", "A"), (1, "C", "A"), (1, "D", "B"), (1, "D", "C"), (1, "A", None), (2, "Y", "X")],
        "project_id long, dst_block string, src_block string",
    )
    rows = {(o, b, h): (round(s, 6), a) for _, o, b, h, s, a in tuples(flows.onward_flow(payments, edges))}
    assert {k: v for k, v in rows.items() if k[0] == "A"} == {
        ("A", "A", 0): (1.0, 100.0), ("A", "B", 1): (0.75, 75.0), ("A", "C", 1): (0.25, 25.0), ("A", "D", 2): (1.0, 100.0),
    }
    assert rows[("B", "D", 1)] == (1.0, 30.0) and ("D", "D", 0) not in rows


def test_onward_flow_ends_on_cycles(spark):
    payments = spend(spark, [{"project_id": 1, "block_no": b, "payee": "p", "amount": 5.0} for b in "ABC"])
    edges = spark.createDataFrame([(1, "B", "A"), (1, "A", "B"), (1, "C", "B"), (1, "C", "C")], "project_id long, dst_block string, src_block string")
    found = tuples(flows.onward_flow(payments, edges, max_hops=6))
    assert max(r[3] for r in found) == 6 and len(found) <= 7 * 9
    for hop in range(7):  # nothing is lost or made
        assert sum(r[4] for r in found if r[1] == "A" and r[3] == hop) == pytest.approx(1.0)
    paths = {(r[1], r[2], r[3]): r[4] for r in found}
    assert paths[("A", "A", 2)] == pytest.approx(0.5) and paths[("A", "A", 4)] == pytest.approx(0.25)
