"""The same results in plain SQL, for a check by another engine.

Written from what each analysis means, row by row, without the folding and
numbering by which the operators avoid hot keys.
"""

from __future__ import annotations

from spendlens.functions import fixed_values as fv
from spendlens.plans import registry as r
from spendlens.plans.fixtures import VIEWS, sql_with_views

DIM = 64


def _sum(column: str) -> str:
    # by way of text, which holds a double as it prints; a direct cast multiplies it first
    return f"CAST(SUM(CAST(CAST({column} AS VARCHAR) AS DECIMAL(38,10))) AS DOUBLE)"


BUDGET_TOTAL = f"""budget_total AS (
    SELECT project_id, project_name, {_sum("total_amt")} AS budget_total
    FROM fx_budget GROUP BY project_id, project_name)"""
SPEND_TOTAL = f"""spend_total AS (
    SELECT project_id, {_sum("amount")} AS spend_total
    FROM fx_spend WHERE amount IS NOT NULL GROUP BY project_id)"""
OVER = f"""{BUDGET_TOTAL}, {SPEND_TOTAL}, over_budget AS (
    SELECT b.project_id, b.project_name, b.budget_total, s.spend_total, s.spend_total - b.budget_total AS excess
    FROM budget_total b JOIN spend_total s ON b.project_id = s.project_id
    WHERE s.spend_total > b.budget_total)"""
CAUSES = f"""{OVER}, causes AS (
    SELECT o.*, CASE
        WHEN project_id IN (SELECT project_id FROM fx_obligation) THEN '{fv.CAUSE_OBLIGATION}'
        WHEN project_id IN (SELECT project_id FROM fx_budget WHERE initial_amt < 0 OR supplementary_amt < 0
                            OR carryover_amt < 0 OR reserve_amt < 0) THEN '{fv.CAUSE_NEGATIVE_PART}'
        WHEN budget_total = 0 THEN '{fv.CAUSE_ZERO}'
        WHEN budget_total < 0 THEN '{fv.CAUSE_NEGATIVE_TOTAL}'
        ELSE '{fv.CAUSE_UNKNOWN}' END AS cause
    FROM over_budget o)"""
WITHIN = f"""{SPEND_TOTAL}, budget_of AS (
    SELECT project_id, {_sum("total_amt")} AS budget_total FROM fx_budget GROUP BY project_id),
within AS (SELECT b.project_id FROM budget_of b JOIN spend_total s ON b.project_id = s.project_id
    WHERE s.spend_total <= b.budget_total)"""
RATES = f"""{SPEND_TOTAL}, declared AS (
    SELECT project_id, project_name, {_sum("total_amt")} AS budget_total,
        {_sum("execution_rate * total_amt")} / NULLIF({_sum("total_amt")}, 0) AS declared_rate
    FROM fx_budget WHERE total_amt IS NOT NULL AND total_amt <> 0 AND execution_rate IS NOT NULL
    GROUP BY project_id, project_name),
rates AS (SELECT d.project_id, project_name, declared_rate,
        spend_total / NULLIF(budget_total, 0) * 100 AS computed_rate,
        ABS(declared_rate - spend_total / NULLIF(budget_total, 0) * 100) AS rate_gap, budget_total, spend_total
    FROM declared d JOIN spend_total s ON d.project_id = s.project_id)"""
TOP_PROJECT = f"""top_project AS (
    SELECT project_id, project_name, {_sum("total_amt")} AS budget_total
    FROM fx_budget WHERE total_amt IS NOT NULL GROUP BY project_id, project_name
    ORDER BY 3 DESC NULLS LAST, 1 NULLS LAST, 2 NULLS LAST LIMIT 1)"""


def _contains(column: str, words: tuple[str, ...]) -> str:
    return " OR ".join(f"{column} LIKE '%{w}%'" for w in words)


KEYWORDS = f"({_contains('o.project_name', r.NAME_WORDS)} OR {_contains('o.purpose', r.PURPOSE_WORDS)})"
KEYWORD_TOTAL = f"""
    SELECT COUNT(o.project_id) AS budget_rows, {_sum("b.total_amt")} AS budget_total
    FROM fx_overview o JOIN fx_budget b ON o.project_id = b.project_id
    WHERE {KEYWORDS} AND b.total_amt > 0"""

DOCUMENTS = """documents_of AS (
    SELECT d.project_id, o.project_name, g.purpose, g.outline AS overview, d.outline, d.payee, d.amount,
        {text} AS document
    FROM fx_spend_detail d LEFT JOIN fx_org o ON d.project_id = o.project_id
        LEFT JOIN fx_overview g ON d.project_id = g.project_id
    WHERE d.outline IS NOT NULL AND o.project_name IS NOT NULL AND d.payee IS NOT NULL
        AND length(d.outline) > {length} AND d.outline NOT IN ({stop}))""".format(
    length=fv.OUTLINE_MIN_LENGTH,
    stop=", ".join(f"'{w}'" for w in fv.OUTLINE_STOP_LIST),
    text="'"
    + fv.DOCUMENT_TEMPLATE.format(
        project_name="' || o.project_name || '",
        purpose=f"' || coalesce(g.purpose, '{fv.NO_PURPOSE}') || '",
        overview=f"' || coalesce(g.outline, '{fv.NO_OVERVIEW}') || '",
        payee="' || d.payee || '",
        outline="' || d.outline || '",
    )
    + "'",
)


def _vectors(source: str, name: str) -> str:
    """Trigram counts of the distinct documents of ``source``, scaled to length 1."""
    return f"""{name}_codes AS (
    SELECT document, [CAST(unicode(c) AS BIGINT) for c in string_split(document, '')] AS c
    FROM (SELECT DISTINCT document FROM {source})),
{name}_buckets AS (
    SELECT document, unnest([(c[i] * 961 + c[i + 1] * 31 + c[i + 2]) % {DIM} for i in range(1, len(c) - 1)]) AS b FROM {name}_codes),
{name}_counts AS (
    SELECT document, histogram(b) AS h FROM {name}_buckets GROUP BY document),
{name}_lists AS (
    SELECT document, [coalesce(CAST(h[b] AS DOUBLE), 0.0) for b in range(0, {DIM})] AS n FROM {name}_counts),
{name} AS (
    SELECT document, [CAST(x / norm AS FLOAT) for x in n] AS embedding
    FROM (SELECT document, n, sqrt(list_sum([x * x for x in n])) AS norm FROM {name}_lists))"""


VECTOR_TEXT = (
    "array_to_string([CAST(CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR) for x in embedding], ',')"
)


def _distance(left: str, right: str) -> str:
    return (
        f"list_sum(["
        f"(CAST({left}[i] AS DOUBLE) - CAST({right}[i] AS DOUBLE)) * "
        f"(CAST({left}[i] AS DOUBLE) - CAST({right}[i] AS DOUBLE)) for i in range(1, {DIM + 1})])"
    )


HITS = f"""hits AS (
    SELECT e.vec_id, e.label, {_distance("e.embedding", "q.embedding")} AS distance
    FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q
    ORDER BY distance, vec_id LIMIT 10)"""


def _top_payees(ids: str) -> str:
    return f"""SELECT payee, spend_total,
        format('{{:,}}', CAST(CAST(spend_total AS DECIMAL(38,0)) AS BIGINT)) AS spend_text FROM (
    SELECT payee, {_sum("amount")} AS spend_total FROM fx_spend_detail WHERE project_id IN ({ids})
    GROUP BY payee ORDER BY 2 DESC NULLS LAST, 1 NULLS LAST LIMIT 3)"""


def _md5(*columns: str) -> str:
    return "md5(concat_ws(chr(1), " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(2))" for c in columns) + "))"


AMOUNT_TEXT = "CAST(amount AS DECIMAL(38,6))"
STORE = f"""{DOCUMENTS}, store AS (
    SELECT 'doc_' || (row_number() OVER (ORDER BY {_md5("project_id", "project_name", "purpose", "overview",
        "outline", "payee", AMOUNT_TEXT, "document")}, project_id, project_name, purpose, overview, outline,
        payee, amount, document) - 1) AS doc_id,
        coalesce(project_id, 0) AS project_id, coalesce(project_name, '') AS project_name,
        coalesce(purpose, '') AS purpose, coalesce(overview, '') AS overview, coalesce(outline, '') AS outline,
        coalesce(payee, '') AS payee, coalesce(amount, 0) AS amount, document
    FROM documents_of)"""
ANSWER = f"""{STORE}, question AS (SELECT '{r.QUESTION}' AS document),
{_vectors("store", "doc_vectors")}, {_vectors("question", "question_vector")},
answers AS (
    SELECT s.doc_id, s.project_id, s.document, {_distance("v.embedding", "q.embedding")} AS distance
    FROM store s JOIN doc_vectors v ON s.document = v.document, question_vector q
    ORDER BY distance, doc_id LIMIT 10)"""


def _sample(source: str, columns: tuple[str, ...], n: int) -> str:
    """n random rows: every row draws an md5 of its values, its copy number and the seed."""
    texts = [AMOUNT_TEXT if c == "amount" else c for c in columns]
    names = ", ".join(columns)
    return f"""SELECT {names} FROM (
        SELECT {names}, row_number() OVER (PARTITION BY {names}) - 1 AS copy_no FROM {source})
    ORDER BY {_md5(*texts, "copy_no", str(r.SEED))}, {", ".join(c + " NULLS LAST" for c in columns)} LIMIT {n}"""


AUDIT_COLUMNS = ("project_name", "outline", "amount", "ministry")


def _selection(params: dict) -> str:
    where = "project_name IS NOT NULL AND outline IS NOT NULL"
    if "ministry" in params:
        where += f" AND ministry = '{params['ministry']}'"
    names = ", ".join(AUDIT_COLUMNS)
    if "top_n" in params:
        order = f"{params['sort_by']} DESC NULLS LAST, " + ", ".join(c + " NULLS LAST" for c in AUDIT_COLUMNS)
        return f"SELECT {names} FROM fx_spend_detail WHERE {where} ORDER BY {order} LIMIT {params['top_n']}"
    return _sample(f"(SELECT {names} FROM fx_spend_detail WHERE {where})", AUDIT_COLUMNS, params["sample_size"])


SCENARIOS = " UNION ALL ".join(
    f"SELECT '{s['scenario_name']}' AS scenario, '{t['description']}' AS step, x.* FROM ({_selection(t['params'])}) x"
    for s in r.SCENARIOS
    for t in s["steps"]
)

DQ = {
    "dq_payee_blank": (
        fv.RULE_PAYEE_BLANK, "fx_spend", "project_id, project_name, block_no, amount, outline",
        "amount IS NOT NULL AND amount <> 0 AND (payee IS NULL OR payee = '')",
    ),
    "dq_contract_blank": (
        fv.RULE_CONTRACT_BLANK, "fx_spend", "project_id, project_name, payee, amount",
        "amount IS NOT NULL AND amount <> 0 AND (method IS NULL OR method = '') AND (outline IS NULL OR outline = '')",
    ),
    "dq_purpose_blank": (
        fv.RULE_PURPOSE_BLANK, "fx_overview", "project_id, project_name, ministry", "purpose IS NULL OR purpose = ''",
    ),
    "dq_negative": (
        fv.RULE_NEGATIVE, "fx_spend", "project_id, project_name, payee, amount, outline", "amount < 0",
    ),
    "dq_no_amount": (
        fv.RULE_NO_AMOUNT, "fx_spend", "project_id, project_name, block_no, payee",
        "(amount IS NULL OR amount = 0) AND (block_total IS NULL OR block_total = 0) "
        "AND (payee_total IS NULL OR payee_total = 0)",
    ),
    "dq_role_blank": (
        fv.RULE_ROLE_BLANK, "fx_spend", "project_id, project_name, block_no, block_total",
        "(amount IS NULL OR amount = 0) AND (role IS NULL OR role = '') "
        "AND block_total IS NOT NULL AND block_total <> 0",
    ),
}
DQ_SQL = {
    key: f"SELECT '{rule}' AS rule, {columns} FROM {view} WHERE {condition}"
    for key, (rule, view, columns, condition) in DQ.items()
}
DQ_SQL["dq_budget_not_positive"] = f"""
    SELECT '{fv.RULE_BUDGET_NOT_POSITIVE}' AS rule, project_id, project_name, {_sum("total_amt")} AS budget_total
    FROM fx_budget GROUP BY project_id, project_name HAVING {_sum("total_amt")} <= 0"""
DQ_REPORT = " UNION ALL BY NAME ".join(f"({sql})" for sql in DQ_SQL.values())

VIEW_COLUMNS = {
    "fx_block_edges": "project_id dst_block src_block from_ministry",
    "fx_breakdown": "project_id block_no payee corp_no outline amount",
    "fx_budget": "project_id project_name fiscal_year account_class initial_amt supplementary_amt carryover_amt "
    "reserve_amt total_amt executed_amt execution_rate",
    "fx_obligation": "project_id contract_amt",
    "fx_org": "project_id project_name ministry other_no",
    "fx_overview": "project_id project_name ministry purpose outline",
    "fx_related": "project_id related_id relation",
    "fx_remarks": "project_id remark_no remark",
    "fx_spend": "project_id project_name ministry block_no block_total payee corp_no outline amount method role "
    "payee_total bid_rate",
}
VIEW_COLUMNS["fx_spend_summary"] = VIEW_COLUMNS["fx_spend_detail"] = VIEW_COLUMNS["fx_spend"]


TEXT_COLUMNS = (
    "project_name ministry block_no payee outline method role purpose account_class relation remark "
    "dst_block src_block from_ministry"
).split()


def _view_sums(view: str) -> str:
    sums = [
        f"SUM(CAST('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 8) AS BIGINT))::BIGINT AS {c}_md5"
        if c in TEXT_COLUMNS
        else f"{_sum(c)} AS {c}_sum"
        for c in VIEW_COLUMNS[view].split()
        if c != "project_id"
    ]
    return f"SELECT project_id, '{view}' AS view_name, COUNT(*) AS records, {', '.join(sums)} FROM {view} GROUP BY project_id"


def _inferred(view: str) -> str:
    number = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
    cells = []
    for position, name in enumerate(VIEW_COLUMNS[view].split()):
        text = f"CAST({name} AS VARCHAR)"
        cells.append(
            f"""{{'position': {position}, 'column_name': '{name}', 'column_type': CASE
            WHEN COUNT(*) > 0 AND COUNT(*) FILTER (WHERE regexp_full_match({text}, '[+-]?[0-9]+')) = COUNT(*) THEN 'BIGINT'
            WHEN COUNT(*) FILTER (WHERE regexp_full_match({text}, '{number}')) = COUNT({name}) THEN 'DOUBLE'
            WHEN COUNT(*) FILTER (WHERE {text} IN ('True','TRUE','true','False','FALSE','false')) = COUNT({name})
                THEN 'BOOLEAN' ELSE 'VARCHAR' END}}"""
        )
    return f"""SELECT '{view}' AS view_name, c.position AS position, c.column_name AS column_name,
        c.column_type AS column_type, false AS notnull, false AS pk
    FROM (SELECT unnest([{", ".join(cells)}]) AS c FROM {view})"""


def _first_rows(view: str) -> str:
    names = VIEW_COLUMNS[view].split()
    order = ", ".join(n + " NULLS LAST" for n in names)
    fields = ", ".join(f"'{n}': {n}" for n in names)
    return f"""SELECT '{view}' AS view_name, CAST(row_number() OVER (ORDER BY {order}) AS INT) AS row_no,
        CAST(to_json({{{fields}}}) AS VARCHAR) AS "row" FROM (SELECT * FROM {view} ORDER BY {order} LIMIT 5)"""


def _lookup(view: str) -> str:
    return f"WITH {OVER} SELECT * FROM {view} WHERE project_id IN (SELECT project_id FROM over_budget)"


def oracle_sql() -> dict[str, str]:
    spend_order = ", ".join(c + " NULLS LAST" for c in VIEW_COLUMNS["fx_spend"].split())
    amount_text = "CAST(amount AS VARCHAR)"
    sql = {
        "scan_limit": f"SELECT * FROM fx_spend ORDER BY {spend_order} LIMIT 100",
        "table_catalog": f"""
            WITH files AS (SELECT p_partkey || '-' || p_size || '_XX_2024_' || replace(p_name, ' ', '_') || '.zip'
                AS file_name FROM part),
            parts AS (SELECT file_name, string_split(regexp_replace(file_name, '[.]zip$', ''), '_') AS p FROM files),
            named AS (SELECT file_name, 'tbl_' || replace(p[1], '-', '_') AS t, array_to_string(p[4:], '_') AS raw
                FROM parts),
            counted AS (SELECT *, row_number() OVER (PARTITION BY raw ORDER BY md5(file_name), file_name) AS n FROM named),
            taken AS (SELECT DISTINCT raw FROM named),
            numbers AS (SELECT raw, k, row_number() OVER (PARTITION BY raw ORDER BY k) + 1 AS n
                FROM (SELECT raw, unnest(range(2, 2 * m + 3)) AS k FROM (SELECT raw, count(*) AS m FROM named GROUP BY raw))
                WHERE raw || '_' || k NOT IN (SELECT raw FROM taken)),
            final AS (SELECT file_name, t, raw || CASE WHEN c.n > 1 THEN '_' || k ELSE '' END AS v
                FROM counted c LEFT JOIN numbers USING (raw, n))
            SELECT t AS table_name, v AS view_name, file_name, 'all' AS part FROM final
            UNION ALL SELECT t || '{fv.SUMMARY_TABLE_SUFFIX}', v || '{fv.SUMMARY_VIEW_SUFFIX}', file_name, 'summary'
            FROM final WHERE file_name LIKE '%{r.SPLIT_ARCHIVE}'
            UNION ALL SELECT t || '{fv.DETAIL_TABLE_SUFFIX}', v || '{fv.DETAIL_VIEW_SUFFIX}', file_name, 'detail'
            FROM final WHERE file_name LIKE '%{r.SPLIT_ARCHIVE}'""",
        "split_summary": f"SELECT * REPLACE (TRY_CAST({amount_text} AS DOUBLE) AS amount) FROM fx_spend "
        f"WHERE TRY_CAST({amount_text} AS DOUBLE) IS NULL",
        "split_detail": f"SELECT * REPLACE (TRY_CAST({amount_text} AS DOUBLE) AS amount) FROM fx_spend "
        f"WHERE TRY_CAST({amount_text} AS DOUBLE) IS NOT NULL",
        "verify_counts": " UNION ALL ".join(
            f"SELECT '{v}' AS view_name, COUNT(*) AS row_count, 'OK' AS status FROM {v}" for v in VIEWS
        ),
        "sample_of_views": " UNION ALL ".join(_first_rows(v) for v in sorted(VIEWS)[:3]),
        "schema_rows": " UNION ALL ".join(_inferred(v) for v in VIEWS),
        "schema_document": 'SELECT view_name, position, column_name AS name, column_type AS type, "notnull", pk FROM ('
        + " UNION ALL ".join(_inferred(v) for v in VIEWS)
        + ")",
        "lookup_project": f"SELECT * FROM fx_spend_detail WHERE project_id = {r.PROJECT}",
        "audit_prompt": """SELECT project_id, 'Rate from 1 (unrelated) to 5 (same subject) how well the contract fits the project.' || chr(10)
            || 'Project: ' || coalesce(project_name, '') || chr(10) || 'Contract: ' || coalesce(outline, '') || chr(10)
            || 'Answer with JSON only: {"score": number, "reason": text}' AS prompt FROM fx_overview""",
        "total_budget": f"SELECT {_sum('total_amt')} AS total_budget FROM fx_budget",
        "total_spend": f"SELECT {_sum('amount')} AS total_spend FROM fx_breakdown WHERE amount IS NOT NULL",
        "spend_vs_budget_rows": f"""
            WITH budgets AS (SELECT project_id, COUNT(*) AS budget_rows, {_sum("total_amt")} AS budget_total
                FROM fx_budget WHERE total_amt IS NOT NULL GROUP BY project_id)
            SELECT s.project_id, s.project_name, s.block_no, s.payee, s.amount, budget_rows, budget_total,
                s.amount / NULLIF(budget_total, 0) * 100 AS budget_pct
            FROM fx_spend s JOIN budgets b ON s.project_id = b.project_id""",
        "spend_vs_budget_grouped": f"""
            WITH budgets AS (SELECT project_id, project_name, {_sum("total_amt")} AS budget_total
                FROM fx_budget WHERE total_amt IS NOT NULL GROUP BY project_id, project_name),
            payees AS (SELECT project_id, payee, {_sum("amount")} AS payee_spend
                FROM fx_spend WHERE amount IS NOT NULL GROUP BY project_id, payee)
            SELECT b.project_id, project_name, budget_total, payee, payee_spend,
                payee_spend / NULLIF(budget_total, 0) * 100 AS budget_pct
            FROM budgets b JOIN payees p ON b.project_id = p.project_id""",
        "top_budget_project": f"WITH {TOP_PROJECT} SELECT * FROM top_project",
        "over_budget": f"""
            WITH {OVER}, parts AS (SELECT project_id, project_name, {_sum("initial_amt")} AS initial_total,
                {_sum("supplementary_amt")} AS supplementary_total, {_sum("carryover_amt")} AS carryover_total,
                {_sum("reserve_amt")} AS reserve_total FROM fx_budget GROUP BY project_id, project_name)
            SELECT o.*, p.initial_total, p.supplementary_total, p.carryover_total, p.reserve_total
            FROM over_budget o JOIN parts p ON o.project_id = p.project_id AND o.project_name = p.project_name""",
        "over_budget_by_year": f"""
            WITH {SPEND_TOTAL}, b AS (SELECT project_id, project_name, {_sum("total_amt")} AS budget_total
                FROM fx_budget WHERE fiscal_year = {r.YEAR} GROUP BY project_id, project_name)
            SELECT b.project_id, project_name, budget_total, spend_total, spend_total - budget_total AS excess
            FROM b JOIN spend_total s ON b.project_id = s.project_id WHERE spend_total > budget_total""",
        "over_budget_cause": f"WITH {CAUSES} SELECT * FROM causes",
        "over_budget_cause_counts": f"WITH {CAUSES} SELECT cause, COUNT(*) AS projects FROM causes GROUP BY cause",
        "execution_rates": f"""
            WITH totals AS (SELECT project_id, project_name, {_sum("total_amt")} AS budget_total,
                {_sum("executed_amt")} AS executed_total FROM fx_budget GROUP BY project_id, project_name)
            SELECT t.project_id, t.project_name, o.ministry, budget_total, executed_total,
                CASE WHEN budget_total = 0 THEN NULL ELSE executed_total / budget_total * 100 END AS rate_pct
            FROM totals t LEFT JOIN fx_org o ON t.project_id = o.project_id""",
        "rate_gap_top100": f"""WITH {RATES} SELECT * FROM rates
            ORDER BY rate_gap DESC NULLS LAST, project_id NULLS LAST, project_name NULLS LAST LIMIT 100""",
        "rate_match_top100": f"""WITH {RATES} SELECT * FROM rates WHERE budget_total > {r.MIN_BUDGET}
            ORDER BY rate_gap NULLS LAST, project_id NULLS LAST, project_name NULLS LAST LIMIT 100""",
        "obligation_within_budget": f"""WITH {WITHIN}
            SELECT project_id FROM within INTERSECT SELECT project_id FROM fx_obligation""",
        "obligation_counts": f"""
            WITH {WITHIN}, ids AS (SELECT DISTINCT project_id FROM fx_obligation),
            both_ids AS (SELECT project_id FROM within INTERSECT SELECT project_id FROM ids)
            SELECT (SELECT COUNT(*) FROM within) AS within_budget, (SELECT COUNT(*) FROM ids) AS with_obligation,
                (SELECT COUNT(*) FROM both_ids) AS exceptions, (SELECT COUNT(*) FROM both_ids) = 0 AS holds""",
        "reconcile_summary_detail": f"""
            WITH s AS (SELECT project_id, block_no, {_sum("block_total")} AS summary_total
                FROM fx_spend_summary WHERE block_total IS NOT NULL GROUP BY project_id, block_no),
            d AS (SELECT project_id, block_no, {_sum("amount")} AS detail_sum
                FROM fx_spend_detail GROUP BY project_id, block_no)
            SELECT s.project_id, o.project_name, s.block_no, summary_total, detail_sum,
                summary_total - detail_sum AS gap
            FROM s JOIN d ON s.project_id = d.project_id AND s.block_no = d.block_no
                LEFT JOIN fx_org o ON s.project_id = o.project_id
            WHERE ABS(summary_total - detail_sum) > 1""",
        "reconcile_detail_breakdown": f"""
            WITH b AS (SELECT project_id, block_no, payee, corp_no, outline, {_sum("amount")} AS breakdown_sum
                FROM fx_breakdown WHERE amount IS NOT NULL GROUP BY ALL)
            SELECT d.project_id, o.project_name, d.payee, d.outline, d.amount AS contract_amount, breakdown_sum,
                d.amount - breakdown_sum AS gap
            FROM fx_spend_detail d JOIN b ON d.project_id = b.project_id AND d.block_no = b.block_no
                AND d.payee = b.payee AND d.corp_no IS NOT DISTINCT FROM b.corp_no
                AND d.outline IS NOT DISTINCT FROM b.outline
                LEFT JOIN fx_org o ON d.project_id = o.project_id
            WHERE d.amount IS NOT NULL AND ABS(d.amount - breakdown_sum) > 1""",
        "lookup_detail": _lookup("fx_spend_detail"),
        "lookup_obligation": _lookup("fx_obligation"),
        "lookup_breakdown": _lookup("fx_breakdown"),
        "lookup_remarks": _lookup("fx_remarks"),
        "keyword_projects": f"""
            SELECT o.project_id, o.project_name, g.ministry, b.total_amt AS budget_amt
            FROM fx_overview o JOIN fx_org g ON o.project_id = g.project_id
                JOIN fx_budget b ON o.project_id = b.project_id
            WHERE {KEYWORDS} AND b.total_amt > 0""",
        "keyword_total": KEYWORD_TOTAL,
        "impact_ratio": f"""
            SELECT budget_rows, budget_total, CAST({r.VOLUME * r.RATE_CUT} AS DOUBLE) AS assumed_loss,
                CAST({r.VOLUME * r.RATE_CUT} AS DOUBLE) / NULLIF(budget_total, 0) * 100 AS impact_pct
            FROM ({KEYWORD_TOTAL})""",
        "ministry_summary": f"""
            SELECT g.ministry, COUNT(DISTINCT o.project_id) AS projects, {_sum("b.total_amt")} AS budget_total
            FROM fx_org g LEFT JOIN fx_overview o ON g.project_id = o.project_id
                LEFT JOIN fx_budget b ON g.project_id = b.project_id
            WHERE b.total_amt > 0 GROUP BY g.ministry""",
        "text_sample": "WITH rows_of AS (SELECT d.project_id, o.project_name, d.payee, d.outline FROM fx_spend_detail d "
        "LEFT JOIN fx_org o ON d.project_id = o.project_id WHERE d.outline IS NOT NULL "
        "AND o.project_name IS NOT NULL AND d.payee IS NOT NULL) SELECT project_name, payee, outline FROM ("
        + _sample("rows_of", ("project_id", "project_name", "payee", "outline"), 100)
        + ")",
        "related_projects": _lookup("fx_related"),
        "related_counts": f"""WITH {OVER} SELECT relation, COUNT(*) AS n FROM fx_related
            WHERE relation IS NOT NULL AND project_id IN (SELECT project_id FROM over_budget) GROUP BY relation""",
        "related_to_top_project": f"""WITH {TOP_PROJECT} SELECT * FROM fx_related
            WHERE project_id IN (SELECT project_id FROM top_project)""",
        "unique_name": "SELECT DISTINCT project_name FROM fx_overview WHERE project_name IS NOT NULL",
        "unique_payee": "SELECT DISTINCT payee FROM fx_spend_detail WHERE payee IS NOT NULL",
        "unique_outline": "SELECT DISTINCT outline FROM fx_spend_detail WHERE outline IS NOT NULL",
        **DQ_SQL,
        "dq_report": DQ_REPORT,
        "dq_counts": f"SELECT rule, COUNT(*) AS issues FROM ({DQ_REPORT}) GROUP BY rule",
        "project_dossier": "SELECT c.project_id, coalesce(o.project_name, '"
        + fv.UNKNOWN_PROJECT
        + "') AS project_name, c.* EXCLUDE (project_id) FROM ("
        + " UNION ALL BY NAME ".join(_view_sums(v) for v in VIEWS)
        + ") c LEFT JOIN fx_org o ON c.project_id = o.project_id AND o.other_no = 0",
        "dossier_flatten": """
            SELECT s.*, o.ministry AS lead_ministry
            FROM fx_spend s LEFT JOIN fx_org o ON s.project_id = o.project_id AND o.other_no = 0""",
        "fund_flow_edges": f"""
            SELECT project_name AS source, payee AS target, {_sum("amount")} AS value FROM fx_spend_detail
            GROUP BY project_name, payee HAVING {_sum("amount")} > {r.MIN_FLOW}""",
        "agent_flow": f"""
            WITH paid AS (SELECT * FROM fx_spend WHERE amount IS NOT NULL AND payee IS NOT NULL),
            payees AS (SELECT project_id, payee, {_sum("amount")} AS payee_spend FROM paid GROUP BY project_id, payee),
            top AS (SELECT * FROM payees QUALIFY row_number()
                OVER (PARTITION BY project_id ORDER BY payee_spend DESC, payee DESC) = 1),
            budgets AS (SELECT project_id, {_sum("total_amt")} AS budget_total FROM fx_budget GROUP BY project_id),
            blocks AS (SELECT project_id, payee, block_no, {_sum("amount")} AS block_spend FROM paid
                GROUP BY project_id, payee, block_no),
            roles AS (SELECT project_id, block_no, MAX(role) AS role FROM fx_spend
                WHERE amount IS NULL AND role IS NOT NULL GROUP BY project_id, block_no),
            edges AS (SELECT DISTINCT project_id, src_block, dst_block FROM fx_block_edges WHERE src_block IS NOT NULL)
            SELECT t.project_id, t.payee, payee_spend, budget_total,
                payee_spend / NULLIF(budget_total, 0) * 100 AS budget_pct, k.block_no, block_spend, role, dst_block
            FROM top t JOIN budgets b ON t.project_id = b.project_id
                JOIN blocks k ON t.project_id = k.project_id AND t.payee = k.payee
                LEFT JOIN roles r ON k.project_id = r.project_id AND k.block_no = r.block_no
                LEFT JOIN edges e ON k.project_id = e.project_id AND k.block_no = e.src_block""",
        "onward_flow": f"""
            WITH ends AS (SELECT DISTINCT project_id, block_no, substr(block_no, 1, 1) AS kind FROM fx_spend),
            edges AS (
                SELECT project_id, src_block, dst_block FROM fx_block_edges WHERE src_block IS NOT NULL
                UNION SELECT a.project_id, a.block_no, b.block_no FROM ends a JOIN ends b ON a.project_id = b.project_id
                    AND (a.kind = 'N' AND b.kind = 'R' OR a.kind = 'R' AND b.kind = 'N' AND a.project_id % 7 = 0)),
            paid AS (SELECT project_id, block_no, {_sum("amount")} AS paid FROM fx_spend WHERE amount > 0 GROUP BY ALL),
            weights AS (
                SELECT e.project_id, src_block, dst_block, coalesce(paid, 0) AS p, sum(coalesce(paid, 0)) OVER w AS total, count(*) OVER w AS n
                FROM edges e LEFT JOIN paid p ON e.project_id = p.project_id AND e.dst_block = p.block_no
                WINDOW w AS (PARTITION BY e.project_id, src_block)),
            origins AS (SELECT project_id, block_no AS origin, {_sum("amount")} AS spend FROM fx_spend
                WHERE amount IS NOT NULL GROUP BY ALL),
            walk AS (WITH RECURSIVE w AS (
                SELECT project_id, origin, origin AS block_no, 0 AS hops, CAST(1 AS DOUBLE) AS share FROM origins
                UNION ALL SELECT w.project_id, w.origin, e.dst_block, w.hops + 1,
                    w.share * CASE WHEN total > 0 THEN p / total ELSE 1.0 / n END
                FROM w JOIN weights e ON w.project_id = e.project_id AND w.block_no = e.src_block WHERE w.hops < 4) SELECT * FROM w)
            SELECT project_id, origin, block_no, hops, round(sum(share), 6) AS share, 
                CASE WHEN round(sum(share) * any_value(spend), 2) = 0 THEN 0 ELSE round(sum(share) * any_value(spend), 2) END AS amount
            FROM walk JOIN origins USING (project_id, origin) GROUP BY project_id, origin, block_no, hops""",
        "rag_documents": f"WITH {DOCUMENTS} SELECT * FROM documents_of",
        "embed_documents": f"""WITH {DOCUMENTS}, {_vectors("documents_of", "vectors")}
            SELECT document, {VECTOR_TEXT} AS vector, 'trigram-{DIM}' AS embedder FROM vectors""",
        "vector_store_rows": f"""WITH {STORE}, {_vectors("store", "vectors")}
            SELECT s.doc_id, {VECTOR_TEXT} AS vector, s.document, project_id, project_name, purpose, overview, outline,
                payee, amount, 'trigram-{DIM}' AS embedder
            FROM store s JOIN vectors v ON s.document = v.document""",
        "knn_top10": f"WITH {HITS} SELECT vec_id, label, round(distance, 6) AS distance FROM hits",
        "knn_questions": f"""SELECT question_id, CAST(rank AS INT) AS rank, vec_id, round(distance, 6) AS distance FROM (
            SELECT q.vec_id AS question_id, e.vec_id, sqrt({_distance("e.embedding", "q.embedding")}) AS distance,
                row_number() OVER (PARTITION BY q.vec_id ORDER BY {_distance("e.embedding", "q.embedding")}, e.vec_id) AS rank
            FROM embeddings e JOIN embeddings q ON e.vec_id <> q.vec_id) WHERE rank <= 10""",
        "knn_context": f"""WITH {HITS}
            SELECT array_to_string(list_sort(list(DISTINCT label)), ',') AS ids,
                string_agg('- vector ' || vec_id, chr(10) ORDER BY distance, vec_id) AS context FROM hits""",
        "retrieved_top_payees": f"WITH {HITS} {_top_payees('SELECT vec_id FROM hits')}",
        "ask_documents": f"""WITH {ANSWER}
            SELECT doc_id, project_id, document, round(distance, 6) AS distance FROM answers""",
        "ask_questions": f"""WITH {STORE}, questions AS (SELECT DISTINCT outline AS document FROM fx_overview),
            {_vectors("store", "doc_vectors")}, {_vectors("questions", "question_vectors")},
            texts AS (
                SELECT q.document AS question_id, v.document, sqrt({_distance("v.embedding", "q.embedding")}) AS distance
                FROM doc_vectors v, question_vectors q),
            near AS (SELECT * FROM texts QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY distance, document) <= 400)
            SELECT question_id, CAST(row_number() OVER (PARTITION BY question_id ORDER BY distance, doc_id) AS INT) AS rank,
                doc_id, project_id, round(distance * distance, 6) AS distance
            FROM near JOIN store s USING (document) QUALIFY rank <= 10""",
        "ask_top_payees": f"WITH {ANSWER} {_top_payees('SELECT project_id FROM answers')}",
        "audit_sample_ministry": _selection({"ministry": "MACHINERY", "sample_size": 100}),
        "audit_sample_top": _selection({"sort_by": "amount", "top_n": 100}),
        "audit_sample_ministry_top": _selection({"ministry": "MACHINERY", "sort_by": "amount", "top_n": 50}),
        "audit_parse": """
            WITH replies AS (SELECT event_id, CASE event_type
                WHEN 'error' THEN '```json' || chr(10) || '{' || replace(props, '"k"', '"score"')
                WHEN 'view' THEN CAST(event_id AS VARCHAR)
                ELSE '```json' || chr(10) || replace(props, '"k"', '"score"') || chr(10) || '```' END AS reply
                FROM events),
            parsed AS (SELECT event_id, TRY_CAST(replace(replace(trim(reply), '```json', ''), '```', '') AS JSON) AS j
                FROM replies)
            SELECT event_id, CASE WHEN json_type(j) = 'OBJECT' THEN CAST(j ->> 'score' AS DOUBLE) ELSE 0.0 END AS score,
                CASE WHEN json_type(j) = 'OBJECT' THEN j ->> 'reason' ELSE '"""
        + "no valid reply"
        + """' END AS reason FROM parsed""",
        "audit_score": f"""
            WITH chosen AS ({_selection({"sample_size": 100})}),
            pairs AS (SELECT *,
                list_distinct([substring(project_name, i, 2) for i in range(1, length(project_name))]) AS a,
                list_distinct([substring(outline, i, 2) for i in range(1, length(outline))]) AS b FROM chosen),
            sizes AS (SELECT *, len(list_intersect(a, b)) AS shared, len(list_distinct(list_concat(a, b))) AS either
                FROM pairs)
            SELECT project_name, outline, amount, ministry,
                CAST(CASE WHEN either = 0 THEN 1 ELSE 1 + (shared * 4) // either END AS DOUBLE) AS score,
                'shared character pairs' AS reason FROM sizes""",
        "scenario_report": SCENARIOS,
        "sql_report": f"""
            SELECT o.ministry, fiscal_year, COUNT(*) AS budget_rows, {_sum("total_amt")} AS budget_total
            FROM fx_budget b JOIN fx_overview o ON b.project_id = o.project_id
            WHERE total_amt > 1000 GROUP BY o.ministry, fiscal_year""",
    }
    return {key: sql_with_views(text) for key, text in sql.items()}
