"""Values that results must agree on. Plain text, in natural order.

Nothing here is computed; these are the domain's own words and formats.
"""

# --- fixed values: sheet names (views) of the domain -------------------------
BUDGET_VIEW = "予算・執行_サマリ"
SPEND_VIEW = "支出先_支出情報"
SPEND_SUMMARY_VIEW = "支出先_支出情報_サマリー"
SPEND_DETAIL_VIEW = "支出先_支出情報_明細"
BREAKDOWN_VIEW = "支出先_費目・使途"
BLOCK_EDGES_VIEW = "支出先_支出ブロックのつながり"
OBLIGATION_VIEW = "支出先_国庫債務負担行為等による契約"
ORG_VIEW = "基本情報_組織情報"
OVERVIEW_VIEW = "基本情報_事業概要等"
RELATED_VIEW = "基本情報_関連事業"
REMARKS_VIEW = "その他備考"

# --- fixed values: domain column -> name used by the operators ---------------
PROJECT_COLUMNS = {"予算事業ID": "project_id", "事業名": "project_name", "府省庁": "ministry"}
BUDGET_COLUMNS = {
    "予算年度": "fiscal_year",
    "会計区分": "account_class",
    "当初予算（合計）": "initial_amt",
    "補正予算（合計）": "supplementary_amt",
    "前年度からの繰越し（合計）": "carryover_amt",
    "予備費等（合計）": "reserve_amt",
    "計（歳出予算現額合計）": "total_amt",
    "執行額（合計）": "executed_amt",
    "執行率": "execution_rate",
}
SPEND_COLUMNS = {
    "支出先ブロック番号": "block_no",
    "支出先ブロック名": "block_name",
    "ブロックの合計支出額": "block_total",
    "支出先名": "payee",
    "法人番号": "corp_no",
    "契約概要": "outline",
    "金額": "amount",
    "契約方式等": "method",
    "事業を行う上での役割": "role",
    "支出先の合計支出額": "payee_total",
    "落札率": "bid_rate",
}
BREAKDOWN_COLUMNS = {
    "支出先ブロック番号": "block_no",
    "支出先名": "payee",
    "法人番号": "corp_no",
    "契約概要": "outline",
    "費目": "expense_item",
    "使途": "usage",
    "金額": "amount",
}
BLOCK_EDGES_COLUMNS = {
    "支出元の支出先ブロック": "src_block",
    "支出先の支出先ブロック": "dst_block",
    "担当組織からの支出": "from_ministry",
}
OBLIGATION_COLUMNS = {"契約額（国庫債務負担行為等による契約）": "contract_amt"}
ORG_COLUMNS = {"その他担当組織_作成責任者_no": "other_no"}
OVERVIEW_COLUMNS = {"事業の目的": "purpose", "事業の概要": "outline"}
RELATED_COLUMNS = {"関連事業の事業ID": "related_id", "関連性": "relation"}
REMARKS_COLUMNS = {"備考": "remark"}

# --- fixed values: catalog and schema document -------------------------------
TABLE_PREFIX = "tbl_"
SUMMARY_TABLE_SUFFIX = "_summary"
DETAIL_TABLE_SUFFIX = "_details"
SUMMARY_VIEW_SUFFIX = "_サマリー"
DETAIL_VIEW_SUFFIX = "_明細"
SPLIT_ARCHIVE = "支出先_支出情報.zip"
SCHEMA_CSV_HEADER = (
    "テーブルキー", "ビュー名(テーブル名)", "元ファイル名", "カラム名", "データ型", "NULL許容しない", "主キー",
)

# --- fixed values: causes of an over-budget project, first match wins --------
CAUSE_OBLIGATION = "国庫債務負担行為の可能性"
CAUSE_NEGATIVE_PART = "収入/返還等（マイナス予算）の可能性"
CAUSE_ZERO = "予算額ゼロ（別会計/繰越金等）"
CAUSE_NEGATIVE_TOTAL = "予算額マイナス（会計上の調整）"
CAUSE_UNKNOWN = "原因不明（要詳細調査）"

# --- fixed values: names of the data-quality rules ---------------------------
RULE_PAYEE_BLANK = "【要注意】明細行なのに支出先名が空欄"
RULE_CONTRACT_BLANK = "【要注意】明細行なのに契約情報が両方空欄"
RULE_PURPOSE_BLANK = "【要注意】事業の目的が空欄"
RULE_NEGATIVE = "【参考】支出金額がマイナス"
RULE_NO_AMOUNT = "【参考】支出に関する金額情報が一切ない"
RULE_BUDGET_NOT_POSITIVE = "【参考】事業全体の予算額が0以下"
RULE_ROLE_BLANK = "【参考】役割が空欄だが金額のあるサマリー行"

# --- fixed values: keywords of road projects ---------------------------------
NAME_KEYWORDS = ("道路", "高速道路", "国道", "インフラ")
PURPOSE_KEYWORDS = ("道路", "交通網")

# --- fixed values: text documents --------------------------------------------
OUTLINE_STOP_LIST = ("その他", "職員旅費", "謝金", "配分", "電気料", "委託費", "その他経費")
OUTLINE_MIN_LENGTH = 5
NO_PURPOSE = "目的の記述なし"
NO_OVERVIEW = "概要の記述なし"
DOCUMENT_TEMPLATE = (
    "事業名「{project_name}」。この事業の目的は「{purpose}」であり、概要は「{overview}」です。"
    "この事業において、支出先「{payee}」に対し、「{outline}」という内容で契約が行われました。"
)
UNKNOWN_PROJECT = "不明な事業"
