"""Queries on statement rows: pivots, counts, look-ups, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from kessan.functions.filters import is_filled
from kessan.operators import audit, tables
from kessan.plans import exports, mart
from kessan.plans.statements import BODY, statements
from kessan.queries import steps
from kessan.queries.registry import query
from kessan.session import written

_RP = "CASE period WHEN 'Prior2Year' THEN 1 WHEN 'Prior1Year' THEN 2 WHEN 'CurrentYear' THEN 3 ELSE 9 END"
_FIGURES = "sales, op_profit, net_income, total_assets, equity"


def rows_of(t):
    return tables.statement_rows(statements(t.facts, only=BODY, few_copies=True))


def bs_pl(t, *only):
    """Rows of balance sheet and income statement, or of the one named: a statement's rows do not depend on another's."""
    return tables.statement_rows(statements(t.facts, only=only or ("BS", "PL"), few_copies=True))


@query(
    "statement_rows", "N27 M8 N5",
    "SELECT doc_id, statement, item, period, value, value_num FROM rows_num",
    "rows_num",
)
def _(t):
    return rows_of(t)


@query("mart", "A1 U1", f"SELECT doc_id, period, {_FIGURES} FROM mart", "mart")
def _(t):
    return mart.mart(bs_pl(t))


@query(
    "ratio_mart", "E2 A1 N6 O1 U1 N27",
    f"SELECT doc_id, period, {_FIGURES}, {steps.RATIOS} FROM mart",
    "mart",
)
def _(t):
    return tables.in_order(mart.mart_of_facts(t.facts, few_copies=True), "doc_id", tables.report_place(F.col("period")))


@query(
    "mart_in_report_order", "O1",
    f"SELECT doc_id, period, {_RP} AS place, sales FROM mart",
    "mart",
)
def _(t):
    place = tables.report_place(F.col("period"))
    return tables.in_order(mart.mart(bs_pl(t)).select("doc_id", "period", place.alias("place"), "sales"), "doc_id", "place")


@query(
    "mart_scaled", "N7 N6",
    f"SELECT doc_id, period, sales / 1e8 AS sales_oku, op_margin * 100 AS op_margin_pct, roa * 100 AS roa_pct, equity_ratio * 100 AS equity_ratio_pct FROM "
    f"(SELECT *, {steps.RATIOS} FROM mart)",
    "mart",
)
def _(t):
    scaled = tables.with_scaled(mart.mart_of_facts(t.facts))
    return scaled.select("doc_id", "period", "sales_oku", "op_margin_pct", "roa_pct", "equity_ratio_pct")


@query(
    "income_of_one_filing", "A2",
    "SELECT period, max(CASE WHEN item = '売上高' THEN value_num END) AS sales, max(CASE WHEN item = '営業利益' THEN value_num END) AS op, "
    "max(CASE WHEN item = '当期利益' THEN value_num END) AS ni FROM rows_num WHERE statement = 'PL' AND doc_id = 'S66' GROUP BY period",
    "rows_num",
)
def _(t):
    rows = bs_pl(t, "PL").filter("doc_id = 'S66'")
    return tables.period_pivot(rows, {"sales": "売上高", "op": "営業利益", "ni": "当期利益"}, ("period",))


@query(
    "row_counts", "A3",
    "SELECT statement, period, count(*) AS n FROM rows_num WHERE statement IN ('BS', 'PL') GROUP BY statement, period UNION ALL "
    "SELECT statement, 'all', count(*) FROM rows_num WHERE statement IN ('BS', 'PL') GROUP BY statement",
    "rows_num",
)
def _(t):
    pairs = F.array(F.col("period"), F.lit("all"))
    return bs_pl(t).select("statement", F.explode(pairs).alias("period")).groupBy("statement", "period").agg(F.count("*").alias("n"))


@query(
    "items_with_part", "P11 A22",
    "SELECT DISTINCT item FROM rows_num WHERE statement = 'PL' AND contains(item, '売上')",
    "rows_num",
)
def _(t):
    return tables.find_items(bs_pl(t, "PL"), "売上")


@query(
    "first_items_with_part", "P11 O2",
    "SELECT DISTINCT item FROM rows_num WHERE statement = 'BS' AND contains(item, '金') ORDER BY item LIMIT 2",
    "rows_num",
)
def _(t):
    return tables.find_items(bs_pl(t, "BS"), "金", 2)


@query(
    "items_of_filing", "P12",
    "SELECT item, value_num FROM rows_num WHERE statement = 'PL' AND doc_id = 'S66' AND period = 'Prior1Year' AND item IN ('売上高', '営業利益', '当期利益', '売上原価')",
    "rows_num",
)
def _(t):
    return tables.items_of(bs_pl(t, "PL"), "S66", "Prior1Year", ["売上高", "営業利益", "当期利益", "売上原価"])


@query(
    "item_over_time", "A23",
    "SELECT doc_id, period, value_num FROM rows_num WHERE statement = 'BS' AND item = '総資産'",
    "rows_num",
)
def _(t):
    return tables.item_over_time(bs_pl(t, "BS"), "総資産")


@query(
    "distinct_items_and_periods", "A22",
    "SELECT 'item' AS kind, item AS name FROM rows_num GROUP BY item UNION ALL SELECT 'period', period FROM rows_num GROUP BY period",
    "rows_num",
)
def _(t):
    pairs = F.array(
        F.struct(F.lit("item").alias("kind"), F.col("item").alias("name")),
        F.struct(F.lit("period").alias("kind"), F.col("period").alias("name")),
    )
    return rows_of(t).select(F.inline(pairs)).distinct()


@query(
    "current_period_rows", "P30",
    "SELECT doc_id, item, value FROM rows_num WHERE statement = 'PL' AND period = 'CurrentYear'",
    "rows_num",
)
def _(t):
    return bs_pl(t, "PL").filter("period = 'CurrentYear'").select("doc_id", "item", "value")


@query(
    "both_statements", "U1",
    "SELECT doc_id, period, item, value_num FROM rows_num WHERE statement IN ('BS', 'PL')",
    "rows_num",
)
def _(t):
    rows = bs_pl(t)
    return tables.both_statements(rows.filter("statement = 'BS'"), rows.filter("statement = 'PL'"))


@query(
    "items_per_company", "A16",
    "SELECT DISTINCT e.entity_id, s.statement, s.item FROM statements s JOIN entities e ON e.doc_id = s.doc_id WHERE s.statement IN ('BS', 'PL')",
    "statements entities",
)
def _(t):
    return exports.item_union(statements(t.facts, only=("BS", "PL")), t.entities)


@query(
    "labelled_sources", "U3",
    "SELECT doc_id, 1 AS label FROM (SELECT docID AS doc_id FROM positive) UNION ALL SELECT docID, 0 FROM annual WHERE docID NOT IN (SELECT docID FROM positive)",
    "positive annual",
)
def _(t):
    fraud = t.filings.join(
        t.judgements.filter("is_accounting_fraud").select(F.col("original_doc_id").alias("docID")), "docID", "left_semi"
    ).select(F.col("docID").alias("doc_id"))
    others = t.annual.select(F.col("docID").alias("doc_id")).join(fraud, "doc_id", "left_anti")
    return fraud.withColumn("label", F.lit(1)).unionByName(others.withColumn("label", F.lit(0)))


@query(
    "wide_to_long", "N24",
    "SELECT 'PL' AS statement, doc_id, period, 'sales' AS figure, sales AS value FROM mart UNION ALL SELECT 'PL', doc_id, period, 'op_profit', op_profit FROM mart",
    "mart",
)
def _(t):
    wide = mart.mart(bs_pl(t)).select("doc_id", "period", "sales", "op_profit")
    return tables.wide_to_long(wide, ["doc_id", "period"], "figure", "value", statement="PL")


@query(
    "template_rows_filled", "P25",
    "SELECT doc_id, turn_text FROM (SELECT conv_id AS doc_id, CASE turn % 4 WHEN 0 THEN ' ' WHEN 1 THEN 'NaN' WHEN 2 THEN NULL ELSE role END AS turn_text FROM conversations) "
    "WHERE turn_text IS NOT NULL AND trim(turn_text) <> '' AND lower(trim(turn_text)) <> 'nan'",
)
def _(t):
    shown = F.expr("CASE turn % 4 WHEN 0 THEN ' ' WHEN 1 THEN 'NaN' WHEN 2 THEN NULL ELSE role END")
    rows = t.raw("conversations").select(F.col("conv_id").alias("doc_id"), shown.alias("turn_text"))
    return rows.filter(is_filled(F.col("turn_text")))


@query(
    "first_candidate_label", "N12",
    "SELECT doc_id, value FROM (SELECT doc_id, value, CASE item WHEN '当期純利益' THEN 0 WHEN '当期利益' THEN 1 WHEN '親会社株主に帰属する当期純利益' THEN 2 "
    "WHEN '親会社株主に帰属する当期利益' THEN 3 END AS place FROM statements WHERE statement = 'PL' AND period = 'CurrentYear') WHERE place IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY place) = 1",
    "statements",
)
def _(t):
    found = exports.candidate_values(statements(t.facts, only=("BS", "PL")), ["当期純利益"])
    return found.select("doc_id", "value")


def accrual_companies(t):
    return t.companies.select(
        F.col("entity_id").alias("edinet_code"), "sec_code", F.col("name").alias("company_name"), "industry",
        F.col("listing").alias("market"),
    )


@query(
    "run_counters", "A24",
    "SELECT 'targets' AS kind, count(*) AS n FROM judged WHERE reason IS NULL UNION ALL SELECT 'excluded', count(*) FROM judged WHERE reason IS NOT NULL "
    "UNION ALL SELECT 'none', 0",
    "judged",
)
def _(t):
    from kessan.plans import targets

    judged = written(targets.judged_companies(t.filings, t.listing), "judged")
    return audit.run_counters(
        targets=targets.targets(judged), excluded=targets.excluded(judged), none=judged.filter("file_count < 0")
    )
