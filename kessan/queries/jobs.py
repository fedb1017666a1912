"""Queries for the end-to-end jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kessan import sinks, sources
from kessan.operators import joins, select
from kessan.plans import accruals, corpus_audit, exports, filing_index, labelled_sets, mart
from kessan.plans.statements import statements
from kessan.queries import steps
from kessan.queries.aggregates import accrual_companies
from kessan.queries.companies import pro_market
from kessan.queries.registry import query
from kessan.session import scratch_path, written

# --- three-year table ----------------------------------------------------------------------

steps.add_cte("keyed_mart", "SELECT m.*, e.entity_id FROM mart m JOIN entities e ON e.doc_id = m.doc_id", "mart", "entities")
steps.add_cte(
    "newest_docs",
    "SELECT entity_id, doc_id FROM keyed_mart WHERE period = 'CurrentYear' AND sales IS NOT NULL QUALIFY row_number() OVER "
    "(PARTITION BY entity_id ORDER BY sales DESC, doc_id DESC) = 1",
    "keyed_mart",
)


def _near_sql(tolerance: float) -> str:
    return (
        "SELECT p.entity_id, p.doc_id, p.amount, min(c.doc_id) AS match_doc FROM prior_totals p JOIN current_totals c ON c.entity_id = p.entity_id "
        f"AND abs(c.amount - p.amount) <= {tolerance} AND c.doc_id <> p.doc_id GROUP BY p.entity_id, p.doc_id, p.amount"
    )


# Orders of one priority as one company: amounts of many orders lie close together.
_TOTALS = "SELECT o_orderpriority AS entity_id, 'S' || CAST(o_orderkey AS STRING) AS doc_id, {0} AS amount FROM orders"
steps.add_cte("current_totals", _TOTALS.format("o_totalprice"))
steps.add_cte("prior_totals", _TOTALS.format("o_totalprice - 1000"))


def _totals(t, amount: str):
    return t.raw("orders").select(
        F.col("o_orderpriority").alias("entity_id"), F.expr("'S' || CAST(o_orderkey AS STRING)").alias("doc_id"),
        F.expr(amount).alias("amount"),
    )


@query("near_matches", "J9", _near_sql(0.5), "current_totals prior_totals")
def _(t):
    return joins.near_matches(_totals(t, "o_totalprice"), _totals(t, "o_totalprice - 1000"))


@query("near_matches_wide", "J9", _near_sql(25), "current_totals prior_totals")
def _(t):
    return joins.near_matches(_totals(t, "o_totalprice"), _totals(t, "o_totalprice - 1000"), 25.0)


# Yearly revenue per customer as filings: current sales is the year, prior sales the year before.
steps.add_cte(
    "revenue_mart",
    "SELECT 'C' || CAST(o_custkey AS STRING) AS entity_id, 'C' || CAST(o_custkey AS STRING) || '-' || CAST(y + d AS STRING) AS doc_id, "
    "CASE d WHEN 0 THEN 'CurrentYear' ELSE 'Prior1Year' END AS period, sales, sales / 10 AS op_profit, sales / 20 AS net_income, sales * 2 AS total_assets, sales / 2 AS equity "
    "FROM (SELECT o_custkey, year(o_orderdate) AS y, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) AS sales FROM orders GROUP BY o_custkey, year(o_orderdate)), "
    "(VALUES (0), (1)) AS v(d)",
)
_FIG = "sales, op_profit, net_income, total_assets, equity"


@query(
    "three_year_table", "E3 W8 J9 N7",
    f"SELECT entity_id, t, doc_id, {_FIG}, op_margin, roa, equity_ratio, sales / 1e8 AS sales_oku, op_margin * 100 AS op_margin_pct, roa * 100 AS roa_pct, "
    f"equity_ratio * 100 AS equity_ratio_pct FROM (SELECT *, {steps.RATIOS} FROM ("
    f"SELECT m.entity_id, 't0' AS t, m.doc_id, {_FIG} FROM revenue_mart m JOIN linked l ON m.doc_id = l.doc_id WHERE period = 'CurrentYear' UNION ALL "
    f"SELECT m.entity_id, 't-1', m.doc_id, {_FIG} FROM revenue_mart m JOIN linked l ON m.doc_id = l.doc_id WHERE period = 'Prior1Year' UNION ALL "
    f"SELECT m.entity_id, 't-2', m.doc_id, {_FIG} FROM revenue_mart m JOIN linked l ON m.doc_id = l.prev_doc WHERE period = 'Prior1Year'))",
    "linked",
)
def _(t):
    yearly = t.raw("orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(
        F.sum(F.expr("CAST(round(o_totalprice * 100) AS BIGINT)")).cast("double").alias("sales")
    )
    entity = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    rows = yearly.withColumn("d", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        entity.alias("entity_id"),
        F.concat(entity, F.lit("-"), (F.col("y") + F.col("d")).cast("string")).alias("doc_id"),
        F.when(F.col("d") == 0, "CurrentYear").otherwise("Prior1Year").alias("period"),
        "sales", (F.col("sales") / 10).alias("op_profit"), (F.col("sales") / 20).alias("net_income"),
        (F.col("sales") * 2).alias("total_assets"), (F.col("sales") / 2).alias("equity"),
    )
    entities = rows.select("doc_id", "entity_id").distinct()
    return mart.three_years(rows.drop("entity_id"), entities)


steps.add_cte(
    "revenue_newest",
    "SELECT entity_id, doc_id FROM revenue_mart WHERE period = 'CurrentYear' QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY sales DESC, doc_id DESC) = 1",
    "revenue_mart",
)
steps.add_cte(
    "linked",
    "SELECT n.entity_id, n.doc_id, min(c.doc_id) AS prev_doc FROM revenue_newest n JOIN revenue_mart p ON p.doc_id = n.doc_id AND p.period = 'Prior1Year' "
    "JOIN revenue_mart c ON c.entity_id = n.entity_id AND c.period = 'CurrentYear' AND c.doc_id <> n.doc_id AND abs(c.sales - p.sales) <= 0.5 "
    "JOIN revenue_mart o ON o.doc_id = c.doc_id AND o.period = 'Prior1Year' GROUP BY n.entity_id, n.doc_id",
    "revenue_newest",
)

# --- accrual inputs ------------------------------------------------------------------------

_PLACES = []
for measure in accruals.MEASURES:
    for place, element in enumerate(measure.elements):
        _PLACES.append((measure.name, "jppfs_cor:" + element, measure.rel_year, measure.period_type, place))
steps.add_cte("slots", steps.values(_PLACES, "measure", "element", "rel_year", "period_type", "place"))
steps.add_cte(
    "consolidated_docs",
    "SELECT DISTINCT doc_id FROM facts WHERE element IN ('jppfs_cor:NetSales', 'jppfs_cor:NetSalesOfCompletedConstructionContracts') "
    "AND consol = '連結' AND rel_year = '当期'",
    "facts",
)
steps.add_cte(
    "figures",
    "SELECT f.doc_id, s.measure, substr(f.element, 11) AS name, max(f.number) AS number FROM (SELECT *, "
    f"{steps.NUMBER.format('value')} * CASE unit WHEN '千円' THEN 1e3 WHEN '百万円' THEN 1e6 ELSE 1 END AS number FROM line_facts) f JOIN slots s ON s.element = f.element AND "
    "s.rel_year = f.rel_year AND s.period_type = f.period_type WHERE f.number IS NOT NULL AND NOT (contains(context, 'Member') AND NOT contains(context, 'ConsolidatedMember')) "
    "AND f.consol = CASE WHEN f.doc_id IN (SELECT doc_id FROM consolidated_docs) THEN '連結' ELSE '個別' END GROUP BY f.doc_id, s.measure, s.place, f.element "
    "QUALIFY row_number() OVER (PARTITION BY f.doc_id, s.measure ORDER BY s.place) = 1",
    "line_facts", "slots", "consolidated_docs",
)
_WIDE = ", ".join(
    f"max(CASE WHEN measure = '{m.name}' THEN number END) AS {m.name}, max(CASE WHEN measure = '{m.name}' THEN name END) AS {m.name}_element"
    for m in accruals.MEASURES
)
steps.add_cte("wide_figures", f"SELECT doc_id, {_WIDE} FROM figures GROUP BY doc_id", "figures")
_BASIS = "CASE WHEN is_consolidated THEN '連結' ELSE '個別' END"
_REASONS = ", ".join(
    "CASE WHEN {0} IS NULL THEN '{1}' END".format(c, text.replace("{}", "' || " + _BASIS + " || '"))
    for c, text in accruals.MISSING_TEXTS
)
steps.add_cte(
    "accrual_grid",
    "SELECT *, CASE WHEN doc_id IS NULL THEN CASE WHEN other_reason IS NOT NULL THEN 'accounting_standard: ' || other_reason ELSE 'no_tsv_found_for_year' END "
    f"ELSE concat_ws('; ', {_REASONS}) END AS missing_reason FROM (SELECT *, ni_t - cfo_t AS ta_t, rev_t - rev_t1 AS d_rev, ar_end_t - ar_end_t1 AS d_ar FROM "
    "(SELECT c.entity_id AS edinet_code, c.sec_code, c.name AS company_name, c.industry, c.listing AS market, CAST(y.fiscal_year AS INT) AS fiscal_year, b.period_end, b.submit_text AS submit_datetime, "
    "b.doc_id, b.path AS tsv_path, b.doc_id IN (SELECT doc_id FROM consolidated_docs) AS is_consolidated, r.standard_reason AS other_reason, "
    "w.* EXCLUDE (doc_id), rec_base_t AS ar_end_t_no_e, rec_base_t1 AS ar_end_t1_no_e, "
    "rec_base_t + COALESCE(eclaims_end_t, 0) AS ar_end_t, rec_base_t1 + COALESCE(eclaims_end_t1, 0) AS ar_end_t1, "
    "CASE WHEN rec_base_t IS NOT NULL THEN 'PLUS_E' ELSE 'NO_BASE' END AS rec_rule, COALESCE(rec_base_t_element, '') AS rec_used_base_eid, "
    "COALESCE(eclaims_end_t_element, '') AS rec_used_eclaims_eid FROM companies c, (SELECT unnest(range(2015, 2025)) AS fiscal_year) y "
    "LEFT JOIN best_year b ON b.entity_id = c.entity_id AND b.fiscal_year = y.fiscal_year LEFT JOIN wide_figures w ON w.doc_id = b.doc_id "
    "LEFT JOIN (SELECT entity_id, fiscal_year, arg_max(standard_reason, path) AS standard_reason FROM headers WHERE NOT accepted GROUP BY entity_id, fiscal_year) r "
    "ON r.entity_id = c.entity_id AND r.fiscal_year = y.fiscal_year))",
    "companies", "best_year", "wide_figures", "consolidated_docs", "headers",
)


@query(
    "figures_of_filings", "D10 D12 W9 A13 A14",
    "SELECT d.doc_id, d.doc_id IN (SELECT doc_id FROM consolidated_docs) AS is_consolidated, w.* EXCLUDE (doc_id) FROM "
    "(SELECT DISTINCT doc_id FROM line_facts WHERE element IN (SELECT element FROM slots)) d LEFT JOIN wide_figures w ON w.doc_id = d.doc_id",
    "line_facts slots wide_figures consolidated_docs",
)
def _(t):
    return accruals.basis_and_values(t.facts)


def _grid(t):
    return accruals.accrual_rows(t.facts, t.entities, accrual_companies(t))


@query(
    "accrual_inputs", "E4 J8 W2 W9 D12 N14 N15 P24 P20 P21",
    f"SELECT {', '.join(accruals.OUTPUT_COLUMNS)} FROM accrual_grid WHERE missing_reason = ''",
    "accrual_grid",
)
def _(t):
    return accruals.complete_rows(_grid(t))


@query(
    "accrual_missing_log", "Q1 A21 J8",
    "SELECT edinet_code, fiscal_year, COALESCE(tsv_path, '') AS tsv_path, missing_reason FROM accrual_grid WHERE missing_reason <> ''",
    "accrual_grid",
)
def _(t):
    return accruals.missing_log(_grid(t))


@query(
    "accrual_duplicates_log", "Q2",
    "SELECT h.entity_id AS edinet_code, h.fiscal_year, b.doc_id || '.tsv' AS chosen_tsv, b.submit_text AS chosen_submit_datetime, h.doc_id || '.tsv' AS skipped_tsv, "
    "'duplicate_skipped: newer submit_datetime or filename chosen' AS skipped_reason FROM headers h JOIN best_year b ON h.entity_id = b.entity_id AND "
    "h.fiscal_year = b.fiscal_year WHERE h.accepted AND h.doc_id <> b.doc_id AND h.fiscal_year BETWEEN 2015 AND 2024",
    "best_year",
)
def _(t):
    return accruals.duplicates(t.facts, t.entities, accrual_companies(t))


@query(
    "accrual_receivables_log", "Q3 N14",
    "SELECT edinet_code, fiscal_year, tsv_path, is_consolidated, rec_rule, rec_base_t AS rec_base_end_t, rec_base_t1 AS rec_base_end_t1, eclaims_end_t AS rec_eclaims_end_t, "
    "eclaims_end_t1 AS rec_eclaims_end_t1, ar_end_t AS rec_plus_e_end_t, ar_end_t1 AS rec_plus_e_end_t1, COALESCE(rec_base_t_element, '') AS rec_used_base_eid_end_t, "
    "COALESCE(rec_base_t1_element, '') AS rec_used_base_eid_end_t1, COALESCE(eclaims_end_t_element, '') AS rec_used_eclaims_eid_end_t, "
    "COALESCE(eclaims_end_t1_element, '') AS rec_used_eclaims_eid_end_t1 FROM accrual_grid WHERE doc_id IS NOT NULL",
    "accrual_grid",
)
def _(t):
    return accruals.receivables_log(_grid(t))


def _accrual_run(t) -> tuple[str, DataFrame]:
    """One run of the job on a target list from a file: its four tables on disk, and the counters its
    writers gave."""
    root = scratch_path(t.spark, "accrual-run")
    sinks.write_csv(accrual_companies(t).withColumn("file_count", F.lit(1)), f"{root}/targets")
    listed = sources.read_target_list(t.spark, f"{root}/targets")
    return root, accruals.write_accrual_run(accruals.accrual_inputs(t.facts, t.entities, listed), root)


steps.add_cte(
    "accrual_outputs",
    "SELECT 'inputs' AS kind, edinet_code, fiscal_year, doc_id AS detail FROM accrual_grid WHERE missing_reason = '' UNION ALL "
    "SELECT 'missing', edinet_code, fiscal_year, missing_reason FROM accrual_grid WHERE missing_reason <> '' UNION ALL "
    "SELECT 'receivables', edinet_code, fiscal_year, rec_rule FROM accrual_grid WHERE doc_id IS NOT NULL UNION ALL "
    "SELECT 'duplicates', h.entity_id, h.fiscal_year, h.doc_id || '.tsv' FROM headers h JOIN best_year b ON h.entity_id = b.entity_id AND "
    "h.fiscal_year = b.fiscal_year WHERE h.accepted AND h.doc_id <> b.doc_id AND h.fiscal_year BETWEEN 2015 AND 2024",
    "accrual_grid", "best_year", "headers",
)


@query("accrual_run", "E4 Q1 Q2 Q3 S7", "SELECT kind, edinet_code, CAST(fiscal_year AS INT) AS fiscal_year, detail FROM accrual_outputs", "accrual_outputs")
def _(t):
    """The four outputs of one run, read back from what it wrote."""
    root, _ = _accrual_run(t)
    details = {"inputs": "doc_id", "missing": "missing_reason", "duplicates": "skipped_tsv", "receivables": "rec_rule"}
    read = [
        t.spark.read.parquet(f"{root}/{kind}").select(F.lit(kind).alias("kind"), "edinet_code", F.col("fiscal_year").cast("int"), F.col(c).alias("detail"))
        for kind, c in details.items()
    ]
    return reduce(DataFrame.union, read)


@query("accrual_counters", "E4 A24", "SELECT kind, count(*) AS n FROM accrual_outputs GROUP BY kind", "accrual_outputs")
def _(t):
    return _accrual_run(t)[1]


@query(
    "company_years", "J8",
    "SELECT c.entity_id, CAST(y.fiscal_year AS INT) AS fiscal_year, b.doc_id FROM companies c, (SELECT unnest(range(2015, 2025)) AS fiscal_year) y "
    "LEFT JOIN best_year b ON b.entity_id = c.entity_id AND b.fiscal_year = y.fiscal_year",
    "companies best_year",
)
def _(t):
    headers = accruals.filing_headers(t.facts, t.entities).filter("accepted")
    grid = select.company_years(t.companies.select("entity_id"), 2015, 2024)
    best = select.best_per_year(headers).select("entity_id", "fiscal_year", "doc_id")
    return grid.join(best, ["entity_id", "fiscal_year"], "left")


# --- template and full export --------------------------------------------------------------

TEMPLATE = (
    "売上高", "売上原価", "営業利益", "当期純利益", "", "流動資産", "現金預金", "売掛金", "電子記録債権", "棚卸資産（合計）", "商品", "原材料", "仕掛品",
    "総資産", "純資産", "有利子負債", "売上債権（合計）", "仕入債務（合計）", "有形固定資産", "株価", "EPS（1株当たり利益）", "社債", "土地", "nan",
)
_ITEMS = [(n, item) for n, item in enumerate(TEMPLATE) if item and item != "nan"]
steps.add_cte("template", steps.values(_ITEMS, "place", "target"))
steps.add_cte("routes", steps.values(exports.routes([i for _, i in _ITEMS]), "target", "statement", "item", "part", "place"))
steps.add_cte(
    "template_slots",
    "SELECT *, 'Y' || CAST(row_number() OVER (PARTITION BY edinetCode ORDER BY COALESCE(submitDateTime, ''), docID) AS STRING) AS slot FROM "
    "(SELECT * FROM annual QUALIFY row_number() OVER (PARTITION BY edinetCode ORDER BY COALESCE(submitDateTime, '') DESC, docID DESC) <= 3)",
    "annual",
)
steps.add_cte(
    "part_values",
    "SELECT s.doc_id, r.target, r.part, s.value FROM statements s JOIN routes r ON r.statement = s.statement AND r.item = s.item WHERE s.period = 'CurrentYear' "
    "QUALIFY row_number() OVER (PARTITION BY s.doc_id, r.target, r.part ORDER BY r.place) = 1",
    "statements", "routes",
)
_NUM = steps.NUMBER.format("value")
steps.add_cte(
    "template_values",
    f"SELECT doc_id, target, CASE WHEN itself IS NOT NULL THEN {steps.NUMBER.format('itself')} ELSE parts END AS number FROM (SELECT doc_id, target, "
    f"COALESCE(max(CASE WHEN part = 'PL' THEN value END), max(CASE WHEN part = 'BS' THEN value END)) AS itself, "
    f"sum(CASE WHEN part NOT IN ('PL', 'BS') THEN {_NUM} END) AS parts FROM part_values GROUP BY doc_id, target)",
    "part_values",
)
steps.add_cte(
    "template_long",
    "SELECT s.edinetCode, i.place, i.target, s.slot, s.docID AS doc_id, CASE WHEN i.target IN ('EPS（1株当たり利益）', '株価') THEN CAST(v.number AS STRING) "
    "ELSE CAST(CAST(round_even(v.number, 0) AS BIGINT) AS STRING) END AS value FROM template_slots s CROSS JOIN template i "
    "LEFT JOIN template_values v ON v.doc_id = s.docID AND v.target = i.target",
    "template_slots", "template", "template_values",
)


def _template(t, items=TEMPLATE, filings=None):
    slots = exports.template_slots(t.annual if filings is None else filings, 3)
    docs = slots.select(F.col("docID").alias("doc_id"))
    values = exports.template_values(statements(t.facts, only=("BS", "PL"), docs=docs, few_copies=True), items)
    return exports.template_long(slots, values, items)


@query(
    "template_slots", "W3 W6",
    "SELECT edinetCode AS \"edinetCode\", slot, docID AS \"docID\" FROM template_slots",
    "template_slots",
)
def _(t):
    return exports.template_slots(t.annual, 3).select("edinetCode", "slot", "docID")


@query(
    "template_values", "J10 N12 N13 N29 N11",
    "SELECT edinetCode AS \"edinetCode\", place, target, slot, doc_id, value FROM template_long",
    "template_long",
)
def _(t):
    return _template(t)


@query(
    "template_export", "E5 N3 N4 P25",
    "SELECT edinetCode AS \"edinetCode\", place, target, max(CASE WHEN slot = 'Y1' THEN value END) AS \"Y1\", max(CASE WHEN slot = 'Y2' THEN value END) AS \"Y2\", "
    "max(CASE WHEN slot = 'Y3' THEN value END) AS \"Y3\" FROM template_long GROUP BY 1, 2, 3",
    "template_long",
)
def _(t):
    return exports.template_table(_template(t), 3)


@query(
    "template_export_from_files", "E5 S7",
    "SELECT edinetCode AS \"edinetCode\", place, target, max(CASE WHEN slot = 'Y1' THEN value END) AS \"Y1\", max(CASE WHEN slot = 'Y2' THEN value END) AS \"Y2\", "
    "max(CASE WHEN slot = 'Y3' THEN value END) AS \"Y3\" FROM template_long WHERE place < 12 GROUP BY 1, 2, 3",
    "template_long",
)
def _(t):
    """The job with its inputs as files: a shorter template, and the list of filings to take."""
    root = scratch_path(t.spark, "template-job")
    form = [(n, item, None, None, None) for n, item in enumerate(TEMPLATE[:12])]
    template = t.spark.createDataFrame(form, "place int, `項目` string, Y1 string, Y2 string, Y3 string").coalesce(1)
    sinks.write_csv(template.sortWithinPartitions("place").drop("place"), f"{root}/template")
    listed = t.annual.select(F.col("docID").alias("doc_id"), "submitDateTime", "docDescription")
    sinks.write_marked_csv(listed, f"{root}/filings")
    items = sources.template_items(sources.read_template(t.spark, f"{root}/template"))
    wanted = sources.read_filings_list(t.spark, f"{root}/filings").select(F.col("doc_id").alias("docID"))
    table = exports.template_table(_template(t, items, t.annual.join(wanted, "docID", "left_semi")), 3)
    places = F.element_at(F.create_map(*(F.lit(x) for i, n in _ITEMS for x in (n, i))), F.col("target"))
    return table.withColumn("place", places.cast(table.schema["place"].dataType))


@query(
    "never_filled_items", "Q4 A15",
    "SELECT edinetCode AS \"edinetCode\", target AS missing_items FROM template_long WHERE target NOT IN ('株価', 'EPS（1株当たり利益）') "
    "GROUP BY 1, 2 HAVING count(value) = 0",
    "template_long",
)
def _(t):
    return exports.never_filled(_template(t))


@query(
    "template_labels", "J13",
    "SELECT edinetCode AS \"edinetCode\", slot AS \"Y\", docID AS doc_id, COALESCE(submitDateTime, '') AS \"submitDateTime\", "
    "COALESCE(docDescription, '') AS \"docDescription\" FROM template_slots",
    "template_slots",
)
def _(t):
    return exports.slot_labels(exports.template_slots(t.annual, 3))


steps.add_cte(
    "chosen_periods",
    "SELECT *, row_number() OVER (PARTITION BY edinetCode ORDER BY periodEnd) AS slot FROM (SELECT * FROM (SELECT * FROM filings WHERE periodEnd <> '' AND "
    f"docID IN (SELECT DISTINCT doc_id FROM facts) QUALIFY row_number() OVER (PARTITION BY edinetCode, periodEnd ORDER BY {steps.SUBMIT_TIME} DESC NULLS LAST, docID DESC) = 1) "
    "QUALIFY row_number() OVER (PARTITION BY edinetCode ORDER BY periodEnd DESC) <= 3)",
    "filings", "facts",
)
steps.add_cte(
    "full_long",
    "SELECT g.edinetCode, g.statement, g.item, g.slot, g.periodEnd, CAST(CAST(round_even(CASE WHEN regexp_matches(s.value, '^-?[0-9]+$') THEN CAST(s.value AS DOUBLE) END, 0) AS BIGINT) AS STRING) AS value "
    "FROM (SELECT DISTINCT c.edinetCode, i.statement, i.item, c.slot, c.periodEnd, c.docID FROM chosen_periods c JOIN (SELECT c.edinetCode, s.statement, s.item FROM statements s JOIN chosen_periods c "
    "ON c.docID = s.doc_id WHERE s.statement IN ('PL', 'BS')) i ON i.edinetCode = c.edinetCode) g LEFT JOIN statements s ON s.doc_id = g.docID AND s.statement = g.statement "
    "AND s.item = g.item AND s.period = 'CurrentYear'",
    "chosen_periods", "statements",
)


def _full(t):
    chosen = written(exports.chosen_periods(t.filings, t.facts, 3), "chosen-periods")
    docs = chosen.select(F.col("docID").alias("doc_id"))
    return exports.full_long(chosen, statements(t.facts, only=("BS", "PL"), docs=docs, few_copies=True))


@query(
    "full_export_long", "E6 U2 N24",
    "SELECT edinetCode AS edinet_code, statement, item AS \"項目\", periodEnd AS \"periodEnd\", value FROM full_long",
    "full_long",
)
def _(t):
    return exports.combined_long(_full(t))


@query(
    "full_export_wide", "E6 A17",
    "SELECT edinetCode AS edinet_code, statement, item, max(CASE WHEN slot = 1 THEN value END) AS \"Y1\", max(CASE WHEN slot = 2 THEN value END) AS \"Y2\", "
    "max(CASE WHEN slot = 3 THEN value END) AS \"Y3\" FROM full_long GROUP BY 1, 2, 3",
    "full_long",
)
def _(t):
    return exports.full_wide_slots(_full(t), 3)


@query(
    "full_export_by_period_end", "A17",
    "SELECT edinetCode AS edinet_code, statement, item, max(CASE WHEN periodEnd = '2015-03-31' THEN value END) AS \"2015-03-31\", "
    "max(CASE WHEN periodEnd = '2016-03-31' THEN value END) AS \"2016-03-31\" FROM full_long GROUP BY 1, 2, 3",
    "full_long",
)
def _(t):
    return exports.full_wide(_full(t), ["2015-03-31", "2016-03-31"])


@query(
    "full_export_all_period_ends", "A17 E6",
    "SELECT i.edinet_code, i.statement, i.item, e.\"periodEnd\", l.value FROM "
    "(SELECT DISTINCT edinetCode AS edinet_code, statement, item FROM full_long) i CROSS JOIN (SELECT DISTINCT periodEnd AS \"periodEnd\" FROM full_long) e "
    "LEFT JOIN full_long l ON l.edinetCode = i.edinet_code AND l.statement = i.statement AND l.item = i.item AND l.periodEnd = e.\"periodEnd\"",
    "full_long",
)
def _(t):
    """The wide export with a column for every period end there is, and its columns turned to rows."""
    long = written(_full(t), "full-long")
    wide = exports.full_wide(long, exports.period_ends(long))
    keys = ["edinet_code", "statement", "item"]
    return wide.unpivot(keys, [F.col(f"`{c}`") for c in wide.columns if c not in keys], "periodEnd", "value")


@query(
    "full_export_labels", "J13 E6",
    "SELECT edinetCode AS \"edinetCode\", periodEnd AS col, docID AS doc_id, periodEnd AS \"periodEnd\", submitDateTime AS \"submitDateTime\", "
    "docDescription AS \"docDescription\" FROM chosen_periods",
    "chosen_periods",
)
def _(t):
    return exports.period_labels(exports.chosen_periods(t.filings, t.facts, 3))


# --- labelled sets -------------------------------------------------------------------------

steps.add_cte(
    "earning_labels",
    f"SELECT p.edinetCode, p.prev_doc AS doc_id, p.cur_doc, p.prev_start, CAST(b.\"current\" > a.\"current\" AS INT) AS label, CAST(a.\"current\" > a.prior AS INT) AS naive_prediction FROM "
    f"(SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY edinetCode ORDER BY {steps.HASH.format('prev_doc')}, prev_doc) = 1) p "
    "JOIN profits a ON a.doc_id = p.prev_doc JOIN profits b ON b.doc_id = p.cur_doc WHERE a.\"current\" IS NOT NULL AND a.prior IS NOT NULL AND b.\"current\" IS NOT NULL "
    "AND p.prev_doc NOT IN (SELECT doc_id FROM gate)",
    "pairs", "profits", "gate",
)
steps.add_cte(
    "earning_examples",
    f"SELECT * FROM earning_labels ORDER BY {steps.HASH.format('edinetCode')}, edinetCode LIMIT 1000",
    "earning_labels",
)
_SECTIONS = "s.meta, s.summary, s.bs, s.pl, s.cf, s.text"
steps.add_cte(
    "section_rows",
    "SELECT s.*, h.edinet_code, TRY_CAST(split_part(h.start, '-', 1) AS INT) AS start_year FROM sections s JOIN (SELECT doc_id, max(CASE WHEN item = 'EDINETコード' THEN value END) AS edinet_code, "
    "max(CASE WHEN item = '当事業年度開始日' THEN value END) AS start FROM meta GROUP BY doc_id) h ON h.doc_id = s.doc_id WHERE h.edinet_code <> ''",
    "sections", "meta",
)


@query(
    "earnings_labels", "N25 N26 W11 P28 J16",
    "SELECT edinetCode AS \"edinetCode\", doc_id, cur_doc, prev_start, label, naive_prediction FROM earning_labels",
    "earning_labels",
)
def _(t):
    return labelled_sets.earnings_labels(t.filings, t.facts)


_EARNINGS = (
    f"SELECT {_SECTIONS}, e.label, e.naive_prediction, s.edinet_code, e.doc_id, s.edinet_code || '/' || e.doc_id || '.tsv' AS previous_year_file_path, "
    "s.edinet_code || '/' || e.cur_doc || '.tsv' AS current_year_file_path, CASE WHEN s.start_year < 2020 THEN 'train' ELSE 'test' END AS split "
    "FROM earning_examples e JOIN section_rows s ON s.doc_id = e.doc_id"
)


@query("earnings_set", "E9 W12 W16", _EARNINGS, "earning_examples section_rows")
def _(t):
    return labelled_sets.earnings_set(t.filings, t.facts)


@query(
    "earnings_set_balanced", "E9 W14 U4",
    f"SELECT doc_id, label, split FROM (SELECT *, row_number() OVER (PARTITION BY split, label ORDER BY {steps.HASH.format('doc_id')}, doc_id) AS place FROM ({_EARNINGS})) x "
    "WHERE place <= (SELECT min(n) FROM (SELECT split, label, count(*) AS n FROM earning_split GROUP BY split, label) y WHERE y.split = x.split)",
    "earning_examples section_rows earning_split",
)
def _(t):
    return labelled_sets.earnings_set(t.filings, t.facts, balanced=True).select("doc_id", "label", "split")


steps.add_cte("earning_split", _EARNINGS, "earning_examples", "section_rows")


@query(
    "industry_set", "E10 W10 W4 J2 J7 P19 N19",
    f"SELECT {_SECTIONS}, i.industry, s.edinet_code, i.doc_id, i.edinetCode || '/' || i.doc_id || '.tsv' AS file_path FROM industry_sample i JOIN section_rows s ON s.doc_id = i.doc_id",
    "industry_sample section_rows",
)
def _(t):
    return labelled_sets.industry_set(t.filings, t.facts, t.companies, pro_market(t))


steps.add_cte(
    "misstatement_examples",
    "SELECT p.docID AS doc_id, 1 AS label, COALESCE(j.explanation, '') AS explanation, COALESCE(j.amended_doc_id, '') AS amended_doc_id FROM positive p "
    "LEFT JOIN (SELECT * FROM judgements WHERE is_accounting_fraud) j ON j.original_doc_id = p.docID UNION ALL SELECT docID, 0, '', '' FROM negative",
    "positive", "negative", "judgements",
)


@query(
    "misstatement_examples", "E8 U3 J11 J17 W13",
    "SELECT doc_id, label, explanation, amended_doc_id FROM misstatement_examples",
    "misstatement_examples",
)
def _(t):
    return labelled_sets.misstatement_examples(t.filings, t.facts, t.judgements)


steps.add_cte(
    "shaped",
    f"SELECT {_SECTIONS}, m.label, m.explanation, s.edinet_code, m.amended_doc_id, m.doc_id, s.edinet_code || '/' || m.doc_id || '.tsv' AS file_path "
    "FROM misstatement_examples m JOIN section_rows s ON s.doc_id = m.doc_id",
    "misstatement_examples", "section_rows",
)


@query(
    "misstatement_set", "E8 W15 P29 N17",
    "SELECT shaped.*, CASE WHEN place <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM shaped JOIN "
    f"(SELECT edinet_code, row_number() OVER (ORDER BY {steps.HASH.format('edinet_code')}, edinet_code) AS place, count(*) OVER () AS n FROM (SELECT DISTINCT edinet_code FROM shaped)) USING (edinet_code)",
    "shaped",
)
def _(t):
    return labelled_sets.misstatement_set(t.filings, t.facts, t.judgements)


# --- filing index --------------------------------------------------------------------------


@query(
    "filing_index", "E11 S5 P13 P14",
    f"SELECT docID AS \"docID\", edinetCode AS \"edinetCode\", {steps.REPORT_TYPE} AS doc_type FROM filings WHERE {steps.REPORT_TYPE} = 'semiannual' AND withdrawalStatus <> '1' "
    "AND TRY_CAST(substr(submitDateTime, 1, 10) AS DATE) BETWEEN DATE '2013-01-01' AND DATE '2018-12-31'",
    "filings",
)
def _(t):
    inside = filing_index.submitted_between(t.filings, "2013-01-01", "2018-12-31")
    return filing_index.wanted_filings(inside, "semiannual").select("docID", "edinetCode", "doc_type")


# --- corpus audit --------------------------------------------------------------------------

_CATEGORY = "SELECT '{0}' AS kind, {0} AS name, count(*) AS n FROM companies WHERE entity_id IN (SELECT edinetCode FROM filings) GROUP BY {0}"


@query(
    "corpus_audit", "E12 A4 A6 A7",
    "SELECT 'companies' AS kind, CASE WHEN file_count >= 10 THEN 'complete' ELSE 'incomplete' END AS name, count(*) AS n FROM counted GROUP BY 2 UNION ALL "
    "SELECT 'fiscal_start_year', CAST(year AS VARCHAR), count(*) FROM start_years GROUP BY 2 UNION ALL "
    + " UNION ALL ".join(_CATEGORY.format(c) for c in ("listing", "consolidated", "entity_type", "industry")),
    "counted start_years companies",
)
def _(t):
    return corpus_audit.corpus_audit(t.filings, t.facts, t.companies)


def _tagged(kind: str, name: str, n: str = "count(*)", first: str = "NULL", last: str = "NULL", of: str = "per_company", by: str = "GROUP BY 2") -> str:
    days = f"CAST({first} AS VARCHAR) AS first_day, CAST({last} AS VARCHAR) AS last_day"
    return f"SELECT '{kind}' AS kind, {name} AS name, CAST({n} AS BIGINT) AS n, {days} FROM {of} {by}"


_START, _END = "TRY_CAST(periodStart AS DATE)", "TRY_CAST(periodEnd AS DATE)"
_SUBMIT = "CAST(try_strptime(submitDateTime, '%Y-%m-%d %H:%M') AS DATE)"
steps.add_cte("per_company", "SELECT edinetCode AS entity_id, count(*) AS n_filings FROM filings WHERE edinetCode IS NOT NULL GROUP BY edinetCode", "filings")


@query(
    "corpus_audit_whole", "E12 A4 A5 A6 A7 A8 A9",
    " UNION ALL ".join([
        _tagged("companies", "CASE WHEN n_filings >= 10 THEN 'complete' ELSE 'incomplete' END"),
        *(_tagged(c, c, of="companies JOIN per_company USING (entity_id)") for c in ("listing", "consolidated", "entity_type", "industry")),
        _tagged("filings_of_company", "entity_id", "max(n_filings)"),
        _tagged("period", "NULL", first=f"min({_START})", last=f"max({_END})", of="filings", by=""),
        _tagged("submitted", "NULL", first=f"min({_SUBMIT})", last=f"max({_SUBMIT})", of="filings", by=""),
        _tagged("fiscal_start_year", "CAST(year AS VARCHAR)", of="start_years"),
    ]),
    "per_company start_years companies",
)
def _(t):
    return corpus_audit.whole_audit(t.filings, t.facts, t.companies)
