"""Queries on filings: classification, choice per company and period, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from kessan.functions import filters
from kessan.functions.dates import day, fiscal_year, one_year_later, submit_time
from kessan.operators import audit, joins, sampling, select
from kessan.plans import accruals, filing_index, labelled_sets
from kessan.queries import steps
from kessan.queries.registry import query
from kessan.session import scratch_path
from kessan.sources import lake

_ID = "edinetCode AS \"edinetCode\", docID AS \"docID\""


@query(
    "report_types", "P13",
    f"SELECT {steps.REPORT_TYPE} AS doc_type, formCode AS \"formCode\", count(*) AS n FROM filings GROUP BY 1, 2",
    "filings",
)
def _(t):
    return filing_index.with_type(t.filings).groupBy("doc_type", "formCode").agg(F.count("*").alias("n"))


@query(
    "wanted_filings", "P14 E11",
    f"SELECT {_ID} FROM filings WHERE formCode = '030000' AND withdrawalStatus <> '1'",
    "filings",
)
def _(t):
    return filing_index.wanted_filings(t.filings).select("edinetCode", "docID")


@query("filings_of_company", "P15", f"SELECT {_ID} FROM filings WHERE edinetCode = 'E77'", "filings")
def _(t):
    return filing_index.of_company(t.filings, "E77").select("edinetCode", "docID")


_PLAIN = (
    "formCode = '030000' AND (docDescription IS NULL OR (contains(docDescription, '有価証券報告書') AND NOT contains(docDescription, '訂正')))"
)


@query("plain_annual_reports", "P16", f"SELECT {_ID} FROM filings WHERE {_PLAIN}", "filings")
def _(t):
    hit = filters.is_plain_annual(F.col("ordinanceCode"), F.col("formCode"), F.col("docDescription"))
    return t.filings.filter(hit).select("edinetCode", "docID")


steps.add_cte(
    "headers",
    "SELECT v.doc_id, e.entity_id, e.entity_id || '/' || v.doc_id || '.tsv' AS path, v.standard, "
    "TRY_CAST(nullif(regexp_extract(v.start_date, '^([0-9]{4})[-/][0-9]{2}[-/][0-9]{2}', 1), '') AS INT) AS fiscal_year, v.period_end, v.submit_text, "
    "COALESCE(contains(v.standard, 'Japan GAAP'), true) AND NOT v.uses_other AS accepted, CASE WHEN v.uses_other THEN COALESCE(nullif(v.standard, ''), 'IFRS/US-GAAP') "
    "ELSE COALESCE(nullif(v.standard, ''), 'Unknown') END AS standard_reason FROM (SELECT doc_id, "
    "arg_max_null(value, src_ord) FILTER (element = 'jpdei_cor:CurrentFiscalYearStartDateDEI') AS start_date, "
    "arg_max_null(value, src_ord) FILTER (element = 'jpdei_cor:CurrentFiscalYearEndDateDEI') AS period_end, "
    "arg_max_null(value, src_ord) FILTER (element = 'jpdei_cor:AccountingStandardsDEI') AS standard, "
    "COALESCE(nullif(arg_max_null(value, src_ord) FILTER (element = 'jpdei_cor:FilingDateDEI'), ''), "
    "nullif(arg_max_null(value, src_ord) FILTER (element = 'jpcrp_cor:FilingDateCoverPage'), '')) AS submit_text, "
    "bool_or(regexp_matches(lower(element), 'ifrs-full:|us-gaap:')) AS uses_other FROM facts GROUP BY doc_id) v JOIN entities e ON e.doc_id = v.doc_id",
    "facts", "entities",
)


@query(
    "filing_headers", "P21 N8 N16 D13 A19",
    "SELECT doc_id, entity_id, path, standard, fiscal_year, period_end, submit_text, accepted, standard_reason FROM headers",
    "headers",
)
def _(t):
    return accruals.filing_headers(t.facts, t.entities)


@query(
    "filings_in_fiscal_years", "P20",
    "SELECT doc_id, fiscal_year FROM headers WHERE fiscal_year BETWEEN 2015 AND 2024",
    "headers",
)
def _(t):
    headers = accruals.filing_headers(t.facts, t.entities).select("doc_id", "fiscal_year")
    return headers.filter(filters.in_fiscal_years(F.col("fiscal_year"), 2015, 2024))


@query(
    "standard_gate", "P21",
    "SELECT accepted, standard_reason, count(*) AS n FROM headers GROUP BY 1, 2",
    "headers",
)
def _(t):
    headers = accruals.filing_headers(t.facts, t.entities)
    return headers.groupBy("accepted", "standard_reason").agg(F.count("*").alias("n"))


steps.add_cte(
    "latest",
    f"SELECT * FROM filings WHERE periodEnd <> '' QUALIFY row_number() OVER (PARTITION BY edinetCode, periodEnd "
    f"ORDER BY {steps.SUBMIT_TIME} DESC NULLS LAST, docID DESC) = 1",
    "filings",
)


@query(
    "latest_per_period", "W1 N10",
    f"SELECT {_ID}, periodEnd AS \"periodEnd\", submitDateTime AS \"submitDateTime\", docDescription AS \"docDescription\" FROM latest",
    "latest",
)
def _(t):
    return select.latest_per_period(t.filings)


steps.add_cte(
    "best_year",
    "SELECT * FROM headers WHERE accepted QUALIFY row_number() OVER (PARTITION BY entity_id, fiscal_year "
    "ORDER BY COALESCE(submit_text, '') DESC, path DESC) = 1",
    "headers",
)


@query(
    "best_filing_per_year", "W2",
    "SELECT entity_id, fiscal_year, doc_id, submit_text FROM best_year",
    "best_year",
)
def _(t):
    headers = accruals.filing_headers(t.facts, t.entities).filter("accepted")
    return select.best_per_year(headers).select("entity_id", "fiscal_year", "doc_id", "submit_text")


@query(
    "duplicate_filings", "Q2 W2",
    "SELECT h.entity_id AS edinet_code, h.fiscal_year, b.doc_id || '.tsv' AS chosen_tsv, b.submit_text AS chosen_submit_datetime, "
    "h.doc_id || '.tsv' AS skipped_tsv, 'duplicate_skipped: newer submit_datetime or filename chosen' AS skipped_reason "
    "FROM headers h JOIN best_year b ON h.entity_id = b.entity_id AND h.fiscal_year = b.fiscal_year WHERE h.accepted AND h.doc_id <> b.doc_id",
    "best_year",
)
def _(t):
    headers = accruals.filing_headers(t.facts, t.entities).filter("accepted")
    return select.duplicate_log(headers, select.best_per_year(headers))


steps.add_cte(
    "last_three",
    "SELECT *, row_number() OVER (PARTITION BY edinetCode ORDER BY periodEnd) AS slot FROM (SELECT * FROM latest "
    "QUALIFY row_number() OVER (PARTITION BY edinetCode ORDER BY periodEnd DESC) <= 3)",
    "latest",
)


@query(
    "last_three_periods", "W3",
    f"SELECT {_ID}, periodEnd AS \"periodEnd\", slot FROM last_three",
    "last_three",
)
def _(t):
    chosen = select.last_periods(select.latest_per_period(t.filings), 3)
    return chosen.select("edinetCode", "docID", "periodEnd", "slot")


@query(
    "all_periods", "W3",
    f"SELECT {_ID}, periodEnd AS \"periodEnd\", row_number() OVER (PARTITION BY edinetCode ORDER BY periodEnd) AS slot FROM latest",
    "latest",
)
def _(t):
    chosen = select.last_periods(select.latest_per_period(t.filings), 0)
    return chosen.select("edinetCode", "docID", "periodEnd", "slot")


steps.add_cte(
    "newest",
    "SELECT * FROM filings QUALIFY row_number() OVER (PARTITION BY edinetCode ORDER BY periodStart DESC, docID DESC) = 1",
    "filings",
)


@query("latest_filing_per_company", "W4", f"SELECT {_ID}, periodStart AS \"periodStart\" FROM newest", "newest")
def _(t):
    return select.latest_filing(t.filings).select("edinetCode", "docID", "periodStart")


_PAIR = (
    "SELECT edinetCode, docID AS prev_doc, periodStart AS prev_start, periodEnd AS prev_end, lead(docID) OVER w AS cur_doc, "
    "lead(periodStart) OVER w AS cur_start, lead(periodEnd) OVER w AS cur_end FROM {0} WINDOW w AS (PARTITION BY edinetCode ORDER BY periodStart, docID)"
)
_SHIFT = (
    "TRY_CAST({1} AS DATE) IS NOT NULL AND year(TRY_CAST({0} AS DATE)) + 1 = year(TRY_CAST({1} AS DATE)) AND "
    "month(TRY_CAST({0} AS DATE)) = month(TRY_CAST({1} AS DATE)) AND day(TRY_CAST({0} AS DATE)) = day(TRY_CAST({1} AS DATE))"
)
_PAIR_COLUMNS = "edinetCode AS \"edinetCode\", prev_doc, prev_start, prev_end, cur_doc, cur_start, cur_end"
steps.add_cte("neighbours", f"SELECT * FROM ({_PAIR.format('filings')}) WHERE cur_doc IS NOT NULL", "filings")
steps.add_cte(
    "pairs",
    f"SELECT * FROM neighbours WHERE {_SHIFT.format('prev_start', 'cur_start')} AND {_SHIFT.format('prev_end', 'cur_end')}",
    "neighbours",
)


@query("adjacent_filings", "W5", f"SELECT {_PAIR_COLUMNS} FROM neighbours", "neighbours")
def _(t):
    return select.adjacent_filings(t.filings)


@query("year_to_year_pairs", "P28 N9 W5", f"SELECT {_PAIR_COLUMNS} FROM pairs", "pairs")
def _(t):
    return select.year_pairs(t.filings)


@query(
    "year_shift_test", "N9",
    f"SELECT edinetCode AS \"edinetCode\", prev_doc, cur_doc, COALESCE({_SHIFT.format('prev_start', 'cur_start')}, false) AS shifted FROM neighbours",
    "neighbours",
)
def _(t):
    pairs = select.adjacent_filings(t.filings)
    shifted = F.coalesce(one_year_later(day(F.col("prev_start")), day(F.col("cur_start"))), F.lit(False))
    return pairs.select("edinetCode", "prev_doc", "cur_doc", shifted.alias("shifted"))


@query(
    "latest_three_filings", "W6 N28",
    f"SELECT {_ID}, row_number() OVER (PARTITION BY edinetCode ORDER BY COALESCE(submitDateTime, '') DESC, docID DESC) AS rank FROM filings "
    "WHERE formCode = '030000' QUALIFY rank <= 3",
    "filings",
)
def _(t):
    return select.latest_filings(t.annual, 3).select("edinetCode", "docID", "rank")


@query(
    "yearly_filings", "W7 P16",
    f"SELECT edinetCode AS \"edinetCode\", docID AS \"docID\", year, row_number() OVER (PARTITION BY edinetCode ORDER BY year DESC) AS rank FROM "
    f"(SELECT *, year({steps.SUBMIT_TIME}) AS year, month({steps.SUBMIT_TIME}) AS m FROM filings WHERE {_PLAIN} AND month({steps.SUBMIT_TIME}) BETWEEN 4 AND 8 "
    "QUALIFY row_number() OVER (PARTITION BY edinetCode, year ORDER BY m BETWEEN 5 AND 7 DESC, submitDateTime DESC, docID DESC) = 1) QUALIFY rank <= 5",
    "filings",
)
def _(t):
    return select.yearly_filings(t.filings).select("edinetCode", "docID", "year", "rank")


@query(
    "first_annual_in_range", "W17",
    f"SELECT {_ID}, submitDateTime AS \"submitDateTime\" FROM filings WHERE edinetCode = 'E77' AND {steps.REPORT_TYPE} = 'annual' AND "
    "TRY_CAST(substr(submitDateTime, 1, 10) AS DATE) BETWEEN DATE '2012-01-01' AND DATE '2019-12-31' ORDER BY submitDateTime, docID LIMIT 1",
    "filings",
)
def _(t):
    hit = select.first_filing(t.filings, "E77", "annual", "2012-01-01", "2019-12-31")
    return hit.select("edinetCode", "docID", "submitDateTime")


@query(
    "oldest_and_newest", "W18",
    f"SELECT {_ID} FROM filings QUALIFY row_number() OVER (PARTITION BY edinetCode ORDER BY docID) <= 3 OR "
    "row_number() OVER (PARTITION BY edinetCode ORDER BY docID DESC) <= 2",
    "filings",
)
def _(t):
    return select.oldest_and_newest(t.filings)


@query(
    "submit_times", "N10",
    f"SELECT docID AS \"docID\", strftime({steps.SUBMIT_TIME}, '%Y-%m-%d %H:%M:%S') AS submitted FROM filings",
    "filings",
)
def _(t):
    time = submit_time(F.col("submitDateTime"))
    return t.filings.select("docID", F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias("submitted"))


@query(
    "fiscal_years", "N8",
    "SELECT docID AS \"docID\", TRY_CAST(nullif(regexp_extract(periodStart, '^([0-9]{4})[-/][0-9]{2}[-/][0-9]{2}', 1), '') AS INT) AS dashed, "
    "TRY_CAST(nullif(regexp_extract(replace(periodEnd, '-', '/'), '^([0-9]{4})[-/][0-9]{2}[-/][0-9]{2}', 1), '') AS INT) AS slashed FROM filings",
    "filings",
)
def _(t):
    slashed = F.translate("periodEnd", "-", "/")
    return t.filings.select(
        "docID", fiscal_year(F.col("periodStart")).alias("dashed"), fiscal_year(slashed).alias("slashed")
    )


@query(
    "filings_with_facts", "J5",
    f"SELECT {_ID} FROM filings WHERE docID IN (SELECT doc_id FROM line_facts)",
    "filings line_facts",
)
def _(t):
    return joins.with_facts(t.filings, t.landed_lines).select("edinetCode", "docID")


@query(
    "pairs_with_facts", "J5",
    "SELECT prev_doc, cur_doc FROM pairs WHERE prev_doc IN (SELECT DISTINCT doc_id FROM line_facts) AND cur_doc IN (SELECT DISTINCT doc_id FROM line_facts)",
    "pairs line_facts",
)
def _(t):
    return joins.pairs_with_facts(select.year_pairs(t.filings), t.landed_lines).select("prev_doc", "cur_doc")


@query(
    "manifest_agrees_with_facts", "J5 J15 S11",
    "SELECT f.docID AS doc_id, count(*) AS n_rows, true AS same FROM filings f JOIN line_facts l ON l.doc_id = f.docID GROUP BY f.docID",
    "filings line_facts",
)
def _(t):
    """The landed filings by the manifest, beside a count over the facts themselves."""
    told = joins.with_facts(t.filings, t.landed_lines).select(F.col("docID").alias("doc_id"))
    counted = t.line_facts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("counted"))
    both = told.join(t.landed_lines, "doc_id").join(counted, "doc_id", "full")
    return both.select("doc_id", "n_rows", F.col("n_rows").eqNullSafe(F.col("counted")).alias("same"))


@query(
    "headers_from_side_table", "P7 P21 A19",
    "SELECT doc_id, arg_max_null(value, src_ord) FILTER (element = 'jpdei_cor:AccountingStandardsDEI') AS standard, "
    "arg_max_null(value, src_ord) FILTER (element = 'jpdei_cor:CurrentFiscalYearStartDateDEI') AS year_start, "
    "bool_or(regexp_matches(lower(element), 'ifrs-full:|us-gaap:')) AS uses_other FROM header_facts GROUP BY doc_id",
    "header_facts",
)
def _(t):
    """The header side table as two landed batches leave it, of even and of odd filings."""
    root = scratch_path(t.spark, "lake")
    facts = t.header_facts.withColumn("entity_id", F.lit(None).cast("string"))
    for batch in (0, 1):
        lake.land_batch(facts.filter(F.expr(f"CAST(substr(doc_id, 2) AS BIGINT) % 2 = {batch}")), root, batch)
    return lake.read_headers(t.spark, root).select("doc_id", "standard", "year_start", "uses_other")


@query(
    "filings_not_landed", "J15 E11",
    f"SELECT {_ID} FROM filings WHERE formCode = '030000' AND withdrawalStatus <> '1' AND docID NOT IN (SELECT doc_id FROM text_facts)",
    "filings text_facts",
)
def _(t):
    landed = t.text_facts.select("doc_id").distinct()
    return filing_index.wanted_filings(t.filings, landed=landed).select("edinetCode", "docID")


@query(
    "fraud_filings", "J17 P27",
    f"SELECT {_ID} FROM filings WHERE docID IN (SELECT original_doc_id FROM judgements WHERE is_accounting_fraud)",
    "filings judgements",
)
def _(t):
    return labelled_sets.fraud_filings(t.filings, t.judgements).select("edinetCode", "docID")


@query(
    "fraud_judgements", "P27",
    "SELECT amended_doc_id, original_doc_id, company_name FROM judgements WHERE is_accounting_fraud",
    "judgements",
)
def _(t):
    return t.judgements.filter("is_accounting_fraud").select("amended_doc_id", "original_doc_id", "company_name")


@query(
    "explanations_of_filings", "J11",
    "SELECT f.docID AS \"docID\", COALESCE(j.explanation, '') AS explanation, COALESCE(j.amended_doc_id, '') AS amended_doc_id FROM filings f "
    "LEFT JOIN (SELECT * FROM judgements WHERE is_accounting_fraud) j ON j.original_doc_id = f.docID",
    "filings judgements",
)
def _(t):
    found = joins.explanations(t.judgements).withColumnRenamed("doc_id", "docID")
    joined = t.filings.select("docID").join(found, "docID", "left")
    return joined.select(
        "docID", F.coalesce("explanation", F.lit("")).alias("explanation"),
        F.coalesce("amended_doc_id", F.lit("")).alias("amended_doc_id"),
    )


@query(
    "profits_of_pairs", "J16",
    "SELECT p.prev_doc, p.cur_doc, CAST(a.prior AS BIGINT) AS two_before, CAST(a.\"current\" AS BIGINT) AS one_before, CAST(b.\"current\" AS BIGINT) AS now "
    "FROM pairs p JOIN profits a ON a.doc_id = p.prev_doc JOIN profits b ON b.doc_id = p.cur_doc",
    "pairs profits",
)
def _(t):
    figures = labelled_sets.profits(t.facts)
    before = figures.select(F.col("doc_id").alias("prev_doc"), F.col("prior").cast("bigint").alias("two_before"), F.col("current").cast("bigint").alias("one_before"))
    after = figures.select(F.col("doc_id").alias("cur_doc"), F.col("current").cast("bigint").alias("now"))
    pairs = select.year_pairs(t.filings).select("prev_doc", "cur_doc")
    return pairs.join(before, "prev_doc").join(after, "cur_doc")


@query(
    "date_ranges", "A9",
    "SELECT count(*) AS n_filings, CAST(min(TRY_CAST(periodStart AS DATE)) AS VARCHAR) AS first_period_start, "
    "CAST(max(TRY_CAST(periodEnd AS DATE)) AS VARCHAR) AS last_period_end, "
    "CAST(CAST(min(try_strptime(submitDateTime, '%Y-%m-%d %H:%M')) AS DATE) AS VARCHAR) AS first_submit, "
    "CAST(CAST(max(try_strptime(submitDateTime, '%Y-%m-%d %H:%M')) AS DATE) AS VARCHAR) AS last_submit FROM filings",
    "filings",
)
def _(t):
    row = audit.date_ranges(t.filings)
    return row.select("n_filings", *(F.col(c).cast("string").alias(c) for c in row.columns[1:]))


@query(
    "document_texts", "A8",
    "SELECT edinetCode AS entity_id, chunk, max(n) AS tsv_count, string_agg(docID, ',' ORDER BY docID) AS doc_ids FROM (SELECT edinetCode, docID, "
    "(row_number() OVER (PARTITION BY edinetCode ORDER BY docID) - 1) // 4 AS chunk, count(*) OVER (PARTITION BY edinetCode) AS n FROM filings) GROUP BY edinetCode, chunk",
    "filings",
)
def _(t):
    """Four ids to a row, so that companies of the given tables need several."""
    return audit.document_texts(t.entities, chunk=4)


@query(
    "document_lists", "A8 S11",
    "SELECT edinetCode AS entity_id, row_number() OVER (PARTITION BY edinetCode ORDER BY docID) AS place, docID AS doc_id, "
    "count(*) OVER (PARTITION BY edinetCode) AS tsv_count FROM filings",
    "filings",
)
def _(t):
    return audit.document_lists(t.entities)


@query(
    "filings_per_day", "N23",
    "SELECT CAST(CAST(d.day AS DATE) AS VARCHAR) AS day, count(f.docID) AS n FROM (SELECT unnest(generate_series(DATE '2012-01-01', DATE '2020-12-31', INTERVAL 1 DAY)) AS day) d "
    "LEFT JOIN filings f ON TRY_CAST(substr(f.submitDateTime, 1, 10) AS DATE) = d.day GROUP BY d.day",
    "filings",
)
def _(t):
    calendar = filing_index.days(t.spark, "2012-01-01", "2020-12-31")
    counts = filing_index.filings_per_day(t.filings, calendar)
    return counts.select(F.col("day").cast("string").alias("day"), "n")


@query(
    "filings_per_month_window", "N23",
    "SELECT CAST(greatest(m.month, DATE '2012-02-10') AS VARCHAR) AS first_day, count(f.docID) AS n FROM (SELECT CAST(unnest(generate_series(DATE '2012-02-01', DATE '2014-11-01', INTERVAL 1 MONTH)) AS DATE) AS month) m "
    "LEFT JOIN filings f ON date_trunc('month', TRY_CAST(substr(f.submitDateTime, 1, 10) AS DATE)) = m.month AND "
    "TRY_CAST(substr(f.submitDateTime, 1, 10) AS DATE) BETWEEN greatest(m.month, DATE '2012-02-10') AND least(last_day(m.month), DATE '2014-11-20') GROUP BY m.month",
    "filings",
)
def _(t):
    windows = filing_index.month_windows(t.spark, "2012-02-10", "2014-11-20").withColumn("month", F.trunc("first_day", "month"))
    inside = filing_index.submitted_between(t.filings, "2012-02-10", "2014-11-20")
    month = F.trunc(day(F.substring("submitDateTime", 1, 10)), "month")
    counts = inside.groupBy(month.alias("month")).agg(F.count("*").alias("n"))
    joined = windows.join(counts, "month", "left")
    return joined.select(F.col("first_day").cast("string").alias("first_day"), F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "one_pair_per_company", "W11",
    f"SELECT edinetCode AS \"edinetCode\", prev_doc, cur_doc FROM pairs QUALIFY row_number() OVER (PARTITION BY edinetCode ORDER BY {steps.HASH.format('prev_doc')}, prev_doc) = 1",
    "pairs",
)
def _(t):
    chosen = labelled_sets.random_pair_per_company(select.year_pairs(t.filings))
    return chosen.select("edinetCode", "prev_doc", "cur_doc")


@query(
    "companies_in_random_order", "W12",
    f"SELECT entity_id, name FROM companies ORDER BY {steps.HASH.format('entity_id')}, entity_id LIMIT 500",
    "companies",
)
def _(t):
    return sampling.take(t.companies, "entity_id", 500).select("entity_id", "name")


steps.add_cte(
    "positive",
    "SELECT docID, edinetCode FROM filings WHERE docID IN (SELECT original_doc_id FROM judgements WHERE is_accounting_fraud)",
    "filings", "judgements",
)
steps.add_cte(
    "negative",
    f"SELECT docID, edinetCode FROM filings WHERE edinetCode IN (SELECT edinetCode FROM (SELECT DISTINCT edinetCode FROM filings ORDER BY "
    f"{steps.HASH.format('edinetCode')}, edinetCode LIMIT 1400) WHERE edinetCode NOT IN (SELECT edinetCode FROM positive) ORDER BY {steps.HASH.format('edinetCode')}, edinetCode LIMIT 700) "
    f"QUALIFY row_number() OVER (PARTITION BY edinetCode ORDER BY {steps.HASH.format('docID')}, docID) = 1",
    "filings", "positive",
)


@query("other_filings_sample", "W13 J6", "SELECT edinetCode AS \"edinetCode\", docID AS \"docID\" FROM negative", "negative")
def _(t):
    docs = labelled_sets.fraud_filings(t.filings, t.judgements).select(F.col("docID").alias("doc_id"))
    codes = labelled_sets.fraud_entities(t.header_facts, docs)
    sample = labelled_sets.other_filings(t.filings, codes)
    return sample.select("edinetCode", "docID")


steps.add_cte(
    "labelled",
    "SELECT docID, edinetCode, CASE WHEN formCode = '030000' THEN 1 ELSE 0 END AS label, TRY_CAST(split_part(periodStart, '-', 1) AS INT) AS year FROM filings",
    "filings",
)


def _labelled(t):
    return t.filings.select(
        "docID", "edinetCode", F.when(F.col("formCode") == "030000", 1).otherwise(0).alias("label"),
        F.get(F.split("periodStart", "-"), F.lit(0)).try_cast("int").alias("year"),
    )


@query(
    "balanced_classes", "W14 U4 A20",
    f"SELECT docID AS \"docID\", label FROM labelled QUALIFY row_number() OVER (PARTITION BY label ORDER BY {steps.HASH.format('docID')}, docID) <= "
    "(SELECT min(n) FROM (SELECT count(*) AS n FROM labelled GROUP BY label))",
    "labelled",
)
def _(t):
    return sampling.balance(_labelled(t), "label", "docID").select("docID", "label")


@query("class_counts", "A20", "SELECT label, count(*) AS n FROM labelled GROUP BY label", "labelled")
def _(t):
    return _labelled(t).groupBy("label").agg(F.count("*").alias("n"))


@query(
    "split_by_company", "W15",
    f"SELECT docID AS \"docID\", edinetCode AS \"edinetCode\", CASE WHEN place <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM labelled JOIN "
    f"(SELECT edinetCode, row_number() OVER (ORDER BY {steps.HASH.format('edinetCode')}, edinetCode) AS place, count(*) OVER () AS n FROM (SELECT DISTINCT edinetCode FROM labelled)) USING (edinetCode)",
    "labelled",
)
def _(t):
    return sampling.split_by_group(_labelled(t), "edinetCode").select("docID", "edinetCode", "split")


@query(
    "split_by_year", "W16",
    "SELECT docID AS \"docID\", CASE WHEN year < 2020 THEN 'train' ELSE 'test' END AS split FROM labelled",
    "labelled",
)
def _(t):
    return sampling.split_by_year(_labelled(t), F.col("year")).select("docID", "split")
