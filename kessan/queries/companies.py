"""Queries on companies."""

from __future__ import annotations

from pyspark.sql import functions as F

from kessan.functions.text import listing_code, ticker
from kessan.operators import audit, companies, joins, sampling
from kessan.plans import labelled_sets, targets
from kessan.queries import steps
from kessan.queries.registry import query


@query(
    "company_search", "P9",
    "SELECT name, entity_id, industry FROM companies WHERE regexp_matches(name, '#0+[0-9]*7[0-9]$')",
    "companies",
)
def _(t):
    return companies.search(t.companies, "#0+[0-9]*7[0-9]$")


@query(
    "company_code", "P10",
    "SELECT entity_id FROM companies WHERE name = 'Customer#000000077' ORDER BY entity_id LIMIT 1",
    "companies",
)
def _(t):
    return companies.entity_code(t.companies, "Customer#000000077")


@query(
    "security_codes", "N19",
    "SELECT entity_id, CASE WHEN length(sec_code) >= 4 THEN substr(sec_code, 1, 4) END AS code, "
    "CASE WHEN length(sec_code) > 0 THEN substr(sec_code, 1, length(sec_code) - 1) END AS ticker FROM companies",
    "companies",
)
def _(t):
    return t.companies.select(
        "entity_id", listing_code(F.col("sec_code")).alias("code"), ticker(F.col("sec_code")).alias("ticker")
    )


@query(
    "filings_with_company", "J2",
    "SELECT f.docID AS \"docID\", c.name, c.industry FROM filings f JOIN companies c ON f.edinetCode = c.entity_id WHERE c.listing = '上場'",
    "filings companies",
)
def _(t):
    return joins.with_company(t.filings, t.companies.filter("listing = '上場'")).select("docID", "name", "industry")


@query(
    "companies_on_exchange", "J3",
    "SELECT c.entity_id, l.name AS listed_name, l.market FROM companies c LEFT JOIN listing l ON l.code = CASE WHEN length(c.sec_code) >= 4 THEN substr(c.sec_code, 1, 4) END",
    "companies listing",
)
def _(t):
    keyed = t.companies.select("entity_id", listing_code(F.col("sec_code")).alias("code"))
    entry = t.listing.select("code", F.col("name").alias("listed_name"), "market")
    return keyed.join(entry, "code", "left").select("entity_id", "listed_name", "market")


@query(
    "companies_in_corpus", "J4 A4",
    "SELECT 'listing' AS \"column\", listing AS value, count(*) AS n FROM companies WHERE entity_id IN (SELECT edinetCode FROM annual) GROUP BY listing UNION ALL "
    "SELECT 'consolidated', consolidated, count(*) FROM companies WHERE entity_id IN (SELECT edinetCode FROM annual) GROUP BY consolidated UNION ALL "
    "SELECT 'entity_type', entity_type, count(*) FROM companies WHERE entity_id IN (SELECT edinetCode FROM annual) GROUP BY entity_type UNION ALL "
    "SELECT 'industry', industry, count(*) FROM companies WHERE entity_id IN (SELECT edinetCode FROM annual) GROUP BY industry",
    "companies annual",
)
def _(t):
    filed = t.annual.select(F.col("edinetCode").alias("entity_id"))
    inside = t.companies.join(filed, "entity_id", "left_semi")
    return audit.value_counts(inside, "listing", "consolidated", "entity_type", "industry")


_GROUPS = steps.values(list(companies.INDUSTRY_GROUPS.items()), "industry", "industry_group")
_NAMES = steps.values(list(companies.GROUP_NAMES_EN.items()), "industry_group", "group_name")


@query(
    "industry_groups", "P19",
    f"SELECT c.entity_id, COALESCE(g.industry_group, 'invalid') AS industry_group FROM companies c LEFT JOIN ({_GROUPS}) g ON c.industry = g.industry",
    "companies",
)
def _(t):
    grouped = companies.recode(t.companies, "industry", companies.INDUSTRY_GROUPS, companies.INVALID, "industry_group")
    return grouped.select("entity_id", "industry_group")


@query(
    "industry_histogram", "A5 P19 O3",
    f"SELECT COALESCE(n.group_name, 'その他') AS group_name, count(*) AS n FROM companies c JOIN ({_GROUPS}) g ON c.industry = g.industry "
    f"LEFT JOIN ({_NAMES}) n ON n.industry_group = g.industry_group GROUP BY 1",
    "companies",
)
def _(t):
    return companies.industry_histogram(t.companies)


steps.add_cte(
    "counted",
    "SELECT edinetCode AS edinet_code, COALESCE(arg_max_null(filerName, (COALESCE(submitDateTime, ''), docID)), 'Unknown') AS company_name, "
    "count(*) AS file_count, arg_max_null(secCode, (COALESCE(submitDateTime, ''), docID)) AS sec FROM filings GROUP BY edinetCode",
    "filings",
)


@query(
    "complete_companies", "A7 O3",
    "SELECT edinet_code, company_name, file_count FROM counted WHERE file_count >= 10",
    "counted",
)
def _(t):
    return companies.complete(companies.filings_per_company(t.filings)).orderBy("edinet_code")


@query(
    "incomplete_companies", "A7",
    "SELECT edinet_code, company_name, file_count FROM counted WHERE file_count < 10",
    "counted",
)
def _(t):
    return companies.incomplete(companies.filings_per_company(t.filings)).orderBy("edinet_code")


_REASON = (
    "CASE WHEN COALESCE(c.sec_code, '') = '' THEN 'No SecCode (Unlisted?)' WHEN l.code IS NULL THEN 'Not in Tosho List' "
    "WHEN l.industry IN ('銀行業', '保険業', '証券、商品先物取引業', 'その他金融業', '-') THEN 'Industry: ' || l.industry "
    "WHEN l.market IN ('ETF・ETN', 'PRO Market', 'REIT・ベンチャーファンド', '出資証券') THEN 'Market: ' || l.market "
    "WHEN contains(l.market, 'ETF') OR contains(l.market, 'ETN') OR contains(l.market, 'REIT') THEN 'Market Keyword: ' || l.market END"
)
steps.add_cte(
    "judged",
    f"SELECT c.edinet_code, COALESCE(c.sec_code, '') AS sec_code, COALESCE(l.name, c.company_name, 'Unknown') AS company_name, "
    f"COALESCE(l.industry, '-') AS industry, COALESCE(l.market, '-') AS market, c.file_count, {_REASON} AS reason FROM "
    "(SELECT *, CASE WHEN length(sec) >= 4 THEN substr(sec, 1, 4) END AS sec_code FROM counted WHERE file_count >= 10) c LEFT JOIN listing l ON l.code = c.sec_code",
    "counted", "listing",
)


@query(
    "companies_judged", "P17 J3",
    "SELECT edinet_code, sec_code, company_name, industry, market, file_count, reason FROM judged",
    "judged",
)
def _(t):
    return targets.judged_companies(t.filings, t.listing)


@query(
    "target_companies", "E7 P17",
    "SELECT edinet_code, sec_code, company_name, industry, market, file_count FROM judged WHERE reason IS NULL",
    "judged",
)
def _(t):
    return targets.targets(targets.judged_companies(t.filings, t.listing))


@query(
    "excluded_companies", "Q5 P17",
    "SELECT edinet_code, sec_code, company_name, industry, market, reason FROM judged WHERE reason IS NOT NULL",
    "judged",
)
def _(t):
    return targets.excluded(targets.judged_companies(t.filings, t.listing))


@query(
    "companies_by_industry_switch", "P18",
    "SELECT 'all' AS kind, count(*) AS n FROM companies UNION ALL SELECT 'without', count(*) FROM companies WHERE industry NOT IN ('建設業', '機械')",
    "companies",
)
def _(t):
    return audit.run_counters(
        all=companies.without_industries(t.companies),
        without=companies.without_industries(t.companies, ("建設業", "機械")),
    )


@query(
    "companies_without_fraud", "J6",
    "SELECT DISTINCT edinetCode AS \"edinetCode\" FROM filings WHERE edinetCode NOT IN (SELECT edinetCode FROM positive)",
    "filings positive",
)
def _(t):
    fraud = labelled_sets.fraud_filings(t.filings, t.judgements)
    return companies.without_fraud(t.filings.select("edinetCode").distinct(), fraud)


@query(
    "companies_without_tickers", "J7",
    "SELECT entity_id, ticker FROM (SELECT entity_id, CASE WHEN length(sec_code) > 0 THEN substr(sec_code, 1, length(sec_code) - 1) END AS ticker FROM companies) "
    "WHERE ticker IS NULL OR ticker NOT IN (SELECT code FROM listing WHERE market = 'PRO Market')",
    "companies listing",
)
def _(t):
    tickers = pro_market(t)
    keyed = t.companies.select("entity_id", ticker(F.col("sec_code")).alias("ticker"))
    return companies.without_tickers(keyed, tickers)


steps.add_cte(
    "industry_pool",
    f"SELECT n.docID AS doc_id, n.edinetCode, COALESCE(g.industry_group, 'invalid') AS industry FROM newest n JOIN companies c ON n.edinetCode = c.entity_id "
    f"LEFT JOIN ({_GROUPS}) g ON c.industry = g.industry WHERE c.industry <> '{companies.NOT_OBLIGED}' AND COALESCE(c.sec_code, '') <> '' "
    "AND substr(c.sec_code, 1, length(c.sec_code) - 1) NOT IN (SELECT code FROM listing WHERE market = 'PRO Market')",
    "newest", "companies", "listing",
)
steps.add_cte(
    "industry_sample",
    f"SELECT * FROM industry_pool QUALIFY row_number() OVER (PARTITION BY industry ORDER BY {steps.HASH.format('doc_id')}, doc_id) <= 35",
    "industry_pool",
)


def pro_market(t):
    return t.listing.filter("market = 'PRO Market'").select(F.col("code").alias("ticker"))


@query("industry_sample", "W10", "SELECT doc_id, edinetCode AS \"edinetCode\", industry FROM industry_sample", "industry_sample")
def _(t):
    return labelled_sets.industry_examples(t.filings, t.companies, pro_market(t))


@query(
    "random_companies_per_industry", "W10",
    f"SELECT entity_id, industry FROM companies QUALIFY row_number() OVER (PARTITION BY industry ORDER BY {steps.HASH.format('entity_id')}, entity_id) <= 35",
    "companies",
)
def _(t):
    return sampling.first_per_group(t.companies, "industry", "entity_id", 35).select("entity_id", "industry")
