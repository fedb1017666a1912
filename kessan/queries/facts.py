"""Queries on the fact table."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kessan.functions import filters
from kessan.operators import audit, facts, joins
from kessan.plans import accruals, labelled_sets, statements
from kessan.queries import steps  # noqa: F401
from kessan.queries.bind import ROWS_A_TASK
from kessan.queries.registry import query
from kessan.session import shuffles_removed, written
from kessan.sources import lake
from kessan.vocab import builtin_vocab

_DIGEST = "count(*) AS n, CAST(sum(src_ord) AS BIGINT) AS ord_sum"


def _digest(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("src_ord").alias("ord_sum"))


@query(
    "facts_in_period", "P1",
    f"SELECT element, context, {_DIGEST} FROM facts WHERE context IN ('CurrentYearInstant', "
    "'CurrentYearInstant_NonConsolidatedMember', 'CurrentYearDuration', 'CurrentYearDuration_NonConsolidatedMember') "
    "GROUP BY element, context",
    "facts",
)
def _(t):
    return _digest(t.facts.filter(filters.in_period(F.col("context"), "CurrentYear")), "element", "context")


@query(
    "facts_of_element", "P2",
    f"SELECT element, rel_year, consol, {_DIGEST} FROM facts WHERE element LIKE '%:NetSales' OR element LIKE '%:NetSalesIFRS' "
    "GROUP BY element, rel_year, consol",
    "facts",
)
def _(t):
    return _digest(t.facts.filter(filters.is_element(F.col("element"), "NetSales")), "element", "rel_year", "consol")


@query(
    "facts_consolidated", "P3",
    f"SELECT consol, context, {_DIGEST} FROM facts WHERE NOT contains(consol, '個別') AND context NOT LIKE '%NonConsolidatedMember' "
    "GROUP BY consol, context",
    "facts",
)
def _(t):
    return _digest(t.facts.filter(filters.is_consolidated(F.col("consol"), F.col("context"))), "consol", "context")


@query(
    "facts_without_segments", "P4",
    f"SELECT consol, context, {_DIGEST} FROM facts WHERE NOT (contains(context, 'Member') AND NOT contains(context, "
    "'NonConsolidatedMember') AND NOT contains(context, 'ConsolidatedMember')) GROUP BY consol, context",
    "facts",
)
def _(t):
    return _digest(t.facts.filter(~filters.is_segment(F.col("context"))), "consol", "context")


@query(
    "exact_figure", "P5",
    "SELECT doc_id, context, unit, value FROM facts WHERE element = 'jppfs_cor:NetSales' AND rel_year = '当期' "
    "AND period_type = '期間' AND consol = '連結'",
    "facts",
)
def _(t):
    hit = filters.is_fact(
        F.col("element"), F.col("rel_year"), F.col("period_type"), F.col("consol"),
        name="NetSales", year="当期", kind="期間", basis="連結",
    )
    return t.facts.filter(hit).select("doc_id", "context", "unit", "value")


@query(
    "header_rows", "P6 S3",
    f"SELECT element, {_DIGEST} FROM facts WHERE regexp_matches(element, 'jpdei_cor:|jpcrp_cor:') GROUP BY element",
    "facts",
)
def _(t):
    narrow = t.facts.select("doc_id", "element", "value", "src_ord")
    return _digest(narrow.filter(filters.is_header(F.col("element"))), "element")


@query(
    "other_standard_filings", "P7 A14",
    "SELECT doc_id, bool_or(regexp_matches(lower(element), 'ifrs-full:|us-gaap:')) AS uses_other FROM facts GROUP BY doc_id",
    "facts",
)
def _(t):
    return facts.standard_flags(t.facts)


@query(
    "member_contexts", "P8",
    "SELECT COALESCE(contains(context, 'Member'), false) AS has_member, count(*) AS n FROM facts GROUP BY 1",
    "facts",
)
def _(t):
    return t.facts.groupBy(filters.has_member(F.col("context")).alias("has_member")).agg(F.count("*").alias("n"))


@query(
    "unique_facts", "U5",
    "SELECT element, context, count(*) AS n, count(value) AS n_value, min(value) AS least, max(value) AS largest FROM dedup "
    "GROUP BY element, context",
    "dedup",
)
def _(t):
    def counted(some: DataFrame) -> DataFrame:
        return facts.unique_facts(some).groupBy("element", "context").agg(
            F.count("*").alias("n"), F.count("value").alias("n_value"),
            F.min("value").alias("least"), F.max("value").alias("largest"),
        )

    if t.rounds == 1:
        return counted(t.facts)
    # Copies are of one filing, so the filings of a round are told apart without those of the others.
    part, found = F.pmod(F.xxhash64("doc_id"), F.lit(t.rounds)), []
    with shuffles_removed(t.spark):
        for n in range(t.rounds):
            found.append(written(counted(t.facts.filter(part == n)), "unique-facts"))
    return reduce(DataFrame.union, found).groupBy("element", "context").agg(
        F.sum("n").alias("n"), F.sum("n_value").alias("n_value"), F.min("least").alias("least"), F.max("largest").alias("largest")
    )


@query(
    "leaf_facts", "J1 N22",
    "SELECT statement, item, period, count(DISTINCT (doc_id, element, context, rel_year, consol, period_type)) AS n FROM leaves "
    "WHERE statement IS NOT NULL GROUP BY statement, item, period",
    "leaves",
)
def _(t):
    leaves = facts.leaf_facts(t.facts, builtin_vocab(t.spark))
    # Facts are told apart by prints: four numbers a row are shuffled, no texts of the key.
    named = leaves.select("statement", "item", "period", *facts.prints("doc_id", *facts.FACT_KEYS))
    distinct = named.distinct()
    return distinct.groupBy("statement", "item", "period").agg(F.count("*").alias("n"))


@query(
    "single_values", "A10",
    "SELECT doc_id, item, ord, period, value FROM singles WHERE statement = 'BS'",
    "singles",
)
def _(t):
    vocab = builtin_vocab(t.spark).filter("statement = 'BS'")
    singles = facts.single_values(facts.leaf_values(facts.leaf_facts(t.facts, vocab)))
    return facts.labelled(singles, vocab).select("doc_id", "item", "ord", "period", "value")


@query(
    "last_leaf_of_label", "A11",
    "SELECT doc_id, item, ord, period, value FROM body WHERE statement = 'PL'",
    "body",
)
def _(t):
    vocab = builtin_vocab(t.spark).filter("statement = 'PL'")
    singles = facts.single_values(facts.leaf_values(facts.leaf_facts(t.facts, vocab)))
    return facts.labelled(facts.last_leaf(singles), vocab).select("doc_id", "item", "ord", "period", "value")


@query("header_items", "A12", "SELECT doc_id, item, value FROM meta", "meta")
def _(t):
    vocab = builtin_vocab(t.spark).filter("statement = 'META'")
    singles = facts.single_values(facts.leaf_values(facts.leaf_facts(t.facts, vocab)))
    return facts.labelled(facts.last_leaf(singles), vocab).select("doc_id", "item", "value")


@query(
    "statements", "E1 A10 A11 A12 J1 U5 N22",
    "SELECT doc_id, statement, item, period, value FROM statements",
    "statements",
)
def _(t):
    return statements.statements(t.facts, few_copies=True).select("doc_id", "statement", "item", "period", "value")


@query(
    "statements_landed_by_filing", "E1 K1 S1",
    "SELECT doc_id, statement, item, period, value FROM statements",
    "statements",
)
def _(t):
    """As ``statements``, from facts landed in buckets by filing: nothing is shuffled after that."""
    table = f"facts_{uuid.uuid4().hex}"
    # A bucket is sorted by one task: buckets follow the corpus, so that what a task sorts does not.
    buckets = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), t.raw("lineitem").count() // (4 * ROWS_A_TASK))
    lake.land_by_filing(t.facts, table, buckets, t.rounds)
    parsed = statements.statements(lake.read_by_filing(t.spark, table), placed=True)
    return parsed.select("doc_id", "statement", "item", "period", "value")


@query(
    "statement_maps", "A18",
    "SELECT doc_id, statement, count(*) AS n_items, '{' || string_agg(CAST(to_json(item) AS VARCHAR) || ':' || json, ',' "
    "ORDER BY ord, item) || '}' AS items FROM period_json WHERE statement <> 'META' GROUP BY doc_id, statement",
    "period_json",
)
def _(t):
    maps = statements.statement_maps(statements.statements(t.facts, only=statements.BODY, few_copies=True))
    text = F.to_json("items", {"ignoreNullFields": "false"})
    return maps.select("doc_id", "statement", F.size("items").cast("bigint").alias("n_items"), text.alias("items"))


@query(
    "statement_sections", "N17 A18",
    "SELECT doc_id, meta, summary, text, bs, pl, cf FROM sections",
    "sections",
)
def _(t):
    return statements.sections(statements.statements(t.facts, few_copies=True))


@query(
    "header_map", "A19 N16 N8",
    "SELECT doc_id, arg_max_null(value, src_ord) FILTER (element = 'jpdei_cor:CurrentFiscalYearStartDateDEI') AS start_date, "
    "arg_max_null(value, src_ord) FILTER (element = 'jpdei_cor:AccountingStandardsDEI') AS standard, "
    "COALESCE(nullif(arg_max_null(value, src_ord) FILTER (element = 'jpdei_cor:FilingDateDEI'), ''), "
    "nullif(arg_max_null(value, src_ord) FILTER (element = 'jpcrp_cor:FilingDateCoverPage'), '')) AS submitted "
    "FROM facts WHERE element IN ('jpdei_cor:CurrentFiscalYearStartDateDEI', 'jpdei_cor:AccountingStandardsDEI', "
    "'jpdei_cor:FilingDateDEI', 'jpcrp_cor:FilingDateCoverPage') GROUP BY doc_id",
    "facts",
)
def _(t):
    from kessan.functions.text import first_filled

    names = [accruals.YEAR_START, accruals.STANDARD, *accruals.SUBMITTED]
    wide = facts.header_values(t.facts, names)
    return wide.select(
        "doc_id",
        F.col(f"`{accruals.YEAR_START}`").alias("start_date"),
        F.col(f"`{accruals.STANDARD}`").alias("standard"),
        first_filled(*(F.col(f"`{c}`") for c in accruals.SUBMITTED)).alias("submitted"),
    )


_REC = {
    "prefix": "jppfs_cor:",
    "ranks": ", ".join(f"('jppfs_cor:{e}', {n})" for n, e in enumerate(accruals.RECEIVABLES)),
}


@query(
    "receivables_by_fallback", "W9 A13 N2 A14",
    "SELECT b.doc_id, b.is_consolidated, w.number AS receivables, w.name AS receivables_element FROM "
    "(SELECT doc_id, bool_or(consol = '連結' AND rel_year = '当期末') AS is_consolidated FROM facts "
    f"WHERE element IN (SELECT element FROM (VALUES {_REC['ranks']}) AS c(element, place)) AND consol IN ('連結', '個別') GROUP BY doc_id) b "
    "LEFT JOIN (SELECT doc_id, consol, number, name FROM (SELECT doc_id, consol, substr(element, 11) AS name, place, max(number) AS number FROM "
    f"(SELECT f.*, c.place, {steps.NUMBER.format('value')} * CASE unit WHEN '千円' THEN 1e3 WHEN '百万円' THEN 1e6 ELSE 1 END AS number "
    f"FROM facts f JOIN (VALUES {_REC['ranks']}) AS c(element, place) ON f.element = c.element "
    "WHERE rel_year = '当期末' AND period_type = '時点' AND NOT (contains(context, 'Member') AND NOT contains(context, 'ConsolidatedMember'))) "
    "WHERE number IS NOT NULL GROUP BY doc_id, consol, element, place) QUALIFY row_number() OVER (PARTITION BY doc_id, consol ORDER BY place) = 1) w "
    "ON w.doc_id = b.doc_id AND w.consol = CASE WHEN b.is_consolidated THEN '連結' ELSE '個別' END",
    "facts",
)
def _(t):
    measure = facts.Measure("receivables", accruals.RECEIVABLES, accruals.END, accruals.INSTANT)
    prefers = (F.col("consol") == filters.CONSOLIDATED) & (F.col("rel_year") == accruals.END)
    found = facts.fallback_values(t.facts, [measure], filters.CONSOLIDATED, filters.SEPARATE, prefers)
    return found.withColumnRenamed("is_preferred", "is_consolidated")


@query(
    "receivable_elements", "P22 A22",
    "SELECT DISTINCT element, label FROM facts WHERE contains(element, 'jppfs_cor:') AND regexp_matches(lower(element), "
    "'receiv|note|electronic') AND consol IN ('連結', '個別') AND rel_year IN ('当期末', '前期末')",
    "facts",
)
def _(t):
    return facts.receivable_elements(t.facts)


_CANDIDATES = ("NotesAndAccountsReceivableTrade", "ElectronicallyRecordedMonetaryClaimsOperating")


@query(
    "candidate_availability", "P23",
    "SELECT doc_id, kind, element, value FROM (SELECT *, max(CASE WHEN kind = 'found' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS has_found "
    "FROM (SELECT doc_id, CASE WHEN element IN ('jppfs_cor:NotesAndAccountsReceivableTrade', 'jppfs_cor:ElectronicallyRecordedMonetaryClaimsOperating') "
    "THEN 'found' ELSE 'instead' END AS kind, element, min(value) AS value FROM facts WHERE rel_year = '当期末' AND consol = '連結' AND "
    "(element IN ('jppfs_cor:NotesAndAccountsReceivableTrade', 'jppfs_cor:ElectronicallyRecordedMonetaryClaimsOperating') OR "
    "(contains(element, 'jppfs_cor:') AND (contains(lower(element), 'receiv') OR contains(label, '売掛') OR contains(label, '手形')))) "
    "GROUP BY doc_id, kind, element)) WHERE kind = 'found' OR has_found = 0 UNION ALL "
    "SELECT DISTINCT doc_id, 'none', NULL, NULL FROM facts WHERE doc_id NOT IN (SELECT doc_id FROM facts WHERE rel_year = '当期末' AND consol = '連結' "
    "AND (contains(element, 'jppfs_cor:') AND (contains(lower(element), 'receiv') OR element = 'jppfs_cor:ElectronicallyRecordedMonetaryClaimsOperating' "
    "OR contains(label, '売掛') OR contains(label, '手形'))))",
    "facts",
)
def _(t):
    return facts.candidate_availability(t.facts, _CANDIDATES)


@query(
    "amended_to_original", "J12",
    "SELECT doc_id AS amended_doc_id, min(value) AS original_doc_id FROM dedup WHERE element LIKE '%:IdentificationOfDocumentSubjectToAmendmentDEI' "
    "GROUP BY doc_id HAVING count(*) = 1 AND min(value) <> ''",
    "dedup",
)
def _(t):
    return joins.amended_originals(t.facts)


@query(
    "fraud_company_codes", "J14",
    "SELECT DISTINCT value AS \"edinetCode\" FROM facts WHERE element LIKE '%:EDINETCodeDEI' AND doc_id IN "
    "(SELECT original_doc_id FROM judgements WHERE is_accounting_fraud)",
    "facts judgements",
)
def _(t):
    docs = t.judgements.filter("is_accounting_fraud").select(F.col("original_doc_id").alias("doc_id"))
    return labelled_sets.fraud_entities(t.facts, docs)


steps.add_cte(
    "profits",
    "SELECT doc_id, max(CASE WHEN period = 'CurrentYear' THEN profit END) AS \"current\", max(CASE WHEN period = 'Prior1Year' THEN profit END) AS prior FROM "
    "(SELECT doc_id, period, CASE WHEN count(*) = 1 AND regexp_matches(min(value), '^[+-]?[0-9]+$') THEN CAST(min(value) AS DECIMAL(38, 0)) END AS profit FROM "
    "(SELECT d.*, p.period, min(CASE WHEN element LIKE '%:ProfitLossAttributableToOwnersOfParentCompanyIFRS%' THEN 2 ELSE 1 END) OVER (PARTITION BY doc_id) AS rank "
    "FROM dedup d LEFT JOIN periods p ON d.context = p.context WHERE regexp_matches(element, ':ProfitLossAttributableToOwnersOfParent(IFRS)?$') "
    "OR regexp_matches(element, ':ProfitLossAttributableToOwnersOfParentCompanyIFRS(IFRS)?$')) GROUP BY doc_id, period) GROUP BY doc_id",
    "dedup", "periods",
)


@query(
    "profits", "N26",
    "SELECT doc_id, CAST(\"current\" AS BIGINT) AS current_profit, CAST(prior AS BIGINT) AS prior_profit FROM profits",
    "profits",
)
def _(t):
    found = labelled_sets.profits(t.facts)
    return found.select(
        "doc_id", F.col("current").cast("bigint").alias("current_profit"), F.col("prior").cast("bigint").alias("prior_profit")
    )


steps.add_cte(
    "start_years",
    "SELECT doc_id, TRY_CAST(split_part(arg_min(value, src_ord), '-', 1) AS INT) AS year FROM facts "
    "WHERE element LIKE '%:CurrentFiscalYearStartDateDEI' GROUP BY doc_id",
    "facts",
)


@query("fiscal_start_year_histogram", "A6", "SELECT year, count(*) AS n FROM start_years GROUP BY year", "start_years")
def _(t):
    return audit.year_histogram(audit.fiscal_start_years(t.facts))


@query(
    "flagged_start_years", "P26",
    "SELECT doc_id, year FROM start_years WHERE year IN (2009, 2010, 2011, 2012, 2013)",
    "start_years",
)
def _(t):
    return audit.flagged_years(audit.fiscal_start_years(t.facts))


@query(
    "unconsolidated_filings", "P29",
    "SELECT doc_id FROM gate",
    "gate",
)
def _(t):
    return statements.unconsolidated(t.facts)
