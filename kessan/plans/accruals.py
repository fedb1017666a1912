"""Inputs of the accrual model, with the logs of what is missing or doubled."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kessan.functions import dates, filters
from kessan.functions.numbers import plus_if_base
from kessan.functions.text import first_filled
from kessan.operators.companies import without_industries
from kessan.operators.facts import HEADER_ELEMENTS, SUBMISSION_COLUMNS, Measure, fallback_values, header_side
from kessan.operators.select import best_and_reasons, best_per_year, company_years, duplicate_log
from kessan.session import written
from kessan.small import LONG, TEXT, small_table

FIRST_YEAR, LAST_YEAR = 2015, 2024

# Header elements by what they hold; of the submission the first that is filled counts.
STANDARD, YEAR_START, YEAR_END = (HEADER_ELEMENTS[c] for c in ("standard", "year_start", "year_end"))
SUBMITTED = tuple(HEADER_ELEMENTS[c] for c in SUBMISSION_COLUMNS)

# Elements that may hold a figure, best first.
NET_SALES = ("NetSales", "NetSalesOfCompletedConstructionContracts")
PROFIT = ("ProfitLoss", "ProfitLossAttributableToOwnersOfParent")
OPERATING_CASH = ("NetCashProvidedByUsedInOperatingActivities",)
ASSETS = ("Assets",)
RECEIVABLES = (
    "NotesAndAccountsReceivableTrade",
    "NotesAndAccountsReceivableTradeAndContractAssets",
    "ReceivablesTradeAndContractAssets",
    "AccountsReceivableTrade",
    "TradeAndOtherReceivables",
    "NotesReceivableTrade",
    "AccountsReceivableOther",
    "AccountsReceivableFromCompletedConstructionContracts",
    "NotesReceivableAccountsReceivableFromCompletedConstructionContractsAndOtherCNS",
)
E_CLAIMS = (
    "ElectronicallyRecordedMonetaryClaimsOperatingCA",
    "ElectronicallyRecordedMonetaryClaimsOperating",
)
FIXED_ASSETS = ("PropertyPlantAndEquipment", "PropertyPlantAndEquipmentNet")

# Year and kind marks.
NOW, BEFORE, END, END_BEFORE = "当期", "前期", "当期末", "前期末"
DURATION, INSTANT = "期間", "時点"

MEASURES = (
    Measure("rev_t", NET_SALES, NOW, DURATION),
    Measure("rev_t1", NET_SALES, BEFORE, DURATION),
    Measure("ni_t", PROFIT, NOW, DURATION),
    Measure("cfo_t", OPERATING_CASH, NOW, DURATION),
    Measure("assets_prev_end", ASSETS, END_BEFORE, INSTANT),
    Measure("rec_base_t", RECEIVABLES, END, INSTANT),
    Measure("rec_base_t1", RECEIVABLES, END_BEFORE, INSTANT),
    Measure("eclaims_end_t", E_CLAIMS, END, INSTANT),
    Measure("eclaims_end_t1", E_CLAIMS, END_BEFORE, INSTANT),
    Measure("ppe_end_t", FIXED_ASSETS, END, INSTANT),
)
# How the log names each missing figure, in its order; {} is the basis.
MISSING_TEXTS = (
    ("rev_t", "rev_t (NetSales 当期 {})"),
    ("rev_t1", "rev_t1 (NetSales 前期 {})"),
    ("ni_t", "ni_t (ProfitLoss 当期 {})"),
    ("cfo_t", "cfo_t (OperatingCF 当期 {})"),
    ("assets_prev_end", "assets_prev_end (Assets 前期末 {})"),
    ("ar_end_t", "ar_end_t (REC base 当期末 {})"),
    ("ar_end_t1", "ar_end_t1 (REC base 前期末 {})"),
    ("ppe_end_t", "ppe_end_t (PPE 当期末 {})"),
    ("ta_t", "ta_t (ni_t - cfo_t)"),
    ("d_rev", "d_rev (rev_t - rev_t1)"),
    ("d_ar", "d_ar (ar_end_t - ar_end_t1)"),
)
COMPANY_COLUMNS = ("edinet_code", "sec_code", "company_name", "industry", "market")
OUTPUT_COLUMNS = (
    *COMPANY_COLUMNS, "fiscal_year", "period_end", "submit_datetime", "doc_id", "tsv_path",
    "is_consolidated", "assets_prev_end", "rev_t", "rev_t1", "ar_end_t", "ar_end_t1",
    "ar_end_t_no_e", "ar_end_t1_no_e", "eclaims_end_t", "eclaims_end_t1", "rec_rule",
    "rec_used_base_eid", "rec_used_eclaims_eid", "ppe_end_t", "ni_t", "cfo_t", "ta_t", "d_rev", "d_ar",
)


def filing_headers(facts: DataFrame, entities: DataFrame) -> DataFrame:
    """One row per filing: company, standard, fiscal dates, submission, and whether the filing
    is of the home standard. ``entities``: ``doc_id, entity_id``."""
    return headers_of_side(header_side(facts), entities)


def headers_of_side(side: DataFrame, entities: DataFrame) -> DataFrame:
    """``filing_headers`` from the header side table kept by the landing, without the facts."""
    uses_other = F.coalesce("uses_other", F.lit(False))
    standard = F.col("standard")
    return side.join(entities, "doc_id").select(
        "doc_id",
        "entity_id",
        F.concat_ws("/", "entity_id", F.concat("doc_id", F.lit(".tsv"))).alias("path"),
        standard.alias("standard"),
        dates.fiscal_year(F.col("year_start")).alias("fiscal_year"),
        F.col("year_end").alias("period_end"),
        first_filled(*map(F.col, SUBMISSION_COLUMNS)).alias("submit_text"),
        filters.home_standard(standard, uses_other).alias("accepted"),
        filters.standard_reason(standard, uses_other).alias("standard_reason"),
    )


def basis_and_values(facts: DataFrame) -> DataFrame:
    """Per filing the figures on its basis: consolidated if it has any consolidated current
    sales row, even one without a number, else separate."""
    sales = [filters.STATEMENT_PREFIX + name for name in NET_SALES]
    has_consolidated = (
        F.col("element").isin(*sales)
        & (F.col("consol") == filters.CONSOLIDATED)
        & (F.col("rel_year") == NOW)
    )
    values = fallback_values(
        facts, MEASURES, filters.CONSOLIDATED, filters.SEPARATE, has_consolidated
    )
    return values.withColumnRenamed("is_preferred", "is_consolidated")


def _reasons(basis: Column) -> Column:
    parts = []
    for column, text in MISSING_TEXTS:
        before, mark, after = text.partition("{}")
        reason = F.concat(F.lit(before), basis, F.lit(after)) if mark else F.lit(text)
        parts.append(F.when(F.col(column).isNull(), reason))
    return F.array_join(F.array_compact(F.array(*parts)), "; ")


@dataclass(frozen=True)
class AccrualTables:
    inputs: DataFrame
    missing: DataFrame
    duplicates: DataFrame
    receivables: DataFrame


def accrual_rows(
    facts: DataFrame, entities: DataFrame, companies: DataFrame,
    first: int = FIRST_YEAR, last: int = LAST_YEAR, excluded_industries: tuple[str, ...] = (), headers: DataFrame | None = None,
) -> DataFrame:
    """A row per company and fiscal year with the chosen filing's figures and ``missing_reason``
    (empty text: complete)."""
    listed = without_industries(companies, excluded_industries)
    headers = (filing_headers(facts, entities) if headers is None else headers).filter(
        filters.in_fiscal_years(F.col("fiscal_year"), first, last)
    )
    figures = basis_and_values(facts)
    picked = best_and_reasons(headers).join(figures, "doc_id", "left").withColumn(
        "is_consolidated", F.coalesce("is_consolidated", F.lit(False))
    )
    years = company_years(listed.select(*COMPANY_COLUMNS), first, last).withColumn(
        "entity_id", F.col("edinet_code")
    )
    # Both sides grow with the corpus. The estimate for ``years`` is that of its companies, as if none of
    # them had several years, so without the hint Spark may bring them all to the driver to broadcast them.
    grid = years.join(picked.hint("merge"), ["entity_id", "fiscal_year"], "left")
    basis = F.when(F.col("is_consolidated"), filters.CONSOLIDATED).otherwise(filters.SEPARATE)
    computed = (
        grid.withColumn("ar_end_t_no_e", F.col("rec_base_t"))
        .withColumn("ar_end_t1_no_e", F.col("rec_base_t1"))
        .withColumn("ar_end_t", plus_if_base(F.col("rec_base_t"), F.col("eclaims_end_t")))
        .withColumn("ar_end_t1", plus_if_base(F.col("rec_base_t1"), F.col("eclaims_end_t1")))
        .withColumn("rec_rule", F.when(F.col("rec_base_t").isNotNull(), "PLUS_E").otherwise("NO_BASE"))
        .withColumn("rec_used_base_eid", F.coalesce("rec_base_t_element", F.lit("")))
        .withColumn("rec_used_eclaims_eid", F.coalesce("eclaims_end_t_element", F.lit("")))
        .withColumn("ta_t", F.col("ni_t") - F.col("cfo_t"))
        .withColumn("d_rev", F.col("rev_t") - F.col("rev_t1"))
        .withColumn("d_ar", F.col("ar_end_t") - F.col("ar_end_t1"))
    )
    reason = F.when(
        F.col("doc_id").isNull(),
        F.when(
            F.col("standard_reason").isNotNull(),
            F.concat(F.lit("accounting_standard: "), "standard_reason"),
        ).otherwise("no_tsv_found_for_year"),
    ).otherwise(_reasons(basis))
    return computed.withColumn("missing_reason", reason).withColumnsRenamed(
        {"submit_text": "submit_datetime", "path": "tsv_path"}
    )


def duplicates(
    facts: DataFrame, entities: DataFrame, companies: DataFrame, first: int = FIRST_YEAR, last: int = LAST_YEAR,
    headers: DataFrame | None = None,
) -> DataFrame:
    """The filings passed over for another of the same company and year."""
    accepted = (written(filing_headers(facts, entities), "headers") if headers is None else headers).filter(
        filters.in_fiscal_years(F.col("fiscal_year"), first, last) & F.col("accepted")
    )
    log = duplicate_log(accepted, best_per_year(accepted))
    return log.join(companies.select("edinet_code"), "edinet_code", "left_semi")


def accrual_inputs(
    facts: DataFrame, entities: DataFrame, companies: DataFrame,
    first: int = FIRST_YEAR, last: int = LAST_YEAR, excluded_industries: tuple[str, ...] = (), side: DataFrame | None = None,
) -> AccrualTables:
    """The complete cases and the three logs.

    ``companies``: ``edinet_code, sec_code, company_name, industry, market``. Three of
    them are views of one grid, which is written once; headers are made once, or read from ``side``,
    the header side table, where that is given.
    """
    listed = without_industries(companies, excluded_industries)
    headers = written(headers_of_side(header_side(facts) if side is None else side, entities), "headers")
    rows = written(accrual_rows(facts, entities, listed, first, last, headers=headers), "accrual-rows")
    return AccrualTables(
        inputs=complete_rows(rows),
        missing=missing_log(rows),
        duplicates=duplicates(facts, entities, listed, first, last, headers),
        receivables=receivables_log(rows),
    )


#: Outputs of a run, in the order of its counters.
OUTPUTS = ("inputs", "missing", "duplicates", "receivables")


def write_accrual_run(tables: AccrualTables, root: str) -> DataFrame:
    """The four tables as parquet folders under ``root``, and ``kind, n``: the rows of each, counted
    by the tasks that write them."""
    counts = []
    for kind in OUTPUTS:
        seen = Observation(kind)
        getattr(tables, kind).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root}/{kind}")
        counts.append((kind, seen.get["n"]))
    return small_table(tables.inputs.sparkSession, counts, kind=TEXT, n=LONG)


def complete_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("missing_reason") == "").select(*OUTPUT_COLUMNS)


def missing_log(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("missing_reason") != "").select(
        "edinet_code", "fiscal_year", F.coalesce("tsv_path", F.lit("")).alias("tsv_path"), "missing_reason"
    )


def receivables_log(rows: DataFrame) -> DataFrame:
    """How the receivables of each chosen filing came about."""
    used = lambda c: F.coalesce(c, F.lit(""))
    return rows.filter(F.col("doc_id").isNotNull()).select(
        "edinet_code", "fiscal_year", "tsv_path", "is_consolidated", "rec_rule",
        F.col("rec_base_t").alias("rec_base_end_t"),
        F.col("rec_base_t1").alias("rec_base_end_t1"),
        F.col("eclaims_end_t").alias("rec_eclaims_end_t"),
        F.col("eclaims_end_t1").alias("rec_eclaims_end_t1"),
        F.col("ar_end_t").alias("rec_plus_e_end_t"),
        F.col("ar_end_t1").alias("rec_plus_e_end_t1"),
        used("rec_base_t_element").alias("rec_used_base_eid_end_t"),
        used("rec_base_t1_element").alias("rec_used_base_eid_end_t1"),
        used("eclaims_end_t_element").alias("rec_used_eclaims_eid_end_t"),
        used("eclaims_end_t1_element").alias("rec_used_eclaims_eid_end_t1"),
    )
