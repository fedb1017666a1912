"""Row predicates on facts, filings and companies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kessan.vocab import CONTEXT_FORMS, IFRS

# Markers in the fact files.
CONSOLIDATED = "連結"
SEPARATE = "個別"
HEADER_PREFIXES = "jpdei_cor:|jpcrp_cor:"
OTHER_STANDARD_PREFIXES = "ifrs-full:|us-gaap:"
HOME_STANDARD = "Japan GAAP"
STATEMENT_PREFIX = "jppfs_cor:"

# Report type by (ordinance, form).
REPORT_TYPES = {
    ("010", "030000"): "annual",
    ("010", "030001"): "annual_amended",
    ("010", "043000"): "quarterly",
    ("010", "043001"): "quarterly_amended",
    ("010", "043A00"): "semiannual",
    ("010", "043A01"): "semiannual_amended",
}
# Words in the description of an annual report.
REPORT_NAME = "有価証券報告書"
AMENDMENT_WORD = "訂正"


def local_name(element: Column) -> Column:
    """Element name behind its last colon."""
    return F.substring_index(element, ":", -1)


def in_period(context: Column, period: str) -> Column:
    """Context of the named period, in any of its four forms."""
    return context.isin(*(period + form for form in CONTEXT_FORMS))


def is_element(element: Column, name: str) -> Column:
    """Element with this name, or with its IFRS form, under any prefix."""
    return element.endswith(f":{name}") | element.endswith(f":{name}{IFRS}")


def is_consolidated(consol: Column, context: Column) -> Column:
    """Neither marked separate nor in a non-consolidated context."""
    return ~consol.contains(SEPARATE) & ~context.endswith("NonConsolidatedMember")


def is_segment(context: Column) -> Column:
    """Context of a segment. One below a (non-)consolidated member does not count."""
    return context.contains("Member") & ~context.contains("ConsolidatedMember")


def has_member(context: Column) -> Column:
    """Any member context; a missing context has none."""
    return F.coalesce(context.contains("Member"), F.lit(False))


def is_fact(
    element: Column, rel_year: Column, period_type: Column, consol: Column, *,
    name: str, year: str, kind: str, basis: str,
) -> Column:
    """Exact selector of one figure."""
    return (
        (element == f"{STATEMENT_PREFIX}{name}")
        & (rel_year == year)
        & (period_type == kind)
        & (consol == basis)
    )


def is_header(element: Column) -> Column:
    return element.rlike(HEADER_PREFIXES)


def other_standard(element: Column) -> Column:
    """Element of another accounting standard."""
    return F.lower(element).rlike(OTHER_STANDARD_PREFIXES)


def report_type(ordinance: Column, form: Column) -> Column:
    chain = None
    for (o, f), name in REPORT_TYPES.items():
        hit = (ordinance == o) & (form == f)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain.otherwise("unknown")


def not_withdrawn(status: Column) -> Column:
    return F.coalesce(status != "1", F.lit(True))


def is_plain_annual(ordinance: Column, form: Column, description: Column) -> Column:
    """Annual report by its codes and, where a description is given, by its words."""
    text = F.coalesce(description, F.lit(""))
    worded = text.contains(REPORT_NAME) & ~text.contains(AMENDMENT_WORD)
    return (report_type(ordinance, form) == "annual") & ((text == "") | worded)


def in_fiscal_years(year: Column, first: int, last: int) -> Column:
    return year.between(first, last)


def home_standard(standard: Column, uses_other: Column) -> Column:
    """Home-standard filing: unstated or named so, and no element of another standard."""
    named = F.coalesce(standard.contains(HOME_STANDARD), F.lit(True))
    return named & ~uses_other


def standard_reason(standard: Column, uses_other: Column) -> Column:
    """Why a filing fails ``home_standard``."""
    return F.when(
        uses_other, F.coalesce(F.nullif(standard, F.lit("")), F.lit("IFRS/US-GAAP"))
    ).otherwise(F.coalesce(F.nullif(standard, F.lit("")), F.lit("Unknown")))


def is_filled(text: Column) -> Column:
    """Template row with an item name."""
    name = F.trim(text)
    return name.isNotNull() & (name != "") & (F.lower(name) != "nan")


def excluded_by(value: Column, excluded: Sequence[str]) -> Column:
    """Membership in a list that may be empty (then false for all)."""
    return value.isin(*excluded) if excluded else F.lit(False)
