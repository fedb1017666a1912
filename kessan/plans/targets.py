"""Target companies: enough filings, listed, of a kind that can be analysed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kessan.functions.text import listing_code
from kessan.operators.companies import complete, filings_per_company, selection


def with_security_code(counts: DataFrame, filings: DataFrame) -> DataFrame:
    """The company counts with the four-character code of the company's last filing."""
    code = F.max_by("secCode", F.struct(F.coalesce("submitDateTime", F.lit("")), "docID"))
    codes = filings.groupBy(F.col("edinetCode").alias("edinet_code")).agg(
        listing_code(code).alias("sec_code")
    )
    return counts.join(codes, "edinet_code", "left")


def judged_companies(filings: DataFrame, listing: DataFrame, threshold: int = 10) -> DataFrame:
    """Companies with enough filings and the first reason against each, if any."""
    counts = complete(filings_per_company(filings), threshold)
    return selection(with_security_code(counts, filings), listing)


def targets(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNull()).select(
        "edinet_code", "sec_code", "company_name", "industry", "market", "file_count"
    )


def excluded(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNotNull()).select(
        "edinet_code", "sec_code", "company_name", "industry", "market", "reason"
    )
