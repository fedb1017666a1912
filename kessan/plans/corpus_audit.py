"""What a corpus holds: counts, dates and gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kessan.functions.dates import day
from kessan.operators import audit, companies

CATEGORIES = ("listing", "consolidated", "entity_type", "industry")


def corpus_audit(filings: DataFrame, facts: DataFrame, master: DataFrame, threshold: int = 10) -> DataFrame:
    """``kind, name, n``: companies with enough filings and without, filings per fiscal start
    year, and the companies of the corpus by each of their categories."""
    counts = companies.filings_per_company(filings)
    size = F.when(F.col("file_count") >= threshold, "complete").otherwise("incomplete")
    by_size = counts.groupBy(size.alias("name")).agg(F.count("*").alias("n")).select(
        F.lit("companies").alias("kind"), "name", "n"
    )
    years = audit.fiscal_start_years(facts).groupBy(F.col("year").cast("string").alias("name")).agg(
        F.count("*").alias("n")
    ).select(F.lit("fiscal_start_year").alias("kind"), "name", "n")
    inside = master.join(filings.select(F.col("edinetCode").alias("entity_id")), "entity_id", "left_semi")
    categories = audit.value_counts(inside, *CATEGORIES).select(
        F.col("column").alias("kind"), F.col("value").alias("name"), "n"
    )
    return by_size.unionByName(years).unionByName(categories)


def whole_audit(filings: DataFrame, facts: DataFrame, master: DataFrame, threshold: int = 10) -> DataFrame:
    """``kind, name, n, first_day, last_day``: everything the audit asks, from one scan of filings and
    one of facts.

    Filings are cut to a row per company with its count and its first and last days; what a
    company says about the corpus is a few tagged rows, and one aggregation over all tags makes
    every table: companies by size and by category, filings per company, ranges of days.
    """
    start, end, submit = day(F.col("periodStart")), day(F.col("periodEnd")), day(F.col("submitDateTime"), "yyyy-M-d H:m")
    per_company = filings.groupBy(F.col("edinetCode").alias("entity_id")).agg(
        F.count("*").alias("n"), F.min(start).alias("start"), F.max(end).alias("end"),
        F.min(submit).alias("submit_first"), F.max(submit).alias("submit_last"),
    )
    known = master.select("entity_id", F.lit(True).alias("known"), *CATEGORIES)
    none, one = F.lit(None), F.lit(1).cast("long")
    size = F.when(F.col("n") >= threshold, "complete").otherwise("incomplete")

    def tag(kind: str, name, n, first=none, last=none, when=F.lit(True)):
        entry = F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"), n.alias("n"),
                         first.cast("date").alias("first_day"), last.cast("date").alias("last_day"))
        return F.when(when, entry)

    company = F.col("entity_id").isNotNull()
    tags = [
        tag("companies", size, one, when=company),
        *(tag(c, F.col(c), one, when=F.col("known")) for c in CATEGORIES),
        tag("filings_of_company", F.col("entity_id"), F.col("n"), when=company),
        tag("period", none, F.col("n"), F.col("start"), F.col("end")),
        tag("submitted", none, F.col("n"), F.col("submit_first"), F.col("submit_last")),
    ]
    of_filings = per_company.join(known, "entity_id", "left").select(F.inline(F.array_compact(F.array(*tags))))
    years = audit.fiscal_start_years(facts).select(
        F.lit("fiscal_start_year").alias("kind"), F.col("year").cast("string").alias("name"), one.alias("n"),
        none.cast("date").alias("first_day"), none.cast("date").alias("last_day"),
    )
    return of_filings.unionByName(years).groupBy("kind", "name").agg(
        F.sum("n").alias("n"), F.min("first_day").cast("string").alias("first_day"), F.max("last_day").cast("string").alias("last_day")
    )
