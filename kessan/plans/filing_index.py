"""From landed index responses to the filings to keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kessan.functions import filters
from kessan.functions.dates import day
from kessan.operators.joins import not_landed


def with_type(filings: DataFrame) -> DataFrame:
    return filings.withColumn("doc_type", filters.report_type(F.col("ordinanceCode"), F.col("formCode")))


def of_company(filings: DataFrame, entity: str | None = None) -> DataFrame:
    """Filings of one company, or all."""
    return filings if entity is None else filings.filter(F.col("edinetCode") == entity)


def wanted_filings(
    filings: DataFrame, doc_type: str = "annual", entity: str | None = None, landed: DataFrame | None = None
) -> DataFrame:
    """Filings of a type that are not withdrawn and not yet landed."""
    kept = with_type(of_company(filings, entity)).filter(
        (F.col("doc_type") == doc_type) & filters.not_withdrawn(F.col("withdrawalStatus"))
    )
    return kept if landed is None else not_landed(kept, landed)


def days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Each day from start to end, both included."""
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(span).alias("day"))


def month_windows(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Whole months from start to end, cut to them: ``first_day, last_day``."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("m")).select(
        F.greatest("m", first).alias("first_day"), F.least(F.last_day("m"), last).alias("last_day")
    )


def submitted_between(filings: DataFrame, start: str, end: str) -> DataFrame:
    on = day(F.substring("submitDateTime", 1, 10))
    return filings.filter(on.between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def filings_per_day(filings: DataFrame, calendar: DataFrame) -> DataFrame:
    """``day, n`` for each day of a calendar, 0 where nothing was filed."""
    on = day(F.substring("submitDateTime", 1, 10))
    counts = filings.groupBy(on.alias("day")).agg(F.count("*").alias("n"))
    return calendar.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))
