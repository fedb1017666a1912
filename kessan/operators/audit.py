"""Counts, ranges and listings over a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from kessan.functions import filters
from kessan.functions.dates import day
from kessan.session import written
from kessan.small import LONG, TEXT, small_table


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """``column, value, n`` for each column, in one pass."""
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)
    )
    return df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count("*").alias("n"))


def date_ranges(filings: DataFrame) -> DataFrame:
    """First and last period and submission dates; unreadable dates do not count."""
    start, end = day(F.col("periodStart")), day(F.col("periodEnd"))
    submit = day(F.col("submitDateTime"), "yyyy-M-d H:m")
    return filings.agg(
        F.count("*").alias("n_filings"),
        F.min(start).alias("first_period_start"),
        F.max(end).alias("last_period_end"),
        F.min(submit).alias("first_submit"),
        F.max(submit).alias("last_submit"),
    )


def fiscal_start_years(facts: DataFrame) -> DataFrame:
    """``doc_id, year`` from the fiscal start date of each filing."""
    start = facts.filter(filters.is_element(F.col("element"), "CurrentFiscalYearStartDateDEI"))
    year = F.get(F.split("value", "-"), F.lit(0)).try_cast("int")
    return start.groupBy("doc_id").agg(F.min_by(year, "src_ord").alias("year"))


def year_histogram(years: DataFrame) -> DataFrame:
    return years.groupBy("year").agg(F.count("*").alias("n")).orderBy("year")


def flagged_years(years: DataFrame, flagged: tuple[int, ...] = (2009, 2010, 2011, 2012, 2013)) -> DataFrame:
    return years.filter(F.col("year").isin(*flagged))


def document_lists(files: DataFrame) -> DataFrame:
    """``entity_id, place, doc_id, tsv_count``: the filing ids of each company in order, with
    their places from 1 and their number.

    Ids are dealt to tasks by ranges that Spark takes from the data, and places are counted by
    range first and ranked only within one, so a company with a third of all filings is no task
    of its own.
    """
    ranges = files.select("entity_id", "doc_id").repartitionByRange("entity_id", "doc_id")
    keyed = written(ranges.withColumn("_p", F.spark_partition_id()), "document-ids")
    counts = keyed.groupBy("entity_id", "_p").agg(F.count("*").alias("_n"))
    along = W.Window.partitionBy("entity_id").orderBy("_p")
    starts = counts.select(
        "entity_id", "_p",
        (F.sum("_n").over(along) - F.col("_n")).alias("_before"),
        F.sum("_n").over(W.Window.partitionBy("entity_id")).alias("tsv_count"),
    )
    within = W.Window.partitionBy("entity_id", "_p").orderBy("doc_id")
    place = (F.col("_before") + F.row_number().over(within)).alias("place")
    return keyed.join(starts, ["entity_id", "_p"]).select("entity_id", place, "doc_id", "tsv_count")


def document_texts(files: DataFrame, chunk: int = 1000) -> DataFrame:
    """``entity_id, chunk, tsv_count, doc_ids``: the ids of each company in order, joined by commas. A
    row holds at most ``chunk`` ids, so a company of that many filings is one row (chunk 0) and a
    larger one goes on in further rows; the rows of a company, joined by commas, are its list."""
    listed = document_lists(files).withColumn("chunk", F.floor((F.col("place") - 1) / chunk))
    entry = F.sort_array(F.collect_list(F.struct("place", "doc_id")))
    return listed.groupBy("entity_id", "chunk").agg(
        F.max("tsv_count").alias("tsv_count"), F.array_join(F.transform(entry, lambda e: e["doc_id"]), ",").alias("doc_ids")
    )


def run_counters(**outputs: DataFrame) -> DataFrame:
    """``kind, n``: rows per named output; an empty output counts 0. One aggregation counts all."""
    kinds = None
    for kind, df in outputs.items():
        spark = df.sparkSession
        rows = df.select(F.lit(kind).alias("kind"), F.lit(1).cast("bigint").alias("one"))
        kinds = rows if kinds is None else kinds.unionByName(rows)
    none = small_table(spark, [(kind, 0) for kind in outputs], kind=TEXT, one=LONG)
    return kinds.unionByName(none).groupBy("kind").agg(F.sum("one").alias("n"))
