"""Statement vocabulary: which element feeds which statement line, and the period contexts.

The vocabulary is a parameter. The built-in one holds the header, the summary figures, the text
blocks, and the balance sheet, income and cash-flow lines; ``read_vocab`` takes another from a
file. An element may feed lines of several statements.
"""

from __future__ import annotations

import csv
from functools import cache
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kessan.small import INT, TEXT, small_table

STATEMENTS = ("META", "SUMMARY", "TEXT", "BS", "PL", "CF")

# Periods in the order in which a later one replaces an earlier one.
PERIODS = (
    "Prior4Year",
    "Prior3Year",
    "Prior2Year",
    "Prior1Year",
    "CurrentYear",
    "Prior1YTD",
    "CurrentYTD",
    "Prior1Quarter",
    "CurrentQuarter",
    "FilingDate",
)
# What follows the period name in a context.
CONTEXT_FORMS = (
    "Instant",
    "Instant_NonConsolidatedMember",
    "Duration",
    "Duration_NonConsolidatedMember",
)
# Fixed value: an element matches a vocabulary entry with or without this ending.
IFRS = "IFRS"


@cache
def _builtin_rows() -> tuple[tuple[str, int, str, str], ...]:
    text = resources.files("kessan.resources").joinpath("vocab.csv").read_text("utf-8")
    lines = [line for line in text.splitlines() if not line.startswith("#")]
    rows, seen = [], {}
    for row in csv.DictReader(lines):
        seen[row["statement"]] = seen.get(row["statement"], 0) + 1
        rows.append((row["statement"], seen[row["statement"]], row["element"], row["item"]))
    return tuple(rows)


def builtin_vocab(spark: SparkSession) -> DataFrame:
    """The built-in entries as ``statement, ord, element, item`` (a fixed, small table)."""
    return small_table(
        spark, list(_builtin_rows()), statement=TEXT, ord=INT, element=TEXT, item=TEXT
    )


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """A vocabulary file: CSV with header ``statement,ord,element,item``."""
    return (
        spark.read.option("header", True)
        .schema("statement string, ord int, element string, item string")
        .csv(path)
    )


def vocab_keys(vocab: DataFrame) -> DataFrame:
    """Two join keys per entry, so that the suffix match is an equality."""
    return vocab.withColumn(
        "local_name", F.explode(F.array("element", F.concat("element", F.lit(IFRS))))
    )


def period_contexts(spark: SparkSession, periods: tuple[str, ...] = PERIODS) -> DataFrame:
    """``period, period_ord, context``: four contexts per period."""
    rows = [
        (period, place, period + form)
        for place, period in enumerate(periods, 1)
        for form in CONTEXT_FORMS
    ]
    return small_table(spark, rows, period=TEXT, period_ord=INT, context=TEXT)
