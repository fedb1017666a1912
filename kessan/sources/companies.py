"""Company master, exchange listing and the company lists the jobs hand to each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kessan.schema import (
    COMPANY_FILE,
    COMPANY_FILE_COLUMNS,
    COMPANY_LIST,
    FILINGS_LIST,
    LISTING_FILE,
    LISTING_FILE_COLUMNS,
    TARGET_LIST,
)


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    return reader.options(**options).csv(path)


def read_company_master(spark: SparkSession, path: str) -> DataFrame:
    """Shift_JIS, one preamble line before the header; undecodable bytes are replaced.

    Spark's CSV source takes this charset only with ``spark.sql.legacy.javaCharsets``, which
    ``build_session`` sets; a session made elsewhere gets it here.
    """
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    rows = (
        spark.read.schema(COMPANY_FILE)
        .option("encoding", "Shift_JIS")
        .option("escape", '"')
        .csv(path)
    )
    first, name = COMPANY_FILE.names[0], "提出者名"
    # The preamble has fewer cells than the header, so its company name is missing.
    return rows.filter((F.col(first) != first) & F.col(f"`{name}`").isNotNull()).withColumnsRenamed(
        COMPANY_FILE_COLUMNS
    )


def read_exchange_listing(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, LISTING_FILE).withColumnsRenamed(LISTING_FILE_COLUMNS)


def read_company_list(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, COMPANY_LIST)


def read_target_list(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, TARGET_LIST)


def read_filings_list(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, FILINGS_LIST)


def read_ticker_list(spark: SparkSession, path: str) -> DataFrame:
    """One code per line."""
    lines = spark.read.text(path).select(F.trim("value").alias("ticker"))
    return lines.filter((F.col("ticker") != "") & ~F.col("ticker").startswith("#"))
