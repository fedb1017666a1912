"""Parquet statement rows, exported tables, templates and the table catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kessan.schema import STATEMENT_ROWS


def read_statement_rows(spark: SparkSession, path: str) -> DataFrame:
    """Statement rows by file, folder or pattern."""
    return spark.read.schema(STATEMENT_ROWS).parquet(path)


def read_wide_export(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A wide export as written; all columns are text, names come from the header."""
    return spark.read.option("header", True).option("sep", sep).csv(path)


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """A template: ``項目`` and ``Y1..Yn``, all text."""
    return spark.read.option("header", True).csv(path)


def template_items(template: DataFrame, limit: int = 10_000) -> list[str]:
    """Item names of a template in file order. A template is a form, so its size is checked."""
    rows = template.select(F.trim("項目").alias("item")).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a template of more than {limit} rows is no form")
    return [row.item for row in rows if row.item and row.item.lower() != "nan"]


def list_tables(spark: SparkSession) -> DataFrame:
    """Names of the tables and views of the current database."""
    return spark.sql("SHOW TABLES").select("tableName", "isTemporary")
