"""Fact files and the parquet copy made of them once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kessan.functions.text import doc_id_of, entity_id_of
from kessan.schema import FACT_FILE, FACT_FILE_COLUMNS, FACTS


FACT_FILE_OPTIONS = {
    "sep": "\t",
    "header": "true",
    "encoding": "UTF-16",
    "multiLine": "true",
    "escape": '"',
    "mode": "PERMISSIVE",
}


def named_facts(rows: DataFrame, *further: str) -> DataFrame:
    """Rows of fact files (with ``path`` and ``src_ord``) under the names used here."""
    named = rows.withColumnsRenamed(FACT_FILE_COLUMNS)
    return named.select(
        doc_id_of(F.col("path")).alias("doc_id"),
        entity_id_of(F.col("path")).alias("entity_id"),
        *(name for name in FACTS.names if name not in ("doc_id", "entity_id")),
        *further,
    )


def read_fact_files(spark: SparkSession, path: str) -> DataFrame:
    """Fact files laid out as ``type/entity/doc.tsv``: UTF-16, tabs, quotes, all text.

    UTF-16 text with line breaks inside quotes cannot be split, so a file is one unit of
    work; filings are small and many go into one task. Ragged lines are cut or filled with
    nulls. ``src_ord`` keeps the order of rows within a file: one task reads it in order.
    """
    rows = spark.read.schema(FACT_FILE).options(**FACT_FILE_OPTIONS).csv(path)
    return named_facts(
        rows.withColumn("src_ord", F.monotonically_increasing_id()).withColumn(
            "path", F.col("_metadata.file_path")
        )
    )


#: Where the reader puts the text of a line it could not fit into the columns.
BAD_LINE = "bad_line"


def scan_fact_files(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_fact_files``, with ``path`` and, for lines that do not have nine cells, their text
    in ``bad_line`` and what is wrong in ``fault``: ``short``, ``long``, or ``quote`` where a quote is
    never closed and the line runs on to the end of the file. Their cells are cut or filled with nulls."""
    schema = T.StructType([*FACT_FILE.fields, T.StructField(BAD_LINE, T.StringType())])
    rows = spark.read.schema(schema).options(**FACT_FILE_OPTIONS, columnNameOfCorruptRecord=BAD_LINE).csv(path)
    text = F.col(BAD_LINE)
    count = lambda mark: F.length(text) - F.length(F.replace(text, F.lit(mark)))
    fault = F.when(count('"') % 2 == 1, "quote").when(count("\t") < len(FACT_FILE) - 1, "short").otherwise("long")
    return named_facts(
        rows.withColumn("src_ord", F.monotonically_increasing_id()).withColumns(
            {"path": F.col("_metadata.file_path"), "fault": F.when(text.isNotNull(), fault)}
        ),
        "path", BAD_LINE, "fault",
    )


def split_scan(scan: DataFrame, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``scan`` parsed once into ``root``; from there the facts that may be used, the table of faulty
    lines, kept whole in ``root``/quarantine, and ``entity_id, doc_id, fault, n``: how many lines
    of each file have a fault. Short and long lines are used, cut or filled, as the rules say; a
    line with an open quote is not, since its last cell holds the rest of the file."""
    spark = scan.sparkSession
    scan.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/lines")
    lines = spark.read.schema(scan.schema).parquet(f"{root}/lines")
    faulty = lines.filter(F.col("fault").isNotNull()).select("entity_id", "doc_id", "src_ord", "fault", BAD_LINE)
    faulty.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/quarantine")
    kept = spark.read.schema(faulty.schema).parquet(f"{root}/quarantine")
    counts = kept.groupBy("entity_id", "doc_id", "fault").agg(F.count(F.lit(1)).alias("n"))
    return lines.filter("fault IS NULL OR fault <> 'quote'"), kept, counts


def land_facts(facts: DataFrame, path: str, mode: str = "append") -> None:
    """The parquet copy all jobs read: sorted by element within each file, so that a filter
    on elements skips row groups. No shuffle: tasks write what they read."""
    facts.sortWithinPartitions("element", "doc_id").write.mode(mode).option("compression", "zstd").parquet(path)


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """The parquet copy. Folders of landing batches add no column."""
    return spark.read.schema(FACTS).parquet(path).select(*FACTS.names)


def read_header_columns(spark: SparkSession, path: str) -> DataFrame:
    """Only what header look-ups need; the other columns are not read from parquet."""
    return read_facts(spark, path).select("doc_id", "entity_id", "element", "value", "src_ord")
