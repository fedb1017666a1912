"""Writers. Partitions write in parallel; nothing is brought to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the mark that tells spreadsheets the file is UTF-8.
BYTE_ORDER_MARK = "﻿"


def write_parquet(df: DataFrame, path: str, by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*by).parquet(path)


def write_statement_rows(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_parquet(rows, path, ("statement",), mode)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).option("escape", '"').csv(path)


#: Lines of a fact file. One task reads a file from end to end, so its size must not follow the corpus.
FACT_FILE_LINES = 20_000


def write_fact_files(lines: DataFrame, path: str, **options: object) -> None:
    """Lines of facts as UTF-16 files with tabs, in files of at most ``FACT_FILE_LINES`` lines."""
    lines.write.options(sep="\t", header=True, encoding="UTF-16", escape='"', **options).option(
        "maxRecordsPerFile", FACT_FILE_LINES
    ).csv(path)


def write_marked_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """CSV or TSV that spreadsheets open as UTF-8: a byte-order mark starts each file."""
    first = df.columns[0]
    marked = df.withColumnRenamed(first, BYTE_ORDER_MARK + first)
    marked.write.mode(mode).option("header", True).option("sep", sep).option(
        "escape", '"'
    ).option("emptyValue", "").csv(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object per line, non-ASCII kept, null fields kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


#: Filings of one company that one task writes; those of larger companies are dealt to several.
FILINGS_A_TASK = 100_000


def write_filing_metadata(filings: DataFrame, path: str, mode: str = "append") -> None:
    """Filing metadata by report type and company."""
    # A folder's rows meet, so that a folder is one file and not one per task. The work is in the number of folders, not
    # in bytes: Spark would deal few bytes to one task, so the number of tasks is given, and tasks move their own files to
    # their place (version 2) rather than the driver all of them. A run that breaks off leaves files and no _SUCCESS.
    keyed = filings.withColumn("entity_id", F.col("edinetCode"))
    large = keyed.groupBy("entity_id").count().filter(F.col("count") > FILINGS_A_TASK)
    parts = large.select("entity_id", F.ceil(F.col("count") / FILINGS_A_TASK).alias("parts"))
    part = F.coalesce(F.pmod(F.xxhash64("docID"), F.col("parts")), F.lit(0))
    dealt = keyed.join(parts, "entity_id", "left").repartition(
        4 * filings.sparkSession.sparkContext.defaultParallelism, "doc_type", "entity_id", part
    )
    dealt.select(*keyed.columns).write.mode(mode).partitionBy("doc_type", "entity_id").option(
        "ignoreNullFields", "false"
    ).option("mapreduce.fileoutputcommitter.algorithm.version", "2").json(path)


def write_judgements(judgements: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_json_lines(judgements, path, mode)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def register_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """A stored table of this name, replaced if there; kept at ``path`` or in the warehouse."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_log(log: DataFrame, path: str) -> None:
    """A log as CSV. An empty log keeps its header: Spark writes one file even for no rows."""
    write_csv(log, path)
