"""Fact files to the parquet copy, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from kessan.schema import FACT_FILE
from kessan.sources.facts import FACT_FILE_OPTIONS, named_facts
from kessan.sources.lake import land_batch


def land_new_fact_files(
    spark: SparkSession, source: str, target: str, state: str, max_files: int = 10_000
) -> StreamingQuery:
    """Land the fact files that appeared since the last run, then stop.

    The checkpoint in ``state`` remembers which files were read, so a second run takes only
    new ones. A batch is a folder of each table of the lake ``target`` (facts, and in
    ``sources.lake`` the manifest and the header side table) that a repeated attempt overwrites, so a run that broke off lands
    nothing twice. ``source`` is a folder pattern like
    ``corpus/annual/*``; ``state`` and ``target`` must be on storage all executors reach.
    """
    files = (
        spark.readStream.schema(FACT_FILE)
        .options(**FACT_FILE_OPTIONS)
        .option("maxFilesPerTrigger", max_files)
        .csv(source)
        .withColumns({"path": F.col("_metadata.file_path"), "file_bytes": F.col("_metadata.file_size")})
    )

    def land(batch: DataFrame, number: int) -> None:
        # Tasks still hold whole files in their order here, so rows can be numbered.
        numbered = batch.withColumn("src_ord", F.monotonically_increasing_id())
        land_batch(named_facts(numbered, "path", "file_bytes"), target, number)

    return (
        files.writeStream.foreachBatch(land)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
