"""A landed corpus: facts, a manifest and the header side table, batch by batch.

A batch is one folder of each of the three tables, written over when an attempt is repeated, so
what a broken run left behind never counts twice. The two small tables lie in folders with an
underscore, which readers of the facts (``read_facts``) pass over. A filing lands as a whole file in one batch,
so its manifest and header rows are final. What is there, and what a filing's header says, is
read from the small tables; the facts are not opened for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kessan.functions import filters
from kessan.operators.facts import header_side
from kessan.schema import FACTS
from kessan.session import shuffles_removed

MANIFEST = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("entity_id", T.StringType()),
    T.StructField("file", T.StringType()), T.StructField("file_bytes", T.LongType()), T.StructField("n_rows", T.LongType()),
])


def manifest_of(facts: DataFrame) -> DataFrame:
    """``doc_id, entity_id, file, file_bytes, n_rows`` per filing and file. ``path`` and
    ``file_bytes`` of ``facts`` are taken where it has them."""
    spare = {"path": F.lit(None).cast("string"), "file_bytes": F.lit(None).cast("long")}
    told = facts.withColumns({name: none for name, none in spare.items() if name not in facts.columns})
    return told.groupBy("doc_id", "entity_id", F.col("path").alias("file"), "file_bytes").agg(
        F.count(F.lit(1)).alias("n_rows")
    ).select(*MANIFEST.names)


def land_batch(facts: DataFrame, root: str, batch: int) -> None:
    """One batch of facts, with its manifest and header rows."""
    spark, place = facts.sparkSession, f"batch={batch}"
    extra = [c for c in ("path", "file_bytes") if c in facts.columns]
    facts.select(*FACTS.names, *extra).sortWithinPartitions("element", "doc_id").write.mode("overwrite").parquet(
        f"{root}/{place}"
    )
    landed = spark.read.parquet(f"{root}/{place}")
    manifest_of(landed).write.mode("overwrite").parquet(f"{root}/_manifest/{place}")
    header_side(landed).write.mode("overwrite").parquet(f"{root}/_headers/{place}")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """What is landed: a row per filing and file, with its ``batch``."""
    batch = T.StructField("batch", T.IntegerType())
    return spark.read.schema(T.StructType([*MANIFEST.fields, batch])).parquet(f"{root}/_manifest")


def read_headers(spark: SparkSession, root: str) -> DataFrame:
    """The header side table, as ``header_side`` gives it."""
    return spark.read.parquet(f"{root}/_headers").drop("batch")


def land_by_filing(facts: DataFrame, table: str, buckets: int, rounds: int = 1) -> None:
    """Facts as a table of ``buckets`` buckets by filing, with the stored ``local_name`` that
    vocabularies are joined on. ``statements(read_by_filing(...), placed=True)`` shuffles nothing.

    Facts of the same texts are sent next to each other, by one sort on a number, and these texts as one
    column, so that they are compressed away in the shuffle; ``local_name`` is made behind it.
    ``rounds``: the facts are read that many times, each time for other buckets, and the shuffle of a round is
    removed before the next one, so that no more than a part of the facts lies on the disk twice."""
    bucket = F.pmod(F.hash("doc_id"), F.lit(buckets))  # as the writer deals them
    for n in range(rounds):
        _land_buckets(facts.filter(bucket % rounds == n) if rounds > 1 else facts, table, buckets, "append" if n else "overwrite")


def _land_buckets(facts: DataFrame, table: str, buckets: int, mode: str) -> None:
    own = [c for c in facts.columns if c in ("doc_id", "value", "src_ord")]
    shared = [c for c in facts.columns if c not in own]
    near = facts.select(*own, F.struct(*shared).alias("shared")).sortWithinPartitions(F.xxhash64("shared"))
    # Without a step between them, a sort is dropped below the later one of the writer.
    counted = near.observe("facts_sent", F.count(F.lit(1)).alias("n"))
    placed = counted.repartition(buckets, "doc_id").select(*own, "shared.*")
    named = placed.select(*facts.columns, filters.local_name(F.col("element")).alias("local_name"))
    with shuffles_removed(facts.sparkSession):
        named.write.mode(mode).option("compression", "zstd").bucketBy(buckets, "doc_id").sortBy(
            "local_name", "doc_id"
        ).format("parquet").saveAsTable(table)


def read_by_filing(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.table(table)
