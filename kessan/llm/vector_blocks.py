"""Vectors in even blocks, and stated queries brought to the blocks.

A block holds about ``BLOCK`` vectors by a hash of their ids, and a group of queries at most
about ``QUERY_GROUP``, so a task has one block and one group at any size of the tables. Results
of the blocks are merged by rank within the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kessan.llm.columns import narrow
from kessan.session import written

BLOCK, QUERY_GROUP = 8192, 4096


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``key long, vector array<double>, size`` of rows with an id whose vector has finite
    components only. Vectors meet only vectors of their own length."""
    named = narrow(df, key=key, vector=vector).select(
        F.col("key").cast("long").alias("key"), F.col("vector").cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return named.filter(F.col("key").isNotNull() & (F.size("vector") > 0) & finite).withColumn("size", F.size("vector"))


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows``, written, with a number (``row``) that tells rows of equal ids apart."""
    return written(rows.withColumn("row", F.monotonically_increasing_id()), name)


def counts(rows: DataFrame) -> dict[int, int]:
    """Rows per vector length; lengths are few, whatever the table's size."""
    return {r["size"]: r["n"] for r in rows.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}


def by_size(values: dict[int, float], otherwise: float) -> Column:
    """A value per vector length, as an expression on ``size``."""
    out = F.lit(otherwise)
    for size, value in values.items():
        out = F.when(F.col("size") == size, F.lit(value)).otherwise(out)
    return out


def parts(rows: dict[int, int], per: int) -> Column:
    """How many parts of about ``per`` rows each length needs."""
    return by_size({size: max(1, -(-n // per)) for size, n in rows.items()}, 1)


def part_of(count: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64("key", F.lit(seed)), count.cast("long")).cast("int")


def every(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), count.cast("int") - 1))


def best(found: DataFrame, k: int, *order: Column) -> DataFrame:
    """``found`` (``query_row, query_id, vec_id, score``) ranked within each query, ``rank`` from 1 to ``k``."""
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(*order, "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_row", "query_id", "rank", "vec_id", "score")
