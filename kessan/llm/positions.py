"""Dense positions of the rows of a table in a given order, without a task that sees them all.

Rows are dealt out by ranges of the order, sorted within each range and written; a row's number
is its number within its range and the sizes of the ranges before. Only those sizes, one number
per range, reach the driver. Equal rows fall into one range, so an order should end in a column
that tells rows apart.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kessan.session import written

_WITHIN = 33  # bits that Spark's row ids spend on the number within a partition


def positioned(df: DataFrame, *order: Column, name: str = "positioned") -> DataFrame:
    """``df``, written, with ``position`` (long, from 0 without gaps) in the given order. ``df``
    is read twice, so it should be cheap or written."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(dealt.withColumn("position", F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned("position", _WITHIN).cast("int")
    sizes = {r["part"]: r["n"] for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return rows
    counts = [sizes.get(i, 0) for i in range(max(sizes) + 1)]
    before = F.lit([0, *accumulate(counts)][:-1]).cast("array<bigint>")
    within = F.col("position").bitwiseAND(F.lit((1 << _WITHIN) - 1))
    return rows.withColumn("position", F.get(before, part) + within)
