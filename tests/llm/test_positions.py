from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kessan.llm.positions import positioned


@pytest.mark.parametrize("apart", [True, False])
def test_positions_are_dense_and_in_order(spark, apart):
    """Over several ranges, of which a hot value's are some, and over one."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, str(not apart).lower())
    try:
        rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 97).alias("a"), F.col("id").alias("b"))
        got = positioned(rows.repartition(6), F.col("a").desc(), F.col("b")).collect()
    finally:
        spark.conf.unset(name)
    want = sorted(((i, 7 if i % 3 == 0 else i % 97) for i in range(5000)), key=lambda r: (-r[1], r[0]))
    assert [(r["b"], r["a"]) for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(5000))


def test_no_rows(spark):
    assert positioned(spark.range(0).toDF("a"), F.col("a")).count() == 0
