"""Fixed small tables as local relations: their size is in the plan, so Spark itself decides
to broadcast them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def small_table(spark: SparkSession, rows: list[tuple], **columns: pa.DataType) -> DataFrame:
    """``rows`` as a table with the given columns, in order."""
    data = list(zip(*rows)) if rows else [[] for _ in columns]
    arrays = [pa.array(values, type=kind) for values, kind in zip(data, columns.values())]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(columns)))


TEXT = pa.string()
INT = pa.int32()
LONG = pa.int64()
