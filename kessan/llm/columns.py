"""Column names that cannot clash with those of the caller's table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def narrow(df: DataFrame, **columns: str):
    """Only the named columns, under the operator's own names: ``narrow(df, key="doc_id")``."""
    return df.select(*(F.col(quoted(source)).alias(target) for target, source in columns.items()))


def with_replaced(df: DataFrame, **columns):
    """``df`` with columns set, in their old place where they exist."""
    out = []
    for name in df.columns:
        out.append(columns.pop(name).alias(name) if name in columns else F.col(quoted(name)))
    return df.select(*out, *(c.alias(name) for name, c in columns.items()))


def mapped(df: DataFrame, work, schema: T.StructType) -> DataFrame:
    """``df.mapInArrow(work, schema)`` for columns of any names: batches go in and out under names
    by position (``c0``, ``c1``, ...), for Arrow takes a dot in a name for a field of a struct."""
    into = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    fields = [T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(schema.fields)]
    return into.mapInArrow(work, T.StructType(fields)).toDF(*schema.fieldNames())
