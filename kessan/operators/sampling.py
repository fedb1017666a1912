"""Repeatable random choice: rows in the order of a seeded hash of their key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

SEED = "42"
#: Hex digits of the hash that name a bucket: 65,536 buckets per group.
BUCKET_DIGITS = 4


def hash_order(key: Column, seed: str = SEED) -> Column:
    """Sort key of the random order; the same in every run and on every cluster."""
    return F.md5(F.concat_ws("|", F.lit(seed), key))


def first_per_group(
    df: DataFrame, group: str, key: str, n: int = 1, seed: str = SEED
) -> DataFrame:
    """``n`` random rows per group.

    ``row_number() <= n`` is cut to ``n`` rows per group before the shuffle, so a group
    with a third of all rows sends no more than the others.
    """
    order = W.Window.partitionBy(group).orderBy(hash_order(F.col(key), seed), key)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).drop("rank")


def positions(
    df: DataFrame, key: str, group: tuple[str, ...] = (), seed: str = SEED, upto: int | None = None
) -> DataFrame:
    """``df`` with ``position``: place of the row in hash order within its group, from 1, and
    ``group_size``. With ``upto`` only rows up to that place come out.

    The order is cut into buckets by the first digits of the hash. Buckets are counted,
    the counts are summed up over buckets (at most 65,536 rows per group), and rows are
    ranked only within their bucket, so no task sorts a whole group. Keys must be unique.
    """
    hashed = df.withColumn("_h", hash_order(F.col(key), seed)).withColumn(
        "_b", F.substring("_h", 1, BUCKET_DIGITS)
    )
    counts = hashed.groupBy(*group, "_b").agg(F.count("*").alias("_n"))
    along = W.Window.partitionBy(*group).orderBy("_b")
    whole = W.Window.partitionBy(*group)
    starts = counts.select(
        *group,
        "_b",
        (F.sum("_n").over(along) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("group_size"),
    )
    if upto is not None:  # whole buckets beyond the last place are dropped before the ranking
        starts = starts.filter(F.col("_before") < upto)
    within = W.Window.partitionBy(*group, "_b").orderBy("_h", key)
    ranked = (
        hashed.join(starts, [*group, "_b"])
        .withColumn("position", F.col("_before") + F.row_number().over(within))
        .drop("_h", "_b", "_before")
    )
    return ranked if upto is None else ranked.filter(F.col("position") <= upto)


def take(df: DataFrame, key: str, n: int, seed: str = SEED) -> DataFrame:
    """The first ``n`` rows in hash order, cut by the counts of hash buckets: no task sees them all."""
    return positions(df, key, seed=seed, upto=n).drop("position", "group_size")


def balance(
    df: DataFrame, label: str, key: str, seed: str = SEED, within: tuple[str, ...] = ()
) -> DataFrame:
    """As many random rows of each class as the smallest class has (in each part of ``within``)."""
    sizes = df.groupBy(*within, label).agg(F.count("*").alias("_n"))
    # One row per class, so the window over all of them is small.
    least = F.min("_n").over(W.Window.partitionBy(*(within or (F.lit(0),))))
    smallest = sizes.select(*within, label, least.alias("_least"))
    group = (*within, label)
    ranked = positions(df, key, group, seed).join(smallest, list(group))
    return ranked.filter(F.col("position") <= F.col("_least")).drop("position", "group_size", "_least")


def split_by_group(df: DataFrame, group: str, test_share: float = 0.2, seed: str = SEED) -> DataFrame:
    """``df`` with ``split``: a random share of the groups is ``test``, the others ``train``;
    no group is in both."""
    groups = positions(df.select(group).distinct(), group, seed=seed)
    is_test = F.col("position") <= F.ceil(F.col("group_size") * F.lit(test_share))
    marks = groups.select(group, F.when(is_test, "test").otherwise("train").alias("split"))
    return df.join(marks, group)


def split_by_year(df: DataFrame, year: Column, first_test_year: int = 2020) -> DataFrame:
    return df.withColumn("split", F.when(year < first_test_year, "train").otherwise("test"))
