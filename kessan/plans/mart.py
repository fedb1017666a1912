"""Statement rows to the ratio mart and the three-year table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kessan.operators.joins import near_matches
from kessan.operators.select import pick
from kessan.operators.tables import MART_ITEMS, period_pivot, statement_rows, with_ratios, with_scaled
from kessan.plans.statements import statements


def mart(rows: DataFrame) -> DataFrame:
    """``doc_id, period`` and the five figures of balance sheet and income statement."""
    return period_pivot(rows.filter("statement IN ('BS', 'PL')"), MART_ITEMS)


def mart_of_facts(facts: DataFrame, vocab: DataFrame | None = None, few_copies: bool = False) -> DataFrame:
    """From facts to the mart with its ratios, in one job. ``few_copies`` as in ``statements``."""
    rows = statement_rows(statements(facts, vocab, only=("BS", "PL"), few_copies=few_copies))
    # Both statements are in ``rows``: one scan serves them.
    return with_ratios(period_pivot(rows, MART_ITEMS))


def three_years(mart_rows: DataFrame, entities: DataFrame) -> DataFrame:
    """Per company the rows ``t-2, t-1, t0`` of its mart.

    ``t0`` and ``t-1`` come from the filing with the largest current sales, ``t-2`` from the
    earlier filing whose current sales are that filing's prior sales; companies without such
    a filing are left out. ``entities``: ``doc_id, entity_id``.
    """
    figures = list(MART_ITEMS)
    keyed = mart_rows.filter(F.col("period").isin("CurrentYear", "Prior1Year")).select(
        "doc_id", "period", *figures
    ).join(entities, "doc_id")
    # A filing has at most one row per period: both sides of a filing on one row.
    value = F.struct(*figures)
    wide = keyed.groupBy("entity_id", "doc_id").agg(
        F.max(F.when(F.col("period") == "CurrentYear", value)).alias("current"),
        F.max(F.when(F.col("period") == "Prior1Year", value)).alias("prior"),
    )
    sold = wide.filter(F.col("current.sales").isNotNull())
    newest = pick(
        sold, ["entity_id"], [F.col("current.sales"), F.col("doc_id")], ["doc_id", "current", "prior"]
    )
    matched = near_matches(
        wide.select("entity_id", "doc_id", F.col("current.sales").alias("amount")),
        newest.filter(F.col("prior.sales").isNotNull()).select(
            "entity_id", "doc_id", F.col("prior.sales").alias("amount")
        ),
    ).select("entity_id", "doc_id", "match_doc")
    older = wide.select("entity_id", F.col("doc_id").alias("match_doc"), F.col("prior").alias("older"))
    chain = newest.join(matched, ["entity_id", "doc_id"]).join(older, ["entity_id", "match_doc"]).filter(
        F.col("older").isNotNull()
    )
    steps = F.array(
        F.struct(F.lit("t-2").alias("t"), F.col("match_doc").alias("doc_id"), F.col("older").alias("v")),
        F.struct(F.lit("t-1").alias("t"), F.col("doc_id"), F.col("prior").alias("v")),
        F.struct(F.lit("t0").alias("t"), F.col("doc_id"), F.col("current").alias("v")),
    )
    rows = chain.select("entity_id", F.inline(steps)).select("entity_id", "t", "doc_id", "v.*")
    return with_scaled(with_ratios(rows))
