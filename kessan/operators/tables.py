"""Statement rows to wide tables and back, and look-ups in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kessan.functions.numbers import ratio, to_double

# Mart column by statement item.
MART_ITEMS = {
    "sales": "売上高",
    "op_profit": "営業利益",
    "net_income": "当期利益",
    "total_assets": "総資産",
    "equity": "純資産",
}
# Order of periods in reports; all others come last.
REPORT_ORDER = ("Prior2Year", "Prior1Year", "CurrentYear")


def statement_rows(statements: DataFrame) -> DataFrame:
    """Statement values with a numeric column (null where the text is no number)."""
    return statements.filter(F.col("statement") != "META").select(
        "doc_id", "statement", "item", "period", "value", to_double(F.col("value")).alias("value_num")
    )


def both_statements(bs: DataFrame, pl: DataFrame) -> DataFrame:
    columns = ["doc_id", "period", "item", "value_num"]
    return bs.select(*columns).unionByName(pl.select(*columns))


def period_pivot(rows: DataFrame, items: dict[str, str], keys: Sequence[str] = ("doc_id", "period")) -> DataFrame:
    """One row per key, one column per item: the largest value of the item."""
    return rows.groupBy(*keys).agg(
        *(F.max(F.when(F.col("item") == item, F.col("value_num"))).alias(name) for name, item in items.items())
    )


def with_ratios(mart: DataFrame) -> DataFrame:
    """Margin, return on assets and equity ratio; null over zero."""
    return mart.select(
        "*",
        ratio(F.col("op_profit"), F.col("sales")).alias("op_margin"),
        ratio(F.col("net_income"), F.col("total_assets")).alias("roa"),
        ratio(F.col("equity"), F.col("total_assets")).alias("equity_ratio"),
    )


def with_scaled(mart: DataFrame) -> DataFrame:
    """Sales in units of 1e8 yen and ratios in percent."""
    return mart.select(
        "*",
        (F.col("sales") / 1e8).alias("sales_oku"),
        (F.col("op_margin") * 100).alias("op_margin_pct"),
        (F.col("roa") * 100).alias("roa_pct"),
        (F.col("equity_ratio") * 100).alias("equity_ratio_pct"),
    )


def report_place(period: Column) -> Column:
    """Place of a period in a report: 1, 2, 3, or 9 for any other."""
    chain = None
    for place, name in enumerate(REPORT_ORDER, 1):
        hit = period == name
        chain = F.when(hit, place) if chain is None else chain.when(hit, place)
    return chain.otherwise(9)


def in_order(rows: DataFrame, *order: str | Column) -> DataFrame:
    """Rows of filings in order. Spark reads the rows once more to find the borders of the ranges; they are placed
    first, so that it reads the few rows there are, and does not make them again. (By the order, since rows that lie by
    filing already would not be placed by filing again.)"""
    return rows.repartition(*order).orderBy(*order)


def find_items(rows: DataFrame, part: str, limit: int | None = None) -> DataFrame:
    """Distinct items with ``part`` in their name, in order, the first ``limit`` of them."""
    found = rows.filter(F.col("item").contains(part)).select("item").distinct().orderBy("item")
    return found.limit(limit) if limit else found


def items_of(rows: DataFrame, doc_id: str, period: str, items: Sequence[str]) -> DataFrame:
    """Values of some items of one filing and period."""
    return rows.filter(
        (F.col("doc_id") == doc_id) & (F.col("period") == period) & F.col("item").isin(*items)
    ).select("item", "value_num").orderBy("item")


def item_over_time(rows: DataFrame, item: str) -> DataFrame:
    return in_order(rows.filter(F.col("item") == item).select("doc_id", "period", "value_num"), "period", "doc_id")


def slot_pivot(rows: DataFrame, keys: Sequence[str], slots: Sequence[str], slot: str = "slot", value: str = "value") -> DataFrame:
    """One column per slot, named as given; the list is passed, so no extra pass finds it."""
    return rows.groupBy(*keys).pivot(slot, list(slots)).agg(F.first(value))


def wide_to_long(wide: DataFrame, keys: Sequence[str], var: str = "periodEnd", value: str = "value", **literals: str) -> DataFrame:
    """Columns other than ``keys`` to rows, with literal columns in front."""
    others = [c for c in wide.columns if c not in keys]
    long = wide.unpivot(list(keys), others, var, value)
    return long.select(*(F.lit(v).alias(k) for k, v in literals.items()), *keys, var, value)


def slot_order(name: Column) -> Column:
    """Place of a column ``Y1..Yn`` by its number; others last."""
    number = F.regexp_extract(name, r"^Y([0-9]+)", 1)
    return F.coalesce(F.nullif(number, F.lit("")).cast("int"), F.lit(999))


def distinct_codes(codes: Column) -> Column:
    """Comma-separated codes without blanks and repeats, in order."""
    parts = F.transform(F.split(codes, ","), lambda c: F.trim(c))
    return F.array_distinct(F.filter(parts, lambda c: c != ""))


def present(df: DataFrame, *names: str, kind: str = "string") -> Column:
    """The first non-null of the columns that exist."""
    found = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast(T.StringType() if kind == "string" else kind)
