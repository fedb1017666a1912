"""Exports: statement figures by template and in full, wide and long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kessan.functions.filters import is_filled
from kessan.functions.numbers import normalize_number, sum_present, to_int, to_places
from kessan.operators.joins import with_facts
from kessan.operators.select import last_periods, latest_per_period
from kessan.operators.tables import slot_pivot
from kessan.small import INT, TEXT, small_table

# Labels under which an item may appear, best first.
CANDIDATES = {
    "当期純利益": ("当期純利益", "当期利益", "親会社株主に帰属する当期純利益", "親会社株主に帰属する当期利益"),
    "現金預金": ("現金及び預金", "現金及び預金（流動資産）", "現金預金"),
    "売上債権（合計）": ("受取手形及び売掛金", "売掛金及び受取手形", "売上債権（合計）", "売上債権"),
    "仕入債務（合計）": ("支払手形及び買掛金", "買掛金及び支払手形", "仕入債務（合計）", "仕入債務"),
    "棚卸資産（合計）": ("棚卸資産（合計）", "棚卸資産"),
    "総資産": ("総資産", "資産合計"),
    "純資産": ("純資産",),
    "有価証券（流動資産）": ("有価証券（流動資産）", "有価証券"),
    "原材料": ("原材料", "原材料及び貯蔵品"),
    "貯蔵品": ("貯蔵品", "原材料及び貯蔵品"),
    "発行済株式数": ("発行済株式総数", "発行済株式数"),
    "EPS（1株当たり利益）": ("１株当たり当期純利益", "１株当たり当期利益"),
    "DPS（1株当たり配当）": ("１株当たり配当額",),
}
# Statement an item is taken from. An item in none is looked up in both.
FROM_INCOME = (
    "売上高", "売上原価", "営業利益", "営業外収益", "営業外費用", "支払利息", "当期純利益", "当期利益",
)
FROM_BALANCE = (
    "流動資産", "流動負債", "現金預金", "売掛金", "受取手形", "電子記録債権", "買掛金", "支払手形",
    "電子記録債務", "有価証券（流動資産）", "棚卸資産（合計）", "商品", "製品", "原材料", "仕掛品",
    "半製品", "貯蔵品", "総資産", "純資産", "新株予約権", "非支配株主持分", "有利子負債", "固定負債",
    "有形固定資産", "売上債権（合計）", "仕入債務（合計）",
)
# Items filled by hand or from elsewhere, always blank here.
NOT_FILLED = ("株価", "EPS（1株当たり利益）", "DPS（1株当たり配当）", "発行済株式数")
# Items with two decimals; all others are whole.
DECIMAL_ITEMS = ("EPS（1株当たり利益）", "DPS（1株当たり配当）", "株価")
# Parts (each with its labels, best first) summed up where a total is missing.
# The inventory parts overlap, as published: 商品及び製品 and 原材料及び貯蔵品 may count twice.
TOTALS = {
    "棚卸資産（合計）": (
        ("商品", "商品及び製品"),
        ("製品", "商品及び製品"),
        ("原材料", "原材料及び貯蔵品"),
        ("仕掛品",),
        ("半製品",),
        ("貯蔵品", "原材料及び貯蔵品"),
    ),
    "売上債権（合計）": (("売掛金",), ("受取手形",), ("電子記録債権",)),
    "仕入債務（合計）": (("買掛金",), ("支払手形",), ("電子記録債務",)),
    "有利子負債": (
        ("短期借入金",),
        ("1年内返済予定の長期借入金",),
        ("長期借入金",),
        ("社債",),
        ("リース債務",),
        ("リース債務（流動負債）",),
        ("リース債務（固定負債）",),
    ),
}
PERIOD = "CurrentYear"
MOST_PARTS = max(len(parts) for parts in TOTALS.values())


def routes(items: Sequence[str]) -> list[tuple[str, str, str, str, int]]:
    """``(target, statement, item, part, rank)``: where a template item looks. Part ``PL`` or
    ``BS`` is the item itself, ``0, 1, ..`` a part of its total."""
    rows = []
    for target in dict.fromkeys(items):
        labels = CANDIDATES.get(target, (target,))
        if target in FROM_INCOME:
            sources = ("PL",)
        elif target in FROM_BALANCE:
            sources = ("BS",)
        elif target in NOT_FILLED:
            sources = ()
        else:
            sources = ("PL", "BS")
        for source in sources:
            rows += [(target, source, label, source, rank) for rank, label in enumerate(labels)]
        for place, part in enumerate(TOTALS.get(target, ())):
            rows += [(target, "BS", label, str(place), rank) for rank, label in enumerate(part)]
    return rows


def candidate_values(parsed: DataFrame, items: Sequence[str]) -> DataFrame:
    """Per filing, target and part: the current-year value of the first label that is there,
    also if that value is missing. ``doc_id, target, part, value``."""
    table = small_table(
        parsed.sparkSession, routes(items), target=TEXT, statement=TEXT, item=TEXT, part=TEXT, rank=INT
    )
    current = parsed.filter((F.col("period") == PERIOD) & F.col("statement").isin("PL", "BS"))
    # The value goes inside a struct: min_by would pass over a label whose value is null.
    first = F.min_by(F.struct("value"), "rank")["value"]
    return (
        current.join(table, ["statement", "item"])
        .groupBy("doc_id", "target", "part")
        .agg(first.alias("value"))
    )


def template_values(parsed: DataFrame, items: Sequence[str]) -> DataFrame:
    """``doc_id, target, number``: the item, else the sum of the parts of its total."""
    found = candidate_values(parsed, items)

    def part(name: str):
        return F.max(F.when(F.col("part") == name, F.col("value")))

    wide = found.groupBy("doc_id", "target").agg(
        part("PL").alias("pl"), part("BS").alias("bs"),
        *(part(str(place)).alias(f"part_{place}") for place in range(MOST_PARTS)),
    )
    itself = F.coalesce("pl", "bs")
    parts = sum_present([normalize_number(F.col(f"part_{place}")) for place in range(MOST_PARTS)])
    return wide.select(
        "doc_id", "target",
        F.when(itself.isNotNull(), normalize_number(itself)).otherwise(parts).alias("number"),
    )


def template_slots(filings: DataFrame, years: int) -> DataFrame:
    """The last ``years`` filings of each company by submission, slot ``Y1`` being the oldest."""
    from pyspark.sql import window as W

    company = W.Window.partitionBy("edinetCode")
    time = F.coalesce("submitDateTime", F.lit(""))
    newest = F.row_number().over(company.orderBy(F.desc(time), F.desc("docID")))
    kept = filings.withColumn("_r", newest).filter(F.col("_r") <= years).drop("_r")
    return kept.withColumn(
        "slot", F.concat(F.lit("Y"), F.row_number().over(company.orderBy(time, "docID")).cast("string"))
    )


def template_long(slots: DataFrame, values: DataFrame, items: Sequence[str]) -> DataFrame:
    """Every template row for every chosen filing, blank or not:
    ``edinetCode, place, target, slot, value``. Blank template rows are skipped."""
    numbered = F.array(
        *(F.struct(F.lit(place).alias("place"), F.lit(item.strip()).alias("target")) for place, item in enumerate(items))
    )
    rows = slots.select(
        "edinetCode", "slot", F.col("docID").alias("doc_id"), F.inline(numbered)
    ).filter(is_filled(F.col("target")))
    joined = rows.join(values, ["doc_id", "target"], "left")
    shown = F.when(
        F.col("target").isin(*DECIMAL_ITEMS), to_places(F.col("number"), 2).cast("string")
    ).otherwise(to_int(F.col("number")).cast("string"))
    return joined.select("edinetCode", "place", "target", "slot", "doc_id", shown.alias("value"))


def template_table(long: DataFrame, years: int) -> DataFrame:
    """The filled template: ``edinetCode, place, target, Y1..Yn``."""
    return slot_pivot(long, ["edinetCode", "place", "target"], [f"Y{n}" for n in range(1, years + 1)])


def never_filled(long: DataFrame) -> DataFrame:
    """Items with no figure in any chosen year of a company (hand-filled items aside)."""
    return (
        long.filter(~F.col("target").isin(*NOT_FILLED))
        .groupBy("edinetCode", "target")
        .agg(F.bool_and(F.col("value").isNull()).alias("blank"))
        .filter("blank")
        .select("edinetCode", F.col("target").alias("missing_items"))
    )


def slot_labels(slots: DataFrame) -> DataFrame:
    """Which filing each slot is."""
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return slots.select(
        "edinetCode", F.col("slot").alias("Y"), F.col("docID").alias("doc_id"),
        text("submitDateTime"), text("docDescription"),
    )


def chosen_periods(filings: DataFrame, facts: DataFrame, years: int, landed: DataFrame | None = None) -> DataFrame:
    """The filings of the full export: those with facts, the last per period end, the last
    ``years`` period ends. ``landed``: the manifest, which saves a scan of the facts."""
    there = facts.select("doc_id").distinct() if landed is None else landed
    return last_periods(latest_per_period(with_facts(filings, there)), years)


def full_long(chosen: DataFrame, parsed: DataFrame) -> DataFrame:
    """Every statement item of a company at each of its chosen period ends:
    ``edinet_code, statement, item, slot, periodEnd, value``; blank where a filing lacks the item."""
    slots = chosen.select(F.col("docID").alias("doc_id"), "edinetCode", "slot", "periodEnd")
    rows = parsed.filter(F.col("statement").isin("PL", "BS")).join(slots.drop("periodEnd"), "doc_id")
    # A filing has one value per item and period, so a company's item has at most one entry per
    # slot; items without a current value keep an empty map.
    entry = F.when(F.col("period") == PERIOD, F.struct("slot", "value"))
    items = rows.groupBy("edinetCode", "statement", "item").agg(
        F.map_from_entries(F.collect_list(entry)).alias("figures")
    )
    periods = slots.groupBy("edinetCode").agg(F.collect_list(F.struct("slot", "periodEnd")).alias("periods"))
    cells = items.join(periods, "edinetCode").select(
        F.col("edinetCode").alias("edinet_code"), "statement", "item", "figures", F.inline("periods")
    )
    figure = to_int(normalize_number(F.try_element_at("figures", "slot")))
    return cells.select(
        "edinet_code", "statement", "item", "slot", "periodEnd", figure.cast("string").alias("value")
    )


def full_wide(long: DataFrame, period_ends: Sequence[str]) -> DataFrame:
    """``edinet_code, statement, item`` and one column per period end."""
    return slot_pivot(long, ["edinet_code", "statement", "item"], period_ends, "periodEnd")


def period_ends(long: DataFrame, most: int = 4000) -> list[str]:
    """The period ends there are, in order: the columns of the wide export. A table of more than
    ``most`` columns is refused rather than cut; eleven years of days are fewer."""
    ends = sorted(r["periodEnd"] for r in long.select("periodEnd").distinct().limit(most + 1).collect())
    if len(ends) > most:
        raise ValueError(f"more than {most} period ends: use the long export")
    return ends


def full_wide_slots(long: DataFrame, years: int) -> DataFrame:
    """As ``full_wide`` with columns ``Y1..Yn``: companies end their years on different days."""
    named = long.withColumn("slot", F.concat(F.lit("Y"), F.col("slot").cast("string")))
    return slot_pivot(named, ["edinet_code", "statement", "item"], [f"Y{n}" for n in range(1, years + 1)])


def combined_long(long: DataFrame) -> DataFrame:
    return long.select("edinet_code", "statement", F.col("item").alias("項目"), "periodEnd", "value")


def period_labels(chosen: DataFrame) -> DataFrame:
    return chosen.select(
        "edinetCode", F.col("periodEnd").alias("col"), F.col("docID").alias("doc_id"),
        "periodEnd", "submitDateTime", "docDescription",
    )


def item_union(parsed: DataFrame, entities: DataFrame) -> DataFrame:
    """Distinct items per company and statement."""
    return parsed.join(entities, "doc_id").select("entity_id", "statement", "item").distinct()
