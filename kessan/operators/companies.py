"""Operators on companies: search, selection with reasons, industry groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kessan.functions.filters import excluded_by
from kessan.small import TEXT, small_table

# Industries left out of the target companies.
EXCLUDED_INDUSTRIES = (
    "銀行業",
    "保険業",
    "証券、商品先物取引業",
    "その他金融業",
    "-",
)
# Markets left out of the target companies.
EXCLUDED_MARKETS = (
    "ETF・ETN",
    "PRO Market",
    "REIT・ベンチャーファンド",
    "出資証券",
)
# Words in a market name that leave it out.
EXCLUDED_MARKET_WORDS = ("ETF", "ETN", "REIT")

# Group of each industry.
INDUSTRY_GROUPS = {
    "水産・農林業": "食品",
    "食料品": "食品",
    "鉱業": "電気・ガス・エネルギー資源",
    "石油・石炭製品": "電気・ガス・エネルギー資源",
    "建設業": "建設・資材",
    "金属製品": "建設・資材",
    "ガラス・土石製品": "建設・資材",
    "繊維製品": "素材・化学",
    "パルプ・紙": "素材・化学",
    "化学": "素材・化学",
    "医薬品": "医薬品",
    "ゴム製品": "自動車・輸送機",
    "輸送用機器": "自動車・輸送機",
    "鉄鋼": "鉄鋼・非鉄",
    "非鉄金属": "鉄鋼・非鉄",
    "機械": "機械",
    "電気機器": "電機・精密",
    "精密機器": "電機・精密",
    "その他製品": "情報通信・サービスその他",
    "情報・通信業": "情報通信・サービスその他",
    "サービス業": "情報通信・サービスその他",
    "電気・ガス業": "電気・ガス・エネルギー資源",
    "陸運業": "運輸・物流",
    "海運業": "運輸・物流",
    "空運業": "運輸・物流",
    "倉庫・運輸関連": "運輸・物流",
    "卸売業": "商社・卸売",
    "小売業": "小売",
    "銀行業": "銀行",
    "証券、商品先物取引業": "金融(除く銀行)",
    "保険業": "金融(除く銀行)",
    "その他金融業": "金融(除く銀行)",
    "不動産業": "不動産",
}
# English name of each group.
GROUP_NAMES_EN = {
    "食品": "Food",
    "電気・ガス・エネルギー資源": "Energy",
    "建設・資材": "Construction",
    "素材・化学": "Materials",
    "医薬品": "Pharma",
    "自動車・輸送機": "Auto",
    "鉄鋼・非鉄": "Steel/Metal",
    "機械": "Machinery",
    "電機・精密": "Electronics",
    "情報通信・サービスその他": "IT & Services",
    "運輸・物流": "Logistics",
    "商社・卸売": "Trading",
    "小売": "Retail",
    "銀行": "Banks",
    "金融(除く銀行)": "Finance",
    "不動産": "Real Estate",
}
# Fixed value: companies not obliged to report, skipped before grouping.
NOT_OBLIGED = "内国法人・組合（有価証券報告書等の提出義務者以外）"
OTHER = "その他"
INVALID = "invalid"


def search(companies: DataFrame, pattern: str) -> DataFrame:
    """Companies whose name matches a regular expression."""
    return companies.filter(F.col("name").rlike(pattern)).select("name", "entity_id", "industry")


def entity_code(companies: DataFrame, name: str) -> DataFrame:
    """The code of the company of exactly this name (the smallest of several)."""
    hits = companies.filter(F.col("name") == name).select("entity_id")
    return hits.orderBy("entity_id").limit(1)


def recode(df: DataFrame, column: str, mapping: dict[str, str], default: str, alias: str) -> DataFrame:
    """``alias``: the mapped value of ``column``, or ``default``."""
    table = small_table(df.sparkSession, list(mapping.items()), **{column: TEXT, alias: TEXT})
    return df.join(table, column, "left").withColumn(alias, F.coalesce(alias, F.lit(default)))


def industry_histogram(companies: DataFrame) -> DataFrame:
    """Companies per industry group, by English name; ungrouped ones are left out."""
    grouped = recode(companies, "industry", INDUSTRY_GROUPS, OTHER, "industry_group")
    known = grouped.filter(F.col("industry_group") != OTHER)
    named = recode(known, "industry_group", GROUP_NAMES_EN, OTHER, "group_name")
    return named.groupBy("group_name").agg(F.count("*").alias("n")).orderBy("n", "group_name")


def filings_per_company(filings: DataFrame) -> DataFrame:
    """Number of filings per company with the name on its last submission."""
    name = F.max_by("filerName", F.struct(F.coalesce("submitDateTime", F.lit("")), "docID"))
    return filings.groupBy(F.col("edinetCode").alias("edinet_code")).agg(
        F.coalesce(name, F.lit("Unknown")).alias("company_name"), F.count("*").alias("file_count")
    )


def complete(counts: DataFrame, threshold: int = 10) -> DataFrame:
    return counts.filter(F.col("file_count") >= threshold)


def incomplete(counts: DataFrame, threshold: int = 10) -> DataFrame:
    return counts.filter(F.col("file_count") < threshold)


def selection(companies: DataFrame, listing: DataFrame) -> DataFrame:
    """Each company of a list with its exchange entry and the first reason against it, if any.

    ``companies``: ``edinet_code, company_name, file_count, sec_code`` (null: not listed).
    """
    entry = listing.select(
        F.col("code").alias("sec_code"),
        F.col("name").alias("listed_name"),
        F.col("industry"),
        F.col("market"),
        F.lit(True).alias("listed"),
    )
    joined = companies.join(entry, "sec_code", "left")
    word = F.lit(False)
    for text in EXCLUDED_MARKET_WORDS:
        word = word | F.col("market").contains(text)
    reason = (
        F.when(F.coalesce("sec_code", F.lit("")) == "", "No SecCode (Unlisted?)")
        .when(F.col("listed").isNull(), "Not in Tosho List")
        .when(
            excluded_by(F.col("industry"), EXCLUDED_INDUSTRIES),
            F.concat(F.lit("Industry: "), "industry"),
        )
        .when(excluded_by(F.col("market"), EXCLUDED_MARKETS), F.concat(F.lit("Market: "), "market"))
        .when(word, F.concat(F.lit("Market Keyword: "), "market"))
    )
    return joined.select(
        "edinet_code",
        F.coalesce("sec_code", F.lit("")).alias("sec_code"),
        F.coalesce("listed_name", "company_name", F.lit("Unknown")).alias("company_name"),
        F.coalesce("industry", F.lit("-")).alias("industry"),
        F.coalesce("market", F.lit("-")).alias("market"),
        "file_count",
        reason.alias("reason"),
    )


def without_industries(companies: DataFrame, excluded: tuple[str, ...] = ()) -> DataFrame:
    """Companies outside the excluded industries; with none given, all."""
    if not excluded:
        return companies
    return companies.filter(~F.coalesce(excluded_by(F.col("industry"), excluded), F.lit(False)))


def without_tickers(companies: DataFrame, tickers: DataFrame) -> DataFrame:
    return companies.join(tickers.select("ticker"), "ticker", "left_anti")


def without_fraud(companies: DataFrame, fraud_entities: DataFrame) -> DataFrame:
    """Companies none of whose filings is a fraud case."""
    return companies.join(fraud_entities.select("edinetCode").distinct(), "edinetCode", "left_anti")
