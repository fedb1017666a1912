"""The three labelled sets: misstatement, earnings direction, industry.

Filings are chosen on narrow columns first; only the chosen ones are parsed into sections.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kessan.functions import filters
from kessan.functions.numbers import rises, to_whole
from kessan.functions.text import ticker
from kessan.operators import sampling
from kessan.operators.companies import INDUSTRY_GROUPS, INVALID, NOT_OBLIGED, recode, without_fraud, without_tickers
from kessan.operators.facts import FACT_KEYS
from kessan.operators.joins import amended_originals, explanations, pairs_with_facts, with_company
from kessan.operators.select import latest_filing, year_pairs
from kessan.plans.statements import ENTITY_ITEM, START_ITEM, sections, statements, unconsolidated
from kessan.session import written
from kessan.small import TEXT, small_table

SECTIONS = ("meta", "summary", "bs", "pl", "cf", "text")

# Profit elements, first choice first.
PROFIT_ELEMENTS = (
    "ProfitLossAttributableToOwnersOfParent",
    "ProfitLossAttributableToOwnersOfParentCompanyIFRS",
)
PER_INDUSTRY = 35
EARNINGS_EXAMPLES = 1000
OTHER_EXAMPLES = 700


def parsed_sections(facts: DataFrame, docs: DataFrame, vocab: DataFrame | None = None) -> DataFrame:
    """Sections of the filings in ``docs`` (``doc_id``), with ``edinet_code`` and the year of the
    fiscal start; filings without a code in their header are left out.

    The ids are written alone: read with the texts beside them they seem too large to broadcast,
    and every fact would be shuffled to find those of a few filings. The facts are read once.
    """
    chosen = written(docs.select("doc_id").distinct(), "chosen-ids")
    rows = sections(statements(facts, vocab, docs=chosen), edinet_code=ENTITY_ITEM, start=START_ITEM)
    year = F.get(F.split("start", "-"), F.lit(0)).try_cast("int")
    return rows.filter(F.coalesce("edinet_code", F.lit("")) != "").withColumn("start_year", year).drop("start")


def readable(facts: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of ``docs`` whose statements would not come out empty."""
    return docs.join(unconsolidated(facts), "doc_id", "left_anti")


# --- earnings direction ------------------------------------------------------------------


def profits(facts: DataFrame) -> DataFrame:
    """Per filing the current and the prior profit: of the first profit element that has any row
    at all, the one fact of the period, on any basis; no or several facts give none."""
    element = F.col("element")
    rank = F.when(filters.is_element(element, PROFIT_ELEMENTS[0]), 1).when(
        filters.is_element(element, PROFIT_ELEMENTS[1]), 2
    )
    key = F.struct(*FACT_KEYS)
    rows = facts.select("doc_id", *FACT_KEYS, "value", rank.alias("rank")).filter("rank is not null")
    current = filters.in_period(F.col("context"), "CurrentYear")
    prior = filters.in_period(F.col("context"), "Prior1Year")
    parts = []
    for r in (1, 2):
        for name, period in (("current", current), ("prior", prior)):
            hit = (F.col("rank") == r) & period
            parts += [
                F.min(F.when(hit, key)).alias(f"{name}_{r}_low"),
                F.max(F.when(hit, key)).alias(f"{name}_{r}_high"),
                F.min(F.when(hit, F.col("value"))).alias(f"{name}_{r}"),
            ]
    grouped = rows.groupBy("doc_id").agg(F.min("rank").alias("rank"), *parts)

    def single(name: str):
        chosen = None
        for r in (1, 2):
            value = F.when(F.col(f"{name}_{r}_low") == F.col(f"{name}_{r}_high"), to_whole(F.col(f"{name}_{r}")))
            hit = F.col("rank") == r
            chosen = F.when(hit, value) if chosen is None else chosen.when(hit, value)
        return chosen

    return grouped.select("doc_id", single("current").alias("current"), single("prior").alias("prior"))


def random_pair_per_company(pairs: DataFrame, seed: str = sampling.SEED) -> DataFrame:
    return sampling.first_per_group(pairs, "edinetCode", "prev_doc", 1, seed)


def earnings_labels(
    filings: DataFrame, facts: DataFrame, seed: str = sampling.SEED, landed: DataFrame | None = None
) -> DataFrame:
    """One random year-to-year pair per company with its label and the naive prediction; pairs
    without the facts or profits they need, or whose earlier filing is not readable, drop out.
    ``landed``: the manifest, which saves a scan of the facts."""
    there = facts.select("doc_id").distinct() if landed is None else landed
    pairs = pairs_with_facts(random_pair_per_company(year_pairs(filings), seed), there)
    figures = profits(facts)
    before = figures.select(
        F.col("doc_id").alias("prev_doc"), F.col("prior").alias("two_before"), F.col("current").alias("one_before")
    )
    after = figures.select(F.col("doc_id").alias("cur_doc"), F.col("current").alias("now"))
    joined = pairs.join(before, "prev_doc").join(after, "cur_doc").dropna(
        subset=["two_before", "one_before", "now"]
    )
    labelled = joined.select(
        F.col("edinetCode"),
        F.col("prev_doc").alias("doc_id"),
        "cur_doc",
        "prev_start",
        rises(F.col("one_before"), F.col("now")).alias("label"),
        rises(F.col("two_before"), F.col("one_before")).alias("naive_prediction"),
    )
    return readable(facts, labelled)


def earnings_examples(
    filings: DataFrame, facts: DataFrame, n: int = EARNINGS_EXAMPLES, seed: str = sampling.SEED
) -> DataFrame:
    """The first ``n`` valid companies in random order."""
    return sampling.take(earnings_labels(filings, facts, seed), "edinetCode", n, seed)


def earnings_set(
    filings: DataFrame, facts: DataFrame, n: int = EARNINGS_EXAMPLES, balanced: bool = False,
    vocab: DataFrame | None = None, seed: str = sampling.SEED,
) -> DataFrame:
    """Examples with sections and ``split`` (fiscal start before 2020: train)."""
    chosen = written(earnings_examples(filings, facts, n, seed).drop("edinetCode"), "earnings-examples")
    rows = parsed_sections(facts, chosen, vocab).join(chosen, "doc_id")
    split = sampling.split_by_year(rows, F.col("start_year"))
    if balanced:
        split = written(split, "earnings-rows")
        keys = split.select("doc_id", "label", "split")
        kept = sampling.balance(keys, "label", "doc_id", seed, within=("split",)).select("doc_id")
        split = split.join(kept, "doc_id", "left_semi")
    return split.select(
        *SECTIONS, "label", "naive_prediction", "edinet_code", "doc_id",
        F.concat("edinet_code", F.lit("/"), "doc_id", F.lit(".tsv")).alias("previous_year_file_path"),
        F.concat("edinet_code", F.lit("/"), "cur_doc", F.lit(".tsv")).alias("current_year_file_path"),
        "split",
    )


# --- industry ----------------------------------------------------------------------------


def shipped_tickers(spark: SparkSession) -> DataFrame:
    """The tickers of ``resources/excluded_tickers.txt``, a fixed list, as ``ticker``."""
    lines = resources.files("kessan.resources").joinpath("excluded_tickers.txt").read_text("utf-8").splitlines()
    return small_table(spark, [(x,) for x in lines if x and not x.startswith("#")], ticker=TEXT)


def industry_candidates(
    filings: DataFrame, companies: DataFrame, excluded_tickers: DataFrame | None = None
) -> DataFrame:
    """The latest filing of each company with its industry group. Companies not obliged to
    report, without a security code, or on the list of excluded tickers (by default the shipped
    one) are left out; an industry without a group stays, as ``invalid``."""
    joined = with_company(latest_filing(filings), companies.select("entity_id", "industry", "sec_code"))
    kept = joined.filter(
        (F.coalesce("industry", F.lit("")) != NOT_OBLIGED) & (F.coalesce("sec_code", F.lit("")) != "")
    ).withColumn("ticker", ticker(F.col("sec_code")))
    if excluded_tickers is None:
        excluded_tickers = shipped_tickers(filings.sparkSession)
    kept = without_tickers(kept, excluded_tickers)
    grouped = recode(kept, "industry", INDUSTRY_GROUPS, INVALID, "industry_group")
    return grouped.select(
        F.col("docID").alias("doc_id"), "edinetCode", F.col("industry_group").alias("industry")
    )


def industry_examples(
    filings: DataFrame, companies: DataFrame, excluded_tickers: DataFrame | None = None,
    per_group: int = PER_INDUSTRY, seed: str = sampling.SEED,
) -> DataFrame:
    candidates = industry_candidates(filings, companies, excluded_tickers)
    return sampling.first_per_group(candidates, "industry", "doc_id", per_group, seed)


def industry_set(
    filings: DataFrame, facts: DataFrame, companies: DataFrame, excluded_tickers: DataFrame | None = None,
    per_group: int = PER_INDUSTRY, vocab: DataFrame | None = None, seed: str = sampling.SEED,
) -> DataFrame:
    chosen = written(industry_examples(filings, companies, excluded_tickers, per_group, seed), "industry-examples")
    rows = parsed_sections(facts, chosen, vocab).join(chosen, "doc_id")
    return rows.select(
        *SECTIONS, "industry", "edinet_code", "doc_id",
        F.concat("edinetCode", F.lit("/"), "doc_id", F.lit(".tsv")).alias("file_path"),
    )


# --- misstatement ------------------------------------------------------------------------


def fraud_filings(filings: DataFrame, judgements: DataFrame) -> DataFrame:
    """The original filings of the cases judged to be fraud."""
    originals = judgements.filter("is_accounting_fraud").select(F.col("original_doc_id").alias("docID"))
    return filings.join(originals, "docID", "left_semi")


def fraud_entities(facts: DataFrame, fraud_docs: DataFrame) -> DataFrame:
    """Company codes of the fraud filings, from their own facts."""
    code = facts.filter(filters.is_element(F.col("element"), "EDINETCodeDEI"))
    return (
        code.join(fraud_docs.select("doc_id"), "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min_by("value", "src_ord").alias("edinetCode"))
        .select("edinetCode")
        .distinct()
    )


def other_filings(
    filings: DataFrame, fraud_codes: DataFrame, n: int = OTHER_EXAMPLES, seed: str = sampling.SEED
) -> DataFrame:
    """A random filing of each of up to ``n`` random companies without a fraud filing.

    A pool of ``2n`` random companies is drawn first, fraud companies leave it, and the
    first ``n`` of the rest stay.
    """
    companies = filings.select("edinetCode").distinct()
    pool = sampling.take(companies, "edinetCode", 2 * n, seed)
    clean = sampling.take(without_fraud(pool, fraud_codes), "edinetCode", n, seed)
    of_clean = filings.join(clean, "edinetCode", "left_semi")
    return sampling.first_per_group(of_clean, "edinetCode", "docID", 1, seed)


def misstatement_examples(
    filings: DataFrame, facts: DataFrame, judgements: DataFrame, n: int = OTHER_EXAMPLES, seed: str = sampling.SEED
) -> DataFrame:
    """``doc_id, label, explanation, amended_doc_id``: fraud filings (1) and others (0).

    A filing without its facts is left out and not replaced. Explanations are looked up by
    the original filing a judgement names.
    """
    positive = fraud_filings(filings, judgements).select(F.col("docID").alias("doc_id"))
    codes = fraud_entities(facts, positive)
    negative = other_filings(filings, codes, n, seed).select(F.col("docID").alias("doc_id"))
    labelled = positive.withColumn("label", F.lit(1)).unionByName(negative.withColumn("label", F.lit(0)))
    # Labels, codes and sample are narrow and small; written, they are chosen once.
    labelled = written(labelled, "misstatement-labels")
    there = facts.select("doc_id").join(labelled.select("doc_id"), "doc_id", "left_semi").distinct()
    explained = labelled.join(there, "doc_id", "left_semi").join(explanations(judgements), "doc_id", "left")
    shown = lambda c: F.when(F.col("label") == 1, F.coalesce(c, F.lit(""))).otherwise("").alias(c)
    return explained.select("doc_id", "label", shown("explanation"), shown("amended_doc_id"))


def misstatement_set(
    filings: DataFrame, facts: DataFrame, judgements: DataFrame, n: int = OTHER_EXAMPLES,
    vocab: DataFrame | None = None, seed: str = sampling.SEED,
) -> DataFrame:
    """Examples with sections, split by company; sort by ``edinet_code`` when writing."""
    chosen = written(misstatement_examples(filings, facts, judgements, n, seed), "misstatement-examples")
    rows = parsed_sections(facts, chosen, vocab).join(chosen, "doc_id")
    shaped = rows.select(
        *SECTIONS, "label", "explanation", "edinet_code", "amended_doc_id", "doc_id",
        F.concat("edinet_code", F.lit("/"), "doc_id", F.lit(".tsv")).alias("file_path"),
    )
    return sampling.split_by_group(written(shaped, "misstatement-rows"), "edinet_code", seed=seed)


def judgements_of_replies(amended_facts: DataFrame, replies: DataFrame) -> DataFrame:
    """Judgement records from replies (``amended_doc_id, reply, amended_pdf_path``) for amended
    filings that name exactly one original."""
    from kessan.functions.text import json_from_reply, judgement_fields

    fields = judgement_fields(F.col("reply"))
    named = replies.join(amended_originals(amended_facts), "amended_doc_id")
    return named.filter(json_from_reply(F.col("reply")).isNotNull()).select(
        "amended_doc_id", "original_doc_id",
        *(column.alias(name) for name, column in fields.items()),
        "amended_pdf_path",
    )
