"""Operators on the fact table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from kessan.functions import filters
from kessan.functions.numbers import normalize_value
from kessan.small import INT, TEXT, small_table
from kessan.vocab import PERIODS, period_contexts, vocab_keys

#: Rows that agree on these are copies of one fact.
FACT_KEYS = ("element", "context", "rel_year", "consol", "period_type")
LEAF_KEYS = ("doc_id", "statement", "item")


def prints(*columns: str) -> list[Column]:
    """A 128-bit fingerprint of columns as two longs, ``print1`` and ``print2``. Rows of equal
    prints are taken for equal: among a trillion rows two unlike ones meet with a chance of 1e-14."""
    # The hash skips nulls, so a null is given a text of its own.
    filled = [F.coalesce(F.col(c), F.lit("\u0000")) for c in columns]
    return [F.xxhash64(F.lit(seed), *filled).alias(f"print{seed}") for seed in (1, 2)]


def unique_facts(facts: DataFrame) -> DataFrame:
    """One row per filing and fact key; of unequal values the smallest is kept.

    Sorts compare a number, 16 bits of it from the key's texts and 48 from the filing, and the texts only
    where it is equal. Copies meet already before the shuffle: a fact repeated without end costs one row
    per task there. Facts of the same texts lie next to each other in it, so these are compressed away.
    """
    texts, doc = F.xxhash64(*(F.col(c) for c in FACT_KEYS)), F.xxhash64("doc_id")
    near = F.shiftleft(texts, 48).bitwiseOR(F.shiftrightunsigned(doc, 16))
    first = W.Window.partitionBy("near", "doc_id", *FACT_KEYS).orderBy(F.col("value").asc_nulls_last())
    marked = facts.select("doc_id", *FACT_KEYS, "value", near.alias("near"))
    return marked.withColumn("place", F.row_number().over(first)).filter("place = 1").drop("place", "near")


def leaf_facts(facts: DataFrame, vocab: DataFrame) -> DataFrame:
    """Facts of vocabulary elements in statement periods, consolidated basis only.

    One equality join with the vocabulary and one with the period contexts serve all
    statements at once; both tables are small and fixed. A fact whose element feeds several
    lines gives a row for each.
    """
    named = facts.filter(
        filters.is_consolidated(F.col("consol"), F.col("context"))
        & F.col("element").contains(":")
    )
    if "local_name" not in facts.columns:  # facts landed by filing hold it
        named = named.withColumn("local_name", filters.local_name(F.col("element")))
    keys = vocab_keys(vocab).select("local_name", "statement", "ord", "item", F.xxhash64("statement", "item").alias("label"))
    rows = named.join(keys, "local_name").select("doc_id", *FACT_KEYS, "statement", "ord", "item", keys["label"], "value")
    return rows.join(period_contexts(facts.sparkSession), "context")


def leaf_values(leaves: DataFrame, last_only: Sequence[str] = ("META",), copies: bool = False) -> DataFrame:
    """``label, leaf, print1, print2, doc_id, value``: the distinct facts of each leaf and period,
    narrow. ``label`` is the hash of statement and item; ``leaf`` holds the place of the element, the
    period, and whether the statement holds one period only, in this order of weight.

    One hash aggregation: copies meet before the shuffle, and no text but the value goes into it.
    ``copies``: they are left in, for ``single_values`` to drop, and nothing is shuffled here.
    """
    one_period = F.col("statement").isin(*last_only).cast("long")
    leaf = F.col("ord").cast("long") * 32 + F.col("period_ord") * 2 + one_period
    narrow = leaves.select("label", leaf.alias("leaf"), *prints(*FACT_KEYS), "doc_id", "value")
    return narrow if copies else narrow.distinct()


#: Windows over a filing and what is within it start with a number: sorts compare it, and the texts of ids, which
#: share their first letters, only where it is equal.
DOC = ("doc", "doc_id")
PLACE, PERIOD, ONE_PERIOD = "shiftright(leaf, 5)", "CAST(shiftright(leaf, 1) & 15 AS INT)", "leaf & 1 = 1"


def single_values(values: DataFrame) -> DataFrame:
    """Of ``leaf_values``, with copies or without, the value of each (leaf, period) that exactly one
    distinct fact supports; of unequal values of that fact the smallest.

    All rows are one fact if and only if the smallest and the largest print agree; they then differ in
    their values at most, so the first row by value stands for its copies. Rows placed by filing stay
    where they are, and one sort serves both windows and those of ``last_leaf``.
    """
    leaf = W.Window.partitionBy(*DOC, "label", "leaf")
    first = F.row_number().over(leaf.orderBy(F.col("value").asc_nulls_last()))
    numbered = values.withColumn("doc", F.xxhash64("doc_id")).withColumn("place", first)
    one_fact = [F.min(p).over(leaf) == F.max(p).over(leaf) for p in ("print1", "print2")]
    marked = numbered.withColumn("single", one_fact[0] & one_fact[1] & (F.col("place") == 1))
    return marked.filter("single").drop("print1", "print2", "place", "single")


def last_leaf(values: DataFrame) -> DataFrame:
    """Of leaves that share a label, the last one with any value replaces the others. Statements
    with one period (META) hold the value of the last period only.

    The window holds at most the periods of the leaves of one label.
    """
    rank = F.expr(f"CASE WHEN {ONE_PERIOD} THEN leaf ELSE {PLACE} END")
    ranked = values.withColumn("rank", rank)
    best = F.max("rank").over(W.Window.partitionBy(*DOC, "label"))
    return ranked.withColumn("best", best).filter("rank = best").drop("rank", "best")


def labelled(values: DataFrame, vocab: DataFrame) -> DataFrame:
    """``doc_id, statement, item, ord, period, period_ord, value``: names for ``label`` and
    ``leaf``; statements with one period have no period."""
    names = vocab.select(F.xxhash64("statement", "item").alias("label"), "ord", "statement", "item")
    told = values.withColumns({"ord": F.expr(f"CAST({PLACE} AS INT)"), "period_ord": F.expr(f"CASE WHEN NOT ({ONE_PERIOD}) THEN {PERIOD} END")})
    period = F.get(F.lit(list(PERIODS)), F.col("period_ord") - 1)
    return told.join(F.broadcast(names), ["label", "ord"]).select(*LEAF_KEYS, "ord", period.alias("period"), "period_ord", "value")


def header_values(facts: DataFrame, elements: Sequence[str]) -> DataFrame:
    """Per filing, the last value in file order of each header element."""
    wanted = facts.filter(F.col("element").isin(*elements))
    return wanted.groupBy("doc_id").agg(
        *(
            F.max_by("value", F.when(F.col("element") == name, F.col("src_ord"))).alias(name)
            for name in elements
        )
    )


#: Header elements of the side table, by its columns.
# The elements of the accounting standard, the fiscal dates and the submission.
HEADER_ELEMENTS = {
    "standard": "jpdei_cor:AccountingStandardsDEI",
    "year_start": "jpdei_cor:CurrentFiscalYearStartDateDEI",
    "year_end": "jpdei_cor:CurrentFiscalYearEndDateDEI",
    "submitted_dei": "jpdei_cor:FilingDateDEI",
    "submitted_time": "jpdei_cor:SubmissionDateTimeDEI",
    "submitted_cover": "jpcrp_cor:FilingDateCoverPage",
}
SUBMISSION_COLUMNS = ("submitted_dei", "submitted_time", "submitted_cover")


def header_side(facts: DataFrame) -> DataFrame:
    """One row per filing that has header rows: the last value of each header element, and whether
    any row uses an element of another accounting standard. One scan, and one shuffle of the few
    rows that say either."""
    element = F.col("element")
    listed = element.isin(*HEADER_ELEMENTS.values())
    wanted = facts.filter(listed | filters.other_standard(element))
    last = [F.max_by("value", F.when(element == name, F.col("src_ord"))).alias(column) for column, name in HEADER_ELEMENTS.items()]
    rows = wanted.groupBy("doc_id").agg(
        *last, F.bool_or(filters.other_standard(element)).alias("uses_other"), F.bool_or(listed).alias("has_header")
    )
    return rows.filter("has_header").drop("has_header")


def single_element_values(facts: DataFrame, name: str) -> DataFrame:
    """``doc_id, value`` of filings in which exactly one distinct fact has the element."""
    key = F.struct(*FACT_KEYS)
    return (
        facts.filter(filters.is_element(F.col("element"), name))
        .groupBy("doc_id")
        .agg(F.min(key).alias("low"), F.max(key).alias("high"), F.min("value").alias("value"))
        .filter(F.col("low").eqNullSafe(F.col("high")))
        .select("doc_id", "value")
    )


def standard_flags(facts: DataFrame) -> DataFrame:
    """Per filing: does any row use an element of another accounting standard."""
    return facts.groupBy("doc_id").agg(
        F.coalesce(F.bool_or(filters.other_standard(F.col("element"))), F.lit(False)).alias(
            "uses_other"
        )
    )


@dataclass(frozen=True)
class Measure:
    """A figure and the elements that may hold it, best first."""

    name: str
    elements: tuple[str, ...]
    rel_year: str
    period_type: str


def fallback_values(
    facts: DataFrame, measures: Sequence[Measure], preferred: str, otherwise: str, prefers: Column
) -> DataFrame:
    """Per filing and measure: the first candidate element with a number, and of its numbers
    the largest; with the name of the element that gave it.

    All figures of a filing are on one basis: ``preferred`` if any row of the candidate
    elements satisfies ``prefers`` (column ``is_preferred``), else ``otherwise``. Columns are
    ``{measure}`` and ``{measure}_element``. Segment rows do not count. A row finds its
    candidates by an equality join with a small table, and one hash aggregation per filing
    keeps a maximum per candidate and basis: one scan, one shuffle, no sort.
    """
    slots, rows = {}, []
    for measure in measures:
        for element in measure.elements:
            key = (element, measure.rel_year, measure.period_type)
            if key not in slots:
                slots[key] = len(slots)
                rows.append((filters.STATEMENT_PREFIX + element, *key[1:], slots[key]))
    table = small_table(
        facts.sparkSession, rows, element=TEXT, rel_year=TEXT, period_type=TEXT, slot=INT
    )
    # The explicit element list reaches the scan; the join alone would not.
    wanted = facts.filter(
        F.col("element").isin(*sorted({row[0] for row in rows}))
        & F.col("consol").isin(preferred, otherwise)
    )
    number = normalize_value(F.col("value"), F.coalesce("unit", F.lit("")))
    slotted = wanted.join(table, ["element", "rel_year", "period_type"], "left").select(
        "doc_id",
        (F.col("consol") == preferred).alias("on_preferred"),
        prefers.alias("prefers"),
        "slot",
        F.when(~filters.is_segment(F.col("context")), number).alias("number"),
    )

    def maximum(slot: int, on_preferred: bool) -> Column:
        hit = (F.col("slot") == slot) & (F.col("on_preferred") == on_preferred)
        return F.max(F.when(hit, F.col("number")))

    maxima = slotted.groupBy("doc_id").agg(
        F.coalesce(F.bool_or("prefers"), F.lit(False)).alias("is_preferred"),
        *(maximum(s, True).alias(f"p{s}") for s in slots.values()),
        *(maximum(s, False).alias(f"o{s}") for s in slots.values()),
    )
    columns: list[Column] = []
    for measure in measures:
        found = []
        for element in measure.elements:
            s = slots[element, measure.rel_year, measure.period_type]
            found.append((element, F.when(F.col("is_preferred"), F.col(f"p{s}")).otherwise(F.col(f"o{s}"))))
        columns.append(F.coalesce(*(c for _, c in found)).alias(measure.name))
        named = (F.when(c.isNotNull(), F.lit(e)) for e, c in found)
        columns.append(F.coalesce(*named).alias(f"{measure.name}_element"))
    return maxima.select("doc_id", "is_preferred", *columns)


def receivable_elements(facts: DataFrame) -> DataFrame:
    """Distinct statement elements whose name speaks of receivables, notes or e-claims, with labels."""
    # Stems and the year-end marks that are looked at.
    stems, ends = "receiv|note|electronic", ("当期末", "前期末")
    return (
        facts.filter(
            F.col("element").contains(filters.STATEMENT_PREFIX)
            & F.lower("element").rlike(stems)
            & F.col("consol").isin(filters.CONSOLIDATED, filters.SEPARATE)
            & F.col("rel_year").isin(*ends)
        )
        .select("element", "label")
        .distinct()
    )


def candidate_availability(facts: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Per filing, which candidate elements have a consolidated year-end row (with a value of
    it); filings with none list the receivable-like elements they do have instead.

    ``kind`` is ``found``, ``instead`` or ``none``. Every filing of ``facts`` has a row.
    """
    full = [filters.STATEMENT_PREFIX + name for name in candidates]
    at_end = (F.col("rel_year") == "当期末") & (F.col("consol") == filters.CONSOLIDATED)
    alike = F.col("element").contains(filters.STATEMENT_PREFIX) & (
        F.lower("element").contains("receiv")
        | F.coalesce(F.col("label").contains("売掛") | F.col("label").contains("手形"), F.lit(False))
    )
    listed = F.col("element").isin(*full)
    marked = facts.select(
        "doc_id",
        F.when(at_end & listed, F.lit("found")).when(at_end & alike, F.lit("instead")).alias("kind"),
        F.when(at_end & (listed | alike), F.col("element")).alias("element"),
        F.when(at_end & (listed | alike), F.col("value")).alias("value"),
    )
    # One row per (filing, kind, element): the many rows that are neither collapse to one.
    grouped = marked.groupBy("doc_id", "kind", "element").agg(F.min("value").alias("value"))
    per_doc = W.Window.partitionBy("doc_id")
    has_found = F.max((F.col("kind") == "found").cast("int")).over(per_doc)
    has_any = F.max(F.col("kind").isNotNull().cast("int")).over(per_doc)
    ranked = grouped.withColumn("has_found", F.coalesce(has_found, F.lit(0))).withColumn("has_any", has_any)
    return ranked.filter(
        (F.col("kind") == "found")
        | ((F.col("kind") == "instead") & (F.col("has_found") == 0))
        | (F.col("kind").isNull() & (F.col("has_any") == 0))
    ).select("doc_id", F.coalesce("kind", F.lit("none")).alias("kind"), "element", "value")
