"""Facts of a corpus to statements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kessan.functions import filters
from kessan.functions.text import json_text
from kessan.operators.facts import DOC, FACT_KEYS, labelled, last_leaf, leaf_facts, leaf_values, prints, single_values
from kessan.small import INT, TEXT, small_table
from kessan.vocab import STATEMENTS, builtin_vocab, period_contexts

# The header item that says whether statements are consolidated.
CONSOLIDATION_ELEMENT = "WhetherConsolidatedFinancialStatementsArePreparedDEI"
CONSOLIDATION_ITEM = "連結決算の有無"
ENTITY_ITEM = "EDINETコード"
START_ITEM = "当事業年度開始日"


#: The statements without the header.
BODY = tuple(s for s in STATEMENTS if s != "META")
#: A line of its own for the header item that says whether statements are consolidated.
GATE = "GATE"


def statements(
    facts: DataFrame, vocab: DataFrame | None = None, only: Sequence[str] = STATEMENTS, placed: bool = False,
    docs: DataFrame | None = None, few_copies: bool = False,
) -> DataFrame:
    """``doc_id, statement, item, ord, period, period_ord, value`` of every filing.

    Header (META) items have no period. Filings that say they are not consolidated yield
    nothing; that item is a leaf like any other, so facts are read once. Only vocabulary rows
    leave the scan, copies meet before the first shuffle, the second places rows by filing, and
    all further steps, here and in ``sections``, keep that placement. ``placed``: the facts are
    landed by filing, so nothing is shuffled. ``docs``: the filings to parse (``doc_id``), all if
    not given; they are looked up among the narrow rows, so no whole fact is shuffled for it.
    ``few_copies``: a fact is not repeated without end, as in filings that are a file each. Copies then
    meet in the sort behind the placement, which is the only shuffle: facts of a filing read one behind the
    other stay so in it, and what they share is compressed away. The result is the same either way.
    """
    spark = facts.sparkSession
    vocab = builtin_vocab(spark) if vocab is None else vocab
    vocab = vocab.filter(F.col("statement").isin(*only))
    lines = vocab.select("statement", "ord", "element", "item")
    lines = lines.union(small_table(spark, [(GATE, 0, CONSOLIDATION_ELEMENT, GATE)], statement=TEXT, ord=INT, element=TEXT, item=TEXT))
    values = leaf_values(leaf_facts(facts, lines), ("META", GATE), copies=placed or few_copies)
    if not placed:
        values = values.repartition("doc_id")
    if docs is not None:
        values = values.join(docs.select("doc_id"), "doc_id", "left_semi")
    kept = last_leaf(single_values(values))
    gate = F.col("label") == F.xxhash64(F.lit(GATE), F.lit(GATE))
    closed = F.max((gate & (F.col("value") == "false")).cast("int")).over(Window.partitionBy(*DOC))
    open_ = kept.withColumn("closed", F.coalesce(closed, F.lit(0))).filter("closed = 0").drop("closed")
    return labelled(open_, vocab)


def unconsolidated(facts: DataFrame) -> DataFrame:
    """``doc_id`` of filings whose header says they are not consolidated: the value of the last
    period that exactly one fact supports is ``false``."""
    flag = facts.filter(
        filters.is_element(F.col("element"), CONSOLIDATION_ELEMENT)
        & filters.is_consolidated(F.col("consol"), F.col("context"))
    ).join(period_contexts(facts.sparkSession), "context")
    least = [f(p).alias(f"{name}{p}") for p in ("print1", "print2") for name, f in (("low_", F.min), ("high_", F.max))]
    # Values other than "false" need not be told apart; the smallest of a fact's values counts.
    below = F.col("value") < "false"
    single = flag.select("doc_id", "period_ord", "value", *prints(*FACT_KEYS)).groupBy("doc_id", "period_ord").agg(
        *least, F.bool_or(F.col("value") == "false").alias("is_false"), F.bool_or(below).alias("is_below")
    ).filter("low_print1 = high_print1 AND low_print2 = high_print2")
    said = F.coalesce(F.col("is_false"), F.lit(False)) & ~F.coalesce(F.col("is_below"), F.lit(False))
    last = single.groupBy("doc_id").agg(F.max(F.col("period_ord") * 2 + said.cast("int")).alias("last"))
    return last.filter(F.col("last") % 2 == 1).select("doc_id")


def period_maps(parsed: DataFrame) -> DataFrame:
    """``doc_id, statement, ord, item, periods, value``: a map from period to value with at most
    ten entries; for header items ``value`` instead."""
    has_period = F.col("period").isNotNull()
    entry = F.when(has_period, F.struct("period_ord", "period", "value"))
    entries = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["period"], e["value"]))
    return parsed.groupBy("doc_id", "statement", "item").agg(
        F.max("ord").alias("ord"),
        F.map_from_entries(entries).alias("periods"),
        F.max(F.when(~has_period, F.col("value"))).alias("value"),
    )


def _quoted(text: Column) -> Column:
    """Text as a JSON string: a one-element array as JSON, without its brackets."""
    one = F.to_json(F.array(text))
    return F.coalesce(F.substring(one, F.lit(2), F.length(one) - 2), F.lit("null"))


def sections(parsed: DataFrame, **header: str) -> DataFrame:
    """One row per filing with the six statements as JSON text: ``meta, summary, text, bs, pl, cf``,
    and a column per header item named.

    A row holds one filing's vocabulary items, so its size does not grow with the corpus.
    """
    is_meta = F.col("statement") == "META"
    shown = F.when(is_meta, F.when(F.col("value").isNull(), "null").otherwise(_quoted(F.col("value")))).otherwise(
        json_text(F.col("periods"))
    )
    items = period_maps(parsed).withColumn("json", shown)

    def listed(name: str) -> Column:
        entry = F.struct("ord", "item", "json")
        return F.array_sort(F.collect_list(F.when(F.col("statement") == name, entry))).alias(name)

    def header_value(item: str, alias: str) -> Column:
        return F.max(F.when(is_meta & (F.col("item") == item), F.col("value"))).alias(alias)

    grouped = items.groupBy("doc_id").agg(
        *(listed(s) for s in STATEMENTS), *(header_value(item, alias) for alias, item in header.items())
    )

    def joined(name: str) -> Column:
        pairs = F.transform(F.col(name), lambda e: F.concat(_quoted(e["item"]), F.lit(":"), e["json"]))
        return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")).alias(name.lower())

    return grouped.select("doc_id", *(joined(s) for s in STATEMENTS), *header)


def statement_maps(parsed: DataFrame) -> DataFrame:
    """``doc_id, statement, items``: nested map from item to period to value."""
    maps = period_maps(parsed.filter(F.col("statement") != "META"))
    entries = F.transform(
        F.array_sort(F.collect_list(F.struct("ord", "item", "periods_list"))),
        lambda e: F.struct(e["item"], F.map_from_entries(e["periods_list"])),
    )
    return maps.withColumn("periods_list", F.map_entries("periods")).groupBy("doc_id", "statement").agg(
        F.map_from_entries(entries).alias("items")
    )
