"""Joins between filings, facts, companies and judgements.

No side is forced to be broadcast: Spark reads the sizes and decides, and splits a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W


def with_facts(filings: DataFrame, landed: DataFrame, key: str = "docID") -> DataFrame:
    """Filings whose fact file is there. ``landed``: the manifest of the landing, or any table
    with a ``doc_id`` for each of them; a semi join asks for no distinct."""
    return filings.join(landed.select(F.col("doc_id").alias(key)), key, "left_semi")


def pairs_with_facts(pairs: DataFrame, landed: DataFrame) -> DataFrame:
    """Pairs of which both fact files are there. ``landed`` as for ``with_facts``."""
    docs = landed.select("doc_id")
    for side in ("prev_doc", "cur_doc"):
        pairs = pairs.join(docs.withColumnRenamed("doc_id", side), side, "left_semi")
    return pairs


def not_landed(filings: DataFrame, landed: DataFrame) -> DataFrame:
    """Filings that are not yet there."""
    return filings.join(landed.select(F.col("doc_id").alias("docID")), "docID", "left_anti")


def with_company(filings: DataFrame, companies: DataFrame) -> DataFrame:
    """Filings with their company's attributes; unknown companies are left out."""
    return filings.join(companies, filings.edinetCode == companies.entity_id)


def near_matches(current: DataFrame, prior: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """For each filing of ``prior`` (``entity_id, doc_id, amount``), the first other filing of
    the same company in ``current`` whose amount is within ``tolerance``.

    Amounts fall into blocks as wide as the band, so the band of a row is the upper end of one
    block and the lower end of the next. A running minimum over each block from either side, read
    off at the row's bounds, gives the first filing of both ends: two sorts, no pairs, linear in
    the rows of a block. The two smallest ids are kept, as the first may be the row's own. Before
    it, ``current`` is cut to the first two filings per company and exact amount.
    """
    width = 2 * tolerance
    first = W.Window.partitionBy("entity_id", "amount").orderBy("doc_id")
    heads = (
        current.filter(F.col("amount").isNotNull())
        .withColumn("_r", F.row_number().over(first))
        .filter(F.col("_r") <= 2)
    )
    amount, none = F.col("amount"), F.lit(None)
    low, high = amount - tolerance, amount + tolerance
    block = F.floor(low / width)

    def entry(side: int, block, at, *own):
        doc, entry_amount = own or (none.cast("string"), none.cast("double"))
        return F.struct(F.lit(side).alias("side"), block.alias("block"), at.cast("double").alias("at"),
                        doc.alias("own"), entry_amount.cast("double").alias("own_amount"))

    held = heads.select("entity_id", F.col("doc_id").alias("match"), F.explode(F.array(
        entry(0, F.floor(amount / width), -amount), entry(1, F.floor(amount / width), amount))).alias("e"))
    asked = prior.filter(amount.isNotNull()).select("entity_id", none.cast("string").alias("match"), F.explode(F.array(
        entry(0, block, -low, F.col("doc_id"), amount), entry(1, block + 1, high, F.col("doc_id"), amount))).alias("e"))
    rows = held.union(asked).select("entity_id", "match", "e.*")
    # At one place the filings come before the rows that ask.
    run = W.Window.partitionBy("entity_id", "block", "side").orderBy("at", F.col("match").isNull(), "match")
    sofar, before = run.rowsBetween(W.Window.unboundedPreceding, 0), run.rowsBetween(W.Window.unboundedPreceding, -1)
    least = rows.withColumn("least", F.min("match").over(sofar)).withColumn("earlier", F.min("match").over(before))
    loser = F.when(F.col("match") != F.col("earlier"), F.greatest("match", "earlier"))
    second = least.withColumn("second", F.min(loser).over(sofar)).filter(F.col("match").isNull())
    found = F.when(F.col("least") != F.col("own"), F.col("least")).otherwise(F.col("second"))
    close = second.select("entity_id", F.col("own").alias("doc_id"), "own_amount", found.alias("match_doc"))
    best = close.filter("match_doc IS NOT NULL").groupBy("entity_id", "doc_id", "own_amount").agg(F.min("match_doc").alias("match_doc"))
    kind = prior.schema["amount"].dataType
    return best.select("entity_id", "doc_id", F.col("own_amount").cast(kind).alias("amount"), "match_doc")


def amended_originals(amended_facts: DataFrame) -> DataFrame:
    """``amended_doc_id, original_doc_id`` where an amended filing names exactly one original."""
    from kessan.operators.facts import single_element_values

    named = single_element_values(amended_facts, "IdentificationOfDocumentSubjectToAmendmentDEI")
    return named.filter(F.col("value") != "").select(
        F.col("doc_id").alias("amended_doc_id"), F.col("value").alias("original_doc_id")
    )


def explanations(judgements: DataFrame) -> DataFrame:
    """Per original filing of a fraud case, its explanation and amended filing (the last one)."""
    fraud = judgements.filter("is_accounting_fraud")
    last = F.max_by(F.struct("explanation", "amended_doc_id"), "amended_doc_id")
    return fraud.groupBy(F.col("original_doc_id").alias("doc_id")).agg(last.alias("_e")).select(
        "doc_id", "_e.explanation", "_e.amended_doc_id"
    )
