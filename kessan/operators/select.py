"""Which filing stands for a company and period.

A company may hold any share of all filings. Choices of one row are aggregations, which
meet their rows before the shuffle; choices of n rows are ranks with a constant limit,
which Spark cuts to n rows per company and task before the shuffle. Windows over a whole
company run only over its distinct dates or years.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from kessan.functions import filters
from kessan.functions.dates import day, one_year_later_day, submit_time
from kessan.session import written

FAR_PAST = "0001-01-01 00:00:00"


def pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """One row per key: the one that is largest by ``order``."""
    best = F.max_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")


def latest_per_period(filings: DataFrame) -> DataFrame:
    """The last submission per company and period end. A time that cannot be read counts as
    the earliest, ties go to the larger id, filings without a period end are left out."""
    time = F.coalesce(submit_time(F.col("submitDateTime")), F.lit(FAR_PAST).cast("timestamp"))
    dated = filings.filter(F.col("periodEnd") != "")
    return pick(
        dated, ["edinetCode", "periodEnd"], [time, F.col("docID")],
        ["docID", "submitDateTime", "docDescription"],
    )


def last_periods(per_period: DataFrame, n: int) -> DataFrame:
    """The last ``n`` period ends per company, ``slot`` 1 being the oldest kept; all if ``n <= 0``.

    Input has one row per company and period end, so a company's rows are few.
    """
    company = W.Window.partitionBy("edinetCode")
    kept = per_period
    if n > 0:
        newest = F.row_number().over(company.orderBy(F.desc("periodEnd")))
        kept = kept.withColumn("_r", newest).filter(F.col("_r") <= n).drop("_r")
    return kept.withColumn("slot", F.row_number().over(company.orderBy("periodEnd")))


def best_per_year(headers: DataFrame) -> DataFrame:
    """One filing per company and fiscal year: last submit text, then last path."""
    return pick(
        headers, ["entity_id", "fiscal_year"],
        [F.coalesce("submit_text", F.lit("")), F.col("path")],
        [c for c in headers.columns if c not in ("entity_id", "fiscal_year")],
    )


def best_and_reasons(headers: DataFrame) -> DataFrame:
    """``best_per_year`` of the accepted filings and, for the others, the reason of the last path:
    one row per company and fiscal year, in one aggregation."""
    order = F.struct(F.coalesce("submit_text", F.lit("")), F.col("path"))
    columns = [c for c in headers.columns if c not in ("entity_id", "fiscal_year", "accepted", "standard_reason")]
    accepted = F.col("accepted")
    return (
        headers.groupBy("entity_id", "fiscal_year")
        .agg(
            F.max_by(F.struct(*columns), F.when(accepted, order)).alias("_best"),
            F.max_by("standard_reason", F.when(~accepted, F.col("path"))).alias("standard_reason"),
        )
        .select("entity_id", "fiscal_year", "_best.*", "standard_reason")
    )


def duplicate_log(headers: DataFrame, chosen: DataFrame) -> DataFrame:
    """The filings that lost in ``best_per_year``, with the winner's name."""
    winners = chosen.select(
        F.col("entity_id"),
        F.col("fiscal_year"),
        F.col("doc_id").alias("chosen_doc"),
        F.concat("doc_id", F.lit(".tsv")).alias("chosen_tsv"),
        F.col("submit_text").alias("chosen_submit_datetime"),
    )
    losers = headers.join(winners, ["entity_id", "fiscal_year"]).filter(
        F.col("doc_id") != F.col("chosen_doc")
    )
    return losers.select(
        F.col("entity_id").alias("edinet_code"),
        "fiscal_year",
        "chosen_tsv",
        "chosen_submit_datetime",
        F.concat("doc_id", F.lit(".tsv")).alias("skipped_tsv"),
        F.lit("duplicate_skipped: newer submit_datetime or filename chosen").alias("skipped_reason"),
    )


def latest_filing(filings: DataFrame) -> DataFrame:
    """One filing per company: the last period start, then the larger id."""
    return pick(filings, ["edinetCode"], [F.col("periodStart"), F.col("docID")], ["docID", "periodStart", "periodEnd"])


def adjacent_filings(filings: DataFrame) -> DataFrame:
    """Neighbouring filings of a company by (period start, id): ``prev_doc, cur_doc`` and
    their starts and ends.

    Filings are dealt out by ranges of (company, start, id) and written, so a company or a date
    with half of all filings is several tasks. Within a range the next row is the neighbour; the
    last row of a range meets the first row of the next one, of which there is one per range.
    """
    order = ["edinetCode", "periodStart", "docID"]
    dealt = filings.select(*order, "periodEnd").repartitionByRange(*order)
    keyed = written(dealt.withColumn("_range", F.spark_partition_id()), "filing-ranges")
    row = F.struct(*order, "periodEnd")
    heads = keyed.groupBy("_range").agg(F.min(row).alias("_head"))
    after = heads.select("_range", F.lead("_head").over(W.Window.orderBy("_range")).alias("_head"))
    following = F.lead(row).over(W.Window.partitionBy("_range").orderBy(*order))
    both = keyed.withColumn("_next", following).join(after, "_range").withColumn("_next", F.coalesce("_next", "_head"))
    return both.filter(F.col("_next").isNotNull() & F.col("_next.edinetCode").eqNullSafe(F.col("edinetCode"))).select(
        "edinetCode",
        F.col("docID").alias("prev_doc"), F.col("periodStart").alias("prev_start"), F.col("periodEnd").alias("prev_end"),
        F.col("_next.docID").alias("cur_doc"), F.col("_next.periodStart").alias("cur_start"),
        F.col("_next.periodEnd").alias("cur_end"),
    )


def year_pairs(filings: DataFrame) -> DataFrame:
    """Neighbouring filings whose start and end both move by exactly one year.

    Filings that share a start date cannot be such a pair, so only the edges of each date
    count: one aggregation, then a step along the distinct dates of the company.
    """
    side = F.struct("docID", "periodEnd")
    ends = filings.groupBy("edinetCode", "periodStart").agg(
        F.min_by(side, "docID").alias("first"), F.max_by(side, "docID").alias("last")
    )
    along = W.Window.partitionBy("edinetCode").orderBy("periodStart")
    stepped = ends.select(
        "edinetCode",
        F.col("last.docID").alias("prev_doc"),
        F.col("periodStart").alias("prev_start"),
        F.col("last.periodEnd").alias("prev_end"),
        F.lead("first.docID").over(along).alias("cur_doc"),
        F.lead("periodStart").over(along).alias("cur_start"),
        F.lead("first.periodEnd").over(along).alias("cur_end"),
    )
    shifted = lambda a, b: one_year_later_day(day(F.col(a))) == day(F.col(b))
    return stepped.filter(shifted("prev_start", "cur_start") & shifted("prev_end", "cur_end"))


def latest_filings(filings: DataFrame, n: int) -> DataFrame:
    """The last ``n`` distinct filings per company by submit text, then id."""
    newest = W.Window.partitionBy("edinetCode").orderBy(
        F.desc(F.coalesce("submitDateTime", F.lit(""))), F.desc("docID")
    )
    # A filing listed on several days is one filing.
    distinct = filings.groupBy("edinetCode", "docID").agg(
        F.max("submitDateTime").alias("submitDateTime"), F.max("docDescription").alias("docDescription")
    )
    return distinct.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= n)


def yearly_filings(
    filings: DataFrame, n: int = 5, months: tuple[int, int] = (5, 7), wider: tuple[int, int] = (4, 8)
) -> DataFrame:
    """One plain annual report per company and submission year, searched for in ``months`` and
    only where there is none in ``wider``; the last submission wins; the last ``n`` years."""
    plain = filters.is_plain_annual(F.col("ordinanceCode"), F.col("formCode"), F.col("docDescription"))
    time = submit_time(F.col("submitDateTime"))
    dated = (
        filings.filter(plain)
        .withColumn("_time", time)
        .withColumn("year", F.year("_time"))
        .withColumn("_month", F.month("_time"))
        .filter(F.col("_month").between(*wider))
    )
    inner = F.col("_month").between(*months)
    per_year = pick(
        dated, ["edinetCode", "year"], [inner, F.col("submitDateTime"), F.col("docID")],
        ["docID", "submitDateTime", "docDescription"],
    )
    newest = W.Window.partitionBy("edinetCode").orderBy(F.desc("year"))
    return per_year.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= n)


def oldest_and_newest(filings: DataFrame, oldest: int = 3, newest: int = 2) -> DataFrame:
    """The first and last filings of each company by id; a filing in both counts once."""
    up = W.Window.partitionBy("edinetCode").orderBy("docID")
    down = W.Window.partitionBy("edinetCode").orderBy(F.desc("docID"))
    keys = filings.select("edinetCode", "docID")
    first = keys.withColumn("r", F.row_number().over(up)).filter(F.col("r") <= oldest)
    last = keys.withColumn("r", F.row_number().over(down)).filter(F.col("r") <= newest)
    return first.unionByName(last).select("edinetCode", "docID").distinct()


def first_filing(filings: DataFrame, entity: str, kind: str, start: str, end: str) -> DataFrame:
    """The first filing of one company and type submitted in a range of days."""
    submitted = day(F.substring("submitDateTime", 1, 10))
    kind_of = filters.report_type(F.col("ordinanceCode"), F.col("formCode"))
    hits = filings.filter(
        (F.col("edinetCode") == entity)
        & (kind_of == kind)
        & submitted.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    return hits.orderBy("submitDateTime", "docID").limit(1)


def company_years(companies: DataFrame, first: int, last: int) -> DataFrame:
    """Each company in each fiscal year."""
    return companies.withColumn(
        "fiscal_year", F.explode(F.sequence(F.lit(first), F.lit(last)))
    )
