"""The landed lake, the statement core's plan, and the band join."""

from __future__ import annotations

import random
import re

import pytest
from filing_helpers import SF_DIR, fact, rows
from pyspark.sql import functions as F

from kessan import sources
from kessan.operators import audit, joins, select
from kessan.operators.facts import FACT_KEYS, header_side, prints, unique_facts
from kessan.plans import accruals, exports
from kessan.plans.statements import statements
from kessan.queries.bind import Tables
from kessan.sources import lake
from kessan.streaming import land_new_fact_files


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def header(**values):
    names = {"standard": "jpdei_cor:AccountingStandardsDEI", "start": "jpdei_cor:CurrentFiscalYearStartDateDEI"}
    return [fact(names[k], context="FilingDateInstant", value=v) for k, v in values.items()]


def test_two_streamed_batches_leave_manifest_and_headers(spark, corpus, tmp_path):
    target, state = str(tmp_path / "lake"), str(tmp_path / "state")
    corpus.add("E1", "S1", header(standard="Japan GAAP", start="2020-04-01"))
    land_new_fact_files(spark, corpus.pattern, target, state).awaitTermination()
    corpus.add("E1", "S2", [*header(standard="IFRS"), fact("ifrs-full:Revenue")])
    corpus.add("E2", "S3", [fact("x:A"), fact("x:B"), fact("x:C")])
    land_new_fact_files(spark, corpus.pattern, target, state).awaitTermination()
    manifest = sources.read_manifest(spark, target)
    assert rows(manifest, "doc_id", "entity_id", "n_rows", "batch") == [("S1", "E1", 2, 0), ("S2", "E1", 2, 1), ("S3", "E2", 3, 1)]
    assert all(r.file.endswith(f"/{r.entity_id}/{r.doc_id}.tsv") and r.file_bytes > 0 for r in manifest.collect())
    landed = sources.read_headers(spark, target)
    again = header_side(sources.read_facts(spark, target))
    columns = ("doc_id", "standard", "year_start", "uses_other")
    assert rows(landed, *columns) == rows(again, *columns) == [("S1", "Japan GAAP", "2020-04-01", False), ("S2", "IFRS", None, True)]
    filings = spark.createDataFrame([("S1",), ("S9",), ("S3",)], "docID string")
    found = joins.with_facts(filings, manifest)
    assert rows(found, "docID") == [("S1",), ("S3",)]
    assert found.inputFiles() and all("/_manifest/" in f for f in found.inputFiles())
    entities = manifest.select("doc_id", "entity_id")
    made, kept = accruals.filing_headers(sources.read_facts(spark, target), entities), accruals.headers_of_side(landed, entities)
    assert rows(made, *made.columns) == rows(kept, *made.columns)


def test_a_repeated_batch_counts_once(spark, tmp_path):
    facts = spark.createDataFrame([("S1", "E1", "x:A", *[None] * 7, 1)], sources.facts.FACTS)
    for _ in range(2):
        lake.land_batch(facts, str(tmp_path), 7)
    assert sources.read_facts(spark, str(tmp_path)).count() == 1 and lake.read_manifest(spark, str(tmp_path)).first().n_rows == 1


def test_core_reads_facts_once_and_places_them_once(spark):
    t = Tables(spark, SF_DIR)
    facts = t.facts.select(*(c for c in t.facts.columns))
    plan = plan_of(statements(facts))
    assert "SortAggregate" not in plan and len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert len(re.findall(r"FileScan parquet", plan)) == 3  # the three tables the facts are bound to, each once
    assert len(re.findall(r"[+-] Sort |: Sort |  Sort ", plan)) <= 1
    landed = "facts_by_filing"
    lake.land_by_filing(facts, landed, 4)
    placed = plan_of(statements(lake.read_by_filing(spark, landed), placed=True))
    assert "Exchange hashpartitioning" not in placed and "SortAggregate" not in placed
    spark.sql(f"DROP TABLE {landed}")


def test_prints_tell_nulls_and_places_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), (None, None), ("", None), ("a", "")], "x string, y string")
    assert df.select(*prints("x", "y")).distinct().count() == 5


def test_unique_facts_keep_the_smallest_value(spark):
    keys = ", ".join(f"{c} string" for c in FACT_KEYS)
    data = [("S", *"abcde", v) for v in ("9", "10", None, "7")] + [("S", None, *"bcde", None), ("T", *"abcde", "0")]
    got = unique_facts(spark.createDataFrame(data, f"doc_id string, {keys}, value string"))
    assert rows(got.filter("element IS NOT NULL"), "doc_id", "value") == [("S", "10"), ("T", "0")] and got.count() == 3


@pytest.mark.parametrize("tolerance,seed", [(0.5, 1), (3.0, 2), (25.0, 3)])
def test_band_join_against_all_pairs(spark, tolerance, seed):
    dice = random.Random(seed)
    make = lambda n: [("EF"[dice.randrange(2)], f"d{i:03d}", dice.choice([dice.randrange(-60, 60) / 2, None, 7.0])) for i in range(n)]
    current, prior = make(180), make(160)
    schema = "entity_id string, doc_id string, amount double"
    got = joins.near_matches(spark.createDataFrame(current, schema), spark.createDataFrame(prior, schema), tolerance)
    want = []
    for e, doc, a in prior:
        hits = [d for f, d, b in current if f == e and a is not None and b is not None and d != doc and abs(a - b) <= tolerance]
        want += [(e, doc, a, min(hits))] if hits else []
    assert rows(got, "entity_id", "doc_id", "amount", "match_doc") == sorted(want)


def test_band_join_of_one_dense_block(spark):
    """100,000 distinct amounts inside one block, which all pairs would make ten thousand million of."""
    n = 100_000
    near = spark.range(n).selectExpr("'E' AS entity_id", f"lpad(CAST(id AS STRING), 6, '0') AS doc_id", f"id / {2 * n} AS amount")
    got = joins.near_matches(near, near).groupBy("match_doc").count()
    assert rows(got, "match_doc", "count") == [("000000", n - 1), ("000001", 1)]


def test_period_ends_are_refused_rather_than_cut(spark):
    long = spark.createDataFrame([(f"2020-01-{i:02d}",) for i in range(1, 6)], "periodEnd string")
    assert exports.period_ends(long) == [f"2020-01-{i:02d}" for i in range(1, 6)]
    with pytest.raises(ValueError, match="long export"):
        exports.period_ends(long, most=4)


def test_faulty_lines_are_kept_and_counted(spark, corpus, tmp_path):
    corpus.add("E1", "S1", [fact("x:A"), fact("x:B", value='a "q"\nnext line')], extra_lines=(
        '"x:short"\t"l"', "\t".join(['"x:long"', *['"v"'] * 14]), "\t".join(['"x:good"', *['"v"'] * 8])))
    corpus.add("E1", "S2", [fact("x:A")], extra_lines=('"x:open"\t"never closed', "\t".join(['"x:lost"', *["v"] * 8])))
    scan = sources.scan_fact_files(spark, corpus.pattern)
    used, kept, counts = sources.split_scan(scan, str(tmp_path / "scan"))
    assert rows(counts, "doc_id", "fault", "n") == [("S1", "long", 1), ("S1", "short", 1), ("S2", "quote", 1)]
    assert rows(used, "doc_id", "element") == [("S1", "x:A"), ("S1", "x:B"), ("S1", "x:good"), ("S1", "x:long"), ("S1", "x:short"), ("S2", "x:A")]
    assert used.filter("element = 'x:B'").first().value == 'a "q"\nnext line'
    assert used.filter("element = 'x:long'").first().value == "v" and used.filter("element = 'x:short'").first().value is None
    (lost,) = [r.bad_line for r in kept.filter("fault = 'quote'").collect()]
    assert "x:open" in lost and "x:lost" in lost
    whole = sources.scan_fact_files(spark, corpus.pattern.replace("*", "E1")).filter("doc_id = 'none'")
    assert sources.split_scan(whole, str(tmp_path / "empty"))[2].count() == 0


@pytest.fixture
def small_ranges(spark):
    """Small partitions stay apart, as large ones would."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_neighbours_of_a_company_with_half_the_filings_on_one_date(spark, small_ranges):
    """Its rows are dealt to several tasks, and no pair is lost at their borders."""
    n = 3000
    hot = spark.range(n).selectExpr("'hot' AS edinetCode", "lpad(CAST(id AS STRING), 5, '0') AS docID", "'2020-04-01' AS periodStart", "'2021-03-31' AS periodEnd")
    rest = spark.range(n).selectExpr("concat('E', id DIV 3) AS edinetCode", "lpad(CAST(id + 9000 AS STRING), 5, '0') AS docID",
                                     "CASE WHEN id % 7 = 0 THEN NULL ELSE concat('20', 10 + id % 3, '-01-01') END AS periodStart", "'x' AS periodEnd")
    filings = hot.union(rest)
    got = select.adjacent_filings(filings)
    ordered = sorted(filings.collect(), key=lambda r: (r.edinetCode, r.periodStart or "", r.docID))
    want = [(a.edinetCode, a.docID, b.docID, a.periodStart, b.periodStart) for a, b in zip(ordered, ordered[1:]) if a.edinetCode == b.edinetCode]
    assert sorted(map(tuple, got.select("edinetCode", "prev_doc", "cur_doc", "prev_start", "cur_start").collect()), key=str) == sorted(want, key=str)
    dealt = filings.repartitionByRange("edinetCode", "periodStart", "docID").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in dealt) < n


def test_id_texts_are_bounded_and_joined_give_the_list(spark):
    files = spark.createDataFrame([("E1", f"S{i:03d}") for i in range(25)] + [("E2", "S9")], "entity_id string, doc_id string")
    got = rows(audit.document_texts(files, chunk=10), "entity_id", "chunk", "tsv_count", "doc_ids")
    assert [r[1] for r in got] == [0, 1, 2, 0] and got[3][2:] == (1, "S9")
    assert ",".join(r[3] for r in got[:3]).split(",") == [f"S{i:03d}" for i in range(25)] and {r[2] for r in got[:3]} == {25}
