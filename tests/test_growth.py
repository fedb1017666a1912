"""What must not grow with the corpus: a file, a broadcast, the rows that are shuffled."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from filing_helpers import SF_DIR, rows
from pyspark.sql import functions as F

from kessan import sinks, sources
from kessan.functions.text import doc_id_of, entity_id_of
from kessan.plans import accruals
from kessan.queries.bind import Tables
from kessan.schema import FACT_FILE
from kessan.session import scratch_path


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FACT_FILE_LINES", 10)
    lines = spark.range(95).coalesce(1).select(*(F.col("id").cast("string").alias(c) for c in FACT_FILE.names))
    sinks.write_fact_files(lines, str(tmp_path / "annual" / "E1"))
    assert len(list((tmp_path / "annual" / "E1").glob("*.csv"))) == 10
    got = sources.read_fact_files(spark, str(tmp_path / "annual" / "*"))
    assert sorted(int(r.value) for r in got.collect()) == list(range(95))


def test_names_from_paths(spark):
    paths = [
        "file:///a/annual/E1/S1.tsv", "annual/E1/S1.v2.tsv", "E1/S1", "S1.tsv", "/S1.tsv", "a//S1", "a/b/", "E1/.tsv", "E1/..tsv", "E1/S1.", "", None,
    ]
    found = spark.createDataFrame([(p,) for p in paths], "path string")
    path = F.col("path")
    old = F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1), F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    for r in found.select("path", doc_id_of(path).alias("a"), entity_id_of(path).alias("b"), old[0].alias("c"), old[1].alias("d")).collect():
        assert (r.a, r.b) == (r.c, r.d), r.path
    assert "regexp_extract" not in plan_of(found.select(doc_id_of(path), entity_id_of(path)))


def test_company_years_are_not_broadcast(spark):
    t = Tables(spark, SF_DIR)
    companies = t.companies.select(
        F.col("entity_id").alias("edinet_code"), "sec_code", F.col("name").alias("company_name"), "industry", F.col("listing").alias("market")
    )
    log = accruals.receivables_log(accruals.accrual_rows(t.facts, t.entities, companies))
    assert re.search(r"SortMergeJoin \[entity_id[^\]]*fiscal_year", plan_of(log))


def test_chosen_filings_are_found_among_narrow_rows(spark):
    """No whole fact is shuffled to find those of the chosen filings."""
    from kessan.plans.statements import statements

    t = Tables(spark, SF_DIR)
    docs = t.annual.select(F.col("docID").alias("doc_id"))
    parsed = statements(t.facts, docs=docs)
    for exchange in re.findall(r"Exchange hashpartitioning\([^\n]*\n[^\n]*", plan_of(parsed)):
        assert "rel_year" not in exchange
    kept = {r.doc_id for r in docs.collect()}
    columns = "doc_id", "statement", "item", "value"
    text = lambda df: sorted(map(str, rows_of(df)))
    rows_of = lambda df: [r for r in df.select(*columns).collect() if r.doc_id in kept]
    assert text(parsed) == text(statements(t.facts)) and {r.doc_id for r in parsed.collect()} <= kept


def test_tasks_that_make_facts_are_bounded(spark, monkeypatch):
    from kessan.queries import bind

    monkeypatch.setattr(bind, "ROWS_A_TASK", 100)
    t = Tables(spark, SF_DIR)
    lines = t.raw("lineitem")
    assert t.line_facts.rdd.getNumPartitions() >= lines.count() // 100


def test_facts_of_a_line_by_either_expressions(spark):
    from kessan.queries import bind

    schema = ("l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double, l_tax double, "
              "l_returnflag string, l_linestatus string")
    lines = [(o, p, n, price, tax, flag, status) for o, (p, n, price, tax, flag, status) in enumerate([
        (7, 1, 10.5, 0.01, "A", "F"), (8, 5, 99.99, 0.07, "N", "O"), (9, 7, 0.0, 0.08, "R", "F"), (None, 5, 3.0, 0.066, None, None),
        (11, None, 4.25, None, "N", "F"), (12, 2, None, 0.02, "A", "O"), (13, 7, -5.5, 0.07, "R", None)])]
    made = spark.createDataFrame(lines, schema)
    whole = made.select("*", bind._spark_line_facts()).select(*bind._spark_columns(bind.LINE_COLUMNS))
    shared = made.select(*bind._spark_columns(bind.LINE_SHARED)).select("*", bind._spark_line_facts())
    parts = shared.select(*bind._spark_columns(bind.FACT_OF_LINE))
    assert whole.schema.simpleString() == parts.schema.simpleString() and parts.count() == 14 * len(lines)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_facts_landed_by_filing_are_sent_without_what_can_be_made(spark, tmp_path):
    """And stored with the stronger compression; all columns and rows are there."""
    from kessan.sources import lake

    facts = Tables(spark, SF_DIR).facts.limit(500)
    lake.land_by_filing(facts, "facts_sent_narrow", 3)
    landed = lake.read_by_filing(spark, "facts_sent_narrow")
    assert landed.columns == [*facts.columns, "local_name"] and landed.count() == 500
    assert all(f.endswith(".zstd.parquet") for f in landed.inputFiles())
    spark.sql("DROP TABLE facts_sent_narrow")
    sources.land_facts(facts, str(tmp_path / "lake"))
    assert all(f.endswith(".zstd.parquet") for f in spark.read.parquet(str(tmp_path / "lake")).inputFiles())


def test_unique_facts_shuffle_no_prints(spark):
    from kessan.operators.facts import FACT_KEYS, unique_facts

    facts = Tables(spark, SF_DIR).facts
    assert "print1" not in plan_of(unique_facts(facts))
    want = facts.groupBy("doc_id", *FACT_KEYS).agg(F.min("value").alias("value"))
    assert sorted(map(str, unique_facts(facts).select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_folders_are_written_by_many_tasks_and_large_companies_by_several(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FILINGS_A_TASK", 50)
    filings = spark.range(600).selectExpr(
        "concat('S', id) AS docID", "CASE WHEN id % 2 = 0 THEN 'large' ELSE concat('E', id) END AS edinetCode", "'annual' AS doc_type"
    )
    sinks.write_filing_metadata(filings, str(tmp_path / "m"))
    files = [f for f in (tmp_path / "m").rglob("part-*")]
    of_large = [f for f in files if f.parent.name == "entity_id=large"]
    assert 1 < len(of_large) <= 6 and len(files) - len(of_large) == 300
    assert len({f.name.split("-")[1] for f in files}) > 3
    assert sources.read_filing_metadata(spark, str(tmp_path / "m"), one_per_file=False).select("docID").distinct().count() == 600


def test_sorts_of_the_core_compare_a_number_first(spark):
    from kessan.plans.statements import statements

    (sort,) = re.findall(r"Sort \[([^\]]*)", plan_of(statements(Tables(spark, SF_DIR).facts)))
    assert sort.startswith("doc#")


def test_rows_are_made_once_before_they_are_ordered(spark):
    from kessan.operators.tables import in_order

    made = spark.range(9).selectExpr("CAST(id AS STRING) AS doc_id", "id % 3 AS place").repartition("doc_id")
    plan = plan_of(in_order(made.groupBy("doc_id", "place").count(), "doc_id", "place"))
    steps = [plan.index(step) for step in ("rangepartitioning", "hashpartitioning(doc_id#", "HashAggregate")]
    assert steps == sorted(steps) and plan.count("Exchange hashpartitioning") == 2


def test_a_statement_alone_is_its_part_of_both(spark):
    from kessan.queries.aggregates import bs_pl

    t = Tables(spark, SF_DIR)
    text = lambda df: sorted(map(str, df.collect()))
    for name in ("BS", "PL"):
        assert text(bs_pl(t, name)) == text(bs_pl(t).filter(F.col("statement") == name))


def test_statements_of_few_copies_are_shuffled_once(spark):
    """By filing, one filing behind the other, and nothing meets by all its columns before; rows are the same, with copies too."""
    from kessan.plans.statements import BODY, statements
    from kessan.queries.aggregates import rows_of as statement_rows_of

    t = Tables(spark, SF_DIR)
    once = statements(t.facts, few_copies=True)
    assert re.findall(r"Exchange hashpartitioning\(([a-z_]+)#", plan_of(once)) == ["doc_id"] and "Aggregate" not in plan_of(once)
    assert re.findall(r"Exchange hashpartitioning\(([a-z_]+)#", plan_of(statement_rows_of(t))) == ["doc_id"]
    text = lambda df: sorted(map(str, df.collect()))
    want = text(statements(t.facts))
    assert text(once) == want
    higher = F.when(F.col("src_ord") % 2 == 0, F.concat(F.lit("\U0010ffff"), "value"))
    copies = t.facts.unionByName(t.facts).unionByName(t.line_facts.withColumn("value", higher))
    assert text(statements(copies, few_copies=True)) == want
    assert text(statements(t.facts, only=BODY, few_copies=True)) == [r for r in want if "statement='META'" not in r]


def test_faulty_files_are_packed(spark, monkeypatch):
    from kessan.queries import all_queries, storage

    folder = []
    monkeypatch.setattr(storage, "scratch_path", lambda spark, name: folder.append(scratch_path(spark, name)) or folder[-1])
    got = all_queries()["faulty_lines_accounted"](spark, SF_DIR)
    files = [f for kind in ("none", "short", "long") for f in Path(folder[0], "annual", kind).glob("part-*")]
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    assert all(f.name.endswith(".zstd.parquet") for f in Path(folder[0], "landed", "lines").glob("part-*"))
    assert got.agg(F.sum("n")).first()[0] == Tables(spark, SF_DIR).header_facts.count() + Tables(spark, SF_DIR).text_facts.count()


def test_facts_are_landed_and_told_apart_in_rounds(spark, monkeypatch):
    """With the same rows, one file a bucket, and no shuffle files of one round left for the next."""
    from kessan.queries import all_queries, bind
    from kessan.sources import lake

    t, made = Tables(spark, SF_DIR), all_queries()
    text = lambda df: sorted(map(str, df.collect()))
    lake.land_by_filing(t.facts, "facts_in_rounds", 5, 3)
    lake.land_by_filing(t.facts, "facts_at_once", 5)
    landed = spark.table("facts_in_rounds")
    assert len(landed.inputFiles()) == 5 and landed.exceptAll(spark.table("facts_at_once")).count() == 0 and landed.count() == t.facts.count()
    for name in ("facts_in_rounds", "facts_at_once"):
        spark.sql(f"DROP TABLE {name}")
    want = text(made["unique_facts"](spark, SF_DIR))
    monkeypatch.setattr(bind, "LINES_A_ROUND", 2000)
    assert Tables(spark, SF_DIR).rounds > 2
    assert text(made["unique_facts"](spark, SF_DIR)) == want
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
