"""Queries that write through a sink and read back through a source."""

from __future__ import annotations

from pyspark.sql import functions as F

from kessan import sinks, sources
from kessan.operators import companies
from kessan.plans import filing_index
from kessan.queries import steps
from kessan.queries.aggregates import bs_pl
from kessan.queries.bind import FILINGS
from kessan.queries.registry import query
from kessan.schema import COMPANY_FILE, COMPANY_FILE_COLUMNS, FACT_FILE_COLUMNS, FILING, LISTING_FILE_COLUMNS
from kessan.session import scratch_path


@query(
    "fact_files_read_back", "S1 S2",
    "SELECT element, label, count(*) AS n, count(value) AS n_value, count(DISTINCT value) AS n_values FROM (SELECT element, label, nullif(value, '') AS value FROM header_facts) GROUP BY element, label",
    "header_facts",
)
def _(t):
    path = scratch_path(t.spark, "fact-files")
    names = {v: k for k, v in FACT_FILE_COLUMNS.items()}
    rows = t.header_facts.withColumn("unit_id", F.lit(None).cast("string"))
    shaped = rows.select(*(F.col(v).alias(k) for v, k in names.items()))
    sinks.write_fact_files(shaped, f"{path}/annual/E1")
    read = sources.read_fact_files(t.spark, f"{path}/annual/*")
    return read.groupBy("element", "label").agg(
        F.count("*").alias("n"), F.count("value").alias("n_value"), F.countDistinct("value").alias("n_values")
    )


_FAULT = (
    "CASE CAST(substr(doc_id, 2) AS BIGINT) % 50 WHEN 1 THEN 'short' WHEN 2 THEN 'long' ELSE 'none' END"
)


@query(
    "faulty_lines_accounted", "S1 S2",
    f"SELECT element, {_FAULT} AS fault, count(*) AS n, count(CASE WHEN {_FAULT} <> 'short' AND nullif(value, '') IS NOT NULL THEN 1 END) AS n_value, "
    f"CASE WHEN {_FAULT} = 'none' THEN 0 ELSE count(*) END AS n_kept FROM (SELECT * FROM header_facts UNION ALL SELECT * FROM text_facts) GROUP BY 1, 2",
    "header_facts text_facts",
)
def _(t):
    """All header and text facts, with quotes and line breaks too, as files in which some filings' lines lack
    two cells and some have three too many; every line is used, and every faulty one kept whole."""
    path = scratch_path(t.spark, "faulty-files")
    cells = [F.lit("") if c == "unit_id" else F.coalesce(F.col(c), F.lit("")) for c in FACT_FILE_COLUMNS.values()]
    shapes = {"none": cells, "short": cells[:-2], "long": [*cells, *[F.lit("more")] * 3]}
    for fault, shape in shapes.items():
        lines = t.header_facts.unionByName(t.text_facts).filter(F.expr(_FAULT) == fault).select(*(c.alias(f"c{i}") for i, c in enumerate(shape)))
        # UTF-16 takes two bytes a character; the reader opens packed files by their names.
        sinks.write_fact_files(lines, f"{path}/annual/{fault}", quoteAll=True, compression="gzip")
    scan = sources.scan_fact_files(t.spark, f"{path}/annual/*")
    used, kept, _ = sources.split_scan(scan, f"{path}/landed")
    found = used.select("element", F.coalesce("fault", F.lit("none")).alias("fault"), "value", F.lit(0).cast("long").alias("kept"))
    first = F.regexp_extract("bad_line", '^"?([^"\\t]*)', 1)
    both = found.union(kept.select(first, "fault", F.lit(None).cast("string"), F.lit(1).cast("long")))
    return both.groupBy("element", "fault").agg(
        F.sum(1 - F.col("kept")).alias("n"), F.count("value").alias("n_value"), F.sum("kept").alias("n_kept")
    )


@query(
    "landed_facts_read_back", "S1 S3 K1",
    "SELECT element, count(*) AS n, count(value) AS n_value FROM facts WHERE element LIKE 'jpdei%' GROUP BY element",
    "facts",
)
def _(t):
    path = scratch_path(t.spark, "landed-facts")
    sources.land_facts(t.facts.withColumn("entity_id", F.lit(None).cast("string")), path)
    read = sources.read_header_columns(t.spark, path).filter(F.col("element").startswith("jpdei"))
    return read.groupBy("element").agg(F.count("*").alias("n"), F.count("value").alias("n_value"))


_FILING_COLUMNS = ", ".join(f'{c} AS "{c}"' for c in FILINGS)


@query(
    "filing_metadata_read_back", "S4 K5",
    f"SELECT {_FILING_COLUMNS} FROM filings WHERE {steps.REPORT_TYPE} = 'semiannual_amended' AND withdrawalStatus <> '1'",
    "filings",
)
def _(t):
    path = scratch_path(t.spark, "filing-metadata")
    wanted = filing_index.wanted_filings(t.filings, "semiannual_amended")
    sinks.write_filing_metadata(wanted, path)
    return sources.read_filing_metadata(t.spark, path, one_per_file=False).select(*FILINGS)


@query(
    "index_responses_read_back", "S5 M3",
    f"SELECT {_FILING_COLUMNS} FROM filings WHERE withdrawalStatus = '0'",
    "filings",
)
def _(t):
    path = scratch_path(t.spark, "index-responses")
    fields = [
        F.col(f.name) if f.name in FILINGS else F.lit(None).cast(f.dataType).alias(f.name) for f in FILING.fields
    ]
    # A response whose filing is withdrawn comes back empty.
    results = F.when(F.col("withdrawalStatus") == "0", F.array(F.struct(*fields)))
    meta = F.struct(F.lit("documents").alias("title"), F.lit("200").alias("status"))
    sinks.write_json_lines(t.filings.select(meta.alias("metadata"), results.alias("results")), path)
    return sources.read_index_responses(t.spark, path, one_per_file=False).select(*FILINGS)


@query(
    "company_master_read_back", "S6 M6",
    "SELECT entity_id, name, industry, sec_code, listing FROM (SELECT * REPLACE (nullif(sec_code, '') AS sec_code) FROM companies)",
    "companies",
)
def _(t):
    path = scratch_path(t.spark, "company-master")
    t.spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    have = {k: v for k, v in COMPANY_FILE_COLUMNS.items() if v in t.companies.columns}
    columns = [
        F.col(have[n]).alias(n) if n in have else F.lit("x").alias(n) for n in COMPANY_FILE.names
    ]
    t.companies.select(*columns).write.option("header", True).option("encoding", "Shift_JIS").option(
        "escape", '"'
    ).csv(path)
    return sources.read_company_master(t.spark, path).select("entity_id", "name", "industry", "sec_code", "listing")


@query(
    "exchange_listing_read_back", "S7 M7 K2",
    "SELECT code, name, market, industry FROM listing",
    "listing",
)
def _(t):
    path = scratch_path(t.spark, "listing")
    sinks.write_csv(t.listing.select(*(F.col(v).alias(k) for k, v in LISTING_FILE_COLUMNS.items())), path)
    return sources.read_exchange_listing(t.spark, path)


@query(
    "company_list_read_back", "S7 K2",
    "SELECT edinet_code, company_name, file_count FROM counted WHERE file_count >= 10",
    "counted",
)
def _(t):
    path = scratch_path(t.spark, "company-list")
    sinks.write_csv(companies.complete(companies.filings_per_company(t.filings)), path)
    return sources.read_company_list(t.spark, path)


@query("ticker_list_read_back", "S8", "SELECT code AS ticker FROM listing", "listing")
def _(t):
    path = scratch_path(t.spark, "tickers")
    t.listing.select(F.concat(F.lit(" "), "code", F.lit(" ")).alias("value")).write.text(path)
    return sources.read_ticker_list(t.spark, path)


@query(
    "statement_rows_read_back", "S9 K1 M8",
    "SELECT doc_id, item, period, value, value_num FROM rows_num WHERE statement = 'PL'",
    "rows_num",
)
def _(t):
    path = scratch_path(t.spark, "statement-rows")
    sinks.write_statement_rows(bs_pl(t), path)
    rows = sources.read_statement_rows(t.spark, path).filter("statement = 'PL'")
    return rows.select("doc_id", "item", "period", "value", "value_num")


@query(
    "judgements_read_back", "S10 K4 K7 M12",
    "SELECT amended_doc_id, original_doc_id, company_name, is_accounting_fraud, explanation, amended_pdf_path FROM judgements",
    "judgements",
)
def _(t):
    path = scratch_path(t.spark, "judgements")
    sinks.write_judgements(t.judgements, path)
    return sources.read_judgements(t.spark, path)


@query(
    "corpus_listing", "S11",
    f"SELECT edinetCode AS entity_id, count(*) AS has_files FROM (SELECT DISTINCT edinetCode FROM filings WHERE {steps.REPORT_TYPE} = 'semiannual_amended' "
    "AND withdrawalStatus <> '1') GROUP BY edinetCode",
    "filings",
)
def _(t):
    path = scratch_path(t.spark, "corpus")
    sinks.write_filing_metadata(filing_index.wanted_filings(t.filings, "semiannual_amended"), path)
    files = sources.list_corpus(t.spark, path, "json").select("entity_id").distinct()
    entity = F.regexp_replace("entity_id", "^entity_id=", "")
    return files.groupBy(entity.alias("entity_id")).agg(F.count("*").alias("has_files"))


@query(
    "wide_export_read_back", "S12 K3",
    "SELECT CAST(c_custkey AS STRING) AS \"項目\", c_name AS \"Y1\", c_mktsegment AS \"Y2\" FROM customer",
)
def _(t):
    path = scratch_path(t.spark, "wide-export")
    wide = t.raw("customer").select(
        F.col("c_custkey").cast("string").alias("項目"), F.col("c_name").alias("Y1"), F.col("c_mktsegment").alias("Y2")
    )
    sinks.write_marked_csv(wide, path, sep="\t")
    read = sources.read_wide_export(t.spark, path)
    return read.toDF(*(c.lstrip(sinks.BYTE_ORDER_MARK) for c in read.columns))


@query(
    "registered_tables", "S13 K6",
    "SELECT formCode AS name, count(*) AS n FROM filings GROUP BY formCode UNION ALL SELECT 'registered', 2",
    "filings",
)
def _(t):
    counts = t.filings.groupBy("formCode").agg(F.count("*").alias("n"))
    sinks.register_table(counts, "kessan_form_counts", scratch_path(t.spark, "form-counts"))
    sinks.register_view(t.spark.table("kessan_form_counts"), "kessan_form_view")
    names = sources.list_tables(t.spark).filter(F.col("tableName").isin("kessan_form_counts", "kessan_form_view"))
    registered = names.agg(F.count("*").alias("n")).select(F.lit("registered").alias("name"), "n")
    return t.spark.table("kessan_form_view").select(F.col("formCode").alias("name"), "n").unionByName(registered)


@query(
    "empty_log_keeps_header", "K8 M10",
    "SELECT 'edinet_code,fiscal_year,tsv_path,missing_reason' AS line, 1 AS n UNION ALL SELECT 'listed', count(*) FROM companies WHERE listing = '上場'",
    "companies",
)
def _(t):
    from kessan.schema import MISSING_LOG

    path = scratch_path(t.spark, "empty-log")
    none = t.companies.filter("entity_id is null").select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in MISSING_LOG.fields)
    )
    sinks.write_log(none, path)
    lines = t.spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))
    listed = t.companies.filter("listing = '上場'").agg(F.count("*").alias("n"))
    return lines.unionByName(listed.select(F.lit("listed").alias("line"), "n"))
