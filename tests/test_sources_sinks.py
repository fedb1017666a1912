"""Files in and out."""

from __future__ import annotations

import json

from filing_helpers import fact, rows
from pyspark.sql import functions as F

from kessan import sinks, sources
from kessan.schema import COMPANY_FILE, FILING, MISSING_LOG
from kessan.streaming import land_new_fact_files


def test_fact_files_utf16_quotes_and_order(spark, corpus):
    corpus.add("E1", "S1", [fact("x:A", value='a "quoted"\nsecond line'), *(fact("x:B", value=str(i)) for i in range(500))])
    corpus.add("E2", "S2", [fact("x:A", value=None)])
    got = sources.read_fact_files(spark, corpus.pattern)
    assert rows(got.groupBy("doc_id", "entity_id").count(), "doc_id", "entity_id", "count") == [("S1", "E1", 501), ("S2", "E2", 1)]
    assert got.filter("element = 'x:A' and doc_id = 'S1'").first().value == 'a "quoted"\nsecond line'
    ordered = [r.value for r in got.filter("element = 'x:B'").orderBy("src_ord").collect()]
    assert ordered == [str(i) for i in range(500)]


def test_ragged_lines(spark, corpus):
    corpus.add("E1", "S1", [fact("x:A")], extra_lines=('"x:short"\t"l"', "\t".join(['"x:long"', *['"v"'] * 14])))
    got = {r.element: r.value for r in sources.read_fact_files(spark, corpus.pattern).collect()}
    assert got == {"x:A": "1", "x:short": None, "x:long": "v"}


def test_landed_copy_prunes_and_pushes_down(spark, corpus, tmp_path):
    corpus.add("E1", "S1", [fact("x:A"), fact("x:B")])
    sources.land_facts(sources.read_fact_files(spark, corpus.pattern), str(tmp_path / "landed"))
    narrow = sources.read_header_columns(spark, str(tmp_path / "landed")).filter("element = 'x:A'").select("doc_id")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(element,x:A)" in plan and "ReadSchema: struct<doc_id:string,element:string>" in plan
    assert narrow.count() == 1


def test_streaming_takes_each_file_once(spark, corpus, tmp_path):
    source, target, state = corpus.pattern, str(tmp_path / "landed"), str(tmp_path / "state")
    corpus.add("E1", "S1", [fact("x:A")])
    land_new_fact_files(spark, source, target, state).awaitTermination()
    corpus.add("E1", "S2", [fact("x:A"), fact("x:B")])
    land_new_fact_files(spark, source, target, state).awaitTermination()
    land_new_fact_files(spark, source, target, state).awaitTermination()
    got = sources.read_facts(spark, target).groupBy("doc_id", "entity_id").count()
    assert rows(got, "doc_id", "entity_id", "count") == [("S1", "E1", 1), ("S2", "E1", 2)]


def test_filing_metadata(spark, tmp_path):
    record = {name: None for name in FILING.names}
    good = {**record, "seqNumber": 1, "docID": "S1", "edinetCode": "E1", "legalStatus": 1, "filerName": "株式会社"}
    (tmp_path / "S1.json").write_text(json.dumps(good, ensure_ascii=False, indent=2), "utf-8")
    (tmp_path / "S2.json").write_text(json.dumps({**record, "edinetCode": "E2"}), "utf-8-sig")
    (tmp_path / "S3.json").write_text("{broken", "utf-8")
    got = sources.read_filing_metadata(spark, str(tmp_path / "*.json"))
    assert rows(got, "docID", "edinetCode", "legalStatus") == [("S1", "E1", "1"), ("S2", "E2", None)]


def test_index_responses(spark, tmp_path):
    filing = {name: "x" for name in FILING.names if name != "seqNumber"}
    day = {"metadata": {"title": "t", "status": "200"}, "results": [{**filing, "seqNumber": 1}, {**filing, "seqNumber": 2}]}
    (tmp_path / "a.json").write_text(json.dumps(day, indent=1), "utf-8")
    (tmp_path / "b.json").write_text(json.dumps({"metadata": {}, "results": []}), "utf-8")
    (tmp_path / "c.json").write_text(json.dumps({"metadata": {}}), "utf-8")
    assert rows(sources.read_index_responses(spark, str(tmp_path)), "seqNumber") == [(1,), (2,)]


def test_company_master(spark, tmp_path):
    header = ",".join(f'"{n}"' for n in COMPANY_FILE.names)
    row = ",".join(f'"v{i}"' for i in range(6)) + ',"株式会社テスト","n","k","東京","小売業","12340","1"'
    text = f"ダウンロード実行日,2024年,件数,1件\r\n{header}\r\n{row}\r\n"
    (tmp_path / "master.csv").write_bytes(text.encode("shift_jis") + b"\x82\r\n")
    got = sources.read_company_master(spark, str(tmp_path / "master.csv"))
    assert rows(got, "entity_id", "name", "industry", "sec_code") == [("v0", "株式会社テスト", "小売業", "12340")]


def test_listings_and_templates(spark, tmp_path):
    (tmp_path / "listing.csv").write_text("コード,銘柄名,市場・商品区分,33業種区分\n1301,極洋,プライム,水産・農林業\n", "utf-8")
    assert rows(sources.read_exchange_listing(spark, str(tmp_path / "listing.csv")), "code", "market") == [("1301", "プライム")]
    (tmp_path / "template.csv").write_text("項目,Y1,Y2\n売上高,,\n,,\n 総資産 ,,\n", "utf-8")
    template = sources.read_template(spark, str(tmp_path / "template.csv"))
    assert sources.template_items(template) == ["売上高", "総資産"]
    (tmp_path / "codes.txt").write_text("1435\n 1518 \n\n", "utf-8")
    assert rows(sources.read_ticker_list(spark, str(tmp_path / "codes.txt")), "ticker") == [("1435",), ("1518",)]
    (tmp_path / "filings.csv").write_text("﻿doc_id,submitDateTime,docDescription\nS1,2024-01-01 09:00,d\n", "utf-8")
    assert rows(sources.read_filings_list(spark, str(tmp_path / "filings.csv")), "doc_id") == [("S1",)]


def test_corpus_listing(spark, corpus):
    corpus.add("E1", "S1", [fact("x:A")])
    corpus.add("E2", "S2", [fact("x:A")])
    got = sources.list_corpus(spark, str(corpus.root))
    assert rows(got, "entity_id", "doc_id") == [("E1", "S1"), ("E2", "S2")]


def test_marked_csv_and_empty_log(spark, tmp_path):
    df = spark.createDataFrame([("売上高", "1", None)], "`項目` string, Y1 string, Y2 string")
    sinks.write_marked_csv(df.coalesce(1), str(tmp_path / "wide"), sep="\t")
    (part,) = (tmp_path / "wide").glob("part-*")
    assert part.read_bytes().decode("utf-8").splitlines() == ["﻿項目\tY1\tY2", "売上高\t1\t"]
    sinks.write_log(spark.createDataFrame([], MISSING_LOG), str(tmp_path / "log"))
    lines = [p.read_text() for p in (tmp_path / "log").glob("part-*")]
    assert lines == ["edinet_code,fiscal_year,tsv_path,missing_reason\n"]


def test_json_lines_keep_nulls_and_text(spark, tmp_path):
    df = spark.createDataFrame([("表", None)], "a string, b string")
    sinks.write_json_lines(df, str(tmp_path / "json"))
    assert [p.read_text("utf-8") for p in (tmp_path / "json").glob("part-*") if p.stat().st_size] == ['{"a":"表","b":null}\n']


def test_metadata_sink_is_keyed_by_type_and_company(spark, tmp_path):
    df = spark.createDataFrame([("S1", "E1", "annual"), ("S2", "E1", "annual")], "docID string, edinetCode string, doc_type string")
    sinks.write_filing_metadata(df, str(tmp_path / "m"))
    files = list((tmp_path / "m" / "doc_type=annual" / "entity_id=E1").glob("part-*"))
    assert len(files) == 1 and len(files[0].read_text().splitlines()) == 2


def test_tables_are_listed(spark):
    sinks.register_view(spark.range(3).withColumn("x", F.lit(1)), "some_view")
    assert "some_view" in {r.tableName for r in sources.list_tables(spark).collect()}
