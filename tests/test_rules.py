"""One small filing per rule of reading statements from facts."""

from __future__ import annotations

import pytest
from filing_helpers import fact, rows
from pyspark.sql import functions as F

from kessan.operators.facts import Measure, candidate_availability, fallback_values, header_values, unique_facts
from kessan.plans.accruals import basis_and_values
from kessan.plans.statements import sections, statement_maps, statements
from kessan.sources import read_fact_files
from kessan.vocab import builtin_vocab, read_vocab

FLAG = "jpdei_cor:WhetherConsolidatedFinancialStatementsArePreparedDEI"


@pytest.fixture
def parse(spark, corpus):
    def run(**docs):
        for doc, facts_ in docs.items():
            corpus.add("E1", doc, facts_)
        return statements(read_fact_files(spark, corpus.pattern))

    return run


def test_element_matches_with_and_without_ifrs_ending(parse):
    found = parse(
        a=[fact("x:NetSales", value="5")], b=[fact("y:NetSalesIFRS", value="6")], c=[fact("x:OtherNetSales")], d=[fact("NetSales")]
    )
    assert rows(found, "doc_id", "item", "value") == [("a", "売上高", "5"), ("b", "売上高", "6")]


def test_only_a_single_fact_counts(parse):
    found = parse(
        both=[fact("x:NetSales"), fact("x:NetSales", "CurrentYearInstant")],
        one=[fact("x:NetSales", "CurrentYearInstant", "7")],
        twins=[fact("x:NetSales"), fact("x:NetSalesIFRS")],
    )
    assert rows(found, "doc_id", "value") == [("one", "7")]


def test_consolidated_only(parse):
    found = parse(
        a=[fact("x:NetSales", consol="個別")],
        b=[fact("x:Assets", "CurrentYearInstant_NonConsolidatedMember")],
        c=[fact("x:Assets", "CurrentYearInstant", "3", consol="その他")],
        d=[fact("x:Assets", "CurrentYearInstant", "3", consol=None)],
    )
    assert rows(found, "doc_id", "value") == [("c", "3")]


def test_later_leaf_replaces_all_periods_of_an_earlier_one(parse):
    found = parse(
        a=[
            fact("x:OperatingProfitLoss", "CurrentYearDuration", "1"),
            fact("x:OperatingProfitLoss", "Prior1YearDuration", "2"),
            fact("x:OperatingIncome", "CurrentYearDuration", "3"),
        ]
    )
    assert rows(found, "item", "period", "value") == [("営業利益", "CurrentYear", "3")]


def test_header_item_takes_its_last_period(parse):
    name = "jpcrp_cor:CompanyNameCoverPage"
    found = parse(a=[fact(name, "CurrentYearInstant", "old"), fact(name, "FilingDateInstant", "new")])
    assert rows(found, "statement", "item", "period", "value") == [("META", "会社名", None, "new")]


def test_unconsolidated_filing_yields_nothing(parse):
    sales = fact("x:NetSales")
    flag = lambda v: fact(FLAG, "FilingDateInstant", v, consol="その他")
    found = parse(no=[sales, flag("false")], yes=[sales, flag("true")], absent=[sales])
    assert {r.doc_id for r in found.collect()} == {"yes", "absent"}


def test_copies_leave_the_smallest_value(parse, spark, corpus):
    found = parse(a=[fact("x:NetSales", value="5"), fact("x:NetSales", value="4"), fact("x:NetSales", value="5")])
    assert rows(found, "value") == [("4",)]
    assert unique_facts(read_fact_files(spark, corpus.pattern)).count() == 1


def test_empty_value_of_a_single_fact_is_kept_as_null(parse):
    found = parse(a=[fact("x:NetSales", value=None)])
    assert rows(found, "item", "value") == [("売上高", None)]
    text = sections(found).first()
    assert text.pl == '{"売上高":{"CurrentYear":null}}' and text.bs == "{}" and text.meta == "{}"


def test_summary_and_text_from_the_dictionary(parse):
    found = parse(
        a=[
            fact("x:NetAssetsSummaryOfBusinessResults", "CurrentYearInstant", "9", label="own"),
            fact("x:NetCashProvidedByUsedInInvestingActivitiesSummaryOfBusinessResults", value="8", label="own"),
            fact("x:NumberOfEmployees", "CurrentYearInstant", "7", label="own"),
            fact("x:BusinessRisksTextBlock", "FilingDateInstant", 'line "one"\nline two\t', label="own"),
            fact("x:NoteOnIndependentAuditFinancialInformation", "FilingDateInstant", "n", label="own"),
            fact("x:SomeOtherTextBlock", "FilingDateInstant", "unlisted", label="own"),
        ]
    )
    text = sections(found).first()
    assert text.summary == (
        '{"純資産額":{"CurrentYear":"9"},"投資活動によるキャッシュ・フロー":{"CurrentYear":"8"},"従業員数":{"CurrentYear":"7"}}'
    )
    assert text.text == (
        '{"事業等のリスク":{"FilingDate":"line \\"one\\"\\nline two\\t"},"監査証明について、経理の状況":{"FilingDate":"n"}}'
    )
    assert "unlisted" not in "".join(str(x) for x in text)
    assert {r.statement for r in found.collect()} >= {"SUMMARY", "BS", "CF", "TEXT"}


def test_a_vocabulary_file_replaces_the_builtin_one(spark, corpus, tmp_path):
    (tmp_path / "vocab.csv").write_text("statement,ord,element,item\nSUMMARY,1,NetSalesSummaryOfBusinessResults,売上\n", "utf-8")
    corpus.add("E1", "a", [fact("x:NetSalesSummaryOfBusinessResults"), fact("x:BusinessRisksTextBlock")])
    vocab = read_vocab(spark, str(tmp_path / "vocab.csv"))
    found = statements(read_fact_files(spark, corpus.pattern), vocab)
    assert rows(found, "statement", "item") == [("SUMMARY", "売上")]


def test_nested_maps(parse):
    found = parse(a=[fact("x:NetSales", value="1"), fact("x:NetSales", "Prior1YearDuration", "2")])
    maps = {r.statement: r["items"] for r in statement_maps(found).collect()}
    assert maps == {"PL": {"売上高": {"Prior1Year": "2", "CurrentYear": "1"}}}


def test_builtin_vocabulary_repeats_labels_as_it_should(spark):
    counts = {
        r.statement: (r.n, r.labels)
        for r in builtin_vocab(spark).groupBy("statement").agg(F.count("*").alias("n"), F.countDistinct("item").alias("labels")).collect()
    }
    assert counts == {"META": (12, 12), "SUMMARY": (27, 27), "TEXT": (50, 50), "BS": (95, 89), "PL": (41, 37), "CF": (42, 39)}


def test_header_value_is_the_last_in_file_order(spark, corpus):
    name = "jpdei_cor:CurrentFiscalYearStartDateDEI"
    corpus.add("E1", "a", [fact(name, value="2020-04-01"), *(fact("x:y", value=str(i)) for i in range(50)), fact(name, value="2021-04-01")])
    found = header_values(read_fact_files(spark, corpus.pattern), [name])
    assert found.first()[name] == "2021-04-01"


REC = Measure("rec", ("First", "Second"), "当期末", "時点")


def end(element, value, context="CurrentYearInstant", **more):
    return fact(f"jppfs_cor:{element}", context, value, rel_year="当期末", period_type="時点", **more)


def fallback(spark, corpus, facts_, consolidated=True):
    corpus.add("E1", "a", facts_)
    prefers = F.lit(consolidated)
    return fallback_values(read_fact_files(spark, corpus.pattern), [REC], "連結", "個別", prefers).first()


def test_first_candidate_with_a_number_wins_and_its_largest(spark, corpus):
    got = fallback(spark, corpus, [end("First", "－"), end("Second", "3"), end("Second", "8", "x"), end("Second", "△9", "y")])
    assert (got.rec, got.rec_element) == (8.0, "Second")


def test_segments_do_not_count_but_below_non_consolidated_they_do(spark, corpus):
    got = fallback(
        spark, corpus,
        [
            end("First", "9", "CurrentYearInstant_ReportableSegmentsMember"),
            end("First", "4", "CurrentYearInstant_NonConsolidatedMember_ReportableSegmentsMember"),
            end("First", "99", None),
        ],
    )
    assert got.rec == 4.0


def test_units_scale(spark, corpus):
    got = fallback(spark, corpus, [end("First", "1,234", unit="千円")])
    assert got.rec == 1_234_000.0


def test_consolidated_basis_even_with_a_missing_sales_value(spark, corpus):
    sales = "jppfs_cor:NetSales"
    corpus.add("E1", "a", [fact(sales, value="－"), fact(sales, value="5", consol="個別")])
    corpus.add("E1", "b", [fact(sales, value="5", consol="個別")])
    got = {r.doc_id: (r.is_consolidated, r.rev_t) for r in basis_and_values(read_fact_files(spark, corpus.pattern)).collect()}
    assert got == {"a": (True, None), "b": (False, 5.0)}


def test_availability_lists_others_where_no_candidate_is(spark, corpus):
    corpus.add("E1", "a", [end("First", "1")])
    corpus.add("E1", "b", [end("SomeReceivables", "2")])
    corpus.add("E1", "c", [end("Land", "3")])
    got = candidate_availability(read_fact_files(spark, corpus.pattern), ["First"])
    assert rows(got, "doc_id", "kind", "value") == [("a", "found", "1"), ("b", "instead", "2"), ("c", "none", None)]
