"""Declared schemas of the canonical tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


#: Columns of a fact file as the issuer writes them, and the names used here.
FACT_FILE_COLUMNS = {
    "要素ID": "element",
    "項目名": "label",
    "コンテキストID": "context",
    "相対年度": "rel_year",
    "連結・個別": "consol",
    "期間・時点": "period_type",
    "ユニットID": "unit_id",
    "単位": "unit",
    "値": "value",
}

FACT_FILE = T.StructType(_strings(*FACT_FILE_COLUMNS))

FACTS = T.StructType(
    _strings(
        "doc_id", "entity_id", "element", "label", "context", "rel_year", "consol",
        "period_type", "unit", "value",
    )
    + [T.StructField("src_ord", T.LongType())]
)

#: One filing as the index lists it.
FILING = T.StructType(
    [T.StructField("seqNumber", T.IntegerType())]
    + _strings(
        "docID", "edinetCode", "secCode", "JCN", "filerName", "fundCode", "ordinanceCode",
        "formCode", "docTypeCode", "periodStart", "periodEnd", "submitDateTime",
        "docDescription", "issuerEdinetCode", "subjectEdinetCode", "subsidiaryEdinetCode",
        "currentReportReason", "parentDocID", "opeDateTime", "withdrawalStatus",
        "docInfoEditStatus", "disclosureStatus", "xbrlFlag", "pdfFlag", "attachDocFlag",
        "englishDocFlag", "csvFlag", "legalStatus",
    )
)

INDEX_RESPONSE = T.StructType(
    [
        T.StructField(
            "metadata",
            T.StructType(
                _strings("title")
                + [
                    T.StructField("parameter", T.StructType(_strings("date", "type"))),
                    T.StructField(
                        "resultset", T.StructType([T.StructField("count", T.LongType())])
                    ),
                ]
                + _strings("processDateTime", "status", "message")
            ),
        ),
        T.StructField("results", T.ArrayType(FILING)),
    ]
)

#: Company master: file columns and the names used here.
COMPANY_FILE_COLUMNS = {
    "ＥＤＩＮＥＴコード": "entity_id",
    "提出者種別": "entity_type",
    "上場区分": "listing",
    "連結の有無": "consolidated",
    "資本金": "capital",
    "決算日": "fiscal_end",
    "提出者名": "name",
    "提出者名（英字）": "name_en",
    "提出者名（ヨミ）": "name_kana",
    "所在地": "address",
    "提出者業種": "industry",
    "証券コード": "sec_code",
    "提出者法人番号": "corporate_number",
}
COMPANY_FILE = T.StructType(_strings(*COMPANY_FILE_COLUMNS))

LISTING_FILE_COLUMNS = {
    "コード": "code",
    "銘柄名": "name",
    "市場・商品区分": "market",
    "33業種区分": "industry",
}
LISTING_FILE = T.StructType(_strings(*LISTING_FILE_COLUMNS))

COMPANY_LIST = T.StructType(
    _strings("edinet_code", "company_name") + [T.StructField("file_count", T.LongType())]
)
TARGET_LIST = T.StructType(
    _strings("edinet_code", "sec_code", "company_name", "industry", "market")
    + [T.StructField("file_count", T.LongType())]
)
FILINGS_LIST = T.StructType(_strings("doc_id", "submitDateTime", "docDescription"))

JUDGEMENT = T.StructType(
    _strings("amended_doc_id", "original_doc_id", "company_name")
    + [T.StructField("is_accounting_fraud", T.BooleanType())]
    + _strings("explanation", "amended_pdf_path")
)

STATEMENT_ROWS = T.StructType(
    _strings("doc_id", "statement", "item", "period", "value")
    + [T.StructField("value_num", T.DoubleType())]
)

MISSING_LOG = T.StructType(
    _strings("edinet_code")
    + [T.StructField("fiscal_year", T.IntegerType())]
    + _strings("tsv_path", "missing_reason")
)
