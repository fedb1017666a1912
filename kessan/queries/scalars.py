"""Queries on scalar functions: number text, rounding, JSON, codes, paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from kessan.functions import numbers, text
from kessan.operators import tables
from kessan.plans import labelled_sets
from kessan.queries import steps
from kessan.queries.registry import query

_YEN = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_CASES = (
    "CASE l_partkey % 14 WHEN 0 THEN '－' WHEN 1 THEN '△' || {c} WHEN 2 THEN '(' || {c} || ')' WHEN 3 THEN '△(' || {c} || ')' "
    "WHEN 4 THEN {c} || '株' WHEN 5 THEN '１２３' WHEN 6 THEN 'abc' WHEN 7 THEN ' ' || {c} || ' ' WHEN 8 THEN '▲' || {c} "
    "WHEN 9 THEN NULL WHEN 10 THEN '—' WHEN 11 THEN '−' WHEN 12 THEN CAST(l_discount AS STRING) ELSE {c} END"
)
_COMMA_SPARK = f"format_number({_YEN}, 0)"
_COMMA_SQL = f"format('{{:,}}', {_YEN})"
_UNIT = "CASE l_linenumber % 6 WHEN 0 THEN '円' WHEN 1 THEN '千円' WHEN 2 THEN '百万円' WHEN 3 THEN '億円' WHEN 4 THEN 'JPY' ELSE '株' END"
_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_TEXTS = f"SELECT {_LINE}, {_CASES.format(c=_COMMA_SQL)} AS t, {_UNIT} AS unit FROM lineitem"
_FLOAT = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def _texts(t):
    return t.raw("lineitem").select(
        *_LINE.split(", "), F.expr(_CASES.format(c=_COMMA_SPARK)).alias("t"), F.expr(_UNIT).alias("unit")
    )


@query(
    "normalize_number", "N1",
    f"SELECT {_LINE}, t, CASE WHEN trim(t) IN ('', '－', '―', 'ー', '-', '–', '—') THEN NULL WHEN regexp_matches(digits, {_FLOAT}) THEN "
    "CASE WHEN neg THEN -CAST(digits AS DOUBLE) ELSE CAST(digits AS DOUBLE) END END AS number FROM (SELECT *, "
    "regexp_matches(bare, '^[△▲]') OR regexp_matches(regexp_replace(bare, '^[△▲]', ''), '^\\(.*\\)$') AS neg, "
    "regexp_replace(translate(bare, '０１２３４５６７８９', '0123456789'), '[^0-9.eE+\\-]', '', 'g') AS digits "
    f"FROM (SELECT *, replace(trim(t), ',', '') AS bare FROM ({_TEXTS})))",
)
def _(t):
    return _texts(t).select(*_LINE.split(", "), "t", numbers.normalize_number(F.col("t")).alias("number"))


@query(
    "normalize_value", "N2",
    f"SELECT {_LINE}, t, unit, CASE WHEN trim(t) IN ('', '－', '-', '―', 'ー', '−', 'nan', 'None') THEN NULL WHEN regexp_matches(body, {_FLOAT}) THEN "
    "CASE WHEN neg THEN -CAST(body AS DOUBLE) ELSE CAST(body AS DOUBLE) END * CASE unit WHEN '千円' THEN 1e3 WHEN '百万円' THEN 1e6 WHEN '億円' THEN 1e8 ELSE 1 END END AS number "
    "FROM (SELECT *, regexp_matches(bare, '^\\(.*\\)$') OR regexp_matches(bare, '^[△▲]') AS neg, translate(CASE WHEN regexp_matches(bare, '^\\(.*\\)$') "
    "THEN substr(bare, 2, length(bare) - 2) ELSE regexp_replace(bare, '^[△▲]', '') END, '０１２３４５６７８９', '0123456789') AS body "
    f"FROM (SELECT *, replace(trim(t), ',', '') AS bare FROM ({_TEXTS})))",
)
def _(t):
    number = numbers.normalize_value(F.col("t"), F.col("unit"))
    return _texts(t).select(*_LINE.split(", "), "t", "unit", number.alias("number"))


@query(
    "whole_figures", "N3",
    f"SELECT {_LINE}, CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS half, CAST(round_even(l_extendedprice, 0) AS BIGINT) AS whole FROM lineitem",
)
def _(t):
    half = numbers.to_int(F.col("l_quantity") / 2)
    return t.raw("lineitem").select(
        *_LINE.split(", "), half.alias("half"), numbers.to_int(F.col("l_extendedprice")).alias("whole")
    )


@query(
    "two_places", "N4",
    f"SELECT {_LINE}, CAST(printf('%.2f', l_extendedprice * (1 - l_discount)) AS DOUBLE) AS net, CAST(printf('%.2f', l_quantity / 8) AS DOUBLE) AS eighth FROM lineitem",
)
def _(t):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return t.raw("lineitem").select(
        *_LINE.split(", "), numbers.to_places(net).alias("net"), numbers.to_places(F.col("l_quantity") / 8).alias("eighth")
    )


@query(
    "coerced_numbers", "N5",
    f"SELECT {_LINE}, t, {steps.NUMBER.format('n')} AS number FROM (SELECT *, translate(trim(t), '０１２３４５６７８９', '0123456789') AS n FROM ({_TEXTS}))",
)
def _(t):
    return _texts(t).select(*_LINE.split(", "), "t", numbers.to_double(F.col("t")).alias("number"))


_PARTS = "sum(CASE WHEN l_linenumber = {0} THEN l_quantity END)"


def _by_order(t):
    return t.raw("lineitem").groupBy("l_orderkey").agg(
        *(F.sum(F.when(F.col("l_linenumber") == n, F.col("l_quantity"))).alias(f"q{n}") for n in (1, 2, 3))
    )


_BY_ORDER = (
    f"SELECT l_orderkey, {_PARTS.format(1)} AS q1, {_PARTS.format(2)} AS q2, {_PARTS.format(3)} AS q3 FROM lineitem GROUP BY l_orderkey"
)


@query(
    "sums_of_present", "N11",
    f"SELECT l_orderkey, CASE WHEN COALESCE(q1, q2, q3) IS NOT NULL THEN COALESCE(q1, 0) + COALESCE(q2, 0) + COALESCE(q3, 0) END AS total FROM ({_BY_ORDER})",
)
def _(t):
    return _by_order(t).select("l_orderkey", numbers.sum_present([F.col("q1"), F.col("q2"), F.col("q3")]).alias("total"))


@query(
    "total_or_parts", "N13",
    f"SELECT l_orderkey, COALESCE(q1, CASE WHEN COALESCE(q2, q3) IS NOT NULL THEN COALESCE(q2, 0) + COALESCE(q3, 0) END) AS total FROM ({_BY_ORDER})",
)
def _(t):
    total = F.coalesce("q1", numbers.sum_present([F.col("q2"), F.col("q3")]))
    return _by_order(t).select("l_orderkey", total.alias("total"))


@query(
    "base_plus_claims", "N14",
    f"SELECT l_orderkey, q1 + COALESCE(q2, 0) AS amount, CASE WHEN q1 IS NOT NULL THEN 'PLUS_E' ELSE 'NO_BASE' END AS rule FROM ({_BY_ORDER})",
)
def _(t):
    rule = F.when(F.col("q1").isNotNull(), "PLUS_E").otherwise("NO_BASE")
    return _by_order(t).select(
        "l_orderkey", numbers.plus_if_base(F.col("q1"), F.col("q2")).alias("amount"), rule.alias("rule")
    )


@query(
    "changes", "N15",
    f"SELECT l_orderkey, q1 - q2 AS accruals, q2 - q3 AS change FROM ({_BY_ORDER})",
)
def _(t):
    return _by_order(t).select(
        "l_orderkey", (F.col("q1") - F.col("q2")).alias("accruals"), (F.col("q2") - F.col("q3")).alias("change")
    )


@query(
    "direction_labels", "N25",
    f"SELECT l_orderkey, CAST(q2 > q1 AS INT) AS label, CAST(q1 > q3 AS INT) AS naive FROM ({_BY_ORDER})",
)
def _(t):
    return _by_order(t).select(
        "l_orderkey", numbers.rises(F.col("q1"), F.col("q2")).alias("label"), numbers.rises(F.col("q3"), F.col("q1")).alias("naive")
    )


@query(
    "first_of_submit_times", "N16 N21 N28",
    "SELECT docID AS \"docID\", COALESCE(nullif(periodEnd, ''), nullif(submitDateTime, ''), nullif(filerName, '')) AS first_filled, "
    "COALESCE(filerName, 'Unknown') AS name, COALESCE(submitDateTime, periodEnd) AS present FROM filings",
    "filings",
)
def _(t):
    filled = text.first_filled(F.col("periodEnd"), F.col("submitDateTime"), F.col("filerName"))
    shown = tables.present(t.filings, "submitDatetimeOld", "submitDateTime", "periodEnd")
    return t.filings.select(
        "docID", filled.alias("first_filled"), F.coalesce("filerName", F.lit("Unknown")).alias("name"), shown.alias("present")
    )


@query(
    "meta_as_json", "N17",
    "SELECT entity_id, '{\"name\":' || CAST(to_json(name) AS VARCHAR) || ',\"industry\":' || CAST(to_json(industry) AS VARCHAR) || ',\"sec_code\":' || "
    "COALESCE(CAST(to_json(sec_code) AS VARCHAR), 'null') || '}' AS json FROM companies",
    "companies",
)
def _(t):
    return t.companies.select("entity_id", text.json_text(F.struct("name", "industry", "sec_code")).alias("json"))


_REPLY_JSON = (
    "CASE WHEN event_id % 4 IN (0, 2) THEN CASE event_id % 4 WHEN 0 THEN regexp_extract(reply, '(?s)```json(.*?)```', 1) "
    "ELSE regexp_extract_all(reply, '(?s)```json(.*?)```', 1)[2] END WHEN event_id % 4 = 1 THEN regexp_extract(reply, '(?s)\\{.*?\\}', 0) END"
)
_REPLY_FIELDS = (
    "COALESCE(CAST(json_extract_string(j, '$.is_accounting_fraud') AS BOOLEAN), false) AS is_accounting_fraud, "
    "COALESCE(json_extract_string(j, '$.explanation'), '') AS explanation, COALESCE(json_extract_string(j, '$.company_name'), '') AS company_name"
)
steps.add_cte(
    "replies_json",
    "SELECT amended_doc_id, reply, amended_pdf_path, CAST(substr(amended_doc_id, 2) AS BIGINT) AS event_id FROM replies",
    "replies",
)


@query(
    "json_from_replies", "N18",
    f"SELECT amended_doc_id, j IS NOT NULL AS has_json, {_REPLY_FIELDS} FROM (SELECT *, trim({_REPLY_JSON}) AS j FROM replies_json)",
    "replies_json",
)
def _(t):
    fields = text.judgement_fields(F.col("reply"))
    return t.replies.select(
        "amended_doc_id",
        text.json_from_reply(F.col("reply")).isNotNull().alias("has_json"),
        *(column.alias(name) for name, column in fields.items()),
    )


@query(
    "judgement_records", "K7 N18 J12",
    f"SELECT r.amended_doc_id, o.original_doc_id, {_REPLY_FIELDS}, r.amended_pdf_path FROM (SELECT *, trim({_REPLY_JSON}) AS j FROM replies_json) r JOIN "
    "(SELECT doc_id, min(value) AS original_doc_id FROM dedup WHERE element LIKE '%:IdentificationOfDocumentSubjectToAmendmentDEI' "
    "GROUP BY doc_id HAVING count(*) = 1 AND min(value) <> '') o ON o.doc_id = r.amended_doc_id WHERE r.j IS NOT NULL",
    "replies_json dedup",
)
def _(t):
    return labelled_sets.judgements_of_replies(t.header_facts, t.replies)


@query(
    "ids_of_paths", "N20",
    "SELECT docID AS \"docID\", docID AS doc_id, edinetCode AS entity_id FROM filings",
    "filings",
)
def _(t):
    path = F.concat(F.lit("file:/corpus/annual/"), "edinetCode", F.lit("/"), "docID", F.lit(".tsv"))
    named = t.filings.select("docID", path.alias("path"))
    return named.select(
        "docID", text.doc_id_of(F.col("path")).alias("doc_id"), text.entity_id_of(F.col("path")).alias("entity_id")
    )


@query(
    "code_lists", "U6",
    "SELECT entity_id, entity_id || ',' || name AS codes FROM companies",
    "companies",
)
def _(t):
    listed = F.concat_ws(",", "entity_id", F.lit(" "), "name", F.concat(F.lit(" "), "entity_id"), "entity_id")
    codes = tables.distinct_codes(listed)
    return t.companies.select("entity_id", F.array_join(codes, ",").alias("codes"))


@query(
    "slot_order", "O4",
    "SELECT p_partkey, name, CASE WHEN p_size % 10 = 0 THEN 999 ELSE p_size END AS place FROM (SELECT p_partkey, p_size, "
    "CASE WHEN p_size % 10 = 0 THEN 'Yx' ELSE 'Y' || CAST(p_size AS STRING) END AS name FROM part)",
)
def _(t):
    name = F.when(F.col("p_size") % 10 == 0, "Yx").otherwise(F.concat(F.lit("Y"), F.col("p_size").cast("string")))
    named = t.raw("part").select("p_partkey", name.alias("name"))
    return named.select("p_partkey", "name", tables.slot_order(F.col("name")).alias("place")).orderBy("place", "p_partkey")
