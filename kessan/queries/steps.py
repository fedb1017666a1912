"""Named SQL steps shared by the SQL of several queries."""

from __future__ import annotations

from kessan.queries.bind import add_cte
from kessan.vocab import CONTEXT_FORMS, PERIODS, _builtin_rows


def values(rows: list[tuple], *names: str) -> str:
    """A literal table."""
    shown = ", ".join(
        "(" + ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in row) + ")" for row in rows
    )
    return f"SELECT * FROM (VALUES {shown}) AS v({', '.join(names)})"


_keys = [
    (statement, ord_, element + ending, item)
    for statement, ord_, element, item in _builtin_rows()
    for ending in ("", "IFRS")
]
add_cte("vocab", values(_keys, "statement", "ord", "local_name", "item"))
add_cte(
    "periods",
    values(
        [(p, n, p + form) for n, p in enumerate(PERIODS, 1) for form in CONTEXT_FORMS],
        "period", "period_ord", "context",
    ),
)
add_cte(
    "dedup",
    "SELECT doc_id, element, context, rel_year, consol, period_type, min(value) AS value, min(label) AS label "
    "FROM facts GROUP BY doc_id, element, context, rel_year, consol, period_type",
    "facts",
)
add_cte(
    "leaves",
    "SELECT d.doc_id, d.element, d.context, d.rel_year, d.consol, d.period_type, d.value, p.period, p.period_ord, "
    "v.statement, v.ord, v.item "
    "FROM (SELECT *, regexp_extract(element, '[^:]*$') AS local_name FROM dedup WHERE contains(element, ':') "
    "AND NOT contains(consol, '個別') AND context NOT LIKE '%NonConsolidatedMember') d "
    "JOIN periods p ON d.context = p.context JOIN vocab v ON d.local_name = v.local_name",
    "dedup", "vocab", "periods",
)
add_cte(
    "singles",
    "SELECT doc_id, statement, item, ord, period, period_ord, min(value) AS value FROM leaves "
    "GROUP BY doc_id, statement, item, ord, period, period_ord HAVING count(*) = 1",
    "leaves",
)
add_cte(
    "body",
    "SELECT * FROM singles WHERE statement <> 'META' QUALIFY dense_rank() OVER "
    "(PARTITION BY doc_id, statement, item ORDER BY ord DESC) = 1",
    "singles",
)
add_cte(
    "meta",
    "SELECT doc_id, statement, item, ord, value FROM singles WHERE statement = 'META' QUALIFY row_number() OVER "
    "(PARTITION BY doc_id, item ORDER BY period_ord DESC) = 1",
    "singles",
)
add_cte("gate", "SELECT doc_id FROM meta WHERE item = '連結決算の有無' AND value = 'false'", "meta")
add_cte(
    "statements",
    "SELECT * FROM (SELECT doc_id, statement, ord, item, period, period_ord, value FROM body UNION ALL "
    "SELECT doc_id, statement, ord, item, NULL, NULL, value FROM meta) s WHERE NOT EXISTS (FROM gate WHERE gate.doc_id = s.doc_id)",
    "body", "meta", "gate",
)
NUMBER = r"CASE WHEN regexp_matches({0}, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN TRY_CAST({0} AS DOUBLE) END"
add_cte(
    "rows_num",
    f"SELECT doc_id, statement, item, period, value, {NUMBER.format('value')} AS value_num FROM statements WHERE statement <> 'META'",
    "statements",
)
MART = (
    "max(CASE WHEN item = '売上高' THEN value_num END) AS sales, max(CASE WHEN item = '営業利益' THEN value_num END) AS op_profit, "
    "max(CASE WHEN item = '当期利益' THEN value_num END) AS net_income, max(CASE WHEN item = '総資産' THEN value_num END) AS total_assets, "
    "max(CASE WHEN item = '純資産' THEN value_num END) AS equity"
)
RATIOS = "op_profit / nullif(sales, 0) AS op_margin, net_income / nullif(total_assets, 0) AS roa, equity / nullif(total_assets, 0) AS equity_ratio"
add_cte(
    "mart",
    f"SELECT doc_id, period, {MART} FROM rows_num WHERE statement IN ('BS', 'PL') GROUP BY doc_id, period",
    "rows_num",
)
add_cte(
    "period_json",
    "SELECT doc_id, statement, item, max(ord) AS ord, '{' || string_agg(CAST(to_json(period) AS VARCHAR) || ':' || "
    "COALESCE(CAST(to_json(value) AS VARCHAR), 'null'), ',' ORDER BY period_ord) || '}' AS json "
    "FROM statements WHERE statement <> 'META' GROUP BY doc_id, statement, item UNION ALL "
    "SELECT doc_id, statement, item, ord, COALESCE(CAST(to_json(value) AS VARCHAR), 'null') FROM statements WHERE statement = 'META'",
    "statements",
)
_SECTION = (
    "COALESCE('{{' || string_agg(CASE WHEN statement = '{0}' THEN CAST(to_json(item) AS VARCHAR) || ':' || json END, ',' "
    "ORDER BY ord, item) || '}}', '{{}}') AS {1}"
)
add_cte(
    "sections",
    "SELECT doc_id, " + ", ".join(_SECTION.format(s, s.lower()) for s in ("META", "SUMMARY", "TEXT", "BS", "PL", "CF"))
    + " FROM period_json GROUP BY doc_id",
    "period_json",
)
SUBMIT_TIME = "COALESCE(try_strptime(submitDateTime, '%Y-%m-%d %H:%M'), try_strptime(submitDateTime, '%Y-%m-%d %H:%M:%S'))"
REPORT_TYPE = (
    "CASE WHEN ordinanceCode = '010' THEN CASE formCode WHEN '030000' THEN 'annual' WHEN '030001' THEN 'annual_amended' "
    "WHEN '043000' THEN 'quarterly' WHEN '043001' THEN 'quarterly_amended' WHEN '043A00' THEN 'semiannual' "
    "WHEN '043A01' THEN 'semiannual_amended' ELSE 'unknown' END ELSE 'unknown' END"
)
HASH = "md5('42|' || {0})"
