"""The given tables as companies, filings, facts and judgements.

Customers are companies, orders are filings, order lines give the figures of a filing and
documents its text. The scalar expressions below are read by both engines; only the
unnesting of one line into several facts is written twice.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kessan.session import written
from kessan.sources.lake import manifest_of

# --- companies (customer) ------------------------------------------------------------------

SEC_CODE = (
    "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN '' "
    "ELSE CAST(1000 + c_custkey AS STRING) || '0' END"
)
INDUSTRY = (
    "CASE WHEN c_custkey % 17 = 0 THEN '銀行業' "
    "WHEN c_custkey % 19 = 0 THEN '内国法人・組合（有価証券報告書等の提出義務者以外）' "
    "WHEN c_custkey % 23 = 0 THEN '-' "
    "WHEN c_mktsegment = 'HOUSEHOLD' THEN '小売業' "
    "WHEN c_mktsegment = 'FURNITURE' THEN 'その他製品' "
    "WHEN c_mktsegment = 'MACHINERY' THEN '機械' "
    "WHEN c_mktsegment = 'BUILDING' THEN '建設業' "
    "ELSE '輸送用機器' END"
)
COMPANIES = {
    "entity_id": "'E' || CAST(c_custkey AS STRING)",
    "name": "c_name",
    "industry": INDUSTRY,
    "sec_code": SEC_CODE,
    "listing": "CASE WHEN c_custkey % 4 = 0 THEN '非上場' ELSE '上場' END",
    "consolidated": "CASE WHEN c_acctbal < 0 THEN '無' ELSE '有' END",
    "entity_type": "CASE WHEN c_custkey % 19 = 0 THEN '内国法人・組合（有価証券報告書等の提出義務者以外）' ELSE '内国法人・組合' END",
    "nationkey": "c_nationkey",
}
LISTING = {
    "code": "CAST(1000 + c_custkey AS STRING)",
    "name": "c_name || ' KK'",
    "industry": INDUSTRY,
    "market": (
        "CASE r_name WHEN 'AFRICA' THEN 'プライム（内国株式）' WHEN 'AMERICA' THEN 'スタンダード（内国株式）' "
        "WHEN 'ASIA' THEN CASE WHEN c_custkey % 2 = 0 THEN 'ETF・ETN' ELSE 'ETF（海外）' END "
        "WHEN 'EUROPE' THEN 'PRO Market' ELSE 'グロース（内国株式）' END"
    ),
}
LISTED = "c_custkey < 9000 AND c_custkey % 3 <> 0"

# --- filings (orders) ----------------------------------------------------------------------

YEAR = "(year(o_orderdate) + 16 + CAST(o_custkey % 5 AS INT))"
START = (
    f"CAST({YEAR} - 1 AS STRING) || CASE WHEN o_custkey % 3 = 0 THEN '-01-01' ELSE '-04-01' END"
)
END = (
    f"CASE WHEN o_custkey % 3 = 0 THEN CAST({YEAR} - 1 AS STRING) || '-12-31' "
    f"ELSE CAST({YEAR} AS STRING) || '-03-31' END"
)
SUBMIT_DAY = f"CAST({YEAR} AS STRING) || substr(CAST(o_orderdate AS STRING), 5, 6)"
SUBMIT = (
    "CASE WHEN o_orderkey % 37 = 0 THEN 'unknown' WHEN o_orderkey % 43 = 0 THEN NULL "
    f"WHEN o_orderkey % 5 = 0 THEN {SUBMIT_DAY} || ' 09:00:30' ELSE {SUBMIT_DAY} || ' 09:00' END"
)
FILINGS = {
    "docID": "'S' || CAST(o_orderkey AS STRING)",
    "edinetCode": "'E' || CAST(o_custkey AS STRING)",
    "filerName": (
        "CASE WHEN o_orderkey % 31 = 0 THEN NULL "
        "ELSE 'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0') END"
    ),
    "secCode": "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE CAST(1000 + o_custkey AS STRING) || '0' END",
    "ordinanceCode": "'010'",
    "formCode": (
        "CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '030001' WHEN '5-LOW' THEN "
        "CASE o_custkey % 4 WHEN 0 THEN '043000' WHEN 1 THEN '043A00' WHEN 2 THEN '043A01' ELSE '999999' END "
        "ELSE '030000' END"
    ),
    "periodStart": START,
    "periodEnd": f"CASE WHEN o_orderkey % 41 = 0 THEN '' ELSE {END} END",
    "submitDateTime": SUBMIT,
    "docDescription": (
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '訂正有価証券報告書' "
        "WHEN o_orderpriority = '5-LOW' THEN '半期報告書' ELSE '有価証券報告書－第' || CAST(o_custkey % 90 AS STRING) || '期' END"
    ),
    "withdrawalStatus": "CASE WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN '1' ELSE '0' END",
}

# --- facts ---------------------------------------------------------------------------------

_Y = "CAST(round(l_extendedprice * 100) AS BIGINT)"
# Per order line: elements (chosen by part), label, kind, and the amount as price * times / over + plus.
LINE_FACTS = (
    (("jppfs_cor:NetSalesOfCompletedConstructionContracts", *("jppfs_cor:NetSales",) * 4), "売上高", "期間", 1, 1, 0),
    (("jppfs_cor:CostOfSales",), "売上原価", "期間", 1, 2, 0),
    (("jppfs_cor:OperatingProfitLoss", *("jppfs_cor:OperatingIncome",) * 3), "営業利益", "期間", 1, 10, 0),
    (("jppfs_cor:ProfitLoss", "jppfs_cor:ProfitLossAttributableToOwnersOfParent"), "当期純利益", "期間", 1, 20, -200000),
    (("jppfs_cor:NetCashProvidedByUsedInOperatingActivities",), "営業活動による収支", "期間", 1, 15, -50000),
    (("jppfs_cor:Assets",), "資産", "時点", 3, 1, 0),
    (("jppfs_cor:NetAssets",), "純資産", "時点", 1, 1, 0),
    (("jppfs_cor:NotesAndAccountsReceivableTrade", "jppfs_cor:AccountsReceivableTrade", "jppfs_cor:AccountsReceivableOther"), "売掛金", "時点", 1, 5, 0),
    (("jppfs_cor:ElectronicallyRecordedMonetaryClaimsOperatingCA", "jppfs_cor:ElectronicallyRecordedMonetaryClaimsOperating"), "電子記録債権", "時点", 1, 50, 0),
    (("jppfs_cor:PropertyPlantAndEquipmentNet", *("jppfs_cor:PropertyPlantAndEquipment",) * 2), "有形固定資産", "時点", 1, 4, 0),
    (
        (
            "jpcrp_cor:NetSalesSummaryOfBusinessResults", "jpcrp_cor:NetAssetsSummaryOfBusinessResults",
            "jpcrp_cor:NetCashProvidedByUsedInInvestingActivitiesSummaryOfBusinessResults",
            "jpcrp_cor:NumberOfEmployees", "jpcrp_cor:UnlistedFigureSummaryOfBusinessResults",
        ),
        "売上高、経営指標等", "期間", 1, 1, 0,
    ),
    (("jppfs_cor:Merchandise", "jppfs_cor:WorkInProcess", "jppfs_cor:RawMaterialsAndSupplies"), "棚卸資産", "時点", 1, 8, 0),
    (("jpigp_cor:NetSalesIFRS", *("jpcrp_cor:OtherNetSales",) * 6), "その他の売上高", "期間", 1, 3, 0),
    (("jppfs_cor:ShortTermLoansPayable", "jppfs_cor:LongTermLoansPayable", "jppfs_cor:BondsPayable"), "借入金", "時点", 1, 6, 0),
)
_AMOUNT = f"(CAST(floor({_Y} * f.times / f.over) AS BIGINT) + f.plus)"
_ELEMENT_SPARK = "get(f.names, CAST(l_partkey % size(f.names) AS INT))"
_ELEMENT_SQL = "f.names[(l_partkey % len(f.names)) + 1]"
_PERIOD = "CASE l_returnflag WHEN 'A' THEN 'CurrentYear' WHEN 'N' THEN 'Prior1Year' ELSE 'Prior2Year' END"
_REL = "CASE l_returnflag WHEN 'A' THEN '当期' WHEN 'N' THEN '前期' ELSE '前々期' END"
LINE_COLUMNS = {
    "doc_id": "'S' || CAST(l_orderkey AS STRING)",
    "element": _ELEMENT_SPARK,
    "label": "f.label",
    "context": (
        f"({_PERIOD}) || CASE WHEN f.kind = '期間' THEN 'Duration' ELSE 'Instant' END "
        "|| CASE WHEN l_linestatus = 'O' THEN '_NonConsolidatedMember' ELSE '' END "
        "|| CASE WHEN l_linenumber = 7 THEN '_ReportableSegmentsMember' ELSE '' END"
    ),
    "rel_year": f"({_REL}) || CASE WHEN f.kind = '期間' THEN '' ELSE '末' END",
    "consol": "CASE WHEN l_linestatus = 'F' THEN '連結' ELSE '個別' END",
    "period_type": "f.kind",
    "unit": "CASE l_linenumber % 4 WHEN 0 THEN '千円' WHEN 1 THEN '円' WHEN 2 THEN '百万円' ELSE 'JPY' END",
    "value": (
        "CASE WHEN l_tax > 0.075 THEN '－' WHEN l_tax > 0.065 AND l_linenumber = 5 THEN NULL "
        f"ELSE CAST({_AMOUNT} AS STRING) END"
    ),
    "src_ord": "CAST(l_linenumber AS BIGINT) * 100 + f.place",
}
# What all facts of a line share, made once per line; and a fact's columns from these, equal to LINE_COLUMNS.
_NO_AMOUNT = "l_tax > 0.075 OR l_tax > 0.065 AND l_linenumber = 5"
LINE_SHARED = {
    "doc_id": LINE_COLUMNS["doc_id"],
    "period_name": _PERIOD,
    "year_name": _REL,
    "member": (
        "CASE WHEN l_linestatus = 'O' THEN '_NonConsolidatedMember' ELSE '' END "
        "|| CASE WHEN l_linenumber = 7 THEN '_ReportableSegmentsMember' ELSE '' END"
    ),
    "consol": LINE_COLUMNS["consol"],
    "unit": LINE_COLUMNS["unit"],
    "no_amount": f"CASE WHEN {_NO_AMOUNT} THEN true ELSE false END",
    "mark": "CASE WHEN l_tax > 0.075 THEN '－' END",
    "cents": f"CASE WHEN {_NO_AMOUNT} THEN NULL ELSE {_Y} END",
    "l_partkey": "l_partkey",
    "before": "CAST(l_linenumber AS BIGINT) * 100",
}
FACT_OF_LINE = {
    "doc_id": "doc_id",
    "element": _ELEMENT_SPARK,
    "label": "f.label",
    "context": "period_name || f.form || member",
    "rel_year": "year_name || f.end",
    "consol": "consol",
    "period_type": "f.kind",
    "unit": "unit",
    "value": "CASE WHEN no_amount THEN mark ELSE CAST((CAST(floor(cents * f.times / f.over) AS BIGINT) + f.plus) AS STRING) END",
    "src_ord": "before + f.place",
}
# (element, label, value) per order, in file order.
HEADER_FACTS = (
    ("'jpdei_cor:EDINETCodeDEI'", "EDINETコード", "'E' || CAST(o_custkey AS STRING)"),
    ("'jpdei_cor:SecurityCodeDEI'", "証券コード", FILINGS["secCode"]),
    ("'jpdei_cor:AccountingStandardsDEI'", "会計基準", "CASE WHEN o_custkey % 11 = 0 THEN 'IFRS' WHEN o_custkey % 13 = 0 THEN NULL ELSE 'Japan GAAP' END"),
    ("CASE WHEN o_orderkey % 17 = 0 THEN 'jpdei_cor:CurrentFiscalYearStartDateDEI' ELSE 'jpcrp_cor:TitleCoverPage' END", "年度開始日", "CASE WHEN o_orderkey % 17 = 0 THEN '1999-01-01' ELSE 'x' END"),
    ("'jpdei_cor:CurrentFiscalYearStartDateDEI'", "年度開始日", START),
    ("'jpdei_cor:CurrentFiscalYearEndDateDEI'", "年度終了日", END),
    ("'jpdei_cor:WhetherConsolidatedFinancialStatementsArePreparedDEI'", "連結決算の有無", "CASE WHEN o_orderkey % 9 = 0 THEN 'false' ELSE 'true' END"),
    ("'jpdei_cor:FilingDateDEI'", "提出日", f"CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE {SUBMIT_DAY} END"),
    ("'jpcrp_cor:FilingDateCoverPage'", "提出日", f"CASE WHEN o_orderkey % 12 = 0 THEN '' ELSE {SUBMIT_DAY} END"),
    ("'jpdei_cor:IdentificationOfDocumentSubjectToAmendmentDEI'", "訂正対象", "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderkey % 10 <> 0 THEN 'S' || CAST(o_orderkey - 1 AS STRING) ELSE NULL END"),
    ("CASE WHEN o_custkey % 11 = 0 OR o_orderkey % 50 = 0 THEN 'IFRS-full:Revenue' ELSE 'jpcrp_cor:CompanyNameCoverPage' END", "会社名", "'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0')"),
)
HEADER_COLUMNS = {
    "doc_id": FILINGS["docID"],
    "element": "f.element",
    "label": "f.label",
    "context": "'FilingDateInstant'",
    "rel_year": "'提出日時点'",
    "consol": "'その他'",
    "period_type": "'時点'",
    "unit": "CAST(NULL AS STRING)",
    "value": "f.text",
    "src_ord": "f.place",
}
TEXT_COLUMNS = {
    "doc_id": "'S' || CAST(doc_id AS STRING)",
    "element": (
        "CASE doc_id % 5 WHEN 0 THEN 'jpcrp_cor:NoteOnIndependentAuditFinancialInformation' "
        "WHEN 1 THEN 'jpcrp_cor:UnlistedTextBlock' ELSE 'jpcrp_cor:BusinessRisksTextBlock' END"
    ),
    "label": "'事業等のリスク'",
    "context": "'FilingDateInstant'",
    "rel_year": "'提出日時点'",
    "consol": "'その他'",
    "period_type": "'時点'",
    "unit": "CAST(NULL AS STRING)",
    "value": "text",
    "src_ord": "CAST(10000 AS BIGINT)",
}
JUDGEMENTS = {
    "amended_doc_id": "'S' || CAST(doc_id + 1 AS STRING)",
    "original_doc_id": "'S' || CAST(doc_id AS STRING)",
    "company_name": "source",
    "is_accounting_fraud": "toxic = 1",
    "explanation": "text",
    "amended_pdf_path": "'annual_amended/S' || CAST(doc_id + 1 AS STRING) || '.pdf'",
}
REPLIES = {
    "amended_doc_id": "'S' || CAST(event_id AS STRING)",
    "reply": (
        "CASE event_id % 4 "
        "WHEN 0 THEN 'Verdict' || chr(10) || '```json' || chr(10) || '{\"is_accounting_fraud\": true, \"explanation\": \"' || event_type || '\", \"company_name\": \"c' || CAST(user_id AS STRING) || '\", \"detail\": ' || props || '}' || chr(10) || '```' "
        "WHEN 1 THEN 'Plain {\"is_accounting_fraud\": false, \"explanation\": \"' || event_type || '\"} end' "
        "WHEN 2 THEN '```json {broken ``` then ```json {\"company_name\": \"' || event_type || '\"} ```' "
        "ELSE 'no verdict' END"
    ),
    "amended_pdf_path": "'annual_amended/S' || CAST(event_id AS STRING) || '.pdf'",
}


def _spark_columns(columns: dict[str, str]) -> list:
    return [F.expr(text).alias(name) for name, text in columns.items()]


def _sql_columns(columns: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in columns.items())


def _spark_header_facts():
    structs = [
        F.struct(
            F.expr(element).alias("element"), F.lit(label).alias("label"), F.expr(text).alias("text"),
            F.lit(place).cast("bigint").alias("place"),
        )
        for place, (element, label, text) in enumerate(HEADER_FACTS, 1)
    ]
    return F.explode(F.array(*structs)).alias("f")


def _spark_line_facts():
    # All literals: the array is folded to one constant and the generated code stays small.
    structs = [
        F.struct(
            F.array(*(F.lit(n) for n in names)).alias("names"), F.lit(label).alias("label"), F.lit(kind).alias("kind"),
            F.lit("Duration" if kind == "期間" else "Instant").alias("form"), F.lit("" if kind == "期間" else "末").alias("end"),
            F.lit(times).cast("bigint").alias("times"), F.lit(over).cast("bigint").alias("over"),
            F.lit(plus).cast("bigint").alias("plus"), F.lit(place).cast("bigint").alias("place"),
        )
        for place, (names, label, kind, times, over, plus) in enumerate(LINE_FACTS, 1)
    ]
    return F.explode(F.array(*structs)).alias("f")


def _sql_header_facts() -> str:
    structs = [
        f"{{'element': {element}, 'label': '{label}', 'text': {text}, 'place': CAST({place} AS BIGINT)}}"
        for place, (element, label, text) in enumerate(HEADER_FACTS, 1)
    ]
    return f"unnest([{', '.join(structs)}]) AS f"


def _sql_line_facts() -> str:
    structs = [
        f"{{'names': {list(names)}, 'label': '{label}', 'kind': '{kind}', 'times': {times}, 'over': {over}, "
        f"'plus': CAST({plus} AS BIGINT), 'place': CAST({place} AS BIGINT)}}"
        for place, (names, label, kind, times, over, plus) in enumerate(LINE_FACTS, 1)
    ]
    return f"unnest([{', '.join(structs)}]) AS f"


#: Lines or orders a task makes into facts (14 and 11 of each). What a task sorts or aggregates must not follow the corpus.
ROWS_A_TASK = 50_000

#: Lines whose facts are shuffled at once, where a job can go over the facts in rounds: what lies on the disk between two
#: of its steps must not follow the corpus.
LINES_A_ROUND = 12_000_000


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, and in tasks of at most about ``ROWS_A_TASK`` rows, where its files make fewer
    tasks than that; unchanged where they make enough. The count is read from the files' footers."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_TASK))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


class Tables:
    """The bound tables of one folder, made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def rounds(self) -> int:
        """In how many rounds, by filing, all facts are placed where the result allows it."""
        return max(1, -(-self.raw("lineitem").count() // LINES_A_ROUND))

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def companies(self) -> DataFrame:
        return self.raw("customer").select(*_spark_columns(COMPANIES))

    @cached_property
    def listing(self) -> DataFrame:
        customer = self.raw("customer").filter(LISTED)
        nation = self.raw("nation").join(self.raw("region"), F.expr("n_regionkey = r_regionkey"))
        return customer.join(nation, F.expr("c_nationkey = n_nationkey")).select(*_spark_columns(LISTING))

    @cached_property
    def filings(self) -> DataFrame:
        return self.raw("orders").select(*_spark_columns(FILINGS))

    @cached_property
    def annual(self) -> DataFrame:
        return self.filings.filter("formCode = '030000'")

    @cached_property
    def line_facts(self) -> DataFrame:
        lines = spread(self.raw("lineitem")).select(*_spark_columns(LINE_SHARED)).select("*", _spark_line_facts())
        return lines.select(*_spark_columns(FACT_OF_LINE))

    @cached_property
    def header_facts(self) -> DataFrame:
        orders = spread(self.raw("orders")).select("*", _spark_header_facts())
        return orders.select(*_spark_columns(HEADER_COLUMNS))

    @cached_property
    def text_facts(self) -> DataFrame:
        return self.raw("documents").select(*_spark_columns(TEXT_COLUMNS))

    @cached_property
    def facts(self) -> DataFrame:
        return self.line_facts.unionByName(self.header_facts).unionByName(self.text_facts)

    @cached_property
    def landed_lines(self) -> DataFrame:
        """The manifest that landing the order lines' facts leaves."""
        return written(manifest_of(self.line_facts.withColumn("entity_id", F.lit(None).cast("string"))), "manifest")

    @cached_property
    def entities(self) -> DataFrame:
        return self.filings.select(F.col("docID").alias("doc_id"), F.col("edinetCode").alias("entity_id"))

    @cached_property
    def judgements(self) -> DataFrame:
        return self.raw("labels").join(self.raw("documents"), "doc_id").select(*_spark_columns(JUDGEMENTS))

    @cached_property
    def replies(self) -> DataFrame:
        return self.raw("events").select(*_spark_columns(REPLIES))


_LINE_SQL = dict(LINE_COLUMNS, element=_ELEMENT_SQL)
CTES = {
    "companies": f"SELECT {_sql_columns(COMPANIES)} FROM customer",
    "listing": (
        f"SELECT {_sql_columns(LISTING)} FROM customer JOIN nation ON c_nationkey = n_nationkey "
        f"JOIN region ON n_regionkey = r_regionkey WHERE {LISTED}"
    ),
    "filings": f"SELECT {_sql_columns(FILINGS)} FROM orders",
    "annual": f"SELECT * FROM (SELECT {_sql_columns(FILINGS)} FROM orders) WHERE formCode = '030000'",
    "line_facts": f"SELECT {_sql_columns(_LINE_SQL)} FROM (SELECT *, {_sql_line_facts()} FROM lineitem)",
    "header_facts": f"SELECT {_sql_columns(HEADER_COLUMNS)} FROM (SELECT *, {_sql_header_facts()} FROM orders)",
    "text_facts": f"SELECT {_sql_columns(TEXT_COLUMNS)} FROM documents",
    "facts": "SELECT * FROM line_facts UNION ALL SELECT * FROM header_facts UNION ALL SELECT * FROM text_facts",
    "entities": "SELECT docID AS doc_id, edinetCode AS entity_id FROM filings",
    "judgements": f"SELECT {_sql_columns(JUDGEMENTS)} FROM labels JOIN documents USING (doc_id)",
    "replies": f"SELECT {_sql_columns(REPLIES)} FROM events",
}
NEEDS = {"facts": ("line_facts", "header_facts", "text_facts"), "entities": ("filings",)}


#: Steps with several readers, computed once.
MATERIALIZED = {
    "dedup", "leaves", "singles", "statements", "template_slots", "pairs", "accrual_grid", "chosen_periods", "full_long",
}


def add_cte(name: str, sql: str, *needs: str) -> None:
    """A further named step for the SQL of several queries."""
    CTES[name] = sql
    NEEDS[name] = needs


def cte(*names: str) -> str:
    """``WITH`` the bound tables, each after what it is made of."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in NEEDS.get(name, ()):
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    shown = (f"{n} AS {'MATERIALIZED ' if n in MATERIALIZED else ''}({CTES[n]})" for n in order)
    return "WITH " + ", ".join(shown) + " "
