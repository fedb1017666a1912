"""Edge values of the scalar functions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from kessan.functions import dates, numbers, text


def apply(spark, column, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


CASES = {
    "1,234": 1234.0, "△1,234": -1234.0, "▲ 5": -5.0, "(56)": -56.0, "△(56)": -56.0, "－": None, "": None, "-": None, "—": None,
    "12株": 12.0, "１２３": 123.0, "abc": None, " 7 ": 7.0, "1e3": 1000.0, "1.5.2": None, "△": None, "3d": 3.0, None: None,
}


def test_normalize_number(spark):
    assert apply(spark, numbers.normalize_number, list(CASES)) == list(CASES.values())


@pytest.mark.parametrize(
    "value,unit,want",
    [
        ("1,234", "千円", 1234000.0), ("▲2", "百万円", -2000000.0), ("5", "株", 5.0), ("5", None, 5.0), ("−", "円", None), ("12株", "円", None),
        ("(3)", "億円", -3e8), ("nan", "円", None), ("1d", "円", None), ("１２", "円", 12.0), ("△(3)", "円", None), ("-4", "JPY", -4.0),
    ],
)
def test_normalize_value(spark, value, unit, want):
    df = spark.createDataFrame([(value, unit)], "v string, u string")
    assert df.select(numbers.normalize_value(F.col("v"), F.col("u"))).first()[0] == want


def test_whole_numbers(spark):
    assert apply(spark, numbers.to_int, [2.5, 3.5, -2.5, 1.2, None], "double") == [2, 4, -2, 1, None]
    got = apply(spark, numbers.to_whole, ["12", "-3", "－", "1.5", "１２"])
    assert [None if v is None else int(v) for v in got] == [12, -3, None, None, 12]


def test_two_places_agree_with_python(spark):
    rng = random.Random(1)
    values = [2.675, 1.005, 0.125, 0.375, -2.675, 1e12 + 0.125, *(rng.uniform(-1e6, 1e6) for _ in range(2000))]
    assert apply(spark, numbers.to_places, values, "double") == [round(v, 2) for v in values]


def test_ratio_and_sums(spark):
    df = spark.createDataFrame([(1.0, 0.0, None), (None, None, None)], "a double, b double, c double")
    got = df.select(
        numbers.ratio(F.col("a"), F.col("b")), numbers.sum_present([F.col("a"), F.col("c")]), numbers.plus_if_base(F.col("a"), F.col("c"))
    ).collect()
    assert [tuple(r) for r in got] == [(None, 1.0, 1.0), (None, None, None)]


def test_dates(spark):
    assert apply(spark, dates.fiscal_year, ["2023-04-01", "2023/04/01", "2023年4月", None]) == [2023, 2023, None, None]
    times = apply(spark, lambda c: dates.submit_time(c).cast("string"), ["2024-11-01 09:00", "2024-11-01 09:00:05", "x", "2023-02-29 09:00"])
    assert times == ["2024-11-01 09:00:00", "2024-11-01 09:00:05", None, None]


def test_year_shift(spark):
    pairs = [("2021-01-01", "2022-01-01"), ("2021-01-01", "2022-01-02"), ("2020-02-29", "2021-02-28"), ("2020-02-29", "2021-03-01")]
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = dates.day(F.col("a")), dates.day(F.col("b"))
    got = df.select(dates.one_year_later(a, b), F.coalesce(dates.one_year_later_day(a) == b, F.lit(False))).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, False), (False, False), (False, False)]


def test_codes_and_paths(spark):
    assert apply(spark, text.listing_code, ["79390", "793", None]) == ["7939", None, None]
    assert apply(spark, text.ticker, ["79390", "", None]) == ["7939", None, None]
    assert apply(spark, text.doc_id_of, ["file:/c/annual/E1/S1.tsv"]) == ["S1"]
    assert apply(spark, text.entity_id_of, ["file:/c/annual/E1/S1.tsv"]) == ["E1"]


def test_json_from_reply(spark):
    replies = [
        'so:\n```json\n{"explanation": "a", "is_accounting_fraud": true}\n```',
        'so {"explanation": "b"} end',
        '```json {"explanation": "c\x01d"} ```',
        '```json {broken ``` and ```json {"explanation": "e"} ```',
        "nothing",
        '```json broken ``` {"explanation": "not tried"}',
    ]
    got = apply(spark, lambda c: text.judgement_fields(c)["explanation"], replies)
    assert got == ["a", "b", "cd", "e", "", ""]
    assert apply(spark, lambda c: text.json_from_reply(c).isNull(), replies) == [False, False, False, False, True, True]
