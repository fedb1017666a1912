"""Random choice against brute force, also with one group holding most rows."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kessan.operators import audit, joins, sampling, select


def place(key):
    return hashlib.md5(f"42|{key}".encode()).hexdigest(), key


@pytest.fixture(scope="module")
def items(spark):
    # Two thirds of all rows in one group.
    data = [(f"k{i:05d}", "hot" if i % 3 else f"g{i % 7}", i % 5 == 0) for i in range(6000)]
    return data, spark.createDataFrame(data, "key string, grp string, label boolean").repartition(7)


def test_positions_are_the_ranks_in_hash_order(items):
    data, df = items
    want = {}
    for group in {g for _, g, _ in data}:
        for n, key in enumerate(sorted((k for k, g, _ in data if g == group), key=place), 1):
            want[key] = n
    got = {r.key: r.position for r in sampling.positions(df, "key", ("grp",)).collect()}
    assert got == want


def test_take_is_the_first_in_hash_order(items):
    data, df = items
    want = set(sorted((k for k, _, _ in data), key=place)[:100])
    assert {r.key for r in sampling.take(df, "key", 100).collect()} == want
    assert sampling.take(df, "key", 10**9).count() == len(data)
    assert sampling.take(df, "key", 0).count() == 0


def test_first_per_group(items):
    data, df = items
    got = sampling.first_per_group(df, "grp", "key", 35).collect()
    for group, n in Counter(r.grp for r in got).items():
        keys = sorted((k for k, g, _ in data if g == group), key=place)[:35]
        assert n == len(keys) and {r.key for r in got if r.grp == group} == set(keys)


def test_group_limit_is_applied_before_the_shuffle(items):
    plan = sampling.first_per_group(items[1], "grp", "key", 35)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_balance(items):
    _, df = items
    got = Counter(r.label for r in sampling.balance(df, "label", "key").collect())
    assert got[True] == got[False] == 1200


def test_split_keeps_groups_whole(items):
    data, df = items
    got = sampling.split_by_group(df, "grp").collect()
    assert len(got) == len(data)
    sides = {}
    for r in got:
        sides.setdefault(r.grp, set()).add(r.split)
    assert all(len(s) == 1 for s in sides.values())
    assert sum(s == {"test"} for s in sides.values()) == math.ceil(0.2 * len(sides))


def test_results_do_not_depend_on_partitioning(items):
    _, df = items
    a = sampling.balance(df.repartition(1), "label", "key").select("key").collect()
    b = sampling.balance(df.repartition(13), "label", "key").select("key").collect()
    assert sorted(a) == sorted(b)


def test_near_matches_against_all_pairs(spark):
    # A third of all amounts are equal, and all filings are of one company.
    data = [("E", f"d{i:03d}", 100.0 if i % 3 == 0 else i * 0.3) for i in range(150)]
    prior = [("E", f"d{i:03d}", 100.0 if i % 5 == 0 else i * 0.31) for i in range(150)]
    schema = "entity_id string, doc_id string, amount double"
    got = joins.near_matches(spark.createDataFrame(data, schema), spark.createDataFrame(prior, schema))
    want = {}
    for _, doc, amount in prior:
        hits = [d for _, d, a in data if abs(a - amount) <= 0.5 and d != doc]
        if hits:
            want[doc] = min(hits)
    assert {r.doc_id: r.match_doc for r in got.collect()} == want


def test_adjacent_filings_and_pairs(spark):
    data = [("E", "a", "2019-04-01", "2020-03-31"), ("E", "b", "2020-04-01", "2021-03-31"), ("E", "c", "2020-04-01", "2021-03-31"),
            ("E", "d", "2021-04-01", "2022-03-31"), ("E", "e", "2022-05-01", "2023-03-31"), ("F", "z", "2023-04-01", "2024-03-31")]
    df = spark.createDataFrame(data, "edinetCode string, docID string, periodStart string, periodEnd string")
    near = {(r.prev_doc, r.cur_doc) for r in select.adjacent_filings(df).collect()}
    assert near == {("a", "b"), ("b", "c"), ("c", "d"), ("d", "e")}
    assert {(r.prev_doc, r.cur_doc) for r in select.year_pairs(df).collect()} == {("a", "b"), ("c", "d")}


def test_document_lists_number_the_ids_of_a_large_company(spark):
    data = [("hot", f"S{i * 7 % 95:05d}") for i in range(95)] + [("E1", "S2"), ("E1", "S1")]
    got = audit.document_lists(spark.createDataFrame(data, "entity_id string, doc_id string").repartition(5)).collect()
    assert {(r.place, r.doc_id, r.tsv_count) for r in got if r.entity_id == "E1"} == {(1, "S1", 2), (2, "S2", 2)}
    hot = sorted((r.place, r.doc_id) for r in got if r.entity_id == "hot")
    assert hot == [(i + 1, f"S{i:05d}") for i in range(95)] and len(got) == 97


def test_sums_of_groups_hold(items):
    data, df = items
    assert sampling.positions(df, "key", ("grp",)).agg(F.sum(F.lit(1))).first()[0] == len(data)


def test_industry_candidates_leave_out_the_shipped_tickers(spark):
    from kessan.plans import labelled_sets

    first = labelled_sets.shipped_tickers(spark).first()["ticker"]
    columns = "edinetCode string, docID string, submitDateTime string, periodStart string, periodEnd string, formCode string, ordinanceCode string"
    filings = spark.createDataFrame(
        [(f"E{i}", f"S{i}", "2020-06-01 10:00", "2019-04-01", "2020-03-31", "030000", "010") for i in (1, 2)], columns
    )
    companies = spark.createDataFrame(
        [("E1", "建設業", first + "0"), ("E2", "建設業", "99990")], "entity_id string, industry string, sec_code string"
    )
    assert [r.doc_id for r in labelled_sets.industry_candidates(filings, companies).collect()] == ["S2"]
    none = labelled_sets.shipped_tickers(spark).limit(0)
    assert labelled_sets.industry_candidates(filings, companies, none).count() == 2
