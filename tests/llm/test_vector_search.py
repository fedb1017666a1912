from __future__ import annotations

import numpy as np
import pytest
from compare import duck, table
from llm_helpers import SF_DIR
from pyspark.sql import functions as F

from kessan.llm import impact_topk, multi_index_hashing, queries, vector_blocks


def test_top_k_query_against_sql(spark):
    name = "op2_impact_topk"
    got = queries.QUERIES[name](spark, SF_DIR)
    want = duck(SF_DIR).execute(queries.SQL[name])
    names = [d[0] for d in want.description]
    assert table(got.columns, [tuple(r) for r in got.collect()]) == table(names, want.fetchall())


def odd_rows():
    dice = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(dice.integers(-3, 4, (60, 6)) / 4)]
    rows += [(100 + i, list(rows[5][1])) for i in range(30)]  # ties
    rows += [(200, [0.0] * 6), (201, [0.0] * 6), (202, None), (203, [1.0, None] + [0.0] * 4), (204, [float("nan")] + [1.0] * 5),
             (205, [float("inf")] * 6), (7, [0.25] * 6), (7, [0.25] * 6), (3, [-0.5, 0.0, 0.75, 0.0, 0.0, 0.25]), (None, [1.0] * 6), (206, [1.0, 2.0]), (207, [2.0, 1.0]), (208, [])]
    return rows


def make(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, size string")


def plain(rows, k, scored, take_zero):
    ok = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    ok = [(i, v) for i, v in ok if take_zero or v.any()]
    out = []
    for place, (i, q) in enumerate(ok):
        others = sorted((*scored(q, v), j) for other, (j, v) in enumerate(ok) if other != place and len(v) == len(q))[:k]
        out += [(i, r, o[-1], o[1]) for r, o in enumerate(others, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,group", [(8192, 4096), (16, 8)])
def test_top_k_of_odd_rows(spark, monkeypatch, block, group):
    monkeypatch.setattr(impact_topk, "BLOCK", block)
    monkeypatch.setattr(impact_topk, "QUERY_GROUP", group)

    def scored(q, v):
        s = int((np.floor(q * 64) * np.floor(v * 64)).sum())
        return -s, s

    rows = odd_rows()
    got = impact_topk.top_k(make(spark, rows), F.lit(True), 7, 64)
    assert sorted(map(tuple, got.collect())) == plain(rows, 7, scored, True)
    assert impact_topk.top_k(make(spark, rows[:0]), F.lit(True), 7, 64).count() == 0


def test_waves_stop_on_proof_only():
    """Random blocks against full products, with early stops in between."""
    dice = np.random.default_rng(4)
    vectors = np.floor(dice.normal(size=(700, 32)) * dice.choice([2, 30], (700, 1))).astype(np.int64)
    place, dimension = np.nonzero(vectors)
    value = vectors[place, dimension]
    import pandas as pd

    rows = pd.DataFrame({"impact": abs(value), "term": 2 * dimension + (value < 0), "place": place})
    segments = rows.groupby(["impact", "term"])["place"].apply(np.array).rename("places").reset_index()
    first = pd.DataFrame({"impact": [0], "term": [-1], "places": [None], "keys": [np.arange(700)], "rows": [np.arange(700)]})
    block = impact_topk._Block(pd.concat([first, segments]), 32)
    got = impact_topk._search(block, np.arange(0, 700, 7), np.arange(0, 700, 7), vectors[::7], 5)
    assert len(block.waves) > 4
    for q, part in got.groupby("query_id"):
        s = vectors @ vectors[q]
        want = sorted((-int(x), i) for i, x in enumerate(s) if i != q)[:5]
        assert [(-a, b) for a, b in zip(part["score"], part["vec_id"], strict=True)] == want


def test_large_components_are_scored_exactly(spark):
    """Products that doubles cannot hold apart, and some that no long can hold."""
    big = float(2**27)
    rows = [(1, [big, 1.0, 0.0]), (2, [big, 2.0, 0.0]), (3, [big, 3.0, 1.0]), (4, [-big, 1.0, 1.0]), (5, [0.0, 1.0, 2.0])]

    def scored(q, v):
        s = sum(int(np.floor(a * 4)) * int(np.floor(b * 4)) for a, b in zip(q, v, strict=True))
        return -s, s

    got = impact_topk.top_k(make(spark, rows), F.lit(True), 4, 4)
    assert sorted(map(tuple, got.collect())) == plain(rows, 4, scored, True)
    huge = impact_topk.top_k(make(spark, [(1, [1e30]), (2, [1e30]), (3, [-1e30]), (4, [1.0])]), F.lit(True), 3, 64)
    top = {(r["query_id"], r["vec_id"]): r["score"] for r in huge.collect()}
    assert top[1, 2] == 2**63 - 1 and top[1, 3] == -(2**63) and len(top) == 12


def test_queries_of_one_id_are_answered_each(spark):
    """A second row of an id: both rows are queries with answers of their own, and find each other."""
    dice = np.random.default_rng(8)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(dice.integers(-9, 9, (30, 4)))]
    rows.append((0, [float(x) for x in dice.integers(-9, 9, 4)]))
    for found in (impact_topk.top_k(make(spark, rows), F.col("key") == 0, 20, 1), multi_index_hashing.nearest(make(spark, rows), F.col("key") == 0, 20, held=1.0)):
        assert sorted(r["rank"] for r in found.collect()) == sorted(2 * list(range(1, 21)))


def test_nearest_query_recall_and_scores(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = queries.op3_multi_index_hashing(spark, SF_DIR).collect()
    by_id = {i: np.array(v, float) for i, v in rows}
    hits = total = 0
    for q in [i for i in by_id if i % 100 == 0]:
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in mine] == list(range(1, 11))
        for _, i, score in mine:
            assert score == pytest.approx(np.linalg.norm(by_id[q] - by_id[i]), rel=1e-12)
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        true = sorted((np.linalg.norm(by_id[q] - v), i) for i, v in by_id.items() if i != q)[:10]
        hits += len({i for _, i in true} & {i for _, i, _ in mine})
        total += 10
    assert hits >= 0.9 * total


@pytest.mark.parametrize("block,group", [(8192, 4096), (16, 8)])
def test_nearest_of_odd_rows(spark, monkeypatch, block, group):
    """With all neighbours held the radius covers them; every query gets as many as there are."""
    monkeypatch.setattr(multi_index_hashing, "BLOCK", block)
    monkeypatch.setattr(multi_index_hashing, "QUERY_GROUP", group)
    rows = odd_rows()
    got = multi_index_hashing.nearest(make(spark, rows), F.lit(True), 7, held=1.0).collect()
    want = plain(rows, 7, lambda q, v: (float(np.sqrt(((q - v) ** 2).sum())),) * 2, False)
    assert [r[:2] for r in sorted(map(tuple, got))] == [r[:2] for r in want]
    assert multi_index_hashing.nearest(make(spark, rows[:0]), F.lit(True), 7).count() == 0


def test_probing_retrieves_every_code_in_the_radius():
    import pandas as pd

    dice = np.random.default_rng(3)
    vectors = dice.normal(size=(400, 16))
    learned = multi_index_hashing.learn(vectors, 10, 0.9, bits=32)
    for radius in (0, 3, 5, 9, 14, 32):
        codes = multi_index_hashing.Codes(learned.mean, learned.rotation, radius)
        code = codes.of(vectors)
        order = np.argsort(code, axis=0, kind="stable").astype("<i4")
        starts = np.stack([np.searchsorted(np.sort(c), np.arange(257)) for c in code.T]).astype("<i4")
        index = pd.Series({
            "size": 16, "keys": np.arange(400).astype("<i8").tobytes(), "rows": np.arange(400).astype("<i8").tobytes(), "vectors": vectors.tobytes(),
            "codes": code.tobytes(), "tables": order.T.tobytes(), "starts": starts.tobytes(),
        })
        asked = pd.DataFrame({"key": [0, 1], "row": [0, 1], "radius": radius, "vector": [vectors[0], vectors[1]]})
        found = multi_index_hashing._search(index, asked, codes, 400)
        for q in (0, 1):
            apart = np.bitwise_count(code ^ code[q]).sum(axis=1, dtype=int)
            want = {i for i in range(400) if i != q and apart[i] <= radius}
            assert set(found[found["query_id"] == q]["vec_id"]) == want


def test_blocks_are_even(spark):
    rows = spark.range(40_000).select(F.col("id").alias("key"), F.lit(4).alias("size"))
    parts = vector_blocks.parts(vector_blocks.counts(rows), 8192)
    sizes = [r["count"] for r in rows.groupBy(vector_blocks.part_of(parts, 3)).count().collect()]
    assert len(sizes) == 5 and max(sizes) < 8192 * 1.05
