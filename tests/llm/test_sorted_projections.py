from __future__ import annotations

import numpy as np
import pytest
from compare import duck, table
from llm_helpers import SF_DIR

from kessan.llm import queries, sorted_projections


def plain(rows, threshold):
    """All pairs of rows ``(id, vector, label)``: links, component, kept."""
    ok = [
        np.array(v, float) if v and label is not None and None not in v and np.isfinite(v).all() and any(v) else None
        for _, v, label in rows
    ]
    near = [[] for _ in rows]
    for i, v in enumerate(ok):
        for j, w in enumerate(ok):
            if i != j and v is not None and w is not None and len(v) == len(w) and rows[i][2] == rows[j][2]:
                if (v / abs(v).max()) @ (w / abs(w).max()) >= threshold * np.linalg.norm(v / abs(v).max()) * np.linalg.norm(w / abs(w).max()):
                    near[i].append(j)
    out = []
    for i, (key, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = set(near[todo.pop()]) - seen
            seen |= new
            todo += new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((key, len(near[i]), least, key is not None and key == least))
    return sorted(out, key=str)


def make(spark, rows):
    own = "vec_id long, embedding array<double>, label int, item string, size string, `a.b` string"
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], own)


def found(df):
    return sorted(map(tuple, df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def clouds(n, seed=3):
    dice = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        centre = np.random.default_rng(i % 7).normal(size=12)
        rows.append((int(i), [float(x) for x in centre + dice.normal(size=12) * 0.25], int(i % 7 % 3)))
    return rows


@pytest.mark.parametrize("window,block", [(1024, 2048), (64, 128), (64, 48)])
def test_clouds_against_all_pairs(spark, monkeypatch, window, block):
    """Clouds larger than the window, over many blocks; no pair is counted twice at their borders."""
    monkeypatch.setattr(sorted_projections, "BLOCK", block)
    rows = clouds(500)
    got = found(sorted_projections.near_duplicates(make(spark, rows), 0.93, window, recall=0.99999))
    want = plain(rows, 0.93)
    assert sum(r[1] for r in want) > 2000
    if window >= 500:
        assert got == want
    else:
        share = sum(r[1] for r in got) / sum(r[1] for r in want)
        assert 0.97 <= share <= 1 and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
        assert [g[2:] for g in got] == [w[2:] for w in want]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.1], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1),
        (7, [], 1), (8, [0.0, -0.0], 1), (9, [1.0, None], 1), (10, [nan, 1.0], 1), (11, [inf, 1.0], 1), (12, [1.0, 0.0, 0.0], 1),
        (13, [1e200, 1e190], 1), (14, [1e-300, 0.0], 1), (4, [1.0, 0.0], 2), (None, [0.0, 1.0], 3), (None, [0.0, 1.0], 3),
        (20, [0.0, 1.0], 4), (None, [0.0, 1.0], 4), (21, [-0.0, 3.0], 4), (22, [0.0, 3.0], 4), (30, [-1.0, 0.0], 1),
    ] + [(100 + i, [0.3, 0.4], 5) for i in range(300)]
    assert found(sorted_projections.near_duplicates(make(spark, rows))) == plain(rows, 0.93)
    assert sorted_projections.near_duplicates(make(spark, [])).count() == 0
    assert found(sorted_projections.near_duplicates(make(spark, rows[4:7]))) == plain(rows[4:7], 0.93)


def test_passes_grow_with_the_largest_label():
    for largest, window in ((100, 1024), (10**4, 1024), (10**9, 1024)):
        n = sorted_projections.passes_for(largest, window, 0.93, 0.999)
        assert n == 1 if largest <= window else n > 3
    assert sorted_projections.passes_for(10**9, 1024, 0.93, 0.999) < 150


def test_query_against_sql(spark):
    name = "op11_sorted_projections"
    got = queries.QUERIES[name](spark, SF_DIR)
    want = duck(SF_DIR).execute(queries.SQL[name])
    names = [d[0] for d in want.description]
    assert table(got.columns, [tuple(r) for r in got.collect()]) == table(names, want.fetchall())
