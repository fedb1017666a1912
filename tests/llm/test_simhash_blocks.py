from __future__ import annotations

import random
import re

import pytest
import xxhash
from llm_helpers import SF_DIR

from kessan.llm import components, queries, simhash_blocks


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union_find(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def plain_components(fps):
    """Ids to the smallest id reachable, by comparing all pairs. ``fps``: list of (id, fp)."""
    distinct = sorted({f for _, f in fps})
    roots = union_find(distinct, [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 2])
    least = {}
    for key, fp in fps:
        if key is not None:
            least[roots[fp]] = min(key, least.get(roots[fp], key))
    return [(key, f"{fp:016x}", least.get(roots[fp])) for key, fp in fps]


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    want = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in docs])
    assert as_rows(queries.op9_simhash_blocks(spark, SF_DIR)) == sorted(want, key=str)


def test_odd_texts(spark, docs):
    texts = ["", None, " \t\n", "One", "one", "ONE TWO", "one two", "a b c", "A  B\nC", "É a", "é a", "x " * 70_000]
    table = docs([*texts, (50, "a b c", None, None, None, None), (50, "a b c", None, None, None, None),
                  (None, "q r s", None, None, None, None), (None, "one", None, None, None, None)])
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in table.collect()]
    assert as_rows(simhash_blocks.near_duplicates(table)) == sorted(plain_components(rows), key=str)
    assert simhash_blocks.near_duplicates(docs([])).count() == 0


@pytest.mark.parametrize("hot", [64, 3, 0])
def test_links_of_clouds_of_fingerprints(spark, monkeypatch, hot):
    """Clouds around a few centres, compared pair by pair, in hot blocks and both mixed."""
    monkeypatch.setattr(simhash_blocks, "HOT", hot)
    dice = random.Random(4)
    fps = {0, 2**64 - 1}
    for _ in range(6):
        centre = dice.getrandbits(64)
        for _ in range(60):
            flips = [1 << dice.randrange(64) for _ in range(dice.randrange(9))]
            fps.add(centre ^ sum(set(flips)))
    signed = {simhash_blocks._signed(f) for f in fps}
    roots = components.components(simhash_blocks.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2))
    found = {r["node"]: r["root"] for r in roots.collect()}
    plain = union_find(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2])
    classes = lambda of: {frozenset(n for n in of if of[n] == r) for r in of.values()}
    want = {frozenset(map(simhash_blocks._signed, c)) for c in classes(plain)}
    assert classes({f: found.get(f, f) for f in signed}) == want
    assert any(len(c) > 3 for c in want)


def test_distance_must_be_even(spark):
    with pytest.raises(ValueError, match="even"):
        simhash_blocks.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7), (2000, 1999)]
    edges += [(3000 + i, 3000 + (7 * i + 3) % 61) for i in range(61)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    plain = union_find(nodes, [e for e in edges if e[0] != e[1]])
    assert set(found) == nodes
    assert len({(found[n], plain[n]) for n in nodes}) == len(set(plain.values())) == len(set(found.values()))
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
