"""Exact top-k by inner product from an impact-ordered, score-at-a-time index.

A vector of integers is a document whose terms are the signed dimensions: component ``v`` of
dimension ``d`` is a posting of term ``d+`` or ``d-`` with impact ``|v|``. A posting segment holds
the vectors of a block with one impact in one term. A query reads segments by descending impact,
in waves of a factor of two, for many queries at a time, and adds to one accumulator per vector.

After a wave the unread part of a vector is known by its length only, so its score is within
``|query| * |unread part|`` of its accumulator (Cauchy-Schwarz). A query stops when that proves
all but a few vectors out of its best ``k``; those left are rescored exactly. No bound is a
guess: where nothing is proven, all segments are read.

Components are ``floor(scale * x)``. Vectors that are null or hold null or non-finite components
take no part, as rows without an id. Rows of equal id are vectors of their own: each is a query
and answered for itself, and finds the others. A vector of zeros has no postings and score zero.
Fewer than ``k`` other vectors are all returned. Scores are exact at any size of the components;
components and scores beyond the range of a long are set to its ends.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kessan.llm.vector_blocks import BLOCK, QUERY_GROUP, best, counts, every, numbered, part_of, parts, usable
from kessan.session import written

#: Queries whose accumulators are held at a time, and vectors per wanted one at which a query stops.
AT_ONCE, STOP_AT = 256, 8
LONGEST = (1 << 63) - 1


def quantised(df: DataFrame, scale: float, key: str, vector: str) -> DataFrame:
    """``key, vector array<long>, size, row``."""
    scaled = F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    return numbered(usable(df, key, vector).withColumn("vector", scaled), "quantised")


def build_index(vectors: DataFrame, blocks: Column) -> DataFrame:
    """``size, block, impact, term, keys, rows, places``: the posting segments of every block, term
    ``2 d`` or ``2 d + 1`` for a positive or negative component of dimension ``d``. The segment
    of impact 0 and term -1 lists all vectors of the block."""

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key", kind="stable")
        matrix = np.maximum(np.stack(rows["vector"].to_numpy()).astype(np.int64), -LONGEST)
        place, dimension = np.nonzero(matrix)
        value = matrix[place, dimension]
        impact, term = np.abs(value), 2 * dimension + (value < 0)
        order = np.lexsort((place, term, -impact))
        impact, term, place = impact[order], term[order], place[order]
        starts = np.flatnonzero(np.r_[True, (impact[1:] != impact[:-1]) | (term[1:] != term[:-1])]) if len(order) else []
        segments = np.split(place.astype(np.int32), starts[1:]) if len(order) else []
        return pd.DataFrame({
            "size": int(rows["size"].iloc[0]), "block": int(rows["block"].iloc[0]),
            "impact": [0, *impact[starts].tolist()], "term": [-1, *term[starts].tolist()],
            "keys": [rows["key"].to_numpy(), *[None] * len(segments)],
            "rows": [rows["row"].to_numpy(), *[None] * len(segments)], "places": [None, *segments],
        })

    placed = vectors.withColumn("block", part_of(blocks, 3))
    schema = "size int, block int, impact long, term int, keys array<long>, rows array<long>, places array<int>"
    return written(placed.groupBy("size", "block").applyInPandas(block, schema), "impact-index")


def _waves(impacts: np.ndarray) -> list[int]:
    """Least impact of each wave: halves of the largest, down to one."""
    out, top = [], int(impacts.max(initial=0))
    while top:
        top //= 2
        out.append(top + 1)
    return out


class _Block:
    """The segments of one block, wave by wave."""

    def __init__(self, rows: pd.DataFrame, size: int):
        every_one = rows[rows["term"] < 0].iloc[0]
        self.keys, self.rows = np.asarray(every_one["keys"], np.int64), np.asarray(every_one["rows"], np.int64)
        self.size = size
        segments = rows[rows["term"] >= 0].sort_values("impact", ascending=False, kind="stable")
        counts = segments["places"].map(len).to_numpy().astype(np.int64)
        self.impact = np.repeat(segments["impact"].to_numpy().astype(np.int64), counts)
        self.term = np.repeat(segments["term"].to_numpy().astype(np.int64), counts)
        parts = segments["places"].to_list()
        self.place = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        # What is unread of each vector after each wave, as a length; the segments stay as they are.
        self.waves, at, size_of = [], 0, self.impact.astype(float) ** 2
        left = np.bincount(self.place, size_of, len(self.keys))
        self.lengths = np.sqrt(left)
        for least in _waves(self.impact):
            end = int(np.searchsorted(-self.impact, -least, "right"))
            left = left - np.bincount(self.place[at:end], size_of[at:end], len(self.keys))
            rest = np.sqrt(np.maximum(left, 0)) if end < len(self.impact) else np.zeros(len(self.keys))
            self.waves.append((at, end, rest + 1e-7 * self.lengths * (end < len(self.impact))))
            at = end

    def part(self, start: int, end: int, kind: type = float) -> np.ndarray:
        matrix = np.zeros((len(self.keys), self.size), kind)
        sign = 1 - 2 * (self.term[start:end] & 1)
        matrix[self.place[start:end], self.term[start:end] >> 1] = sign * self.impact[start:end]
        return matrix


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row by row inner products of integers, exact; beyond the range of a long its ends."""
    if float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1] < 2.0**62:
        return (queries * vectors).sum(axis=1)
    exact = (queries.astype(object) * vectors.astype(object)).sum(axis=1)
    return np.array([max(-LONGEST - 1, min(LONGEST, x)) for x in exact], np.int64)


def _search(block: _Block, ids: np.ndarray, rows: np.ndarray, whole: np.ndarray, k: int) -> pd.DataFrame:
    """The best ``k`` of the block for each query, exactly. ``whole``: the queries as integers."""
    queries, full = whole.astype(float), block.part(0, len(block.impact), np.int64)
    n, found = len(block.keys), []
    open_ = np.arange(len(ids))
    sums = np.zeros((len(ids), n))
    sums[rows[:, None] == block.rows[None, :]] = -np.inf
    lengths = np.sqrt((queries**2).sum(axis=1))
    for start, end, left in block.waves or [(0, 0, np.zeros(n))]:
        sums[open_] += queries[open_] @ block.part(start, end).T
        last = end == len(block.impact)
        if not last and left.max() * lengths.max() > np.abs(sums[open_][np.isfinite(sums[open_])]).max(initial=0):
            continue  # too early for any proof
        # What is unread, and what the sums of doubles may be off by.
        slack = lengths[open_][:, None] * (left * (1 + 1e-9) + 1e-12 * block.lengths)[None, :] + 1e-6
        low = sums[open_] - slack
        bar = np.partition(low, n - k, axis=1)[:, n - k] if n > k else np.full(len(open_), -np.inf)
        possible = (sums[open_] + slack >= bar[:, None]) & np.isfinite(sums[open_])
        done = np.ones(len(open_), bool) if last else possible.sum(axis=1) <= STOP_AT * k
        at, place = np.nonzero(possible[done])
        at = open_[done][at]
        exact = _products(whole[at], full[place])
        order = np.lexsort((block.keys[place], -exact, at))
        at, place, exact = at[order], place[order], exact[order]
        first = np.searchsorted(at, at, "left")
        keep = np.arange(len(at)) - first < k
        found.append(pd.DataFrame({"query_row": rows[at[keep]], "query_id": ids[at[keep]], "vec_id": block.keys[place[keep]], "score": exact[keep]}))
        open_ = open_[~done]
        if not len(open_):
            break
    return pd.concat(found)


def top_k(
    df: DataFrame, is_query: Column, k: int, scale: float, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that satisfies ``is_query`` (of column
    ``key``) the ``k`` others with the highest inner products, ties to the smaller id."""
    vectors = quantised(df, scale, key, vector)
    queries = vectors.filter(is_query)
    groups, blocks = parts(counts(queries), QUERY_GROUP), parts(counts(vectors), BLOCK)
    index = build_index(vectors, blocks)
    asked = queries.withColumn("part", part_of(groups, 5)).withColumn("block", every(blocks))
    read = index.withColumn("part", every(groups))
    keys = ["size", "block", "part"]

    def search(segments: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(segments) or not len(rows):
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})
        block = _Block(segments, int(segments["size"].iloc[0]))
        matrix = np.maximum(np.stack(rows["vector"].to_numpy()).astype(np.int64), -LONGEST)
        ids, numbers = rows["key"].to_numpy(), rows["row"].to_numpy()
        runs = [slice(i, i + AT_ONCE) for i in range(0, len(ids), AT_ONCE)]
        return pd.concat([_search(block, ids[r], numbers[r], matrix[r], k) for r in runs])

    found = read.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        search, "query_row long, query_id long, vec_id long, score long"
    )
    return best(found, k, F.desc("score")).drop("query_row")
