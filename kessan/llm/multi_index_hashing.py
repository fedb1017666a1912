"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Codes are the signs of rotated vectors; rotations are learned on a bounded sample so that vectors
lie close to their signs (iterative quantisation), several of them for longer codes. A code is
split into 8-bit substrings, each with its own table of buckets. By the pigeonhole principle a
code within ``m * s + a`` bits of the query's (``m`` substrings) is within ``s`` bits in one of the
first ``a + 1`` substrings or within ``s - 1`` in one of the others, so probing those buckets
retrieves every code within the radius; their full distance is checked, and what is left is
ranked by Euclidean distance of the original vectors.

The radius is learned, too: the one that holds ``held`` of the true neighbours in the sample,
whose neighbours are farther than those of all rows. A query that finds fewer than ``k`` is asked
again with twice the radius, up to all codes, so no query gets less than there is. All vectors are
indexed. Null vectors, zero ones, those with null or non-finite components, and rows without an
id take no part. Rows of equal id are vectors of their own: each is a query and answered for
itself, and finds the others.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kessan.llm.vector_blocks import BLOCK, QUERY_GROUP, best, by_size, counts, every, numbered, part_of, parts, usable
from kessan.session import written

#: Vectors that rotations and radius are learned on, about, of each length; bits of a code, at least.
SAMPLE, BITS, STEPS = 4096, 128, 30


@dataclass(frozen=True)
class Codes:
    """What was learned for vectors of one length."""

    mean: np.ndarray
    rotation: np.ndarray  # components by bits
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """One byte per substring."""
        return np.packbits((vectors - self.mean) @ self.rotation > 0, axis=1)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Largest component one, so that no product overflows."""
    return vectors / max(np.abs(vectors).max(initial=0), 1e-300)


def learn(vectors: np.ndarray, k: int, held: float, bits: int = BITS, seed: int = 7) -> Codes:
    """Rotations and radius from a sample (rows)."""
    dice, n, size = np.random.default_rng(seed), *vectors.shape
    mean = vectors.mean(axis=0)
    centred = _scaled(vectors - mean)
    parts = []
    for _ in range(-(-bits // size)):
        rotation = np.linalg.qr(dice.normal(size=(size, size)))[0]
        for _ in range(STEPS):
            u, _, vt = np.linalg.svd(centred.T @ np.where(centred @ rotation > 0, 1.0, -1.0))
            rotation = u @ vt
        parts.append(rotation)
    rotation = np.concatenate(parts, axis=1)
    rotation = rotation[:, : -(-max(bits, size) // 8) * 8]
    if short := -rotation.shape[1] % 8:
        rotation = np.concatenate([rotation, np.zeros((size, short))], axis=1)
    codes = Codes(mean, rotation, 0).of(vectors)
    asked = dice.permutation(n)[:256]
    near = max(1, min(k, n - 1))
    distance = (centred[asked] ** 2).sum(1)[:, None] - 2 * centred[asked] @ centred.T + (centred**2).sum(1)[None, :]
    distance[np.arange(len(asked)), asked] = np.inf
    nearest = np.argsort(distance, axis=1, kind="stable")[:, :near]
    apart = np.bitwise_count(codes[asked][:, None, :] ^ codes[nearest]).sum(axis=2, dtype=int)
    return Codes(mean, rotation, int(np.ceil(np.quantile(apart, held))) if n > 1 else rotation.shape[1])


def _probes() -> list[np.ndarray]:
    """All byte values of at most 0, 1, .. 8 bits."""
    by_bits = [[sum(1 << b for b in c) for c in combinations(range(8), r)] for r in range(9)]
    return [np.array(sum(by_bits[: r + 1], []), np.uint8) for r in range(9)]


def build_index(vectors: DataFrame, codes: dict[int, Codes], blocks: Column) -> DataFrame:
    """One row per block: its vectors and codes, and per substring the vectors by bucket."""

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key", kind="stable")
        matrix = np.stack(rows["vector"].to_numpy()).astype("<f8")
        code = codes[int(rows["size"].iloc[0])].of(matrix)
        order = np.argsort(code, axis=0, kind="stable").astype("<i4")
        starts = np.stack([np.searchsorted(np.sort(c), np.arange(257)) for c in code.T]).astype("<i4")
        return pd.DataFrame({
            "size": rows["size"].iloc[:1].to_numpy(), "block": rows["block"].iloc[:1].to_numpy(),
            "keys": [rows["key"].to_numpy().astype("<i8").tobytes()],
            "rows": [rows["row"].to_numpy().astype("<i8").tobytes()], "vectors": [matrix.tobytes()],
            "codes": [code.tobytes()], "tables": [order.T.tobytes()], "starts": [starts.tobytes()],
        })

    placed = vectors.withColumn("block", part_of(blocks, 3))
    schema = "size int, block int, keys binary, rows binary, vectors binary, codes binary, tables binary, starts binary"
    return written(placed.groupBy("size", "block").applyInPandas(block, schema), "hash-index")


def _search(index: pd.Series, asked: pd.DataFrame, codes: Codes, k: int) -> pd.DataFrame:
    size = int(index["size"])
    keys, rows = np.frombuffer(index["keys"], "<i8"), np.frombuffer(index["rows"], "<i8")
    n, m = len(keys), codes.rotation.shape[1] // 8
    vectors = np.frombuffer(index["vectors"], "<f8").reshape(n, size)
    code = np.frombuffer(index["codes"], np.uint8).reshape(n, m)
    tables = np.frombuffer(index["tables"], "<i4").reshape(m, n)
    starts = np.frombuffer(index["starts"], "<i4").reshape(m, 257)
    probes, out = _probes(), []
    matrix = np.stack(asked["vector"].to_numpy()).astype(float)
    wanted = codes.of(matrix)
    for row, (query, own, radius) in enumerate(zip(asked["key"], asked["row"], asked["radius"], strict=True)):
        bits, more = divmod(min(int(radius), 8 * m), m)
        hit = np.zeros(n, bool)
        for j in range(m):
            within = bits - (j > more)
            if within < 0:
                continue
            values = wanted[row, j] ^ probes[min(within, 8)]
            begin, end = starts[j, values], starts[j, values.astype(int) + 1]
            count = end - begin
            at = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
            hit[tables[j, at]] = True
        found = np.flatnonzero(hit & (rows != own))
        apart = np.bitwise_count(code[found] ^ wanted[row]).sum(axis=1, dtype=int)
        found = found[apart <= radius]
        distance = np.sqrt(((vectors[found] - matrix[row]) ** 2).sum(axis=1))
        order = np.lexsort((keys[found], distance))[:k]
        out.append(pd.DataFrame({"query_row": own, "query_id": query, "vec_id": keys[found[order]], "score": distance[order]}))
    return pd.concat(out)


def nearest(
    df: DataFrame, is_query: Column, k: int, held: float = 0.98, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that satisfies ``is_query`` (of column
    ``key``) its ``k`` nearest others among those found, ties to the smaller id."""
    vectors = numbered(usable(df, key, vector).filter(F.exists("vector", lambda x: x != 0)), "vectors")
    total = counts(vectors)
    # The rows with the lowest hashes: about SAMPLE of each length, whatever the table's size.
    share = by_size({size: min(1.0, SAMPLE / n) for size, n in total.items()}, 0.0)
    low = F.xxhash64("key", F.lit(9)).cast("double") / F.lit(2.0**64) + 0.5 <= share
    sample = vectors.filter(low).select("key", "size", "vector").toPandas().sort_values("key", kind="stable")
    codes = {int(s): learn(np.stack(g["vector"].to_numpy()), k, held) for s, g in sample.groupby("size")}
    if not codes:
        return vectors.select(
            F.col("key").alias("query_id"), F.lit(0).alias("rank"), F.col("key").alias("vec_id"), F.lit(0.0).alias("score")
        )
    blocks = parts(total, BLOCK)
    index = build_index(vectors, codes, blocks)
    radius = by_size({size: c.radius for size, c in codes.items()}, 0)
    widest = by_size({size: c.rotation.shape[1] for size, c in codes.items()}, 0)
    queries = written(
        vectors.filter(is_query).select(
            "key", "row", "vector", "size", radius.alias("radius"), widest.alias("widest"), (by_size(total, 1) - 1).alias("others")
        ),
        "hash-queries",
    )
    groups = parts(counts(queries), QUERY_GROUP)
    read = index.withColumn("part", every(groups))
    keys = ["size", "block", "part"]

    def search(block: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(rows):
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})
        return _search(block.iloc[0], rows, codes[int(block["size"].iloc[0])], k)

    result = None
    while True:
        asked = queries.withColumn("part", part_of(groups, 5)).withColumn("block", every(blocks))
        found = read.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
            search, "query_row long, query_id long, vec_id long, score double"
        )
        ranked = written(best(found, k, F.asc("score")), "hash-found")
        sizes = ranked.groupBy("query_row").agg(F.count(F.lit(1)).alias("n"))
        rest = queries.join(sizes, queries["row"] == sizes["query_row"], "left").filter(
            (F.coalesce("n", F.lit(0)) < F.least(F.lit(k), "others")) & (F.col("radius") < F.col("widest"))
        ).select("key", "row", "vector", "size", F.least(F.col("radius") * 2 + 1, "widest").alias("radius"), "widest", "others")
        again = written(rest, "hash-queries")
        done = ranked.join(again.select(F.col("row").alias("query_row")), "query_row", "left_anti").drop("query_row")
        result = done if result is None else result.unionByName(done)
        if again.isEmpty():
            return result
        queries = again
