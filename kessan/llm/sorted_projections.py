"""Near-duplicate vectors by sorted projection passes.

In each pass every vector gets a string of random hashes (the signs of random projections), the
vectors of one label are ordered lexicographically by it, and each is compared with the
``window`` vectors that follow. Pairs with a cosine of at least ``threshold`` are links; the links
of all passes are united into components.

* Equal vectors of one label are one item with a count, so copies, however many, cost one row.
* The order of a pass is that of positions in one global sort over (pass, label, hashes), so a
  label with a third of all rows is cut like any other. Blocks of ``BLOCK`` positions with the
  ``window`` after them are the tasks; ties of hashes are broken anew in every pass.
* A pair that lies within the window in several passes counts in the first one, which its
  positions tell. So a task gives sums and one edge per row, never pairs.
* How many passes are made follows from the largest label: a pair at the threshold shares a prefix
  long enough to fall into the window with a known chance per pass, and ``recall`` is the chance
  to meet at least once. Labels with at most ``window + 1`` vectors are compared completely. Links
  among more than ``window`` vectors with nearly equal hashes are met at random, pass by pass; their
  components do not depend on meeting all.

Vectors that are null, empty, zero or hold null or non-finite components, and those without a label,
link with nothing, nor do vectors of unlike lengths. Rows that share an id are vectors of their
own. Rows without an id may link others; a component without any id has none, and such rows are
never kept. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kessan.llm.columns import narrow
from kessan.llm.components import components
from kessan.llm.positions import positioned
from kessan.session import written

#: Positions of a block, and bits of a pass's hash string.
BLOCK, BITS = 2048, 62
#: Rows of a block compared at a time.
STEP = 256


def passes_for(largest: int, window: int, threshold: float, recall: float) -> int:
    """Passes after which a pair at the threshold has met with a chance of ``recall``: one bit
    agrees with chance ``1 - angle / pi``, and a window of ``2 * window`` rows holds the vectors
    that share ``log2(largest / (2 * window))`` bits."""
    if largest <= window + 1:
        return 1
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    met = agree ** max(1.0, math.log2(largest / (2 * window)))
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - met))) if met < 1 else 2


def _units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _hashed(items: DataFrame, passes: int, seed: int) -> DataFrame:
    """``item, size, label, pass, hashes, tie`` with a row per pass."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (np.int64(1) << np.arange(BITS, dtype=np.int64))[::-1]
        directions: dict[int, np.ndarray] = {}
        for batch in batches:
            size = batch.column(1).to_numpy()
            flat, bounds = batch.column(3).flatten().to_numpy(), np.append(0, np.cumsum(size))
            key = np.empty((batch.num_rows, passes), np.int64)
            for width in np.unique(size):
                if width not in directions:
                    dice = np.random.default_rng([seed, int(width)])
                    directions[width] = dice.standard_normal((width, passes * BITS))
                mine = np.flatnonzero(size == width)
                for at in range(0, len(mine), STEP):
                    some = mine[at : at + STEP]
                    units = _units(flat[bounds[some][:, None] + np.arange(width)])
                    key[some] = ((units @ directions[width]) > 0).reshape(len(some), passes, BITS) @ weights
            once = np.repeat(np.arange(batch.num_rows), passes)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(pa.array(once)) for i in range(3)),
                 pa.array(np.tile(np.arange(passes, dtype=np.int32), batch.num_rows)), pa.array(key.reshape(-1))],
                ["item", "size", "label", "pass", "hashes"],
            )

    rows = items.select("item", "size", "label", "vector").mapInArrow(
        work, "item long, size int, label string, pass int, hashes long"
    )
    return rows.withColumn("tie", F.xxhash64("item", "pass", F.lit(seed)))


def _linked(position: np.ndarray, label: np.ndarray, size: np.ndarray, ring: np.ndarray, places: np.ndarray,
            copies: np.ndarray, vectors: np.ndarray, own: int, window: int, threshold: float):
    """Sums of newly linked copies per row and a root per row, for rows in order of position. Only
    the first ``own`` rows are the block's; those after them are compared by the next one, too."""
    found, root = np.zeros(len(position), np.int64), np.arange(len(position))
    run = (label[1:] != label[:-1]) | (size[1:] != size[:-1]) | (ring[1:] != ring[:-1]) | (np.diff(position) != 1)
    starts = np.flatnonzero(np.append(True, run))
    for start, end in zip(starts, np.append(starts[1:], len(position)), strict=True):
        if end - start < 2:
            continue
        units, places_of = _units(np.stack(vectors[start:end])), places[start:end]
        for a in range(0, min(end, own) - start, STEP):
            b, c = min(a + STEP, min(end, own) - start), min(a + STEP + window, end - start)
            near = units[a:b] @ units[a:c].T >= threshold
            i, j = np.nonzero(near)
            ahead = j - i
            pair = (ahead > 0) & (ahead <= window)
            i, j = i[pair] + a, j[pair] + a
            earlier = np.arange(places_of.shape[1]) < ring[start]
            fresh = ~((np.abs(places_of[i][:, earlier] - places_of[j][:, earlier]) <= window).any(axis=1))
            i, j = i[fresh] + start, j[fresh] + start
            found += np.bincount(i, copies[j], len(found)).astype(np.int64)
            found += np.bincount(j, copies[i], len(found)).astype(np.int64)
            for x, first in zip(*np.unique(i, return_index=True), strict=True):
                others = j[first : np.searchsorted(i, x, "right")]
                roots = np.unique(np.append(root[others], root[x]))
                if len(roots) > 1:
                    root[np.isin(root, roots[1:])] = roots[0]
    return found, root


def links(items: DataFrame, passes: int, window: int, threshold: float, seed: int) -> DataFrame:
    """``item, found, root``: per block and row with new links, the copies newly linked and the
    smallest-placed item of the block it is linked to. ``items``: ``item, size, label, copies, vector``."""
    ordered = positioned(
        written(_hashed(items, passes, seed), "projections"),
        *(F.col(c) for c in ("pass", "size", "label", "hashes", "tie", "item")), name="projection-order",
    )
    places = ordered.groupBy("item").agg(
        *(F.max(F.when(F.col("pass") == p, F.col("position"))).alias(f"p{p}") for p in range(passes))
    ).select("item", F.array(*(f"p{p}" for p in range(passes))).alias("places"))
    placed = items.join(places, "item").select("*", F.posexplode("places").alias("ring", "position"))
    block = F.floor(F.col("position") / BLOCK)
    reach = F.greatest(F.lit(0).cast("long"), F.floor((F.col("position") - window) / BLOCK))
    dealt = placed.withColumn("block", F.explode(F.sequence(reach, block)))

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("position", ignore_index=True)
        item, position = rows["item"].to_numpy(), rows["position"].to_numpy()
        own = int(np.searchsorted(position, (rows["block"].iloc[0] + 1) * BLOCK))
        found, root = _linked(
            position, rows["label"].to_numpy(), rows["size"].to_numpy(), rows["ring"].to_numpy(),
            np.stack(rows["places"].to_numpy()), rows["copies"].to_numpy(), rows["vector"].to_numpy(), own,
            window, threshold,
        )
        hit = np.flatnonzero(found)
        return pd.DataFrame({"item": item[hit], "found": found[hit], "root": item[root[hit]]})

    return dealt.groupBy("block").applyInPandas(work, "item long, found long, root long")


def near_duplicates(
    df: DataFrame, threshold: float = 0.93, window: int = 1024, recall: float = 0.999, seed: int = 17,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """``key, n_links, component_id, kept`` per row of ``df``."""
    named = narrow(df, key=key, vector=vector, label=label).select(
        "key", F.col("label").cast("string").alias("label"), F.col("vector").cast("array<double>").alias("vector")
    )
    infinite = F.lit(float("inf"))
    finite: Column = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    linkable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    vectors = F.when(linkable, F.transform("vector", lambda x: x + F.lit(0.0)))  # no minus zero
    rows = named.select("key", "label", vectors.alias("vector"))
    digest = [F.xxhash64(F.lit(s), "label", "vector").alias(f"digest{s}") for s in (1, 2)]
    items = written(
        rows.filter("vector IS NOT NULL").groupBy("label", "vector").agg(
            F.count(F.lit(1)).alias("copies"), F.min("key").alias("least")
        ).select("*", *digest, F.size("vector").alias("size"), F.monotonically_increasing_id().alias("item")),
        "vectors",
    )
    sizes = items.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()
    passes = passes_for(sizes["n"] or 0, window, threshold, recall)
    found = written(links(items, passes, window, threshold, seed), "projection-links")
    roots = components(found.select(F.col("item").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("item").agg(F.sum("found").alias("found"))
    rooted = written(
        items.select("item", "copies", "least", "digest1", "digest2")
        .join(counted, "item", "left").join(roots.withColumnRenamed("node", "item"), "item", "left")
        .select("digest1", "digest2", "least", F.coalesce("root", "item").alias("root"),
                (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        "rooted-vectors",
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    result = written(rooted.join(least, "root").select("digest1", "digest2", "n_links", "component_id"), "linked-vectors")
    mine = rows.select("key", *(F.when(F.col("vector").isNotNull(), d).alias(f"digest{i}") for i, d in enumerate(digest, 1)))
    own = F.when(F.col("digest1").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return mine.join(result, ["digest1", "digest2"], "left").select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), own.alias("component_id"),
        F.coalesce(F.col("key") == own, F.lit(False)).alias("kept"),
    )
