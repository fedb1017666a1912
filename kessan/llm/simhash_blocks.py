"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint is cut into ``max_distance + 1`` blocks; two fingerprints that differ in at most
``max_distance`` bits agree in one block, so the join on blocks meets every close pair, and the
pairs are verified by their Hamming distance. Only distinct fingerprints are joined: copies of
one fingerprint, however many, are one row.

A block value that more than ``HOT`` fingerprints share would cost the square of its size. Its
fingerprints are linked another, exact way: two of them are within ``max_distance`` bits if and
only if some value lies within half that distance of both, so each fingerprint is listed under
all values that near (65 for two bits), and those listed under one value are linked to its
smallest. That costs the same per fingerprint at any size of the block.

Texts without words (null ones, too) have fingerprint zero and are linked like any other. Rows
with equal ids or none are kept one by one; a component's id is the smallest id that is not null,
so a component without ids has none. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kessan.llm.columns import narrow, quoted
from kessan.llm.components import components
from kessan.session import written

#: Fingerprints of a block value that are still compared pair by pair.
HOT = 64
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits; a bit is set where over half of the shingles' hashes have it set."""
    from xxhash import xxh64_intdigest as digest

    words = (text or "").encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[-n:].tolist()
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 255 * 256):  # bytes count to 255
        bits = np.unpackbits(hashes[at : at + 255 * 256].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for low in range(0, len(bits), 255):
            counts += bits[low : low + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp`` per row; ``fp`` is the fingerprint as a signed 64-bit integer."""
    kind = df.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["key", "fp"])

    return narrow(df, key=key, text=text).mapInArrow(work, f"key {kind}, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, max_distance: int) -> DataFrame:
    """``a, b``: links whose components are those of all pairs within ``max_distance`` bits.
    ``fps``: distinct ``fp``."""
    if max_distance < 0 or max_distance % 2 or max_distance > 20:
        raise ValueError("max_distance must be even, and at most 20")
    blocks = max_distance + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    value = [
        F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1) if high - low < 64 else F.lit(-1))
        for low, high in zip(edges, edges[1:], strict=False)
    ]
    keyed = fps.select("fp", F.posexplode(F.array(*value)).alias("block", "value"))
    sizes = keyed.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = written(sizes.select("block", "value", (F.col("n") > HOT).alias("hot")), "block-sizes")
    shared = written(keyed.join(sizes, ["block", "value"]), "blocks")
    small = shared.filter("NOT hot").select("block", "value", F.col("fp").alias("a"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    pairs = small.join(
        small.select("block", "value", F.col("a").alias("b")), ["block", "value"]
    ).filter((F.col("a") < F.col("b")) & near)
    masks = [
        _signed(sum(1 << b for b in bits)) for r in range(max_distance // 2 + 1) for bits in combinations(range(64), r)
    ]
    hot = shared.filter("hot").select("fp").distinct()
    around = hot.select("fp", F.explode(F.array(*(F.lit(m) for m in masks))).alias("mask"))
    listed = around.groupBy(F.col("fp").bitwiseXOR(F.col("mask")).alias("middle")).agg(F.collect_set("fp").alias("fps"))
    stars = listed.filter(F.size("fps") > 1).select(
        F.array_min("fps").alias("a"), F.explode("fps").alias("b")
    ).filter("a <> b")
    return pairs.select("a", "b").union(stars)


def near_duplicates(
    df: DataFrame, shingle: int = 3, max_distance: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, fingerprint, component_id`` per row of ``df``; ``fingerprint`` as 16 hex digits."""
    found = written(fingerprints(df, shingle, key, text), "fingerprints")
    per_fp = written(found.groupBy("fp").agg(F.min("key").alias("least")), "distinct-fingerprints")
    roots = components(links(per_fp.select("fp"), max_distance))
    rooted = per_fp.join(roots, per_fp["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = written(rooted, "rooted")
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    named = written(rooted.join(least, "root").select("fp", "component_id"), "fingerprint-components")
    return found.join(named, "fp").select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_per_component(
    df: DataFrame, shingle: int = 3, max_distance: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of ``df`` per component, with all its columns: that of the smallest key, of equal
    keys the one with the smallest checksum of its text, of equal rows any one."""
    rows = df.select(
        F.struct(*(quoted(c) for c in df.columns)).alias("row"),
        F.struct(
            F.col(quoted(key)).isNull().alias("none"), F.col(quoted(key)).alias("id"),
            F.crc32(F.coalesce(quoted(text), F.lit(""))).alias("crc"),
        ).alias("key"),
        F.col(quoted(text)).alias("text"),
    )
    found = near_duplicates(rows, shingle, max_distance, "key", "text")
    first = found.filter(F.col("key").eqNullSafe(F.col("component_id"))).select("key").distinct()
    columns = [F.col("key.none"), F.hash("key.id").alias("hash"), F.col("key.crc"), F.col("key.id").alias("id")]
    names = ["none", "hash", "crc"]
    kept = rows.select(*columns, "row").join(first.select(*columns).withColumnRenamed("id", "other"), names)
    kept = kept.filter(F.col("id").eqNullSafe(F.col("other")))
    within = Window.partitionBy(*names).orderBy("id")
    before = F.lag("id").over(within)
    return kept.withColumn("again", (F.row_number().over(within) > 1) & before.eqNullSafe(F.col("id"))).filter(
        "NOT again"
    ).select("row.*")
