"""Best-two-fit packing of tokenised documents into sequences.

Only lengths decide a packing, and a length is at most the capacity. So the corpus is counted by
length (a table of at most ``capacity`` rows at any size of the corpus), the bins are built on
the counts, many equal bins in one step, and every piece is then placed by its rank among the
pieces of its length. Ranks are taken within salted parts of a length, so that a length which a
third of all pieces share is no task of its own.

Null texts count as empty, repeated rows are packed each for itself, an empty table gives an
empty table, and further columns stay outside: the result has the columns named below only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kessan.llm.byte_bpe import encoder
from kessan.llm.columns import narrow
from kessan.session import written

#: Pieces of a length that one part holds at most, on average, and the least number of parts.
PER_PART, PARTS = 100_000, 64


def cut_pieces(
    df: DataFrame, path: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, piece, start, length, ids``: each document's ids and the closing id, cut into pieces
    of ``capacity`` ids where it is longer; the first piece holds what is over."""
    kind = df.schema[key].dataType
    closing = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, encoded in encoder(path, None).steps(batch.column(1).to_pylist()):
                part = batch.slice(at, len(encoded))
                rows, pieces, starts, lengths, ids = [], [], [], [], []
                for row, data in enumerate(encoded):
                    data += closing
                    n, begin, piece = len(data) // 4, 0, 0
                    while begin < n:
                        end = begin + ((n - begin) % capacity or capacity)
                        rows.append(row)
                        pieces.append(piece)
                        starts.append(begin)
                        lengths.append(end - begin)
                        ids.append(data[4 * begin : 4 * end])
                        begin, piece = end, piece + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()),
                        pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()),
                    ],
                    ["key", "piece", "start", "length", "ids"],
                )
        encoder(path, None).forget()

    cut = narrow(df, key=key, text=text).mapInArrow(
        work, f"key {kind.simpleString()}, piece int, start long, length long, ids binary"
    )
    return cut.withColumnRenamed("key", key)


def _best(lengths: np.ndarray, counts: np.ndarray, gap: int, used: dict[int, int]) -> int:
    """Place of the longest length that fits ``gap`` and is still to be had, or -1."""
    place = int(np.searchsorted(lengths, gap, "right")) - 1
    while place >= 0 and counts[place] - used.get(place, 0) <= 0:
        place -= 1
    return place


def _better_pair(lengths: np.ndarray, counts: np.ndarray, gap: int, above: int, used: dict[int, int]):
    """Two lengths that fit ``gap`` and fill more of it than ``above``, the fullest such pair."""
    places = [p for p in range(int(np.searchsorted(lengths, gap, "right"))) if counts[p] > used.get(p, 0)]
    best, found, low, high = above, None, 0, len(places) - 1
    while low <= high:
        a, b = places[low], places[high]
        total = int(lengths[a] + lengths[b])
        if total > gap:
            high -= 1
            continue
        if total > best and (a != b or counts[a] - used.get(a, 0) >= 2):
            best, found = total, (a, b)
            if best == gap:
                break
        low += 1
    return found


def plan_bins(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """``(how many equal bins, {length: pieces of it in each})``; ``lengths`` ascending.

    A bin takes the longest piece left, then again and again the longest that fits. Then its
    smallest piece gives way to the two unpacked pieces that together fill the gap it leaves
    more tightly, as long as there are such two.
    """
    lengths, counts, bins = np.asarray(lengths, np.int64), np.array(counts, np.int64), []
    while counts.any():
        used: dict[int, int] = {}
        gap = capacity
        while (place := _best(lengths, counts, gap, used)) >= 0:
            used[place] = used.get(place, 0) + 1
            gap -= int(lengths[place])
        while gap and sum(used.values()) > 1:
            smallest = min(used)
            less = {p: n - (p == smallest) for p, n in used.items() if n > (p == smallest)}
            pair = _better_pair(lengths, counts, gap + int(lengths[smallest]), int(lengths[smallest]), less)
            if not pair:
                break
            for place in pair:
                less[place] = less.get(place, 0) + 1
            gap += int(lengths[smallest]) - int(lengths[pair[0]] + lengths[pair[1]])
            used = less
        times = min(int(counts[p]) // n for p, n in used.items())
        bins.append((times, {int(lengths[p]): n for p, n in sorted(used.items(), reverse=True)}))
        for p, n in used.items():
            counts[p] -= times * n
    return bins


def _slots(bins: list[tuple[int, dict[int, int]]]) -> dict[int, list[np.ndarray]]:
    """Per length the runs of ranks: first rank, first bin, pieces per bin, offset in the bin."""
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    first = 0
    for times, content in bins:
        offset = 0
        for length, n in content.items():
            slots.setdefault(length, []).append((ranks.get(length, 0), first, n, offset))
            ranks[length] = ranks.get(length, 0) + times * n
            offset += length * n
        first += times
    return {length: [np.array(x, np.int64) for x in zip(*rows, strict=True)] for length, rows in slots.items()}


def pack(pieces: DataFrame, capacity: int, order: tuple[str, ...], length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: sequences of at most ``capacity``, gapless.

    ``pieces`` must be a table that reads alike each time (a written one). ``order`` names the
    columns that number the pieces of a length; ties among them are numbered in any order.
    """
    counted = pieces.groupBy(F.col(length).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    # At most one row per length, however large the corpus.
    rows = sorted((r["length"], r["n"]) for r in counted.collect())
    if rows and rows[-1][0] > capacity:
        raise ValueError(f"a piece is longer than {capacity}")
    bins = plan_bins([r[0] for r in rows], [r[1] for r in rows], capacity)
    slots = _slots(bins)
    parts = max(PARTS, sum(r[1] for r in rows) // PER_PART)
    salted = pieces.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sizes = salted.groupBy(length, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(length).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(length, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(length, "_part").orderBy(*order)
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(sizes, [length, "_part"])
    ranked = ranked.select(*pieces.columns, (F.col("_rank") + F.col("_before")).alias("_rank"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence = np.zeros(len(batch), np.int64)
            offset = np.zeros(len(batch), np.int64)
            ranks, lengths = batch["_rank"].to_numpy(), batch[length].to_numpy()
            for value in np.unique(lengths):
                here = np.flatnonzero(lengths == value)
                first_rank, first_bin, per_bin, base = slots[int(value)]
                run = np.searchsorted(first_rank, ranks[here], "right") - 1
                place = ranks[here] - first_rank[run]
                sequence[here] = first_bin[run] + place // per_bin[run]
                offset[here] = base[run] + place % per_bin[run] * int(value)
            yield batch.drop(columns="_rank").assign(sequence_id=sequence, offset=offset)

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInPandas(work, schema)


def pack_documents(
    df: DataFrame, path: str, end_id: int = 2, capacity: int = 1024, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset`` of all documents."""
    cut = cut_pieces(df, path, end_id, capacity, key, text)
    table = written(cut.select(key, "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(table, capacity, (key, "piece", "start", "ids_crc32"))
