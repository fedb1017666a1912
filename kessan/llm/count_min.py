"""A count-min sketch of 128-bit digests with counters of 0, 1 and "2 or more".

The estimate is never below the count, so an estimate of one proves that a digest occurs once.
Tasks sketch their own rows and send the touched segments of the counters, compressed; the
segments are summed as a stream. The sketch grows with the number of digests up to
``MOST_BITS``, which bounds what is broadcast (24 MB); beyond that it proves less, but nothing wrong.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows of counters, the binary logarithm of the longest row, and that of a segment.
DEPTH, MOST_BITS, SEGMENT_BITS = 3, 25, 18


def bits_for(rows: int) -> int:
    """The binary logarithm of a row's counters: at least four counters per digest, up to the bound."""
    return min(MOST_BITS, max(SEGMENT_BITS, (4 * rows).bit_length()))


def _cells(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """The counters of each digest, one column per row of the sketch."""
    a, b = first.view(np.uint64)[:, None], second.view(np.uint64)[:, None] | np.uint64(1)
    turn = np.arange(DEPTH, dtype=np.uint64)
    column = (a + turn * b) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)
    return (column + (turn << np.uint64(bits))).astype(np.int64)


def _packed(counts: np.ndarray) -> bytes:
    quads = counts.reshape(-1, 4)
    return (quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    packed = np.frombuffer(data, np.uint8)
    return np.stack([packed >> s & 3 for s in (0, 2, 4, 6)], axis=1).reshape(-1)


def sketch(digests: DataFrame, bits: int) -> bytes:
    """The sketch of ``digests`` (two long columns)."""
    size = 1 << SEGMENT_BITS

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(DEPTH << bits, np.uint8)
        for batch in batches:
            cells = _cells(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits).reshape(-1)
            touched, n = np.unique(cells, return_counts=True)
            counts[touched] = np.minimum(counts[touched] + np.minimum(n, 2), 2)
        segments = counts.reshape(-1, size)
        for i in np.flatnonzero(segments.any(axis=1)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([zlib.compress(_packed(segments[i]), 1)])], ["segment", "counts"]
            )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, None
        done = lambda: pa.RecordBatch.from_arrays(
            [pa.array([current], pa.int32()), pa.array([zlib.compress(_packed(total), 1)])], ["segment", "counts"]
        )
        for batch in batches:
            for i, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = _unpacked(zlib.decompress(data))
                if i != current:
                    if current is not None:
                        yield done()
                    current, total = i, counts
                else:
                    total = np.minimum(total + counts, 2)
        if current is not None:
            yield done()

    kind = "segment int, counts binary"
    parts = digests.mapInArrow(local, kind).repartition("segment").sortWithinPartitions("segment")
    whole = np.zeros((DEPTH << bits) // 4, np.uint8).reshape(-1, size // 4)
    for row in parts.mapInArrow(summed, kind).toLocalIterator():
        whole[row["segment"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint8)
    return whole.tobytes()


def estimates(data: bytes, bits: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The estimate (0 to 2) of each digest."""
    packed, cells = np.frombuffer(data, np.uint8), _cells(first, second, bits)
    return (packed[cells >> 2] >> (cells & 3) * 2 & 3).min(axis=1)
