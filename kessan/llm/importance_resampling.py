"""Importance resampling towards a target distribution, features found by an Aho-Corasick dictionary.

A text is lower-cased (A-Z only), and what is not an ASCII letter or digit or a character beyond
ASCII is a delimiter. Features are runs of up to ``max_run`` words joined by one space; a feature's
bucket is the CRC-32 of its bytes modulo ``buckets``.

The dictionary holds distinct words between delimiters; a word's payload is its CRC-32 and length. One
pass of the automaton over a stretch of many texts gives the payload of every word it knows, by
the place where the word ends. The CRC-32 of a run is composed from the payloads of adjacent words: that of
``A B`` follows from those of ``A``, of ``" B"`` and the length of ``" B"``, by a fixed linear map per length.
So texts are not cut into strings, and no run is ever joined.

Each task grows its own dictionary: words it does not know are computed in place and added when the
automaton is next built, up to ``WORDS`` words of at most ``LONGEST`` bytes. The bound is on memory only:
words beyond it are computed in place, to the same result.

A bucket's gain compares how often it occurs in the target and in the raw texts, both smoothed, over
all rows. A document's weight is the sum of its features' gains; a Gumbel number from the hash of its
id is added, and the highest sums among documents of at least ``least_words`` words are drawn: a
sample without replacement in proportion to the weights. Ranks come from ``positions``, so no task
orders all documents.

Null and empty texts have no features and weight 0. Rows are handled one by one: repeated rows count and
are ranked each; ties go to the smaller id, null ids last (their hash is that of an empty id). Empty
tables count as nothing; an empty table of documents gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kessan.llm.columns import narrow
from kessan.llm.positions import positioned
from kessan.session import written

#: Words of a task's dictionary, bytes of its longest word, and bytes of text scanned at a time.
WORDS, LONGEST, STRETCH = 1 << 16, 64, 1 << 20

_SPACE = 0x20
_SHOWN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else _SPACE
    for b in range(256)
)


@cache
def _powers() -> np.ndarray:
    """``[bit, i]``: the CRC register holding bit ``i`` alone, after ``2 ** bit`` zero bytes."""
    one_zero_bit = np.array([0xEDB88320 if i == 0 else 1 << (i - 1) for i in range(32)], np.uint32)
    tables = [one_zero_bit]
    for _ in range(34):
        tables.append(_applied(tables[-1], tables[-1]))
    return np.stack(tables[3:])


def _applied(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros_like(values)
    for i in range(32):
        out ^= np.where(values >> np.uint32(i) & np.uint32(1), table[i], np.uint32(0))
    return out


def composed(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of concatenations from those of their two parts and the length of the second."""
    moved = first.copy()
    for bit in range(int(length.max(initial=0)).bit_length()):
        mine = np.flatnonzero(length >> bit & 1)
        moved[mine] = _applied(_powers()[bit], moved[mine])
    return moved ^ second


class Dictionary:
    """Payloads of words by an automaton that learns."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.crc, self.spaced, self.length = [], [], []
        self.automaton, self.built, self.payloads = None, 0, None

    def _build(self) -> None:
        from ahocorasick import Automaton

        self.automaton = Automaton()
        for word, place in self.place.items():
            self.automaton.add_word(f" {word} ", place)
        self.automaton.make_automaton()
        self.built = len(self.place)
        self.payloads = np.array(self.crc, np.uint32), np.array(self.spaced, np.uint32), np.array(self.length, np.int64)

    def scan(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """CRC-32 of each word, that with a space before it, and its length. ``data`` holds spaces before
        and after each word; words start and end at the given places."""
        n = len(starts)
        crc, spaced, length = np.empty(n, np.uint32), np.empty(n, np.uint32), ends - starts
        known = np.zeros(n, bool)
        if self.automaton:
            hits = [x for hit in self.automaton.iter(data.decode("latin-1")) for x in hit]
            hits = np.array(hits, np.int64).reshape(-1, 2)
            word = np.searchsorted(ends, hits[:, 0])
            crc[word], spaced[word] = self.payloads[0][hits[:, 1]], self.payloads[1][hits[:, 1]]
            known[word] = True
        for i in np.flatnonzero(~known):
            word = data[starts[i] : ends[i]]
            crc[i], spaced[i] = zlib.crc32(word), zlib.crc32(b" " + word)
            if len(self.place) < WORDS and len(word) <= LONGEST:
                shown = word.decode("latin-1")
                if shown not in self.place:
                    self.place[shown] = len(self.place)
                    self.crc.append(int(crc[i]))
                    self.spaced.append(int(spaced[i]))
                    self.length.append(len(word))
        if len(self.place) >= 2 * self.built + 1024 or (len(self.place) == WORDS > self.built):
            self._build()
        return crc, spaced, length


def features(dictionary: Dictionary, texts: list[str | None], max_run: int, buckets: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per stretch of texts: the number of its texts, the words of each, and text and bucket of every feature."""
    at = 0
    while at < len(texts):
        parts, size, first = [], 0, at
        while at < len(texts) and (size < STRETCH or at == first):
            parts.append((texts[at] or "").encode("utf-8").translate(_SHOWN))
            size += len(parts[-1]) + 1
            at += 1
        data = b" " + b" ".join(parts) + b" "
        shown = np.frombuffer(data, np.uint8) != _SPACE
        edges = np.flatnonzero(shown[1:] != shown[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        crc, spaced, length = dictionary.scan(data, starts, ends)
        bounds = np.cumsum([len(p) + 1 for p in parts]) + 1
        text = np.searchsorted(bounds, starts, side="right")
        texts_of, found = [text], [crc]
        run = crc
        for n in range(1, max_run):
            run = composed(run[:-1], spaced[n:], length[n:] + 1) if len(run) > 1 else run[:0]
            whole = text[n:] == text[: len(text) - n] if len(text) > n else np.zeros(0, bool)
            texts_of.append(text[n:][whole])
            found.append(run[whole])
        yield len(parts), np.bincount(text, minlength=len(parts)), np.concatenate(texts_of), np.concatenate(found) % buckets


def bucket_counts(df: DataFrame, text: str, max_run: int, buckets: int) -> DataFrame:
    """``bucket, n`` over all rows of ``df``; each task sends at most one row per bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, counts = Dictionary(), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, found in features(dictionary, batch.column(0).to_pylist(), max_run, buckets):
                counts += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen])], ["bucket", "n"])

    return narrow(df, text=text).mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of every bucket: ``buckets`` numbers. Both tables: ``bucket, n``."""
    counts = np.zeros((2, buckets))
    for i, table in enumerate((raw, target)):
        for row in table.toLocalIterator():
            counts[i, row["bucket"]] = row["n"]
    s, t = counts
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighed(df: DataFrame, gain: np.ndarray, key: str, text: str, max_run: int) -> DataFrame:
    """``key, n_words, n_features, weight`` per row."""
    named = narrow(df, key=key, text=text)
    shared = df.sparkSession.sparkContext.broadcast(gain)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, gain = Dictionary(), shared.value
        for batch in batches:
            done = 0
            for n, words, texts_of, found in features(dictionary, batch.column(1).to_pylist(), max_run, len(gain)):
                weight = np.zeros(n, np.int64)
                np.add.at(weight, texts_of, gain[found])
                columns = [words, np.bincount(texts_of, minlength=n), weight]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, n), *(pa.array(c, pa.int64()) for c in columns)],
                    ["key", "n_words", "n_features", "weight"],
                )
                done += n

    kind = named.schema["key"].dataType.simpleString()
    return named.mapInArrow(work, f"key {kind}, n_words long, n_features long, weight long")


def perturbed(weight: Column, key: Column, seed: int) -> Column:
    """``weight`` plus a Gumbel number in thousandths, from the hash of ``seed:key``."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double")
    return weight + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    df: DataFrame, target: DataFrame, share: tuple[int, int] = (10, 100), least_words: int = 20, max_run: int = 2,
    buckets: int = 10_000, seed: int = 2024, key: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """``key, n_features, weight, score, rank`` per row of ``df``; ``rank`` (from 1) for the drawn
    ``share`` (as a fraction) of the rows with at least ``least_words`` words."""
    gain = gains(bucket_counts(df, text, max_run, buckets), bucket_counts(target, target_text, max_run, buckets), buckets)
    scored = weighed(df, gain, key, text, max_run).withColumn("score", perturbed(F.col("weight"), F.col("key"), seed))
    scored = written(scored, "scored")
    able = scored.filter(F.col("n_words") >= least_words)
    quota = share[0] * able.count() // share[1]
    numbered = positioned(able, F.col("score").desc(), F.col("key").asc_nulls_last(), name="drawn")
    rank = F.when(F.col("position") < quota, F.col("position") + 1).alias("rank")
    out = ("key", "n_features", "weight", "score")
    drawn = numbered.select(*out, rank).union(
        scored.filter(F.col("n_words") < least_words).select(*out, F.lit(None).cast("long"))
    )
    return drawn.withColumnRenamed("key", key)
