"""Substring deduplication by relative Lempel-Ziv parsing against an index of the whole corpus.

*Reference blocks.* The corpus is its own reference. It is written once in blocks, one per
partition, and every word gets a place: the block's number and a position in it. The blocks are
indexed by *phrases*: a phrase is the stretch of words whose ``window``-word windows share one
smallest ``GRAM``-word hash (its anchor), so equal windows always lie in phrases of one anchor,
wherever they stand. The index holds each distinct phrase with its first and its last place in all blocks, two
places for any number of copies. A phrase that a document holds many times (a few words over and
over make one of every window) is one row with all its places there.

*Factors.* A document is parsed from left to right. At the first window not yet in a factor that
occurs elsewhere, the source is taken whose match reaches farthest: from phrase to phrase while
the same source goes on, whatever block it lies in, never at the document's own place. The factor
is its first word, its length, and the source's block and position. Only matches of at least
``window`` words make factors; words between them are literals.

*Borders.* Where a match ends, a phrase has a known anchor but occurs nowhere else as a whole:
there, and only there, the windows themselves are looked up with their places, so a factor is
not cut short at a phrase's border. A window across the border of two factors, found with another
source, starts a factor of its own, which overlaps the one before.

All steps are counts and extremes with map-side combining and joins on counted keys; no group is
gathered and no pairs are formed, so a passage that a third of all documents share costs one row
per document and phrase. Of a phrase's copies only the first and the last serve as sources; that
can make a factor shorter than a copy between them would, but leaves no repeated window outside
of factors.

Result: every word inside a window that also starts anywhere else (in the same document, too) is
in a factor and goes, the first copy like the others. Windows are compared by 128 bits of hash
(anchor and window). Null texts have no words; texts shorter than a window lose none; equal rows
count as separate documents; an empty table gives an empty one; other columns pass through
untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kessan.llm.columns import quoted
from kessan.llm.word_hashes import gram_hashes, gram_sums, sliding_minimum, word_hashes
from kessan.session import written

#: Words of an anchor; bytes of text handled at a time (a longer text alone).
GRAM, STEP_BYTES = 8, 1 << 20

#: Low bits of a place, which hold the position in its block.
BLOCK_BITS = 40


def _steps(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``STEP_BYTES``, with the number of the first."""
    first, run, size = 0, [], 0
    for text in texts:
        run.append((text or "").encode("utf-8"))
        size += len(run[-1])
        if size >= STEP_BYTES:
            yield first, run
            first, run, size = first + len(run), [], 0
    if run:
        yield first, run


def _beside_itself(grams: np.ndarray, lowest: np.ndarray, width: int, window: int) -> np.ndarray:
    """Windows around an anchor that stands twice within a window's length: words that repeat at
    so short a distance can make two windows of one phrase equal, so each is a phrase alone."""
    around = np.concatenate([np.zeros(width - 1, np.uint64), lowest, np.zeros(width - 1, np.uint64)])
    anchors = np.flatnonzero(grams == ~sliding_minimum(~around, width))
    twice = (grams[anchors[1:]] == grams[anchors[:-1]]) & (np.diff(anchors) <= window)
    change = np.zeros(len(lowest) + 1, np.int64)
    np.add.at(change, np.maximum(anchors[:-1][twice] - width + 1, 0), 1)
    np.add.at(change, np.minimum(anchors[1:][twice] + 1, len(lowest)), -1)
    return np.cumsum(change)[:-1] > 0


def phrases_of(texts: list[bytes], window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Per phrase: text number, first window, number of windows, anchor, hash of all its words."""
    hashes, begin = word_hashes(texts)
    n = len(hashes)
    if n < window:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    sums = gram_sums(hashes)
    at = np.arange(n - gram + 1)
    grams = gram_hashes(sums, at, at + gram)
    lowest = sliding_minimum(grams, window - gram + 1)
    alone = _beside_itself(grams, lowest, window - gram + 1, window)
    text = np.searchsorted(begin, np.arange(n - window + 1), "right") - 1
    starts = np.flatnonzero(np.arange(n - window + 1) + window <= begin[text + 1])
    text, lowest, alone = text[starts], lowest[starts], alone[starts]
    if not len(starts):
        return phrases_of([], window, gram)
    new = np.ones(len(starts), bool)
    new[1:] = (lowest[1:] != lowest[:-1]) | (text[1:] != text[:-1])
    # A run of one anchor without end (one word over and over) is cut into equal parts.
    run = np.maximum.accumulate(np.where(new, np.arange(len(starts)), 0))
    new |= (np.arange(len(starts)) - run) % window == 0
    new[1:] |= alone[1:] | alone[:-1]
    first = np.flatnonzero(new)
    count = np.diff(first, append=len(starts))
    place = starts[first]
    whole = gram_hashes(sums, place, place + count + window - 1)
    return text[first], place - begin[text[first]], count, lowest[first], whole


def once_a_text(text: np.ndarray, anchor: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows in order, the first of each phrase in its text; how often it comes again there; and
    the rows where it does, one kept row's after the other's."""
    n = len(whole)
    order = np.argsort(whole, kind="stable")
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([x[order[1:]] != x[order[:-1]] for x in (whole, anchor, text)])
    leader = np.empty(n, np.int64)
    leader[order] = order[np.maximum.accumulate(np.where(new, np.arange(n), 0))]
    kept, rest = np.flatnonzero(leader == np.arange(n)), np.flatnonzero(leader != np.arange(n))
    again = np.bincount(leader[rest], minlength=n)[kept]
    return kept, again, rest[np.argsort(leader[rest], kind="stable")]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _lists(sizes: np.ndarray, values: np.ndarray) -> pa.Array:
    """Lists of the given sizes; null for an empty one."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)), mask=pa.array(sizes == 0))


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` (``text`` among its columns) as reference blocks: with ``doc``, the place of each
    document's first word. A document of n bytes takes n / 2 + 1 places, at least one a word."""
    names, at = docs.columns, docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64) // 2 + 1
            ends = used + np.cumsum(sizes)
            start = pc.add(pc.shift_left(batch.column(-1), BLOCK_BITS), pa.array(ends - sizes))
            used = int(ends[-1]) if len(ends) else used
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], start], [*names, "doc"])

    numbered = docs.withColumn("doc", F.spark_partition_id().cast("long"))
    return numbered.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField("doc", T.LongType())]))


def phrases(blocks: DataFrame, window: int, gram: int) -> DataFrame:
    """``doc, first, count, anchor, whole, again`` of every phrase of a document; ``again`` has the
    first windows of its other places there, null if it has none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _steps(batch.column(1).to_pylist()):
                text, first, count, anchor, whole = phrases_of(texts, window, gram)
                kept, again, rest = once_a_text(text, anchor, whole)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(text[kept] + start)), pa.array(first[kept].astype(np.int32)),
                        pa.array(count[kept].astype(np.int32)), _signed(anchor[kept]), _signed(whole[kept]),
                        _lists(again, first[rest]),
                    ],
                    ["doc", "first", "count", "anchor", "whole", "again"],
                )

    texts = blocks.select("doc", "text").filter(F.col("text").isNotNull())
    return texts.mapInArrow(work, "doc long, first int, count int, anchor long, whole long, again array<int>")


def _windows(df: DataFrame, window: int) -> DataFrame:
    """``doc, first, anchor, hash, weight, high`` of each window of the phrases listed in ``todo``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            todo = batch.column(2)
            for start, texts in _steps(batch.column(1).to_pylist()):
                hashes, begin = word_hashes(texts)
                sums = gram_sums(hashes)
                part = todo.slice(start, len(texts))
                of = np.repeat(np.arange(len(texts)), np.diff(part.offsets.to_numpy()))
                listed = part.flatten()
                field = lambda i, x=listed: x.field(i).to_numpy()
                count = field(1).astype(np.int64)
                row = np.repeat(np.arange(len(of)), count)
                inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                first = field(0).astype(np.int64)[row] + inside
                place = begin[of[row]] + first
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(of[row] + start)), pa.array(first.astype(np.int32)),
                        pa.array(field(2)[row]), _signed(gram_hashes(sums, place, place + window)),
                        pa.array(field(3)[row]), pa.array(field(4)[row] + inside),
                    ],
                    ["doc", "first", "anchor", "hash", "weight", "high"],
                )

    return df.mapInArrow(work, "doc long, first int, anchor long, hash long, weight long, high long")


def _by_document(rows: DataFrame, *fields: str) -> DataFrame:
    """The rows of each document as one list; a document bounds its length."""
    return rows.groupBy("doc").agg(F.collect_list(F.struct(*fields)).alias("todo"))


def matches(blocks: DataFrame, window: int, gram: int = GRAM) -> DataFrame:
    """``doc, first, count, low, high, again``: runs of windows of a document that also start elsewhere,
    the first and the last place in all blocks where the run stands, and the first windows of its
    other places in the document (null if none)."""
    place = F.col("doc") + F.col("first")
    times = F.sum(F.coalesce(F.array_size("again"), F.lit(0)) + 1)
    ends = F.min(place).alias("low"), F.max(F.col("doc") + F.greatest("first", F.array_max("again"))).alias("high")
    found = phrases(blocks, window, gram)
    anchors = found.groupBy("anchor").agg(
        times.alias("n"), F.min("whole").alias("least"), F.max("whole").alias("most"), *ends
    )
    # An anchor that occurs once starts no factor. Written, so that the join can split hot anchors.
    known = written(
        anchors.filter("n > 1").select("anchor", (F.col("least") == F.col("most")).alias("alike"), "low", "high"),
        "anchors",
    )
    phrase = written(found.join(known, "anchor"), "phrases")
    several = phrase.filter("NOT alike").select("doc", "first", "count", "anchor", "whole", "again")
    index = written(several.groupBy("anchor", "whole").agg(times.alias("weight"), *ends), "phrase-index")
    looked_up = written(several.join(index, ["anchor", "whole"]).drop("whole"), "phrases-looked-up")
    run = "doc", "first", "count", "low", "high", "again"
    full = phrase.filter("alike").select(*run).unionByName(looked_up.filter("weight > 1").select(*run))
    # Borders: each distinct phrase shows its windows once, at its first place, with the weight of its copies.
    todo = _by_document(looked_up.filter(place == F.col("low")), "first", "count", "anchor", "weight", "high")
    shown = blocks.select("doc", "text").join(todo, "doc")
    window_rows = written(_windows(shown, window), "windows")
    repeated = written(
        window_rows.groupBy("anchor", "hash").agg(
            F.sum("weight").alias("n"), F.min(place).alias("low"), F.max("high").alias("high")
        ).filter("n > 1").drop("n"),
        "repeated-windows",
    )
    edges = window_rows.filter("weight = 1").drop("high").join(repeated, ["anchor", "hash"])
    alone = {"count": F.lit(1), "again": F.lit(None).cast("array<int>")}
    return full.unionByName(edges.withColumns(alone).select(*run))


def parse(runs: list[tuple[int, int, int, int]], doc: int, window: int) -> list[tuple[int, int, int]]:
    """Greedy factors ``(first word, words, place of the source)`` of the document at place ``doc``
    from its ``(first, count, low, high)``. Of sources that reach equally far, the nearest."""
    runs, choices = sorted(runs), []
    reach: dict[int, int] = {}
    after = None
    for first, count, low, high in reversed(runs):
        end, here = first + count, {}
        for away in (low - first - doc, high - first - doc):
            if away:
                here[away] = reach.get(away, end) if after == end else end
        choices.append(max((to, -abs(away), away) for away, to in here.items()))
        reach, after = here, first
    factors, done = [], 0
    for (first, *_), (to, _, away) in zip(runs, reversed(choices), strict=True):
        if first >= done:
            factors.append((first, to - first + window - 1, doc + first + away))
            done = to
    return factors


def covered_spans(factors: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Merged word spans ``[start, end)`` of factors in order."""
    spans: list[tuple[int, int]] = []
    for first, length, _ in factors:
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], first + length))
        else:
            spans.append((first, first + length))
    return spans


def _columns(place: int) -> dict[str, int]:
    return {"block": place >> BLOCK_BITS, "position": place & ((1 << BLOCK_BITS) - 1)}


def remove_repeats(
    df: DataFrame, window: int = 35, key: str = "doc_id", text: str = "text", rest: tuple[str, ...] = ()
) -> DataFrame:
    """``key, n_words, n_removed, kept, spans, factors, block, position, rest`` per row of ``df``: the
    words that stay, joined by one space; the word spans that went; the factors (first word,
    words, block and position of the source); the document's own block and position; and the
    columns named in ``rest`` as a struct (absent if none are named)."""
    named = {"rest": F.struct(*(F.col(quoted(c)) for c in rest))} if rest else {}
    docs = df.select(
        F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"), *(c.alias(name) for name, c in named.items())
    )
    blocks = written(placed(docs), "reference-blocks")
    lists = _by_document(matches(blocks, window), "first", "count", "low", "high", "again")
    span = T.StructType([T.StructField(name, T.IntegerType()) for name in ("start", "end")])
    place = [T.StructField(name, T.LongType()) for name in ("block", "position")]
    factor = T.StructType([T.StructField(name, T.IntegerType()) for name in ("start", "length")] + place)
    schema = T.StructType([
        T.StructField("key", docs.schema["key"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
        T.StructField("spans", T.ArrayType(span)), T.StructField("factors", T.ArrayType(factor)), *place,
        *(T.StructField(name, docs.schema[name].dataType) for name in named),
    ])
    spans_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    factors_kind = pa.list_(pa.struct(
        [("start", pa.int32()), ("length", pa.int32()), ("block", pa.int64()), ("position", pa.int64())]
    ))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, gone, kept, spans, factors, own = [], [], [], [], [], []
                for text_, doc, runs in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3), strict=True):
                    words = (text_ or "").encode("utf-8").split()
                    parsed = []
                    if runs.is_valid:
                        fields = [runs.values.field(i).to_pylist() for i in range(5)]
                        every = [(at_, *x) for first, *x, again in zip(*fields, strict=True) for at_ in (first, *(again or ()))]
                        parsed = parse(every, doc, window)
                    found = covered_spans(parsed)
                    stay, last = [], 0
                    for start, end in found:
                        stay += words[last:start]
                        last = end
                    stay += words[last:]
                    sizes.append(len(words))
                    gone.append(len(words) - len(stay))
                    kept.append(b" ".join(stay).decode("utf-8"))
                    spans.append([{"start": a, "end": b} for a, b in found])
                    factors.append([{"start": a, "length": n, **_columns(source)} for a, n, source in parsed])
                    own.append(_columns(doc))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(kept, pa.string()), pa.array(spans, spans_kind), pa.array(factors, factors_kind),
                     *(pa.array([o[name] for o in own], pa.int64()) for name in ("block", "position")), *part.columns[4:]],
                    schema.fieldNames(),
                )

    joined = blocks.join(lists, "doc", "left").select("key", "text", "doc", "todo", *named)
    out = joined.mapInArrow(work, schema)
    return out.select(F.col("key").alias(key), *(quoted(c) for c in out.columns[1:]))
