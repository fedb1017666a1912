"""Quality by ordinal cumulative-link regression on graded ratings.

A rating is a grade 0, 1, .. in order. The model has one weight per hashed text feature, shared
by all grades, and one threshold between neighbouring grades, in order:
``P(grade <= j) = sigmoid(threshold[j] - weights . features)``. A document gets its expected
grade and the probability of a chosen grade or better, which selects it.

Features are the distinct words of the whole text (lower case, ASCII punctuation cut off), their
beginnings, and the classes of a few proportions of it (capitals, marks, repeated words and
lines). The fit uses those that enough sampled documents have and whose grades differ from the
others' by more than chance.

The fit reads at most ``sample_rows`` rated documents, those with the smallest hashes of their
ids, so its cost does not grow with the corpus. Their features are computed on the executors and
written; each round every part of the sample improves the shared model by itself, and each weight
takes the mean of the changes the parts ask for, which needs one vector per part on the driver. All documents are scored.

Ratings without a grade or id are not used; of several ratings of one id the lowest counts.
Without ratings, or with one grade only, every document is kept. Null texts are scored as
empty ones. An empty table gives an empty one; repeated rows are scored alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kessan.llm.columns import mapped, narrow
from kessan.session import written

_BREAKS = bytes(
    32 if b < 128 and not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122) else b + 32 if 65 <= b <= 90 else b
    for b in range(256)
)
_CAPITALS = bytes(range(65, 91))
_MARKS = b"!\"#$%&()*+/:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Settings:
    #: log2 of the number of weights.
    bits: int = 18
    #: Most rated documents that the fit reads.
    sample_rows: int = 16_384
    parts: int = 8
    rounds: int = 10
    epochs: int = 3
    rate: float = 0.2
    #: Shrinking of weights towards zero, per step.
    shrink: float = 1e-2
    #: Sampled documents that must have a feature, and by how many standard errors the mean
    #: grade of those must differ from that of all.
    least_documents: int = 5
    least_errors: float = 2.5
    seed: int = 11


def _class(share: float) -> int:
    """0 for none, then one class for every doubling from 1/256 up."""
    return 0 if share <= 0 else max(1, 9 + math.floor(math.log2(min(share, 1.0))))


def features(text: str | None, bits: int) -> list[int]:
    """Distinct hashed features of a whole text."""
    data = (text or "").encode("utf-8")
    mask, raw = (1 << bits) - 1, data.split()
    words = set(data.translate(_BREAKS).split())
    found = {crc32(word) & mask for word in words}
    found.update([crc32(b"\1" + begin) & mask for begin in {word[:4] for word in words if len(word) > 4}])
    if raw:
        size, lines = len(data), data.split(b"\n")
        capitals = size - len(data.translate(None, _CAPITALS))
        marks = size - len(data.translate(None, _MARKS))
        same = sum(a == b for a, b in zip(raw, raw[1:], strict=False))
        for name, share in (
            ("capitals", capitals / size), ("marks", marks / size), ("same", same / len(raw)),
            ("known", 1 - len(set(raw)) / len(raw)), ("lines", 1 - len(set(lines)) / len(lines)),
        ):
            found.add(crc32(f"\0{name}{_class(share)}".encode()) & mask)
        found.add(crc32(f"\0words{len(raw).bit_length()}".encode()) & mask)
    found.add(crc32(b"\0all") & mask)
    return sorted(found)


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def cumulative(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Per score the probabilities of grade <= 0, <= 1, .. below the highest."""
    return 1 / (1 + np.exp(-np.clip(thresholds[None, :] - score[:, None], -60, 60)))


def improve(
    weights: np.ndarray, thresholds: np.ndarray, rows: list[np.ndarray], grades: np.ndarray, s: Settings, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """A few epochs of adaptive gradient steps on the likelihood of the grades."""
    weights, thresholds = weights.copy(), thresholds.copy()
    squares, levels = np.full(len(weights), 1.0), np.full(len(thresholds), 1.0)
    dice = np.random.default_rng(seed)
    for _ in range(s.epochs):
        for i in dice.permutation(len(rows)):
            at, grade = rows[i], grades[i]
            score = float(weights[at].sum())
            above = sigmoid(thresholds[grade] - score) if grade < len(thresholds) else 1.0
            below = sigmoid(thresholds[grade - 1] - score) if grade else 0.0
            slope = above + below - 1  # of the log likelihood, by the score
            squares[at] += slope * slope
            step = s.rate / np.sqrt(squares[at])
            moved = weights[at] + step * slope
            weights[at] = np.sign(moved) * np.maximum(np.abs(moved) - step * s.shrink, 0)
            span = max(above - below, 1e-9)
            for j, p, sign in ((grade, above, 1), (grade - 1, below, -1)):
                if 0 <= j < len(thresholds):
                    g = sign * p * (1 - p) / span
                    levels[j] += g * g
                    thresholds[j] += s.rate * g / math.sqrt(levels[j])
            np.maximum.accumulate(thresholds, out=thresholds)
    return weights, thresholds


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    bits: int

    def rated(self, texts: pa.Array, least_grade: int) -> tuple[np.ndarray, np.ndarray]:
        """Expected grades, and probabilities of ``least_grade`` or better."""
        scores = np.array([self.weights[features(t.as_py(), self.bits)].sum() for t in texts], float)
        below = cumulative(scores, self.thresholds)
        place = min(least_grade, len(self.thresholds)) - 1
        return (1 - below).sum(axis=1), np.ones(len(scores)) if place < 0 else 1 - below[:, place]


def _sample(docs: DataFrame, ratings: DataFrame, s: Settings) -> DataFrame:
    """``part, features, grade`` of the sampled rated documents. ``ratings``: ``key, grade``."""
    rated = ratings.filter("key IS NOT NULL AND grade IS NOT NULL").groupBy("key").agg(F.min("grade").alias("grade"))
    order = F.xxhash64("key", F.lit(s.seed))
    chosen = written(
        rated.withColumn("place", order).orderBy("place", "key").limit(s.sample_rows).select("key", "grade"), "ratings"
    )
    # At most ``sample_rows`` pairs of an id and a grade.
    joined = docs.join(F.broadcast(chosen), "key").select("key", "text", "grade")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([features(t.as_py(), s.bits) for t in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), found, batch.column(2)], ["key", "features", "grade"])

    kind = docs.schema["key"].dataType.simpleString()
    rows = joined.mapInArrow(work, f"key {kind}, features array<int>, grade int")
    return rows.withColumn("part", F.pmod(F.xxhash64("key", F.lit(s.seed + 1)), F.lit(s.parts)).cast("int"))


def _telling(sample: DataFrame, counts: dict[int, int], s: Settings) -> np.ndarray:
    """Which features the fit uses. At most one row per weight comes to the driver."""
    total = sum(counts.values())
    mean = sum(g * n for g, n in counts.items()) / total
    spread = math.sqrt(sum(n * (g - mean) ** 2 for g, n in counts.items()) / total)
    seen = sample.select(F.explode("features").alias("at"), "grade").groupBy("at").agg(
        F.count(F.lit(1)).alias("n"), F.sum("grade").alias("grades")
    )
    errors = F.abs(F.col("grades") - F.col("n") * mean) / (F.sqrt("n") * spread)
    used = np.zeros(1 << s.bits, bool)
    chosen = seen.filter((F.col("n") >= s.least_documents) & (errors >= s.least_errors)).select("at")
    used[[r["at"] for r in chosen.collect()]] = True
    return used


def _trainer(weights: np.ndarray, thresholds: np.ndarray, used: np.ndarray, s: Settings, seed: int):
    """From one part of the sample to the change of the model that it asks for."""

    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key", kind="stable")
        rows = [x[used[x]] for x in part["features"].map(lambda x: np.asarray(x, np.int64))]
        new, levels = improve(weights, thresholds, rows, part["grade"].to_numpy(), s, seed)
        at = np.flatnonzero(new != weights)
        return pd.DataFrame({
            "n": [len(rows)], "at": [at.astype("<i4").tobytes()],
            "delta": [(new - weights)[at].astype("<f4").tobytes()], "thresholds": [levels.tolist()],
        })

    return one


def fit(docs: DataFrame, ratings: DataFrame, settings: Settings | None = None) -> Model | None:
    """The model, or None where the ratings hold fewer than two grades."""
    s = settings or Settings()
    sample = written(_sample(docs, ratings, s), "quality-sample")
    counts = {r["grade"]: r["n"] for r in sample.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    highest, total = max(counts), sum(counts.values())
    share = np.cumsum([counts.get(j, 0) for j in range(highest)]) / total
    share = np.clip(share, 0.5 / total, 1 - 0.5 / total)
    weights, thresholds = np.zeros(1 << s.bits), np.log(share / (1 - share))
    used = _telling(sample, counts, s)
    for round_ in range(s.rounds):
        one = _trainer(weights, thresholds, used, s, s.seed + round_)
        found = sample.groupBy("part").applyInPandas(one, "n long, at binary, delta binary, thresholds array<double>")
        # One changed model per part: bounded by the parts and the weights.
        models = sorted(found.collect(), key=lambda m: (m["n"], bytes(m["at"])))
        moved, asked = np.zeros_like(weights), np.zeros(len(weights), np.int64)
        for m in models:
            at = np.frombuffer(m["at"], "<i4")
            moved[at] += np.frombuffer(m["delta"], "<f4")
            asked[at] += 1
        weights = weights + moved / np.maximum(asked, 1)
        size = np.array([m["n"] for m in models], float)
        thresholds = size @ np.array([m["thresholds"] for m in models]) / size.sum()
    return Model(weights, np.maximum.accumulate(thresholds), s.bits)


def score(
    df: DataFrame, model: Model | None, least_grade: int, probability: float = 0.5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, expected_grade, tail_probability, kept``: kept where the probability of
    ``least_grade`` or better is at least ``probability``. Without a model all are kept."""
    docs = narrow(df, key=key, text=text)
    kind = docs.schema["key"].dataType.simpleString()
    if model is None:
        return docs.select(
            F.col("key").alias(key), F.lit(None).cast("double").alias("expected_grade"),
            F.lit(None).cast("double").alias("tail_probability"), F.lit(True).alias("kept"),
        )
    shared = df.sparkSession.sparkContext.broadcast(model)  # as many weights as Settings.bits says

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            expected, tail = shared.value.rated(batch.column(1), least_grade)
            columns = [batch.column(0), pa.array(expected), pa.array(tail), pa.array(tail >= probability)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "expected_grade", "tail_probability", "kept"])

    out = docs.mapInArrow(work, f"key {kind}, expected_grade double, tail_probability double, kept boolean")
    return out.withColumnRenamed("key", key)


def select(
    df: DataFrame, model: Model | None, least_grade: int, probability: float = 0.5, text: str = "text"
) -> DataFrame:
    """The rows of ``df`` that ``score`` keeps, with all their columns."""
    if model is None:
        return df
    shared, place = df.sparkSession.sparkContext.broadcast(model), df.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.rated(batch.column(place), least_grade)[1] >= probability))

    return mapped(df, work, df.schema)


def graded(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, grade`` of labels: 0 poor, 1 well made but toxic, 2 well made and not toxic."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) > 0
    return labels.select(
        F.col(key).alias("key"),
        F.when(F.col("quality") <= 0, 0).when(F.col("quality").isNotNull(), F.when(toxic, 1).otherwise(2))
        .cast("int").alias("grade"),
    )


def rate_documents(
    df: DataFrame, labels: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Fit on the rated ones, score all: those of grade 2 are kept."""
    return score(df, fit(narrow(df, key=key, text=text), graded(labels, key), settings), 2, key=key, text=text)
