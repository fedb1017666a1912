from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import SF_DIR

from kessan.llm import importance_resampling, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, max_run):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, max_run + 1) for i in range(len(words) - n + 1)]


def plain_resample(docs, target, max_run, buckets=10_000, least=20):
    of = lambda f: zlib.crc32(f.encode()) % buckets
    raw, wanted, rows = Counter(), Counter(), []
    for key, text in docs:
        n, found = plain_features(text, max_run)
        found = [of(f) for f in found]
        raw.update(found)
        rows.append((key, n, found))
    for text in target:
        wanted.update(map(of, plain_features(text, max_run)[1]))
    s, t = sum(raw.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets))))
    out = []
    for key, n, found in rows:
        weight = sum(map(gain, found))
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: 10 * len(able) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in out), key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_against_plain_resampling(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = queries.op13_importance_resampling(spark, SF_DIR)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert found(got) == plain_resample(docs, target, 1)


@pytest.mark.parametrize("max_run", [1, 2, 4])
def test_odd_texts(spark, docs, monkeypatch, max_run):
    """Runs never cross documents; a dictionary too small for the words gives the same."""
    monkeypatch.setattr(importance_resampling, "WORDS", 40)
    dice = random.Random(7)
    words = ["É", "é", "ABC", "abc", "9", "wörter", " ", "x" * 100, "—", "\u0000", "a.b", "[z]", "`", "{", "日本", "\x7f"]
    texts = [" ".join(dice.choices(words, k=dice.randrange(60))) for _ in range(120)]
    texts += ["", None, " ", "...", "word", "w " * 50_000, "x" * 300_000, texts[0], texts[0]]
    rows = docs(texts).union(docs([(None, texts[0] * 3, None, None, None, None), (7, texts[1], None, None, None, None)]))
    want = plain_resample([(r["doc_id"], r["text"]) for r in rows.collect()], ["abc 9 é", None, ""], max_run)
    target = spark.createDataFrame([("abc 9 é",), (None,), ("",)], "text string")
    got = importance_resampling.resample(rows.repartition(3), target, max_run=max_run)
    assert found(got) == want
    assert importance_resampling.resample(docs([]), target).count() == 0
    nothing = importance_resampling.resample(rows, target.limit(0), max_run=max_run)
    assert found(nothing) == plain_resample([(r["doc_id"], r["text"]) for r in rows.collect()], [], max_run)


def test_composed_checksums():
    dice = random.Random(1)
    pairs = [(dice.randbytes(dice.randrange(1, 9)), dice.randbytes(dice.choice([1, 2, 7, 300, 70_000]))) for _ in range(200)]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    got = importance_resampling.composed(crc(a), crc(b), np.array([len(x) for x in b]))
    assert (got == crc([x + y for x, y in pairs])).all()


def test_the_automaton_knows_what_it_has_seen():
    words = [f"word{i}" for i in range(3000)]
    dictionary = importance_resampling.Dictionary()
    for _ in range(3):
        list(importance_resampling.features(dictionary, [" ".join(words)], 1, 100))
    assert dictionary.built == 3000 and dictionary.automaton.get(" word7 ") == dictionary.place["word7"]
