from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import SF_DIR

from kessan.llm import count_min, prefix_trie, queries

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain_trie(rows):
    """The nodes as tuples of turns, level by level. ``rows``: conversation, turn, role, text."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = tuple(own.get(donor, [])[:h]) + tuple(own[c][h:])
    members, kids = defaultdict(list), defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    for n in members:
        if n:
            kids[n[:-1]].append(n)
    out, leaves, saved = [], {}, {}
    for n in sorted(members, key=len, reverse=True):
        m = members[n]
        leaves[n] = sum(leaves[k] for k in kids[n]) or 1
        saved[n] = (len(m) - 1) * (len(n[-1][1].encode()) if n else 0) + sum(saved[k] for k in kids[n])
        ends = ",".join(str(c) for c in m if len(rebuilt[c]) == len(n))
        parent = members[n[:-1]][0] if n else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((m[0], len(n), parent, len(m), len(kids[n]), leaves[n], saved[n], digest))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def make(spark, rows):
    own = "conv_id long, turn long, role string, text string, depth string, position long, `a.b` string"
    return spark.createDataFrame([(*r, "x", 7, "y") for r in rows], own)


def test_query_against_plain_trie(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op12_prefix_trie(spark, SF_DIR)) == plain_trie(rows)


def few_texts(seed, convs=120):
    """Conversations of few distinct texts, so that much is shared at every depth; negative ids too."""
    dice = random.Random(seed)
    rows = []
    for c in dice.sample(range(-60, 400), convs):
        for t in range(dice.randrange(1, 14)):
            text = dice.choice(["", "a", "b", "é" * 3]) if t < 10 else f"{c} {t}"
            rows.append((c, t, "user", text))
    return rows


@pytest.mark.parametrize("chunk", [1024, 3])
def test_shared_prefixes(spark, monkeypatch, chunk):
    """Digests, places and lists of ends over several chunks agree with those in one."""
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    rows = few_texts(5)
    assert found(prefix_trie.conversation_trie(make(spark, rows))) == plain_trie(rows)


def test_a_sketch_that_proves_nothing_changes_nothing(spark, monkeypatch):
    """All counters at two or more: every row is grouped exactly."""
    rows = few_texts(6, 60)
    monkeypatch.setattr(count_min, "sketch", lambda digests, bits: b"\xaa" * ((count_min.DEPTH << bits) // 4))
    assert found(prefix_trie.conversation_trie(make(spark, rows))) == plain_trie(rows)


def test_odd_rows(spark):
    rows = [(5, None, "user", "first"), (5, 0, None, "x"), (5, 1, "user", None), (6, 3, "user", "x"), (None, 0, "user", "lost"),
            (7, 0, "", ""), (7, 1, None, None), (8, 9, "user", "y" * 200_000), (10, 1, "user", "x"), (11, 1, "user", "x")]
    rows += [(20 + i, 0, "user", "same") for i in range(0, 300)]  # copies of one conversation
    rows += [(1000, t, "user", f"turn {t}") for t in range(2500)]  # a long one
    rows += [(1001, t, "user", f"turn {t}") for t in range(2400)]
    assert found(prefix_trie.conversation_trie(make(spark, rows))) == plain_trie(rows)
    assert prefix_trie.conversation_trie(make(spark, [])).count() == 0


def test_repeated_turns_are_turns(spark):
    rows = [(5, 0, "user", "x"), (5, 0, "user", "x"), (10, 0, "user", "x")]
    assert found(prefix_trie.conversation_trie(make(spark, rows))) == plain_trie(rows)


def test_sketch_never_estimates_too_low(spark):
    dice = np.random.default_rng(2)
    values = dice.integers(-(2**62), 2**62, 3000)
    drawn = dice.integers(0, 3000, 5000)
    counts = Counter(drawn.tolist())
    table = spark.createDataFrame([(int(values[i]), int(-values[i])) for i in drawn], "d1 long, d2 long").repartition(5)
    for bits in (18, 19):
        data = count_min.sketch(table, bits)
        got = count_min.estimates(data, bits, values, -values)
        want = np.array([min(counts[i], 2) for i in range(3000)])
        assert (got >= want).all() and (got == want).mean() > 0.99
    assert count_min.bits_for(10**12) == count_min.MOST_BITS
