from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from kessan import session
from kessan.llm import queries, relative_lz


def expected(texts, window):
    """Per text: words, removed words, kept text; by counting every window."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def found(df, window):
    rows = relative_lz.remove_repeats(df, window).collect()
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in rows}, rows


def corpus(dice, n, letters, longest):
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(dice.randrange(1, 4)):
            kind = dice.random()
            if texts and kind < 0.4:  # a piece of an earlier text
                old = dice.choice(texts).split()
                at = dice.randrange(len(old) + 1)
                parts += old[at : at + dice.randrange(longest)]
            elif kind < 0.5:  # words over and over, at a short period
                period = [dice.choice(letters) for _ in range(dice.randrange(1, 5))]
                parts += (period * longest)[: dice.randrange(longest)]
            else:
                parts += [dice.choice(letters) for _ in range(dice.randrange(longest))]
        texts.append(dice.choice([" ", "\n", " \t "]).join(parts))
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_small_alphabet_against_counting(spark, docs, seed):
    dice = random.Random(seed)
    texts = corpus(dice, 150, [f"w{i}" for i in range(30)], 120)
    texts += [texts[3], texts[3], "", None, " \n", "x " * 34, "y " * 35, "z " * 36, "é  ñ " * 40]
    got, rows = found(docs(texts), 35)
    for i, want in enumerate(expected(texts, 35)):
        assert got[i] == want, texts[i]
    assert len(rows) == len(texts)
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
    check_factors(rows, {i: (t or "").encode().split() for i, t in enumerate(texts)}, 35)


def check_factors(rows, words, window):
    """Each factor equals its source's words, which stand at another place, and goes as far as that source does."""
    by_block = {}
    for r in rows:
        by_block.setdefault(r["block"], []).append((r["position"], r["doc_id"]))
    n = 0
    for r in rows:
        for f in r["factors"]:
            start, source = max(x for x in by_block[f["block"]] if x[0] <= f["position"])
            mine, theirs, at = words[r["doc_id"]], words[source], f["position"] - start
            assert f["length"] >= window
            assert (source, at) != (r["doc_id"], f["start"])
            assert mine[f["start"] : f["start"] + f["length"]] == theirs[at : at + f["length"]]
            n += 1
        assert [f["start"] for f in r["factors"]] == sorted({f["start"] for f in r["factors"]})
    assert n


def test_long_copies_are_one_factor_across_phrases(spark, docs):
    """Copies of 400 words, in the middle and at the ends of texts that are otherwise their own."""
    passage = [f"p{i}" for i in range(400)]
    own = lambda k, n: [f"o{k}x{i}" for i in range(n)]
    texts = [own(0, 50) + passage + own(1, 50), passage + own(2, 90), own(3, 10) + passage, own(4, 300)]
    rows = {r["doc_id"]: r for r in relative_lz.remove_repeats(docs([" ".join(t) for t in texts])).collect()}
    assert [rows[i]["n_removed"] for i in range(4)] == [400, 400, 400, 0]
    check_factors(rows.values(), dict(enumerate(texts)), 35)
    for i, start in enumerate((50, 0, 10)):
        assert rows[i]["spans"][0]["start"] == start and len(rows[i]["spans"]) == 1
    assert rows[3]["factors"] == []
    # Whole phrases have one first and one last place, so their sources go on; only the windows
    # at the two borders may have sources of their own.
    for i in range(3):
        assert len(rows[i]["factors"]) <= 3 and max(f["length"] for f in rows[i]["factors"]) >= 300


def test_greedy_parse_of_given_runs():
    """The source that reaches farthest wins; a window over a border starts a factor of its own."""
    place = 1000
    runs = [(0, 5, 2000, 3000), (5, 5, 2005, 9005), (10, 1, 7000, 7000), (30, 2, 1030, 1500)]
    assert relative_lz.parse(runs, place, 35) == [(0, 44, 2000), (10, 35, 7000), (30, 36, 1500)]
    assert relative_lz.covered_spans(relative_lz.parse(runs, place, 35)) == [(0, 66)]
    assert relative_lz.parse([], place, 35) == []


def test_phrases_of_any_window_against_counting():
    """Without Spark: every window of a phrase has its anchor; phrases of a text are gapless."""
    dice = random.Random(8)
    texts = [t.encode() for t in corpus(dice, 60, "abcdef", 40)]
    text, first, count, anchor, whole = relative_lz.phrases_of(texts, 9, 3)
    for i, t in enumerate(texts):
        n = max(0, len(t.split()) - 8)
        mine = [(f, c) for k, f, c in zip(text, first, count, strict=True) if k == i]
        assert sum(c for _, c in mine) == n
        assert [f for f, _ in mine] == [sum(c for _, c in mine[:k]) for k in range(len(mine))]
    words = [t.split() for t in texts]
    by_window = {}
    for k, f, c, a in zip(text, first, count, anchor, strict=True):
        for w in range(f, f + c):
            by_window.setdefault(tuple(words[k][w : w + 9]), set()).add(int(a))
    assert all(len(a) == 1 for a in by_window.values())


def periodic(n_words):
    """Texts that hold the same two words over and over, between words of their own."""
    turns = ["Is onhe."] * (n_words // 2)
    return [" ".join([*(f"a{i}x{k}" for k in range(20 * i)), *turns, *(f"b{i}x{k}" for k in range(15 * i))]) for i in range(6)]


def test_words_over_and_over_are_one_row_a_document_and_phrase(spark, docs):
    """However long the words go on: no more rows are looked up, joined or gathered."""
    counted = []
    for n_words in (200, 1600):
        texts = periodic(n_words)
        blocks = session.written(relative_lz.placed(docs(texts).select("doc_id", "text")), "blocks").select("doc", "text")
        rows = relative_lz.phrases(blocks, 35, 8).collect()
        assert len(rows) == len({(r["doc"], r["anchor"], r["whole"]) for r in rows})
        windows = [(r["doc"], f + i) for r in rows for f in (r["first"], *(r["again"] or ())) for i in range(r["count"])]
        assert len(windows) == len(set(windows)) == sum(len(t.split()) - 34 for t in texts)
        counted.append((len(rows), relative_lz.matches(blocks, 35).count()))
        got, rows = found(docs(texts), 35)
        assert [got[i] for i in range(len(texts))] == expected(texts, 35)
        check_factors(rows, {i: t.encode().split() for i, t in enumerate(texts)}, 35)
    assert counted[0] == counted[1]


def test_rows_once_a_text_against_counting():
    dice = random.Random(4)
    for n in (0, 1, 2, 50, 400):
        text = sorted(dice.randrange(4) for _ in range(n))
        rows = [(t, dice.randrange(3), dice.randrange(5)) for t in text]
        columns = [np.array([r[i] for r in rows], kind) for i, kind in enumerate((np.int64, np.uint64, np.uint64))]
        kept, again, rest = relative_lz.once_a_text(*columns)
        ends, held = np.cumsum(again), {}
        for k, end, size in zip(kept, ends, again, strict=True):
            held.setdefault(rows[k], []).extend([int(k), *map(int, rest[end - size : end])])
        want = {}
        for i, row in enumerate(rows):
            want.setdefault(row, []).append(i)
        assert {k: sorted(v) for k, v in held.items()} == want
        assert list(kept) == sorted(kept)


def test_rows_with_one_id_no_id_and_none(spark, docs):
    long = " ".join(f"a{i}" for i in range(50))
    table = docs([(1, long, "en", "s", 1, "k"), (1, long, "en", "s", 1, "k"), (1, "b " * 3, "en", "s", 1, "k"),
                  (None, "c d", None, None, None, None), (None, None, None, None, None, None)])
    rows = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in relative_lz.remove_repeats(table).collect())
    assert rows == [("1", 3, 0), ("1", 50, 50), ("1", 50, 50), ("None", 0, 0), ("None", 2, 0)]
    assert relative_lz.remove_repeats(docs([])).count() == 0


def test_query_against_counting(spark):
    from llm_helpers import SF_DIR

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    want = dict(zip(texts, expected(list(texts.values()), 35), strict=True))
    rows = queries.op5_relative_lz(spark, SF_DIR).collect()
    assert len(rows) == len(texts) and any(r["n_removed"] for r in rows)
    for r in rows:
        n, gone, kept = want[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
