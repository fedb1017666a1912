from __future__ import annotations

import hashlib
import random
import re
from dataclasses import replace

import numpy as np
from llm_helpers import SF_DIR

from kessan.llm import anchored_pii, ordinal_quality, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """Base spans by the patterns themselves."""
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    spans = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    spans += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(int(p) < 256 for p in m.group().split("."))]
    spans += [
        (m.start(), m.end(), "card") for m in CARD.finditer(text)
        if 12 <= len(digits(m)) <= 19 and anchored_pii.luhn(digits(m))
    ]
    spans += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(spans, key=lambda s: (s[0], anchored_pii.BASE_KINDS.index(s[2])))


def base(text):
    return [s for s in anchored_pii.spans_of(text) if s[2] in anchored_pii.BASE_KINDS]


def test_base_spans_equal_the_patterns():
    dice = random.Random(2)
    tokens = ["@", ".", "+", "-", " ", "(", ")", "a", "b.c", "1", "25", "256", "4111111111111111", "4111 1111-1111 1111",
              "é", "x@y.zz", "10.0.0.1", "+1 (555) 010-9999", "%", "_", "\n", "://", "token=", "0", "00000001", "٣"]
    for _ in range(6000):
        text = "".join(dice.choice(tokens) for _ in range(dice.randrange(14)))
        assert base(text) == plain(text), repr(text)


def test_long_texts_take_linear_time():
    for text in ("1" * 200_000, "1." * 100_000, "a@" * 100_000, "a" * 200_000 + "@", "+1((" * 50_000, "1 " * 100_000,
                 "a.b" * 60_000 + "@" + "c" * 60_000, "password=" * 20_000, "x://" * 40_000):
        anchored_pii.spans_of(text)


def test_added_kinds_and_masks():
    text = 'Mail a.b@c.de, password=abcd1234ef! Token = "00ff00ff00ff"; IBAN GB82 WEST 1234 5698 7654 32, ftp://me:pw@host.org/x'
    kinds = [(text[a:b], k) for a, b, k in anchored_pii.spans_of(text)]
    assert kinds[0] == ("a.b@c.de", "email") and ("abcd1234ef", "account") in kinds and ("00ff00ff00ff", "account") in kinds
    assert ("GB82 WEST 1234 5698 7654 32", "account") in kinds and ("ftp://me:pw@host.org/x", "address") in kinds
    assert anchored_pii.masked("write a@b.cd now") == "write <EMAIL> now"
    assert anchored_pii.masked("https://example.org/a tokens: none") == "https://example.org/a tokens: none"
    assert anchored_pii.masked(None) is None and anchored_pii.masked("") == ""


def test_pii_query_and_odd_tables(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op8_anchored_pii(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r["doc_id"]])
        shown = ",".join(f"{k}:{a}:{b}" for a, b, k in want)
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in anchored_pii.BASE_KINDS] == [sum(s[2] == k for s in want) for k in anchored_pii.BASE_KINDS]
        assert not set(shown.split(",")) - set(r["spans"].split(","))
    table = docs([None, "", "é a@b.cd", "é a@b.cd"])
    assert [r["text"] for r in anchored_pii.mask(table).collect()] == [None, "", "é <EMAIL>", "é <EMAIL>"]
    assert anchored_pii.mask(table).columns == table.columns
    assert anchored_pii.find(docs([])).count() == 0 and anchored_pii.mask(docs([])).count() == 0


def graded_texts(n, seed):
    dice = random.Random(seed)
    plain_words = [f"{a}{b}" for a in ("ren", "sol", "mak", "tin") for b in ("da", "vo", "les", "pu", "qui")]
    out = []
    for i in range(n):
        words = [dice.choice(plain_words) for _ in range(dice.randrange(20, 200))]
        grade = dice.choice([0, 1, 2, 2, 2])
        if grade == 0:
            words = [w.upper() + "!!" for w in words]
        if grade == 1:
            for _ in range(3):
                words.insert(dice.randrange(len(words)), dice.choice(["vile", "awful", "nasty"]))
        out.append((i, " ".join(words), grade))
    return out


def test_grades_of_held_out_texts(spark):
    rows = graded_texts(1500, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "key long, text string")
    ratings = spark.createDataFrame([(i, g) for i, _, g in rows if i < 1000], "key long, grade int")
    model = ordinal_quality.fit(docs, ratings)
    assert (np.diff(model.thresholds) >= 0).all()
    again = ordinal_quality.fit(docs, ratings.orderBy("grade"))
    assert (model.weights == again.weights).all()
    found = {r["key"]: r for r in ordinal_quality.score(docs, model, 2, key="key").collect()}
    held = [(found[i], g) for i, _, g in rows if i >= 1000]
    assert np.mean([r["kept"] == (g == 2) for r, g in held]) > 0.95
    means = [np.mean([r["expected_grade"] for r, g in held if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]
    kept = {r["key"] for r in ordinal_quality.select(docs, model, 2).collect()}
    assert kept == {k for k, r in found.items() if r["kept"]}
    few = ordinal_quality._sample(docs, ratings, replace(ordinal_quality.Settings(), sample_rows=50))
    assert few.count() == 50


def test_likelihood_slopes():
    """The steps of ``improve`` point up the likelihood: many steps on one row make it certain."""
    s = ordinal_quality.Settings(epochs=400, shrink=0.0)
    for grade in (0, 1, 2):
        w, t = ordinal_quality.improve(np.zeros(4), np.array([-1.0, 1.0]), [np.array([1, 2])], np.array([grade]), s, 0)
        p = np.diff(np.concatenate([[0.0], ordinal_quality.cumulative(np.array([w[1] + w[2]]), t)[0], [1.0]]))
        assert p.argmax() == grade and p[grade] > 0.8


def test_quality_odd_tables(spark, docs):
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 0), (2, 1, None), (2, 0, 0)], "doc_id long, quality int, toxic int")
    table = docs([None, "", "a", "x " * 50_000, "a"])
    rows = ordinal_quality.rate_documents(table, labels).collect()  # one grade only: no model
    assert len(rows) == 5 and all(r["kept"] for r in rows)
    two = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert ordinal_quality.rate_documents(table, two).count() == 5
    assert ordinal_quality.rate_documents(docs([]), two).count() == 0
    assert ordinal_quality.rate_documents(table, two.limit(0)).filter("kept").count() == 5


def test_quality_query(spark):
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = queries.op1_ordinal_quality(spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    clean = [r["kept"] for r in rows if labels.get(r["doc_id"]) == (1, 0)]
    poor = [r["kept"] for r in rows if labels.get(r["doc_id"], (1, 0))[0] == 0]
    assert np.mean(clean) > 0.95 and np.mean(poor) < 0.2
