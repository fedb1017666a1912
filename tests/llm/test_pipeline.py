"""The pipeline stage by stage against plain versions on the small tables."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from llm_helpers import SF_DIR
from test_quality_and_pii import EMAIL, PHONE
from test_relative_lz import expected
from test_simhash_blocks import plain_components, plain_fingerprint
from test_tokens_and_packing import check_packing

from kessan.llm import anchored_pii, queries


def as_dict(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "repeated_passages", "personal_data", "packing"]
    held = as_dict(docs)
    kept = {r["doc_id"] for r in queries.op1_ordinal_quality(spark, SF_DIR).collect() if r["kept"]}
    want = {k: t for k, t in held.items() if k in kept}
    for name, step in list(stages.items())[:-1]:
        result = step(spark, docs, SF_DIR)
        assert result.columns == docs.columns and result.dtypes == docs.dtypes
        if name == "near_duplicates":
            rows = plain_components([(k, plain_fingerprint(t)) for k, t in want.items()])
            want = {k: want[k] for k, _, least in rows if k == least}
        elif name == "repeated_passages":
            want = dict(zip(want, [e[2] for e in expected(list(want.values()), 35)], strict=True))
        elif name == "personal_data":
            want = {k: anchored_pii.masked(t) for k, t in want.items()}
        got = as_dict(result)
        assert got == want, name
        docs = spark.createDataFrame(result.collect(), docs.schema)
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect() if name in ("repeated_passages", "personal_data"))
    assert not any(EMAIL.search(t) or (PHONE.search(t) and anchored_pii.spans_of(t)) for t in want.values())
    check_packing(stages["packing"](spark, docs, SF_DIR).collect(), want)
    assert len(corpus_pipeline.run(spark, SF_DIR).collect()) == stages["packing"](spark, docs, SF_DIR).count()


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_columns_of_any_name(spark, stage):
    own = "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, `c d` int, `e``f` string, `rest` int, ids int"
    dice = random.Random(2)
    copied = " ".join(f"w{dice.randrange(999)}" for _ in range(50))
    texts = [f"mail me at a{i}@b.cd now {i}" for i in range(40)] + [f"{copied} {i} {i * i}" for i in range(3)]
    table = spark.createDataFrame([(i, t, "en", "s", len(t), i, -i, f"x{i}", 1, 2) for i, t in enumerate(texts)], own)
    result = dict(corpus_pipeline.STAGES)[stage](spark, table, SF_DIR)
    if stage == "packing":
        assert result.count() == len(texts)
        return
    assert result.dtypes == table.dtypes
    for r in result.collect():
        assert (r["a.b"], r["c d"], r["e`f"], r["rest"], r["ids"]) == (r["doc_id"], -r["doc_id"], f"x{r['doc_id']}", 1, 2)
        if stage == "personal_data" and r["doc_id"] < 40:
            assert r["text"] == f"mail me at <EMAIL> now {r['doc_id']}" and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_odd_tables(spark, stage, docs):
    dice = random.Random(1)
    long = " ".join(f"w{dice.randrange(10**6)}" for _ in range(40_000))
    rows = [None, "", " ", "a b", "a b", long, "mail a@b.cd"]
    table = docs([*rows, (None, None, None, None, None, None), (None, "q w", None, None, None, None),
                  (3, "a b", "en", "src0", 3, "own"), (3, "other words here", "en", "s", 3, "own")])
    step = dict(corpus_pipeline.STAGES)[stage]
    result = step(spark, table, SF_DIR)
    if stage != "packing":
        assert result.columns == table.columns
    n = result.count()
    assert n >= (1 if stage == "quality" else 5)
    if stage in ("repeated_passages", "personal_data"):
        assert n == 11
    if stage == "near_duplicates":
        plain = plain_components([(i, plain_fingerprint(r["text"])) for i, r in enumerate(table.collect())])
        assert n == len({least for _, _, least in plain}) == 6
    assert step(spark, docs([]), SF_DIR).count() == 0
