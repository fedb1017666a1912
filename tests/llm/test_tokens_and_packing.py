from __future__ import annotations

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from kessan.llm import best_two_fit, byte_bpe, queries

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
JSON = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "a", " a", "a  b", "a \n b\n\n c \t", "é" * 50, "日本語 テキスト", "😀 a😀b 😀", "don't we'll I'M",
    "x y   z", "a  b", "a \x85b", "a\x1c b \x1cc", "a ﻿b", "1234 56 7.8", "<|endoftext|> a",
    "̀a ̀", "a" * 3000, "ab " * 5000, "\r\n \r\n", " ᠎ ​ x", "aaa" * 7 + "!!!??",
]


def public_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n):
    dice = random.Random(5)
    letters = "abz%$×÷ÿ \n\t.,'!0159éßñ日😀 ́ 　"
    return ["".join(dice.choice(letters) for _ in range(dice.randrange(60))) for _ in range(n)]


def test_ids_equal_the_public_library():
    texts = ODD + random_texts(3000)
    known = public_encoding()
    found = byte_bpe.chunk_encoder(RANKS, PATTERN).encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == known.encode_ordinary(text), repr(text)


def test_chunks_equal_whole_texts_with_the_file_tokenizer():
    texts = ODD + random_texts(3000)
    tokenizer = byte_bpe.file_tokenizer(JSON)
    found = byte_bpe.chunk_encoder(JSON, None).encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_memory_of_chunks_is_bounded_by_bytes(monkeypatch):
    texts = [*random_texts(300), "x " + "long" * 50, "日本語" * 100 + " y"]
    whole = byte_bpe.chunk_encoder(JSON, None).encode(texts)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 2000)
    small = byte_bpe.chunk_encoder(JSON, None)
    assert [x for t in texts for x in small.encode([t])] == whole
    assert 0 < len(small.matches) < 12
    assert [x for _, some in small.steps(texts) for x in some] == whole
    small.forget()
    assert not small.matches


def test_another_pattern_gives_the_tokenizers_ids():
    """Nothing is taken for granted of patterns other than the public one."""
    pattern = r" ?\p{L}{1,2}|\s+|[^\s\p{L}]"
    texts = [*ODD, "abcdef ghijk  lmn 12", *random_texts(200)]
    tokenizer = byte_bpe.rank_tokenizer(RANKS, pattern)
    found = byte_bpe.chunk_encoder(RANKS, pattern).encode(texts)
    want = [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == want
    known = base64.b64decode  # the public library agrees
    ranks = {known(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    assert want == [other.encode_ordinary(t) for t in texts]


def test_file_with_another_split(tmp_path):
    from tokenizers import pre_tokenizers

    tokenizer = byte_bpe.file_tokenizer.__wrapped__(JSON)
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    assert not byte_bpe.cuts_at_spaces(tokenizer, None)
    path = str(tmp_path / "t.json")
    tokenizer.save(path)
    found = byte_bpe.chunk_encoder(path, None).encode(["ab cd"])[0]
    assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode("ab cd", add_special_tokens=False).ids


def test_query_against_the_public_library(spark):
    import hashlib

    from llm_helpers import SF_DIR

    known, want = public_encoding(), []
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        ids = known.encode_ordinary(r["text"] or "")
        packed = np.array(ids, "<u4").tobytes()
        digests = [hashlib.sha256(x).hexdigest() for x in (packed, (r["text"] or "").encode())]
        want.append((r["doc_id"], len(ids), *digests))
    assert sorted(map(tuple, queries.op7_byte_bpe(spark, SF_DIR).collect())) == sorted(want)


def test_columns_of_any_name(spark):
    table = spark.createDataFrame([(1, "a b", 2, 3, 4)], "doc_id long, text string, `a.b` int, `c d` int, `e``f` int")
    row = byte_bpe.decode(byte_bpe.encode(table, RANKS, PATTERN), RANKS, PATTERN).first()
    assert row["a.b"] == 2 and row["c d"] == 3 and row["e`f"] == 4 and bytes(row["decoded"]) == b"a b"


def test_round_trip_offsets_and_odd_tables(spark, docs):
    table = docs([*ODD, None, "a", "a"])
    encoded = byte_bpe.encode(table, RANKS, PATTERN, offsets=True)
    assert encoded.columns[:6] == table.columns
    rows = byte_bpe.decode(encoded, RANKS, PATTERN).collect()
    assert len(rows) == len(ODD) + 3
    for r in rows:
        text = r["text"] or ""
        assert bytes(r["decoded"]).decode() == text
        assert len(r["starts"]) == len(r["ends"]) == len(r["ids"]) // 4
        assert all(0 <= a < b <= len(text) for a, b in zip(r["starts"], r["ends"], strict=True))
        assert sorted({i for a, b in zip(r["starts"], r["ends"], strict=True) for i in range(a, b)}) == list(range(len(text)))
    assert byte_bpe.decode(byte_bpe.encode(docs([]), RANKS, PATTERN), RANKS, PATTERN).count() == 0


def check_packing(rows, texts, capacity=1024):
    tokenizer = byte_bpe.file_tokenizer(JSON)
    want = {}
    for key, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        start, piece = 0, 0
        while start < len(ids):
            end = start + ((len(ids) - start) % capacity or capacity)
            want[key, piece] = (start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes()))
            start, piece = end, piece + 1
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert len(rows) == len(want)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(r["length"] for r in rows)


def test_packing_of_the_table(spark):
    from llm_helpers import SF_DIR

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    n, total = check_packing(queries.op6_best_two_fit(spark, SF_DIR).collect(), texts)
    assert n <= -(-total // 1024) * 1.02 + 1


def test_packing_odd_tables(spark, docs):
    texts = [*ODD, None, "a b c", "a b c"]
    n, total = check_packing(best_two_fit.pack_documents(docs(texts), JSON).collect(), dict(enumerate(texts)))
    assert n <= total // 1024 + 2
    assert best_two_fit.pack_documents(docs([]), JSON).count() == 0
    repeated = best_two_fit.pack_documents(docs([(1, "a b", "en", "s", 3, "x")] * 700), JSON).collect()
    assert len(repeated) == 700 and len({(r["sequence_id"], r["offset"]) for r in repeated}) == 700


def test_smallest_gives_way_to_a_tighter_pair():
    # Greedy: 60 then 30 leaves 10; 30 gives way to 25 + 15, which leaves none.
    assert best_two_fit.plan_bins([15, 25, 30, 60], [1, 1, 1, 1], 100)[0] == (1, {60: 1, 25: 1, 15: 1})


def test_plan_uses_every_piece_once():
    dice = np.random.default_rng(3)
    lengths = np.arange(1, 101)
    counts = dice.integers(0, 1000, 100)
    used = np.zeros(101, np.int64)
    for times, content in best_two_fit.plan_bins(lengths, counts, 100):
        assert times > 0 and sum(k * n for k, n in content.items()) <= 100
        for k, n in content.items():
            used[k] += times * n
    assert (used[1:] == counts).all()


def test_too_long_a_piece_is_an_error(spark):
    with pytest.raises(ValueError, match="longer"):
        best_two_fit.pack(spark.createDataFrame([(1, 9)], "doc_id long, length long"), 8, ("doc_id",))
