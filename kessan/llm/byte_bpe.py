"""Byte-level BPE over Arrow batches with the tokenizers library, offsets, and decoding.

A text is cut before every space that a non-space follows. No match of the public splitting
pattern crosses such a place, so distinct chunks can be encoded apart, and most are a word and marks, two
matches of the pattern that the library's model merges one by one. Matches met first, the
frequent ones among them, are remembered within a bound of bytes until the partition ends; that is
a speed-up only. With any other pattern, or any other pre-tokenizer in a tokenizer's file, whole
texts go through the library as they are.

Null texts are encoded as empty ones (no ids). Whole texts are encoded at any length. Rows are
handled one by one, so repeated rows, ties and further columns pass through unchanged; an empty
table gives an empty table. The columns the operators add replace columns of the same name.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kessan.llm.columns import mapped

#: Bytes of matches a worker remembers, and characters of the longest one.
REMEMBERED, LONGEST = 64_000_000, 64
#: Rows of a step of an Arrow batch, and the characters of text that are encoded at a time.
STEP, STEP_SIZE = 1024, 2_000_000

# Code points that some engines count as white space and others do not are never cut at.
_NO_CUT = r"\s\x1c-\x1f\x85\u180e\u200b\ufeff"
_DOUBTFUL = re.compile(rf" (?:[{_NO_CUT}]|$)")
_CUT = re.compile(rf" (?=[^{_NO_CUT}])")
# A Latin word with what may follow it: the word is one match of the public pattern, the ASCII
# punctuation (but no apostrophe, which may start a contraction) another.
_WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\[-`{-~]*)")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 bytes stand for
    themselves, the others in order for the characters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, free = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in table:
            table[b], free = chr(free), free + 1
    return [table[b] for b in range(256)]


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token's bytes and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


@cache
def rank_tokenizer(path: str, pattern: str):
    """A tokenizer that merges as the ranks say: any two neighbours whose bytes together are a
    token may merge, lowest rank first; a match that is a token as a whole stays whole."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, shown = read_ranks(path), byte_characters()
    text = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = [
        (text[token[:i]], text[token[i:]])
        for token in sorted(ranks, key=ranks.get)
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    vocab = {text[token]: rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return tokenizer


@cache
def file_tokenizer(path: str):
    """A tokenizer from its JSON file; names of special tokens in a text are ordinary text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def cuts_at_spaces(tokenizer, pattern: str | None) -> bool:
    """Whether the tokenizer splits by the public pattern and adds nothing of its own."""
    import public_tokenizers

    if pattern is not None:
        return pattern == public_tokenizers.PATTERN
    split = json.loads(tokenizer.to_str())["pre_tokenizer"] or {}
    return split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")


class Remembered(dict):
    """Results of ``compute`` by key: those met first, as frequent ones are, up to ``most`` bytes;
    the others in ``step``, until that is cleared."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.room, self.step = compute, most, {}

    def __missing__(self, key: str) -> bytes:
        found = self.step.get(key)
        if found is None:
            found = self.compute(key)
            if self.room > 0 and len(key) <= LONGEST:
                self.room -= 2 * len(key) + len(found) + 200
                self[key] = found
            else:
                self.step[key] = found
        return found


class ChunkEncoder:
    """Texts to little-endian unsigned 32-bit ids."""

    def __init__(self, tokenizer, by_chunks: bool):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if tokenizer.normalizer is not None:
            raise ValueError("a byte-level tokenizer without a normalizer is needed")
        self.tokenizer, self.model, self.by_chunks = tokenizer, tokenizer.model, by_chunks
        self.shown = dict(enumerate(byte_characters()))
        self.space = self.shown[ord(" ")]
        last = max(tokenizer.get_vocab(with_added_tokens=True).values(), default=-1)
        self.packed = [i.to_bytes(4, "little") for i in range(last + 1)]
        self.forget()

    def forget(self) -> None:
        """Drops what is remembered, as at the end of a partition."""
        self.matches = Remembered(self._merged, REMEMBERED)

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _merged(self, match: str) -> bytes:
        """The ids of one match of the public pattern."""
        packed = self.packed
        if match[1:].isalpha() and match.isascii():  # letters stand for themselves
            shown = self.space + match[1:] if match[0] == " " else match
        else:
            shown = match.encode("utf-8").decode("latin-1").translate(self.shown)
        return b"".join([packed[t.id] for t in self.model.tokenize(shown)])

    def _found(self, chunk: str) -> bytes:
        """The ids of a chunk with the space before it. Lines of a word and marks are looked up by
        match; a single line break between two of them is a match of its own."""
        found = _WORD.fullmatch(chunk)
        if found:
            word, marks = found.groups()
            return self.matches[" " + word] + self.matches[marks] if marks else self.matches[" " + word]
        lines = chunk.split("\n")
        if len(lines) > 1:
            found = [_WORD.fullmatch(line) for line in lines]
            if None not in found:
                parts = [m for x in found for m in ("\n", x[1], x[2]) if m]
                parts[:2] = [" " + parts[1]]
                return b"".join([self.matches[m] for m in parts])
        return self._whole([" " + chunk])[0]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text. Arrow splits the texts, finds the distinct chunks and lays their ids out
        again in order, so Python sees a chunk once per call."""
        texts = [t or "" for t in texts]
        if not self.by_chunks:
            return self._whole(texts)
        heads, tails, odd = [], [], {}
        for i, text in enumerate(texts):
            if _DOUBTFUL.search(text):
                head, *rest = _CUT.split(text)
                odd[i] = b"".join(map(self._found, rest))
                tail = None
            else:
                head, space, tail = text.partition(" ")
            heads.append(head)
            tails.append(tail if i not in odd and space else None)
        lists = pc.split_pattern(pa.array(tails, pa.large_string()), " ")
        words = lists.flatten().dictionary_encode()
        table = pa.array(list(map(self._found, words.dictionary.to_pylist())), pa.large_binary())
        laid = table.take(words.indices)
        bounds = np.frombuffer(laid.buffers()[1], np.int64)[laid.offset : laid.offset + len(laid) + 1]
        self.matches.step.clear()
        ends = bounds[np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())].tolist()
        data, first = laid.buffers()[2], self._whole(heads)
        out = []
        for i, (head, start, end) in enumerate(zip(first, [0, *ends], ends, strict=False)):
            out.append(head + (odd[i] if i in odd else data[start:end].to_pybytes() if end > start else b""))
        return out

    def steps(self, texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
        """The ids of ``texts`` in steps of bounded size, each with the place of its first text."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (size < STEP_SIZE or end == at):
                size += len(texts[end] or "")
                end += 1
            yield at, self.encode(texts[at:end])
            at = end


_encoders: dict[tuple, ChunkEncoder] = {}


def encoder(path: str, pattern: str | None) -> ChunkEncoder:
    """One encoder per worker and vocabulary: of a rank file with its pattern, or of a JSON file."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = chunk_encoder(path, pattern)
    return _encoders[path, pattern]


def chunk_encoder(path: str, pattern: str | None) -> ChunkEncoder:
    tokenizer = file_tokenizer(path) if pattern is None else rank_tokenizer(path, pattern)
    return ChunkEncoder(tokenizer, cuts_at_spaces(tokenizer, pattern))


def token_offsets(text: str, ids: bytes, token_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end (exclusive) of each token. Tokens that share the bytes of one
    character all cover that character."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    ends = np.cumsum(token_sizes[np.frombuffer(ids, "<u4")])
    starts = ends - token_sizes[np.frombuffer(ids, "<u4")]
    return character[starts].astype(np.int32), character[ends - 1].astype(np.int32) + 1


def _arrow_type(kind: T.DataType) -> pa.DataType:
    return {"binary": pa.binary(), "array<int>": pa.list_(pa.int32())}[kind.simpleString()]


def add_columns(df: DataFrame, added: dict[str, T.DataType], rows) -> DataFrame:
    """``df`` with columns that ``rows(batch) -> dict of lists`` computes, batch by batch."""
    fields = [f for f in df.schema.fields if f.name not in added]
    schema = T.StructType(fields + [T.StructField(name, kind) for name, kind in added.items()])
    names = df.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                part = pa.RecordBatch.from_arrays(batch.slice(start, STEP).columns, names)
                new = rows(part)
                kept = [part.column(i) for i, name in enumerate(names) if name not in added]
                kept += [pa.array(new[name], _arrow_type(kind)) for name, kind in added.items()]
                yield pa.RecordBatch.from_arrays(kept, [f"c{i}" for i in range(len(kept))])
        for forget in (x.forget for x in _encoders.values()):
            forget()

    return mapped(df, work, schema)


def encode(
    df: DataFrame, path: str, pattern: str | None = None, text: str = "text", ids: str = "ids", offsets: bool = False
) -> DataFrame:
    """``df`` with column ``ids`` (binary, little-endian unsigned 32-bit), and with ``offsets``
    also ``starts`` and ``ends``, the characters of each token. ``pattern`` names the split of a
    rank file; without it ``path`` is a tokenizer's JSON file."""
    added = {ids: T.BinaryType()}
    if offsets:
        added |= {"starts": T.ArrayType(T.IntegerType()), "ends": T.ArrayType(T.IntegerType())}

    def rows(part: pa.RecordBatch) -> dict[str, list]:
        texts = part.column(part.schema.get_field_index(text)).to_pylist()
        out = {ids: [x for _, some in encoder(path, pattern).steps(texts) for x in some]}
        if offsets:
            sizes = token_sizes(path, pattern)
            pairs = [token_offsets(t or "", i, sizes) for t, i in zip(texts, out[ids], strict=True)]
            out |= {"starts": [p[0] for p in pairs], "ends": [p[1] for p in pairs]}
        return out

    return add_columns(df, added, rows)


@cache
def token_bytes(path: str, pattern: str | None) -> tuple[bytes, ...]:
    """The bytes of each id, by reversing the byte table. An id without bytes is empty."""
    if pattern:
        ranks = read_ranks(path)
        table = {rank: token for token, rank in ranks.items()}
    else:
        back = {c: b for b, c in enumerate(byte_characters())}
        table = {
            i: bytes(back[c] for c in token) if all(c in back for c in token) else token.encode("utf-8")
            for token, i in file_tokenizer(path).get_vocab(with_added_tokens=True).items()
        }
    return tuple(table.get(i, b"") for i in range(max(table, default=-1) + 1))


@cache
def token_sizes(path: str, pattern: str | None) -> np.ndarray:
    return np.array([len(x) for x in token_bytes(path, pattern)], np.int64)


def decode(
    df: DataFrame, path: str, pattern: str | None = None, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``df`` with column ``decoded``, the bytes of the ids. Bytes of one character that several
    tokens share meet again, so the bytes of a whole text are valid UTF-8; null ids give null."""

    def rows(part: pa.RecordBatch) -> dict[str, list]:
        table = token_bytes(path, pattern).__getitem__
        column = part.column(part.schema.get_field_index(ids)).to_pylist()
        return {decoded: [
            None if x is None else b"".join(map(table, np.frombuffer(x, "<u4").tolist())) for x in column
        ]}

    return add_columns(df, {decoded: T.BinaryType()}, rows)
