"""Personal data by anchor expansion.

One Aho-Corasick pass over the whole text finds anchors: at-signs, plus signs, digits, ``://``
and cue words. From each anchor a small deterministic parser grows to the bounds of what stands
there and checks it. A parser never reads again what it has read, so time is linear in the text
at any length and for any text.

Base kinds are ``email``, ``ip``, ``card`` and ``phone``, with the bounds of these patterns,
leftmost first and without overlap within a kind, failing matches dropped:

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+), parts at most 255
    card   [0-9]([ -]?[0-9])+, 12 to 19 digits with a Luhn check digit
    phone  \\+[0-9][ ().0-9-]+[0-9], 9 to 15 digits

The anchors add ``account`` (a cue such as ``password=`` or ``IBAN`` with its value, a value of
eight or more characters that holds a digit, an IBAN with its check digits) and ``address`` (an
address with a scheme that names a user before its host). Offsets count code points, ends are exclusive.

Null and empty texts have no spans and stay as they are. Rows are handled one by one: repeated
rows, other columns and empty tables need no care.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kessan.llm.columns import mapped, narrow

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "address")
_ORDER = {kind: i for i, kind in enumerate(KINDS)}
# Words before the value of an account.
CUES = ("password", "passwd", "token", "secret", "api_key", "apikey", "iban", "account number", "account no")

_LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789.+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PARTS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_VALUE = re.compile(r"""\s{0,3}[:=]\s{0,3}["']?([A-Za-z0-9_+/.=-]{8,})""")
_IBAN = re.compile(r"\s{0,3}[:=]?\s{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)")
_AUTHORITY = re.compile(r"[^\s/?#@<>\"]+@[A-Za-z0-9.:\[\]-]+[^\s<>\"]*")

Span = tuple[int, int, str]


@cache
def _automaton():
    from ahocorasick import Automaton

    found = Automaton()
    for anchor in ("@", "+", "://"):
        found.add_word(anchor, (anchor, len(anchor)))
    for digit in "0123456789":
        found.add_word(digit, ("0", 1))
    for cue in CUES:
        for word in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(word, (cue, len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _run_before(text: str, at: int, least: int, allowed: frozenset[str]) -> int:
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def _ips(text: str, start: int, end: int) -> Iterator[Span]:
    """Every four parts of a dotted run, from its start."""
    parts = text[start:end].split(".")
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        size = sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in four):
            yield start, start + size, "ip"
        start += size + 1


def _iban(value: str) -> bool:
    plain = value.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def spans_of(text: str | None) -> list[Span]:
    """``(start, end, kind)`` by start, then by kind in the order of ``KINDS``."""
    if not text:
        return []
    spans: list[Span] = []
    read = dict.fromkeys(("email", "parts", "chain", "account", "address"), 0)
    for last, (anchor, size) in _automaton().iter(text):
        at = last + 1 - size
        if anchor == "0":
            if at >= read["chain"]:
                read["chain"] = end = _CHAIN.match(text, at).end()
                if end - at >= 12:
                    digits = text[at:end].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        spans.append((at, end, "card"))
            if at >= read["parts"]:
                read["parts"] = end = _PARTS.match(text, at).end()
                if end - at >= 7:
                    spans += _ips(text, at, end)
        elif anchor == "@":
            start, domain = _run_before(text, at, read["email"], _LOCAL_CHARACTERS), _DOMAIN.match(text, at + 1)
            if start < at and domain:
                read["email"] = domain.end()
                spans.append((start, domain.end(), "email"))
        elif anchor == "+":
            found = _PHONE.match(text, at)
            if found and 9 <= sum(c in "0123456789" for c in found.group()) <= 15:
                spans.append((at, found.end(), "phone"))
        elif anchor == "://":
            found = _AUTHORITY.match(text, last + 1) if at >= read["address"] else None
            if found:
                start = _run_before(text, at, read["address"], _SCHEME_CHARACTERS)
                read["address"] = found.end()
                spans.append((start, found.end(), "address"))
        elif last >= read["account"] and not text[at - 1 : at].isalnum():
            found = (_IBAN if anchor == "iban" else _VALUE).match(text, last + 1)
            if found:
                value = found.group(1)
                if _iban(value) if anchor == "iban" else any(c in "0123456789" for c in value):
                    read["account"] = found.end(1)
                    spans.append((found.start(1), found.end(1), "account"))
    return sorted(spans, key=lambda s: (s[0], _ORDER[s[2]]))


def masked(text: str | None) -> str | None:
    """The text with each span, or run of overlapping spans, as the name of its first kind."""
    spans = spans_of(text)
    if not spans:
        return text
    out, last = [], 0
    for start, end, kind in spans:
        if start >= last:
            out += [text[last:start], f"<{kind.upper()}>"]
        last = max(last, end)
    return "".join([*out, text[last:]])


def find(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, spans`` per row, ``spans`` an array of ``kind, start, end``."""
    of = df.schema[key].dataType.simpleString()
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [{"kind": kind, "start": start, "end": end} for start, end, kind in spans_of(t.as_py())]
                for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kinds)], ["key", "spans"])

    found = narrow(df, key=key, text=text).mapInArrow(
        work, f"key {of}, spans array<struct<kind:string,start:long,end:long>>"
    )
    return found.select(F.col("key").alias(key), "spans")


def mask(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its personal data masked, all other columns as they are."""
    place = df.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array((masked(t.as_py()) for t in batch.column(place)), pa.string())
            yield batch.set_column(place, batch.schema.field(place), new)

    return mapped(df, work, df.schema)
