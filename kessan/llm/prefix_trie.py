"""The trie of conversation prefixes, screened by a count-min sketch of prefix digests.

A conversation is a sequence of turns; a node is a distinct sequence of first turns, and its
members are the conversations that start with it. Texts do not leave the scan: a turn goes on as
its hashes and its length, and the digest of a prefix is the exclusive or of its turns' hashes,
each mixed with its depth.

* **Screening.** All prefix digests are sketched (``count_min``). An estimate of one proves that
  a prefix has one member. A row whose parent prefix has a proven single member is written
  where it stands: the tail of a conversation that nobody shares is never shuffled. Only the
  other rows are grouped by digest.
* **Subtrees without iteration.** The nodes whose smallest member is conversation m are those of
  its prefixes from some depth a(m) on. So each conversation adds to every node it passes what
  is a sum over the node's members: one leaf, if m's last turn is a node of its own without
  children; one child, if a(m) is at most one deeper; and for the tokens a shared cache saves, the
  bytes of its turns from there to a(m), those that a smaller conversation has already. Two
  aggregations with map-side combining serve the whole trie, at any depth.
* **Long conversations** get their places by ``positions`` and their running digests by chunks of
  ``CHUNK`` turns, so no task holds one. The ids of a node's ends are joined to text by chunks,
  too; the hash of a node reads its chunks as a stream.

Turns are ordered by ``turn``, null first; turns of equal number in the order of a hash of role
and text. Null roles and texts are empty. Rows without a conversation id belong to none and are
left out. Repeated rows are turns of their own. A conversation left without turns is a member
of the root. Without conversations there is no root: the result is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kessan.llm import count_min
from kessan.llm.columns import narrow
from kessan.llm.positions import positioned
from kessan.session import written

#: Turns of a chunk of a conversation; ids of a chunk of a node's ends.
CHUNK = 1024
EMPTY = hashlib.sha256(b"").hexdigest()
_DIGEST = ("d1", "d2")


def ordered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, ordinal, t1, t2, bytes``: every turn as its hashes, with its place (from 1)."""
    role_, text_ = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    light = narrow(df, conv=conv, turn=turn, role=role, text=text).filter("conv IS NOT NULL").select(
        F.col("conv").cast("long").alias("conv"), "turn",
        *(F.xxhash64(F.lit(s), role_, text_).alias(f"t{s}") for s in (1, 2)),
        F.octet_length(text_).cast("long").alias("bytes"),
    )
    order = ("conv", "turn", "t1", "t2")
    placed = positioned(light, *(F.col(c).asc_nulls_first() for c in order), name="turns")
    first = placed.groupBy("conv").agg(F.min("position").alias("first"))
    ordinal = (F.col("position") - F.col("first") + 1).alias("ordinal")
    return written(placed.join(first, "conv").select("conv", ordinal, "t1", "t2", "bytes"), "ordinals")


def grafted(turns: DataFrame, family: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: ``conv, depth, t1, t2, bytes, length`` and ``conv, length``. The
    first h turns of conversation c come from conversation c - c % ``family``, where h is the CRC-32 of
    the decimal c modulo ``most`` + 1; c's own turns after its first h follow."""
    own = turns.groupBy("conv").agg(F.max("ordinal").alias("own"))
    heads = own.select("conv", "own", (F.col("conv") - F.col("conv") % family).alias("donor"),
                       (F.crc32(F.col("conv").cast("string")) % (most + 1)).alias("h"))
    given = own.select(F.col("conv").alias("donor"), F.col("own").alias("given"))
    same = F.col("conv") == F.col("donor")
    head = F.when(same, F.least("h", "own")).otherwise(F.least(F.col("h"), F.coalesce("given", F.lit(0))))
    convs = written(
        heads.join(given, "donor", "left").select("conv", "donor", "h", head.cast("long").alias("head"), "own")
        .withColumn("length", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))),
        "conversations",
    )
    tail = turns.join(convs.select("conv", "h", "head", "length"), "conv").filter("ordinal > h").select(
        "conv", (F.col("ordinal") - F.col("h") + F.col("head")).alias("depth"), "t1", "t2", "bytes", "length"
    )
    kids = convs.filter("head > 0").select("conv", "donor", "head", "length")
    start = turns.filter(F.col("ordinal") <= most).withColumnRenamed("conv", "donor").join(kids, "donor").filter(
        "ordinal <= head").select("conv", F.col("ordinal").alias("depth"), "t1", "t2", "bytes", "length")
    return start.union(tail), convs.select("conv", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with the digest of the prefix that each ends (``d1, d2``), that of its parent
    (``p1, p2``), and the bytes before it (``before``)."""
    chunk = F.floor((F.col("depth") - 1) / CHUNK)
    mixed = turns.select("conv", "depth", "bytes", "length", chunk.alias("chunk"),
                         *(F.xxhash64("depth", "t1", "t2", F.lit(s)).alias(f"m{s}") for s in (1, 2)))
    running = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    within = mixed.select("*", *(F.bit_xor(f"m{s}").over(running).alias(f"x{s}") for s in (1, 2)),
                          F.sum("bytes").over(running).alias("upto"))
    chunks = mixed.groupBy("conv", "chunk").agg(*(F.bit_xor(f"m{s}").alias(f"c{s}") for s in (1, 2)), F.sum("bytes").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    bases = chunks.select("conv", "chunk", *(F.coalesce(F.bit_xor(f"c{s}").over(earlier), zero).alias(f"b{s}") for s in (1, 2)),
                          F.coalesce(F.sum("n").over(earlier), zero).alias("base"))
    both = within.join(bases, ["conv", "chunk"])
    digests = [F.col(f"x{s}").bitwiseXOR(F.col(f"b{s}")) for s in (1, 2)]
    return both.select(
        "conv", "depth", "bytes", "length", *(d.alias(f"d{s}") for s, d in enumerate(digests, 1)),
        *(d.bitwiseXOR(F.col(f"m{s}")).alias(f"p{s}") for s, d in enumerate(digests, 1)),
        (F.col("base") + F.col("upto") - F.col("bytes")).alias("before"),
    )


def screened(rows: DataFrame) -> DataFrame:
    """``rows`` (written) with ``tail``: the parent prefix is proven to have one member."""
    bits = count_min.bits_for(rows.count())
    data = rows.sparkSession.sparkContext.broadcast(count_min.sketch(rows.select(*_DIGEST), bits))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            alone = count_min.estimates(data.value, bits, column["p1"].to_numpy(), column["p2"].to_numpy()) == 1
            alone &= column["depth"].to_numpy() > 1  # the root is nobody's tail
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(alone)], [*column, "tail"])

    return rows.mapInArrow(work, rows.selectExpr("*", "true AS tail").schema)


def _ends(last: DataFrame) -> DataFrame:
    """``d1, d2, ends_sha256``: the hash of the ids that end at each digest, in order. ``last``: ``d1, d2, conv``."""
    placed = positioned(written(last, "ends"), *(F.col(c) for c in (*_DIGEST, "conv")), name="ordered-ends")
    first = placed.groupBy(*_DIGEST).agg(F.min("position").alias("first"))
    chunk = F.floor((F.col("position") - F.col("first")) / CHUNK).alias("chunk")
    texts = placed.join(first, list(_DIGEST)).select(*_DIGEST, chunk, "conv").groupBy(*_DIGEST, "chunk").agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, hashed = None, None
        for batch in batches:
            out = []
            for d1, d2, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (d1, d2) == current:
                    hashed.update(b"," + ids.encode())
                    continue
                if current:
                    out.append((*current, hashed.hexdigest()))
                current, hashed = (d1, d2), hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["d1", "d2", "ends_sha256"])
        if current:
            out = [[current[0]], [current[1]], [hashed.hexdigest()]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["d1", "d2", "ends_sha256"])

    streamed = texts.repartition(*_DIGEST).sortWithinPartitions(*_DIGEST, "chunk").select(*_DIGEST, "ids")
    return streamed.mapInArrow(work, "d1 long, d2 long, ends_sha256 string")


def _exact(rows: DataFrame) -> DataFrame:
    """The nodes of the ``rows`` that may be shared, the root's among them."""
    node = ["depth", *_DIGEST]
    nodes = written(
        rows.groupBy(*node).agg(F.min("conv").alias("rep"), F.max("length").alias("longest"), F.min("before").alias("before")),
        "nodes",
    )
    # Where each conversation's own nodes begin, the bytes before that, and whether it ends in a leaf.
    marks = nodes.select(F.col("rep").alias("conv"), F.col("depth").alias("at"), F.col("before").alias("bytes"),
                         (F.col("longest") == F.col("depth")).alias("leaf"), F.lit(False).alias("ended"))
    ended = rows.filter("depth = length").select("conv", F.col("length") + 1, F.col("before") + F.col("bytes"), F.lit(False), F.lit(True))
    own = written(
        marks.union(ended).groupBy("conv").agg(
            F.min(F.struct("at", "bytes")).alias("own"), (F.bool_or("leaf") | ~F.bool_or("ended")).alias("leaf")
        ).select("conv", F.col("own.at").alias("own"), F.col("own.bytes").alias("own_before"), "leaf"),
        "own-nodes",
    )
    child = (F.col("own") <= F.col("depth") + 1) & (F.col("depth") < F.col("length"))
    count = lambda what: F.sum(what.cast("long"))
    summed = written(
        rows.join(own, "conv").groupBy(*node).agg(
            F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), count(child).alias("n_children"),
            count(F.col("leaf")).alias("n_leaves"),
            count(F.greatest(F.col("own_before") - F.col("before"), F.lit(0))).alias("saved_tokens"),
            F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        ),
        "summed-nodes",
    )
    ends = written(_ends(rows.filter("depth = length").select(*_DIGEST, "conv")), "ended-nodes")
    # Inside its own nodes a conversation is its parent's smallest member; the parents of first own nodes are looked up.
    tops = own.select(F.col("conv").alias("conv_id"), "own")
    placed = summed.join(tops, "conv_id").withColumn("top", F.col("own") == F.col("depth"))
    parents = summed.select(F.col("depth") + 1, "d1", "d2", F.col("conv_id").alias("above")).toDF("depth", "p1", "p2", "above")
    named = placed.filter("top").join(parents, ["depth", "p1", "p2"], "left").withColumn("parent_conv_id", F.col("above"))
    inner = placed.filter("NOT top").withColumn("parent_conv_id", F.col("conv_id"))
    kept = [*node, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return named.select(*kept).union(inner.select(*kept)).join(ends, list(_DIGEST), "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))
    )


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``. ``turns`` and ``convs`` as ``grafted`` gives them."""
    rows = written(screened(written(prefixes(turns), "prefixes")), "screened-prefixes")
    zero: list[Column] = [F.lit(0).cast("long")]
    root = convs.select("conv", F.lit(0).cast("long").alias("depth"), *(z.alias("bytes") for z in zero), "length",
                        *(zero[0].alias(c) for c in ("d1", "d2", "p1", "p2", "before")))
    exact = _exact(written(rows.filter("NOT tail").drop("tail").unionByName(root), "shared-prefixes"))
    one, last = F.lit(1).cast("long"), F.col("depth") == F.col("length")
    tails = rows.filter("tail").select(
        F.col("conv").alias("conv_id"), "depth", F.col("conv").alias("parent_conv_id"), one.alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"), zero[0].alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv").cast("string"), 256)).otherwise(EMPTY).alias("ends_sha256"),
    )
    return exact.drop(*_DIGEST).unionByName(tails)


def conversation_trie(df: DataFrame, family: int = 5, most: int = 8) -> DataFrame:
    """The trie of the conversations of ``df``, rebuilt as ``grafted`` says."""
    return trie(*grafted(ordered_turns(df), family, most))
