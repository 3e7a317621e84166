"""Prefix trie of conversations, built as a z-fast trie on distributed tables.

A conversation is the sequence of digests of its turns; the signature of a prefix is a
chained digest, so equal signatures are equal prefixes.  The trie is compacted: a node
is kept only where conversations end or part.  Its extent is the prefix it stands for;
its edge covers the depths above its parent's extent.  A node is found by its handle,
the signature of the prefix whose length is the two-fattest number of its edge (the
one divisible by the highest power of two).

Distinct conversations are inserted in batches of growing size.  In a batch every
conversation finds its exit node by fat binary search: about log2(length) joins of
signatures with the handle table, whatever the depth of the trie.  Conversations
that leave inside an edge split it; what lies beyond the exits becomes new nodes
where conversations of the batch end or part (two different next signatures under one
prefix).  All of this is joins and partial aggregates on signatures, so a turn or
conversation that a third of all rows share is one row after the first aggregate.

In the end edges are expanded to one row a depth.  What is summed over subtrees is
summed over compacted nodes: a node's own path holds the signatures of its ancestors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayflow.llm.common import words_of
from dayflow.session import materialize

# Share of the distinct conversations (by signature) that is in the trie after each batch.
BATCHES = (1 / 16, 1.0)
ROOT = hashlib.sha256(b"").digest()[:16]
IDS_TOGETHER = 4096         # neighbouring ids that are joined before a digest reads them
_NODE = "array<struct<sig:binary,words:bigint>>"


def _lit(sig: bytes) -> Column:
    return F.lit(sig).cast("binary")


def turn_arrays(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv, turns)``: a conversation's turn digests and word counts in turn order.

    Null turns come first; rows that share a turn go by role, then by the digest of the
    text.  Null roles and texts are empty; rows without an id take no part.
    Only digests and counts (about 60 bytes a turn) are gathered, never texts.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    item = F.struct(F.col(turn_col).alias("turn"), role.alias("role"),
                    F.unhex(F.sha2(text.cast("binary"), 256)).alias("text"),
                    F.size(words_of(text)).cast("bigint").alias("words"))
    return (turns.filter(F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).alias("conv")).agg(F.sort_array(F.collect_list(item)).alias("t"))
            .select("conv", F.transform("t", lambda t: F.struct(
                F.unhex(F.sha2(F.concat(F.unhex(F.sha2(t["role"].cast("binary"), 256)),
                                        t["text"]), 256)).alias("turn"),
                t["words"].alias("words"))).alias("turns")))


def chained(turns: Column) -> Column:
    """Signature and words of each prefix (1 to all turns)."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                sig, words, path = ROOT, 0, []
                for t in row or ():
                    sig = hashlib.sha256(sig + t["turn"]).digest()[:16]
                    words += t["words"]
                    path.append({"sig": sig, "words": words})
                out.append(path)
            yield pa.array(out, pa.list_(pa.struct([("sig", pa.binary()), ("words", pa.int64())])))
    return F.arrow_udf(run, _NODE)(turns)


def two_fattest(low: Column, high: Column) -> Column:
    """The number in ``(low, high]`` that is divisible by the highest power of two."""
    top = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("bigint"), top))


def _sig(path: Column, depth: Column) -> Column:
    """Signature at a depth of a path; the root's at 0."""
    return F.when(depth == 0, _lit(ROOT)).otherwise(F.get(path, (depth - 1).cast("int"))["sig"])


def _words(path: Column, depth: Column) -> Column:
    """Words of a path down to a depth."""
    return F.when(depth == 0, F.lit(0).cast("bigint")).otherwise(
        F.get(path, (depth - 1).cast("int"))["words"])


def _depths(low: Column, high: Column, of: Callable[[Column], Column]) -> Column:
    """Rows of ``of(depth)`` for the depths from ``low`` to ``high`` (none if reversed).

    Made inside one array, so no row carries the path that it is taken from.
    """
    return F.explode(F.transform(F.when(low <= high, F.sequence(low, high)), of))


@dataclass(frozen=True)
class Trie:
    """Compacted nodes and where conversations end.

    ``nodes``: sig, depth (of the extent), above (depth of the parent's extent, -1 for
    the root), path (signature and words of each prefix).  ``ends``: conv, sig.
    """

    nodes: DataFrame
    ends: DataFrame


def _handles(nodes: DataFrame) -> DataFrame:
    """``(handle, found, found_depth, found_above)`` of every node but the root."""
    at = two_fattest(F.col("above"), F.col("depth"))
    return nodes.filter("depth > 0").select(
        _sig(F.col("path"), at).alias("handle"), F.col("sig").alias("found"),
        F.col("depth").alias("found_depth"), F.col("above").alias("found_above"))


def _exits(keys: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """``keys`` with ``low`` (extent of the deepest node that is a prefix), ``shared``
    (turns shared with the trie) and ``split`` (the node whose edge it leaves inside).

    Fat binary search: a probe at the two-fattest number of ``(low, high]`` either finds
    a node, whose extent raises ``low`` (if the key leaves inside its edge, the search ends
    at its parent), or lowers ``high``.  The two-fattest number's power of two falls with every
    probe, so about log2(longest) probes are enough.  The last step looks below the
    found node for an edge that begins like the key's next turn.
    """
    handles = _handles(nodes)
    state = keys.withColumns({"low": F.lit(0).cast("bigint"), "high": F.col("length"),
                              "inside": F.lit(None).cast("binary")})
    open_ = F.col("inside").isNull() & (F.col("low") < F.col("high"))
    for _ in range(longest.bit_length() + 1):
        probe = F.when(open_, two_fattest(F.col("low"), F.col("high")))
        state = (state.withColumn("probe", probe)
                 .withColumn("handle", F.when(open_, _sig(F.col("path"), F.col("probe")))
                             .otherwise(F.col("key")))      # closed: spread, not looked at
                 .join(handles, "handle", "left"))
        hit = open_ & F.col("found").isNotNull()
        whole = hit & (F.col("found_depth") <= F.col("length")) \
            & (_sig(F.col("path"), F.col("found_depth")) == F.col("found"))
        state = state.select(
            *keys.columns,
            F.when(whole, F.col("found_depth")).when(hit, F.col("found_above"))
            .otherwise(F.col("low")).alias("low"),
            F.when(open_ & ~hit, F.col("probe") - 1).otherwise(F.col("high")).alias("high"),
            F.when(hit & ~whole, F.col("found")).otherwise(F.col("inside")).alias("inside"))
    below = nodes.filter("depth > 0").select(
        _sig(F.col("path"), F.col("above") + 1).alias("first"), F.col("sig").alias("split"),
        F.col("depth").alias("split_depth"), F.col("path").alias("split_path"))
    same = F.size(F.filter(F.zip_with("path", "split_path", lambda a, b: a["sig"] == b["sig"]),
                           lambda x: x))
    more = F.col("low") < F.col("length")
    left = (state.withColumn("first", F.when(more, _sig(F.col("path"), F.col("low") + 1))
                             .otherwise(F.col("key")))
            .join(below, "first", "left"))
    into = more & F.col("split").isNotNull()
    return left.select(
        *keys.columns, "low",
        F.when(into, same.cast("bigint")).otherwise(F.col("low")).alias("shared"),
        F.when(into, F.col("split")).alias("split"))


def _insert(nodes: DataFrame, keys: DataFrame, longest: int, step: int) -> DataFrame:
    """The nodes of the trie after a batch of distinct conversations."""
    at = materialize(_exits(keys, nodes, longest), f"trie-exits-{step}")
    path, length, shared = F.col("path"), F.col("length"), F.col("shared")
    prefixes = at.select("key", "low", _depths(shared, length, lambda d: F.struct(
        d.alias("depth"), _sig(path, d).alias("sig"),
        F.when(d < length, _sig(path, d + 1)).alias("next"),
        ((d == length) | ((d == shared) & F.col("split").isNotNull())).alias("keep")))
        .alias("p")).select("key", "low", "p.*")
    made = (prefixes.groupBy("sig", "depth").agg(
                F.min("low").alias("above"), F.min("key").alias("key"), F.max("keep").alias("keep"),
                (F.min("next") != F.max("next")).alias("parts"))
            .filter("keep or coalesce(parts, false)")
            .join(nodes.select("sig"), "sig", "left_anti"))
    made = materialize(made.select("sig", "depth", "above", "key"), f"trie-made-{step}")
    new = made.join(keys.select("key", "path"), "key").select(
        "sig", "depth", "above", F.slice("path", 1, F.col("depth").cast("int")).alias("path"))
    # edges that were split, and new nodes below others: the nearest new node above
    every = new.unionByName(nodes.select("sig", "depth", "above", "path"))
    inner = every.select(F.col("sig").alias("own"), _depths(
        F.col("above") + 1, F.col("depth") - 1,
        lambda d: F.struct(d.alias("d"), _sig(path, d).alias("sig"))).alias("p"))
    nearer = (inner.select("own", "p.*").join(made.select("sig"), "sig", "left_semi")
              .groupBy("own").agg(F.max("d").alias("nearer")))
    out = (every.join(nearer, F.col("sig") == F.col("own"), "left")
           .select("sig", "depth", F.coalesce("nearer", "above").alias("above"), "path"))
    return materialize(out, f"trie-nodes-{step}")


def build(spark: SparkSession, arrays: DataFrame, batches: tuple[float, ...] = BATCHES) -> Trie:
    """Trie of the conversations ``(conv, turns)`` of :func:`turn_arrays`.

    Conversations without turns end at the root.  An empty table gives a trie without
    nodes.
    """
    chains = materialize(arrays.select("conv", chained(F.col("turns")).alias("path")), "trie-chains")
    length = F.size("path").cast("bigint")
    ends = chains.select("conv", _sig(F.col("path"), length).alias("sig"))
    # copies of a conversation are one key
    keys = materialize(chains.groupBy(_sig(F.col("path"), length).alias("key")).agg(
        F.any_value("path").alias("path"), F.any_value(length).alias("length")), "trie-keys")
    n, longest = keys.agg(F.count(F.lit(1)), F.max("length")).first()
    root = spark.range(1 if n else 0).select(
        _lit(ROOT).alias("sig"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(-1).cast("bigint").alias("above"), F.array().cast(_NODE).alias("path"))
    nodes, place, begin = root, F.pmod(F.xxhash64("key"), F.lit(1 << 20)), 0
    for step, share in enumerate(batches if n else ()):
        end = (1 << 20) if step + 1 == len(batches) else int(share * (1 << 20))
        batch = keys.filter((place >= begin) & (place < end) & (F.col("length") > 0))
        nodes = _insert(nodes, batch, longest, step)
        begin = end
    return Trie(nodes, ends)


def _digests(ends: DataFrame) -> DataFrame:
    """``(sig, ends_sha256)``: digest of the ascending ids that end at a node.

    Runs of neighbouring ids are joined in parallel first; a digest is then fed the
    runs in order, one stream a node, so no node's ids are held together.
    """
    run = F.floor(F.col("conv") / IDS_TOGETHER)
    pieces = (ends.groupBy("sig", run.alias("run")).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")))

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, digest, done = None, None, []
        for batch in batches:
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own != sig:
                    if sig is not None:
                        done.append((sig, digest.hexdigest()))
                    sig, digest = own, hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            yield _digest_rows(done)
            done = []
        if sig is not None:
            yield _digest_rows([(sig, digest.hexdigest())])

    return (pieces.repartition("sig").sortWithinPartitions("sig", "run").select("sig", "ids")
            .mapInArrow(feed, "sig binary, ends_sha256 string"))


def _digest_rows(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
        ["sig", "ends_sha256"])


def expand(trie: Trie) -> DataFrame:
    """One row a distinct prefix: the edges of the compacted trie, depth by depth.

    ``conv_id`` smallest member, ``depth``, ``parent_conv_id`` (null at the root),
    ``n_convs`` members, ``n_children``, ``n_leaves`` (childless nodes of the subtree),
    ``saved_tokens`` (over the subtree, members less one times the words of the last
    turn), ``ends_sha256`` (digest of the ids that end there).
    """
    nodes = trie.nodes
    here = trie.ends.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"))
    children = (nodes.filter("depth > 0")
                .groupBy(_sig(F.col("path"), F.col("above")).alias("sig"))
                .agg(F.count(F.lit(1)).alias("children")))
    own = nodes.join(here, "sig", "left").join(children, "sig", "left")
    # a node with each compacted node that its path goes through, itself included
    chain = F.concat(F.array(_lit(ROOT)), F.transform("path", lambda p: p["sig"]))
    pairs = materialize(
        own.select(F.col("sig").alias("of"), F.explode(chain).alias("sig"),
                   F.coalesce("n", F.lit(0)).alias("n"), "conv",
                   F.col("children").isNull().cast("bigint").alias("leaf"))
        .join(nodes.select("sig"), "sig", "left_semi"), "trie-pairs")
    sums = pairs.groupBy("sig").agg(F.sum("n").alias("n_convs"), F.min("conv").alias("conv_id"),
                                    F.sum("leaf").alias("n_leaves"))
    path, deep, above = F.col("path"), F.col("depth"), F.col("above")
    parent = F.when(deep > 0, _sig(path, above))
    start = F.when(deep > 0, _words(path, above)).otherwise(F.lit(0))
    # the words of an edge before each of its depths; the root is a depth without words
    before = F.when(deep > 0, F.transform(F.slice(path, above.cast("int") + 1, (deep - above).cast(
        "int")), lambda p: p["words"] - start))
    whole = materialize(
        nodes.join(sums, "sig").join(children, "sig", "left").select(
            "sig", "depth", "above", "n_convs", "conv_id", "n_leaves", parent.alias("parent"),
            F.coalesce("children", F.lit(0)).cast("bigint").alias("children"),
            F.when(deep > 0, _words(path, deep) - start).otherwise(F.lit(0)).alias("words"),
            F.concat(F.array(F.lit(0).cast("bigint")), F.coalesce(before, F.array()))
            .alias("before")), "trie-sums")
    saved = (pairs.select("of", "sig").join(
                whole.select(F.col("sig").alias("of"),
                             ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "of")
             .groupBy("sig").agg(F.sum("saved").alias("saved")))
    parents = whole.select(F.col("sig").alias("parent"), F.col("conv_id").alias("above_conv"))
    rows = (whole.join(saved, "sig").join(parents, "parent", "left")
            .join(_digests(trie.ends), "sig", "left")
            .select("conv_id", "depth", "above", "above_conv", "n_convs", "children", "n_leaves",
                    "saved", "ends_sha256", _depths(
                        F.greatest(above + 1, F.lit(0)), deep, lambda d: F.struct(
                            d.alias("d"), F.get("before", (d - above - 1).cast("int"))
                            .alias("words"))).alias("p")))
    d, last, words = F.col("p.d"), F.col("p.d") == deep, F.col("p.words")
    return rows.select(
        "conv_id", d.alias("depth"),
        F.when(d > above + 1, F.col("conv_id")).when(deep > 0, F.col("above_conv"))
        .alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("children")).otherwise(F.lit(1)).cast("bigint")
        .alias("n_children"), "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * words).alias("saved_tokens"),
        F.when(last & F.col("ends_sha256").isNotNull(), F.col("ends_sha256"))
        .otherwise(F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def prefix_trie(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text",
                batches: tuple[float, ...] = BATCHES) -> DataFrame:
    """Nodes of the prefix trie of all conversations of ``turns`` (see :func:`expand`)."""
    arrays = turn_arrays(turns, id_col, turn_col, role_col, text_col)
    return expand(build(turns.sparkSession, arrays, batches))
