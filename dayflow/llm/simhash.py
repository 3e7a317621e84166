"""SimHash near-duplicate groups through a byte-position inverted index.

A text's fingerprint is the bitwise majority of its word shingles' hashes.  Two
64-bit fingerprints at most ``max_bits`` bits apart differ in at most
``max_bits`` of their 8 bytes, so they share at least ``8 - max_bits`` bytes at
the same positions: that is the guaranteed minimum the count filter asks for.

A posting list per single positional byte holds 1/256 of all fingerprints, and
tallying such lists emits a quadratic number of pairs.  The index is therefore
keyed by small *sets* of positional bytes, chosen so that every guaranteed
match of ``8 - max_bits`` positions contains at least one whole set (the sets
of three bytes inside either half: any 5 of 8 positions have 3 in one half).
A pair found under any set is tallied over all eight positions, kept when it
reaches the minimum, and verified by its bit distance.

Lists of up to ``short_list`` fingerprints are paired by a join (so pairs stay
linear in the postings).  Longer lists (families of near copies) are cut into
blocks of ``block_rows`` fingerprints; block pairs go to separate tasks, and
each emits only a spanning forest of its links, so output stays linear in the
fingerprints it read while every link's connection survives.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayflow.llm.common import fresh, stretches
from dayflow.session import materialize

N_BYTES = 8
SEED = 42


def fingerprint_bytes(text: bytes, shingle_words: int = 3, seed: int = SEED) -> int:
    """SimHash of one UTF-8 text as a signed 64-bit integer.

    A-Z are lower-cased, words are split at ASCII white space; fewer words than
    a shingle make one shingle of all of them, none gives zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = shingle_words
    if len(words) <= n:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, seed)).astype(np.int64))
    nexts = list(accumulate([len(w) + 1 for w in words]))   # start of the following word
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, dtype=np.int64)
    starts = [0, *nexts[:len(words) - n]]
    ends = nexts[n - 1:]
    for lo in range(0, len(starts), 65536):
        packed = b"".join([digest(joined[a:b - 1], seed)
                           for a, b in zip(starts[lo:lo + 65536], ends[lo:lo + 65536])])
        bits = np.unpackbits(np.frombuffer(packed, np.uint8).reshape(-1, N_BYTES), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    major = np.packbits(ones * 2 > len(starts))              # most significant bit first
    return int(np.frombuffer(major.tobytes(), ">i8")[0])


def fingerprint(text: Column, shingle_words: int = 3, seed: int = SEED) -> Column:
    """Column form of :func:`fingerprint_bytes` (null text: as the empty text)."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in stretches(b.cast(pa.binary()) for b in batches):
            yield pa.array([fingerprint_bytes(t or b"", shingle_words, seed) for t in texts],
                           pa.int64())
    return F.arrow_udf(run, "bigint")(text)


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def index_sets(max_bits: int = 3) -> list[tuple[int, ...]]:
    """Byte-position sets such that each ``8 - max_bits`` positions contain one.

    The positions are halved; of any m positions, one half has ceil(m / 2).
    """
    size = (N_BYTES - max_bits + 1) // 2
    if size < 1:
        raise ValueError("max_bits must leave at least one shared byte")
    return [c for half in (range(4), range(4, 8)) for c in combinations(half, size)]


def _mask(positions: tuple[int, ...]) -> int:
    m = sum(0xFF << (8 * p) for p in positions)
    return m - (1 << 64) if m >= 1 << 63 else m


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the given links (union-find over their ends)."""
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(ids)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = []
    for i, (x, y) in enumerate(zip(flat[:len(a)].tolist(), flat[len(a):].tolist())):
        rx, ry = find(x), find(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            keep.append(i)
    return a[keep], b[keep]


def links_between(a: np.ndarray, b: np.ndarray, max_bits: int,
                  min_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs of ``a`` x ``b`` within ``max_bits`` bits.

    Pairs are taken in strips; shared positional bytes are tallied first, and
    only pairs reaching ``min_bytes`` have their bits counted.  Strips' forests
    are merged as they come, so memory stays linear in the two blocks.
    """
    left, right = np.empty(0, np.int64), np.empty(0, np.int64)
    width = max(1, 2_000_000 // max(1, len(b)))
    for lo in range(0, len(a), width):
        x = a[lo:lo + width, None] ^ b[None, :]
        shared = (x.view(np.uint8).reshape(*x.shape, N_BYTES) == 0).sum(axis=2, dtype=np.uint8)
        i, j = np.nonzero(shared >= min_bytes)
        ok = np.bitwise_count(x[i, j].view(np.uint64)) <= max_bits
        i, j = i[ok] + lo, j[ok]
        ok = a[i] != b[j]
        left, right = _forest(np.concatenate([left, a[i[ok]]]),
                              np.concatenate([right, b[j[ok]]]))
    return left, right


def links(fps: DataFrame, max_bits: int = 3, short_list: int = 32,
          block_rows: int = 1024) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fps(fp)``.

    Every two fingerprints within ``max_bits`` bits are connected in the result
    (short lists give each such pair, long lists a spanning forest of them).
    """
    min_bytes = N_BYTES - max_bits
    sets = index_sets(max_bits)
    posted = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("s"), F.col("fp").bitwiseAND(F.lit(_mask(p))).alias("key"))
        for k, p in enumerate(sets)])).alias("e")).select("fp", "e.s", "e.key")
    # a long list of n members gets ceil(n / block_rows) blocks; 0 marks a short one
    sizes = (posted.groupBy("s", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
             .select("s", "key", F.when(F.col("n") <= short_list, 0)
                     .otherwise(F.ceil(F.col("n") / block_rows)).cast("int").alias("blocks")))
    listed = posted.join(sizes, ["s", "key"])
    x = F.col("a").bitwiseXOR(F.col("b"))
    tally = sum((F.when(F.shiftright(x, 8 * p).bitwiseAND(F.lit(0xFF)) == 0, 1).otherwise(0)
                 for p in range(N_BYTES)), F.lit(0))
    small = listed.filter("blocks = 0").select("s", "key", "fp")
    pairs = (small.withColumnRenamed("fp", "a")
             .join(small.withColumnRenamed("fp", "b"), ["s", "key"])
             .filter("a < b").select("a", "b")
             .filter(tally >= min_bytes).filter(F.bit_count(x) <= max_bits)
             .dropDuplicates(["a", "b"]))
    # long lists: each member goes to every pair of blocks its own block is in
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    big = (listed.filter("blocks > 0").withColumn("own", mine)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("s", "key", "fp", "own",
                   F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")))

    def join_blocks(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        fp, own = pdf["fp"].to_numpy(), pdf["own"].to_numpy()
        left = fp[own == key[2]]
        right = left if key[2] == key[3] else fp[own == key[3]]
        a, b = links_between(left, right, max_bits, min_bytes)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    dense = big.groupBy("s", "key", "lo", "hi").applyInPandas(join_blocks, "a bigint, b bigint")
    return pairs.unionByName(dense)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: link a node's neighbours to the smallest id around it.

    Edges point from the larger to the smaller id.  The large step moves the
    larger neighbours of each node, the small step the smaller ones.
    """
    seen = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        seen = seen.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = (seen.groupBy("u").agg(F.min("v").alias("m"))
             .select("u", F.least("u", "m").alias("m")))
    moved = seen.join(least, "u")
    if large:
        moved = moved.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = (moved.select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    return moved.filter("a <> b").dropDuplicates(["a", "b"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root: smallest node id.

    Alternating star contraction: both steps keep connectivity and shrink the
    graph to stars in a logarithmic number of rounds.  Every round is written
    to the shared checkpoint root, which cuts lineage and survives executor
    loss; only a row count and a checksum reach the driver.
    """
    def mark(df: DataFrame) -> tuple:
        h = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(df.agg(F.count(F.lit(1)), F.sum(h)).first())

    cur = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .filter("a <> b").dropDuplicates(["a", "b"]), "simhash-links")
    last = mark(cur)
    for _ in range(max_rounds):
        if not last[0]:
            break
        cur = materialize(_star(_star(cur, True), False), "simhash-stars")
        now = mark(cur)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))


def classes(rows: DataFrame, id_col: str, max_bits: int = 3, short_list: int = 32,
            block_rows: int = 1024) -> DataFrame:
    """``(fp, component_id)`` for every distinct ``fp`` of ``rows(id_col, fp)``.

    ``component_id`` is the smallest non-null id reachable through links (null
    if a class has none).  Equal fingerprints are one node, so exact copies add
    no pairs however many there are.  ``rows`` should be a written table: it is
    read more than once.
    """
    nodes = rows.groupBy("fp").agg(F.min(id_col).alias("least"))
    nodes = materialize(nodes, "simhash-nodes")
    found = components(links(nodes, max_bits, short_list, block_rows))
    rooted = (nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    shingle_words: int = 3, max_bits: int = 3, short_list: int = 32,
                    block_rows: int = 1024) -> DataFrame:
    """One row ``(id_col, fp, component_id)`` per row of ``df``.

    Null and empty texts have fingerprint zero and are linked like any other;
    repeated rows and null ids keep one row each; other columns are not read.
    """
    rows = materialize(df.select(F.col(id_col), fingerprint(F.col(text_col), shingle_words)
                                 .alias("fp")), "simhash-fp")
    return (rows.join(classes(rows, id_col, max_bits, short_list, block_rows), "fp")
            .select(id_col, "fp", "component_id"))


def keep_one(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
             shingle_words: int = 3, max_bits: int = 3) -> DataFrame:
    """Rows of ``df``, one of each near-duplicate class: that of the smallest id.

    All columns are kept.  Rows that share the smallest id are told apart by a
    row number fixed when the fingerprinted table is written.
    """
    cols = df.columns
    fp, rid = fresh(df, "_simhash_fp"), fresh(df, "_simhash_row")
    staged = materialize(df.withColumn(fp, fingerprint(F.col(text_col), shingle_words))
                         .withColumn(rid, F.monotonically_increasing_id()), "simhash-rows")
    narrow = staged.select(F.col(id_col).alias("id"), F.col(fp).alias("fp"),
                           F.col(rid).alias("rid"))
    best = (narrow.join(classes(narrow, "id", max_bits).withColumnRenamed("component_id", "c"),
                        "fp")
            .groupBy("c").agg(F.min(F.struct(F.isnull("id"), "id", "rid")).alias("best"))
            .select(F.col("best.rid").alias(rid)))
    return staged.join(best, rid, "left_semi").select(*cols)
