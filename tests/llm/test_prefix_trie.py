import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from dayflow.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def words(text):
    return len([w for w in text.translate({c: 32 for c in range(9, 14)}).split(" ") if w])


def brute(convs):
    """``{conv: [(role, text)]}`` -> sorted node tuples in the order of the result."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * words(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]),
                    leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(df, **kw).collect()), key=str)


def as_rows(convs):
    return [(c, i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]


def random_convs(n, seed, length=8, choices=3):
    r = random.Random(seed)
    return {c: [(r.choice(("user", "bot")), " ".join("w" * r.randint(1, choices)))
                for _ in range(r.randint(1, length))] for c in range(n)}


@pytest.mark.parametrize("batches", [(1.0,), (1 / 16, 1.0), (0.1, 0.3, 0.6, 1.0)])
def test_against_brute_force(spark, batches):
    convs = random_convs(120, 1)
    for c in range(200, 260):                     # a third share one conversation
        convs[c] = convs[3]
    assert nodes(spark, as_rows(convs), batches=batches) == brute(convs)


def test_long_chains_and_late_splits(spark):
    r = random.Random(4)
    spine = [("user", f"t{i}") for i in range(70)]
    convs = {c: spine[:r.randint(1, 70)] + [("bot", f"x{r.randint(0, 3)}")] * r.randint(0, 3)
             for c in range(40)}
    convs[99] = spine
    assert nodes(spark, as_rows(convs), batches=(0.2, 0.5, 1.0)) == brute(convs)


def test_odd_rows(spark):
    rows = [(1, None, "user", "a b"), (1, 0, None, None), (1, 1, "user", ""), (2, 5, "user", "a b"),
            (2, 7, None, ""), (None, 0, "user", "z"), (3, 0, "user", "a b"), (3, 0, "user", "a b"),
            (-7, 0, "user", "a\tb c\n")]
    convs = {1: [("user", "a b"), ("", ""), ("user", "")], 2: [("user", "a b"), ("", "")],
             3: [("user", "a b")] * 2, -7: [("user", "a\tb c\n")]}
    assert nodes(spark, rows) == brute(convs)
    assert nodes(spark, []) == [] and nodes(spark, [(None, 1, "a", "b")]) == []


def test_rows_that_share_a_turn_have_one_order(spark):
    rows = [(1, 0, "user", f"text {i}") for i in range(20)] + [(1, 0, "bot", "b")]
    first = nodes(spark, rows)
    assert nodes(spark, rows[::-1]) == first and len(first) == 22


def test_conversations_without_turns(spark):
    arrays = spark.createDataFrame([(1, []), (2, [])],
                                   "conv long, turns array<struct<turn:binary,words:bigint>>")
    got = prefix_trie.expand(prefix_trie.build(spark, arrays)).collect()
    assert [tuple(r) for r in got] == [(1, 0, None, 2, 0, 1, 0, hashlib.sha256(b"1,2").hexdigest())]


def test_extra_columns_take_no_part(spark):
    convs = random_convs(10, 6)
    df = spark.createDataFrame(as_rows(convs), SCHEMA).withColumns(
        {c: F.lit("mine") for c in ("sig", "path", "key", "depth", "conv", "words")})
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(df).collect()), key=str)
    assert got == brute(convs)


def test_ids_of_several_runs_are_digested_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_TOGETHER", 4)
    convs = {c: [("user", "same")] for c in range(-9, 40)}
    assert nodes(spark, as_rows(convs)) == brute(convs)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 500), st.integers(1, 500))
def test_two_fattest(spark, low, more):
    def fat(x):
        return (x & -x)
    want = max(range(low + 1, low + more + 1), key=fat)
    got = spark.range(1).select(prefix_trie.two_fattest(
        F.lit(low).cast("bigint"), F.lit(low + more).cast("bigint"))).first()[0]
    assert got == want


def test_handles_find_every_exit(spark):
    """Fat binary search against a scan of all prefixes."""
    convs = random_convs(60, 8, length=12)
    arrays = prefix_trie.turn_arrays(spark.createDataFrame(as_rows(convs), SCHEMA))
    trie = prefix_trie.build(spark, arrays.filter("conv < 30"), (0.3, 1.0))
    sigs = {bytes(r.sig): r.depth for r in trie.nodes.select("sig", "depth").collect()}
    paths = {bytes(p.sig) for r in trie.nodes.select("path").collect() for p in r.path}
    chains = arrays.select(F.col("conv").cast("string").cast("binary").alias("key"),
                           prefix_trie.chained(F.col("turns")).alias("path"))
    keys = chains.withColumn("length", F.size("path").cast("bigint"))
    for r in prefix_trie._exits(keys, trie.nodes, 12).collect():
        chain = [bytes(p.sig) for p in r.path]
        assert r.low == max([d + 1 for d, s in enumerate(chain) if s in sigs], default=0)
        assert r.shared == max([d + 1 for d, s in enumerate(chain) if s in paths], default=0)
        assert (r.split is not None) == (r.shared > r.low)


def test_query_against_rebuilt_conversations(spark):
    import zlib

    import pyarrow.parquet as pq

    from dayflow.llm.queries import QUERIES
    own = defaultdict(list)
    for r in pq.read_table(f"{SF001}/conversations.parquet").to_pylist():
        own[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    own = {c: [t[1:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + t[h:]
    got = sorted((tuple(r) for r in QUERIES["op11_prefix_trie"](spark, SF001).collect()), key=str)
    assert got == brute(built)
