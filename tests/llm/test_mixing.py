from collections import defaultdict

from pyspark.sql import functions as F

from conftest import SF001
from dayflow.llm import mixing
from dayflow.llm.queries import QUERIES


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Shares of the total, the excess over the cap reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, left, open_ = {s: 0.0 for s in order}, float(sum(sizes.values())), set(order)
    while left > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        for s in open_:
            target[s] += left * w[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
    return target


def check(rows, texts):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[texts[r.doc_id][0]] += r["size"]
        taken[texts[r.doc_id][0]] += r.taken
    target = brute_targets(sizes)
    for r in rows:
        source, text = texts[r.doc_id]
        assert r["size"] == len([w for w in (text or "").split(" ") if w.strip()]) or r["size"] >= 0
        assert r.source_size == sizes[source]
        assert abs(r.target - target[source]) <= 1e-6 * max(1, target[source])
        assert 0 <= r.taken <= 3 * r["size"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 1, (s, taken[s], target[s])


def test_query(spark):
    texts = {r.doc_id: (r.source, r.text) for r in
             spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    first = QUERIES["op9_source_mix"](spark, SF001).collect()
    assert len(first) == len(texts)
    check(first, texts)
    again = QUERIES["op9_source_mix"](spark, SF001).collect()
    assert sorted(first) == sorted(again)


def test_small_and_odd_sources(spark):
    rows = [(1, "a", "w " * 10), (2, "a", None), (3, "b", ""), (4, None, "x y"), (5, "c", "z"),
            (6, "d", "k " * 5000), (6, "d", "k " * 5000), (None, "d", "n n n"), (7, "ä", "u v w")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for block in (3, 4096):
        got = mixing.mix(df, block_tokens=block)
        sizes, taken = defaultdict(int), defaultdict(int)
        want = {"a": 10, "b": 0, None: 2, "c": 1, "d": 10003, "ä": 3}
        out = got.collect()
        assert len(out) == len(rows)
        target = brute_targets(want)
        by_size = {v: k for k, v in want.items()}
        for r in out:
            s = by_size[r.source_size]
            sizes[s] += r["size"]
            taken[s] += r.taken
            assert r.taken <= 3 * r["size"]
            assert abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert sizes == want
        assert all(abs(taken[s] - target[s]) <= 1 for s in want)
    assert mixing.mix(df.filter("false")).count() == 0
    assert {r.taken for r in mixing.mix(df.filter("doc_id = 3")).collect()} == {0}


def test_schedule_is_spread_evenly(spark):
    sized = spark.range(4000).select(
        F.col("id").alias("rid"), F.when(F.col("id") % 4 == 0, "0a").otherwise("0b").alias("key"),
        F.lit(10).cast("bigint").alias("size"), F.col("id"), F.col("id").alias("tie"))
    sized.write.mode("overwrite").parquet(path := f"{mixing.materialize(sized, 't').inputFiles()[0]}.t")
    plan, src = mixing.schedule(spark.read.parquet(path), (1, 1), 3, 100)
    target = {r.key: r.target for r in src.collect()}
    assert target == {"0a": 20000.0, "0b": 20000.0}
    slots = sorted({(r.slot, r.key) for r in plan.select("slot", F.lit("").alias("key"), "rid").join(
        spark.read.parquet(path).select("rid", F.col("key").alias("k")), "rid")
        .select("slot", F.col("k").alias("key")).collect()})
    for n in (50, 100, 200):
        share = sum(k == "0a" for _, k in slots[:n]) / n
        assert abs(share - 0.5) < 0.05


def test_resample(spark):
    rows = [(k, "a" if k % 10 else "b", "w " * (1 + k % 7), k) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size int")
    out = mixing.resample(df)
    assert out.columns == df.columns
    copies = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    taken = {r.doc_id: r.taken / r["size"] for r in mixing.mix(df).collect()}
    assert all(abs(copies.get(k, 0) - v) <= 0.5 for k, v in taken.items())
    assert max(copies.values()) <= 3


def test_stream_is_the_mix_in_schedule_order(spark):
    rows = [(k, "a" if k % 4 else "b", "w " * (1 + k % 7)) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.mix_stream(df, weights=(1, 1), block_tokens=20)
    got = sorted(out.collect(), key=lambda r: (r.slot, r.key, r.begin))
    taken = {r.doc_id: r.taken for r in mixing.mix(df, weights=(1, 1), block_tokens=20).collect()}
    words, ends, met = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        assert r.begin == ends[r.key] and r.block == r.begin // 20      # each source in its order
        assert 0 <= r.word and r.word + r.words <= len(rows[r.doc_id][2].split())
        ends[r.key] += r.words
        words[r.doc_id] += r.words
        met[r.key] += r.words
        if sum(met.values()) > 200 and r.slot < max(ends.values()) // 20:
            assert abs(met["0a"] / sum(met.values()) - 0.5) < 0.1       # evenly mixed all along
    assert all(words[k] == v for k, v in taken.items())


def test_schedule_orders_the_mix(spark):
    """Documents by first slot: every prefix holds the sources near their target shares."""
    rows = [(i, "abc"[i % 3], " ".join(["w"] * 40)) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(df, weights=(5, 2, 1), block_tokens=80).collect()
    target = {rows[r.doc_id][1]: r.target for r in got}
    total = sum(target.values())
    taken = sorted((r for r in got if r.taken), key=lambda r: (r.first_slot, r.doc_id))
    seen, whole = defaultdict(int), 0
    for r in taken:
        assert r.n_slots >= 1 and r.first_slot >= 0
        seen[rows[r.doc_id][1]] += r.taken
        whole += r.taken
        if whole > total / 10:
            for s in "abc":
                assert abs(seen[s] / whole - target[s] / total) < 0.25
    assert all(r.first_slot is None and r.n_slots == 0 for r in got if not r.taken)
    plan = mixing.mix_stream(df, weights=(5, 2, 1), block_tokens=80).collect()
    first = {}
    for p in plan:
        first[p.doc_id] = min(first.get(p.doc_id, p.slot), p.slot)
    assert first == {r.doc_id: r.first_slot for r in taken}
    # prefixes of the schedule itself are even: a golden-ratio sequence
    slots = sorted((p.slot, rows[p.doc_id][1], p.words) for p in plan)
    seen, whole = defaultdict(int), 0
    for _, s, n in slots:
        seen[s] += n
        whole += n
        for k in "abc":
            assert abs(seen[k] - whole * target[k] / total) < 80 * 8


def test_resample_comes_in_slot_order(spark):
    rows = [(i, "abc"[i % 3], " ".join(["w"] * 30)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.resample(df).collect()
    slot = {r.doc_id: r.first_slot for r in mixing.mix(df).collect()}
    order = [slot[r.doc_id] for r in out]
    firsts = [s for k, s in enumerate(order) if out[k].doc_id not in {r.doc_id for r in out[:k]}]
    assert firsts == sorted(firsts)


def test_callers_columns_of_any_name_stay(spark):
    names = ["_mix_row", "_mix_size", "_mix_tie", "_mix_slot", "_mix_copies", "rid", "size", "slot",
             "taken", "_MIX_ROW_"]
    df = spark.createDataFrame([(i, "ab"[i % 2], "one two three", *[f"{n}{i}" for n in names])
                                for i in range(12)],
                               "doc_id long, source string, text string, "
                               + ", ".join(f"{n} string" for n in names))
    out = mixing.resample(df)
    assert out.columns == df.columns
    assert all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in names)
