import zlib

import numpy as np

from conftest import SF001
from dayflow.llm import toxicity as T
from dayflow.llm.queries import QUERIES


def tiny(n=120, seed=0):
    r = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(300)]
    texts, labels = [], []
    for k in range(n):
        t = list(r.choice(words, r.integers(5, 90)))
        if k % 3 == 0:
            t.insert(int(r.integers(0, len(t))), "grubnik,")
        texts.append(" ".join(t))
        labels.append(int(k % 3 == 0))
    return texts, labels


def test_windows_cover_the_text():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        starts = T.window_starts(n)
        covered = {s + i for s in starts for i in range(T.WINDOW)}
        assert set(range(n)) <= covered
        assert all(b - a <= T.STRIDE for a, b in zip(starts, starts[1:]))


def test_gradients():
    rng = np.random.default_rng(1)
    m = T._initial({}, np.zeros(1, np.float32), 1)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    old = T.F32
    T.F32 = np.float64
    try:
        table = rng.standard_normal((2, 9, 3 * T.HIDDEN))
        ids = rng.integers(0, 9, (4, 6))
        ids[:, 0] = 1
        y = np.array([0.0, 1, 1, 0])
        _, grad, d_table = T._backward(m, table, ids, y)

        def loss():
            p = 1 / (1 + np.exp(-m.forward(table, ids)[0]))
            return -np.mean(np.log(np.where(y > 0, p, 1 - p) + 1e-7))
        for name, g in [*grad.items(), ("table", d_table)]:
            if name == "table":
                value, g = table, g.reshape(9, 2, -1).transpose(1, 0, 2)
            else:
                value = m.p[name]
            for _ in range(6):
                at = tuple(int(rng.integers(0, s)) for s in value.shape)
                if name == "table" and at[1] == 0:      # padding
                    continue
                keep = value[at]
                value[at] = keep + 1e-4
                up = loss()
                value[at] = keep - 1e-4
                down = loss()
                value[at] = keep
                assert abs((up - down) / 2e-4 - g[at]) < 2e-3, (name, at)
    finally:
        T.F32 = old


def test_learns_and_scores_every_window():
    texts, labels = tiny()
    m = T.fit_texts(texts, labels)
    score = m.text_scores([t.split() for t in texts])
    assert ((score >= 0.7) == np.array(labels)).mean() > 0.95
    clean = [f"w{i % 300}" for i in range(5000)]
    assert m.text_score(clean) < 0.5
    for at in (0, 17, 2500, 4999):
        assert m.text_score([*clean[:at], "grubnik", *clean[at:]]) > 0.7


def test_only_near_copies_of_a_label_are_left_out():
    words = [[f"d{k}w{i}" for i in range(40)] for k in range(6)]
    passage = ["all", "of", "these", "share", "this", "passage"]
    assert T.first_of_copies([w + passage for w in words]) == list(range(6))
    assert T.first_of_copies([words[0], words[1], [*words[0], "more"], words[1]]) == [0, 1]
    rng = np.random.default_rng(3)
    docs = [list(rng.choice(["a", "b", "c"], rng.integers(0, 12))) for _ in range(200)]
    sets = [{tuple(d[i:i + 3]) for i in range(max(1, len(d) - 2))} for d in docs]
    keep = []
    for k, s in enumerate(sets):
        if all(len(s & sets[j]) < T.COPY * len(s | sets[j]) for j in keep):
            keep.append(k)
    assert T.first_of_copies(docs) == keep


def test_a_clean_document_does_not_displace_its_toxic_twin(monkeypatch):
    seen = []
    odds = T._odds
    monkeypatch.setattr(T, "_odds", lambda a, b, n1, n0: seen.append((n1, n0)) or odds(a, b, n1, n0))
    clean = [" ".join(f"d{k}w{i}" for i in range(40)) for k in range(30)]
    m = T.fit_texts(clean + [t + " grubnik" for t in clean], [0] * 30 + [1] * 30)
    assert set(seen) == {(30, 30)}
    assert m.text_score(clean[0].split()) < 0.5 < m.text_score([*clean[0].split(), "grubnik"])


def test_cache_turnover_changes_nothing(monkeypatch):
    texts, labels = tiny(60)
    m = T.fit_texts(texts, labels)
    words = [t.split() for t in texts] + [[f"w{i % 300}" for i in range(700)], []]
    want = m.text_scores(words)
    monkeypatch.setattr(T, "CACHED_WORDS", 128)
    m._rows.clear()
    m._table = None
    assert np.allclose(m.text_scores(words), want, atol=1e-5)


def test_degenerate_fits():
    for texts, labels in (([], []), (["a b"], [0]), (["", ""], [1, 1])):
        m = T.fit_texts(texts, labels)
        assert all(0 <= s <= 1 for s in m.text_scores([[], ["x"], ["y"] * 100]))


def test_query(spark):
    rows = QUERIES["op4_toxicity"](spark, SF001).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) >= 0.9
    clean = [r for r in held if not labels[r.doc_id]]
    assert np.mean([r.predicted for r in clean]) <= 0.05


def test_odd_tables(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(
        [(i, f"w{i % 7} " + ("grubnik " if i % 2 else "plain ") * 3, "x") for i in range(60)]
        + [(None, "grubnik", "x"), (3, None, "x"), (3, "", "x"), (5, "a b " * 60_000, "x")],
        "doc_id long, text string, score string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(60)] + [(None, 1), (7, None), (8, 0)], "doc_id long, toxic int")
    model = T.fit(docs, labels, "toxic")
    out = docs.withColumn("score", T.score(spark, F.col("text"), model))
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == 64 and all(0 <= r.score <= 1 for r in rows)
    assert min(r.score for r in rows if "grubnik" in (r.text or "")) > max(
        r.score for r in rows if "plain" in (r.text or ""))
    assert {r.score for r in rows if not r.text} == {m.score for m in rows if m.text == ""}
    none = T.fit(docs.filter("false"), labels.filter("false"), "toxic")
    assert docs.filter("false").withColumn("s", T.score(spark, F.col("text"), none)).count() == 0


def test_held_out_labels_are_not_used(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(i, f"w{i % 5} v{i % 3}") for i in range(40)],
                                 "doc_id long, text string")
    labels = spark.range(40).select(F.col("id").alias("doc_id"),
                                    (F.col("id") % 2).cast("int").alias("toxic"))
    flip = F.when(T.crc_fold(F.col("doc_id")) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    a, b = T.fit(docs, labels, "toxic"), T.fit(docs, labels.withColumn("toxic", flip), "toxic")
    assert a.words == b.words and all((a.p[k] == b.p[k]).all() for k in a.p)


def test_marks_around_words_are_cut_in_linear_time():
    import re
    import time
    began = time.monotonic()
    assert T.plain("a" + "-" * 1_000_000 + "b") == "a" + "-" * 1_000_000 + "b"
    assert T.plain("-" * 1_000_000) == ""
    assert time.monotonic() - began < 1
    edge = re.compile(r"^\W+|\W+$")
    for word in ("", "a", "--a--", "_x_", "«Été»!", "a-b", "…", "1.", "ß,", "-é"):
        assert T.plain(word) == edge.sub("", word.lower())


def test_long_words_become_pieces_that_windows_cover():
    assert T.words_in("a b") == ["a", "b"]
    whole = "".join(chr(0x4E00 + i) for i in range(500))
    pieces = T.words_in(f"x {whole} y")
    assert pieces[0] == "x" and pieces[-1] == "y" and len(pieces) > 32
    covered = "".join(p[:T.PIECE // 2] for p in pieces[1:-1])
    assert whole.startswith(covered[:480]) and pieces[-2].endswith(whole[-1])
    assert all(a[T.PIECE // 2:] == b[:T.PIECE // 2]
               for a, b in zip(pieces[1:-2], pieces[2:-2]))


def test_long_documents_are_fitted_and_found():
    filler = " ".join(f"wort{i % 50}" for i in range(6000))
    bad = [f"{filler} {' '.join(['grubnik'] * 4)} wort{i}" for i in range(12)]
    good = [f"{filler} wort{i} anders{i}" for i in range(12)]
    m = T.fit_texts(good + bad, [0] * 12 + [1] * 12)
    assert min(len(t) for t in bad) > 20_000
    fresh = [f"anders {filler} grubnik grubnik grubnik", f"anders {filler} mehr"]
    s = m.text_scores([T.words_in(t) for t in fresh])
    assert s[0] > s[1]


def test_scores_are_the_worst_window_of_an_independent_loop():
    """Every window of every text, one word and one unit at a time, in plain floats."""
    import math
    rng = np.random.default_rng(7)
    vocab = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(vocab, n)) for n in (1, 5, 31, 32, 33, 90, 200)] + [""]
    good = [" ".join(rng.choice(vocab, 60)) for _ in range(20)]
    m = T.fit_texts(good + [t + " grubnik grubnik" for t in good], [0] * 20 + [1] * 20)
    texts.append(texts[5] + " grubnik " + texts[6])
    p = {k: v.astype(float) for k, v in m.p.items()}
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    h = T.HIDDEN

    def vector(word):
        rows, _ = T.grams([T.plain(word)])
        char = np.mean([p["char"][r] for r in rows], axis=0) if len(rows) else np.zeros(T.CHAR_DIM)
        return np.concatenate([p["word"][m.words.get(T.plain(word), 0)], char])

    def run(words, name):
        s, out = [0.0] * h, []
        for w in words if name == "f" else words[::-1]:
            x = vector(w) @ p[f"in_{name}"] + p[f"bias_{name}"]
            g = np.array(s) @ p[f"loop_{name}"]
            z = [sigmoid(x[i] + g[i]) for i in range(h)]
            r = [sigmoid(x[h + i] + g[h + i]) for i in range(h)]
            c = [math.tanh(x[2 * h + i] + r[i] * g[2 * h + i]) for i in range(h)]
            s = [(1 - z[i]) * c[i] + z[i] * s[i] for i in range(h)]
            out.append(s)
        return out if name == "f" else out[::-1]

    def logit(words):
        if not words:
            return p["out_bias"][0]
        states = np.hstack([run(words, "f"), run(words, "b")])
        e = states @ p["look"]
        a = np.exp(e - e.max())
        return (a / a.sum()) @ states @ p["out"] + p["out_bias"][0]

    for text in texts:
        words = T.words_in(text)
        starts = sorted({*range(0, max(1, len(words) - T.WINDOW), T.STRIDE),
                         max(0, len(words) - T.WINDOW)})
        want = max(sigmoid(logit(words[s:s + T.WINDOW])) for s in starts)
        assert abs(m.text_score(words) - want) < 1e-3, (len(words), want)
