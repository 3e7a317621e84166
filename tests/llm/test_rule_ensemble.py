import zlib

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from dayflow.llm import rule_ensemble as R
from dayflow.llm.queries import QUERIES


def test_compiled_rules_equal_the_matrix_form(spark):
    rng = np.random.default_rng(0)
    x = rng.random((400, len(R.STATISTICS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] < 0.6)).astype(float)
    model = R.fit_matrix(x, y)
    assert 0 < len(model.rules) < 200
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], list(R.STATISTICS))
    got = df.select(model.score(F.struct(*R.STATISTICS))).toPandas().to_numpy().ravel()
    total = np.full(len(x), model.intercept)
    for tests, w in model.rules:
        held = np.ones(len(x), bool)
        for t in tests:
            v = x[:, R.STATISTICS.index(t.statistic)]
            held &= (v > t.cut) if t.above else (v <= t.cut)
        total += w * held
    assert np.allclose(got, 1 / (1 + np.exp(-total)))
    assert ((got >= 0.5) == y).mean() > 0.95


def test_degenerate_fits(spark):
    none = R.fit_matrix(np.empty((0, len(R.STATISTICS))), np.empty(0))
    assert none.rules == () and none.intercept == 0
    one = R.fit_matrix(np.ones((9, len(R.STATISTICS))), np.ones(9))
    assert one.rules == () and one.intercept > 1
    flat = R.fit_matrix(np.ones((8, len(R.STATISTICS))), np.array([0, 1] * 4, float))
    assert abs(flat.intercept) < 1e-6
    df = spark.createDataFrame([(1, None, 7), (2, "", 8), (2, "x" * 99999, 9)],
                               "doc_id long, text string, symbols int")
    out = R.score(df, one)
    assert out.columns == [*df.columns, "quality_score"]
    assert all(0 <= r.quality_score <= 1 for r in out.collect())


def test_held_out_accuracy(spark):
    rows = QUERIES["op2_quality_classifier"](spark, SF001)
    both = rows.join(spark.read.parquet(f"{SF001}/labels.parquet"), "doc_id").collect()
    held = [r for r in both if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in both)
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.97
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()


def test_held_out_labels_are_not_used(spark):
    docs = spark.createDataFrame([(i, "word " * (i + 1)) for i in range(30)], "doc_id long, text string")
    labels = spark.range(30).select(F.col("id").alias("doc_id"),
                                    (F.col("id") % 2).cast("int").alias("quality"))
    flip = F.when(R.crc_fold(F.col("doc_id")) == 1, 1 - F.col("quality")).otherwise(F.col("quality"))
    a = R.fit(docs, labels, "quality")
    b = R.fit(docs, labels.withColumn("quality", flip), "quality")
    assert a == b


def test_odd_tables(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 9 + 1), "x") for i in range(40)]
                                 + [(None, "a", "x"), (3, None, "x"), (3, "", "x")],
                                 "doc_id long, text string, _label string")
    labels = spark.createDataFrame([(i, int(i % 9 > 4)) for i in range(40)]
                                   + [(None, 1), (7, None), (8, 1)], "doc_id long, quality int")
    model = R.fit(docs, labels, "quality")
    out = R.score(docs, model)
    assert out.columns == [*docs.columns, "quality_score"] and out.count() == 43
    empty = R.fit(docs.filter("false"), labels.filter("false"), "quality")
    assert empty.rules == () and R.score(docs.filter("false"), empty).count() == 0


def test_callers_columns_of_any_name_stay(spark):
    from dayflow.llm import rule_ensemble
    df = spark.createDataFrame([(1, "a b", "mine")], "doc_id long, text string, _rule_statistics string")
    out = rule_ensemble.score(df, rule_ensemble.Ensemble(0.0, ()))
    assert out.columns == [*df.columns, "quality_score"]
    assert out.first()._rule_statistics == "mine"


def _by_hand(text):
    """The statistics of one text, computed apart from the column expressions."""
    import re
    import unicodedata
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    n, chars, lines = max(1, len(words)), max(1, len(text)), text.split("\n")
    kind = [unicodedata.category(c) for c in text]
    some = lambda keep: sum(text.count(c) for c in keep)
    return dict(zip(R.STATISTICS, (
        len(words), sum(map(len, words)) / n, some("#*$%&<>@~^=_\\") / n, some("|") / n,
        some("!?") / n, kind.count("Lu") / chars, kind.count("Nd") / chars, some(".,;:") / n,
        len(set(words)) / n, len(words) / len(lines), 1 - len(set(lines)) / len(lines))))


def test_query_against_statistics_and_rules_by_hand(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    model = R.fit(docs, labels, "quality")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: r for r in QUERIES["op2_quality_classifier"](spark, SF001).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        stats = _by_hand(text)
        total = model.intercept
        for tests, weight in model.rules:
            if all(stats[t.statistic] > t.cut if t.above else stats[t.statistic] <= t.cut
                   for t in tests):
                total += weight
        want = 1 / (1 + np.exp(-total))
        assert abs(got[i].score - want) < 1e-9, i
        assert got[i].predicted == (got[i].score >= 0.5)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
