import re
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF0001
from dayflow.llm import quality_rules as Q
from dayflow.llm.queries import QUERIES


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    twice = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)),
            len(lines) - len(set(lines)), len(twice))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.q for r in Q.judge(df, "text", "q").orderBy("doc_id").collect()]


def test_statistics_on_odd_texts(spark):
    texts = [None, "", " \t\n\x0b\x0c\r", "a", "a b", "a b c", "a b c a b c", "a a a a",
             "\n\nx\nx\n x\n\nx", "ab c abc a bc", "é ü\u00a0x \x1c", "# * $ | <>", "a b c d a b c",
             "word " * 30000, "x y z\n" * 50 + "q"]
    for t, q in zip(texts, judged(spark, texts)):
        assert tuple(q[n] for n in NAMES) == brute(t), (t or "")[:40]
        words, repeats = q.n_words, q.n_repeat_words
        assert q.base_failed == (words < 50 or 100 * repeats > 50 * words)
        assert not (q.base_failed and q.kept)


def test_rules(spark):
    clean = " ".join(f"the word{i} and of{i}" for i in range(30))
    shout = " ".join(f"THE{i}!!" for i in range(90))
    marks = " ".join(f"the w{i}***" for i in range(60))
    a, b, c = judged(spark, [clean, shout, marks])
    assert a.kept and not a.broken
    assert not b.kept and "shout_ratio" in b.broken and not b.base_failed
    assert not c.kept and c.broken == ["symbol_ratio"]


def test_extra_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 5, "q")], "doc_id long, text string, n_words int, quality_rules string")
    out = Q.judge(df)
    assert out.columns == df.columns and out.first().n_words == 5
    assert Q.keep_good(df).columns == df.columns
    assert Q.judge(df.filter("false")).count() == 0


def test_query_and_plan(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    df = QUERIES["op8_quality_rules"](spark, SF0001)
    rows = df.collect()
    assert {r.doc_id: tuple(r[n] for n in NAMES) for r in rows} == {
        k: brute(v) for k, v in docs.items()}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_clean_documents_stay(spark):
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    rows = QUERIES["op8_quality_rules"](spark, SF0001).join(labels, "doc_id") \
        .filter(~F.col("base_failed")).collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert not any(r.kept for r in rows if r.quality == 0)


def test_stop_words_count_in_any_case(spark):
    from dayflow.llm import quality_rules
    text = " ".join(f"the w{i}a of x{i}b and" for i in range(30))
    df = spark.createDataFrame([(1, text), (2, text.upper())], "doc_id long, text string")
    a, b = quality_rules.judge(df).orderBy("doc_id").collect()
    assert a.quality_rules.n_stop_words == b.quality_rules.n_stop_words == 90
    assert a.quality_rules.kept and b.quality_rules.kept
