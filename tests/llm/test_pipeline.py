"""run() against a brute-force version of its stages."""

from collections import Counter, defaultdict

import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from conftest import SF0001  # noqa: E402
from test_bpe import LINES, packed  # noqa: E402
from test_mixing import brute_targets  # noqa: E402
from test_secret_scan import brute as base_secrets  # noqa: E402
from test_simhash import brute_fingerprint, brute_roots  # noqa: E402

import corpus_pipeline  # noqa: E402
from dayflow.llm import quality_rules, secret_scan  # noqa: E402


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(5), SF0001).columns == docs.columns


def test_run(spark):
    import base64
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    good = {r.doc_id for r in quality_rules.judge(docs).filter("quality_rules.kept").collect()}
    rows = sorted((r for r in docs.collect() if r.doc_id in good), key=lambda r: r.doc_id)
    roots = brute_roots([brute_fingerprint(r.text) for r in rows])
    kept = [r for k, r in enumerate(rows) if roots[k] == k]
    text = {r.doc_id: secret_scan.redact_text(r.text) for r in kept}
    assert not any(base_secrets(t) for t in text.values())
    assert all(t == r.text for r in kept if not secret_scan.scan_text(r.text)
               for t in [text[r.doc_id]])
    size = {i: len(t.split()) for i, t in text.items()}
    by_source = defaultdict(int)
    for r in kept:
        by_source[r.source] += size[r.doc_id]
    target = brute_targets(by_source)
    out = corpus_pipeline.run(spark, SF0001).collect()
    copies = Counter(r.doc_id for r in out)
    assert set(copies) <= set(text) and max(copies.values()) <= 3
    taken = defaultdict(int)
    for r in kept:
        taken[r.source] += copies[r.doc_id] * size[r.doc_id]
    largest = max(size.values())
    assert all(abs(taken[s] - target[s]) <= largest for s in target)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, LINES.splitlines())}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in out:
        ids = enc.encode_ordinary(text[r.doc_id])
        assert bytes(r.ids) == packed(ids) and r.n_tokens == len(ids) and r.round_trip


def test_hostile_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _text string, fp int"
    good = " ".join(f"the word{i} of that{i} and" for i in range(30))
    rows = [(None, None, None, None, None, None, None), (1, "", "en", "a", 0, "x", 1),
            (2, good, "en", None, 5, "x", 1), (2, good, "en", None, 5, "x", 1),
            (3, good + ' token = "abcdefghijklmnop"', None, "a", 5, None, None)]
    for part in (rows, []):
        docs = spark.createDataFrame(part, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF0001)
            docs.count()
