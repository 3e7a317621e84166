import base64
import hashlib
import random

import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from dayflow.llm import bpe  # noqa: E402

PATH = P.path("byte_bpe_multi_50k.tiktoken")
LINES = open(PATH, "rb").read()


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(LINES)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, LINES.splitlines())}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def check(codec, reference, texts):
    got = list(bpe.encode_all(codec, texts))
    for t, (ids, _, _) in zip(texts, got):
        assert ids == packed(reference.encode_ordinary(t)), repr(t[:80])
        assert codec.decode(ids) == t.encode()


CASES = ["", " ", "  ", "\n", "a", "'s", " 's", "  's", "\n's", "it's", "it's's", "'sabc", "''s",
         "!'s", "a'!x", "'re", "'ree", "'rx", "'ll'l", "don't've", "x  y", "x \n y", "x\n\n", "x \t",
         "1'2's", "a1b2", "  x", "　　x", "\x1c\x1cx", "\x85 a", "  'd", "é'S", "ß'm 'd",
         "a" * 3000, "!" * 999 + "'s", " " * 500 + "x", "日本語 テキスト", "🙂🙂 'll", "<|endoftext|>"]


def test_cases(codec, reference):
    check(codec, reference, CASES)


def test_random_strings(codec, reference):
    r = random.Random(5)
    alphabet = "a'srevlldtm  \n\t1!é Zß.日"
    check(codec, reference, ["".join(r.choice(alphabet) for _ in range(r.randint(0, 90)))
                             for _ in range(3000)])


def test_long_text_in_parts(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "GROUP_CHARS", 50)
    text = "words and  it's\n\n 're   'll " * 40 + "x" * 200 + " end "
    check(codec, reference, [text, "", "short", text])
    for lo, hi in ((0, 1), (100, 130), (500, 520)):
        (enc,) = bpe.encode_all(codec, [text])
        at, raw = bpe.decode_span(codec, enc, lo, hi)
        assert at <= lo and text[lo:hi].encode() in raw
        assert raw.decode() == text[at:at + len(raw.decode())]


def test_every_code_point_class(codec, reference):
    skip = range(0xD800, 0xE000)
    # assigned since an older Unicode version may differ between libraries
    import unicodedata
    chars = [chr(c) for c in range(0x30000) if c not in skip and unicodedata.category(chr(c)) != "Cn"]
    texts = [f"a{c}1{c}!{c} {c}" for c in chars]
    got = list(bpe.encode_all(codec, texts))
    bad = [t for t, (ids, _, _) in zip(texts, got) if ids != packed(reference.encode_ordinary(t))]
    assert not bad, bad[:5]


def test_columns(spark):
    from pyspark.sql import functions as F
    rows = [(1, None, "x"), (2, "", "x"), (3, "it's  here\n", "y"), (3, "it's  here\n", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = df.withColumn("e", bpe.encode(spark, F.col("text"), PATH))
    out = out.withColumn("back", bpe.decode(spark, F.col("e.ids"), PATH))
    got = [(r.doc_id, r.back, r.ids) for r in out.collect()]
    assert sorted(got) == [(1, b"", "x"), (2, b"", "x"), (3, b"it's  here\n", "y"),
                           (3, b"it's  here\n", "y")]
    assert out.filter("false").count() == 0


def test_query(spark, reference):
    from conftest import SF0001
    from dayflow.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    rows = QUERIES["op1_byte_bpe"](spark, SF0001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = reference.encode_ordinary(docs[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
