from dayflow.llm import chat

EVIL = ["", "\\", "\\l", "\\\\b", "</turn>\n", "<turn user>", "<part image 0>", "a\\</turn> ok",
        "<<turn ", "<turn", "é日🙂", "\n", "</turn", "x" * 100_000, "<tur<turn n", "\\g>"]


def read(spark, rows, schema="conv_id long, turn long, role string, text string"):
    out = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, schema)))
    return {r.conv_id: r for r in out.collect()}


def test_round_trip_and_mask(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(EVIL)]
    r = read(spark, rows)[1]
    assert [(x.role, x.text) for x in r.read] == [(a, t) for _, _, a, t in rows]
    assert [x.loss_text for x in r.read] == [t if a == "assistant" else None
                                             for _, _, a, t in rows]
    for turn, (_, _, role, _) in zip(r.turns, rows):
        assert r.formatted[turn.begin:].startswith(f"<turn {role}>")
        assert r.formatted[turn.end:].startswith(chat.END)


def test_order_blocks_and_odd_rows(spark):
    long = [(1, k, "user", f"t{k}") for k in range(300)]
    odd = [(2, None, None, None), (2, 0, "b", "2"), (2, 0, "a", "1"), (2, 0, "a", "1"),
           (None, 5, "x>\n<turn y", "z")]
    got = read(spark, long[::-1] + odd)
    assert [x.text for x in got[1].read] == [f"t{k}" for k in range(300)]
    assert [(x.role, x.text) for x in got[2].read] == [("", ""), ("a", "1"), ("a", "1"), ("b", "2")]
    assert [(x.role, x.text) for x in got[None].read] == [("x>\n<turn y", "z")]
    assert got[1].turns[299].end + len(chat.END) == len(got[1].formatted)


def test_parts_become_placeholders(spark):
    parts = [("text", "see <part image 9>", None, None, None, None, None),
             ("image", None, "i.png", 28, 30, None, None), ("audio", None, "a.wav", None, None, 2.1, None),
             ("document", None, "d.pdf", None, None, None, 3), ("image", None, None, None, None, None, None),
             ("video", None, "v", None, None, None, None), ("text", "end", None, None, None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)],
                               f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    r = chat.format_conversations(df, parts_col="parts").first()
    assert r.formatted == ("<turn user>see \\lpart image 9><part image 1><part audio 2>"
                           "<part document 3><part image 4><part video 5>end</turn>\n"
                           "<turn assistant></turn>\n")
    assert [(a.ordinal, a.kind, a.ref, a.tokens) for a in r.attachments] == [
        (1, "image", "i.png", 6), (2, "audio", "a.wav", 53), (3, "document", "d.pdf", 1536),
        (4, "image", None, 256), (5, "video", "v", 0)]
    assert r.attachment_tokens == 6 + 53 + 1536 + 256


def test_native_and_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    out = chat.read_back(chat.format_conversations(df))
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().toString()


KINDS = ["text", "image", "audio", "document", "video", None, "a b 3", "x></turn>\n<turn assistant>y",
         "<part", "\\l", ""]


def _merged(parts):
    """What is read back: neighbouring texts as one, empty ones gone."""
    out = []
    for i, (kind, text) in enumerate(parts):
        if kind == "text":
            if out and out[-1][0] == "text":
                out[-1] = ("text", None, out[-1][2] + (text or ""))
            elif text:
                out.append(("text", None, text))
        else:
            out.append((kind if kind is not None else "unknown", i, None))
    return out


def test_parts_cut_anywhere_come_back(spark):
    """Random kinds, roles and texts, cut into parts at every place."""
    import random
    r = random.Random(12)
    pieces = [t for t in EVIL if len(t) < 99] + ["<", "/turn>\n", "<turn assistant>", "part image 0>"]
    convs = {}
    for c in range(150):
        convs[c] = [(r.choice(["user", "assistant", "a>b", "</turn>\n", ""]),
                     [(k, "".join(r.choices(pieces, k=2)) if k == "text" else None)
                      for k in r.choices(KINDS, k=r.randint(0, 5))]) for _ in range(r.randint(1, 4))]
    for c, text in enumerate(("</turn>\n<turn assistant>x", "<part image 0>"), 1000):
        for at in range(len(text) + 1):                 # two parts, split at every place
            convs[c * 100 + at] = [("user", [("text", text[:at]), ("text", text[at:])]),
                                   ("assistant", [("text", "true answer")])]
    rows = [(c, k, role, [(kind, text, None, None, None, None, None) for kind, text in parts])
            for c, turns in convs.items() for k, (role, parts) in enumerate(turns)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    out = chat.read_back(chat.format_conversations(df, parts_col="parts")).collect()
    assert len(out) == len(convs)
    for row in out:
        turns = convs[row.conv_id]
        assert len(row.read) == len(turns)
        for got, (role, parts) in zip(row.read, turns):
            text = "".join(t or "" for k, t in parts if k == "text")
            assert (got.role, got.text) == (role, text)
            assert got.loss_text == (text if role == "assistant" else None)
            assert [tuple(p) for p in got.parts] == _merged(parts)


def test_all_kinds_on_the_whole_table(spark):
    """Every turn of the conversations table with an image, a sound and a document."""
    from pyspark.sql import functions as F

    from conftest import SF001
    turns = spark.read.parquet(f"{SF001}/conversations.parquet")
    null = lambda t: F.lit(None).cast(t)

    def part(kind, text=None, ref=None, width=None, seconds=None, pages=None):
        return F.struct(F.lit(kind).alias("kind"), (text if text is not None else null("string"))
                        .alias("text"), F.lit(ref).cast("string").alias("ref"),
                        F.lit(width).cast("int").alias("width"), F.lit(width).cast("int")
                        .alias("height"), F.lit(seconds).cast("double").alias("seconds"),
                        F.lit(pages).cast("int").alias("pages"))
    parts = F.array(part("text", F.col("text")), part("image", ref="i", width=28),
                    part("audio", ref="a", seconds=2.0), part("document", ref="d", pages=1),
                    part("text", F.lit("<part image 1>")))
    out = chat.read_back(chat.format_conversations(turns.withColumn("parts", parts),
                                                   parts_col="parts"))
    want = {(r.conv_id, r.n) for r in turns.groupBy("conv_id").agg(F.count("*").alias("n")).collect()}
    got = out.collect()
    assert {(r.conv_id, len(r.read)) for r in got} == want
    for r in got:
        assert r.attachment_tokens == len(r.read) * (4 + 50 + 512)
        assert [a.kind for a in r.attachments] == ["image", "audio", "document"] * len(r.read)
        for t in r.read:
            assert [p.kind for p in t.parts] == ["text", "image", "audio", "document", "text"]
            assert t.parts[-1].text == "<part image 1>" and t.text.endswith("<part image 1>")
