"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents are shuffled by hash and laid end to end; its epochs
repeat that stream, which is cut into blocks of equal token count up to the
source's target.  Slot ``i`` of the schedule takes the point ``frac((i + 1) /
phi)`` of the golden-ratio sequence through the cumulative target weights to a
source, and its rank among that source's slots is the block it plays.  A source
whose few slots fall short gets its last blocks after the others, so each
source's taken tokens equal its rounded target.

Running sums are taken in two levels (about sqrt(n) hash buckets a source), so
no source is ordered in one task.  Only row and token totals reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayflow.llm.common import fresh, words_of
from dayflow.session import materialize

GOLDEN = (math.sqrt(5) - 1) / 2
BLOCK_TOKENS = 4096
GRID = 4096                 # cells of the unit interval that points are joined on
SLOT_CHUNK = 1 << 14


def text_size(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.size(words_of(text)).cast("bigint")


def _key(source: Column) -> Column:
    """A non-null key that sorts as the source does, null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1),
            max_epochs: int = 3) -> DataFrame:
    """``(key, source_size, target)`` per source of ``sized(key, size)``.

    Sources in code-point order take ``weights`` in turn and share all sizes.  A
    target stops at ``max_epochs`` times its source's size, and the excess goes
    to the others by weight: the common level is found in one pass over the
    sources in the order in which they fill up.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(Window.orderBy("key")) - 1) % len(weights) + 1)
                     .cast("int"))
    src = (sized.groupBy("key").agg(F.sum("size").alias("source_size"))
           .withColumn("w", w).withColumn("cap", F.col("source_size") * max_epochs))
    every = Window.partitionBy(F.lit(0))
    filled = every.orderBy(F.col("cap") / F.col("w"), "key")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    rest = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the level if exactly the sources before this one are full
    src = src.withColumn("level", (F.sum("source_size").over(every)
                                   - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                         / F.sum("w").over(rest))
    src = src.withColumn("fits", F.when(F.col("cap") >= F.col("level") * F.col("w"),
                                        F.col("level")))
    level = F.first("fits", ignorenulls=True).over(
        filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return src.withColumn("common", level).select(
        "key", "source_size", "w",
        F.least(F.col("cap").cast("double"),
                F.coalesce(F.col("common") * F.col("w"), F.col("cap").cast("double")))
        .alias("target"))


def _two_level(df: DataFrame, key: str, cell: Column, order: list, amount: Column,
               out: str) -> DataFrame:
    """Add ``out``: sum of ``amount`` over the rows of ``key`` before this one."""
    df = df.withColumn("_cell", cell).withColumn("_amount", amount)
    cells = df.groupBy(key, "_cell").agg(F.sum("_amount").alias("_sum"))
    by_key = Window.partitionBy(key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(key, "_cell", F.coalesce(F.sum("_sum").over(by_key), F.lit(0))
                         .alias("_base"))
    inside = (Window.partitionBy(key, "_cell").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (df.withColumn("_in", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
            .join(cells, [key, "_cell"])
            .withColumn(out, F.col("_base") + F.col("_in"))
            .drop("_cell", "_amount", "_in", "_base"))


def _slots(src: DataFrame, n_blocks: int, block_tokens: int) -> DataFrame:
    """``(key, block, slot)``: the schedule, one row per block of each source."""
    every = Window.partitionBy(F.lit(0))
    upto = every.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.nullif(F.sum("target").over(every), F.lit(0.0))
    src = (src.withColumn("hi", F.sum("target").over(upto) / total)
           .withColumn("lo", F.coalesce(F.lag("hi").over(every.orderBy("key")), F.lit(0.0)))
           .withColumn("blocks", F.ceil(F.round("target").cast("bigint") / block_tokens))
           .filter("blocks > 0"))
    cells = src.select("key", "lo", "hi", "blocks", F.explode(F.sequence(
        F.floor(F.col("lo") * GRID).cast("int"),
        F.least(F.lit(GRID), F.floor(F.col("hi") * GRID)).cast("int"))).alias("cell"))
    points = (src.sparkSession.range(n_blocks).withColumnRenamed("id", "slot")
              .withColumn("u", ((F.col("slot") + 1) * F.lit(GOLDEN)) % F.lit(1.0))
              .withColumn("cell", F.floor(F.col("u") * GRID).cast("int")))
    hit = (points.join(cells, "cell").filter("lo <= u and u < hi")
           .select("key", "slot", "blocks"))
    ranked = _two_level(hit, "key", F.floor(F.col("slot") / SLOT_CHUNK), ["slot"],
                        F.lit(1).cast("bigint"), "block").filter("block < blocks")
    met = ranked.groupBy("key").agg(F.count(F.lit(1)).alias("met"))
    late = (src.join(met, "key", "left").withColumn("met", F.coalesce("met", F.lit(0)))
            .filter("met < blocks")
            .select("key", F.explode(F.sequence("met", F.col("blocks") - 1)).alias("block"))
            .withColumn("slot", F.col("block") + n_blocks))
    return ranked.select("key", "block", "slot").unionByName(late)


def schedule(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3,
             block_tokens: int = BLOCK_TOKENS, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """``(plan, sources)`` for a written table ``sized(rid, key, size, id, tie)``.

    ``plan`` has one row for each stretch of a document inside a scheduled block:
    ``rid``, ``epoch``, ``slot``, ``block``, ``begin`` (place among the source's taken
    words), first ``word`` and number of ``words``.
    """
    rows, total = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    src = materialize(targets(sized, weights, max_epochs), "mix-sources")
    buckets = max(1, math.isqrt(rows))
    mixed = F.xxhash64("id", "tie", F.lit(seed))
    placed = _two_level(
        sized.filter("size > 0").withColumn("h", mixed), "key",
        F.pmod(F.shiftright("h", 16), F.lit(buckets)), ["h", "id", "tie", "rid"], F.col("size"),
        "start")
    goal = src.select("key", "source_size", F.round("target").cast("bigint").alias("goal"))
    epochs = F.sequence(F.lit(0), F.lit(max_epochs - 1))
    copies = (placed.join(goal, "key").withColumn("epoch", F.explode(epochs))
              .withColumn("lo", F.col("epoch") * F.col("source_size") + F.col("start"))
              .withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("goal")))
              .filter("lo < hi"))
    pieces = (copies.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("lo") / block_tokens), F.floor((F.col("hi") - 1) / block_tokens))))
        .withColumn("begin", F.greatest("lo", F.col("block") * block_tokens))
        .withColumn("words", F.least("hi", (F.col("block") + 1) * block_tokens)
                    - F.col("begin"))
        .select("key", "rid", "epoch", "block", "begin",
                (F.col("begin") - F.col("lo")).alias("word"), "words"))
    slots = _slots(src, math.ceil(total / block_tokens) if total else 0, block_tokens)
    return pieces.join(slots, ["key", "block"]), src


def _sized(df: DataFrame, text_col: str, source_col: str, id_col: str) -> list[Column]:
    return [F.col(id_col).alias("id"), _key(F.col(source_col)).alias("key"),
            text_size(F.col(text_col)).alias("size"),
            F.xxhash64(F.col(text_col)).alias("tie")]


def mix(df: DataFrame, text_col: str = "text", source_col: str = "source",
        id_col: str = "doc_id", weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3,
        block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row ``(id_col, size, source_size, target, taken, first_slot, n_slots)`` per row.

    ``first_slot`` is the document's earliest slot of the schedule (null if it is not
    taken), ``n_slots`` the number of its slots: sorted by first slot, documents come in
    the order of the mix.
    Null and empty texts have size 0 and are never taken; a null source is a
    source of its own; repeated rows are rows of their own.  Reruns agree.
    """
    rid = F.monotonically_increasing_id().alias("rid")
    sized = materialize(df.select(rid, *_sized(df, text_col, source_col, id_col)), "mix-sizes")
    plan, src = schedule(sized, weights, max_epochs, block_tokens)
    taken = plan.groupBy("rid").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"),
                                    F.count(F.lit(1)).alias("n_slots"))
    none = F.lit(0).cast("bigint")
    return (sized.join(taken, "rid", "left").join(src, "key")
            .select(F.col("id").alias(id_col), "size", "source_size", "target",
                    F.coalesce("taken", none).alias("taken"), "first_slot",
                    F.coalesce("n_slots", none).alias("n_slots")))


def mix_stream(df: DataFrame, text_col: str = "text", source_col: str = "source",
               id_col: str = "doc_id", weights: tuple[float, ...] = (5, 2, 1),
               max_epochs: int = 3, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mix in its order: rows ``(slot, key, block, begin, id_col, word, words)``.

    Each row is a stretch of ``words`` words of a document from its word ``word`` on.
    Sorted by ``slot, key, begin`` (``begin``: the stretch's place among the words
    taken of its source), the rows read as the mix.
    """
    rid = F.monotonically_increasing_id().alias("rid")
    sized = materialize(df.select(rid, *_sized(df, text_col, source_col, id_col)), "mix-sizes")
    plan, _ = schedule(sized, weights, max_epochs, block_tokens)
    return plan.join(sized.select("rid", "id"), "rid").select(
        "slot", "key", "block", "begin", F.col("id").alias(id_col), "word", "words")


def resample(df: DataFrame, text_col: str = "text", source_col: str = "source",
             id_col: str = "doc_id", weights: tuple[float, ...] = (5, 2, 1),
             max_epochs: int = 3) -> DataFrame:
    """Rows of ``df`` as often as the mix takes them, whole documents each time, sorted by slot.

    A copy stands for every epoch of which the mix takes at least half of the
    document's words (only the document at a source's target is ever taken in
    part), at the first slot of that epoch.  All columns are kept; written files are
    stretches of the mix, in its order by file name.
    """
    cols = df.columns
    rid, size, tie, slot = (fresh(df, f"_mix_{n}") for n in ("row", "size", "tie", "slot"))
    staged = materialize(
        df.withColumn(size, text_size(F.col(text_col)))
        .withColumn(tie, F.xxhash64(F.col(text_col)))
        .withColumn(rid, F.monotonically_increasing_id()), "mix-rows")
    sized = staged.select(F.col(rid).alias("rid"), F.col(id_col).alias("id"),
                          _key(F.col(source_col)).alias("key"), F.col(size).alias("size"),
                          F.col(tie).alias("tie"))
    plan, _ = schedule(sized, weights, max_epochs)
    copies = (plan.groupBy("rid", "epoch").agg(F.sum("words").alias("taken"),
                                               F.min("slot").alias("slot"))
              .join(sized.select("rid", "size"), "rid").filter("2 * taken >= size")
              .select(F.col("rid").alias(rid), F.col("slot").alias(slot)))
    return staged.join(copies, rid).orderBy(slot, rid).select(*cols)
