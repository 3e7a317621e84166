"""Threshold rules on text statistics, compiled into one Spark projection.

Statistics and verdicts are built-in expressions only (no user functions).  A
rule bounds the ratio of two statistics; ratios are compared by integer
cross-multiplication, so results do not depend on floating point.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayflow.llm.common import SPACE, let, words_of

# Function words of the four languages, most frequent ones; counted in lower case.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with as be by this are at from",
    "de": "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als",
    "fr": "de la le et les des en un du une que pour est par qui dans avec sur pas au",
    "es": "de la que el en y los se del las un por con no su una para es al lo",
}
ALL_STOP_WORDS = sorted({w for v in STOP_WORDS.values() for w in v.split()})


@dataclass(frozen=True)
class Rule:
    """Reject unless ``low <= 100 * value / per <= high`` (a None bound is open).

    A zero ``per`` makes the rule hold.
    """

    name: str
    value: str
    per: str
    low: int | None = None
    high: int | None = None


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 200, 1500),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 30),
    Rule("shout_ratio", "n_shouts", "n_words", None, 30),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 5, None),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", None, 50),
    Rule("bullet_line_ratio", "n_bullet_lines", "n_lines", None, 90),
    Rule("dup_line_ratio", "n_dup_lines", "n_lines", None, 60),
)
STATISTICS = ("n_words", "word_chars", "n_stop_words", "n_repeat_words", "n_lines", "n_dup_lines",
              "n_ellipsis_lines", "n_bullet_lines", "n_symbols", "n_shouts")
MIN_WORDS = 50
MAX_REPEAT_PCT = 50


def repeated_words(words: Column, window: int = 3) -> Column:
    """Words inside windows of ``window`` words that occur twice or more.

    Windows are sorted by a 64-bit hash, with their places; equal neighbours
    are checked word by word, and the places that they cover are counted once:
    n log n in the words of one text.
    """
    n = F.size(words)
    span = range(window)
    keyed = F.transform(F.sequence(F.lit(0), n - window), lambda i: F.struct(
        F.xxhash64(*[F.get(words, i + k) for k in span]).alias("h"), i.alias("p")))

    def places(s: Column) -> Column:
        twin = F.filter(F.sequence(F.lit(1), n - window),
                        lambda j: F.get(s, j)["h"] == F.get(s, j - 1)["h"])
        both = F.transform(twin, lambda j: F.struct(F.get(s, j)["p"].alias("x"),
                                                    F.get(s, j - 1)["p"].alias("y")))
        same = F.filter(both, lambda b: F.slice(words, b["x"] + 1, F.lit(window))
                        == F.slice(words, b["y"] + 1, F.lit(window)))
        return F.size(F.array_distinct(F.flatten(F.transform(same, lambda b: F.array(
            *[b[c] + k for c in "xy" for k in span])))))

    return F.when(n > window, let(F.sort_array(keyed), places)).otherwise(F.lit(0))


def stats(text: Column) -> Column:
    """Struct of long statistics of one text (null: as the empty text)."""
    t = F.coalesce(text, F.lit(""))

    def long(c: Column, name: str) -> Column:
        return c.cast("bigint").alias(name)

    def of_lines(lines: Column) -> list[Column]:
        ends = lambda p: F.size(F.filter(lines, lambda x: x.rlike(p)))
        return [
            long(F.size(lines), "n_lines"),
            long(F.size(lines) - F.size(F.array_distinct(lines)), "n_dup_lines"),
            long(ends(rf"(\.\.\.|…)[{SPACE}]*$"), "n_ellipsis_lines"),
            long(ends(rf"^[{SPACE}]*[-*•][{SPACE}]"), "n_bullet_lines"),
        ]

    def of_words(words: Column) -> list[Column]:
        return [
            long(F.size(words), "n_words"),
            long(F.length(F.array_join(words, "")), "word_chars"),
            long(F.size(F.filter(words, lambda w: F.lower(w).isin(*ALL_STOP_WORDS))),
                 "n_stop_words"),
            long(repeated_words(words), "n_repeat_words"),
        ]

    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    return let(words_of(text), lambda w: let(lines, lambda ls: F.struct(
        *of_words(w), *of_lines(ls),
        long(F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")), "n_symbols"),
        long(F.length(F.regexp_replace(t, r"[^!]+", "")), "n_shouts"))))


def holds(s: Column, rule: Rule) -> Column:
    value, per = s[rule.value] * 100, s[rule.per]
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (value >= per * rule.low)
    if rule.high is not None:
        ok = ok & (value <= per * rule.high)
    return ok | (per == 0)


def base_failed(s: Column) -> Column:
    return ((s["n_words"] < MIN_WORDS)
            | (s["n_repeat_words"] * 100 > s["n_words"] * MAX_REPEAT_PCT))


def kept(s: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a statistics struct passes the base rule and all others."""
    ok = ~base_failed(s)
    for r in rules:
        ok = ok & holds(s, r)
    return ok


def verdict(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct of the statistics, ``base_failed``, ``broken`` and ``kept``."""
    def of(s: Column) -> Column:
        broken = F.filter(F.array(*[F.when(~holds(s, r), F.lit(r.name)) for r in rules]),
                          lambda x: x.isNotNull())
        return F.struct(*[s[n].alias(n) for n in STATISTICS],
                        base_failed(s).alias("base_failed"), broken.alias("broken"),
                        kept(s, rules).alias("kept"))
    return let(stats(text), of)


def judge(df: DataFrame, text_col: str = "text", out: str = "quality_rules",
          rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add struct column ``out``: statistics, ``base_failed``, ``broken`` (names of
    the rules that do not hold, in table order) and ``kept``.

    An input column called ``out`` is replaced; all others stay.  Null, empty and
    blank texts have zero statistics and fail the base rule.
    """
    return df.withColumn(out, verdict(F.col(text_col), rules))


def keep_good(df: DataFrame, text_col: str = "text",
              rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows whose text passes every rule; the columns are those of ``df``.

    The statistics are bound inside the predicate: a filter on a computed column
    would repeat them for every rule.
    """
    return df.filter(let(stats(F.col(text_col)), lambda s: kept(s, rules)))
