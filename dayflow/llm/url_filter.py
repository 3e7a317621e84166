"""URL filters as a sort-merge range join, in DataFrame operations only.

A host's canonical key is its labels reversed, each followed by a dot
(``www.example.com`` -> ``com.example.www.``).  The keys of a rule host and all
its subdomains are those between the rule's key and the next key without that
prefix, so a rule is an interval, and any two intervals nest or are apart.

Rules and distinct hosts are sorted together; the sweep carries the stack of
rules nested around the last rule that began, and a host pops those whose
interval has ended.  The paths of one rule host are swept the same way: a path
prefix is an interval of the sorted paths, so every (rule host, path) that is asked for
finds its longest prefix among that host's path rules.  The longest rule wins.

Hosts are swept in groups of their first two labels and paths in groups of their rule
host; a group takes as many cells as its rows need (``CELL_ROWS``), and rules go to
every cell of their group (rules of one label: to every group below it).  Only distinct
hosts and paths are swept: urls join the result, so a host with a third of all pages is
one row of the sweep, and its join is split by adaptive skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL_ROWS = 50_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
DEFAULT_VERDICT = "allow"


def host_of(url: Column) -> Column:
    """Host of a url, A-Z lower-cased; empty without ``://`` and for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """Reversed labels, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _after(key: Column) -> Column:
    """The smallest key beyond all that start with ``key`` (``/`` follows ``.``)."""
    return F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/"))


def _group(key: Column) -> Column:
    """First two labels of a key."""
    return F.substring_index(key, ".", 2)


def clean_rules(rules: DataFrame) -> DataFrame:
    """``(host, path, verdict)``, one row per host and path; of equal rules, ``block`` counts."""
    return (rules.select(F.translate("host", UPPER, LOWER).alias("host"),
                         F.coalesce("path", F.lit("")).alias("path"), "verdict")
            .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))


def host_stacks(rules: DataFrame) -> DataFrame:
    """``(key, stack)`` per rule host: all rule hosts around it, itself included, each with
    its interval."""
    entry = (rules.select("host").distinct().withColumn("key", host_key(F.col("host")))
             .withColumn("until", _after(F.col("key"))))
    labels = F.split(F.expr("substring(key, 1, length(key) - 1)"), r"\.")
    around = entry.select("key", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit("."))))
        .alias("outer"))
    outer = entry.select(F.col("key").alias("outer"), F.struct("key", "until", "host").alias("entry"))
    return (around.join(outer, "outer").groupBy("key")
            .agg(F.sort_array(F.collect_list("entry")).alias("stack")))


def path_chains(rules: DataFrame) -> DataFrame:
    """``(host, path, chain)`` per rule: the rules of its host whose paths its own path
    starts with, itself included, shortest first."""
    starts = rules.select("host", "path", F.explode(F.transform(
        F.sequence(F.lit(0), F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n))).alias("start"))
    inner = rules.select("host", F.col("path").alias("start"),
                         F.struct(F.length("path").alias("n"), "path", "verdict").alias("rule"))
    return (starts.join(inner, ["host", "start"]).groupBy("host", "path")
            .agg(F.sort_array(F.collect_list("rule")).alias("chain")))


def _cells(rows: DataFrame, *group: str) -> DataFrame:
    """``(group, salts)``: cells that the rows of a group are dealt to."""
    return rows.groupBy(*group).agg(
        F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("salts"))


def _swept(rules: DataFrame, rows: DataFrame, cell: list[str], order: str, carried: str) -> DataFrame:
    """``rows`` with ``carried`` of the last of ``rules`` at or before them in their cell."""
    both = (rules.select(*cell, order, carried, F.lit(True).alias("_rule"))
            .unionByName(rows.select(*cell, order, F.lit(False).alias("_rule"),
                                     *[c for c in rows.columns if c not in (*cell, order)]),
                         allowMissingColumns=True))
    w = (Window.partitionBy(*cell).orderBy(order, F.col("_rule").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return both.withColumn(carried, F.last(carried, ignorenulls=True).over(w)).filter("not _rule")


def sweep(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, stack)``: the rule hosts whose interval holds each distinct host."""
    label = F.substring_index(F.col("key"), ".", 1)
    seen = (hosts.select("host").distinct().withColumn("key", host_key(F.col("host")))
            .withColumns({"label": label, "group": _group(F.col("key"))}))
    cells = _cells(seen, "label", "group")
    stacks = host_stacks(rules).withColumns({"label": label, "group": _group(F.col("key")),
                                             "one": F.size(F.split("key", r"\.")) <= 2})
    begins = (stacks.filter("one").select("key", "stack", "label").join(cells, "label")
              .unionByName(stacks.filter("not one").select("key", "stack", "label", "group")
                           .join(cells.drop("label"), "group"))
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))))
    dealt = seen.join(cells.drop("label"), "group").select(
        "group", F.pmod(F.xxhash64("host"), F.col("salts")).cast("int").alias("salt"), "key", "host")
    swept = _swept(begins, dealt, ["group", "salt"], "key", "stack")
    return swept.select("host", F.filter(
        "stack", lambda e: (e["key"] <= F.col("key")) & (F.col("key") < e["until"]))
        .alias("stack")).filter(F.size("stack") > 0)


def sweep_paths(asked: DataFrame, rules: DataFrame) -> DataFrame:
    """``(rule_host, path, rule)``: the longest of the rule host's path rules that each
    distinct ``(rule_host, path)`` starts with (rows without one are left out)."""
    seen = asked.select("rule_host", "path").distinct()
    cells = _cells(seen, "rule_host")
    chains = path_chains(rules).withColumnRenamed("host", "rule_host")
    begins = chains.join(cells, "rule_host").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    dealt = seen.join(cells, "rule_host").select(
        "rule_host", F.pmod(F.xxhash64("path"), F.col("salts")).cast("int").alias("salt"), "path")
    swept = _swept(begins, dealt, ["rule_host", "salt"], "path", "chain")
    open_ = F.filter("chain", lambda r: F.startswith(F.col("path"), r["path"]))
    return swept.select("rule_host", "path", F.get(open_, F.size(open_) - 1).alias("rule")) \
        .filter("rule is not null")


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url",
          default: str = DEFAULT_VERDICT) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of these
    names are replaced).

    The longest rule (host and path) that fits wins; with none, ``rule`` is null
    and the verdict ``default``.  Null urls and urls without ``://`` have an
    empty host and path.  Repeated rows are rows of their own, each with its verdict.
    """
    cols = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    urls = pages.select(F.struct(*cols).alias("_page"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    rules = clean_rules(rules)
    seen = urls.select("host", "path").distinct()
    asked = seen.join(sweep(seen, rules), "host").select(
        "host", "path", F.explode("stack.host").alias("rule_host"))
    fits = asked.join(sweep_paths(asked, rules), ["rule_host", "path"])
    n_host = F.length("rule_host")
    best = fits.groupBy("host", "path").agg(F.max(F.struct(
        (n_host + F.col("rule.n")).alias("size"), n_host.alias("n_host"),
        F.concat("rule_host", "rule.path").alias("rule"),
        F.col("rule.verdict").alias("verdict"))).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "_page.*", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
