"""Quality classifier: a sparse ensemble of conjunctive rules.

Shallow trees are grown on text statistics; every node's path is a rule, a
conjunction of threshold tests.  A lasso-penalised logistic regression over the
rules keeps few of them, and those are compiled into one Spark column, so
scoring all documents runs without user functions.

Fitting uses a bounded sample of labelled rows (``FIT_ROWS``, by hash order);
only their statistics, not their texts, reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayflow.llm.common import crc_fold, fresh, let, words_of

FIT_ROWS = 20_000
HELD_OUT_FOLD, FOLDS = 1, 3
N_TREES, DEPTH, MIN_LEAF, CUTS = 40, 3, 5, 32
LASSO, ROUNDS = 2e-3, 500

STATISTICS = ("n_words", "word_chars", "symbols", "pipes", "shouts", "upper", "digits", "stops",
              "distinct", "line_words", "repeated_lines")


def statistics(text: Column) -> Column:
    """Struct of double statistics of one text; ratios are per word or character."""
    t = F.coalesce(text, F.lit(""))
    count = lambda keep: F.length(F.regexp_replace(t, f"[^{keep}]+", ""))

    def of(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1))
        chars = F.greatest(F.length(t), F.lit(1))
        lines = F.split(t, "\n")
        values = (
            F.size(words),
            F.length(F.array_join(words, "")) / n,
            count(r"#*$%&<>@~^=_\\") / n,
            count("|") / n,
            count("!?") / n,
            count(r"\p{Lu}") / chars,
            count(r"\p{Nd}") / chars,
            count(".,;:") / n,
            F.size(F.array_distinct(words)) / n,
            F.size(words) / F.size(lines),
            1 - F.size(F.array_distinct(lines)) / F.size(lines))
        return F.struct(*[c.cast("double").alias(name) for name, c in zip(STATISTICS, values)])

    return let(words_of(text), of)


@dataclass(frozen=True)
class Test:
    """``statistic <= cut`` or, if ``above``, ``statistic > cut``."""

    statistic: str
    cut: float
    above: bool

    def column(self, stats: Column) -> Column:
        x = stats[self.statistic]
        return x > F.lit(self.cut) if self.above else x <= F.lit(self.cut)


@dataclass(frozen=True)
class Ensemble:
    """Intercept and weighted rules; a rule is a tuple of tests."""

    intercept: float
    rules: tuple[tuple[tuple[Test, ...], float], ...]

    def score(self, stats: Column) -> Column:
        """Probability of label 1 as a column expression."""
        total = F.lit(self.intercept)
        for tests, weight in self.rules:
            held = tests[0].column(stats)
            for t in tests[1:]:
                held = held & t.column(stats)
            total = total + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _grow(x: np.ndarray, target: np.ndarray, cuts: list[np.ndarray], rows: np.ndarray,
          columns: np.ndarray, path: tuple, depth: int, out: list) -> None:
    """Least-squares tree; appends the path of every node but the root."""
    if path:
        out.append(path)
    if depth == 0 or len(rows) < 2 * MIN_LEAF:
        return
    y = target[rows]
    best = (1e-9, None)
    for c in columns:
        v = x[rows, c]
        at = np.searchsorted(cuts[c], v, "left")          # v <= cuts[k] iff at <= k
        size = len(cuts[c]) + 1
        n = np.cumsum(np.bincount(at, minlength=size))[:-1]
        s = np.cumsum(np.bincount(at, weights=y, minlength=size))[:-1]
        m = len(rows) - n
        ok = (n >= MIN_LEAF) & (m >= MIN_LEAF)
        if not ok.any():
            continue
        gain = np.where(ok, s ** 2 / np.maximum(n, 1) + (y.sum() - s) ** 2 / np.maximum(m, 1), -1)
        k = int(gain.argmax())
        if (won := gain[k] - y.sum() ** 2 / len(rows)) > best[0]:
            best = (won, (c, float(cuts[c][k])))
    if best[1] is None:
        return
    c, cut = best[1]
    below = x[rows, c] <= cut
    for above, part in ((False, rows[below]), (True, rows[~below])):
        _grow(x, target, cuts, part, columns, (*path, (int(c), cut, above)), depth - 1, out)


def _holds(x: np.ndarray, path: tuple) -> np.ndarray:
    held = np.ones(len(x), bool)
    for c, cut, above in path:
        held &= (x[:, c] > cut) if above else (x[:, c] <= cut)
    return held


def _lasso(rules: np.ndarray, y: np.ndarray, penalty: float, rounds: int) -> tuple:
    """Logistic weights under an l1 penalty (accelerated proximal gradient)."""
    n, m = rules.shape
    a = np.hstack([np.ones((n, 1)), rules])
    top = np.linalg.eigvalsh(a.T @ a / n)[-1]
    step = 4 / max(top, 1e-9)
    w = v = np.zeros(m + 1)
    w[0] = np.log((y.sum() + 1) / (n - y.sum() + 1))
    momentum = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ v, -30, 30)))
        new = v - step * (a.T @ (p - y)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        nxt = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        v = new + (momentum - 1) / nxt * (new - w)
        w, momentum = new, nxt
    return w[0], w[1:]


def fit_matrix(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = STATISTICS,
               seed: int = 3) -> Ensemble:
    """Fit on a statistics matrix; without both labels, a constant ensemble."""
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return Ensemble(float(np.log(p / (1 - p))), ())
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, c], np.linspace(0, 1, CUTS + 2)[1:-1])) for c in
            range(x.shape[1])]
    score = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    paths: list[tuple] = []
    for _ in range(N_TREES):                # boosted on logistic residuals
        rows = rng.choice(len(y), max(2 * MIN_LEAF, len(y) // 2), replace=len(y) < 4 * MIN_LEAF)
        columns = rng.choice(x.shape[1], max(1, x.shape[1] * 2 // 3), replace=False)
        residual = y - 1 / (1 + np.exp(-score))
        grown: list[tuple] = []
        _grow(x, residual, cuts, rows, np.sort(columns), (), DEPTH, grown)
        paths += grown
        inner = {p[:-1] for p in grown}
        for p in grown:
            if p not in inner:
                held = _holds(x, p)
                score[held] += 0.3 * residual[held].mean() * 4
    paths = list(dict.fromkeys(paths))
    if not paths:
        return Ensemble(float(np.log(y.mean() / (1 - y.mean()))), ())
    rules = np.column_stack([_holds(x, p) for p in paths]).astype(np.float64)
    _, first = np.unique(rules, axis=1, return_index=True)   # rules that hold alike count once
    keep = np.sort(first)
    b, w = _lasso(rules[:, keep], y.astype(np.float64), LASSO, ROUNDS)
    return Ensemble(float(b), tuple(
        (tuple(Test(names[c], cut, above) for c, cut, above in paths[k]), float(wk))
        for k, wk in zip(keep, w) if abs(wk) > 1e-6))


def fit(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id",
        text_col: str = "text", fit_rows: int = FIT_ROWS) -> Ensemble:
    """Fit on at most ``fit_rows`` labelled rows outside the held-out fold.

    Rows are chosen by the hash of their id.  Null labels are not used; a
    repeated id counts once per row.
    """
    order = [F.xxhash64(id_col), F.col(id_col)]
    chosen = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .filter(crc_fold(F.col(id_col), FOLDS) != HELD_OUT_FOLD)
              .select(F.col(id_col), F.col(label_col).cast("int").alias("_label"))
              .orderBy(*order, "_label").limit(fit_rows))
    rows = (docs.select(F.col(id_col), F.col(text_col)).join(F.broadcast(chosen), id_col)
            .withColumn("_s", statistics(F.col(text_col)))
            .select(id_col, "_label", *[F.col("_s")[c].alias(f"_{c}") for c in STATISTICS])
            .orderBy(*order, "_label", *[f"_{c}" for c in STATISTICS]).limit(fit_rows)
            .toPandas())
    return fit_matrix(rows[[f"_{c}" for c in STATISTICS]].to_numpy(float),
                      rows["_label"].to_numpy(float))


def score(docs: DataFrame, model: Ensemble, text_col: str = "text",
          out: str = "quality_score") -> DataFrame:
    """``docs`` with column ``out``; null and empty texts are scored as empty texts."""
    stats = fresh(docs, "_rule_statistics")
    return (docs.withColumn(stats, statistics(F.col(text_col)))
            .withColumn(out, model.score(F.col(stats))).drop(stats))
