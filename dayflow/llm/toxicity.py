"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word's input joins its word vector (words of the fitted vocabulary; others
share one) and the mean of its character-gram vectors (runs of 3 to 5
characters, word edges included).  Two gated recurrent
layers read every window of ``WINDOW`` words in both directions, attention pools
their states, and a logistic unit scores the window.  Windows overlap by half
and cover the whole text; a document's score is that of its worst window.

A word of more than ``LONG_WORD`` characters (texts without white space, joined words)
is cut into overlapping pieces that are words of their own, so windows cover it too.

Everything is numpy.  Fitting uses a bounded sample of labelled documents
(``FIT_DOCS`` per label, by hash order, of any length); scoring reads whole texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayflow.llm.common import crc_fold, stretches

FIT_DOCS = 2000
HELD_OUT_FOLD, FOLDS = 1, 3
WINDOW, STRIDE = 32, 16
WORD_DIM, CHAR_DIM, HIDDEN = 8, 8, 8
VOCABULARY, MIN_DOCS = 20_000, 5
GRAM_SIZES, GRAMS = (3, 4, 5), 1 << 15
ROUNDS, PASSES, BATCH, RATE = 4, 3, 128, 0.01
WINDOWS_AT_ONCE = 4096
CACHED_WORDS = 1 << 18
COPY = 0.8                 # Jaccard similarity from which documents of one label are copies
LONG_WORD, PIECE = 48, 16  # pieces overlap by half
WORD_CHAR = re.compile(r"\w")
F32 = np.float32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return F32(0.5) * np.tanh(F32(0.5) * x) + F32(0.5)


def plain(word: str) -> str:
    """A word in lower case without leading and trailing marks."""
    word = word.lower()
    first = WORD_CHAR.search(word)
    if not first:
        return ""
    end = len(word)
    while not (word[end - 1].isalnum() or word[end - 1] == "_"):
        end -= 1
    return word[first.start():end]


def words_in(text: str) -> list[str]:
    """Words of a text; long ones as their overlapping pieces."""
    out = text.split()
    if len(text) <= LONG_WORD or not any(len(w) > LONG_WORD for w in out):
        return out
    return [p for w in out for p in ([w] if len(w) <= LONG_WORD else [
        w[i:i + PIECE] for i in range(0, len(w) - PIECE // 2, PIECE // 2)])]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Gram rows of all words, word after word, and how many each word has."""
    size = np.array([len(w) + 2 for w in words])
    chars = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le", "replace"),
                          np.uint32).astype(np.uint64)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(chars))   # characters to the word's end
    longest = max(GRAM_SIZES)
    padded = np.append(chars, np.zeros(longest, np.uint64))
    value, rows = np.full(len(chars), 1469598103, np.uint64), []
    for k in range(longest):
        value = (value ^ padded[k:k + len(chars)]) * np.uint64(1099511628211)
        if k + 1 in GRAM_SIZES:
            rows.append((value >> np.uint64(20)) % np.uint64(GRAMS))
    inside = left[:, None] >= np.array(GRAM_SIZES)
    per_word = np.add.reduceat(inside.sum(axis=1), np.cumsum(size) - size)
    return np.stack(rows, axis=1)[inside].astype(np.int64), per_word


def mean_rows(table: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean of the table rows of each word (zero for a word without any)."""
    out = np.zeros((len(counts), table.shape[1]), table.dtype)
    some = counts > 0
    if some.any():
        first = (np.cumsum(counts) - counts)[some]
        out[some] = np.add.reduceat(table[rows], first, axis=0) / counts[some, None]
    return out


def scatter_add(out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """``out[rows] += values`` with repeated rows added up."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    out[rows[first]] += np.add.reduceat(values[order], first, axis=0)


def window_starts(n: int) -> list[int]:
    """Window starts that cover ``n`` words; the last window ends with the text."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


@dataclass
class Model:
    """Vocabulary (word -> row; row 0: any other word) and parameters by name."""

    words: dict[str, int]
    p: dict[str, np.ndarray]
    _rows: dict[str, int] = field(default_factory=dict, repr=False)
    _table: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return {"words": self.words, "p": self.p, "_rows": {}, "_table": None}

    def inputs(self, words: list[str]) -> np.ndarray:
        """Input vectors of distinct words."""
        get = self.words.get
        word = self.p["word"][[get(w, 0) for w in words]]
        return np.hstack([word, mean_rows(self.p["char"], *grams(words))])

    def rows_of(self, words: list[str]) -> np.ndarray:
        """Rows of the cached projection table for raw words (row 0 is padding).

        There is room for ``CACHED_WORDS`` words; when it is used up, the cache
        starts again (rows given out before are then void).
        """
        if self._table is None:
            self._table = np.zeros((2, 1 + CACHED_WORDS, 3 * HIDDEN), F32)
        get = self._rows.get
        rows = list(map(get, words))
        new = dict.fromkeys(w for w, r in zip(words, rows) if r is None)
        if not new:
            return np.array(rows, np.int32)
        if len(self._rows) + len(new) > CACHED_WORDS:
            self._rows.clear()
            new = dict.fromkeys(words)
        at = 1 + len(self._rows)
        self._table[:, at:at + len(new)] = self.project(self.inputs([plain(w) for w in new]))
        self._rows.update(zip(new, range(at, at + len(new))))
        return np.array(list(map(get, words)), np.int32)

    def project(self, x: np.ndarray) -> np.ndarray:
        """What both layers add up from input vectors: (2, rows, 3 * HIDDEN)."""
        p = self.p
        return np.stack([x @ p[f"in_{d}"] + p[f"bias_{d}"] for d in "fb"]).astype(F32)

    def text_score(self, words: list[str]) -> float:
        return float(self.text_scores([words])[0])

    def text_scores(self, texts: list[list[str]]) -> np.ndarray:
        """Probability of label 1 per text: the maximum over its windows."""
        best = np.full(len(texts), -np.inf)
        step = CACHED_WORDS // 2            # words whose rows are looked up together
        group: list[tuple[int, list[str]]] = []
        size = 0
        for k, words in enumerate(texts):
            # neighbouring stretches of a long text share a window's words
            for lo in range(0, max(1, len(words)), step):
                part = words[max(0, lo - WINDOW):lo + step]
                if size + len(part) > step and group:
                    self._score_parts(group, best)
                    group, size = [], 0
                group.append((k, part))
                size += len(part)
        if group:
            self._score_parts(group, best)
        return 1 / (1 + np.exp(-best))

    def _score_parts(self, parts: list[tuple[int, list[str]]], best: np.ndarray) -> None:
        """Raise ``best`` of each part's text to the highest logit of its windows."""
        rows = self.rows_of([w for _, words in parts for w in words])
        owner, ids, at = [], [], 0
        for k, words in parts:
            own = rows[at:at + len(words)]
            at += len(words)
            if len(own) < WINDOW:
                own = np.concatenate([own, np.zeros(WINDOW - len(own), np.int32)])
            starts = np.array(window_starts(len(own)))
            ids.append(own[starts[:, None] + np.arange(WINDOW)])
            owner.append(np.full(len(starts), k))
        np.maximum.at(best, np.concatenate(owner), self.logits(self._table, np.concatenate(ids)))

    def logits(self, table: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = [self.forward(table, ids[lo:lo + WINDOWS_AT_ONCE])[0]
               for lo in range(0, len(ids), WINDOWS_AT_ONCE)]
        return np.concatenate(out)

    def forward(self, table: np.ndarray, ids: np.ndarray, keep: bool = False) -> tuple:
        """Logits of windows of table rows ``ids`` (row 0: padding)."""
        n, steps = ids.shape
        h = HIDDEN
        real = ids > 0
        padded = not real.all()
        states = np.zeros((steps, n, 2 * h), F32)
        saved = {}
        by_step = np.ascontiguousarray(ids.T)
        for d, name in enumerate(("f", "b")):
            u = self.p[f"loop_{name}"]
            part = table[d]
            s = np.zeros((n, h), F32)
            log = []
            for t in (range(steps) if d == 0 else range(steps - 1, -1, -1)):
                x = part[by_step[t]]
                g = s @ u
                zr = _sigmoid(x[:, :2 * h] + g[:, :2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(x[:, 2 * h:] + r * g[:, 2 * h:])
                new = c + z * (s - c)
                if padded:
                    new = np.where(real[:, t, None], new, s)
                if keep:
                    log.append((t, s, z, r, c, g[:, 2 * h:]))
                s = new
                states[t, :, h * d:h * (d + 1)] = s
            saved[name] = log
        e = states @ self.p["look"]                              # steps x n
        if padded:
            e = np.where(real.T, e, F32(-1e9))
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        if padded:
            a = a * real.T
        pooled = np.einsum("tn,tnh->nh", a, states)
        logit = pooled @ self.p["out"] + self.p["out_bias"][0]
        return logit, (states, a, pooled, saved, real)


def _backward(m: Model, table: np.ndarray, ids: np.ndarray, y: np.ndarray) -> tuple:
    """Loss, gradients of the recurrent parameters, and of the table's rows."""
    h = HIDDEN
    logit, (states, a, pooled, saved, real) = m.forward(table, ids, keep=True)
    prob = _sigmoid(logit)
    n, steps = ids.shape
    d = ((prob - y) / n).astype(F32)
    grad = {"out": pooled.T @ d, "out_bias": np.array([d.sum()], F32)}
    d_pool = d[:, None] * m.p["out"][None, :]
    d_a = np.einsum("nh,tnh->tn", d_pool, states)
    d_e = a * (d_a - (a * d_a).sum(axis=0))
    grad["look"] = np.einsum("tn,tnh->h", d_e, states)
    d_states = a[:, :, None] * d_pool[None] + d_e[:, :, None] * m.p["look"]
    d_all = np.empty((steps, n, 6 * h), table.dtype)
    for k, name in enumerate(("f", "b")):
        u = m.p[f"loop_{name}"]
        d_u = np.zeros_like(u)
        d_s = np.zeros((n, h), F32)
        for t, s, z, r, c, g in reversed(saved[name]):
            d_s = d_s + d_states[t, :, h * k:h * (k + 1)]
            on = real[:, t, None]
            d_new = np.where(on, d_s, 0)
            d_c = d_new * (1 - z) * (1 - c * c)
            d_z = d_new * (s - c) * z * (1 - z)
            d_r = d_c * g * r * (1 - r)
            d_x = np.hstack([d_z, d_r, d_c])
            d_g = np.hstack([d_z, d_r, d_c * r])
            d_all[t, :, 3 * h * k:3 * h * (k + 1)] = d_x
            d_u += s.T @ d_g
            d_s = np.where(on, d_new * z + d_g @ u.T, d_s)
        grad[f"loop_{name}"] = d_u
    d_table = np.zeros((table.shape[1], 6 * h), table.dtype)
    scatter_add(d_table, ids.T.ravel(), d_all.reshape(n * steps, -1))
    loss = -np.mean(np.log(np.where(y > 0, prob, 1 - prob) + 1e-7))
    return loss, grad, d_table


def first_of_copies(docs: list[list[str]]) -> list[int]:
    """Indices of the documents that are no near copy of an earlier kept one.

    Copies of one document would make all its rare words look like signs of its
    label.  Two documents are near copies if their sets of three-word runs have
    a Jaccard similarity of ``COPY`` or more.  Such sets share a run among the
    rarest 1 - ``COPY`` of either, so only documents that do are compared, and
    no pair is missed.
    """
    sets = [{" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))} for words in docs]
    held = Counter(r for runs in sets for r in runs)
    by_run: dict[str, list[int]] = {}
    keep = []
    for k, runs in enumerate(sets):
        n = len(runs)
        rarest = sorted(runs, key=lambda r: (held[r], r))[:n - math.ceil(COPY * n) + 1]
        others = dict.fromkeys(j for r in rarest for j in by_run.get(r, ()))
        if any(_similar(runs, sets[j]) for j in others):
            continue
        keep.append(k)
        for r in rarest:
            by_run.setdefault(r, []).append(k)
    return keep


def _similar(a: set[str], b: set[str]) -> bool:
    """Whether the Jaccard similarity is ``COPY`` or more."""
    if min(len(a), len(b)) < COPY * max(len(a), len(b)):
        return False
    both = len(a & b)
    return both >= COPY * (len(a) + len(b) - both)


def _odds(in_one: np.ndarray, in_zero: np.ndarray, n_one: int, n_zero: int) -> np.ndarray:
    """Clipped log odds of terms by their document counts; rare ones near zero."""
    raw = np.log((in_one + 0.5) / (n_one + 1)) - np.log((in_zero + 0.5) / (n_zero + 1))
    both = in_one + in_zero
    return np.clip(raw * both / (both + 5), -3, 3).astype(F32)


def _initial(words: dict[str, int], odds: np.ndarray, seed: int) -> Model:
    """Random parameters; a word vector's first entry starts at its log odds."""
    rng = np.random.default_rng(seed)
    def draw(*shape):
        return (rng.standard_normal(shape) / math.sqrt(shape[0])).astype(F32)
    p = {"word": (0.1 * rng.standard_normal((len(words) + 1, WORD_DIM))).astype(F32),
         "char": (0.1 * rng.standard_normal((GRAMS, CHAR_DIM))).astype(F32),
         "look": draw(2 * HIDDEN), "out": draw(2 * HIDDEN), "out_bias": np.zeros(1, F32)}
    p["word"][:, 0] = odds
    for name in "fb":
        p[f"in_{name}"] = draw(WORD_DIM + CHAR_DIM, 3 * HIDDEN)
        p[f"loop_{name}"] = draw(HIDDEN, 3 * HIDDEN)
        p[f"bias_{name}"] = np.zeros(3 * HIDDEN, F32)
    return Model(words, p)


def fit_texts(texts: list[str], labels: list[int], seed: int = 11) -> Model:
    """Train on labelled texts, one of each group of near copies of a label; without
    both labels, the model is a constant."""
    docs = [[plain(w) for w in words_in(t)] for t in texts]
    chosen = []
    for label in sorted(set(labels)):
        own = [k for k, v in enumerate(labels) if v == label]
        chosen += [own[j] for j in first_of_copies([docs[k] for k in own])]
    docs, labels = [docs[k] for k in chosen], [labels[k] for k in chosen]
    y = np.array(labels, F32)
    seen = {1: Counter(), 0: Counter()}
    for words, label in zip(docs, labels):
        seen[int(label)].update(set(words))
    n1, n0 = max(1, int(y.sum())), max(1, int(len(y) - y.sum()))
    ranked = sorted((w for w, c in (seen[0] + seen[1]).items() if c >= MIN_DOCS),
                    key=lambda w: (-seen[0][w] - seen[1][w], w))[:VOCABULARY]
    words = {w: i + 1 for i, w in enumerate(ranked)}
    odds = np.zeros(len(words) + 1, F32)
    if words:
        odds[1:] = _odds(*(np.array([seen[k][w] for w in ranked], float) for k in (1, 0)), n1, n0)
    m = _initial(words, odds, seed)
    if not len(y) or y.min() == y.max():
        m.p["out"][:] = 0
        p1 = (y.sum() + 1) / (len(y) + 2)
        m.p["out_bias"][0] = math.log(p1 / (1 - p1))
        return m
    vocab = list(dict.fromkeys(w for d in docs for w in d))
    row = {w: i + 1 for i, w in enumerate(vocab)}
    flat, size = grams(vocab)
    first = np.cumsum(size) - size
    word_row = np.array([words.get(w, 0) for w in vocab])

    def grams_of(some: np.ndarray) -> np.ndarray:
        """Gram rows of the vocabulary entries ``some``, in order."""
        n = size[some]
        return flat[np.repeat(first[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    # grams start at the odds of the documents that hold them
    in_docs = np.zeros((2, GRAMS))
    for d, label in zip(docs, labels):
        own = np.array([row[w] - 1 for w in set(d)], np.int64)
        in_docs[int(label), np.unique(grams_of(own))] += 1
    m.p["char"][:, 0] = _odds(in_docs[1], in_docs[0], n1, n0)
    all_ids, owner = [], []
    for k, d in enumerate(docs):
        r = np.array([row[w] for w in d], np.int32)
        if len(r) < WINDOW:
            r = np.concatenate([r, np.zeros(WINDOW - len(r), np.int32)])
        starts = np.array(window_starts(len(r)))
        all_ids.append(r[starts[:, None] + np.arange(WINDOW)])
        owner.append(np.full(len(starts), k))
    ids, owner = np.concatenate(all_ids), np.concatenate(owner)
    rng = np.random.default_rng(seed)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.p.items()}
    tick = 0

    def table_of(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inputs and projections of the vocabulary rows ``some`` (padding first)."""
        x = np.zeros((len(some) + 1, WORD_DIM + CHAR_DIM), F32)
        x[1:, :WORD_DIM] = m.p["word"][word_row[some]]
        x[1:, WORD_DIM:] = mean_rows(m.p["char"], grams_of(some), size[some])
        return x, m.project(x)

    def step(batch: np.ndarray, target: np.ndarray) -> None:
        nonlocal tick
        some, local = np.unique(batch, return_inverse=True)
        local = local.reshape(batch.shape)
        if some[0] == 0:
            some = some[1:]
        else:
            local = local + 1
        x, table = table_of(some - 1)
        _, grad, d_table = _backward(m, table, local, target)
        d_x = np.zeros_like(x)
        for k, name in enumerate("fb"):
            part = d_table[:, 3 * HIDDEN * k:3 * HIDDEN * (k + 1)]
            grad[f"in_{name}"], grad[f"bias_{name}"] = x.T @ part, part[1:].sum(axis=0)
            d_x += part @ m.p[f"in_{name}"].T
        grad["word"], grad["char"] = np.zeros_like(m.p["word"]), np.zeros_like(m.p["char"])
        scatter_add(grad["word"], word_row[some - 1], d_x[1:, :WORD_DIM])
        n = size[some - 1]
        share = d_x[1:, WORD_DIM:] / np.maximum(n, 1)[:, None]
        scatter_add(grad["char"], grams_of(some - 1), np.repeat(share, n, axis=0))
        tick += 1
        for k, g in grad.items():
            a, b = moment[k]
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            rate = RATE * math.sqrt(1 - 0.99 ** tick) / (1 - 0.9 ** tick)
            m.p[k] -= (rate * a / (np.sqrt(b) + 1e-8)).astype(F32)

    for turn in range(ROUNDS):
        # each document stands for its worst window, a clean one for another too
        if turn:
            worth = m.logits(table_of(np.arange(len(vocab)))[1], ids)
        else:
            hint = odds[word_row] + mean_rows(m.p["char"][:, :1], flat, size)[:, 0]
            worth = np.concatenate([[0], hint])[ids].max(axis=1)
        order = np.lexsort((-worth, owner))
        top = order[np.flatnonzero(np.r_[True, owner[order][1:] != owner[order][:-1]])]
        extra = rng.permutation(np.flatnonzero(y[owner] == 0))[:len(docs)]
        chosen = np.concatenate([top, extra])
        for _ in range(PASSES):
            mixed = rng.permutation(chosen)
            size_now = max(8, min(BATCH, len(mixed) // 24))   # small samples: more, smaller steps
            for lo in range(0, len(mixed), size_now):
                part = mixed[lo:lo + size_now]
                step(ids[part], y[owner[part]])
    return m


def fit(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id",
        text_col: str = "text", fit_docs: int = FIT_DOCS) -> Model:
    """Fit on at most ``fit_docs`` whole documents per label outside the held-out fold."""
    rows: list[tuple[str, int]] = []
    texts = docs.select(F.col(id_col), F.col(text_col).alias("_text")).filter("_text is not null")
    usable = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .filter(crc_fold(F.col(id_col), FOLDS) != HELD_OUT_FOLD))
    for label in (0, 1):
        order = [F.xxhash64(id_col), F.col(id_col)]
        chosen = (usable.filter(F.col(label_col) == label).select(id_col)
                  .orderBy(*order).limit(fit_docs))
        got = (texts.join(F.broadcast(chosen), id_col)
               .orderBy(*order, F.xxhash64("_text")).limit(fit_docs).select("_text").collect())
        rows += [(r["_text"], label) for r in got]
    return fit_texts([t for t, _ in rows], [v for _, v in rows])


def score(spark: SparkSession, text: Column, model: Model) -> Column:
    """Probability of label 1 of whole texts (null: as the empty text).

    The model is broadcast: at most ``VOCABULARY`` words and fixed layers.
    """
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in stretches(batches, 1 << 20):
            yield pa.array(m.text_scores([words_in(t or "") for t in texts]), pa.float64())

    return F.arrow_udf(run, "double")(text)
