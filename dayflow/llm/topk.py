"""Exact top-k inner-product search over norm-sorted, rotated vectors.

Components are integers, so scores are exact.  Rows are placed in sectors: a
band of lengths, the nearest of a few pivot directions, and a ring of distance
from that pivot.  Of each sector all rows' extremes are kept: the range of the
part along the pivot and the longest part beside it, which bound any score of a
query in the sector (partial sum plus Cauchy-Schwarz on the residuals).  A query

1. takes a first threshold from the longest vectors, and a better one from one
   cell of the sector with the highest bound;
2. is then sent to the sectors whose bound reaches its threshold, and to no other.

A sector is cut into cells of bounded size.  A rotation (the right singular
vectors, from the Gram matrix) moves most of the length into the first
coordinates; in a cell candidates are taken by descending length, in strips:

* a query stops at the first strip whose longest vector cannot reach its
  threshold (``|q| |c| < t``);
* otherwise the inner product over the first coordinates plus the product of
  the two residual lengths (Cauchy-Schwarz) bounds the score, and only
  candidates whose bound reaches the threshold are scored exactly.

Each cell returns at most k rows a query.  The rotation and the pivots cover the
first ``ROTATED`` components; further ones count in the residual lengths and are
multiplied in blocks, so a long vector costs its own components only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayflow.session import materialize

SCALE = 1024
CELL_VECTORS = 16384       # candidates of a cell
CELL_QUERIES = 1024        # queries of a cell
CELL_COMPONENTS = 1 << 22  # components of a cell's candidates, and of its queries
ROTATED = 256              # components that the rotation and the pivots cover
TAIL = 512                 # components of a block beyond them
SEED_VECTORS = 1024        # longest vectors that give the first thresholds ...
SEED_WIDTH = 4096          # ... of at most so many components
STRIP = 2048
PIVOTS = 64                # directions at most; their number follows the rows
PIVOT_SAMPLE = 4096        # rows that the pivots are fitted on; every row is placed
BANDS = (0.25, 0.5, 0.75, 0.9, 0.97, 0.99, 0.999)  # quantiles of length between bands
RINGS = 3
EXACT = float(1 << 52)     # integers below this are exact in doubles


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component; null if any is null or not finite."""
    x = lambda c: c.cast("double")
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(x(c)) | (F.abs(x(c)) == math.inf))
    return F.when(~bad, F.transform(vector, lambda c: F.floor(x(c) * scale)))


class Vectors:
    """Rows of any length: the first ``width`` components dense, the rest ragged."""

    def __init__(self, flat: np.ndarray, size: np.ndarray, width: int):
        row = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        self.head = np.zeros((len(size), width))
        self.head[row[at < width], at[at < width]] = flat[at < width]
        self.tail = flat[at >= width]
        self.tail_size = np.maximum(size - width, 0)
        self.tail_start = np.cumsum(self.tail_size) - self.tail_size
        self.norm2 = np.bincount(row, flat * flat, len(size))

    @classmethod
    def of(cls, column: pa.ChunkedArray | pa.Array, width: int) -> Vectors:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return cls(flat, np.asarray(column.value_lengths(), np.int64), width)

    @classmethod
    def dense(cls, matrix: np.ndarray) -> Vectors:
        n, width = matrix.shape
        return cls(matrix.astype(np.float64).ravel(), np.full(n, width), width)

    def __len__(self) -> int:
        return len(self.head)

    def block(self, rows: np.ndarray, lo: int) -> np.ndarray:
        """``TAIL`` components from ``lo`` on of the tails of ``rows``."""
        at = lo + np.arange(TAIL)[None, :]
        inside = at < self.tail_size[rows, None]
        return np.where(inside, self.tail[np.where(inside, self.tail_start[rows, None] + at, 0)],
                        0.0)


def _gram(vectors: DataFrame, width: int) -> np.ndarray:
    """Sum of outer products over the first ``width`` components of all vectors:
    ``width`` squared numbers, at most ``ROTATED`` squared."""
    def run(batches):
        total = np.zeros((width, width))
        for b in batches:
            m = Vectors.of(b.column(0), width).head
            total += m.T @ m
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), pa.array(list(total), pa.list_(pa.float64()))],
            ["i", "row"])
    rows = (vectors.select(F.slice("v", 1, width).alias("v"))
            .mapInArrow(run, "i bigint, row array<double>")
            .select("i", F.posexplode("row").alias("j", "x"))
            .groupBy("i", "j").agg(F.sum("x").alias("x")).collect())
    out = np.zeros((width, width))
    for r in rows:
        out[r.i, r.j] = r.x
    return out


def _number(a: Vectors, b: Vectors) -> type:
    """Doubles where every partial sum of a product is an exact one, else integers."""
    reach = math.sqrt(a.norm2.max(initial=0)) * math.sqrt(b.norm2.max(initial=0))
    return np.float64 if reach < EXACT else np.int64


def _products(a: Vectors, i: np.ndarray, b: Vectors, j: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows ``i`` of ``a`` with all rows ``j`` of ``b``."""
    kind = _number(a, b)
    out = a.head[i].astype(kind) @ b.head[j].astype(kind).T
    left, right = a.tail_size[i], b.tail_size[j]
    for lo in range(0, min(left.max(initial=0), right.max(initial=0)), TAIL):
        x, y = np.flatnonzero(left > lo), np.flatnonzero(right > lo)
        out[np.ix_(x, y)] += a.block(i[x], lo).astype(kind) @ b.block(j[y], lo).astype(kind).T
    return out.astype(np.int64)


def _pairs(a: Vectors, i: np.ndarray, b: Vectors, j: np.ndarray) -> np.ndarray:
    """Integer inner products of the corresponding rows ``i`` of ``a`` and ``j`` of ``b``."""
    kind = _number(a, b)
    dots = lambda x, y: np.einsum("ij,ij->i", x.astype(kind), y.astype(kind))
    out = dots(a.head[i], b.head[j])
    shared = np.minimum(a.tail_size[i], b.tail_size[j])
    for lo in range(0, shared.max(initial=0), TAIL):
        on = np.flatnonzero(shared > lo)
        out[on] += dots(a.block(i[on], lo), b.block(j[on], lo))
    return out.astype(np.int64)


def _best(rows: tuple, k: int) -> tuple:
    """The ``k`` best ``(query, id, score)`` of each query; ties to the smaller id."""
    q, ids, score = rows
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    keep = rank < k
    return q[keep], ids[keep], score[keep]


def first_floor(queries: Vectors, query_ids: np.ndarray, seeds: Vectors, seed_ids: np.ndarray,
                k: int) -> np.ndarray:
    """The ``k``-th best score of each query among the seeds: a lower score is not needed."""
    if len(seeds) <= k:
        return np.full(len(queries), -math.inf)
    s = _products(queries, np.arange(len(queries)), seeds, np.arange(len(seeds)))
    s = np.where(query_ids[:, None] == seed_ids[None, :], -math.inf, s)
    return np.partition(s, -k, axis=1)[:, -k]


def search_cell(queries: Vectors, query_ids: np.ndarray, cands: Vectors, cand_ids: np.ndarray,
                floor: np.ndarray, rotation: np.ndarray,
                k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Top-k of one cell as ``(query row, candidate id, score)``; scores below a query's
    ``floor`` may be left out."""
    nq, floor = len(queries), floor.astype(np.float64)
    order = np.lexsort((cand_ids, -cands.norm2))
    lengths, q_len = np.sqrt(cands.norm2), np.sqrt(queries.norm2)
    head = max(1, len(rotation) // 4)
    qr, cr = queries.head @ rotation[:, :head], cands.head @ rotation[:, :head]
    q_rest = np.sqrt(np.maximum(queries.norm2 - (qr * qr).sum(1), 0))
    c_rest = np.sqrt(np.maximum(cands.norm2 - (cr * cr).sum(1), 0))
    slack = 1e-6 * (1 + q_len.max(initial=0) * lengths.max(initial=0))  # rounding of bounds
    some = max(1, (1 << 22) // max(TAIL, len(rotation)))
    best = (np.empty(0, np.int64),) * 3
    for lo in range(0, len(cands), STRIP):
        part = order[lo:lo + STRIP]
        live = np.flatnonzero(q_len * lengths[part[0]] + slack >= floor)
        if not len(live):
            break
        bound = qr[live] @ cr[part].T + q_rest[live, None] * c_rest[None, part] + slack
        i, j = np.nonzero(bound >= floor[live, None])
        other = query_ids[live[i]] != cand_ids[part[j]]
        i, j = i[other], j[other]
        if not len(i):
            continue
        if len(i) * 4 > len(live) * len(part):  # little was pruned: all products at once
            score = _products(queries, live, cands, part)[i, j]
        else:
            score = np.concatenate([
                _pairs(queries, live[i[x:x + some]], cands, part[j[x:x + some]])
                for x in range(0, len(i), some)])
        i, j = live[i], part[j]
        hit = score >= floor[i]
        best = _best(tuple(np.concatenate([a, b]) for a, b in zip(
            best, (i[hit], cand_ids[j[hit]], score[hit]))), k)
        counts = np.bincount(best[0], minlength=nq)
        full = counts >= k
        last = np.cumsum(counts) - 1
        floor[full] = np.maximum(floor[full], best[2][last[full]])
    return best


def fit_pivots(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """At most ``count`` unit directions: spherical k-means of the sample's rows."""
    rows = sample[(sample * sample).sum(1) > 0]
    if not len(rows):
        return np.eye(1, sample.shape[1])
    rows = rows / np.sqrt((rows * rows).sum(1))[:, None]
    pivots = rows[np.linspace(0, len(rows) - 1, min(count, len(rows))).astype(int)]
    for _ in range(rounds):
        near = (rows @ pivots.T).argmax(1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, near, rows)
        length = np.sqrt((sums * sums).sum(1))[:, None]
        pivots = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), pivots)
    return pivots


def place(vectors: Vectors, pivots: np.ndarray,
          bands: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sector, part along the sector's pivot and length beside it, of each row."""
    along = vectors.head @ pivots.T
    near = along.argmax(1)
    along = along[np.arange(len(near)), near]
    length = np.sqrt(vectors.norm2)
    beside = np.sqrt(np.maximum(vectors.norm2 - along * along, 0))
    ring = np.minimum((RINGS * beside / np.maximum(length, 1e-300)).astype(np.int64), RINGS - 1)
    band = np.searchsorted(bands, vectors.norm2)
    return (band * len(pivots) + near) * RINGS + ring, along, beside


@dataclass
class Sectors:
    """Extremes of the sectors that hold rows, in columns; at most
    ``(len(BANDS) + 1) * PIVOTS * RINGS`` of them."""
    code: np.ndarray       # ascending
    low: np.ndarray        # part along the pivot: smallest, largest
    high: np.ndarray
    beside: np.ndarray     # longest part beside the pivot
    norm2: np.ndarray      # longest row
    cells: np.ndarray      # cells that the sector is cut into
    pivots: np.ndarray

    def bounds(self, queries: Vectors) -> np.ndarray:
        """No row of sector ``s`` scores above ``bounds[q, s]`` with query ``q``."""
        along = queries.head @ self.pivots.T
        rest = np.sqrt(np.maximum(queries.norm2[:, None] - along * along, 0))
        pivot = self.code // RINGS % len(self.pivots)
        along, rest = along[:, pivot], rest[:, pivot]
        by_parts = np.maximum(along * self.low, along * self.high) + rest * self.beside
        by_length = np.sqrt(queries.norm2)[:, None] * np.sqrt(self.norm2)
        return np.minimum(by_parts, by_length) + 1e-6 * (1 + by_length)  # rounding

    def reached(self, queries: Vectors, floor: np.ndarray) -> np.ndarray:
        """Which sectors each query has to be sent to."""
        return self.bounds(queries) >= floor[:, None]


def _parts(batches, rows: int = 512):
    """Arrow batches in stretches of few rows, since bounds are rows times sectors."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def _groups(queries: DataFrame, sectors: Sectors, cell_queries: int,
            per_cell: bool) -> DataFrame:
    """``(sector, cells, groups)`` of the sectors with queries, for a broadcast: query groups
    are of bounded size.  ``queries`` has a row for each query and sector it is sent to
    (``per_cell``: to one cell of it)."""
    found = queries.groupBy("sector").agg(F.count(F.lit(1)).alias("n"),
                                          F.sum(F.size("v")).alias("m")).toArrow()
    code = found["sector"].to_numpy()
    cells = sectors.cells[np.searchsorted(sectors.code, code)]
    shares = cells if per_cell else 1
    groups = np.maximum(-(-found["n"].to_numpy() // (cell_queries * shares)),
                        -(-found["m"].to_numpy() // (CELL_COMPONENTS * shares)))
    return F.broadcast(queries.sparkSession.createDataFrame(pa.table(
        {"sector": code, "cells": cells, "groups": np.maximum(groups, 1)})))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = SCALE, cell_vectors: int = CELL_VECTORS,
          cell_queries: int = CELL_QUERIES) -> DataFrame:
    """``(query_id, rank, id_col, score)``: the ``k`` best candidates of each query row.

    Candidates are all rows but those with the query's own id.  Rows with a null
    id, a null vector, or a null or non-finite component take no part; shorter
    vectors count as padded with zeros, whatever the longest one's length; an empty
    query set gives no rows.  Rows of one id are candidates (or queries) of their own.
    Scores are exact while they fit 64 bits.
    """
    table = materialize(
        vectors.select(F.col(id_col).alias("id"), quantized(F.col(vector_col), scale).alias("v"),
                       is_query.alias("ask"), F.monotonically_increasing_id().alias("row"))
        .filter("id is not null and v is not null")
        .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)), "topk-vectors")
    n, width, bands = table.agg(
        F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0)),
        F.percentile_approx("norm2", list(BANDS), 10000)).first()
    width, bands = min(max(1, width), ROTATED), np.unique(bands or [])
    rotation = np.linalg.eigh(_gram(table, width))[1][:, ::-1].copy() if n else np.eye(width)
    longest = (table.filter(F.size("v") <= SEED_WIDTH).orderBy(F.desc("norm2"), "id")
               .limit(SEED_VECTORS).select("id", "v").toArrow())
    seeds, seed_ids = Vectors.of(longest["v"], width), longest["id"].to_numpy()
    sample = (table.orderBy(F.xxhash64("row")).limit(PIVOT_SAMPLE)
              .select(F.slice("v", 1, width).alias("v")).toArrow())
    pivots = fit_pivots(Vectors.of(sample["v"], width).head,
                        min(PIVOTS, max(1, math.ceil(math.sqrt(n / 1024)))))

    def placed_rows(batches):
        for b in batches:
            found = place(Vectors.of(b.column("v"), width), pivots, bands)
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, found)],
                                             [*b.schema.names, "sector", "along", "beside"])

    placed = materialize(table.mapInArrow(
        placed_rows, "id bigint, v array<bigint>, ask boolean, row bigint, norm2 double, "
        "sector bigint, along double, beside double"), "topk-placed")
    held = placed.groupBy("sector").agg(
        F.min("along").alias("low"), F.max("along").alias("high"),
        F.max("beside").alias("beside"), F.max("norm2").alias("norm2"),
        F.greatest(F.ceil(F.count(F.lit(1)) / cell_vectors),
                   F.ceil(F.sum(F.size("v")) / CELL_COMPONENTS)).alias("cells")
    ).orderBy("sector").toArrow()
    sectors = Sectors(*(held[c].to_numpy() for c in held.column_names), pivots)

    def homes(batches):
        for b in _parts(batches):
            q, ids = Vectors.of(b.column("v"), width), b.column("id").to_numpy()
            home = sectors.bounds(q).argmax(1)
            floor = first_floor(q, ids, seeds, seed_ids, k)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(floor), pa.array(sectors.code[home]),
                 pa.array(sectors.cells[home])], [*b.schema.names, "floor", "sector", "cells"])

    def reached(batches):
        for b in _parts(batches):
            q, floor = Vectors.of(b.column("v"), width), b.column("floor").to_numpy()
            sent = sectors.reached(q, floor)
            home = np.searchsorted(sectors.code, b.column("home").to_numpy())
            at = np.arange(len(q))
            sent[at, home] &= sectors.cells[home] > 1   # the home cell is done
            to = pa.ListArray.from_arrays(np.r_[0, sent.sum(1).cumsum()].astype(np.int32),
                                          sectors.code[np.nonzero(sent)[1]])
            yield pa.RecordBatch.from_arrays([*b.columns, to], [*b.schema.names, "sectors"])

    out = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("id", pa.int64()),
                     ("score", pa.int64())])

    def cell(queries: pa.Table, found: pa.Table) -> pa.Table:
        if not queries.num_rows or not found.num_rows:
            return out.empty_table()
        ids, rows = queries["id"].to_numpy(), queries["row"].to_numpy()
        q, c, s = search_cell(Vectors.of(queries["v"], width), ids,
                              Vectors.of(found["v"], width), found["id"].to_numpy(),
                              queries["floor"].to_numpy(), rotation, k)
        return pa.table([rows[q], ids[q], c, s], schema=out)

    def search(asked: DataFrame, info: DataFrame) -> DataFrame:
        """Hits of queries with (sector, c) and the candidates of these sectors."""
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1))
        cands = placed.select("id", "v", "row", "sector").join(info, "sector").select(
            "id", "v", "sector", F.pmod(F.xxhash64("row"), "cells").alias("c"), every.alias("g"))
        asked = asked.join(info.select("sector", "groups"), "sector").select(
            "id", "v", "row", "floor", "sector", "c",
            F.pmod(F.xxhash64("row"), "groups").alias("g"))
        key = ("sector", "c", "g")
        return (asked.groupBy(*key).cogroup(cands.groupBy(*key))
                .applyInArrow(cell, "row bigint, query_id bigint, id bigint, score bigint"))

    asked = materialize(placed.filter("ask").select("id", "v", "row").mapInArrow(
        homes, "id bigint, v array<bigint>, row bigint, floor double, sector bigint, cells bigint")
        .withColumn("c", F.pmod(F.xxhash64("row", F.lit(1)), "cells")).drop("cells"),
        "topk-homes")
    near = materialize(search(asked, _groups(asked, sectors, cell_queries, True)), "topk-near")
    floors = near.groupBy("row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score"))
                                     .cast("double").alias("kth"))
    better = asked.join(floors, "row", "left").select(
        "id", "v", "row", F.greatest("floor", "kth").alias("floor"),
        F.col("sector").alias("home"), F.col("c").alias("home_c"))
    sent = materialize(better.mapInArrow(
        reached, "id bigint, v array<bigint>, row bigint, floor double, home bigint, "
        "home_c bigint, sectors array<bigint>"), "topk-sent")
    per_sector = sent.withColumn("sector", F.explode("sectors")).drop("sectors")
    info = _groups(per_sector, sectors, cell_queries, False)
    cells = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cells") - 1))
    far = search(per_sector.join(info.drop("groups"), "sector").withColumn("c", cells)
                 .filter("not (sector = home and c = home_c)"), info)
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "id"))
    return (near.unionByName(far).withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
