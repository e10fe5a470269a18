"""Nearest neighbours by inner product with an inverted multi-index.

Each vector is cut in two halves; each half is quantised by its own codebook, so a vector lies in a cell (i, j) of a
K x K grid.  For a query both halves' products with the centroids are sorted, and a heap yields pairs (i, j) by
decreasing sum until the cells passed hold ``LEAST`` vectors and ``SHARE`` of all vectors (all cells, if there are fewer).
All entries of these cells are scored exactly, in double precision, and the best ``k`` stay; ties go to the smaller
vec_id.  The share decides recall: vectors without any structure need about a third, clustered ones far less.

Codebooks are fitted on a bounded sample (``SAMPLE`` vectors of smallest hash); every vector is indexed.  The only
thing sent to the driver is the number of vectors in each cell (K * K numbers).  Neighbouring cells are stored together
in blocks of about ``BLOCK`` vectors, and a cell with a third of all vectors is many blocks; queries go to the blocks in
chunks of about ``CHUNK`` with the bits of the cells that each has passed.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part.  Rows that
share a vec_id count once (the largest vector in array order).  No usable vector: no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


SAMPLE, ROUNDS = 20_000, 12
K, BLOCK, CHUNK = 128, 2_048, 256
LEAST, SHARE = 200, 0.36
VISITORS = 64


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): one row per usable vector."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), v.alias("v")).where(
        "vec_id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)")
    width = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (width["d"] if width else -1)).groupBy("vec_id").agg(F.max("v").alias("v"))


def codebook(x: np.ndarray, k: int) -> np.ndarray:
    """Centroids of a bounded sample (k-means from evenly spaced distinct rows)."""
    distinct = np.unique(x, axis=0)
    c = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)]
    for _ in range(ROUNDS):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        total = np.stack([np.bincount(near, x[:, j], len(c)) for j in range(x.shape[1])], 1)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1)[None] - 2 * x @ c.T).argmin(1)


def cells_by_sum(a: np.ndarray, b: np.ndarray, filled: np.ndarray, entries: int) -> list[int]:
    """Filled cells by decreasing a[i] + b[j] until they hold ``entries`` vectors."""
    oa, ob = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
    heap, seen, out, held = [(-(a[oa[0]] + b[ob[0]]), 0, 0)], {(0, 0)}, [], 0
    while heap and held < entries:
        _, i, j = heapq.heappop(heap)
        cell = int(oa[i]) * len(b) + int(ob[j])
        if filled[cell]:
            out.append(cell)
            held += int(filled[cell])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (-(a[oa[x]] + b[ob[y]]), x, y))
    return out


def _matrix(column: pa.ListArray) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def search(vectors: DataFrame, every: int = 20, k: int = 20, least: int = LEAST, share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score for the vectors whose id ``every`` divides."""
    spark = vectors.sparkSession
    rows = materialise(spark, usable(vectors), "vectors")
    total = rows.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total:
        return empty
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
    x = _matrix(sample)
    half, entries = max(x.shape[1] // 2, 1), max(least, int(share * total)) + 1
    books = [codebook(x[:, :half], K), codebook(x[:, half:], K) if x.shape[1] > half else np.zeros((1, 0))]
    shared = spark.sparkContext.broadcast(books)

    def assign(batches):
        for b in batches:
            v = _matrix(b.column("v"))
            cell = nearest(v[:, :half], shared.value[0]) * len(shared.value[1]) + nearest(v[:, half:], shared.value[1])
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array(cell.astype(np.int64))], ["vec_id", "v", "cell"])

    placed = materialise(spark, rows.mapInArrow(assign, "vec_id long, v array<double>, cell long"), "cells")
    counts = placed.groupBy("cell").count()
    filled = np.zeros(len(books[0]) * len(books[1]), np.int64)
    for r in counts.collect():  # at most K * K rows
        filled[r["cell"]] = r["count"]
    sizes = spark.sparkContext.broadcast(filled)
    band = np.maximum(np.cumsum(filled) - 1, 0) // BLOCK  # neighbouring cells; a large cell is a band with several parts
    start = np.concatenate([[0], np.flatnonzero(np.diff(band)) + 1, [len(filled)]])
    band = np.repeat(np.arange(len(start) - 1), np.diff(start))
    parts = np.maximum(-(-np.bincount(band, weights=filled).astype(np.int64) // BLOCK), 1)
    bands = spark.sparkContext.broadcast((band, start, parts))

    def pack(batches):
        for b in batches:
            of = bands.value[0][np.asarray(b.column("cell"))]
            part = np.asarray(b.column("hash")).astype(np.int64) % bands.value[2][of]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("vec_id", "v", "cell")), pa.array(of), pa.array(part)], ["vec_id", "v", "cell", "band", "part"])

    blocks = (placed.withColumn("hash", F.xxhash64("vec_id")).mapInArrow(pack, "vec_id long, v array<double>, cell long, band long, part long")
              .groupBy("band", "part").agg(F.collect_list(F.struct("vec_id", "v", "cell")).alias("e"))
              .select("band", "part", F.col("e.vec_id").alias("ids"), F.flatten("e.v").alias("vs"), F.col("e.cell").alias("cells")))

    def visit(batches):
        for b in batches:
            v = _matrix(b.column("v"))
            a, c = v[:, :half] @ shared.value[0].T, v[:, half:] @ shared.value[1].T
            bits = np.zeros((len(v), len(sizes.value)), bool)
            for i in range(len(v)):
                bits[i, cells_by_sum(a[i], c[i], sizes.value, entries)] = True
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array([np.packbits(x).tobytes() for x in bits], pa.binary())], ["query_id", "q", "bits"])

    def spread(batches):
        """A chunk of queries for every part of every band that one of them visits."""
        for b in batches:
            for ids, qs, bits in zip(*(b.column(c) for c in ("query_ids", "qs", "bits"))):
                seen = np.unpackbits(np.frombuffer(b"".join(bits.as_py()), np.uint8).reshape(len(ids), -1), axis=1)
                of, start, parts = bands.value
                out = [(r, p, np.packbits(seen[:, start[r] : start[r + 1]]).tobytes()) for r in range(len(parts)) if seen[:, start[r] : start[r + 1]].any() for p in range(parts[r])]
                for r, p, sub in out:
                    yield pa.RecordBatch.from_arrays([pa.array([r]), pa.array([p]), pa.array([ids.as_py()], pa.list_(pa.int64())), pa.array([np.asarray(qs.values)], pa.list_(pa.float64())), pa.array([sub], pa.binary())],
                                                     ["band", "part", "query_ids", "qs", "sub"])

    # A count of its own keeps adaptive execution from joining these small, busy partitions.
    tasks = -(-total // (every * VISITORS))
    visits = rows.where(F.col("vec_id") % every == 0).repartition(tasks, "vec_id").mapInArrow(visit, "query_id long, q array<double>, bits binary")
    visits = visits.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(1 + total // every // CHUNK)).alias("chunk")).agg(F.collect_list(F.struct("query_id", "q", "bits")).alias("e"))
    visits = visits.select(F.col("e.query_id").alias("query_ids"), F.flatten("e.q").alias("qs"), F.col("e.bits").alias("bits")).mapInArrow(
        spread, "band long, part long, query_ids array<long>, qs array<double>, sub binary")

    def score(batches):
        """Exact scores; each task passes on its best ``k`` of every query."""
        held: list[list[np.ndarray]] = [[], [], []]
        n = 0

        def best():
            q, v, s = (np.concatenate(h) for h in held)
            order = np.lexsort((v, -s, q))
            q, v, s = q[order], v[order], s[order]
            first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
            place = np.arange(len(q)) - np.repeat(first, np.diff(np.concatenate([first, [len(q)]])))
            return [a[place < k] for a in (q, v, s)]

        for batch in batches:
            for r, ids, vs, cells, qids, qs, sub in zip(*(batch.column(c) for c in ("band", "ids", "vs", "cells", "query_ids", "qs", "sub"))):
                start = bands.value[1][r.as_py() : r.as_py() + 2]
                ids, qids = np.asarray(ids.values), np.asarray(qids.values)
                e, q = np.asarray(vs.values).reshape(len(ids), -1), np.asarray(qs.values).reshape(len(qids), -1)
                width = int(start[1] - start[0])
                seen = np.unpackbits(np.frombuffer(sub.as_py(), np.uint8))[: width * len(qids)].reshape(len(qids), width).astype(bool)
                seen = seen[:, np.asarray(cells.values) - start[0]]
                for i in range(len(qids)):  # one sum per pair, in one order, so equal vectors tie exactly
                    at = np.flatnonzero(seen[i] & (ids != qids[i]))
                    s = (e[at] * q[i]).sum(1)
                    if len(at) > k:
                        top = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                        at, s = at[top], s[top]
                    for h, v in zip(held, (np.full(len(at), qids[i]), ids[at], s)):
                        h.append(v)
                    n += len(at)
            if n > 2_000_000:
                held = [[a] for a in best()]
                n = len(held[0][0])
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in best()], ["query_id", "vec_id", "score"])

    found = blocks.join(visits, ["band", "part"]).select("band", "ids", "vs", "cells", "query_ids", "qs", "sub").mapInArrow(score, "query_id long, vec_id long, score double")
    # The rows of one query: at most k from each task.
    top = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("t"))
    return top.select("query_id", F.posexplode("t").alias("p", "e")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), (-F.col("e.s")).alias("score"))
