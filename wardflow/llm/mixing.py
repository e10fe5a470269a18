"""Mixing to target weights with soft domain membership.

1. A classifier fitted on a bounded sample of the labelled table gives each document posteriors over the domains
   (quality label x toxic label).
2. Nonnegative document rates ``r`` are fitted by projected gradient least squares, so that the expected domain tokens
   ``sum(r * tokens * posterior)`` meet the targets.  The gradient is scaled by the inverse of the domains' second moments
   over documents that still have a rate, so a handful of rounds is enough.  A round is one aggregation over the
   posterior table; only the K totals and K x K moments reach the driver.  Rates are never stored: they follow from the posterior
   and the list of rounds so far.
3. A rate is the expected number of copies: its whole part, and one more by a hash of the document.

Targets are shares of all tokens and are scaled to sum 1.  Null and blank texts have no tokens and get rate 1.  Without
labels or tokens every rate is 1.  Rows that share a doc_id get rates by their own texts; texts of any length are scored whole; an empty table
gives no rows; extra columns pass through ``mix`` unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import map_texts, packed, unpacked
from .text_model import Softmax, fitted, labelled_rows

#: Domains: good, good but toxic, poor, poor and toxic.
TARGETS = (0.88, 0.05, 0.06, 0.01)
ROUNDS, CLOSE = 25, 1e-4


def _fit(rows: pa.Table | None) -> Softmax:
    if rows is None:
        return Softmax(4)
    y = np.where(np.asarray(rows.column("quality")) == 1, 0, 2) + (np.asarray(rows.column("toxic")) == 1)
    return Softmax(4).fit(rows.column("text").combine_chunks(), y.astype(int))


def fit_domains(docs: DataFrame, labels: DataFrame) -> Softmax:
    return fitted(labelled_rows(docs, labels, ["quality", "toxic"]), _fit)


def with_posteriors(docs: DataFrame, model: Softmax) -> DataFrame:
    """doc_id, a hash of the row, its tokens and its posteriors."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(part):
        p, n = shared.value.predict(part.column("text"))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row_hash"), pa.array(n.astype(np.int64)),
                                           pa.array(list(p), pa.list_(pa.float64()))], ["doc_id", "row_hash", "tokens", "p"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row_hash"))
    return map_texts(rows, run, "doc_id long, row_hash long, tokens long, p array<double>")


def rate(p: Column, tokens: Column, rounds: list[np.ndarray]) -> Column:
    """Rate after the rounds: each adds a product with the posterior and is cut at zero."""
    r = F.lit(1.0)
    for step in rounds:
        r = F.greatest(r + sum((p[i] * float(x) for i, x in enumerate(step)), F.lit(0.0)), F.lit(0.0))
    return F.when(tokens > 0, r).otherwise(F.lit(1.0))


def rates(p: np.ndarray, tokens: np.ndarray, rounds: list[np.ndarray]) -> np.ndarray:
    """``rate`` of many rows at once."""
    r = np.ones(len(p))
    for step in rounds:
        r = np.maximum(r + p @ step, 0.0)
    return np.where(tokens > 0, r, 1.0)


def _totals(members: DataFrame, k: int, rounds: list[np.ndarray]) -> np.ndarray:
    """Tokens, expected tokens of each domain, and second moments over rows that still have a rate: one row for each batch, then one."""
    names = [f"t{i}" for i in range(1 + k + k * k)]

    def run(batches):
        for batch in batches:
            n = np.asarray(batch.column("tokens")).astype(float)
            p = np.asarray(batch.column("p").flatten()).reshape(-1, k)
            r = rates(p, n, rounds)
            some = p * np.where(r > 0, n, 0.0)[:, None]
            found = [n.sum(), *(r * n) @ p, *(some.T @ p).ravel()]
            yield pa.RecordBatch.from_arrays([pa.array([float(x)]) for x in found], names)

    sums = members.select("tokens", "p").mapInArrow(run, ", ".join(f"{c} double" for c in names)).agg(*[F.sum(c) for c in names]).first()
    return np.array([x or 0.0 for x in sums])


def fit_rates(members: DataFrame, targets=TARGETS) -> list[np.ndarray]:
    """Rounds of the projected gradient; ``members`` has tokens and p."""
    k = len(targets)
    goal, steps, best = None, [], (np.inf, 0)
    for _ in range(ROUNDS):
        row = _totals(members, k, steps)
        if not row[0]:
            return []
        goal = np.array(targets) / sum(targets) * row[0]
        left = goal - row[1 : k + 1]
        size = float(np.linalg.norm(left) / np.linalg.norm(goal))
        if size < best[0]:
            best = (size, len(steps))
        if size < CLOSE:
            break
        moments = row[k + 1 :].reshape(k, k)
        steps.append(np.linalg.solve(moments + np.eye(k) * 1e-6 * np.trace(moments), left))
    return steps[: best[1]]


def document_rates(docs: DataFrame, labels: DataFrame, targets=TARGETS) -> DataFrame:
    """doc_id, tokens, posterior of each domain, rate and copies of every row."""
    members = materialise(docs.sparkSession, with_posteriors(docs, fit_domains(docs, labels)), "posteriors")
    r = rate(F.col("p"), F.col("tokens"), fit_rates(members, targets))
    u = F.pmod(F.xxhash64("row_hash", F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return members.withColumn("rate", r).select(
        "doc_id", "row_hash", F.col("tokens").alias("n_tokens"), *[F.col("p")[i].alias(f"domain_{i}") for i in range(len(targets))], "rate",
        (F.floor("rate") + (u < F.col("rate") - F.floor("rate")).cast("int")).cast("int").alias("copies"))


def mix(docs: DataFrame, labels: DataFrame, targets=TARGETS) -> DataFrame:
    """``docs`` with every row as often as its copies say."""
    copies = document_rates(docs, labels, targets).groupBy("row_hash").agg(F.max("copies").alias("n"))
    key = F.xxhash64(F.col("row.doc_id").cast("long"), F.col("row.text"))
    rows = packed(docs).withColumn("k", key).join(copies, F.col("k") == F.col("row_hash")).where("n > 0")
    return unpacked(rows.withColumn("i", F.explode(F.array_repeat(F.lit(1), F.col("n")))), docs.columns)
