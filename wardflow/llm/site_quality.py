"""Quality by hierarchical empirical Bayes: document classifier, host posterior, path posterior.

1. A classifier of words and shape, fitted on a bounded sample of labelled rows, gives each document its probability.
2. Grouped sums of these over hosts and paths give site means.  The strength of each prior comes from the spread
   of the means around their parent (method of moments), so sparse sites shrink toward it: path to host, host to all.
3. A document's posterior adds its own evidence (log odds over the training share) to the log odds of its path, from which
   the document itself is left out, as it is from the host above; so a host's only document has the prior of all as its site.

Here the host is ``source`` and the path below it is ``lang``.  Null hosts and paths are sites of their own; null and
empty texts are scored by their shape alone.  Without labels the classifier says 0.5 to all.  Rows that share a
doc_id are scored one by one; texts of any length are scored whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import map_texts
from .text_model import Softmax, fitted, labelled_rows

KEEP = 0.5
_EDGE = 1e-4


def _fit(rows: pa.Table | None) -> tuple[Softmax, float]:
    """The classifier and the training share of good documents."""
    if rows is None:
        return Softmax(2), 0.5
    y = np.asarray(rows.column("quality")).astype(int)
    return Softmax(2).fit(rows.column("text").combine_chunks(), y), float(np.clip(y.mean(), _EDGE, 1 - _EDGE))


def score_texts(docs: DataFrame, model: Softmax) -> DataFrame:
    """doc_id, host, path and the classifier's probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(part):
        p, _ = shared.value.predict(part.column("text"))
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "host", "path")), pa.array(p[:, 1].astype(float))], ["doc_id", "host", "path", "p"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.col("source").cast("string").alias("host"), F.col("lang").cast("string").alias("path"))
    return map_texts(rows, run, "doc_id long, host string, path string, p double")


def _strength(mean: Column, parent: Column, n: Column) -> list[Column]:
    """Sums for the method of moments: spread of site means around their parents, and what chance alone would give."""
    return [F.sum(n).alias("n"), F.sum(n * (mean - parent) ** 2).alias("spread"), F.sum(parent * (1 - parent)).alias("chance"), F.sum(n * parent * (1 - parent)).alias("scale")]


def _kappa(row) -> float:
    """Prior counts: large if sites differ no more than chance, small if they differ widely."""
    if not row or not row["n"]:
        return 1.0
    between = max(row["spread"] - row["chance"], 1e-9) / row["n"]
    return float(np.clip(row["scale"] / row["n"] / between - 1, 1.0, 1e6))


def site_posteriors(scores: DataFrame) -> DataFrame:
    """(host, path) with counts, sums of path and host, host posterior, the prior of all and both prior strengths."""
    paths = scores.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"))
    hosts = paths.groupBy(F.col("host").alias("_host")).agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    total = hosts.agg(F.sum("host_s"), F.sum("host_n")).first()
    prior = float(np.clip(total[0] / total[1] if total[1] else 0.5, _EDGE, 1 - _EDGE))
    k_host = _kappa(hosts.agg(*_strength(F.col("host_s") / F.col("host_n"), F.lit(prior), F.col("host_n"))).first())
    hosts = hosts.withColumn("host_posterior", (k_host * prior + F.col("host_s")) / (k_host + F.col("host_n")))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    k_path = _kappa(both.agg(*_strength(F.col("s") / F.col("n"), F.col("host_posterior"), F.col("n"))).first())
    return both.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "n", "s", "host_posterior", F.lit(k_path).alias("k"),
                       "host_n", "host_s", F.lit(prior).alias("prior"), F.lit(k_host).alias("k_host"))


def with_posteriors(scores: DataFrame) -> DataFrame:
    """host_posterior and path_posterior of every scored row, from all other rows of its host and path."""
    found = scores.join(site_posteriors(scores), F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")))
    host = (F.col("k_host") * F.col("prior") + F.col("host_s") - F.col("p")) / (F.col("k_host") + F.col("host_n") - 1)
    path = (F.col("k") * F.col("host_posterior") + F.col("s") - F.col("p")) / (F.col("k") + F.col("n") - 1)
    return found.withColumn("host_posterior", host).withColumn("path_posterior", path)


def classify(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """doc_id, host, path, p, host_posterior, path_posterior, posterior and kept of every row."""
    model, share = fitted(labelled_rows(docs, labels, ["quality"]), _fit)
    scores = materialise(docs.sparkSession, score_texts(docs, model), "scores")
    odds = lambda c: F.log(c / (1 - c))
    inside = lambda c: F.least(F.greatest(c, F.lit(_EDGE)), F.lit(1 - _EDGE))
    found = with_posteriors(scores)
    z = odds(inside(F.col("p"))) - float(np.log(share / (1 - share))) + odds(inside(F.col("path_posterior")))
    found = found.withColumn("posterior", 1 / (1 + F.exp(-z)))
    return found.select("doc_id", "host", "path", "p", "host_posterior", "path_posterior", "posterior", (F.col("posterior") >= keep).alias("kept"))
