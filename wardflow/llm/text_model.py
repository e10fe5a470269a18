"""Small text models trained here: hashed words with their beginnings, shape counts, softmax and noisy-or training.

Labelled rows are a bounded sample (``SAMPLE`` rows of smallest hash and, where the fit runs in a task, ``SAMPLE_BYTES`` of their texts),
so that training has bounded memory; scoring runs over every row on the executors with a weight table of fixed size.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, split_words

DIM = 1 << 18
SAMPLE = 4_000
SAMPLE_BYTES = 32 << 20
MARKS = ".,;:!?*#%&$|\"'<>()[]{}-_"
SHAPE = 7


def word_ids(word: str) -> list[int]:
    """Table places of a word: itself and its beginnings of four to seven letters."""
    bare = word.strip(MARKS).lower()
    parts = {bare, *(f"{k}{bare[:k]}" for k in range(4, 8) if len(bare) >= k)} if bare else {"-"}
    return sorted(xxhash.xxh3_64_intdigest(p.encode()) % DIM for p in parts)


def word_places(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, place) pairs of many words, as ``word_ids`` has them: each distinct beginning is hashed once."""
    bare = pa.array([v.strip(MARKS).lower() for v in values], pa.string())
    long = np.asarray(pc.utf8_length(bare), np.int64) if len(bare) else np.zeros(0, np.int64)
    owner, place = [], []
    for k in (0, 4, 5, 6, 7):
        at = np.flatnonzero(long >= k) if k else np.arange(len(bare))
        parts = pc.utf8_slice_codeunits(bare.take(pa.array(at)), 0, k) if k else bare
        coded = parts.dictionary_encode()
        ids = np.fromiter((xxhash.xxh3_64_intdigest(f"{k}{p}" if k else p or "-") % DIM for p in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        owner.append(at)
        place.append(ids[np.asarray(coded.indices)] if len(at) else np.zeros(0, np.int64))
    owner, place = np.concatenate(owner), np.concatenate(place)
    order = np.argsort(owner, kind="stable")
    return owner[order], place[order]


def word_shapes(values: pa.Array) -> np.ndarray:
    """Counts of distinct words that add up to the shape of a text."""
    count = lambda pattern: pc.count_substring_regex(values, pattern)
    only_marks = pc.match_substring_regex(values, r"^[.,;:!?*#%&$|\"'<>()\[\]{}_-]+$")
    columns = [pc.utf8_length(values), count(r"[#*$%&|<>]"), count(r"\p{Lu}"), count("!"), count("[0-9]"), pc.cast(only_marks, pa.int32())]
    return np.stack([np.asarray(c).astype(np.float32) for c in columns], 1)


def shape_features(sums: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Shape of texts from the sums of their words' counts."""
    chars, words = np.maximum(sums[:, :1], 1), np.maximum(n[:, None], 1)
    return np.hstack([np.log1p(n)[:, None] / 5, sums[:, :1] / words / 10, sums[:, 1:3] / chars * 4, sums[:, 3:4] / words, sums[:, 4:5] / chars * 4, sums[:, 5:6] / words])


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the rows between offsets, zero where there are none."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]))
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, offsets[full], axis=0)
    return out


def labelled_rows(docs: DataFrame, labels: DataFrame, columns: list[str], where: Column | None = None, size: int = SAMPLE) -> DataFrame:
    """Texts and labels of at most ``size`` documents: those of smallest hash among the labelled rows."""
    rows = labels.dropna(subset=["doc_id", *columns])
    rows = rows.where(where) if where is not None else rows
    rows = rows.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in columns]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    texts = docs.select(F.col("doc_id").alias("_id"), "text")
    return texts.join(F.broadcast(rows), F.col("_id") == F.col("doc_id")).dropDuplicates(["doc_id"]).select("doc_id", "text", *columns)


def labelled_sample(docs: DataFrame, labels: DataFrame, columns: list[str], where: Column | None = None, size: int = SAMPLE) -> pa.Table:
    return labelled_rows(docs, labels, columns, where, size).orderBy("doc_id").toArrow()


def fitted(rows: DataFrame, fit: Callable[[pa.Table], Any], limit: int = SAMPLE_BYTES) -> Any:
    """``fit`` of a bounded sample, in one task of an executor: only the model reaches the driver.

    Rows come in the order of their hash, and those behind the first ``limit`` bytes of text are left out, so memory is bounded by
    bytes as well as by rows.
    """
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices(batch):
                if size < limit:
                    held.append(part)
                    size += part.column("text").nbytes
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(pa.Table.from_batches(held) if held else None))], pa.binary())], ["model"])

    ordered = rows.orderBy(F.xxhash64("doc_id"), "doc_id").coalesce(1)
    found = ordered.mapInArrow(run, "model binary").first()
    return pickle.loads(found[0]) if found else fit(None)  # no rows, no task


class Words:
    """Words of texts as places of the distinct words, with what a distinct word brings."""

    def __init__(self, texts: pa.Array):
        self.coded, self.offsets = split_words(texts)
        self.index = np.asarray(self.coded.indices).astype(np.int64)
        self.values: list[str] = self.coded.dictionary.to_pylist()

    def spread(self, per_word: np.ndarray) -> np.ndarray:
        return per_word[self.index] if len(self.index) else np.zeros((0, *per_word.shape[1:]), per_word.dtype)

    def shape(self) -> np.ndarray:
        return shape_features(sums(self.spread(word_shapes(self.coded.dictionary)), self.offsets), np.diff(self.offsets).astype(float))


def useful_ids(words: Words, of_text: np.ndarray, y: np.ndarray, k: int, least: int, lift: float, above_only: bool = False):
    """(distinct word, place) pairs of the places that tell classes apart, and these places.

    ``of_text`` gives the text of each word (ascending), ``y`` the class (below ``k``) of each text.  A place is kept if
    ``least`` texts or more hold it and some class has ``lift`` standard errors more or fewer of them than its
    share of all texts (``above_only``: class 1 has more).  Texts are counted in small groups, to bound memory.
    """
    owner, place = word_places(words.values)
    if not len(place):
        return owner, place, place
    first = np.searchsorted(owner, np.arange(len(words.values) + 1))
    held, hits = np.zeros(DIM), np.zeros((k, DIM))
    for start in range(0, len(y), 200):
        a, b = np.searchsorted(of_text, [start, start + 200])
        met = np.unique((of_text[a:b] - start) * np.int64(len(words.values)) + words.index[a:b])
        of, text = met % len(words.values), met // len(words.values)
        n = first[of + 1] - first[of]
        at = np.repeat(first[of] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.unique(np.repeat(text, n) * np.int64(DIM) + place[at])  # places of each text, once
        here, label = both % DIM, y[start + both // DIM]
        held += np.bincount(here, minlength=DIM)
        for c in range(k):
            hits[c] += np.bincount(here[label == c], minlength=DIM)
    share = np.bincount(y, minlength=k)[:, None] / len(y)
    z = (hits - held * share) / np.sqrt(np.maximum(held * share * (1 - share), 1e-9))
    good = (held >= least) & (z[1] > lift if above_only else (np.abs(z) > lift).any(0))
    keep = good[place]
    return owner[keep], place[keep], np.flatnonzero(good)


class Adagrad:
    """Full-batch steps scaled by the gradients so far."""

    def __init__(self, shape, rate: float):
        self.rate, self.seen = rate, np.full(shape, 1e-8)

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.seen += gradient * gradient
        return -self.rate * gradient / np.sqrt(self.seen)


class Softmax:
    """Posterior of ``k`` classes from a text's words (sum over the root of their number) and shape."""

    def __init__(self, k: int):
        self.k, self.w, self.b = k, np.zeros((DIM, k), np.float32), np.zeros(k)
        self.v, self.mean, self.std = np.zeros((SHAPE, k)), np.zeros(SHAPE), np.ones(SHAPE)

    def fit(self, texts: pa.Array, y: np.ndarray, epochs: int = 120, l2: float = 2e-4, least: int = 5, lift: float = 4.0) -> Softmax:
        if not len(y):
            return self
        words = Words(texts)
        text = np.repeat(np.arange(len(y)), np.diff(words.offsets))
        owner, place, used = useful_ids(words, text, y, self.k, least, lift)
        to = np.zeros(DIM, np.int64)
        to[used] = np.arange(len(used))
        place = to[place]
        x = words.shape()
        self.mean, self.std = x.mean(0), x.std(0) + 1e-6
        x = (x - self.mean) / self.std
        root = np.sqrt(np.maximum(np.diff(words.offsets), 1))[:, None]
        known = len(words.values)
        told = np.flatnonzero(np.bincount(owner, minlength=known)[words.index] > 0) if known else np.zeros(0, np.int64)
        word, text = words.index[told], text[told]  # words without a kept place weigh nothing
        share = np.bincount(y, minlength=self.k) + 1.0
        self.b = np.log(share / share.sum())
        w, goal = np.zeros((len(used), self.k)), np.eye(self.k)[y]
        up = [Adagrad(w.shape, 0.3), Adagrad(self.v.shape, 0.3), Adagrad(self.b.shape, 0.1)]
        evidence = np.zeros((len(y), self.k))
        for _ in range(epochs):
            for c in range(self.k):
                evidence[:, c] = np.bincount(text, np.bincount(owner, w[place, c], known)[word], len(y))
            err = (self.posterior(evidence / root, x) - goal) / len(y)
            back = err / root
            grad = l2 * w
            for c in range(self.k):
                grad[:, c] += np.bincount(place, np.bincount(word, back[text, c], known)[owner], len(used))
            w += up[0].step(grad)
            self.v += up[1].step(x.T @ err + 1e-4 * self.v)
            self.b += up[2].step(err.sum(0))
        self.w[used] = w
        return self

    def posterior(self, evidence: np.ndarray, x: np.ndarray) -> np.ndarray:
        z = evidence + x @ self.v + self.b
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Posteriors of texts, and their numbers of words."""
        words = Words(texts)
        owner, place = word_places(words.values)
        per = np.add.reduceat(self.w[place], np.searchsorted(owner, np.arange(len(words.values))), axis=0) if len(owner) else np.zeros((0, self.k), np.float32)
        n = np.diff(words.offsets)
        evidence = sums(words.spread(per), words.offsets) / np.sqrt(np.maximum(n, 1))[:, None]
        return self.posterior(evidence, (words.shape() - self.mean) / self.std), n
