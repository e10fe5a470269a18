"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, trained from document labels.

A sentence ends with its line or with a word that ends in ``. ! ?``.  Its score is a logistic model of its words and
their beginnings (those met clearly more often in toxic texts); a document is toxic unless all of its sentences are clean, so its score is
``1 - (1 - LEAK) * product(1 - sentence)``.  LEAK stands for labels that no sentence explains.  Training uses document
labels only (a bounded sample, see text_model.SAMPLE), yet the sentence scores tell where the offence is.

Null and empty texts have no sentence: their score is LEAK.  Without labelled rows every sentence scores 0.  Repeated
rows are scored alike; texts of any length are scored whole; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts
from .text_model import DIM, Adagrad, Words, labelled_sample, sums, useful_ids, word_ids

LEAK, THRESHOLD = 0.005, 0.3


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def sentences(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, offsets of the sentences in the words, offsets of the texts in the sentences."""
    lines = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    of_text = np.asarray(lines.offsets).astype(np.int64)
    of_text -= of_text[0]
    words = Words(lines.flatten())
    ends = np.array([v.rstrip("\"')*#%&$|") [-1:] in (".", "!", "?") for v in words.values] or [False], bool)
    n = len(words.index)
    start = np.zeros(n + 1, bool)
    start[words.offsets] = True
    if n:
        start[1:] |= ends[words.index]
    start[n] = True
    first = np.flatnonzero(start)  # the last is the end of the words
    offsets = first if n else np.zeros(1, np.int64)
    return words, offsets, np.searchsorted(offsets, words.offsets[of_text])


class NoisyOr:
    """Sentence weights ``w`` by hashed word, bias ``b``."""

    def __init__(self):
        self.w, self.b = np.zeros(DIM, np.float32), -40.0

    @staticmethod
    def _sentence(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -40, 30)))

    def fit(self, texts: pa.Array, y: np.ndarray, epochs: int = 160, l2: float = 1e-6, least: int = 4, lift: float = 4.5) -> NoisyOr:
        if not len(y):
            return self
        words, cut, of_text = sentences(texts)
        in_sentence = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
        in_text = np.repeat(np.arange(len(y)), np.diff(of_text))
        owner, place, used = useful_ids(words, in_text[in_sentence], y, 2, least, lift, above_only=True)
        to = np.zeros(DIM, np.int64)
        to[used] = np.arange(len(used))
        place = to[place]
        known = len(words.values)
        told = np.flatnonzero(np.bincount(owner, minlength=known)[words.index] > 0) if known else np.zeros(0, np.int64)
        word, sentence = words.index[told], in_sentence[told]  # words without a kept place weigh nothing
        del in_sentence
        w, b = np.zeros(len(used)), -6.0
        up, up_b = Adagrad(w.shape, 1.0), Adagrad((), 0.2)
        for _ in range(epochs):
            p = self._sentence(b + np.bincount(sentence, np.bincount(owner, w[place], known)[word], len(cut) - 1))
            clean = (1 - LEAK) * np.exp(sums(np.log1p(-np.minimum(p, 1 - 1e-9)), of_text))
            pull = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) / len(y)  # d loss / d log(1 - p), turned
            back = pull[in_text] * p
            grad = np.bincount(place, np.bincount(word, back[sentence], known)[owner], len(used)) + l2 * w
            w += up.step(grad)
            b = float(np.clip(b + up_b.step(np.array(back.sum())), -12, -4))
        self.w[used], self.b = w, b
        return self

    def score(self, texts: pa.Array, cache: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each text, number of its worst sentence (-1 if none) and that sentence's score."""
        words, cut, of_text = sentences(texts)
        if len(cache) > 300_000:
            cache.clear()
        per = np.array([cache[v] if v in cache else cache.setdefault(v, float(self.w[word_ids(v)].sum())) for v in words.values])
        p = self._sentence(self.b + sums(words.spread(per), cut)) if len(words.index) else np.zeros(0)
        score = 1 - (1 - LEAK) * np.exp(sums(np.log1p(-np.minimum(p, 1 - 1e-9)), of_text))
        n = np.diff(of_text)
        worst, high = np.full(len(n), -1), np.zeros(len(n))
        for i in np.flatnonzero(n):
            part = p[of_text[i] : of_text[i + 1]]
            worst[i] = part.argmax()
            high[i] = part[worst[i]]
        return np.clip(score, 0, 1), worst, high


def train(docs: DataFrame, labels: DataFrame) -> NoisyOr:
    """Model from the labelled rows that are not held out."""
    rows = labelled_sample(docs, labels, ["toxic"], ~held_out(F.col("doc_id")))
    return NoisyOr().fit(rows.column("text").combine_chunks(), np.asarray(rows.column("toxic")).astype(int))


def score_documents(docs: DataFrame, model: NoisyOr, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, worst_sentence and worst_score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.w, model.b))
    cache: dict[str, float] = {}

    def run(part):
        own = NoisyOr()
        own.w, own.b = shared.value
        score, worst, high = own.score(part.column("text"), cache)
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score), pa.array(worst, pa.int64()), pa.array(high)],
                                          ["doc_id", "score", "worst_sentence", "worst_score"])

    rows = map_texts(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, score double, worst_sentence long, worst_score double")
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"), "worst_sentence", "worst_score")
