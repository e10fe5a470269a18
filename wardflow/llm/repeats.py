"""Removal of word passages that occur earlier in the corpus, by prefix-partitioned sparse suffix trees.

A window of ``size`` words repeats if its words also start earlier (smaller doc_id, or earlier in the same document).

1. Every window has an anchor: the place inside it where the ``GRAM``-word string of smallest hash starts.  Equal windows
   have equal anchors, and runs of neighbouring windows share one, so only anchors (about one place in eight) enter the
   trees.  Anchor strings are counted over the whole corpus; those that occur once can't lie in a repeat.
2. Suffixes go to groups by the prefix at their anchor.  Prefixes of more than ``GROUP`` suffixes are extended (by a
   salt of the document), so that no group outgrows a task; a Bloom filter of fixed size tells which prefixes repeat
   and which are extended.
3. Each group is a subtree, built as its leaves in lexicographic order: neighbours that share ``size`` words lie below an
   internal node of at least that depth.  All leaves of such a node but the earliest are repeats.
4. For extended prefixes (and groups cut by the memory bound) the earliest leaf of every deep node goes to a second
   round, where the nodes of all parts meet by the hash of their window.

Documents are named by (doc_id, 64-bit hash of the text) and ordered by it, a null doc_id first; so rows that share a doc_id, or have none, are
documents of their own where their texts differ.  Equal rows are one document: the same place is not earlier than itself, and
what is removed is removed from each of them.  Null or empty text: no words, nothing removed.  Texts of any length enter whole.  An
empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import Bloom, doc_numbers, map_texts, mix, window_hashes, word_hashes

SIZE, GRAM = 20, 6
GROUP, SALTS = 2_000, 64
BITS = 1 << 26
NULL_DOC = -(1 << 63)


def anchored_runs(words: np.ndarray, offsets: np.ndarray, size: int):
    """Runs of neighbouring windows with one anchor: key, text number, first window (within the text), windows."""
    none = (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    n = len(words) - size + 1
    if n <= 0:
        return none
    gram = min(GRAM, size)
    grams = window_hashes(words, gram)
    at = np.arange(n) + sliding_window_view(grams, size - gram + 1).argmin(axis=1)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    whole = np.arange(n) + size <= offsets[text + 1]
    at, text, start = at[whole], text[whole], np.flatnonzero(whole)
    if not len(at):
        return none
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    return grams[at[first]], text[first], start[first] - offsets[text[first]], np.diff(np.concatenate([first, [len(at)]]))


def anchor_counts(docs: DataFrame, size: int) -> DataFrame:
    """(key, n): how many runs start at each anchor string; counted within a slice before the exchange."""
    def run(part):
        key, *_ = anchored_runs(*word_hashes(part.column("text")), size)
        key, n = np.unique(key, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n, pa.int64())], ["key", "n"])
    return map_texts(docs.select("text"), run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")


def suffix_runs(docs: DataFrame, repeated, wide, size: int) -> DataFrame:
    """Runs whose anchor string may repeat, with the words that their windows cover."""
    names = ["key", "salt", "doc", "text_hash", "start", "n", "words"]

    def run(part):
        texts, ids, hashes = part.column("text"), doc_numbers(part, NULL_DOC), text_hashes(part.column("text"))
        key, text, start, n = anchored_runs(*word_hashes(texts), size)
        hit = np.flatnonzero(repeated.value.has(key)) if len(key) else np.zeros(0, np.int64)
        key, text, start, n = key[hit], text[hit], start[hit], n[hit]
        content, last, words = [], -1, []
        for t, s, k in zip(text.tolist(), start.tolist(), n.tolist()):
            if t != last:
                last, words = t, texts[t].as_py().encode().split()
            content.append(b" ".join(words[s : s + k + size - 1]))
        doc, own = ids[text], hashes[text]
        salt = np.where(wide.value.has(key), 1 + (mix(doc.view(np.uint64) ^ own.view(np.uint64)) % np.uint64(SALTS)).astype(np.int64), 0)
        return pa.RecordBatch.from_arrays([
            pa.array(key.view(np.int64)), pa.array(salt, pa.int32()), pa.array(doc), pa.array(own), pa.array(start, pa.int32()), pa.array(n, pa.int32()),
            pa.array(content, pa.binary())], names)

    return map_texts(docs.select(F.col("doc_id").cast("long"), "text"), run, "key long, salt int, doc long, text_hash long, start int, n int, words binary")


def subtree(runs: list[tuple[int, int, int, int, bytes]], size: int) -> tuple[list[tuple[int, int, int]], list[tuple[bytes, int, int, int]]]:
    """Repeated windows of a group, and the earliest leaf of every window string."""
    leaves = []
    for doc, own, start, n, content in runs:
        words = content.split(b" ")
        leaves += [(b" ".join(words[i : i + size]), doc, own, start + i) for i in range(n)]
    leaves.sort()
    gone, first, node = [], [], None
    for leaf in leaves:
        if node is not None and leaf[0] == node[0]:
            if leaf != node:
                gone.append(leaf[1:])
        else:
            node = leaf
            first.append(leaf)
    return gone, first


def _stretches(gone: list[tuple[int, int, int]]):
    """(doc, text_hash, start, windows) of neighbouring repeated windows."""
    gone = sorted(set(gone))
    at = 0
    for i in range(1, len(gone) + 1):
        if i == len(gone) or gone[i][:2] != gone[i - 1][:2] or gone[i][2] != gone[i - 1][2] + 1:
            yield *gone[at], i - at
            at = i


def repeated_stretches(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc, text_hash, start, n): stretches of windows that also start earlier; ``doc`` is doc_id with null as the smallest."""
    spark = docs.sparkSession
    counts = anchor_counts(docs, size)
    filters = Bloom.build(counts, "key", BITS, repeated=F.lit(True), wide=F.col("n") > GROUP)
    repeated, wide = (spark.sparkContext.broadcast(filters[k]) for k in ("repeated", "wide"))
    runs = suffix_runs(docs, repeated, wide, size).repartition("key", "salt").sortWithinPartitions("key", "salt", "doc", "text_hash", "start")

    def build(batches):
        """Subtrees of the groups of a partition; a group over the bound is built in parts."""
        group, held, cut = None, [], False
        out: list[list] = [[], [], [], [], [], []]  # doc, text_hash, start, n, and the two hashes of an open node

        def close(open_: bool):
            gone, first = subtree(held, size)
            for d, t, s, n in _stretches(gone):
                for column, v in zip(out, (d, t, s, n, None, None)):
                    column.append(v)
            for w, d, t, s in first if open_ else ():
                h = xxhash.xxh3_128_intdigest(w)
                for column, v in zip(out, (d, t, s, 0, (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63))):
                    column.append(v)
            held.clear()

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                                               ["doc", "text_hash", "start", "n", "h1", "h2"])
            for column in out:
                column.clear()
            return batch

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for key, salt, *run in zip(*columns):
                if (key, salt) != group:
                    if held:
                        close(cut or group[1] > 0)
                    group, cut = (key, salt), False
                elif len(held) >= GROUP:
                    close(True)
                    cut = True
                held.append(tuple(run))
            if len(out[0]) >= 20_000:
                yield flush()
        if held:
            close(cut or group[1] > 0)
        yield flush()

    found = materialise(spark, runs.mapInArrow(build, "doc long, text_hash long, start int, n int, h1 long, h2 long"), "repeat-nodes")
    # The earliest leaf of each part of a group: all but the first of a node are repeats.  Three minima in turn find the first, combined before
    # their exchanges, so a node of any number of parts is never one list.
    parts = found.where("h1 IS NOT NULL").select("h1", "h2", "doc", "text_hash", "start")
    node, order = ["h1", "h2"], ["doc", "text_hash", "start"]
    several = parts.groupBy(*node).agg(F.count(F.lit(1)).alias("_n"), F.min("doc").alias("_doc")).where("_n > 1").drop("_n")
    open_ = parts.join(several, node)
    for done, c in enumerate(order[1:], 1):
        same = [F.col(x) == F.col(f"_{x}") for x in order[:done]]
        least = open_.where(reduce(and_, same)).groupBy(*node).agg(F.min(c).alias(f"_{c}"))
        open_ = open_.join(least, node)
    first = reduce(and_, [F.col(c) == F.col(f"_{c}") for c in order])
    merged = open_.where(~first).select(*order, F.lit(1).alias("n"))
    return found.where("h1 IS NULL").select(*order, "n").unionByName(merged)


def text_hashes(texts: pa.Array) -> np.ndarray:
    """64-bit hash of each text as a signed number; a null text counts as empty."""
    return np.fromiter((xxhash.xxh3_64_intdigest(t or "") for t in texts.to_pylist()), np.uint64, len(texts)).view(np.int64)


def stretches_by_document(stretches: DataFrame) -> DataFrame:
    """(doc, text_hash, gone): the stretches of each document, whose number its length bounds."""
    return stretches.distinct().groupBy("doc", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("gone"))


def _digest(text: str | None, gone, size: int) -> tuple[int, int, str, bytes]:
    words = (text or "").encode().split()
    if not gone:
        kept = words
    else:
        edge = np.zeros(len(words) + 1, np.int32)
        for g in gone:
            edge[g["start"]] += 1
            edge[g["start"] + g["n"] + size - 1] -= 1
        kept = [w for w, c in zip(words, np.cumsum(edge[:-1]).tolist()) if not c]
    joined = b" ".join(kept)
    return len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined


def remove_repeats(docs: DataFrame, size: int = SIZE, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and ``kept``, the words left) of every row.

    Only documents that may have lost words, by a Bloom filter of fixed size, are joined with their stretches; all
    others are finished where they are read.
    """
    spark = docs.sparkSession
    lists = materialise(spark, stretches_by_document(repeated_stretches(docs, size)), "repeats")
    hit = spark.sparkContext.broadcast(Bloom.build(lists.select(F.xxhash64("doc", "text_hash").alias("key")), "key", BITS // 8, all=F.lit(True))["all"])

    def named(part):
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), pa.array(doc_numbers(part, NULL_DOC)),
                                           pa.array(text_hashes(part.column("text")))], ["doc_id", "text", "doc", "text_hash"])

    rows = map_texts(docs.select(F.col("doc_id").cast("long"), "text"), named, "doc_id long, text string, doc long, text_hash long")
    rows = rows.withColumn("key", F.xxhash64("doc", "text_hash"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]

    def finished(part, gone):
        got = [_digest(t, g, size) for t, g in zip(part.column("text").to_pylist(), gone)]
        n, removed, sha, kept = zip(*got) if got else ((), (), (), ())
        columns = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())]
        columns += [pa.array([k.decode() for k in kept], pa.string())] if with_text else []
        return pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    def split(part, wanted):
        mask = hit.value.has(np.asarray(part.column("key")).astype(np.int64).view(np.uint64)) == wanted
        return part.filter(pa.array(mask))

    whole = map_texts(rows, lambda p: finished(q := split(p, False), [None] * q.num_rows), schema)
    joined = (map_texts(rows, lambda p: split(p, True), rows.schema)
              .join(lists, ["doc", "text_hash"], "left").select("doc_id", "text", "gone"))
    return whole.unionByName(map_texts(joined, lambda p: finished(p, p.column("gone").to_pylist()), schema))
