"""Removal of every byte of a string of ``SIZE`` bytes that starts anywhere else, by a depth-limited radix sort of suffixes.

Only equality up to depth ``SIZE`` matters, so suffixes are never ordered further, and buckets are keyed by hashes of their digits.

1. Every window of ``size`` bytes has an anchor: the place inside it where the string of ``gram`` bytes with the smallest hash starts.
   Equal windows have equal anchors, and neighbouring windows share one, so a run of windows (some sixty) enters as one suffix.
2. The first digit is the string at the anchor.  Later digits extend it to both sides: windows whose start lies within ``width`` bytes of each
   other, seen from the anchor, share ``size - width + 1`` bytes.  Passes run from the widest span to width 1, where the shared
   string is the window itself, so equal groups of the last pass are exactly the repeated windows.
3. In each pass, suffixes are counted by (digits, class); a class is a whole run, place of the anchor included.  A class met twice is repeated
   in all its windows and needs no further pass.  Only buckets with several classes, one of them met once, are split by the next digit,
   and one suffix stands for each class there.  Everything else leaves.
4. A pass scans its source for counts, of classes and of buckets, and once more for the rows of the classes found.  Bloom filters of a fixed
   size spare most rows the exchange in that last scan; the join behind it is exact, so a full filter costs shuffle (40 bytes a suffix) and
   loses nothing.

No group is ever collected: counts are combined before each exchange, and a join has one row for each class on one side.

Documents are told apart by (doc_id, 64-bit hash of the text); equal rows are copies of each other, so all their windows are repeated.  Null or
empty text: no bytes, nothing removed.  A null doc_id is a number of its own.  Texts of any length are cut into chunks of windows,
which changes classes but not results.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import Bloom, doc_numbers, map_texts, mix, slices

SIZE = 200
CHUNK = 1 << 20
BITS = 1 << 26
NULL_DOC = -(1 << 63)

_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BASE = 0xD6E8FEB86659FD93
_RUN = ["key", "class", "place", "weight", "doc", "text_hash", "start", "n", "lead"]
_RUN_SCHEMA = "key long, class long, place long, weight int, doc long, text_hash long, start long, n int, lead int"


# --- windows and anchors
def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive bytes, from hashes of runs of doubling length."""
    run, length, factor = _BYTES[data], 1, _BASE
    out, have = None, 0
    while True:
        if size & length:
            n = len(data) - have - length + 1
            if n <= 0:
                return np.zeros(0, np.uint64)
            out = run if out is None else out[:n] * np.uint64(factor) + run[have : have + n]
            have += length
        if length * 2 > size:
            return mix(out)
        n = len(run) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        run = run[:n] * np.uint64(factor) + run[length : length + n]
        length, factor = length * 2, factor * factor % (1 << 64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values, size = np.minimum(values[: len(values) - size], values[size:]), size * 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def anchored(data: np.ndarray, ends: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in a chunk: (key, first window, windows, bytes from the first window to the anchor).

    ``ends``: for each byte the end of its text, so windows that would cross texts are left out.
    """
    n = len(data) - size + 1
    none = (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    if n <= 0:
        return none
    whole = np.flatnonzero(np.arange(n) + size <= ends[:n])
    if not len(whole):
        return none
    grams = rolling(data, gram)
    tagged = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    at = (sliding_min(tagged, size - gram + 1)[whole] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(whole) != 1) | (ends[whole[1:]] != ends[whole[:-1]])]))
    start = whole[first]
    return grams[at[first]], start, np.diff(np.append(first, len(whole))), at[first] - start


@dataclass
class Runs:
    """Suffixes of a slice: their columns, and their bytes on demand."""
    columns: dict[str, np.ndarray]
    content: Callable[[int], bytes]


def _columns(key, classes, weight, doc, text_hash, start, n, lead) -> dict[str, np.ndarray]:
    place = mix(mix(text_hash ^ mix(doc.view(np.uint64))) + mix(start.astype(np.uint64)))
    as_long = lambda x: x.view(np.int64)
    return dict(zip(_RUN, (as_long(key), as_long(classes), as_long(place), weight, doc, as_long(text_hash), start, n, lead)))


def _class_hash(content: list, lead: np.ndarray) -> np.ndarray:
    found = np.fromiter((xxhash.xxh3_64_intdigest(c) for c in content), np.uint64, len(content))
    return mix(found ^ mix(lead.astype(np.uint64) + np.uint64(1)))


def text_runs(size: int, gram: int) -> Callable[[pa.RecordBatch], Iterator[Runs]]:
    """First pass: the suffixes of whole texts."""
    def run(part):
        texts, ids = pc.fill_null(part.column("text"), "").cast(pa.binary()), doc_numbers(part, NULL_DOC)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        raw = texts.buffers()[2]
        data = (np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8))[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        view, lengths = memoryview(np.ascontiguousarray(data)), np.diff(offsets)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(offsets, offsets[1:])), np.uint64, len(texts))
        for a in range(0, len(data), CHUNK):
            b = min(a + CHUNK + size - 1, len(data))
            first_text = int(np.searchsorted(offsets, a, "right")) - 1
            last_text = int(np.searchsorted(offsets, b, "left"))
            near = np.arange(first_text, last_text)
            ends = np.repeat(offsets[1:][near], np.minimum(offsets[1:][near], b) - np.maximum(offsets[near], a)) - a
            key, start, n, lead = anchored(data[a:b], ends, size, gram)
            start = start + a
            text = np.searchsorted(offsets, start, "right") - 1
            bounds = list(zip(start.tolist(), (start + n + size - 1).tolist()))
            classes = _class_hash([view[x:y] for x, y in bounds], lead)
            columns = _columns(key, classes, np.ones(len(key), np.int32), ids[text], hashes[text], start - offsets[text], n, lead)
            yield Runs(columns, lambda i, bounds=bounds: bytes(view[bounds[i][0] : bounds[i][1]]))
    return run


def content_runs(size: int, width: int) -> Callable[[pa.RecordBatch], Iterator[Runs]]:
    """Later passes: the suffixes left, split by where their windows start from the anchor."""
    def run(part):
        held = part.to_pylist()
        rows, content = [], []
        for r in held:
            i = 0
            while i < r["n"]:
                lead = r["lead"] - i  # bytes from this window to the anchor; negative behind it
                floor = lead // width * width
                m = min(lead - floor + 1, r["n"] - i)
                body = r["content"][i : i + m + size - 1]
                # Windows of this span start at most ``width - 1`` bytes before the string that all of them share.
                core = body[lead - floor : lead - floor + size - width + 1]
                rows.append((xxhash.xxh3_64_intdigest(core, seed=floor % (1 << 32)), r["weight"], r["doc"], r["text_hash"], r["start"] + i, m, lead))
                content.append(body)
                i += m
        key, weight, doc, text_hash, start, n, lead = (np.array(c, t) for c, t in zip(
            zip(*rows) if rows else [()] * 7, (np.uint64, np.int32, np.int64, np.int64, np.int64, np.int64, np.int64)))
        yield Runs(_columns(key, _class_hash(content, lead), weight, doc, text_hash.view(np.uint64), start, n, lead), content.__getitem__)
    return run


# --- a pass
def _batch(columns: dict[str, np.ndarray], mask: np.ndarray, names: list[str]) -> list[pa.Array]:
    kinds = {"weight": pa.int32(), "n": pa.int32(), "lead": pa.int32()}
    return [pa.array(columns[c][mask], kinds.get(c, pa.int64())) for c in names]


def radix_pass(source: DataFrame, runs: Callable, by: str, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """(repeated stretches, suffixes for the next pass) of the suffixes that ``runs`` makes of the slices of ``source``."""
    spark = source.sparkSession
    names = ["key", "class", "place", "weight"]

    def count(batches):
        for batch in batches:
            for part in slices(batch, by):
                for r in runs(part):
                    yield pa.RecordBatch.from_arrays(_batch(r.columns, np.ones(len(r.columns["key"]), bool), names), names)

    classes = (source.mapInArrow(count, "key long, class long, place long, weight int")
               .groupBy("key", "class").agg(F.sum("weight").alias("met"), F.min("place").alias("place")))
    if last:  # the digits are whole windows
        wanted = classes.where("met > 1").withColumn("split", F.lit(False))
    else:
        # Both uses scan the source: a staged copy would take 24 bytes for every 60 of text and save little time.
        mixed = (classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes"), F.max((F.col("met") == 1).cast("int")).alias("single"))
                 .where("classes > 1 AND single = 1").select("key", F.lit(True).alias("split")))
        wanted = (classes.join(mixed, "key", "left").select("key", "class", "met", "place", F.coalesce("split", F.lit(False)).alias("split"))
                  .where("met > 1 OR split"))
    wanted = materialise(spark, wanted, "wanted")
    filters = Bloom.build(wanted.select("class", (F.col("met") > 1).alias("twice")), "class", BITS, twice=F.col("twice"))
    filters |= Bloom.build(wanted.where("split").select("place"), "place", BITS, split=F.lit(True)) if not last else {}
    hit = {k: spark.sparkContext.broadcast(v) for k, v in filters.items()}

    def find(batches):
        for batch in batches:
            for part in slices(batch, by):
                for r in runs(part):
                    n = len(r.columns["key"])
                    if not n:
                        continue
                    stands = hit["split"].value.has(r.columns["place"].view(np.uint64)) if not last else np.zeros(n, bool)
                    # A suffix of weight 2 was reported by an earlier pass and is only a partner here.
                    mask = stands | ((r.columns["weight"] == 1) & hit["twice"].value.has(r.columns["class"].view(np.uint64)))
                    content = [r.content(i) if s else None for i, s in zip(np.flatnonzero(mask).tolist(), stands[mask].tolist())]
                    yield pa.RecordBatch.from_arrays([*_batch(r.columns, mask, _RUN), pa.array(content, pa.binary())], [*_RUN, "content"])

    found = source.mapInArrow(find, _RUN_SCHEMA + ", content binary").join(
        wanted.select("key", "class", "met", F.col("place").alias("stand"), "split"), ["key", "class"])
    next_weight = F.least("met", F.lit(2)).cast("int")
    kept = materialise(spark, found.select(
        "doc", "text_hash", "start", "n", "lead", ((F.col("met") > 1) & (F.col("weight") == 1)).alias("repeated"), next_weight.alias("weight"),
        F.when(F.col("split") & (F.col("place") == F.col("stand")), F.col("content")).alias("content")), "radix")
    for b in hit.values():
        b.unpersist()
    stretches = kept.where("repeated").select("doc", "text_hash", "start", "n")
    return stretches, None if last else kept.where("content IS NOT NULL").drop("repeated")


def passes(size: int) -> tuple[int, list[int]]:
    """Length of the first digit, and the widths of the later passes."""
    gram = max(size // 3, 1)
    span = size - gram + 1
    return gram, sorted({w for w in (-(-span // 8), 1) if w < span}, reverse=True)


def repeated_stretches(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc, text_hash, start, n): stretches of windows, in bytes, whose string also starts elsewhere."""
    gram, widths = passes(size)
    out, rest = radix_pass(docs.select(F.col("doc_id").cast("long"), "text"), text_runs(size, gram), "text", last=not widths)
    for w in widths:
        found, rest = radix_pass(rest, content_runs(size, w), "content", last=w == widths[-1])
        out = out.unionByName(found)
    return out


# --- removal
def _spans(gone, size: int, length: int) -> list[tuple[int, int]]:
    """Maximal removed byte spans."""
    out: list[list[int]] = []
    for g in sorted((g["start"], g["start"] + g["n"] + size - 1) for g in gone or ()):
        if out and g[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], g[1])
        else:
            out.append(list(g))
    return [(a, min(b, length)) for a, b in out]


def remove_repeated_bytes(docs: DataFrame, size: int = SIZE, with_spans: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row; with ``with_spans`` also the removed ``spans`` (start and end in
    bytes) and the bytes ``kept``.

    Only documents that may have lost bytes, by a Bloom filter of fixed size, are joined with their stretches; all others are
    finished where they are read.
    """
    spark = docs.sparkSession
    stretches = repeated_stretches(docs, size).distinct()  # equal rows have equal stretches; after that a text's length bounds its list
    found = materialise(spark, stretches.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("gone")), "stretches")
    hit = spark.sparkContext.broadcast(Bloom.build(found.select(F.xxhash64("doc", "text_hash").alias("b")), "b", BITS // 8, all=F.lit(True))["all"])
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", spans array<struct<start:long,end:long>>, kept binary" * with_spans

    def named(part):
        texts = pc.fill_null(part.column("text"), "").to_pylist()
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in texts), np.uint64, len(texts)).view(np.int64)
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), pa.array(doc_numbers(part, NULL_DOC)), pa.array(hashes)],
                                          ["doc_id", "text", "doc", "text_hash"])

    def finish(part, gone):
        out = []
        for t, g in zip(part.column("text").to_pylist(), gone):
            data = (t or "").encode()
            spans = _spans(g, size, len(data))
            kept = b"".join(data[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(data)]))
            row = (len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
            out.append(row + ([{"start": a, "end": b} for a, b in spans], kept) * with_spans)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        kinds = kinds[: 6 if with_spans else 4]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * len(kinds), kinds)]],
                                          names[: 1 + len(kinds)])

    rows = map_texts(docs.select(F.col("doc_id").cast("long"), "text"), named, "doc_id long, text string, doc long, text_hash long")
    rows = rows.withColumn("b", F.xxhash64("doc", "text_hash"))

    def only(part, wanted):
        return part.filter(pa.array(hit.value.has(np.asarray(part.column("b")).astype(np.int64).view(np.uint64)) == wanted))

    whole = map_texts(rows, lambda p: finish(q := only(p, False), [None] * q.num_rows), schema)
    joined = (map_texts(rows, lambda p: only(p, True), rows.schema).join(found, ["doc", "text_hash"], "left").select("doc_id", "text", "gone"))
    return whole.unionByName(map_texts(joined, lambda p: finish(p, p.column("gone").to_pylist()), schema))
