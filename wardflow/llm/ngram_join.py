"""N-gram Jaccard join by grouped prefixes, and its connected components.

1. Every text becomes the set of its word shingles (64-bit hashes); equal sets are one class, named by their 128-bit
   signature through all steps; doc_ids come in only at the end.
2. Shingles are ordered rare first: every document's shingles are counted in a table of ``TABLE`` cells, and a shingle's rank is the order of
   magnitude of its cell, then its hash.  Any order gives the same links; this one keeps common passages out of prefixes, and in a full
   table it becomes the order of hashes.  In that order two sets that reach the threshold share a shingle among the first
   ``n - ceil(t n) + 1`` (the prefix).  Documents with the same size and prefix are one group and enter the index once.  Shingles that
   are in one group's prefix only are left out (counted over the corpus, told by a Bloom filter of fixed size).
3. Star links: in every bucket (the groups with one prefix shingle) each group is paired with the one that has the fewest rarer shingles,
   the nearest to a common original, and each class with the first of its group.  Group pairs are filtered by size and position and made
   distinct over all shingles; only then do they become pairs of classes, filtered by an upper bound of the overlap from two
   sketches and verified on whole sets.
4. Only buckets that still hold several components are searched further: small ones pair by pair with the size and
   position filters, large ones in blocks of bounded size with the sketch bound.  Classes outside a bucket's largest component visit all
   its blocks; those inside stay in their own.  Pairs inside one component are never formed, so a large group of copies costs its star
   and no more; no link between components is lost.
5. Components come from large-star and small-star rounds, each written to the shared folder.

The sketch counts shingles in residue classes (about four to a class, at least ``CLASSES`` classes): an overlap is at most
the sum of the smaller counts.

Null, empty and blank texts have no shingles and link with nothing.  A component is shown by its smallest doc_id, which is null only
if no row of it has one.  Rows that share a doc_id, or have none, are told apart by their sets: they are in one component only if their
sets are linked.  Texts of any length enter whole, equal rows are one class, and an empty table gives no rows.  Other columns are not read;
``first_of_each`` passes them through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import Bloom, doc_numbers, lists, map_texts, mix, packed, slices, unpacked, window_hashes, word_hashes

WORDS, PERCENT = 5, 80
CLASSES = 128
SMALL, BLOCK = 32, 1_024
TABLE, CHUNK, SALTS = 1 << 22, 1 << 16, 16
FULL = 1 << 24
BITS = 1 << 26
NULL_DOC = (1 << 63) - 1


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, offsets = word_hashes(texts, lower=True)
    grams, out = window_hashes(hashes, words), []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:  # the whole sequence is one shingle; its length keeps it apart
            out.append(mix(window_hashes(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1 if n else 0


def sketch(values: np.ndarray) -> bytes:
    """Counts of shingles in residue classes, about four shingles a class (a power of two, CLASSES at least)."""
    classes = max(CLASSES, 1 << (max(len(values) // 4, 1) - 1).bit_length())
    return np.minimum(np.bincount((values % np.uint64(classes)).astype(np.int64), minlength=classes), 255).astype(np.uint8).tobytes()


def folded(counts: bytes, classes: int = CLASSES) -> np.ndarray:
    """A sketch with fewer classes; a class that holds a full counter stays out of every bound (it counts as infinite)."""
    fine = np.frombuffer(counts, np.uint8)
    out = fine.reshape(-1, classes).sum(0, dtype=np.int32)
    if (fine == 255).any():
        out[(fine.reshape(-1, classes) == 255).any(0)] = FULL
    return out


def may_reach(a: np.ndarray, b: np.ndarray, na, nb, percent: int):
    """Whether the overlap bound of folded sketches (in the last axis) allows the threshold."""
    return (100 + percent) * np.minimum(a, b).sum(axis=-1, dtype=np.int64) >= percent * (na + nb)


def pair_may_reach(a: bytes, b: bytes, na: int, nb: int, percent: int) -> bool:
    classes = min(len(a), len(b))
    return bool(may_reach(folded(a, classes), folded(b, classes), na, nb, percent))


def sized(na: Column, nb: Column, percent: int) -> Column:
    return 100 * F.least(na, nb) >= percent * F.greatest(na, nb)


def text_key(text: Column) -> Column:
    """128-bit hash of a text; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def magnitudes(docs: DataFrame, words: int) -> np.ndarray:
    """Order of magnitude of the number of documents whose shingles fall into each cell; every document counts.

    A task keeps one table of bytes, summed in chunks by key in two steps; what reaches the driver has ``TABLE`` bytes whatever the corpus.
    """
    table = TABLE

    def count(batches):
        cells = np.zeros(table, np.uint8)
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column("text"), words)
                at, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]) & np.uint64(table - 1), return_counts=True)
                at = at.astype(np.int64)
                cells[at] = np.minimum(cells[at] + n, 255)
        chunks = [(i, cells[a : a + CHUNK]) for i, a in enumerate(range(0, table, CHUNK))]
        yield rows([(i, c.astype(np.int64)) for i, c in chunks if c.any()])

    def rows(chunks):
        width = np.uint8 if all(c.max() < 256 for _, c in chunks) else np.int64
        return pa.RecordBatch.from_arrays([pa.array([i for i, _ in chunks], pa.int32()), pa.array([np.dtype(width).itemsize for _ in chunks], pa.int32()),
                                           pa.array([c.astype(width).tobytes() for _, c in chunks], pa.binary())], ["chunk", "width", "cells"])

    def add(batches):
        at, total = None, None
        for batch in batches:
            for chunk, width, cells in zip(*(batch.column(i) for i in range(3))):
                values = np.frombuffer(cells.as_buffer(), np.uint8 if width.as_py() == 1 else np.int64).astype(np.int64)
                if chunk.as_py() != at:
                    if at is not None:
                        yield rows([(at, total)])
                    at, total = chunk.as_py(), np.zeros(len(values), np.int64)
                total = total + values
        if at is not None:
            yield rows([(at, total)])

    schema = "chunk int, width int, cells binary"
    parts = docs.select("text").mapInArrow(count, schema)
    salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))).repartition("chunk", "salt")
    some = salted.sortWithinPartitions("chunk").drop("salt").mapInArrow(add, schema)
    summed = some.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, schema)

    def scale(batches):
        for batch in batches:
            for chunk, width, cells in zip(*(batch.column(i) for i in range(3))):
                values = np.frombuffer(cells.as_buffer(), np.uint8 if width.as_py() == 1 else np.int64).astype(np.float64)
                bits = np.frexp(values)[1].astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([chunk.as_py()], pa.int32()), pa.array([bits.tobytes()], pa.binary())], ["chunk", "bits"])

    out = np.zeros(table, np.uint8)
    for row in summed.mapInArrow(scale, "chunk int, bits binary").collect():  # one byte a cell
        out[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row.bits, np.uint8)
    return out


def document_sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One row per document: hash of its text, size, 128-bit signature, group, prefix and sketch of its set."""
    ranks = docs.sparkSession.sparkContext.broadcast(magnitudes(docs, words))

    def rarest(s):
        table, k = ranks.value, prefix_length(len(s), percent)
        rank = table[(s & np.uint64(len(table) - 1)).astype(np.int64)]
        return s[np.argsort(rank, kind="stable")[:k]]  # s ascends, so equal ranks stay in the order of hashes

    def run(part):
        sets = shingle_sets(part.column("text"), words)
        sizes = np.array([len(s) for s in sets], np.int64)
        prefixes = [rarest(s) for s in sets]
        sig = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
        group = np.array([xxhash.xxh3_64_intdigest(p.tobytes(), seed=len(s)) for p, s in zip(prefixes, sets)], np.uint64)
        signed = lambda values: pa.array(np.array(values, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([
            pa.array(doc_numbers(part, NULL_DOC)), part.column("key"), pa.array(sizes), pa.array([x.to_bytes(16, "big") for x in sig], pa.binary()), signed(group),
            lists(np.concatenate(prefixes).view(np.int64) if prefixes else np.zeros(0, np.int64), [len(p) for p in prefixes], pa.int64()),
            pa.array([sketch(s) if len(s) else None for s in sets], pa.binary())], ["doc", "key", "n", "sig", "gid", "prefix", "sketch"])
    return map_texts(docs.select(F.col("doc_id").cast("long"), text_key(F.col("text")).alias("key"), "text"), run,
                     "doc long, key binary, n long, sig binary, gid long, prefix array<long>, sketch binary")


def postings(sets: DataFrame) -> DataFrame:
    """(token, gid, n, pos) for prefix shingles that several rows hold; one row per group."""
    spark = sets.sparkSession
    counts = sets.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = spark.sparkContext.broadcast(Bloom.build(counts, "token", BITS, all=F.lit(True))["all"])

    def run(batches):
        for b in batches:
            column = b.column("prefix")
            lengths = np.diff(np.asarray(column.offsets))
            tokens = np.asarray(column.flatten()).astype(np.int64)
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            hit = shared.value.has(tokens.view(np.uint64))
            spread = lambda name: pa.array(np.repeat(np.asarray(b.column(name)), lengths)[hit])
            yield pa.RecordBatch.from_arrays([pa.array(tokens[hit]), spread("gid"), spread("n"), pa.array(pos[hit].astype(np.int32))], ["token", "gid", "n", "pos"])

    return sets.where("n > 0").select("gid", "n", "prefix").mapInArrow(run, "token long, gid long, n long, pos int").distinct()


def verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose whole sets reach the threshold; one document of each class is read out."""
    spark = docs.sparkSession
    ids = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    row = F.xxhash64("shown.doc", "shown.key")
    shown = classes.select(F.col("c").alias("sig"), "shown").join(ids, "sig", "left_semi").select(row.alias("key"))
    hit = spark.sparkContext.broadcast(Bloom.build(shown, "key", BITS // 8, all=F.lit(True))["all"])
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_DOC))
    rows = docs.select("text", F.struct(doc.alias("doc"), text_key(F.col("text")).alias("key")).alias("shown")).select("text", row.alias("key"))

    def run(part):
        mask = hit.value.has(np.asarray(part.column("key")).astype(np.int64).view(np.uint64))
        part = part.filter(pa.array(mask))
        items = [s.tobytes() for s in (shingle_sets(part.column("text"), words) if part.num_rows else [])]
        sig = [xxhash.xxh3_128_digest(x) for x in items]
        return pa.RecordBatch.from_arrays([pa.array(sig, pa.binary()), pa.array(items, pa.binary())], ["sig", "items"])

    # Rows without doc_id may hold one text many times; each set goes on once.
    sets = map_texts(rows, run, "sig binary, items binary").join(ids, "sig", "left_semi").groupBy("sig").agg(F.first("items").alias("items"))
    left = pairs.join(sets.select(F.col("sig").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(sets.select(F.col("sig").alias("b"), F.col("items").alias("y")), "b").select("a", "b", "x", "y")

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(x, y)
                both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(check, "a binary, b binary").distinct()


def _sketched(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes that size and sketch bound allow."""
    side = lambda c, k: classes.select(F.col("c").alias(c), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"s{k}"))
    rows = pairs.join(side("a", 1), "a").where(F.col("n1") > 0).join(side("b", 2), "b").where(sized(F.col("n1"), F.col("n2"), percent))

    def run(batches):
        for b in batches:
            keep = [pair_may_reach(x, y, m, n, percent) for x, y, m, n in zip(*(b.column(k).to_pylist() for k in ("s1", "s2", "n1", "n2")))]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.select("a", "b", "n1", "n2", "s1", "s2").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(c, comp) of every node of the links: the smallest node that it reaches.  Large-star and small-star rounds."""
    spark = links.sparkSession
    e = materialise(spark, links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "links")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("v", "u")), F.lit(0))).first()
    seen = mark(e)
    while seen[0]:
        both = e.select(F.col("v").alias("x"), F.col("u").alias("y")).unionByName(e.select(F.col("u").alias("x"), F.col("v").alias("y")))
        low = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
        large = both.join(low, "x").where("y > x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v")
        small = small.select("v", F.col("m").alias("u")).unionByName(small.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))).distinct()
        e = materialise(spark, small, "links")
        if (now := mark(e)) == seen:
            break
        seen = now
    return e.select(F.col("v").alias("c"), F.col("u").alias("comp"))


def _small_buckets(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in buckets of up to SMALL rows, with size and position filters."""
    def run(batches):
        token, held, out = None, [], set()

        def close():
            held.sort()
            for i, (na, pa_, a, ca) in enumerate(held):
                for nb, pb, b, cb in held[i + 1 :]:
                    if 100 * na < percent * nb:
                        break
                    if ca != cb and (100 + percent) * (1 + min(na - pa_, nb - pb) - 1) >= percent * (na + nb):
                        out.add((a, b) if a < b else (b, a))
            held.clear()

        def flush():
            a, b = zip(*out) if out else ((), ())
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

        for batch in batches:
            for t, *row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if t != token:
                    close()
                    token = t
                held.append(tuple(row))
            if len(out) > 50_000:
                yield flush()
        close()
        yield flush()

    return (rows.repartition("token").sortWithinPartitions("token").select("token", "n", "pos", "c", "comp")
            .mapInArrow(run, "a binary, b binary").distinct())


def _large_buckets(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in larger buckets, in blocks of about BLOCK rows.

    A row outside the bucket's largest component (``major``) visits every block; a row inside stays in its own, as it only
    has to meet the others.
    """
    blocks = F.ceil(F.col("cnt") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("c"), blocks).cast("int")
    rows = rows.join(classes.select("c", "sketch"), "c").withColumn("own", own)
    at = F.when(F.col("comp") == F.col("major"), F.array("own")).otherwise(F.sequence(F.lit(0), blocks - 1))
    met = rows.select("token", F.explode(at).alias("block"), "own", "n", "pos", "c", "comp", "sketch")

    def run(batches):
        cell, held = None, []

        def close():
            if not held:
                return
            home, n, pos = (np.array(v, np.int64) for v in list(zip(*held))[:3])
            home = home == cell[1]
            c, fine = ([h[x] for h in held] for x in (3, 5))
            numbers: dict[bytes, int] = {}
            comp = np.array([numbers.setdefault(h[4], len(numbers)) for h in held], np.int64)
            s = np.stack([folded(f) for f in fine])
            order = np.argsort(n, kind="stable")
            home, n, pos, comp, s = (v[order] for v in (home, n, pos, comp, s))
            c, fine = ([v[x] for x in order] for v in (c, fine))
            for i in range(len(n)):
                j = np.arange(i + 1, int(np.searchsorted(n, 100 * n[i] // percent, side="right")))
                # Two visitors meet in the block that one of them has as its own.
                need = ((100 + percent) * np.minimum(n[i] - pos[i], n[j] - pos[j]) >= percent * (n[i] + n[j])) & (comp[j] != comp[i])
                j = j[need if home[i] else need & home[j]]
                if len(j):
                    j = j[may_reach(s[j], s[i], n[j], n[i], percent)]
                    j = j[[pair_may_reach(fine[x], fine[i], int(n[x]), int(n[i]), percent) for x in j]] if len(j) else j
                    if len(j):
                        a, b = zip(*(sorted((c[x], c[i])) for x in j))
                        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
            held.clear()

        for batch in batches:
            for t, block, *row in zip(*(batch.column(x).to_pylist() for x in range(8))):
                if (t, block) != cell:
                    yield from close()
                    cell = (t, block)
                held.append(row)
        yield from close()

    return met.repartition("token", "block").sortWithinPartitions("token", "block").mapInArrow(run, "a binary, b binary").distinct()


def _several(rows: DataFrame, by: str) -> DataFrame:
    """(by, cnt, major) of the buckets that hold several components; ``major`` is the one with most rows."""
    counts = rows.groupBy(by, "comp").agg(F.count(F.lit(1)).alias("_n"))
    return (counts.groupBy(by).agg(F.sum("_n").alias("cnt"), F.count(F.lit(1)).alias("_comps"), F.max(F.struct("_n", "comp")).alias("_m"))
            .where("_comps > 1").select(by, "cnt", F.col("_m.comp").alias("major")))


def _linked(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc, key, n, sig of every row and comp, the smallest signature of its component (null without shingles)."""
    spark = docs.sparkSession
    sets = materialise(spark, document_sets(docs, words, percent), "sets")
    classes = materialise(spark, sets.where("n > 0").groupBy(F.col("sig").alias("c"), "n").agg(
        F.min(F.struct("doc", "key")).alias("shown"), F.min("gid").alias("gid"), F.min("sketch").alias("sketch")), "classes")
    index = materialise(spark, postings(sets), "postings")

    first = classes.groupBy("gid").agg(F.min("c").alias("rep"))
    centre = (index.groupBy("token").agg(F.min(F.struct("pos", "gid", "n")).alias("m"), F.count(F.lit(1)).alias("cnt")).where("cnt > 1")
              .select("token", "m.*").toDF("token", "p0", "g0", "n0"))
    placed = (100 + percent) * F.least(F.col("n") - F.col("pos"), F.col("n0") - F.col("p0")) >= percent * (F.col("n") + F.col("n0"))
    stars = index.join(centre, "token").where((F.col("gid") != F.col("g0")) & sized(F.col("n"), F.col("n0"), percent) & placed).select("g0", "gid").distinct()
    name = lambda g, c: first.select(F.col("gid").alias(g), F.col("rep").alias(c))
    pairs = stars.join(name("g0", "a"), "g0").join(name("gid", "b"), "gid").select("a", "b").unionByName(
        classes.join(first, "gid").where("c <> rep").select(F.col("rep").alias("a"), F.col("c").alias("b")))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    links = materialise(spark, verified(docs, materialise(spark, _sketched(pairs, classes, percent), "pairs"), classes, words, percent), "links")
    comps = components(links)

    members = classes.select("c", "gid").join(comps, "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    members = materialise(spark, members, "members")
    rows = index.join(members, "gid")
    rows = materialise(spark, rows.join(_several(rows, "token"), "token").select("token", "n", "pos", "c", "comp", "cnt", "major"), "buckets")
    more = _sketched(_small_buckets(rows.where(f"cnt <= {SMALL}"), percent), classes, percent).unionByName(
        _large_buckets(rows.where(f"cnt > {SMALL}"), classes, percent)).distinct()
    # Classes with one prefix and no common bucket left (a prefix that no other group holds) meet through their group.
    twins = members.join(_several(members, "gid"), "gid").join(classes.select("c", "n"), "c").select(
        F.col("gid").alias("token"), "n", F.lit(0).alias("pos"), "c", "comp", "cnt", "major")
    more = more.unionByName(_sketched(_small_buckets(twins.where(f"cnt <= {SMALL}"), percent), classes, percent)).unionByName(
        _large_buckets(twins.where(f"cnt > {SMALL}"), classes, percent)).distinct()
    more = verified(docs, materialise(spark, more, "pairs"), classes, words, percent)
    comps = components(links.unionByName(more))

    named = classes.select(F.col("c").alias("sig")).join(comps.withColumnRenamed("c", "sig"), "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
    return sets.select("doc", "key", "n", "sig").join(named, "sig", "left")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    rows = materialise(docs.sparkSession, _linked(docs, words, percent), "linked")
    lows = rows.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc").alias("low"))
    out = rows.join(lows, "comp", "left").withColumn("low", F.coalesce("low", "doc"))
    real = lambda c: F.when(F.col(c) == NULL_DOC, F.lit(None)).otherwise(F.col(c)).cast("long")
    return out.select(real("doc").alias("doc_id"), F.col("n").alias("n_shingles"), real("low").alias("component_id"))


def first_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents that show their components, in the shape of the input; texts without shingles all stay.

    The smallest doc_id, null last, shows a component, and of its texts in it the one of smallest signature and hash.  Rows
    equal in doc_id and text are one document and stay together; without doc_id one of them stays.
    """
    rows = materialise(docs.sparkSession, _linked(docs, words, percent), "linked")
    shown = rows.where("comp IS NOT NULL").groupBy("comp").agg(F.min(F.struct("doc", "sig", "key")).alias("s")).select("s.doc", "s.key")
    blank = rows.where("comp IS NULL").select("doc", "key").distinct()
    found = shown.withColumn("one", F.col("doc") == NULL_DOC).unionByName(blank.withColumn("one", F.lit(False)))
    mine = packed(docs).withColumn("doc", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(NULL_DOC))).withColumn("key", text_key(F.col("row.text")))
    kept = mine.join(found.where("NOT one"), ["doc", "key"], "left_semi").select("row")
    single = mine.where(F.col("doc") == NULL_DOC).join(found.where("one"), ["doc", "key"], "left_semi").groupBy("key").agg(F.first("row").alias("row"))
    return unpacked(kept.unionByName(single.select("row")), docs.columns)
