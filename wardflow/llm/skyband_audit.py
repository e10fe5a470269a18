"""Divergence of the sources of a language: how far their word shares lie apart, and which words set a source off.

A word's share of a group (a source within a language, or a language) is ``p = 1 + floor(SCALE * (n + PRIOR) / (N + PRIOR * V))`` for its
``n`` of the group's ``N`` occurrences of the ``V`` kept words.  All arithmetic is on integers.

1. Words are counted in Arrow slices, combined before the exchange: occurrences for each (lang, source, word), documents for each
   (lang, word).  Words in at least ``MIN_DOCS`` documents of the language are kept.
2. Words (part ``term``): a word that occurs no more often in a group, no less often in the language and later in UTF-8 order than another
   ranks behind it, whatever N and V are.  Each partition therefore retains the ``TOP``-skyband of every group, the words
   that fewer than ``TOP`` others dominate so; the skybands are merged and cut again, and only then are shares computed and words
   ranked exactly.  Blocks of ``BLOCK`` words are cut at a time; a block that can't be cut is handed on whole.
3. Pairs (part ``pair``): the distance of two sources is summed over tiles, ``TILE`` sources against ``TILE`` sources for about ``CHUNK`` words.
   A word that a source lacks has the source's base share, so only occurrences are shuffled.  The result has one row
   for each ordered pair of sources in a language, as its contract asks; no other step is quadratic.

Null text, lang and source are ''.  Empty texts have no words, but their group occurs.  Texts of any length are counted whole; repeated
rows and rows that share a doc_id are documents of their own; doc_id is not read.  Ties rank by UTF-8 order.  A language without kept
words gives pairs of value 0 and no terms.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import map_texts, split_words

MIN_DOCS, PRIOR, SCALE, TOP = 30, 5, 1_000_000_000, 50
BLOCK, SALTS = 2048, 16
TILE, CHUNK = 256, 512

_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[0x80:] = np.arange(0x80, 0x100)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)


# --- counting
def letters_only(texts: pa.Array) -> pa.Array:
    """Texts with A-Z lower-cased and a blank for every other ASCII byte that is no letter."""
    texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(offsets - offsets[0])), pa.py_buffer(_LETTERS[raw]))


def _count(part: pa.RecordBatch) -> pa.RecordBatch:
    """n occurrences and docs documents of each (lang, source, term) of a slice."""
    coded, offsets = split_words(letters_only(part.column("text")))
    lang, source = part.column("lang").dictionary_encode(), part.column("source").dictionary_encode()
    group = np.asarray(lang.indices, np.int64) * len(source.dictionary) + np.asarray(source.indices, np.int64)
    code, size = np.asarray(coded.indices, np.int64), max(len(coded.dictionary), 1)
    row = np.repeat(np.arange(part.num_rows), np.diff(offsets))
    once, n = np.unique(row * size + code, return_counts=True)
    pair, at = np.unique(group[once // size] * size + once % size, return_inverse=True)
    g = pair // size
    take = lambda values, places: values.take(pa.array(places))
    return pa.RecordBatch.from_arrays(
        [take(lang.dictionary, g // max(len(source.dictionary), 1)), take(source.dictionary, g % max(len(source.dictionary), 1)),
         take(coded.dictionary, pair % size), pa.array(np.bincount(at, weights=n, minlength=len(pair)).astype(np.int64)),
         pa.array(np.bincount(at, minlength=len(pair)).astype(np.int64))], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) over whole texts."""
    return (map_texts(docs.select("lang", "source", "text"), _count, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(n: Column | str, total: str, kept: str) -> Column:
    """The share of ``n`` of ``total`` occurrences of ``kept`` words; products of 64-bit numbers are taken as decimals."""
    wide = (F.col(n) if isinstance(n, str) else n).cast("decimal(19,0)") + PRIOR
    return 1 + F.call_function("div", wide * SCALE, (F.col(total) + PRIOR * F.col(kept)).cast("decimal(19,0)"))


# --- terms: skybands
def undominated(n: np.ndarray, lang_n: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Rows that fewer than ``k`` others dominate: at least as high ``n``, at most as high ``lang_n``, smaller ``place``."""
    order = np.lexsort((place, lang_n, -n))
    low, at = lang_n[order], place[order]
    kept = np.zeros(len(n), bool)
    for a in range(0, len(n), 256):  # only rows before in this order can dominate
        b = min(a + 256, len(n))
        by = (low[None, :b] <= low[a:b, None]) & (at[None, :b] < at[a:b, None]) & (np.arange(b)[None, :] < np.arange(a, b)[:, None])
        kept[order[a:b]] = by.sum(axis=1) < k
    return kept


def skyband(rows: DataFrame, k: int, *salt: Column) -> DataFrame:
    """The rows (lang, source, term, n, lang_n) that fewer than ``k`` rows of their group and partition dominate, or more where a
    block can't be cut; with ``salt``, partitions are made anew from the parts of each group."""
    if salt:
        rows = rows.repartition("lang", "source", *salt)
    rows = rows.sortWithinPartitions("lang", "source")

    def cut(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        order = np.asarray(pc.sort_indices(table.column("term").cast(pa.binary())))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        mask = undominated(np.asarray(table.column("n")), np.asarray(table.column("lang_n")), place, k)
        return table.filter(pa.array(mask)).combine_chunks().to_batches()[0]

    def run(batches):
        group, held, size = None, [], 0
        for batch in batches:
            lang, source = batch.column("lang"), batch.column("source")
            edge = np.flatnonzero(np.asarray(pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(source[1:], source[:-1])), bool)) + 1
            cuts = [0, *edge.tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                own = (lang[a].as_py(), source[a].as_py())
                if own != group:
                    if held:
                        yield cut(held)
                    group, held, size = own, [], 0
                while a < b:
                    step = min(b - a, BLOCK - size)
                    held.append(batch.slice(a, step))
                    a, size = a + step, size + step
                    if size == BLOCK:
                        kept = cut(held)
                        if kept.num_rows > BLOCK // 2:
                            yield kept
                            held, size = [], 0
                        else:
                            held, size = [kept], kept.num_rows
        if held:
            yield cut(held)

    return rows.mapInArrow(run, rows.schema)


def distinctive_terms(counted: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The ``top`` words of each group whose share exceeds the language's by most."""
    few = skyband(skyband(counted, top), top, F.pmod(F.xxhash64("term"), F.lit(SALTS)))
    shares = (few.join(groups, ["lang", "source"])
              .select("lang", "source", F.col("term").alias("item"), (share("n", "total", "kept") - share("lang_n", "lang_total", "kept")).alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return shares.where("value > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


# --- pairs: tiles
def _tile_sums(table: pa.Table) -> pa.Table:
    """Sums of distances over the words of one chunk, for the sources of one pair of tiles, both ways."""
    lang, ti, tj = (table.column(c)[0].as_py() for c in ("lang", "ti", "tj"))
    names = table.column("source").combine_chunks().dictionary_encode()
    words = table.column("term").combine_chunks().dictionary_encode()
    who, p = np.asarray(names.indices), np.asarray(table.column("p"), np.int64)
    tile, listed = np.asarray(table.column("tile")), np.asarray(table.column("term").is_null())
    own = np.zeros(len(names.dictionary), np.int64)
    base = np.zeros(len(own), np.int64)
    own[who], base[who[listed]] = tile, p[listed]
    shares = np.repeat(base[:, None], len(words.dictionary), axis=1)
    at = np.asarray(pc.fill_null(words.indices, 0))[~listed]
    shares[who[~listed], at] = p[~listed]
    left, right = np.flatnonzero(own == ti), np.flatnonzero(own == tj)
    kept = np.asarray(table.column("kept"))[0] if table.column("chunk")[0].as_py() == 0 else 0
    a, b, value = [], [], []
    for s in left:
        others = right[right != s]
        # Words that no source of the tiles has are at base: all of them are added once, those met here are taken off.
        sums = np.abs(shares[others] - shares[s]).sum(axis=1) + (kept - shares.shape[1]) * np.abs(base[others] - base[s])
        a.append(np.full(len(others), s))
        b.append(others)
        value.append(sums)
    a, b, value = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, value))
    if ti != tj:
        a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([value, value])
    pick = lambda places: names.dictionary.take(pa.array(places))
    return pa.table([pa.array([lang] * len(a), pa.string()), pick(a), pick(b), pa.array(value, pa.int64())], ["lang", "source", "item", "value"])


def source_distances(counted: DataFrame, groups: DataFrame) -> DataFrame:
    """Distance of every ordered pair of sources of a language over all kept words."""
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    base = F.when(F.col("kept") > 0, share(F.lit(0), "total", "kept")).otherwise(0)
    listed = (groups.join(sizes, "lang")
              .select("lang", "source", "total", "kept", base.alias("base"), F.ceil(F.col("sources") / TILE).alias("tiles"),
                      F.greatest(F.lit(1), F.ceil(F.col("kept") / CHUNK)).alias("chunks"))
              .withColumn("tile", F.pmod(F.xxhash64("source"), "tiles")))
    everywhere = listed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
                               F.lit(None).cast("string").alias("term"), F.col("base").alias("p"))
    met = counted.join(listed, ["lang", "source"]).select(
        *listed.columns, F.pmod(F.xxhash64("term"), "chunks").alias("chunk"), "term", share("n", "total", "kept").alias("p"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    dealt = (everywhere.unionByName(met).select("lang", "source", "tile", "kept", "chunk", "term", "p", other)
             .select("lang", F.least("tile", "other").alias("ti"), F.greatest("tile", "other").alias("tj"), "chunk", "source", "tile", "kept", "term", "p"))
    sums = dealt.groupBy("lang", "ti", "tj", "chunk").applyInArrow(_tile_sums, "lang string, source string, item string, value long")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")  # one row for each other source
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank: distances between sources and their distinctive words."""
    spark = docs.sparkSession
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(blank("lang"), blank("source"), blank("text"))
    terms = materialise(spark, term_counts(rows), "terms")
    kept = (terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= min_docs).drop("docs"))
    counted = materialise(spark, terms.drop("docs").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept-terms")
    totals = counted.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # A word's count in the language is the sum over its sources, so both follow from the kept rows.
    langs = (counted.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n"))
             .groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("kept")))
    groups = materialise(spark, rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
                         .na.fill(0, ["total", "lang_total", "kept"]), "groups")
    found = {"pair": source_distances(counted, groups), "term": distinctive_terms(counted, groups, top)}
    pair, term = (df.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")
                  for part, df in found.items())
    return pair.unionByName(term)


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}),
langs AS (SELECT lang, sum(lang_n) AS lang_total, count(*) AS v FROM kept GROUP BY lang),
gr AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT gr.lang, gr.source, kept.term, kept.lang_n FROM gr JOIN kept USING (lang)),
counts AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
filled AS (SELECT lang, source, term, coalesce(n, 0) AS n, lang_n, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total
  FROM cells LEFT JOIN counts USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + ({SCALE}::HUGEINT * (n + {PRIOR})) // (total + {PRIOR} * v) AS p,
    1 + ({SCALE}::HUGEINT * (lang_n + {PRIOR})) // (lang_total + {PRIOR} * v) AS q FROM filled JOIN langs USING (lang)),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(apart.value, 0) AS value
  FROM gr a JOIN gr b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found)
WHERE part = 'pair' OR rank <= {TOP}"""
