"""Quality rules on lines shared by many documents of a host, with DataFrame functions only.

Lines are normalised and hashed; each (host, line) gets the number of distinct documents that hold it.  A line
in more than ``min_docs`` documents, a fixed count however large the host is, is removed from all but the first of them, so that the
content itself is not lost.  A document that loses more than ``max_lost`` of its word characters is depleted and rejected.

Documents are named by (doc_id, MD5 of the text): rows that share a doc_id, or have none, are told apart by their texts, and
equal rows are one document for the line counts and share its verdict.  The first document of a line is the one of smallest doc_id, null
last, then of smallest MD5.  Null or empty text: no words, so the base rules fail.  A null host is a host of its own.  Texts of any
length are split whole inside their row.  An empty table gives no rows.  Every column of the input is matched by name; other
columns pass through ``clean_documents`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import BLANKS, let, packed, unpacked, words_col

SYMBOLS = "#*$%&|<>"
MIN_DOCS, MAX_LOST = 20, 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0000000000"


def bare(text: Column) -> Column:
    """Text without blanks."""
    return F.translate(text, BLANKS, "")


def line_hash(line: Column) -> Column:
    """Hash of a line with blanks collapsed, A-Z lowered and digits made equal."""
    return F.xxhash64(F.trim(F.regexp_replace(F.translate(line, _UPPER, _LOWER), r"[\x20\x09-\x0D]+", " ")))


def full_lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda s: bare(s) != "")


def text_key(text: Column) -> Column:
    """128-bit hash of a text; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def word_counts(text: Column) -> Column:
    """``n`` words and ``r`` words in repeated three-word windows.

    Repeated windows are found by sorting (window, place) strings inside the row: n log n per
    document, no shuffle, nothing quadratic in the length of a text.
    """
    def repeated(w: Column) -> Column:
        three = F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)))
        return let(three, lambda t: F.when(F.size(t) > F.size(F.array_distinct(t)), let(F.array_sort(F.transform(
            t, lambda x, i: F.concat(x, F.lit(" "), F.lpad(i.cast("string"), 9, "0")))), covered)).otherwise(0))

    def covered(keys: Column) -> Column:
        window = lambda s: F.substring(s, F.lit(1), F.length(s) - 10)
        twice = F.filter(F.transform(keys, lambda s, i: F.when(
            (window(s) == window(F.get(keys, i - 1))) | (window(s) == window(F.get(keys, i + 1))), F.substring(s, -9, 9).cast("int"))), lambda p: p.isNotNull())
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda p: F.array(p, p + 1, p + 2)))))

    return let(words_col(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated(w).cast("long").alias("r")))


def fails(n: Column, repeated: Column) -> Column:
    return (n < 50) | (100 * repeated > 50 * n)


def with_base_stats(docs: DataFrame) -> DataFrame:
    """doc_id, key, host and the base measures of each text."""
    text = F.coalesce("text", F.lit(""))
    df = docs.select(
        "doc_id", text_key(F.col("text")).alias("key"), F.col("source").alias("host"), F.length(bare(text)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(full_lines(F.col("text")), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        word_counts(F.col("text")).alias("c"))
    df = df.select("*", F.col("c.n").alias("n_words"), F.col("c.r").alias("n_repeat_words")).drop("c")
    return df.withColumn("base_failed", fails(F.col("n_words"), F.col("n_repeat_words")))


def document_lines(docs: DataFrame) -> DataFrame:
    """One row per (document, host, line hash) with the word characters of its occurrences."""
    one = F.explode(F.transform(full_lines(F.col("text")), lambda s: F.struct(line_hash(s).alias("h"), F.length(bare(s)).alias("c"))))
    # The key is taken before lines are parted, once for each text.
    named = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.col("source").alias("host"), "text")
    return (named.select("doc_id", "key", "host", one.alias("l"))
            .groupBy("doc_id", "key", "host", F.col("l.h").alias("h")).agg(F.sum("l.c").alias("chars")))


def _at(f_host: str, f_h: str) -> Column:
    return F.col("host").eqNullSafe(F.col(f_host)) & (F.col("h") == F.col(f_h))


def frequent_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Lines above the limit of their host, with the first document that holds them."""
    counts = lines.groupBy(F.col("host").alias("f_host"), F.col("h").alias("f_h")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc")).where(F.col("n_docs") > min_docs)
    # Only rows of the smallest doc_id are looked at again, so texts under one id, or without, are told apart.
    firsts = (lines.join(counts, _at("f_host", "f_h") & F.col("doc_id").eqNullSafe(F.col("first_doc")))
              .groupBy("f_host", "f_h").agg(F.min("key").alias("first_key")).toDF("g_host", "g_h", "first_key"))
    same = F.col("f_host").eqNullSafe(F.col("g_host")) & (F.col("f_h") == F.col("g_h"))
    return counts.join(firsts, same).select("f_host", "f_h", "first_doc", "first_key")


def marked_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The lines of all documents, cut and hashed once, with ``gone`` where a document loses the line."""
    lines = materialise(docs.sparkSession, document_lines(docs), "lines")
    first = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("key") == F.col("first_key"))
    return lines.join(frequent_lines(lines, min_docs), _at("f_host", "f_h"), "left").withColumn("gone", F.col("f_h").isNotNull() & ~first)


def _losses(marked: DataFrame, *more: Column) -> DataFrame:
    return marked.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(
        F.sum("chars").alias("line_chars"), F.sum(F.when(F.col("gone"), F.col("chars")).otherwise(0)).alias("lost_chars"), *more)


def _named(doc_id: Column, key: Column) -> Column:
    return doc_id.eqNullSafe(F.col("_id")) & (key == F.col("_key"))


def _enough(max_lost: float) -> Column:
    return F.coalesce("lost_chars", F.lit(0)) <= F.lit(max_lost) * F.coalesce("line_chars", F.lit(0))


def line_verdicts(docs: DataFrame, min_docs: int = MIN_DOCS, max_lost: float = MAX_LOST) -> DataFrame:
    """Base measures and the verdict of every row."""
    lost = _losses(marked_lines(docs, min_docs))
    return (with_base_stats(docs).join(lost, _named(F.col("doc_id"), F.col("key")), "left").drop("_id", "_key", "key")
            .withColumn("kept", ~F.col("base_failed") & _enough(max_lost))
            .withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("line_chars", "lost_chars")}))


def clean_documents(docs: DataFrame, min_docs: int = MIN_DOCS, max_lost: float = MAX_LOST) -> DataFrame:
    """The kept rows in the shape of the input, without the removed lines; ``n_chars`` follows the text.

    Documents that fail the base rules go where they are read; the others meet their removed lines in one join.
    """
    lost = _losses(marked_lines(docs, min_docs), F.collect_list(F.when(F.col("gone"), F.col("h"))).alias("gone"))  # lines of one document
    text = F.col("row.text")
    rows = packed(docs).where(~let(word_counts(text), lambda c: fails(c["n"], c["r"]))).withColumn("key", text_key(text))
    kept = rows.join(lost, _named(F.col("row.doc_id"), F.col("key")), "left").where(_enough(max_lost))
    rest = F.array_join(F.filter(F.split(text, "\n"), lambda s: ~F.array_contains("gone", line_hash(s)) | (bare(s) == "")), "\n")
    text = F.when(F.coalesce(F.size("gone"), F.lit(0)) == 0, text).otherwise(rest)
    size = {"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return unpacked(kept, docs.columns, text=text, **size)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest([x FOR x IN string_split_regex(text, '[\x20\x09-\x0D]+') IF x <> '']) AS w,
             generate_subscripts([x FOR x IN string_split_regex(text, '[\x20\x09-\x0D]+') IF x <> ''], 1) AS i FROM d),
nw AS (SELECT r, count(*) AS n_words FROM w GROUP BY r),
t AS (SELECT r, i, w || ' ' || lead(w, 1) OVER p || ' ' || lead(w, 2) OVER p AS t FROM w WINDOW p AS (PARTITION BY r ORDER BY i)),
t2 AS (SELECT r, i FROM t WHERE t IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, t) > 1),
rep AS (SELECT r, count(*) AS n_repeat_words FROM (SELECT DISTINCT r, i + k AS i FROM t2, (VALUES (0), (1), (2)) AS v(k)) GROUP BY r),
l AS (SELECT r, doc_id, md5(text) AS key, host, unnest([x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')]) AS l FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines FROM l GROUP BY r),
ln AS (SELECT doc_id, key, host, trim(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', 'abcdefghijklmnopqrstuvwxyz0000000000'),
              '[\x20\x09-\x0D]+', ' ', 'g')) AS k, sum(length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g'))) AS chars FROM l GROUP BY ALL),
c AS (SELECT host, k, min(doc_id) AS first_doc FROM ln GROUP BY host, k HAVING count(*) > 20),
f AS (SELECT c.host, c.k, first_doc, min(key) AS first_key FROM c JOIN ln ON ln.host IS NOT DISTINCT FROM c.host AND ln.k = c.k
      AND ln.doc_id IS NOT DISTINCT FROM c.first_doc GROUP BY ALL),
lost AS (SELECT ln.doc_id, ln.key, sum(chars) AS line_chars,
           sum(CASE WHEN f.k IS NOT NULL AND (ln.doc_id IS DISTINCT FROM first_doc OR ln.key <> first_key) THEN chars ELSE 0 END) AS lost_chars
         FROM ln LEFT JOIN f ON ln.host IS NOT DISTINCT FROM f.host AND ln.k = f.k GROUP BY ln.doc_id, ln.key),
b AS (SELECT d.doc_id, md5(text) AS key, coalesce(n_words, 0) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d LEFT JOIN nw USING (r) LEFT JOIN rep USING (r) LEFT JOIN dup USING (r))
SELECT b.* EXCLUDE (key), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce(lost_chars, 0) <= 0.5 * coalesce(line_chars, 0) AS kept,
  coalesce(line_chars, 0) AS line_chars, coalesce(lost_chars, 0) AS lost_chars
FROM b LEFT JOIN lost ON b.doc_id IS NOT DISTINCT FROM lost.doc_id AND b.key = lost.key
"""
