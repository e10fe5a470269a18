"""Merkle manifest of a dataset as postorder append logs, with proofs addressed by closed-form positions.

Every row is a leaf, the SHA-256 of its fields.  The leaves of a source, in ascending order, are the bottom of its tree: as
long as several nodes remain, every ``FANOUT`` consecutive ones (the last run may be shorter, even one) are hashed into their
parent.  The tops, in the order of their sources, are the leaves of one more tree, whose top is the root of the dataset.

1. Leaves are numbered within their source by a two-level count over range-partitioned blocks of even size.
2. Aligned builders each take ``SEGMENT`` consecutive leaves and append nodes in the order of their completion: a node
   follows its last child.  A segment is thus one stretch of the source's postorder log.  The tops of the segments are the leaves
   of the next layer, until a source has one node left; each layer is ``SEGMENT`` times smaller than the one below.
3. Positions in such a log follow from subtree sizes (``position``), so the siblings of a node are read by address.
   Proofs go from the top layer down: a segment gets the path above its top once and hands each leaf its own path.

Only hashes and ids leave the scan of the texts.  No step holds more than ``SEGMENT`` nodes and one path.

Nulls: every null field is the text ``-``; a null source is a source of its own, before all others; a null doc_id comes first
in its source and is never tampered with.  Rows that share a doc_id are ordered by their leaf, so equal rows take any order and the
result is the same.  Empty texts are ``0:``; texts of any length are hashed whole.  An empty table gives no rows.  Other columns
are not read.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

FANOUT = 16
LEVELS = 2
SEGMENT = FANOUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "array<struct<at:int,siblings:string>>"


# --- closed forms
def height(n: int) -> int:
    """Levels above the leaves of a tree over ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // FANOUT), h + 1
    return h


def position(level: int, j: int, n: int, top: int) -> int:
    """Place in the postorder log of node ``j`` of a level, in a tree of ``top`` levels over ``n`` leaves.

    Before it stand the nodes of lower levels up to its last leaf, its own level up to ``j``, and the higher nodes that ended
    before its first leaf.
    """
    first = j * FANOUT**level
    end = min(first + FANOUT**level, n)
    lower = sum(-(-end // FANOUT**k) for k in range(level))
    return lower + j + sum(first // FANOUT**k for k in range(level + 1, top + 1))


def sibling_positions(i: int, n: int, top: int) -> list[tuple[int, list[int]]]:
    """For each level below the top: the place of leaf ``i``'s ancestor in its run, and where its siblings stand in the log."""
    out = []
    for level in range(top):
        j = i // FANOUT**level
        a = j - j % FANOUT
        b = min(a + FANOUT, -(-n // FANOUT**level))
        out.append((j - a, [position(level, k, n, top) for k in range(a, b) if k != j]))
    return out


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def append(leaves: list[str], top: int) -> list[str]:
    """Nodes of a tree of ``top`` levels in the order of their completion."""
    log: list[str] = []
    open_: list[list[str]] = [[] for _ in range(top + 1)]

    def close(level: int, node: str) -> None:
        log.append(node)
        open_[level].append(node)
        if level < top and len(open_[level]) == FANOUT:
            run, open_[level] = open_[level], []
            close(level + 1, digest(*run))

    for leaf in leaves:
        close(0, leaf)
    for level in range(top):  # runs that the last leaf leaves open
        if open_[level]:
            run, open_[level] = open_[level], []
            close(level + 1, digest(*run))
    return log


def fold(node: str, path: list[dict]) -> str:
    """The top that a node and its path lead to."""
    for step in path:
        cut = 64 * step["at"]
        node = digest(step["siblings"][:cut], node, step["siblings"][cut:])
    return node


# --- leaves
def leaf_hash(*values: Column) -> Column:
    def field(v):
        text = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, leaf, and the leaf of the tampered row where the row is tampered with."""
    values = [F.col(c) for c in FIELDS]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    picked = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    # Byte order of these names is: null first, then the sources by UTF-8.
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))
    return docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("item"), leaf_hash(*values).alias("hash"),
                       F.when(picked, leaf_hash(*values[:-1], lowered)).alias("tampered"))


def numbered(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` with their place ``idx`` in their tree, by (item, hash), and the number ``n`` of the tree's leaves.

    Blocks follow the whole order, equal rows included, so a tree with any share of the rows is many blocks.
    """
    order = ["tree", "item", "hash", "_seq"]
    placed = materialise(rows.sparkSession, rows.withColumn("_seq", F.monotonically_increasing_id()).repartitionByRange(*order)
                         .sortWithinPartitions(*order).drop("_seq").withColumn("_block", F.spark_partition_id())
                         .withColumn("_at", F.monotonically_increasing_id()), label)
    parts = placed.groupBy("tree", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    by_tree = Window.partitionBy("tree")  # one row for each block that holds a part of the tree
    bases = parts.select("tree", "_block", (F.sum("_n").over(by_tree.orderBy("_block")) - F.col("_n") - F.col("_first")).alias("_base"),
                         F.sum("_n").over(by_tree).alias("n"))
    return placed.join(bases, ["tree", "_block"]).withColumn("idx", F.col("_at") + F.col("_base")).drop("_block", "_at", "_base")


# --- the log, layer by layer
def _top(m: int, n: int) -> int:
    """Levels that a builder adds over its ``m`` of the layer's ``n`` nodes: all of them if it has the whole tree."""
    return height(n) if n <= SEGMENT else LEVELS


def segments(nodes: DataFrame, label: str) -> DataFrame:
    """(tree, blk, n, log, items, tampered): the log segment of every aligned run of ``SEGMENT`` nodes."""
    run = F.sort_array(F.collect_list(F.struct("idx", "hash", "item", "tampered")))  # SEGMENT entries at most
    grouped = (nodes.groupBy("tree", F.floor(F.col("idx") / SEGMENT).alias("blk")).agg(F.first("n").alias("n"), run.alias("run"))
               .select("tree", "blk", "n", F.col("run.hash").alias("log"), F.col("run.item").alias("items"), F.col("run.tampered").alias("tampered")))

    def build(batches):
        for batch in batches:
            logs = [append(run, _top(len(run), n)) for run, n in zip(batch.column("log").to_pylist(), batch.column("n").to_pylist())]
            yield batch.set_column(batch.schema.get_field_index("log"), "log", pa.array(logs, pa.list_(pa.string())))

    return materialise(nodes.sparkSession, grouped.mapInArrow(build, grouped.schema), label)


def layers(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Segments of all layers of all trees, the bottom first."""
    out = [segments(nodes, label)]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > SEGMENT:
        above = out[-1].where(F.col("n") > SEGMENT).select(
            "tree", F.col("blk").alias("idx"), F.element_at("log", -1).alias("hash"), F.ceil(F.col("n") / SEGMENT).alias("n"),
            F.lit(None).cast("long").alias("item"), F.lit(None).cast("string").alias("tampered"))
        out.append(segments(above, label))
    return out


def tops(built: list[DataFrame]) -> DataFrame:
    """(tree, hash) of every tree."""
    found = [s.where(F.col("n") <= SEGMENT).select("tree", F.element_at("log", -1).alias("hash")) for s in built]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def log_table(built: list[DataFrame]) -> DataFrame:
    """The whole append log, (tree, position, level, idx, hash), positions as in one log of each tree."""
    total = built[0].groupBy("tree").agg(F.sum(F.size("items")).alias("total"))
    schema = "tree string, position long, level int, idx long, hash string"

    def run(layer):
        def nodes(batches):
            for batch in batches:
                rows = []
                for s in batch.to_pylist():
                    m, n, blk, leaves_ = len(s["items"]), s["n"], s["blk"], s["total"]
                    top = _top(m, n)
                    for level in range(1 if layer else 0, top + 1):  # the leaves of a higher layer stand in the one below
                        span = SEGMENT // FANOUT**level
                        for j in range(-(-m // FANOUT**level)):
                            g, at = layer * LEVELS + level, blk * span + j
                            rows.append((s["tree"], position(g, at, leaves_, height(leaves_)), g, at, s["log"][position(level, j, m, top)]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*rows) if rows else [()] * 5, (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string()))],
                    ["tree", "position", "level", "idx", "hash"])
        return nodes

    parts = [s.join(total, "tree").mapInArrow(run(i), schema) for i, s in enumerate(built)]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


# --- proofs
def _steps(segment: dict, i: int) -> list[dict]:
    m, log = len(segment["items"]), segment["log"]
    return [{"at": at, "siblings": "".join(log[p] for p in where)} for at, where in sibling_positions(i, m, _top(m, segment["n"]))]


def paths(built: list[DataFrame], heads: DataFrame) -> DataFrame:
    """Bottom segments with the path above their top.  ``heads``: tree, top, and the path from the top of the tree on."""
    schema = f"tree string, blk long, top string, path {_STEP}"

    def down(batches):
        for batch in batches:
            for k in range(batch.num_rows):  # a segment at a time
                s = batch.slice(k, 1).to_pylist()[0]
                yield _batch([(s["tree"], s["blk"] * SEGMENT + i, s["top"], _steps(s, i) + s["path"]) for i in range(len(s["items"]))],
                             ["tree", "blk", "top", "path"], [pa.string(), pa.int64(), pa.string(), _PATH])

    ready = None
    for layer, here in reversed(list(enumerate(built))):
        single = here.where(F.col("n") <= SEGMENT).join(heads, "tree")
        rows = single if ready is None else single.unionByName(here.where(F.col("n") > SEGMENT).join(ready, ["tree", "blk"]))
        if layer == 0:
            return rows
        ready = materialise(here.sparkSession, rows.mapInArrow(down, schema), "merkle-path")


_PATH = pa.list_(pa.struct([("at", pa.int32()), ("siblings", pa.string())]))


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(names), types)], names)


def manifest(docs: DataFrame, proofs: bool = False) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row; the ``proof`` itself if asked for.

    ``proof`` is the path from the leaf to the root: for each level the place in its run and the siblings, left to right.
    """
    built = layers(numbered(leaves(docs), "merkle-leaves"), "merkle")
    spark = docs.sparkSession
    sources = tops(built).select(F.lit("").alias("tree"), F.col("tree").alias("item"), "hash", F.lit(None).cast("string").alias("tampered"))
    upper = layers(numbered(sources, "merkle-sources"), "merkle-top")
    found = tops(upper).first()
    root = found["hash"] if found else ""
    heads = paths(upper, spark.createDataFrame([("", "", [])], f"tree string, top string, path {_STEP}"))

    def head(batches):
        for batch in batches:
            out = []
            for s in batch.to_pylist():
                own = s["log"]
                m = len(s["items"])
                out += [(tree, own[position(0, i, m, _top(m, s["n"]))], _steps(s, i) + s["path"]) for i, tree in enumerate(s["items"])]
            yield _batch(out, ["tree", "top", "path"], [pa.string(), pa.string(), _PATH])

    heads = materialise(spark, heads.mapInArrow(head, f"tree string, top string, path {_STEP}"), "merkle-heads")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof"]
    types = [pa.int64(), *[pa.string()] * 5, pa.bool_(), _PATH]
    kept = len(names) if proofs else len(names) - 1

    def prove(batches):
        for batch in batches:
            for k in range(batch.num_rows):  # a segment at a time
                s = batch.slice(k, 1).to_pylist()[0]
                m, above, out = len(s["items"]), s["path"], []
                rest = "".join(step["siblings"] for step in above)
                for i, (item, changed) in enumerate(zip(s["items"], s["tampered"])):
                    own = s["log"][position(0, i, m, _top(m, s["n"]))]
                    near = _steps(s, i)
                    got = fold(changed or own, near + above)
                    out.append((item, own, s["top"], root, digest(*[x["siblings"] for x in near], rest), got, got == root,
                                near + above if proofs else None)[:kept])
                yield _batch(out, names[:kept], types[:kept])

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return paths(built, heads).mapInArrow(prove, schema + f", proof {_STEP}" * proofs)


# --- SQL
def _crc32(text: str) -> str:
    byte = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"


def _tree_sql(name: str, levels: int) -> str:
    """Tables {name}0.. of nodes and {name}r0.. of runs over {name}0 (tree, idx, h); FANOUT nodes a run."""
    out = []
    for k in range(levels):
        out.append(f"""{name}r{k} AS (SELECT tree, idx // {FANOUT} AS run, list(h ORDER BY idx) AS hs, any_value(c) AS c
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM {name}{k}) GROUP BY ALL),
{name}{k + 1} AS (SELECT tree, run AS idx, CASE WHEN c = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}r{k})""")
    return ",\n".join(out)


def _fold_sql(name: str, start: str, levels: int) -> str:
    """Follow (tree, idx, f, proof) of table ``start`` up through the runs of {name}: {name}f<levels>."""
    out, last = [], start
    for k in range(levels):
        at = f"(d.idx // {FANOUT**k}) % {FANOUT}"
        left, right = f"array_to_string(r.hs[1:{at}], '')", f"array_to_string(r.hs[{at} + 2:], '')"
        out.append(f"""{name}f{k} AS (SELECT d.* REPLACE (CASE WHEN r.c = 1 THEN d.f ELSE sha256({left} || d.f || {right}) END AS f,
  CASE WHEN r.c = 1 THEN d.proof ELSE d.proof || {left} || {right} END AS proof)
  FROM {last} d JOIN {name}r{k} r ON r.tree = d.tree AND r.run = d.idx // {FANOUT ** (k + 1)})""")
        last = f"{name}f{k}"
    return ",\n".join(out)


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in (*FIELDS[:-1], text)) + ")"


def oracle_sql(levels: int = 7, source_levels: int = 4) -> str:
    """The same result for up to FANOUT**levels rows of a source and FANOUT**source_levels sources."""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH docs AS (SELECT doc_id, coalesce('=' || source, '-') AS tree, {_leaf_sql("text")} AS leaf,
  CASE WHEN ({_crc32("doc_id::VARCHAR")}) % 5 = 0 THEN {_leaf_sql(lowered)} END AS tampered FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM docs),
d0 AS (SELECT tree, idx, leaf AS h FROM placed),
{_tree_sql("d", levels)},
s0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, h, tree AS own FROM d{levels}),
{_tree_sql("s", source_levels)},
start AS (SELECT tree, idx, coalesce(tampered, leaf) AS f, '' AS proof, doc_id, leaf FROM placed),
{_fold_sql("d", "start", levels)},
middle AS (SELECT s0.tree, s0.idx, f.f, f.proof, f.doc_id, f.leaf, s0.h AS subroot FROM d{'f'}{levels - 1} f JOIN s0 ON s0.own = f.tree),
{_fold_sql("s", "middle", source_levels)}
SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = root.h AS verified
FROM sf{source_levels - 1}, s{source_levels} AS root"""
