"""The Merkle manifest against a plain version, its log positions and its proofs."""

import collections
import random
import zlib

import pytest
from pyspark.sql import functions as F

from wardflow.llm import merkle_log
from wardflow.llm.merkle_log import FANOUT, append, digest, fold, height, position, sibling_positions

from .conftest import COLUMNS, edge_rows


def plain_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + FANOUT]) for i in range(0, len(out[-1]), FANOUT)])
    return out


def plain_path(levels, i):
    out = []
    for nodes in levels[:-1]:
        a = i - i % FANOUT
        run = nodes[a : a + FANOUT]
        out.append((i - a, run[: i - a] + run[i - a + 1 :]))
        i //= FANOUT
    return out


def plain_manifest(rows):
    """Rows are (doc_id, text, lang, source, n_chars)."""
    def leaf(doc_id, text, lang, source, n_chars):
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])

    low = lambda t: t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    trees = collections.defaultdict(list)
    for r in rows:
        trees[(r[3] is not None, (r[3] or "").encode())].append((r[0] is not None, r[0] or 0, leaf(*r), r))
    order = sorted(trees)
    levels = {t: plain_levels([x[2] for x in sorted(trees[t], key=lambda x: x[:3])]) for t in order}
    top = plain_levels([levels[t][-1][0] for t in order])
    root, out = top[-1][0], []
    for k, t in enumerate(order):
        for i, (_, _, own, r) in enumerate(sorted(trees[t], key=lambda x: x[:3])):
            path = plain_path(levels[t], i) + plain_path(top, k)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf(r[0], low(r[1]), *r[2:]) if changed else own
            for at, run in path:
                node = digest(*run[:at], node, *run[at:])
            out.append((r[0], own, levels[t][-1][0], root, digest(*[x for _, run in path for x in run]), node, node == root))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, merkle_log.manifest(df).collect()), key=str)


def test_edges(edge):
    assert got(edge) == plain_manifest([r[:5] for r in edge_rows()])


def test_empty_table(none):
    assert got(none) == []


@pytest.mark.parametrize("n", [1, 2, 16, 17, 255, 256, 257, 272, 273, 4096, 4097, 5000])
def test_position_is_the_place_in_the_append_log(n):
    leaves = [digest(str(i)) for i in range(n)]
    log, levels = append(leaves, height(n)), plain_levels(leaves)
    assert len(log) == sum(map(len, levels))
    for level, nodes in enumerate(levels):
        assert [log[position(level, j, n, height(n))] for j in range(len(nodes))] == nodes
    for i in {0, n // 2, n - 1}:
        assert [(at, [log[p] for p in where]) for at, where in sibling_positions(i, n, height(n))] == plain_path(levels, i)


def test_layers_many_sources_and_repeated_rows(spark):
    """Sources of one row, of exact and broken runs and of several layers; a third of all rows equal and without an id."""
    random_, rows = random.Random(3), []
    for k in range(40):
        rows += [(i, f"Text {k} {i}", "en", f"s{k}ü" if k % 3 else f"S{k}", i) for i in range(random_.choice([1, 2, 15, 16, 17, 33]))]
    rows += [(i, f"t{i}" if i % 3 else "T" * (i % 50), None, "hot", None) for i in range(4500)] + [(None, "SAME", "en", "hot", 4)] * 2500
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert got(df) == plain_manifest(rows)


def test_proofs_and_the_whole_log(spark):
    rows = [(i, f"t{i}", "en", "a" if i < 700 else None, 1, "row", 0, 0, 0, "", 0, "", "") for i in range(720)]
    df = spark.createDataFrame(rows, COLUMNS)
    for r in merkle_log.manifest(df, proofs=True).collect():
        path = [s.asDict() for s in r.proof]
        assert fold(r.leaf, path) == r.root and r.verified == (r.folded_root == r.root)
        assert fold(digest("other"), path) != r.root
    built = merkle_log.layers(merkle_log.numbered(merkle_log.leaves(df), "t"), "t")
    log = merkle_log.log_table(built).where("tree = '=a'").orderBy("position").collect()
    leaves = [x.hash for x in log if x.level == 0]
    assert [x.position for x in log] == list(range(len(log))) and [x.hash for x in log] == append(leaves, height(700))
    assert len(leaves) == 700 and merkle_log.tops(built).where(F.col("tree") == "=a").first().hash == log[-1].hash
