"""The source audit against a plain version with Python integers."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.llm import skyband_audit

from . import brute
from .conftest import edge_rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, min_docs, top=50):
    """Rows are (text, lang, source)."""
    count, docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    groups = set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(brute.LOWER))
        groups.add((lang, source))
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, c in docs[lang].items() if c >= min_docs]
        own = sorted(s for g, s in groups if g == lang)
        whole = {t: sum(count[lang, s][t] for s in own) for t in kept}

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(count[lang, s]) for s in own}, shares(whole)
        for s in own:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def got(df, **kw):
    return sorted(map(tuple, skyband_audit.audit(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect()))


@pytest.mark.parametrize("min_docs", [1, 2, 30])
def test_edges(edge, min_docs):
    assert got(edge, min_docs=min_docs) == plain([(r[1], r[2], r[3]) for r in edge_rows()], min_docs)


def test_empty_table(none):
    assert got(none) == []


def test_small_blocks_and_tiles(spark, monkeypatch):
    """Several tiles and chunks, blocks that can't be cut, a hot source, ties, words beyond ASCII."""
    for name, value in (("BLOCK", 32), ("TILE", 3), ("CHUNK", 8), ("SALTS", 2)):
        monkeypatch.setattr(skyband_audit, name, value)
    random_, rows = random.Random(11), []
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)] + ["é", "Éa", "ß", "字", "\U0001F600x", "don't"]
    for k in range(400):
        source = "hot" if k % 3 == 0 else f"s{random_.randrange(9)}"
        rows.append((" ".join(random_.choice(words) for _ in range(random_.randrange(12))), random_.choice(["en", "de", None]), source))
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    for top in (1, 4, 50):
        assert got(df, min_docs=2, top=top) == plain(rows, 2, top)


def test_undominated_is_the_skyband():
    random_ = np.random.default_rng(1)
    n, low, at = random_.integers(0, 9, 700), random_.integers(0, 9, 700), random_.permutation(700)
    by = [sum((n[j] >= n[i]) and (low[j] <= low[i]) and (at[j] < at[i]) for j in range(700)) for i in range(700)]
    for k in (1, 3, 50):
        assert skyband_audit.undominated(n, low, at, k).tolist() == [x < k for x in by]


def test_shares_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**17, 3 * 10**17, 7)], "n long, t long, v long").select(
        skyband_audit.share("n", "t", "v").alias("p"), F.col("n")).first()
    assert row.p == 1 + 10**9 * (10**17 + 5) // (3 * 10**17 + 35)
