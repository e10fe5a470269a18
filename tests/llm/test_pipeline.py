"""The pipeline's end result on one small corpus, worked out in plain Python."""

import collections
import datetime as dt
import hashlib
import random
import re
import string

import pytest

import corpus_pipeline
from wardflow.llm import pseudonyms

from . import brute
from .test_pseudonyms import plain_day

public_tokenizers = pytest.importorskip("public_tokenizers")
SAME_DIGITS = str.maketrans(string.ascii_uppercase + string.digits, string.ascii_lowercase + "0" * 10)


def plain_quality(rows, min_docs=20, max_lost=0.5):
    """(doc_id, text, source) rows that stay, without the lines that go."""
    last = lambda i: (i is None, i or 0)
    name = lambda i, t: (last(i), hashlib.md5((t or "").encode()).digest())
    norm = lambda line: re.sub(r"[\x20\x09-\x0D]+", " ", line.translate(SAME_DIGITS)).strip(" ")
    bare = lambda line: re.sub(r"[\x20\x09-\x0D]", "", line)
    holders = collections.defaultdict(set)
    for i, t, s in rows:
        for line in (t or "").split("\n"):
            if bare(line):
                holders[s, norm(line)].add(name(i, t))
    gone = lambda i, t, s, line: bool(bare(line)) and len(holders[s, norm(line)]) > min_docs and min(holders[s, norm(line)]) != name(i, t)
    out = []
    for i, t, s in rows:
        w = brute.words(t)
        windows = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        repeated = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = (t or "").split("\n")
        lost = sum(len(bare(x)) for x in lines if gone(i, t, s, x))
        if len(w) >= 50 and 100 * len(repeated) <= 50 * len(w) and lost <= max_lost * sum(len(bare(x)) for x in lines):
            out.append((i, "\n".join(x for x in lines if not gone(i, t, s, x)), s))
    return out


def plain_first(rows):
    """One row of each component: the smallest doc_id, its rows equal in id and text together."""
    comp = brute.components([(i, t) for i, t, _ in rows])
    kept = {c for _, _, c in comp}
    return [r for r in rows if r[0] in kept]


def test_end_result(spark, tmp_path):
    random_ = random.Random(12)
    vocabulary = ["".join(random_.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(random_.randrange(3, 9))) for _ in range(400)]
    prose = lambda n: "\n".join(" ".join(random_.choice(vocabulary) for _ in range(10)) for _ in range(n))
    rows = [(i, prose(7) + "\nAll rights reserved 2021", "a") for i in range(25)]
    rows += [(100 + i, rows[i][1].replace("All", prose(1)[:5] + " All"), "b") for i in range(5)]  # near copies elsewhere
    rows += [(200, "two words", "a"), (201, " ".join(["again and again"] * 30), "a"), (202, None, None), (203, "", "a")]
    rows += [(300 + i, "\n".join(["All rights reserved 2022"] * 30) + "\n" + prose(5), "a") for i in range(3)]  # depleted
    rows += [(400, prose(8) + " seen 2024-02-29 by all", "c"), (400, prose(8), "c"), (None, prose(9), "c")]
    docs = spark.createDataFrame([(i, t, None, s, None if t is None else len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")  # without labels every rate is 1

    spark.conf.set(pseudonyms.KEY_CONF, "k")
    try:
        got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()), key=str)
    finally:
        spark.conf.unset(pseudonyms.KEY_CONF)

    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t, _ in plain_first(plain_quality(rows)):
        t = re.sub(r"\b\d{4}-\d\d-\d\d\b", lambda m: plain_day(dt.date.fromisoformat(m.group()), "k").isoformat(), t)
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=str)
    assert {r[0] for r in got} == {*range(25), 400, None} and len(got) == 28
