"""Removal of repeated byte strings against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest

from wardflow.llm import radix_repeats

from .conftest import edge_rows


def plain(rows, size):
    count = collections.Counter()
    for _, text in rows:
        data = (text or "").encode()
        count.update(data[i : i + size] for i in range(len(data) - size + 1))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone, end = [False] * len(data), 0
        for k in range(len(data) - size + 1):
            if count[data[k : k + size]] > 1:
                for x in range(max(k, end), k + size):
                    gone[x] = True
                end = k + size
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, size=200):
    return sorted(map(tuple, radix_repeats.remove_repeated_bytes(df, size).collect()), key=str)


def test_edges(edge):
    assert got(edge) == plain([(r[0], r[1]) for r in edge_rows()], 200)


def test_empty_table(none):
    assert got(none) == []


def random_rows(size, seed):
    """Copies, near copies, shared passages at odd places, self-overlapping texts, clashing and missing ids, repeated rows."""
    random_ = random.Random(seed)
    text = lambda n, letters: "".join(random_.choice(letters) for _ in range(n))
    base, rows = [text(random_.randrange(1, 4 * size + 5), "abé") for _ in range(10)], []
    for i in range(70):
        kind = random_.random()
        if kind < 0.3:
            t = text(random_.randrange(6 * size), "ab")
        elif kind < 0.6:
            t = random_.choice(base) + text(random_.randrange(size), "xyz") + random_.choice(base)
        elif kind < 0.8:
            t = list(random_.choice(base) * 2)
            t[random_.randrange(len(t))] = "Q"
            t = "".join(t)
        else:
            t = "a" * random_.randrange(4 * size)
        rows.append((random_.choice([i, i, 7, None]), t))
    return rows + [(None, None), (5, "")] + rows[:3]


@pytest.mark.parametrize("size", [1, 2, 8, 30, 200])
def test_random_texts(spark, size):
    rows = random_rows(size, size)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), size) == plain(rows, size)


def test_chunks_and_full_filters(spark, monkeypatch):
    """Texts cut into many chunks of windows and filters that let almost everything through change nothing."""
    monkeypatch.setattr(radix_repeats, "CHUNK", 37)
    monkeypatch.setattr(radix_repeats, "BITS", 1 << 10)
    rows = random_rows(30, 5)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 30) == plain(rows, 30)


def test_one_passage_in_a_third_of_all_documents(spark):
    passage = "x".join(str(i * i) for i in range(70))
    random_ = random.Random(2)
    own = lambda: "".join(random_.choice("abcdefghij ") for _ in range(random_.randrange(100, 500)))
    rows = [(i, own() + passage[i % 5 :] + own() if i % 3 == 0 else own()) for i in range(900)] + [(None, passage)] * 300
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)) == plain(rows, 200)


def test_spans_and_kept_bytes(spark):
    passage = "".join(f"{i:04d}" for i in range(60))
    df = spark.createDataFrame([(1, "é" + passage + "tail"), (2, passage), (3, "short")], "doc_id long, text string")
    out = {r.doc_id: r for r in radix_repeats.remove_repeated_bytes(df, with_spans=True).collect()}
    assert [tuple(s) for s in out[1].spans] == [(2, 242)] and bytes(out[1].kept) == "étail".encode()
    assert out[2].n_removed == 240 and out[2].n_spans == 1 and bytes(out[2].kept) == b"" and out[3].spans == []


def test_rolling_hashes_tell_strings_apart():
    data = np.frombuffer(b"abracadabra" * 3, np.uint8)
    for size in (1, 2, 3, 7, 11, 33, 34):
        hashes = radix_repeats.rolling(data, size)
        strings = [data[i : i + size].tobytes() for i in range(len(data) - size + 1)]
        assert len(hashes) == len(strings) and len(set(zip(strings, hashes.tolist()))) == len(set(strings)) == len(set(hashes.tolist()))
