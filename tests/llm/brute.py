"""Plain versions of the operators, row by row, for small tables."""

import collections
import hashlib
import re
import string

import xxhash

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def order(i):
    return -(1 << 63) if i is None else i


def repeats(rows, size=20):
    """{(doc_id, text): (n_words, n_removed, sha)} of (doc_id, text) rows; documents in the order of id (null first) and 64-bit text hash."""
    seen, out = {}, {}
    for i, text in sorted(set(rows), key=lambda r: (order(r[0]), signed(xxhash.xxh3_64_intdigest(r[1] or "")))):
        w, gone = words(text), set()
        for k in range(len(w) - size + 1):
            t, here = " ".join(w[k : k + size]), (i, text, k)
            if seen.setdefault(t, here) != here:
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, text] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def signed(h):
    return h - (1 << 64) if h >= 1 << 63 else h


def components(rows, n=5, percent=80):
    """[(doc_id, n_shingles, component_id)] of (doc_id, text) rows."""
    last = lambda i: (1 << 63) - 1 if i is None else i
    sets = []
    for i, text in rows:
        w = words((text or "").translate(LOWER))
        sets.append((last(i), frozenset(tuple(w[k : k + n]) for k in range(max(len(w) - n + 1, 1))) if w else frozenset()))
    nodes = list(dict.fromkeys(sets))
    up = {x: x for x in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, x in enumerate(nodes):
        for y in nodes[a + 1 :]:
            if x[1] and y[1] and 100 * len(x[1] & y[1]) >= percent * len(x[1] | y[1]):
                up[max(top(x), top(y), key=lambda v: v[0])] = min(top(x), top(y), key=lambda v: v[0])
    low = collections.defaultdict(list)
    for x in nodes:
        low[top(x)].append(x[0])
    back = lambda i: None if i == last(None) else i
    return sorted(((back(i), len(s), back(min(low[top((i, s))]))) for i, s in sets), key=str)
