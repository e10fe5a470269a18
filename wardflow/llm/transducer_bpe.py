"""BPE encoding and decoding through a minimal acyclic transducer of frequent words.

1. Words are counted over all documents; the ``LEXICON_WORDS`` most frequent (a fixed bound) are encoded once.
2. They are compiled into a minimal acyclic automaton: equal suffixes share states, and each transition carries the
   number of words that sort before it, so the sum along a path is the word's place in the table of id lists.
3. The automaton is one file in the shared folder, shipped by Spark to every executor and memory-mapped there.
4. A word that the automaton does not accept is merged exactly, pair by pair, in order of merge rank.

A tokenizer file with NFC, blank, lower-case and byte-level steps and an end-of-word suffix is expected; its path is
a parameter.  Null and blank texts give no ids, an empty table no rows; texts and words of any length are encoded whole, long words by a heap of merges.  Special tokens in a text are found before any other step.  Repeated
rows are encoded like any other, extra columns pass through ``encode_documents``.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import struct
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_path
from .common import rest, slices

LEXICON_WORDS = 32_768
CACHE, SLICE = 300_000, 2 << 20  # parts of a generation; bytes of text at a time
LONG, BITS = 64, 20
ENDS = (".", ",", ";", ":", "!", "?")  # marks that part a plain word from what follows
MASK, NONE = (1 << BITS) - 1, 1 << 62
# The word pattern of the tokenizer file and the characters with the White_Space property.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_letters() -> list[str]:
    """Printable stand-in of each byte, as byte-level vocabularies write them."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and special tokens of a tokenizer file (a bounded table, shipped to the executors)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): r for r, m in enumerate(model["merges"])}
        self.end: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        letters = byte_letters()
        self.inner, self.last = ([self.ids[c + end] for c in letters] for end in ("", self.end))
        # Both parts of a pair in one number, and its rank and what it becomes in another: a smaller one is merged first.
        self.pairs = {self.ids[a] << BITS | self.ids[b]: r << BITS | self.ids[a + b] for (a, b), r in self.ranks.items()}

    def merge(self, word: str) -> list[int]:
        """Ids of one word: the adjacent pair of lowest rank is joined until none is left."""
        data = word.encode()
        if not data:
            return []
        inner, get = self.inner, self.pairs.get
        parts = [inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        if len(parts) > LONG:
            return self._merge_long(parts)
        pairs = [get(a << BITS | b, NONE) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best == NONE:
                break
            i = pairs.index(best)
            new = parts[i] = best & MASK
            del parts[i + 1], pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] << BITS | new, NONE)
            if i < len(pairs):
                pairs[i] = get(new << BITS | parts[i + 1], NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in n log n: a heap of (rank, place) over a linked list, outdated entries skipped."""
        n, get = len(parts), self.pairs.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i) for i in range(n - 1) if (r := get(parts[i] << BITS | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j < 0 or get(parts[i] << BITS | parts[j]) != best:  # a part that was joined away is negative
                continue
            parts[i], parts[j] = best & MASK, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (r := get(parts[i] << BITS | parts[k])) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := get(parts[h] << BITS | parts[i])) is not None:
                heapq.heappush(heap, (r, h))
        return [p for p in parts if p >= 0]

    def decode(self, ids) -> str:
        """Tokens of the ids joined by a blank, special tokens included; unknown ids are left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


def chunks(text: str) -> list[str]:
    """Parts between white space.  str.split also cuts at four control characters that are no white space here."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [c for c in regex.split(f"[{WHITE}]+", text) if c]
    return text.split()


_WORDS = regex.compile(PATTERN.replace(r"^\s", "^" + WHITE))


def words(chunk: str) -> list[str]:
    """Normalised words of a part without white space."""
    if chunk.isascii():
        if chunk.isalpha():  # the pattern takes plain letters whole
            return [chunk.lower()]
        body, mark = chunk[:-1], chunk[-1:]
        if mark in ENDS and body.isalpha():
            return [body.lower(), mark]
    else:
        chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")  # no final sigma
    return _WORDS.findall(chunk.lower())


def compile_lexicon(entries: dict[str, list[int]]) -> bytes:
    """Minimal acyclic transducer of word -> ids as one block of bytes.

    Words come in byte order; states of the part that no later word can change are merged with an equal state at
    once (equal: same finality and same labelled targets), so the automaton is minimal when the last word is in.
    """
    items = sorted((w.encode(), ids) for w, ids in entries.items())
    known: dict[tuple, int] = {}
    arcs: list[list[tuple[int, int]]] = []
    final: list[bool] = []
    path: list[tuple[int, list, list[bool]]] = [(0, [], [False])]  # label into the state, its arcs, its finality

    def freeze(depth: int) -> None:
        while len(path) > depth + 1:
            label, out, end = path.pop()
            key = (end[0], tuple(out))
            if key not in known:
                known[key] = len(arcs)
                arcs.append(out)
                final.append(end[0])
            path[-1][1].append((label, known[key]))

    last = b""
    for word, _ in items:
        same = os.path.commonprefix([last, word])
        freeze(len(same))
        path.extend((b, [], [False]) for b in word[len(same):])
        path[-1][2][0] = True
        last = word
    freeze(0)
    root = len(arcs)
    arcs.append(path[0][1])
    final.append(path[0][2][0])
    below = []  # words that each state accepts; targets are always frozen before the states above them
    for end, out in zip(final, arcs):
        below.append(end + sum(below[t] for _, t in out))
    first, labels, targets, before = [0], bytearray(), [], []
    for end, out in zip(final, arcs):
        n = int(end)
        for label, t in out:
            labels.append(label)
            targets.append(t * 2 + final[t])
            before.append(n)
            n += below[t]
        first.append(len(labels))
    starts, flat = [0], []
    for _, ids in items:
        flat.extend(ids)
        starts.append(len(flat))
    head = struct.pack("<6I", root, len(first), len(labels), len(starts), len(flat), int(final[root]))
    ints = [*first, *targets, *before, *starts, *flat]
    return head + struct.pack(f"<{len(ints)}I", *ints) + bytes(labels)


class Lexicon:
    """Memory-mapped transducer."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, n_first, n_arcs, n_starts, n_ids, self.empty = struct.unpack_from("<6I", self.map)
        at, parts = 24, []
        for n in (n_first, n_arcs, n_arcs, n_starts, n_ids):
            parts.append(np.frombuffer(self.map, np.uint32, n, at))
            at += 4 * n
        self.first, self.targets, self.before, self.starts, self.flat = parts
        labels = np.frombuffer(self.map, np.uint8, n_arcs, at)
        # (state, label) of each transition; sorted, as both are stored in order.
        self.keys = np.repeat(np.arange(n_first - 1), np.diff(self.first.astype(np.int64))) << 8 | labels

    def ranks(self, data: list[bytes]) -> np.ndarray:
        """Place of each word in the table of id lists, -1 for words that the automaton does not accept.

        All words take their next transition together.
        """
        size = np.array([len(d) for d in data], np.int64)
        start, text = np.cumsum(size) - size, np.frombuffer(b"".join(data), np.uint8)
        rank = np.zeros(len(data), np.int64)
        out = np.full(len(data), -1)
        if self.empty:
            out[size == 0] = 0
        live = np.flatnonzero(size > 0)
        state = np.full(len(live), self.root, np.int64)
        step = 0
        while len(live):
            keys = state << 8 | text[start[live] + step]
            at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
            found = self.keys[at] == keys if len(self.keys) else np.zeros(len(live), bool)
            live, at = live[found], at[found]
            rank[live] += self.before[at]
            target = self.targets[at].astype(np.int64)
            step += 1
            last = size[live] == step
            ended = live[last & (target & 1 == 1)]
            out[ended] = rank[ended]
            live, state = live[~last], target[~last] >> 1
        return out

    def ids(self, word: str) -> list[int] | None:
        """Ids of a word, None if the automaton does not accept it."""
        rank = int(self.ranks([word.encode()])[0])
        return None if rank < 0 else self.flat[self.starts[rank] : self.starts[rank + 1]].tolist()


class Recent:
    """Entries of the last two generations of ``size`` keys each; what is asked for again stays."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def missing(self, keys: set) -> set:
        """Keys without an entry; the others are in ``new`` afterwards, as the caller puts the missing ones."""
        if len(self.new) > self.size:
            self.new, self.old = {}, self.new
        out = keys.difference(self.new)
        known = out.intersection(self.old)
        self.new.update(zip(known, map(self.old.__getitem__, known)))
        return out - known


class Encoder:
    """Ids of whole texts; words and parts already met by this worker are kept up to a fixed number."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.special)) or r"(?!)")
        self.seen, self.inner = Recent(CACHE), Recent(CACHE // 4)  # parts, and words that were met inside parts only
        self.names = {i: str(i) for i in vocabulary.tokens}

    def entry(self, ids: list[int]) -> tuple[int, str, str]:
        """Number of ids, the ids as text, and their decoded text."""
        return len(ids), " ".join([self.names[i] for i in ids]), self.vocabulary.decode(ids)

    def word_entries(self, asked: list[str]) -> dict[str, tuple[int, str, str]]:
        """Entries of words, looked up in the automaton all at once; those that it does not hold are merged."""
        ranks = self.lexicon.ranks([w.encode() for w in asked]).tolist() if self.lexicon else [-1] * len(asked)
        out = {}
        merge, name, token = self.vocabulary.merge, self.names.__getitem__, self.vocabulary.tokens.__getitem__
        for w, r in zip(asked, ranks):
            ids = merge(w) if r < 0 else self.lexicon.flat[self.lexicon.starts[r] : self.lexicon.starts[r + 1]].tolist()
            decoded = " ".join(map(token, ids))
            out[w] = len(ids), " ".join(map(name, ids)), w if decoded == w else decoded
        return out

    def learn(self, parts: set[str]) -> None:
        """Entries of all parts of some texts."""
        split = {c: words(c) for c in self.seen.missing(parts)}
        known = self.seen.new
        alone = [c for c, ws in split.items() if len(ws) == 1 and ws[0] == c]
        known.update(self.word_entries(alone))
        for c in alone:
            del split[c]
        # Words of the other parts stand alone somewhere, or are kept apart.
        inside = {w for ws in split.values() for w in ws}.difference(known)
        more = self.inner.missing(inside)
        extra = self.inner.new
        extra.update(self.word_entries(list(more)))
        for c, ws in split.items():
            got = [known.get(w) or extra[w] for w in ws]
            known[c] = got[0] if len(got) == 1 else (sum(g[0] for g in got), " ".join([g[1] for g in got]), " ".join([g[2] for g in got]))

    def pieces(self, texts: list[str | None]) -> list[list[tuple[int, str, str]]]:
        """Entries of the parts of every text in order."""
        cut, met, special = [], set(), self.vocabulary.special
        for text in texts:
            row: list = []
            for part, is_special in self.parts(text or ""):
                row += [(part,)] if is_special else chunks(part)
            met.update(row)
            cut.append(row)
        marks = {c for c in met if c.__class__ is tuple}
        self.learn(met - marks)
        known = self.seen.new
        if marks:
            known = known | {m: self.entry([special[m[0]]]) for m in marks}
        return [list(map(known.__getitem__, row)) for row in cut]

    def rest(self) -> None:
        """Hold no parts while this worker waits for its next task."""
        self.seen, self.inner = Recent(CACHE), Recent(CACHE // 4)
        rest()

    def ids(self, texts: list[str | None]) -> list[list[int]]:
        return [[int(i) for p in row for i in p[1].split()] for row in self.pieces(texts)]

    def parts(self, text: str):
        at = 0
        for m in self.special.finditer(text) if "<" in text else ():
            yield text[at : m.start()], False
            yield m.group(), True
            at = m.end()
        yield text[at:], False

    def digests(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Number of ids, and the digests of the ids and of the text decoded from them, of every text."""
        out = []
        for row in self.pieces(texts):
            n, ids, decoded = zip(*row) if row else ((), (), ())
            if 0 in n:  # parts without ids leave no blank
                n, ids, decoded = zip(*[p for p in row if p[0]]) if any(n) else ((), (), ())
            out.append((sum(n), *(hashlib.sha256(" ".join(x).encode()).hexdigest() for x in (ids, decoded))))
        return out


def frequent_words(docs: DataFrame, size: int = LEXICON_WORDS) -> DataFrame:
    """The most frequent words of all texts; ties by the word.  Tasks count before the exchange."""
    def count(batches):
        seen: Counter = Counter()

        def flush():
            total: dict[str, int] = {}
            had = total.get
            for c, n in seen.items():
                for w in words(c):
                    total[w] = had(w, 0) + n
            seen.clear()
            return pa.RecordBatch.from_pydict({"word": pa.array(total.keys(), pa.string()), "n": pa.array(total.values(), pa.int64())})

        for batch in batches:
            for part in slices(batch, limit=SLICE):
                for text in part.column("text").to_pylist():
                    if text:
                        seen.update(chunks(text))
                    if len(seen) > 400_000:
                        yield flush()
        if seen:
            yield flush()

    return (docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "word").limit(size))


def ship_lexicon(spark: SparkSession, docs: DataFrame, vocabulary: Vocabulary, size: int = LEXICON_WORDS) -> str:
    """Compile the frequent words, write the file to the shared folder and have Spark copy it to every executor.

    Only ``size`` words reach the driver.  Returns the file's name for SparkFiles.
    """
    top = [r.word for r in frequent_words(docs, size).collect()]
    block = compile_lexicon({w: vocabulary.merge(w) for w in top})
    target = work_path(spark, "lexicon") + ".bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(block))
    out.close()
    spark.sparkContext.addFile(target)
    return target.rsplit("/", 1)[1]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str, vocabulary) -> Encoder:
    """One encoder for each worker and lexicon."""
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(vocabulary.value, Lexicon(SparkFiles.get(name)))
    return _ENCODERS[name]


def encode_documents(docs: DataFrame, tokenizer: str, size: int = LEXICON_WORDS) -> DataFrame:
    """``docs`` with the column ``ids`` of every text (an own column of that name is replaced)."""
    spark = docs.sparkSession
    vocabulary = Vocabulary(tokenizer)
    shared, name = spark.sparkContext.broadcast(vocabulary), ship_lexicon(spark, docs, vocabulary, size)
    docs = docs.drop("ids")

    def run(batches):
        coder = _encoder(name, shared)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                ids = pa.array(coder.ids(part.column("text").to_pylist()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*part.schema.names, "ids"])
        coder.rest()

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode_documents(coded: DataFrame, tokenizer: str) -> DataFrame:
    """``coded`` with the column ``decoded`` of its ``ids``; null ids give an empty text."""
    shared = coded.sparkSession.sparkContext.broadcast(Vocabulary(tokenizer))
    coded = coded.drop("decoded")

    def run(batches):
        for batch in batches:
            text = pa.array([shared.value.decode(ids or ()) for ids in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, "decoded"])

    return coded.mapInArrow(run, T.StructType([*coded.schema.fields, T.StructField("decoded", T.StringType())]))


def round_trip_digests(docs: DataFrame, tokenizer: str, size: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the text decoded from them, for every row."""
    spark = docs.sparkSession
    vocabulary = Vocabulary(tokenizer)
    shared, name = spark.sparkContext.broadcast(vocabulary), ship_lexicon(spark, docs, vocabulary, size)

    def run(batches):
        coder = _encoder(name, shared)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                n, ids, decoded = zip(*coder.digests(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        coder.rest()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
