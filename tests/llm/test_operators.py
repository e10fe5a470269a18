"""Every operator on edge cases and against brute force."""

import datetime as dt
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardflow.llm import (line_rules, mixing, multi_index, ngram_join, perspectives, pseudonyms, repeats, site_quality, toxicity,
                          transducer_bpe)

from . import brute
from .conftest import edge_rows

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# --- 1: BPE
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(TOKENIZER)


def digests(tok, text):
    ids = tok.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))


def test_bpe_equals_the_library(spark, edge):
    tok = library()
    got = sorted(map(tuple, transducer_bpe.round_trip_digests(edge, TOKENIZER, 200).collect()), key=str)
    assert got == sorted(((r[0], *digests(tok, r[1])) for r in edge_rows()), key=str)


def test_bpe_fuzz():
    tok, vocabulary = library(), transducer_bpe.Vocabulary(TOKENIZER)
    coder, random_ = transducer_bpe.Encoder(vocabulary, None), random.Random(5)
    letters = list("ab 's'tS\n\x1c\x1f\x85 é́Σςİßﬁ½²Ⅷ١😀_-<|>​\x00　ǅ가각") + ["<|endoftext|>", "<|startoftext|>"]
    for _ in range(2000):
        text = "".join(random_.choice(letters) for _ in range(random_.randint(0, 30)))
        ids = tok.encode(text, add_special_tokens=False).ids
        assert coder.ids([text]) == [ids] and coder.digests([text]) == [digests(tok, text)]
        assert vocabulary.decode(ids) == tok.decode(ids, skip_special_tokens=False)


def test_transducer_is_minimal_and_exact(tmp_path):
    entries = {w: [i, i + 1] for i, w in enumerate(["", "tap", "taps", "top", "tops", "é", "zzz"])}
    path = tmp_path / "lexicon"
    path.write_bytes(transducer_bpe.compile_lexicon(entries))
    lexicon = transducer_bpe.Lexicon(str(path))
    assert {w: lexicon.ids(w) for w in entries} == entries
    assert [lexicon.ids(w) for w in ("ta", "tapss", "x", "zz")] == [None] * 4
    heads = {w.encode()[:i] for w in entries for i in range(len(w.encode()) + 1)}
    ends = {frozenset(w.encode()[len(h):] for w in entries if w.encode().startswith(h)) for h in heads}
    assert len(lexicon.first) - 1 == len(ends)  # one state for each distinct set of endings


def test_encode_then_decode(edge, none):
    coded = transducer_bpe.encode_documents(edge, TOKENIZER, 50)
    out = transducer_bpe.decode_documents(coded, TOKENIZER).collect()
    tok = library()
    assert all(r.decoded == tok.decode(tok.encode(r.text or "", add_special_tokens=False).ids, skip_special_tokens=False) for r in out)
    assert set(out[0].asDict()) == set(edge.columns) | {"decoded"}
    assert transducer_bpe.encode_documents(none, TOKENIZER).count() == 0


# --- 2: repeated passages
@pytest.mark.parametrize("group", [2_000, 2])
def test_repeats(edge, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    base = " ".join(f"p{i}" for i in range(50))
    rows = [(r[0], r[1]) for r in edge_rows()] + [(None, f"{k} {base} {k}") for k in "abc"] + [(7, f"{k} {base}") for k in "de"] + [
        (7, " ".join(f"u{i}" for i in range(60))), (None, " ".join(f"v{i}" for i in range(60))), (20, base)]
    want = brute.repeats(rows)
    more = edge.select("doc_id", "text").unionByName(edge.sparkSession.createDataFrame(rows[len(edge_rows()):], "doc_id long, text string"))
    got = repeats.remove_repeats(more, with_text=True).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == sorted(((i, *want[i, t]) for i, t in rows), key=str)
    assert want[7, rows[-3][1]][1] == want[None, rows[-2][1]][1] == 0  # texts that repeat nowhere keep their words
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_repeats_of_nothing(none):
    assert repeats.remove_repeats(none).count() == 0


# --- 4: line rules
def test_line_rules_edges(edge, none):
    out = {(r.doc_id, r.n_words): r for r in line_rules.line_verdicts(edge, min_docs=1).collect()}
    assert out[4, 0].base_failed and out[5, 0].word_chars == 0 and not out[6, 0].kept
    assert out[12, 120].n_dup_lines == 119 and out[12, 120].n_repeat_words == 120
    assert line_rules.line_verdicts(edge).count() == len(edge_rows()) and line_rules.line_verdicts(none).count() == 0
    assert line_rules.clean_documents(none).columns == none.columns


def test_frequent_lines_go_but_their_first_document_keeps_them(spark):
    letters = lambda n: "".join("abcdefghij"[int(c)] for c in str(n))
    own = lambda i: "\n".join("own line " + " ".join(f"q{letters(i)}w{letters(k)}z{letters(j)}" for j in range(10)) for k in range(6))
    rows = [(i, own(i) + "\nCopyright  2021 all rights", "h") for i in range(30)] + [(i, "\n".join(" ".join(f"m{letters(k)}{c}" for c in "abcdefgh") for k in range(9)), "h") for i in range(30, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text").cast("long"))
    kept = {r.doc_id: r for r in line_rules.clean_documents(docs).collect()}
    assert sorted(kept) == list(range(31))  # documents of nothing but shared lines go, all but the first
    assert "Copyright" in kept[0].text and all("Copyright" not in kept[i].text for i in range(1, 30))
    assert all(r.n_chars == len(r.text) for r in kept.values())


def test_texts_without_or_under_one_id_are_judged_apart(spark):
    """A null-id row that fails goes although another passes; lines are counted by text and leave only the documents that lose them."""
    letters = lambda n: "".join("abcdefghij"[int(c)] for c in str(n))
    own = lambda i: "\n".join("own line " + " ".join(f"q{letters(i)}w{letters(k)}z{letters(j)}" for j in range(10)) for k in range(6))
    shared, rows = "the line that all of them share", []
    for i in range(30):
        rows.append((None if i % 3 == 0 else 7 if i % 3 == 1 else 100 + i, own(i) + "\n" + shared, "h"))
    rows += [(None, "two words", "h"), (7, "two words", "h"), rows[0], (5, own(99), "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = [(r.doc_id, r.text) for r in line_rules.clean_documents(docs).collect()]
    assert len(out) == 32 and "two words" not in {t for _, t in out}
    keepers = {(i, t) for i, t in out if shared in t}
    first = min((hashlib.md5(t.encode()).digest(), t) for i, t, _ in rows[:30] if i == 7)[1]
    assert keepers == {(7, first)}  # smallest id, then smallest hash of the text
    assert sorted(t.replace("\n" + shared, "") for _, t in out) == sorted(t.replace("\n" + shared, "") for _, t, _ in rows if t != "two words")


def test_line_limit_does_not_grow_with_the_host(spark):
    letters = lambda n: "".join("abcdefghij"[int(c)] for c in str(n))
    own = lambda i: " ".join(f"q{letters(i)}z{letters(j)}" for j in range(60))
    common = "\n".join(" ".join(f"m{letters(k)}{c}" for c in "abcdefgh") for k in range(9))
    rows = [(i, own(i) + "\nshared by a few", "h") for i in range(25)] + [(i, own(i), "h") for i in range(25, 975)] + [(i, common, "h") for i in range(975, 1000)]
    kept = {r.doc_id: r.text for r in line_rules.clean_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert sorted(kept) == list(range(976))  # 25 of 1,000 documents are under 5 % and above 20
    assert [i for i, t in kept.items() if "shared" in t] == [0]


# --- 5: perspectives
def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hé"), (1, 2, "bob", "yo"), (1, 2, "bob", "yo"), (1, None, None, None), (2, 0, "system", "alone"),
            (None, 600, "ann", "late"), (None, 1, "bob", "early")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("speaker", F.lit("clash"))
    out = {(r.conv_id, r.part, r.speaker): r for r in perspectives.rotate(df).collect()}
    assert set(out) == {(1, 0, s) for s in ("ann", "bob", "unknown")} | {(None, p, s) for p in (0, 1) for s in ("ann", "bob")}
    for r in out.values():
        own = [m.content for m in r.messages if m.role == "assistant"]
        assert [r.rendered[s.start : s.end] for s in r.mask] == own and r.n_own == len(own)
        assert all(m.name not in (None, r.speaker) for m in r.messages if m.role == "user")
    assert out[1, 0, "ann"].rendered == "<|user name=unknown|>\n\n<|system|>\nbe kind\n<|assistant|>\nhé\n<|user name=bob|>\nyo\n"
    assert perspectives.rotate(df.limit(0)).count() == 0


def test_no_part_holds_more_rows_than_turns(spark):
    rows = [(c, t, f"r{i % 2}", f"text {i}") for c in (1, None) for i in range(25) for t in (0, 1)] + [(1, 11, "r0", "end"), (1, 30, "r1", "last"), (2, 9, "r0", "x"), (2, 10, "r1", "y")]
    rows += [(3, None, None, f"t{i}") for i in range(23)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    out = perspectives.rotate(df, 10).collect()
    assert max(r.n_turns for r in out) == 10 and len({(r.conv_id, r.part, r.speaker) for r in out}) == len(out)
    for conv, speaker in {(r.conv_id, r.speaker) for r in out}:
        mine = sorted((r for r in out if (r.conv_id, r.speaker) == (conv, speaker)), key=lambda r: r.part)
        want = sorted((-1 if t is None else t, role or "unknown", text) for c, t, role, text in rows if c == conv)
        assert [m.content for r in mine for m in r.messages] == [x[2] for x in want]
        assert [[r.rendered[s.start : s.end] for s in r.mask] for r in mine] == [[m.content for m in r.messages if m.role == "assistant"] for r in mine]
    assert sorted({(r.conv_id, r.part) for r in out if r.conv_id in (1, 2)}) == [(1, 0), (1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (1, 7), (2, 0), (2, 1)]


# --- 6: multi-index
def brute_nearest(vectors, every, k):
    good = {i: np.array(v) for i, v in vectors if v is not None and len(v) == 4 and None not in v and np.isfinite(v).all() and np.any(v)}
    return {q: sorted(((-float((good[q] * v).sum()), i) for i, v in good.items() if i != q))[:k] for q in good if q % every == 0}


def test_multi_index_scans_all_of_a_small_table(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).round(3).tolist()) for i in range(90)] + [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(90, 130)]
    rows += [(200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan")] * 4), (204, [1.0]), (220, [float("inf"), 0.0, 0.0, 0.0]), (60, rows[60][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, cell int")
    got = {}
    for r in multi_index.search(df, k=7).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute_nearest(dict(rows).items(), 20, 7)
    assert {q: [(i, v, s) for i, (_, v, s) in enumerate(sorted(x), 1)] for q, x in got.items()} == {q: [(i, v, -s) for i, (s, v) in enumerate(x, 1)] for q, x in want.items()}
    assert multi_index.search(df.limit(0)).count() == 0


def test_multi_index_recall(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in multi_index.search(df, least=500).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 3000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert hits / (150 * 20) >= 0.9


def test_cells_come_by_decreasing_sum():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=9), rng.normal(size=7)
    filled = rng.integers(0, 3, 63)
    order = [int(c) for c in np.argsort(-(a[:, None] + b[None]).ravel(), kind="stable") if filled[c]]
    assert multi_index.cells_by_sum(a, b, filled, 10**9) == order
    some = multi_index.cells_by_sum(a, b, filled, 20)
    assert some == order[: len(some)] and filled[some].sum() >= 20 > filled[some[:-1]].sum()


# --- 7: pseudonyms
def test_pseudonyms(spark, edge, none):
    text = ("x 4111 1111 1111 1111, 4111111111111111 9807915762804490 a12345678901234567 12345678901234567890123 und.34@mail7.example.com "
            "+1 (017) 555-7713 97.51.17.173 999.1.1.1 2024-02-29 31.12.1999 2024-13-01 v4.0 3. 123-45-6789 GB82 WEST 1234 5698 7654 32")
    df = spark.createDataFrame([(1, text), (2, "again und.34@mail7.example.com"), (3, None), (4, "")], "doc_id long, text string")
    out = {r.doc_id: r for r in pseudonyms.pseudonymise(df, "k").collect()}
    new = out[1].text
    assert out[1].n_replaced == 10 and out[3].text is None and out[4].text == ""
    for gone in ("4111", "9807915762804490", "und.34", "555-7713", "97.51.17.173", "2024-02-29", "31.12.1999", "123-45-6789", "WEST 1234"):
        assert gone not in new
    for stays in (" a12345678901234567 ", " 12345678901234567890123 ", "@mail7.example.com", "+1 (", " 999.1.1.1 ", "2024-13-01 v4.0 3."):
        assert stays in new
    assert len(new) - len(text) == len(new.split("999.1.1.1")[0].split()[-1]) - len("97.51.17.173")
    assert new[2:21].replace(" ", "") == new[23:39] and luhn(new[23:39]) and not luhn(new[40:56])
    assert out[2].text.split()[1] in new
    rows = pseudonyms.pseudonymise(edge, "k")
    assert rows.columns == [*edge.columns, "n_replaced"] and rows.count() == len(edge_rows())
    assert all(r.text == dict((x[0], x[1]) for x in edge_rows())[r.doc_id] for r in rows.where("doc_id not in (14)").collect())
    assert pseudonyms.pseudonymise(none, "k").count() == 0


def replaced(spark, values, after="."):
    df = spark.createDataFrame([(i, f"x {v}{after}") for i, v in enumerate(values)], "doc_id long, text string")
    return [(r.text, r.n_replaced) for r in pseudonyms.pseudonymise(df, "k").orderBy("doc_id").collect()]


PHONES = ["+41 44 668 18 00", "+49 30 12 34 56 78", "+34 612 34 56 78", "+34 91 123 45 67", "+33 6 12 34 56 78", "+33.6.12.34.56.78", "+41446681800",
          "+1 (017) 555-7713", "+44 (0)20 7946 0958", "(555) 123-4567", "555-123-4567", "555.123.4567", "044 668 18 00", "044.668.18.00", "06 12 34 56 78", "(030) 12345678"]


@pytest.mark.parametrize("after,n", [(".", 0), (" 97.51.17.173 y", 1), (" 2024-02-29 y", 1), (" 4111 1111 1111 1111 y", 1), (" 123-45-6789 y", 1), (" 3.14 y", 0)])
def test_phone_spellings(spark, after, n):
    for v, (text, count) in zip(PHONES, replaced(spark, PHONES, after)):
        assert count == 1 + n and v not in text and [c if not c.isdigit() else "0" for c in text[2 : 2 + len(v)]] == [c if not c.isdigit() else "0" for c in v], v
        assert n or text.endswith(after)


def test_date_spellings(spark):
    forms = {"12/25/1990": "%m/%d/%Y", "07/15/2024": "%m/%d/%Y", "25/12/1990": "%d/%m/%Y", "2024/07/15": "%Y/%m/%d", "25 December 1990": "%d %B %Y",
             "December 25, 1990": "%B %d, %Y", "25 dec 1990": "%d %b %Y", "DEC. 25, 1990": "%b. %d, %Y"}
    for (v, form), (text, n) in zip(forms.items(), replaced(spark, list(forms))):
        assert n == 1 and v not in text and 1700 <= dt.datetime.strptime(text[2:-1], form).year < 2100
    values = ["7/15/2024", "25th of December 1990", "3. März 1999", "1er août 2001", "25 de diciembre de 1990", "May 3rd 2001", "31 février 1999", "13/13/1999", "2024/13/01"]
    out = replaced(spark, values)
    assert [n for _, n in out] == [1] * 6 + [0] * 3 and [t for t, _ in out[6:]] == [f"x {v}." for v in values[6:]]
    month, day, _ = out[0][0][2:-1].split("/")
    assert int(month) <= 12 < int(day)
    assert " of " in out[1][0] and ". " in out[2][0] and out[4][0].count(" de ") == 2


def test_month_first_dates_are_permuted(spark):
    days = spark.range(0, 146_097, 9, 8).select(F.date_add(F.lit(pseudonyms.FIRST_DAY).cast("date"), F.col("id").cast("int")).alias("d")).where("day(d) > 12")
    r = days.select(pseudonyms.permute_late_day(F.col("d"), "k").alias("n")).agg(F.count_distinct("n"), F.count("n"), F.min(F.dayofmonth("n"))).first()
    assert r[0] == r[1] and r[2] == 13


def test_other_digits_are_no_phones(spark):
    same = ["(2019) 45 123-130", "01-02-2024", "999.1.1.1", "1,234,567.89", "12345", "v1.2.3", "+12 34", "+1 2 3 4"]
    assert replaced(spark, same) == [(f"x {v}.", 0) for v in same]
    assert [t[:5] + t[-10:] for t, _ in replaced(spark, ["+41 44 668 18 00", "+1 555 123 4567"], " 25 items.")] == ["x +41 25 items.", "x +1  25 items."]
    a, b = (t[5:-1].replace(" ", "") for t, _ in replaced(spark, ["+41 44 668 18 00", "+41446681800"]))
    assert a == b


def luhn(number):
    digits = [int(c) for c in number[::-1]]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_days_are_permuted(spark):
    days = spark.range(0, 146_097, 1, 8).select(F.date_add(F.lit(pseudonyms.FIRST_DAY).cast("date"), F.col("id").cast("int")).alias("d"))
    new = days.select(pseudonyms.permute_day(F.col("d"), "k").alias("d"))
    r = new.agg(F.count_distinct("d"), F.min("d"), F.max("d")).first()
    assert tuple(r) == (146_097, dt.date(1700, 1, 1), dt.date(2099, 12, 31))


def test_digits_are_permuted(spark):
    for width in (3, 4):
        r = spark.range(10**width).select(pseudonyms.permute_text(F.lpad(F.col("id").cast("string"), width, "0"), "k", "t").alias("v")).agg(F.count_distinct("v")).first()
        assert r[0] == 10**width


# --- 8: toxicity
def toxic_docs(spark, n=240):
    rng = random.Random(2)
    line = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"]) for _ in range(9)) + "."
    rows = []
    for i in range(n):
        lines = [line() for _ in range(6)]
        if i % 4 == 0:
            lines[i % 6] = f"you {rng.choice(['idiot', 'moron'])} beta."
        rows.append((i, "\n".join(lines), int(i % 4 == 0), i % 6))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, at int")


def test_toxicity_learns_from_documents_and_finds_the_sentence(spark):
    docs = toxic_docs(spark)
    model = toxicity.train(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    out = toxicity.score_documents(docs, model).join(docs, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert held and all(r.predicted == r.toxic for r in held)
    assert all(r.worst_sentence == r["at"] for r in held if r.toxic)


def test_toxicity_never_learns_held_out_labels(spark):
    docs = toxic_docs(spark)
    flipped = docs.select("doc_id", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic"))
    a, b = (toxicity.train(docs.drop("toxic"), x) for x in (docs.select("doc_id", "toxic"), flipped))
    assert (a.w == b.w).all() and a.b == b.b


def test_toxicity_edges(edge, none, labels):
    out = toxicity.score_documents(edge, toxicity.train(edge, labels)).collect()
    assert len(out) == len(edge_rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert {r.worst_sentence for r in out if r.doc_id in (4, 5, 6)} == {-1}
    model = toxicity.train(none, labels.limit(0))
    assert {r.predicted for r in toxicity.score_documents(edge, model).collect()} == {0}


# --- 9: n-gram join
@pytest.mark.parametrize("small,block", [(32, 1_024), (1, 2)])
def test_ngram_join(spark, edge, none, monkeypatch, small, block):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(7)
    base = [f"v{i}" for i in range(40)]
    rows = [(r[0], r[1]) for r in edge_rows()]
    for i in range(100, 160):  # near copies around the threshold
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(40)] = f"x{rng.randrange(6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in ngram_join.near_duplicates(df).collect()), key=str)
    assert got == brute.components(rows)
    assert ngram_join.near_duplicates(none).count() == 0


def test_first_of_each(edge):
    out = ngram_join.first_of_each(edge)
    assert out.columns == edge.columns
    assert {r.doc_id for r in out.select("doc_id").collect()} >= {4, 5, 6, 7, 8, 10, 12, 13} and 3 not in {r.doc_id for r in out.collect()}


def test_rows_without_doc_id_stay_apart(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcdef"}
    rows = [(1, texts["a"]), (5, texts["b"]), (None, texts["a"] + " x"), (None, texts["b"] + " x"), (None, texts["b"] + " y"), (None, texts["c"]), (None, texts["d"]),
            (None, texts["d"]), (None, texts["d"] + " x"), (7, texts["e"]), (7, texts["f"]), (8, texts["f"] + " x"), (None, ""), (None, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted((tuple(r) for r in ngram_join.near_duplicates(df).collect()), key=str) == brute.components(rows)
    out = [tuple(r) for r in ngram_join.first_of_each(df).collect()]
    both = [x for x in out if x[1] and x[1].startswith("d0")]
    assert len(both) == 1 and sorted((x for x in out if x not in both), key=str) == sorted(
        [(1, texts["a"]), (5, texts["b"]), (None, texts["c"]), (7, texts["e"]), (7, texts["f"]), (None, ""), (None, None), (9, "")], key=str)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 200), (200, 300), (5, 5)], "a long, b long")
    got = {r.c: r.comp for r in ngram_join.components(links).collect()}
    assert got == {i: 0 for i in range(1, 51)} | {200: 100, 300: 100}


# --- 10: site quality
def test_site_quality(spark, edge, none, labels):
    out = site_quality.classify(edge, labels).collect()
    assert len(out) == len(edge_rows()) and all(0 <= r.posterior <= 1 and r.kept == (r.posterior >= 0.5) for r in out)
    assert site_quality.classify(none, labels).count() == 0
    assert {r.p for r in site_quality.classify(edge, labels.limit(0)).collect()} == {0.5}


def test_sparse_sites_shrink(spark):
    rows = [("a", "x", 0.9)] * 400 + [("b", "x", 0.2)] * 400 + [("c", "x", 0.2)] + [("d", "x", 0.6)] * 300
    sites = {r["_h"]: r.host_posterior for r in site_quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    assert abs(sites["b"] - 0.2) < 0.02 and sites["c"] > sites["b"] + 0.05


def test_only_document_of_a_host_leaves_itself_out(spark):
    rows = [("a", "x", 0.9)] * 40 + [("b", "x", 0.2)] * 40 + [("c", "x", 0.05), ("d", "x", 0.95)]
    out = {r.host: r for r in site_quality.with_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect() if r.host in "cd"}
    prior = sum(p for *_, p in rows) / len(rows)
    assert all(abs(r.host_posterior - prior) < 1e-9 and abs(r.path_posterior - prior) < 1e-9 for r in out.values())


# --- 3: mixing
def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(n), rng.dirichlet([3, 1, 1, 1]).tolist()) for i, n in enumerate(rng.integers(1, 500, 400))]
    df = spark.createDataFrame(rows, "doc_id long, tokens long, p array<double>")
    goal = (0.55, 0.2, 0.15, 0.1)
    steps = mixing.fit_rates(df, goal)
    out = df.withColumn("rate", mixing.rate(F.col("p"), F.col("tokens"), steps)).collect()
    got = sum(r.rate * r.tokens * np.array(r.p) for r in out)
    assert min(r.rate for r in out) >= 0 and np.allclose(got / sum(n for _, n, _ in rows), goal, atol=1e-3)


def test_mix(edge, none, labels):
    out = mixing.mix(edge, labels)
    rates = mixing.document_rates(edge, labels).collect()
    assert out.columns == edge.columns and out.count() == sum(r.copies for r in rates)
    assert all(r.rate == 1 and r.copies == 1 for r in rates if r.n_tokens == 0)
    assert mixing.mix(none, labels).count() == 0 and mixing.mix(edge, labels.limit(0)).count() == len(edge_rows())
