"""Recall of the index at its defaults, and long words in the encoder."""

import random
import time

import numpy as np
import pytest

from wardflow.llm import multi_index, transducer_bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_long_words_equal_the_library():
    from tokenizers import Tokenizer
    library, vocabulary = Tokenizer.from_file(TOKENIZER), transducer_bpe.Vocabulary(TOKENIZER)
    random_ = random.Random(6)
    texts = ["a" * 5000, "ab" * 700, "the" * 300, "".join(random_.choice("etaoinshrdlu") for _ in range(3000)),
             "".join(chr(random_.randrange(0x4E00, 0x9FA5)) for _ in range(2000)), "ü" * 65, "x" * 64, "y" * 66]
    for t in texts:
        assert vocabulary.merge(t) == library.encode(t, add_special_tokens=False).ids
    word = "".join(chr(random_.randrange(0x4E00, 0x9FA5)) for _ in range(16_000))
    began = time.perf_counter()
    vocabulary.merge(word)
    assert time.perf_counter() - began < 1.5  # n log n; 10 s when each merge searched the whole word


def test_plain_words_need_no_pattern():
    for chunk in ["Hello", "hello,", "HELLO!", "don't", "a.b.", "x9", "9.", ",", "..", "it's.", "A", "?", "ab-", "naïve,", "<|x|>"]:
        assert transducer_bpe.words(chunk) == transducer_bpe._WORDS.findall(chunk.lower())


@pytest.mark.parametrize("n", [500, 2_000, 50_000])
def test_recall_at_the_defaults(spark, n):
    """Vectors with the spread of the given ones but no clusters, the hardest case for an index."""
    given = np.stack(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("embedding").toPandas()["embedding"].to_list())
    rng = np.random.default_rng(1)
    x = rng.multivariate_normal(given.mean(0), np.cov(given.T), n).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    every = max(20, n // 100)
    found = {}
    for r in multi_index.search(df, every=every).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    queries = list(range(0, n, every))
    assert sorted(found) == queries
    scores = x[queries] @ x.T
    scores[np.arange(len(queries)), queries] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :20]
    recall = np.mean([len(found[q] & set(b.tolist())) / 20 for q, b in zip(queries, best)])
    assert recall >= 0.9, recall
