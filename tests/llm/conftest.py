import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, gone int, h int, n int, ids string, found int, kept string, text_ string"


def long_text(n):
    return " ".join(f"w{i % 977}x{i % 31}" for i in range(n))


def edge_rows():
    """Nulls in every column, blank and long texts, ties, repeated rows."""
    base = " ".join(f"tok{i} of{i % 7}" for i in range(60))
    texts = [
        (1, base, "en", "s0"), (1, base, "en", "s0"), (2, base, None, "s0"), (3, base + " extra", "en", None), (4, None, "en", "s0"), (5, "", "de", "s1"),
        (6, " \t\n\r\x0b\x0c ", "de", "s1"), (7, "one", "fr", "s1"), (8, "a b c d", "fr", "s1"), (9, "A B C D", "fr", "s1"), (None, base, "en", "s0"), (None, None, None, None),
        (10, long_text(60_000), "en", "s2"), (11, long_text(59_990) + " tail", "en", "s2"), (12, "word\nword\nword\n" * 40, "en", "s2"),
        (13, "idiot stupid idiot. scum!", "en", "s0"), (14, "mail a.b@c.example.com 4111 1111 1111 1111 on 2024-02-29, " + base, "en", "s0"),
        (15, "é ß\x00 \U0001F600 'll don't <|endoftext|> Σίσυφος", "el", "s3"), (16, "same same " * 50, "en", "s3"),
    ]
    return [(i, t, lang, src, len(t) if t else None, "r", 1, 2, 3, "x", 4, "k", "t") for i, t, lang, src in texts]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, int(i not in (12, 16)), int(i == 13)) for i in range(1, 17)] + [(None, 1, 1), (3, None, 0), (99, 1, 0)],
                                 "doc_id long, quality int, toxic int")
