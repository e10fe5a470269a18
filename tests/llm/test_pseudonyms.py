"""Pseudonyms against a Feistel network in plain Python, and where the key is."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wardflow.llm import pseudonyms

CLASSES = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
HEX = ["0123456789abcdef", "0123456789ABCDEF"]


def digest(key, label, *parts):
    return hashlib.sha512("|".join([key, label, *parts]).encode()).hexdigest()


def plain_text(value, key, label, hexa=False):
    def half(text, other, n):
        d, out = digest(key, f"{label}{n}", other), ""
        for i, c in enumerate(text):
            k = i * 4 % 124
            letters = next((x for x in (HEX if hexa else CLASSES) if c in x), None)
            out += letters[(letters.index(c) + int(d[k : k + 4], 16)) % len(letters)] if letters else c
        return out

    cut = len(value) // 2
    left, right = value[:cut], value[cut:]
    for n in range(1, pseudonyms.ROUNDS // 2 + 1):
        left = half(left, f"{n}|{right}", 0)
        right = half(right, f"{n}|{left}", 1)
    return left + right


def plain_day(day, key):
    first = dt.date(1700, 1, 1)
    a, b = divmod((day - first).days, pseudonyms.B)
    for n in range(1, pseudonyms.ROUNDS // 2 + 1):
        a = (a + int(digest(key, "day-a", str(n), str(b))[:12], 16)) % pseudonyms.A
        b = (b + int(digest(key, "day-b", str(n), str(a))[:12], 16)) % pseudonyms.B
    return first + dt.timedelta(days=a * pseudonyms.B + b)


def plain_ip(value, key):
    o = [int(x) for x in value.split(".")]
    left, right = o[0] * 256 + o[1], o[2] * 256 + o[3]
    for n in range(1, pseudonyms.ROUNDS // 2 + 1):
        left = (left + int(digest(key, "ip-l", str(n), str(right))[:8], 16)) % 65536
        right = (right + int(digest(key, "ip-r", str(n), str(left))[:8], 16)) % 65536
    return ".".join(map(str, (*divmod(left, 256), *divmod(right, 256))))


def test_equal_to_a_plain_feistel_network(spark):
    random_ = random.Random(3)
    rows = []
    for _ in range(60):
        digits = lambda n: "".join(random_.choice("0123456789") for _ in range(n))
        day = dt.date(1700, 1, 1) + dt.timedelta(days=random_.randrange(146_097))
        ip = ".".join(str(random_.randrange(256)) for _ in range(4))
        name = "".join(random_.choice("abcXYZ019._") for _ in range(9)) + "q"
        secret = "".join(random_.choice(HEX[0]) for _ in range(40))
        ssn = f"{digits(3)}-{digits(2)}-{digits(4)}"
        rows.append((f"a {day.isoformat()}, b {ip}; c {name}@mail.example; d {secret} e {ssn} f {day.isoformat()}T10:00 g",
                     f"a {plain_day(day, 'key').isoformat()}, b {plain_ip(ip, 'key')}; c {plain_text(name, 'key', 'mail')}@mail.example; "
                     f"d {plain_text(secret, 'key', 'secret', True)} e {plain_text(ssn, 'key', 'ssn')} f {plain_day(day, 'key').isoformat()}T10:00 g"))
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pseudonyms.pseudonymise(df, "key").collect()}
    assert got == {i: b for i, (_, b) in enumerate(rows)}


def test_the_key_is_given_and_shown_nowhere(spark, tmp_path):
    df = spark.createDataFrame([(1, "on 2024-02-29 12/25/90 2024-02-29Tx")], "doc_id long, text string")
    with pytest.raises(TypeError):
        pseudonyms.pseudonymise(df)
    with pytest.raises(ValueError):
        pseudonyms.pseudonymise(df, "")
    out = pseudonyms.pseudonymise(df, "very-secret-key")
    assert out.first().n_replaced == 1 and out.first().text.endswith("12/25/90 2024-02-29Tx")  # stated: stays
    text = out._jdf.queryExecution().toString() + out._jdf.queryExecution().executedPlan().treeString()
    assert "very-secret-key" not in text
    assert out.first().text == pseudonyms.pseudonymise(df, "very-secret-key").first().text != pseudonyms.pseudonymise(df, "other").first().text

    assert pseudonyms.deployment_key(spark) != pseudonyms.deployment_key(spark)  # no setting: a key for this call
    (tmp_path / "key").write_text("from-a-file\n")
    spark.conf.set(pseudonyms.KEY_FILE_CONF, str(tmp_path / "key"))
    try:
        assert pseudonyms.deployment_key(spark) == "from-a-file"
        spark.conf.set(pseudonyms.KEY_CONF, "from-a-setting")
        assert pseudonyms.deployment_key(spark) == "from-a-setting"
    finally:
        spark.conf.unset(pseudonyms.KEY_CONF)
        spark.conf.unset(pseudonyms.KEY_FILE_CONF)


def test_own_columns_stay(spark):
    df = spark.createDataFrame([(1, "on 2024-02-29", 5, 7, 13)], "doc_id long, text string, n_replaced int, `a.b` int, n_chars int")
    out = pseudonyms.pseudonymise_text(df, "k")
    assert out.columns == df.columns and out.schema == df.schema
    row = out.first()
    assert row.n_replaced == 5 and row["a.b"] == 7 and row.n_chars == 13 and row.text != "on 2024-02-29"
    assert pseudonyms.pseudonymise_text(df.drop("n_replaced"), "k").columns == ["doc_id", "text", "a.b", "n_chars"]
    assert df.withColumn("n_replaced", F.lit(None).cast("int")).transform(pseudonyms.pseudonymise_text, "k").first().n_replaced is None
