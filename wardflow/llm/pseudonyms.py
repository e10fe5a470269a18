"""Format-preserving Feistel pseudonyms for personal numbers and dates, with DataFrame functions only.

Found and validated in every text, in one pass from left to right: e-mail addresses, IPv4 addresses, phone numbers
with a country code or in national form, calendar dates, card-like numbers (13 to 19 digits, plain or in groups of four), bank numbers
with valid form, social security numbers, and 32 to 64 digit hexadecimal secrets.  Each value is permuted by a keyed
Feistel network within its own format, so equal values stay equal across documents and different ones stay different:

* digits, letters and hexadecimal digits: two halves of the value take turns; each character moves within its class
  (digit, capital, small letter) by an amount taken from a keyed hash of the other half.  Separators stay and have
  no part in it, so a card or phone number is linked in all its spellings.
* card numbers: the last digit keeps its distance to the Luhn check digit, so valid stays valid and invalid invalid.
* dates: the day number within the 400 years from 1700 is written as a pair in Z_189 x Z_773 (189 * 773 = 146,097 days)
  and both parts are shifted in turn, so every result is a real date of that span and no date is met twice.
* IPv4: the two 16-bit halves take turns.

Phones: the country code stays.  Where its plan fixes the length, exactly that many digits are taken, else 8 to 15 in all; a
card, address, date, decimal or time after a blank is left whole.  Where the plan leaves the length open, a bare short number
after a single blank is taken as a further group.  National forms need an area code, in brackets, with a leading zero, or as 3-3-4 digits.

Dates: yyyy-MM-dd (also before a time, T10:00), yyyy/MM/dd, dd.MM.yyyy, slash dates and written months (English, German, French, Spanish, full or short).
A slash date is read day first; only where that is no real date it is read month first, and then moves among the dates
that can only be read so (days above 12).  So 03/04/2021 is 3 April, whoever wrote it.  Years of two digits are no dates here, as their
century isn't known: such text stays.

The key is a parameter and stands in no source, plan or log; ``deployment_key`` takes it from the session's settings.

``n_replaced`` is added (an own column of that name is replaced); ``pseudonymise_text`` leaves all other columns as they are.  Null text stays null.  A number that is part of a longer run of letters, digits or underscores is left alone.  Nothing
else in a text changes; repeated rows and extra columns pass through; ``n_chars`` follows the text where it exists.
"""

from __future__ import annotations

import secrets
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, packed, unpacked

#: Settings that name the key: the key itself, or a text file with it that Spark can read.
KEY_CONF, KEY_FILE_CONF = "spark.wardflow.pseudonyms.key", "spark.wardflow.pseudonyms.keyFile"
ROUNDS = 6
FIRST_DAY, A, B = "1700-01-01", 189, 773
_IP = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?!\.[0-9])"
_ISO = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}"
_EURO = r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
_GROUPED = r"[0-9]{4}(?:[ -][0-9]{4}){2,3}[ -][0-9]{1,4}"
# Between two digits of a phone; what follows a blank must not be a number of another kind.
_STEP = rf"(?:(?:\)?[./-]?\(?)|\)? \(?(?!(?:{_GROUPED}|{_IP}|{_ISO}|{_EURO}|{_SSN})(?![0-9A-Za-z_])|[0-9]+[.,:][0-9]))"
# Countries by the digits of their numbers, where the plan fixes them; a trunk zero in brackets is extra.
_LENGTHS = {10: "1|7|30|44|52|57|90|91", 9: "31|33|34|40|41|48|56|61|351|420|421", 8: "45|47|65|386"}
_FIXED = "|".join(rf"(?:{codes})[ ./-]?(?:\(0\))?(?:\)?[ ./-]?\(?[0-9]){{{n}}}(?![0-9A-Za-z_])" for n, codes in _LENGTHS.items())
_COUNTRY = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{1,3})[ ./-]?"
# Full names, then short ones, of each language; a name takes the first list that has it.
MONTHS = [x.split() for x in (
    "january february march april may june july august september october november december",
    "januar februar märz april mai juni juli august september oktober november dezember",
    "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "jan feb mar apr may jun jul aug sep oct nov dec", "jan feb mär apr mai jun jul aug sep okt nov dez",
    "janv févr mars avr mai juin juil août sept oct nov déc", "ene feb mar abr may jun jul ago sep oct nov dic",
    "jan feb mar apr may jun jul aug sept oct nov dec")]
_MONTH = "(?iu:" + "|".join(sorted({m for x in MONTHS for m in x}, key=lambda m: (-len(m), m))) + ")"
_DAY_FIRST = rf"[0-9]{{1,2}}(?:st|nd|rd|th|er|\.)?[ -](?:of |de )?{_MONTH}\.?,?[ -](?:de |del )?[0-9]{{4}}"
_MONTH_FIRST = rf"{_MONTH}\.?[ -][0-9]{{1,2}}(?:st|nd|rd|th)?,?[ -][0-9]{{4}}"
# Fixed formats, in the order in which they are tried at a place.
FORMATS = {
    "mail": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": r"[0-9a-f]{32,64}|[0-9A-F]{32,64}",
    "bank": r"[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?",
    "phone": rf"\+(?:{_FIXED})|\+[1-9](?:{_STEP}[0-9]){{7,14}}(?![.,/:-][0-9])",
    "ip": _IP,
    "iso": _ISO,
    "euro": _EURO,
    "written": rf"{_DAY_FIRST}|{_MONTH_FIRST}",
    "ssn": _SSN,
    "card": rf"{_GROUPED}|[0-9]{{13,19}}",
    "call": (rf"(?:\([0-9]{{3}}\)[ .-]?[0-9]{{3}}[ .-]?|[0-9]{{3}}-[0-9]{{3}}-|[0-9]{{3}}\.[0-9]{{3}}\.|[0-9]{{3}}[ /][0-9]{{3}}[ -])[0-9]{{4}}(?![.,/:-][0-9])"
             rf"|(?:\((?!(?:1[89]|20)[0-9]{{2}}\))[0-9]{{2,5}}\)[ ./-]?|(?![0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}(?![0-9]))0[1-9][0-9]{{0,3}}[ ./-])"
             rf"[0-9](?:{_STEP}[0-9]){{5,8}}(?![.,/:-][0-9])"),
}
# Only at the edges of a run of letters, digits and underscores; this also keeps the search linear.
# An ISO date may be followed by its time.
ANY = "(?<![0-9A-Za-z_])(?:(?:" + "|".join(FORMATS.values()) + ")(?![0-9A-Za-z_])|[0-9]{4}-[0-9]{2}-[0-9]{2}(?=T[0-9]{2}:[0-9]{2}))"


def _hash(key: str | Column, label: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key) if isinstance(key, str) else key, F.lit(label), *parts), 512)


def deployment_key(spark: SparkSession) -> str:
    """The key of this deployment, from the session's settings.

    Without one, a key of this call alone: values are then linked within one result, and nobody can turn them back.
    """
    named = spark.conf.get(KEY_CONF, None)
    if not named and (path := spark.conf.get(KEY_FILE_CONF, None)):
        named = spark.read.text(path, wholetext=True).first()[0].strip()
    return named or secrets.token_hex(32)


def _secret(spark: SparkSession, key: str) -> Column:
    """The key as a scalar subquery over one row, so that plans and event logs show a reference and never its value."""
    if not key:
        raise ValueError("a key is needed")
    return spark.createDataFrame([(key,)], "secret string").scalar()


def _amount(digest: Column, place, digits: int = 6) -> Column:
    """A number of ``digits`` hexadecimal digits of a keyed hash."""
    return F.conv(F.substring(digest, place, F.lit(digits)), 16, 10).cast("long")


def _shifted(char: Column, amount: Column, hexa: bool) -> Column:
    """A character moved within its class; others stay."""
    classes = [("0123456789abcdef", r"^[0-9a-f]$"), ("0123456789ABCDEF", r"^[0-9A-F]$")] if hexa else [
        ("0123456789", "^[0-9]$"), ("abcdefghijklmnopqrstuvwxyz", "^[a-z]$"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "^[A-Z]$")]
    out = char
    for letters, pattern in reversed(classes):
        at = F.instr(F.lit(letters), char) - 1
        out = F.when(char.rlike(pattern), F.substring(F.lit(letters), (at + amount) % len(letters) + 1, F.lit(1))).otherwise(out)
    return out


def permute_text(value: Column, key: str | Column, label: str, hexa: bool = False) -> Column:
    """Characters of a value moved within their classes; value, separators and length keep their form."""
    def half(text: Column, other: Column, n: int) -> Column:
        return let(_hash(key, f"{label}{n}", other), lambda d: F.array_join(F.transform(
            F.split(text, ""), lambda c, i: _shifted(c, _amount(d, (i * 4) % 124 + 1, 4), hexa)), ""))

    cut = F.floor(F.length(value) / 2).cast("int")
    pair = F.struct(F.substring(value, F.lit(1), cut).alias("l"), F.substring(value, cut + 1, F.length(value)).alias("r"))

    def turn(p: Column, n: Column) -> Column:
        left = half(p["l"], F.concat_ws("|", n.cast("string"), p["r"]), 0)
        return let(left, lambda x: F.struct(x.alias("l"), half(p["r"], F.concat_ws("|", n.cast("string"), x), 1).alias("r")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), pair, turn, lambda p: F.concat(p["l"], p["r"]))


def _plain(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9A-Za-z]", "")


def _laid(value: Column, fresh: Column) -> Column:
    """Characters of ``fresh`` in the places of the letters and digits of ``value``; separators stay."""
    start = F.struct(F.lit(1).alias("i"), F.lit("").alias("s"))
    return let(fresh, lambda fresh: F.aggregate(F.split(value, ""), start, lambda a, c: F.when(c.rlike("[0-9A-Za-z]"), F.struct(
        (a["i"] + 1).alias("i"), F.concat(a["s"], F.substring(fresh, a["i"], F.lit(1))).alias("s"))).otherwise(
        F.struct(a["i"].alias("i"), F.concat(a["s"], c).alias("s"))), lambda a: a["s"]))


def _luhn(payload: Column) -> Column:
    """Check digit of a run of digits."""
    turned = F.transform(F.split(F.reverse(payload), ""), lambda c, i: F.when(i % 2 == 0, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10)).otherwise(c.cast("int")))
    return (10 - F.aggregate(turned, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10) % 10


def permute_card(value: Column, key: str | Column) -> Column:
    """Digits before the last are permuted; the last keeps its distance to the check digit; groups stay."""
    digits = _plain(value)
    body, last = F.substring(digits, F.lit(1), F.length(digits) - 1), F.substring(digits, -1, 1).cast("long")
    return _laid(value, let(permute_text(body, key, "card"), lambda fresh: F.concat(
        fresh, ((last - _luhn(body) + _luhn(fresh) + 10) % 10).cast("string"))))


def permute_day(day: Column, key: str | Column) -> Column:
    """Another day of the 400 years from FIRST_DAY; a bijection of that span."""
    number = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    pair = F.struct(F.floor(number / B).cast("long").alias("a"), (number % B).alias("b"))

    def turn(p: Column, n: Column) -> Column:
        a = (p["a"] + _amount(_hash(key, "day-a", n.cast("string"), p["b"].cast("string")), F.lit(1), 12)) % A
        return let(a, lambda a: F.struct(a.alias("a"), ((p["b"] + _amount(_hash(key, "day-b", n.cast("string"), a.cast("string")), F.lit(1), 12)) % B).alias("b")))

    moved = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), pair, turn, lambda p: p["a"] * B + p["b"])
    return F.date_add(F.lit(FIRST_DAY).cast("date"), moved.cast("int"))


def permute_late_day(day: Column, key: str | Column) -> Column:
    """Another day of the span with a day of the month above 12: the permutation is followed until it meets one.

    It always comes back to the day itself; 100 steps miss with odds of 0.4 ** 100.
    """
    late = lambda d: F.dayofmonth(d) > 12
    return F.aggregate(F.sequence(F.lit(2), F.lit(100)), permute_day(day, key), lambda d, _: F.when(late(d), d).otherwise(permute_day(d, key)))


def _inside(day: Column) -> Column:
    return (day >= F.lit(FIRST_DAY).cast("date")) & (day < F.lit("2100-01-01").cast("date"))


def _date(value: Column, formats: list[tuple[str, str, str]], key: str | Column) -> Column:
    """A real date of the span is permuted and written in its own format; any other run of digits stays."""
    out = value
    for pattern, read, write in formats:
        day = F.try_to_timestamp(value, F.lit(read)).cast("date")
        month_first = read in ("MM/dd/yyyy", "M/d/yyyy")
        fits = value.rlike(pattern) & _inside(day) & (F.dayofmonth(day) > 12 if month_first else F.lit(True))
        out = F.when(fits, F.date_format(permute_late_day(day, key) if month_first else permute_day(day, key), write)).otherwise(out)
    return out


def _written(value: Column, key: str | Column) -> Column:
    """A date with a month name; language, length, case, order and marks of the name stay, an English ordinal follows its day."""
    name = F.regexp_extract(value, f"({_MONTH})", 1)
    low = F.lower(name)
    style = F.array(*[F.array(*map(F.lit, x)) for x in MONTHS])
    mine = F.filter(style, lambda x: F.array_contains(x, low))[0]
    number = F.regexp_extract(value, "(?<![0-9])([0-9]{1,2})(?![0-9])", 1)
    year = F.regexp_extract(value, "([0-9]{4})$", 1)
    day = F.try_to_timestamp(F.concat_ws("-", year, F.array_position(mine, low).cast("string"), number.cast("int").cast("string")), F.lit("y-M-d")).cast("date")

    def laid(fresh: Column) -> Column:
        n, month = F.dayofmonth(fresh), F.get(mine, F.month(fresh) - 1)
        month = F.when(name == F.upper(name), F.upper(month)).when(name == low, month).otherwise(F.initcap(month))
        count = F.when(number.startswith("0"), F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string"))
        ordinal = F.when(n.isin(11, 12, 13), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
        mark = F.regexp_extract(value, "(?<![0-9])[0-9]{1,2}(st|nd|rd|th|er|)", 1)
        mark = F.when(mark.isin("st", "nd", "rd", "th"), ordinal).when((mark == "er") & (n == 1), "er").otherwise("")
        between = lambda pattern: F.regexp_extract(value, pattern, 1)
        first = F.concat(count, mark, between(f"^[0-9]{{1,2}}(?:st|nd|rd|th|er)?(.*?){_MONTH}"), month)
        last = F.concat(month, between(f"^{_MONTH}([^0-9]*)"), count, mark)
        tail = F.when(value.rlike("^[0-9]"), between(f"{_MONTH}(.*?)[0-9]{{4}}$")).otherwise(between("[0-9](?:st|nd|rd|th)?([^0-9a-z]*)[0-9]{4}$"))
        return F.concat(F.when(value.rlike("^[0-9]"), first).otherwise(last), tail, F.date_format(fresh, "yyyy"))

    return F.when(_inside(day), let(permute_day(day, key), laid)).otherwise(value)


def _octets(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda s: s.cast("long") < 256)


def permute_ip(value: Column, key: str | Column) -> Column:
    """Four octets as two 16-bit halves."""
    o = F.transform(F.split(value, r"\."), lambda s: s.cast("long"))
    pair = F.struct((o[0] * 256 + o[1]).alias("l"), (o[2] * 256 + o[3]).alias("r"))

    def turn(p: Column, n: Column) -> Column:
        a = (p["l"] + _amount(_hash(key, "ip-l", n.cast("string"), p["r"].cast("string")), F.lit(1), 8)) % 65536
        return let(a, lambda a: F.struct(a.alias("l"), ((p["r"] + _amount(_hash(key, "ip-r", n.cast("string"), a.cast("string")), F.lit(1), 8)) % 65536).alias("r")))

    out = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), pair, turn, lambda p: F.array(
        F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256))
    return F.when(_octets(value), F.array_join(F.transform(out, lambda x: x.cast("string")), ".")).otherwise(value)


def pseudonym(value: Column, key: str | Column) -> Column:
    """Pseudonym of one match of ANY, or the match itself if it is none of the validated formats."""
    whole = lambda kind: value.rlike(f"^(?:{FORMATS[kind]})$")
    at = F.instr(value, "@")
    mail = F.concat(permute_text(F.substring(value, F.lit(1), at - 1), key, "mail"), F.substring(value, at, F.length(value)))
    prefix = F.regexp_extract(value, _COUNTRY, 0)
    local = F.substring(value, F.length(prefix) + 1, F.length(value))
    phone = F.concat(prefix, _laid(local, permute_text(_plain(local), key, "phone")))
    account = F.substring(value, F.lit(3), F.length(value))
    bank = F.concat(F.substring(value, 1, 2), _laid(account, permute_text(_plain(account), key, "bank")))
    cases = [
        (value.contains("@"), mail), (whole("secret"), permute_text(value, key, "secret", True)), (whole("bank"), bank),
        (whole("phone"), phone), (whole("ip") & _octets(value), permute_ip(value, key)),
        (whole("iso"), _date(value, [(r"^[0-9]{4}-.{5}$", "yyyy-MM-dd", "yyyy-MM-dd"), (r"^[0-9]{4}/.{5}$", "yyyy/MM/dd", "yyyy/MM/dd"),
                                     (r"^[0-9]{4}/.{3,4}$", "yyyy/M/d", "yyyy/M/d")], key)),
        (whole("euro"), _date(value, [(r"^[0-9]{2}\.[0-9]{2}\.", "dd.MM.yyyy", "dd.MM.yyyy"), (r"^[0-9]{2}/[0-9]{2}/", "dd/MM/yyyy", "dd/MM/yyyy"),
                                      (r"^([0-9]\.[0-9]{1,2}|[0-9]{2}\.[0-9])\.", "d.M.yyyy", "d.M.yyyy"),
                                      (r"^([0-9]/[0-9]{1,2}|[0-9]{2}/[0-9])/", "d/M/yyyy", "d/M/yyyy"),
                                      (r"^[0-9]{2}/[0-9]{2}/", "MM/dd/yyyy", "MM/dd/yyyy"),
                                      (r"^[0-9]/[0-9]{2}/", "M/d/yyyy", "M/d/yyyy")], key)),
        (whole("written"), _written(value, key)), (whole("ssn"), permute_text(value, key, "ssn")), (whole("card"), permute_card(value, key)),
        (whole("call"), _laid(value, permute_text(_plain(value), key, "phone"))),
    ]
    return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), reversed(cases), value)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with every validated value replaced; adds ``n_replaced``.  The same key gives the same pseudonyms.

    The text is cut at the matches and joined with their pseudonyms again, so every occurrence is replaced.
    """
    text = F.col("row.text")
    found = F.when(text.rlike(r"[0-9@]"), F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1)))
    df = packed(docs).withColumn("found", found).withColumn("secret", _secret(docs.sparkSession, key))
    df = df.withColumn("new", F.transform("found", lambda v: pseudonym(v, F.col("secret"))))
    pieces = F.zip_with(F.split(text, f"(?:{ANY})", -1), "new", lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))
    df = df.withColumn("text", F.when(F.size("found") > 0, F.array_join(F.flatten(pieces), "")).otherwise(text))
    changed = F.filter(F.zip_with("found", "new", lambda a, b: a != b), lambda x: x)
    size = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return unpacked(df, docs.columns, text=F.col("text"), **size, n_replaced=F.when(F.size("found") > 0, F.size(changed)).otherwise(0).cast("long"))


def pseudonymise_text(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` in its own shape: only the text, and ``n_chars`` with it, changes."""
    counted = pseudonymise(docs, key)
    if "n_replaced" not in docs.columns:
        return counted.drop("n_replaced")
    moved = packed(docs).select("row", F.col("row.n_replaced").alias("_n"), F.col("row.text").alias("text"))
    out = pseudonymise(moved, key)
    size = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return unpacked(out, docs.columns, text=F.col("text"), **size)
