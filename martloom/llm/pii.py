"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation, all in SQL functions.

A value is found by its shape and validated: e-mail addresses, phone numbers, IPv4 addresses, payment card
numbers (Luhn), social security numbers, ISO dates from 1900 to 2099. Cards in the groups they are printed in are
found first, at any group a number may begin with, so that a number beside another hides neither; the other formats
are looked for between them, and last cards with blanks or hyphens anywhere. A valid value is
written as a pair of numbers (l, r) below (a, b); eight rounds add a keyed hash of one to the other in turn, which permutes all
values of that format. So a pseudonym has the format of its value, two values never get one pseudonym, and equal values stay
linked across documents. A card's check digit is computed anew; an address' letters and digits move within their kinds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import ASCII_LOWER, ASCII_UPPER, named

ROUNDS = 8
KEY = "change-me"  # a deployment passes its own secret

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]*+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,24}"
IPV4 = rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])"
PHONE = (
    r"(?<![0-9A-Za-z+])(?:\+?1[ .\-]?)?(?:\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}|[0-9]{3}[ .\-][0-9]{3}[ .\-][0-9]{4}"
    r"|(?<![0-9][.,])[2-9][0-9]{2}[2-9][0-9]{6}(?![.,][0-9]))(?![0-9A-Za-z])"
)
ABROAD = r"(?<![0-9A-Za-z+])\+[1-9](?:[ .\-]?[0-9]|[ .\-]?\([0-9]\)|[ .\-]?\([0-9]|[0-9]\)){6,14}(?![0-9A-Za-z]|[.\-][0-9])"
COUNTRY = "^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"  # one digit, two, else three
SSN = r"(?<![0-9A-Za-z\-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z]|-[0-9])"
DATE = r"(?<![0-9A-Za-z\-/])(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9A-SU-Za-su-z]|[Tt][A-Za-z]|-[0-9])"
CARD = r"(?<![0-9A-Za-z])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9A-Za-z]|[ \-][0-9])"
# digits in one, and the groups of the card schemes: 4-4-4-4 and up to three more, 4-4-4-1 to 4-4-4-3, 4-4-5, 4-6-4, 4-6-5, 4-7-4, 4-5-6, 6-13
PRINTED = (
    "[0-9]{13,19}",
    *(rf"[0-9]{{4}}([ \-])[0-9]{{4}}\2[0-9]{{4}}\2[0-9]{{4}}\2[0-9]{{{n}}}" for n in (3, 2, 1)),
    r"[0-9]{4}([ \-])[0-9]{4}\2[0-9]{4}\2[0-9]{1,4}",
    r"[0-9]{4}([ \-])(?:[0-9]{4}\2[0-9]{5}|[0-9]{6}\2[0-9]{4,5}|[0-9]{7}\2[0-9]{4}|[0-9]{5}\2[0-9]{6})",
    r"[0-9]{6}[ \-][0-9]{13}",
)
MAYBE_PRINTED = r"[0-9]{13}|[0-9]{4}[ \-][0-9]{4}"  # part of each
ANY = "|".join((EMAIL, IPV4, PHONE, ABROAD, SSN, DATE))


def _shape(m: Column, pattern: str) -> Column:
    return m.rlike(f"^(?:{pattern})$")


def _prf(key: str, tag: str, turn: Column, x: Column) -> Column:
    """60 keyed pseudo-random bits."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), turn.cast("string"), x.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, tag: str) -> Column:
    """struct(l, r): a permutation of the pairs with 0 <= l < a and 0 <= r < b."""

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return named(
            l=F.when(even, F.pmod(s["l"] + _prf(key, tag, i, s["r"]) % a, a)).otherwise(s["l"]).cast("long"),
            r=F.when(even, s["r"]).otherwise(F.pmod(s["r"] + _prf(key, tag, i, s["l"]) % b, b)).cast("long"),
        )

    start = named(l=left.cast("long"), r=right.cast("long"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _pad(x: Column, width: Column | int) -> Column:
    return F.lpad(x.cast("string"), width, "0")


def _refill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced in order by ``digits``."""
    start = named(out=F.lit(""), k=F.lit(1))

    def put(s: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        return named(
            out=F.concat(s["out"], F.when(is_digit, F.substring(digits, s["k"], F.lit(1))).otherwise(c)), k=s["k"] + is_digit.cast("int")
        )

    return F.aggregate(F.split(m, ""), start, put)["out"]


def _luhn_digit(payload: Column) -> Column:
    """The check digit behind ``payload``."""
    chars = F.reverse(F.split(payload, ""))
    each = F.transform(
        chars, lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int"))
    )
    total = F.aggregate(each, F.lit(0), lambda s, x: s + x)
    return ((10 - total % 10) % 10).cast("string")


def _card(m: Column, key: str) -> Column:
    def put(d: Column) -> Column:
        n = F.length(d) - 1
        half = F.floor(n / 2).cast("int")
        a, b = F.pow(F.lit(10), half).cast("long"), F.pow(F.lit(10), n - half).cast("long")
        left, right = F.substring(d, F.lit(1), half).cast("long"), F.substring(d, half + 1, n - half).cast("long")
        return _let(
            feistel(left, right, a, b, key, "card"),
            lambda s: _let(F.concat(_pad(s["l"], half), _pad(s["r"], n - half)), lambda p: _refill(m, F.concat(p, _luhn_digit(p)))),
        )

    return F.when(F.call_function("luhn_check", _digits(m)), _let(_digits(m), put)).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    def put(d: Column) -> Column:
        ten = F.substring(d, F.length(d) - 9, F.lit(10))
        area, rest = F.substring(ten, 1, 3).cast("long"), F.substring(ten, 4, 7).cast("long")
        lead = F.substring(d, F.lit(1), F.length(d) - 10)
        # 800 * 8,000,000 numbers whose area and exchange begin with 2 to 9; of the others 200 * 10^7 by the area, 800 * 2,000,000 by the exchange
        index = F.when(area < 200, area * 10_000_000 + rest).otherwise(2_000_000_000 + (area - 200) * 2_000_000 + rest)

        def other(n: Column) -> Column:
            late = n - 2_000_000_000
            return F.when(n < 2_000_000_000, _pad(n, 10)).otherwise(
                F.concat((F.floor(late / 2_000_000) + 200).cast("string"), _pad(late % 2_000_000, 7))
            )

        assigned = _let(
            feistel(area - 200, rest - 2_000_000, F.lit(800), F.lit(8_000_000), key, "phone"),
            lambda x: F.concat((x["l"] + 200).cast("string"), (x["r"] + 2_000_000).cast("string")),
        )
        free = _let(
            feistel(F.floor(index / 60_000), index % 60_000, F.lit(60_000), F.lit(60_000), key, "phone-other"),
            lambda x: other(x["l"] * 60_000 + x["r"]),
        )
        return _refill(m, F.concat(lead, F.when((area >= 200) & (rest >= 2_000_000), assigned).otherwise(free)))

    return _let(_digits(m), put)


def _abroad(m: Column, key: str) -> Column:
    """The digits behind the country code move among all of their number."""

    def put(d: Column) -> Column:
        code = F.regexp_extract(d, COUNTRY, 1)
        n = F.length(d) - F.length(code)
        half = F.floor(n / 2).cast("int")
        own = F.substring(d, F.length(code) + 1, n)
        a, b = F.pow(F.lit(10), half).cast("long"), F.pow(F.lit(10), n - half).cast("long")
        left, right = F.substring(own, F.lit(1), half).cast("long"), F.substring(own, half + 1, n - half).cast("long")
        return _let(
            feistel(left, right, a, b, key, "abroad"), lambda x: _refill(m, F.concat(code, _pad(x["l"], half), _pad(x["r"], n - half)))
        )

    return F.when(_digits(m).rlike("^1[0-9]{10}$"), _phone(m, key)).otherwise(_let(_digits(m), put))


def _ssn(m: Column, key: str) -> Column:
    def put(d: Column) -> Column:
        area = F.substring(d, 1, 3).cast("long")
        left = area - F.when(area < 666, 1).otherwise(2)
        right = (F.substring(d, 4, 2).cast("long") - 1) * 9999 + F.substring(d, 6, 4).cast("long") - 1
        return _let(
            feistel(left, right, F.lit(898), F.lit(99 * 9999), key, "ssn"),
            lambda s: F.concat_ws(
                "-",
                _pad(s["l"] + F.when(s["l"] < 665, 1).otherwise(2), 3),
                _pad(F.floor(s["r"] / 9999) + 1, 2),
                _pad(s["r"] % 9999 + 1, 4),
            ),
        )

    return _let(_digits(m), put)


def _ipv4(m: Column, key: str) -> Column:
    def put(o: Column) -> Column:
        left, right = o[0].cast("long") * 256 + o[1].cast("long"), o[2].cast("long") * 256 + o[3].cast("long")
        return _let(
            feistel(left, right, F.lit(65536), F.lit(65536), key, "ipv4"),
            lambda s: F.concat_ws(
                ".", *(x.cast("long").cast("string") for x in (F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256))
            ),
        )

    return _let(F.split(m, r"\."), put)


def _date(m: Column, key: str) -> Column:
    """Days from 1900-01-01 to 2099-12-31: 73,049 = 17 * 4,297."""
    day = F.try_to_date(m, "yyyy-MM-dd") if hasattr(F, "try_to_date") else F.to_date(m, "yyyy-MM-dd")
    origin = F.to_date(F.lit("1900-01-01"))

    def put(n: Column) -> Column:
        return _let(
            feistel(F.floor(n / 4297), n % 4297, F.lit(17), F.lit(4297), key, "date"),
            lambda s: F.date_format(F.date_add(origin, (s["l"] * 4297 + s["r"]).cast("int")), "yyyy-MM-dd"),
        )

    return F.when(day.isNull(), m).otherwise(_let(F.datediff(day, origin), put))


def _email(m: Column, key: str) -> Column:
    """Letters and digits before the last dot move within their kind; each half is shifted by a hash of the other."""
    kinds = [(ASCII_LOWER, 26), (ASCII_UPPER, 26), ("0123456789", 10)]

    def shifted(own: Column, other: Column, turn: Column) -> Column:
        def move(c: Column, i: Column) -> Column:
            digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), turn.cast("string"), F.floor(i / 32).cast("string"), other), 256)
            by = F.conv(F.substring(digest, (i % 32 * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")
            out = c
            for letters, n in kinds:
                at = F.instr(F.lit(letters), c)
                out = F.when((at > 0) & (c != ""), F.substring(F.lit(letters), (at - 1 + by) % n + 1, F.lit(1))).otherwise(out)
            return out

        return F.concat_ws("", F.transform(F.split(own, ""), move))

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return named(l=F.when(even, shifted(s["l"], s["r"], i)).otherwise(s["l"]), r=F.when(even, s["r"]).otherwise(shifted(s["r"], s["l"], i)))

    head = F.substring_index(m, ".", -1)

    def put(own: Column) -> Column:
        half = F.floor(F.length(own) / 2).cast("int")
        start = named(l=F.substring(own, F.lit(1), half), r=F.substring(own, half + 1, F.length(own)))
        return _let(
            F.aggregate(F.sequence(F.lit(0), F.lit(3)), start, turn), lambda s: F.concat(s["l"], s["r"], F.lit("."), head)
        )

    return _let(F.substring(m, F.lit(1), F.length(m) - F.length(head) - 1), put)


def pseudonym(m: Column, key: str = KEY) -> Column:
    """The pseudonym of one found value; a value that fails validation stays."""
    return (
        F.when(F.contains(m, F.lit("@")), _email(m, key))
        .when(_shape(m, IPV4), _ipv4(m, key))
        .when(_shape(m, PHONE), _phone(m, key))
        .when(_shape(m, ABROAD), _abroad(m, key))
        .when(_shape(m, SSN), _ssn(m, key))
        .when(_shape(m, DATE), _date(m, key))
        .otherwise(_card(m, key))
    )


def _printed_cards(text: Column) -> Column:
    """The valid cards of a text in printed groups, wherever a group begins, longest first."""
    each = (F.regexp_extract_all(text, F.lit(rf"(?<![0-9A-Za-z])(?=({p})(?![0-9A-Za-z]))"), F.lit(1)) for p in PRINTED)
    digits = F.filter(F.array_distinct(F.concat(*each)), lambda m: F.length(_digits(m)).between(13, 19) & F.call_function("luhn_check", _digits(m)))
    return F.transform(F.sort_array(F.transform(digits, lambda m: named(n=F.length(m), m=m)), asc=False), lambda x: x["m"])


def _cut(parts: Column, pattern: Column, change: Callable[[Column], Column]) -> Column:
    """``parts`` (old, new) with the finds of ``pattern`` in those not yet changed as parts of their own."""

    def cut(p: Column) -> Column:
        found = F.transform(F.regexp_extract_all(p["old"], pattern, F.lit(0)), lambda m: named(old=m, new=change(m)))
        gaps = F.transform(F.split(p["old"], pattern, -1), lambda g: named(old=g, new=g))
        return F.filter(F.flatten(F.zip_with(gaps, found, lambda g, f: F.array(g, f))), lambda x: x.isNotNull())

    open_ = lambda p: (p["old"] == p["new"]) & p["old"].rlike("[0-9@]")
    return F.flatten(F.transform(parts, lambda p: F.when(open_(p), cut(p)).otherwise(F.array(p))))


def masked(text: Column, key: str = KEY) -> Column:
    """struct(text, n_values): the text with pseudonyms and how many values were replaced."""

    def card(m: Column) -> Column:
        return _card(m, key)

    def printed(p: Column) -> Column:
        literal = F.concat(F.lit("(?<![0-9A-Za-z])(?:"), F.array_join(p["cards"], "|"), F.lit(")(?![0-9A-Za-z])"))
        return F.when(F.size(p["cards"]) > 0, _cut(p["parts"], literal, card)).otherwise(p["parts"])

    whole = F.array(named(old=text, new=text))
    cards = F.when(text.rlike(MAYBE_PRINTED), _printed_cards(text)).otherwise(F.expr("cast(array() as array<string>)"))
    parts = _let(named(parts=whole, cards=cards), printed)
    parts = _cut(_cut(parts, F.lit(ANY), lambda m: pseudonym(m, key)), F.lit(CARD), card)
    report = _let(
        parts,
        lambda ps: named(
            text=F.concat_ws("", F.transform(ps, lambda p: p["new"])), n_values=F.size(F.filter(ps, lambda p: p["old"] != p["new"]))
        ),
    )
    plain = named(text=text, n_values=F.lit(0))
    return F.when(text.rlike("[0-9@]") & (text.rlike(MAYBE_PRINTED) | text.rlike(ANY) | text.rlike(CARD)), report).otherwise(plain)


def mask_documents(docs: DataFrame, key: str = KEY, column: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``column``, all other columns as they were.

    Null and empty texts stay as they are. Every row is worked on by itself: null and repeated ids, repeated rows and further
    columns of any name don't matter.
    """
    return docs.withColumn(column, masked(F.col(column), key).getField("text"))


def mask_report(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, text with pseudonyms, n_values replaced."""
    return docs.select("doc_id", masked(F.col("text"), key).alias("m")).select("doc_id", "m.text", "m.n_values")
