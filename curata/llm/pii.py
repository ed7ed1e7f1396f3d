"""Operator 4, personal data: format-preserving Feistel pseudonyms.

Validated values found in a text are replaced by the image of a keyed permutation of
their own format, so that equal values get equal pseudonyms in every document and no
value keeps its meaning:

* payment cards (13 to 19 digits, Luhn-valid, with or without blanks or hyphens): all
  digits but the last are permuted and the check digit is made right again.  Among other
  digits the longest valid stretch of whole groups counts;
* phone numbers ``(ddd) ddd-dddd``, ``ddd-ddd-dddd`` and ``ddd.ddd.dddd``, with or without a leading 1, and
  ``+1 ddd ddd dddd``: numbers with a valid area and exchange code stay valid, others permute their ten digits;
* social security numbers ``ddd-dd-dddd`` that are valid stay valid;
* IPv4 addresses; dates ``yyyy-mm-dd``, ``yyyy/mm/dd`` and ``m/d/yyyy`` from 1900-01-01 to 2099-08-04
  (the permuted days); local parts of e-mail addresses (letters to letters of the same
  case, digits to digits, other signs as they are, the domain stays).

A value that fails its check (no Luhn sum, no such day) is left alone.  The
permutation is an alternating Feistel network over Z_a x Z_b with a keyed SHA-256
round function, exact on its domain without any cycle walking, so a value has one pseudonym
wherever it stands.  A pseudonym among other digits may happen to make another stretch
Luhn-valid; so the stretch of each replaced value is returned as a mark, and ``reveal_text`` runs
the rounds backwards on the marked stretches.  Only DataFrame expressions are used.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

ROUNDS = 5  # double rounds: each permutes both halves
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
EMAIL = r"(?<![\w.%+-])[\w.%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IPV4 = rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)"
PHONE = (r"(?:(?<![\w+])\+?1[ .-]?)?(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\w)|(?<![\w+-])\+?1[ .-]\d{3}-\d{3}-\d{4}(?![\w-])"
         r"|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\w-])|(?:(?<![\w+.-])\+?1[ .-])?(?<![\w+-])(?<!\d\.)\d{3}\.\d{3}\.\d{4}(?![\w-]|\.\d)"
         r"|(?<![\w+])\+1 \d{3} \d{3} \d{4}(?![\w-]| \d)")
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
ISO_DATE = r"(?:(?<![\w-])\d{4}-\d{2}-\d{2}(?:(?=T\d)|(?![\w-]))|(?<![\w/])\d{4}/\d{2}/\d{2}(?![\w/]))"
US_DATE = r"(?<![\w/])\d{1,2}/\d{1,2}/\d{4}(?![\w/])"
_PRINTED = r"(?:\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{4,5})"  # as printed on cards
_OTHER = "|".join([IPV4, PHONE, SSN, ISO_DATE, US_DATE, r"(?:" + _PRINTED + r"|\d{14,19})(?!\w)"])
# unbroken, printed form with a short group after it, any other grouping; none goes on into another value
CARD = (rf"(?<![\w.])(?<![\w.]-)(?:\d{{14,19}}(?![\w-])|{_PRINTED}(?:[ -](?!{_OTHER})\d{{1,3}})?(?![\w-])"
        rf"|\d(?:(?:[ -](?!{_OTHER}))?\d){{12,18}}(?![\w-]))")
ANY = "|".join([EMAIL, IPV4, PHONE, SSN, ISO_DATE, US_DATE, CARD])
KINDS = ["email", "ipv4", "phone", "ssn", "iso_date", "us_date", "card"]
FIRST_DAY, SIDE = "1900-01-01", 270  # 270 * 270 days


def _long(c: Column) -> Column:
    return c.cast("long")


def _keyed(key: str, tag: str, r: Column, half: Column) -> Column:
    """Hex digest of the round function's input, keyed inside and outside."""
    return F.sha2(F.concat(F.lit(f"{key}|{tag}|"), F.sha2(F.concat(F.lit(f"{tag}|{key}|"), r.cast("string"), F.lit("|"),
                                                               half.cast("string")), 256)), 256)


def feistel(x: Column, y: Column, a: Column, b: Column, key: str, tag: str, reveal: bool = False) -> Column:
    """Struct (x, y): the keyed permutation of Z_a x Z_b (``reveal``: its inverse)."""
    def number(r: Column, half: Column) -> Column:
        return _long(F.conv(F.substring(_keyed(key, tag, r, half), 1, 14), 16, 10))

    def forth(acc: Column, r: Column) -> Column:
        return let(F.pmod(acc["x"] + number(r, acc["y"]), a), lambda x1: F.struct(
            x1.alias("x"), F.pmod(acc["y"] + number(-r, x1), b).alias("y")))

    def back(acc: Column, r: Column) -> Column:
        return let(F.pmod(acc["y"] - number(-r, acc["x"]), b), lambda y1: F.struct(
            F.pmod(acc["x"] - number(r, y1), a).alias("x"), y1.alias("y")))

    rounds = F.sequence(F.lit(ROUNDS), F.lit(1)) if reveal else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, F.struct(_long(x).alias("x"), _long(y).alias("y")), back if reveal else forth)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order."""
    return F.aggregate(
        F.sequence(F.lit(1), F.length(shape)), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")),
        lambda acc, i: let(F.substring(shape, i, F.lit(1)), lambda c: F.when(
            c.rlike("[0-9]"), F.struct(F.concat(acc["out"], F.substring(digits, acc["k"], F.lit(1))).alias("out"),
                                       (acc["k"] + 1).alias("k")))
            .otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["k"].alias("k")))),
        lambda acc: acc["out"])


def _two_parts(n: Column, b: int) -> tuple[Column, Column]:
    return F.floor(n / b), F.pmod(n, F.lit(b))


def _luhn_digit(payload: Column) -> Column:
    """Check digit that makes payload + digit Luhn-valid."""
    n = F.length(payload)
    total = F.aggregate(
        F.sequence(F.lit(1), n), F.lit(0),
        lambda acc, i: acc + let(F.substring(payload, n - i + 1, F.lit(1)).cast("int"), lambda d: F.when(
            i % 2 == 0, d).when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)))
    return F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string")


def _permute_digits(d: Column, key: str, tag: str, reveal: bool) -> Column:
    """Any run of 2 to 18 digits to another of its length."""
    left, n = F.floor(F.length(d) / 2).cast("int"), F.length(d)
    return let(feistel(_long(F.substring(d, F.lit(1), left)), _long(F.substring(d, left + 1, n)),
                       _long(F.pow(F.lit(10), left)), _long(F.pow(F.lit(10), n - left)), key, tag, reveal),
               lambda p: F.concat(F.lpad(p["x"].cast("string"), left, "0"),
                                  F.lpad(p["y"].cast("string"), n - left, "0")))


def _stretch(m: Column) -> Column:
    """Struct (lead, length): the longest, then first, Luhn-valid stretch of whole groups of ``m``; no such: zeros."""
    def valid(x: Column) -> Column:
        return _luhn_digit(F.substring(x, F.lit(1), F.length(x) - 1)) == F.substring(x, F.length(x), F.lit(1))

    # digits before each group and in all; a stretch from group i up to group j has j - i - 1 signs inside
    cuts = F.aggregate(F.split(m, "[ -]"), F.array(F.lit(0)),
                       lambda acc, g: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(g))))
    stretches = let(cuts, lambda c: F.array_sort(F.filter(F.flatten(F.transform(c, lambda a, i: F.transform(
        c, lambda b, j: F.struct((a - b).alias("less"), a.alias("at"), (a + i).alias("lead"),
                                 (b - a + j - i - 1).alias("length"))))), lambda w: w["less"].between(-19, -13))))
    hit = let(_digits(m), lambda d: F.get(F.filter(stretches, lambda w: valid(
        F.substring(d, w["at"] + 1, -w["less"]))), F.lit(0)))
    return let(hit, lambda w: F.struct(F.coalesce(w["lead"], F.lit(0)).alias("lead"),
                                       F.coalesce(w["length"], F.lit(0)).alias("length")))


def _card(m: Column, mark: Column, key: str, reveal: bool) -> Column:
    """``m`` with the marked stretch replaced."""
    def other(card: Column) -> Column:
        return let(_permute_digits(F.substring(card, F.lit(1), F.length(card) - 1), key, "card", reveal),
                   lambda p: F.concat(p, _luhn_digit(p)))
    lead, length = mark["lead"], mark["length"]
    return F.when(length == 0, m).otherwise(F.concat(
        F.substring(m, F.lit(1), lead),
        let(F.substring(m, lead + 1, length), lambda c: _refill(c, let(_digits(c), other))),
        F.substring(m, lead + length + 1, F.length(m))))


def _phone(m: Column, key: str, reveal: bool) -> Column:
    def ten(d: Column) -> Column:
        area, exchange, line = (_long(F.substring(d, at, n)) for at, n in ((1, 3), (4, 3), (7, 4)))
        index = ((area - 200) * 800 + (exchange - 200)) * 10000 + line
        x, y = _two_parts(index, 80000)
        valid = let(feistel(x, y, F.lit(80000), F.lit(80000), key, "phone", reveal),
                    lambda p: let(p["x"] * 80000 + p["y"], lambda i: F.concat(
                        (F.floor(i / 8000000) + 200).cast("string"),
                        (F.pmod(F.floor(i / 10000), F.lit(800)) + 200).cast("string"),
                        F.lpad(F.pmod(i, F.lit(10000)).cast("string"), 4, "0"))))
        return F.when((area >= 200) & (exchange >= 200), valid).otherwise(_permute_digits(d, key, "digits", reveal))
    return let(_digits(m), lambda d: _refill(m, F.concat(
        F.substring(d, F.lit(1), F.length(d) - 10), let(F.substring(d, F.length(d) - 9, F.lit(10)), ten))))


def _ssn(m: Column, key: str, reveal: bool) -> Column:
    def nine(d: Column) -> Column:
        area, group, serial = (_long(F.substring(d, at, n)) for at, n in ((1, 3), (4, 2), (6, 4)))
        sound = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        rank = F.when(area > 666, area - 2).otherwise(area - 1)

        def text(p: Column) -> Column:
            r = F.floor(p["x"] / 99)
            return F.concat(F.lpad(F.when(r >= 665, r + 2).otherwise(r + 1).cast("string"), 3, "0"), F.lit("-"),
                            F.lpad((F.pmod(p["x"], F.lit(99)) + 1).cast("string"), 2, "0"), F.lit("-"),
                            F.lpad((p["y"] + 1).cast("string"), 4, "0"))
        return F.when(sound, let(feistel(rank * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn",
                                         reveal), text)).otherwise(m)
    return let(_digits(m), nine)


def _ipv4(m: Column, key: str, reveal: bool) -> Column:
    def address(o: Column) -> Column:
        part = [_long(F.get(o, F.lit(i))) for i in range(4)]
        return let(feistel(part[0] * 256 + part[1], part[2] * 256 + part[3], F.lit(65536), F.lit(65536), key, "ipv4",
                           reveal),
                   lambda p: F.concat_ws(".", F.floor(p["x"] / 256), p["x"] % 256, F.floor(p["y"] / 256), p["y"] % 256))
    return let(F.split(m, "[.]"), address)


def _other_day(day: Column, key: str, reveal: bool) -> Column:
    """Another day of the domain; null outside it."""
    n = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    x, y = _two_parts(n, SIDE)
    return F.when(n.between(0, SIDE * SIDE - 1), let(
        feistel(x, y, F.lit(SIDE), F.lit(SIDE), key, "date", reveal),
        lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["x"] * SIDE + p["y"]).cast("int"))))


def _iso_date(m: Column, key: str, reveal: bool) -> Column:
    day = _other_day(F.translate(m, "/", "-").try_cast("date"), key, reveal).cast("string")
    return F.coalesce(F.when(m.contains("/"), F.translate(day, "-", "/")).otherwise(day), m)


def _us_date(m: Column, key: str, reveal: bool) -> Column:
    def parts(p: Column) -> Column:
        month, day = F.get(p, F.lit(0)), F.get(p, F.lit(1))
        iso = F.concat_ws("-", F.get(p, F.lit(2)), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
        pad = (F.length(month) == 2) & (F.length(day) == 2)
        return let(_other_day(iso.try_cast("date"), key, reveal), lambda d: F.coalesce(
            F.when(pad, F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "M/d/yyyy")), m))
    return let(F.split(m, "/"), parts)


def _shift(s: Column, hexes: Column, reveal: bool) -> Column:
    """Each letter or digit of ``s`` moved within its class by a keyed amount."""
    def one(i: Column) -> Column:
        c = F.substring(s, i, F.lit(1))
        step = _long(F.conv(F.substring(hexes, F.pmod((i - 1) * 3, F.lit(60)) + 1, F.lit(3)), 16, 10))
        step = -step if reveal else step

        def moved(first: str, n: int) -> Column:
            return F.char(F.pmod(F.ascii(c) - ord(first) + step, F.lit(n)) + ord(first))
        return F.when(c.rlike("[0-9]"), moved("0", 10)).when(c.rlike("[a-z]"), moved("a", 26)) \
            .when(c.rlike("[A-Z]"), moved("A", 26)).otherwise(c)
    return F.when(F.length(s) == 0, F.lit("")).otherwise(
        F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), one), ""))


def _email(m: Column, key: str, reveal: bool) -> Column:
    def parts(local: Column) -> Column:
        half = F.floor(F.length(local) / 2).cast("int")
        start = F.struct(F.substring(local, F.lit(1), half).alias("x"),
                         F.substring(local, half + 1, F.length(local)).alias("y"))

        def forth(acc: Column, r: Column) -> Column:
            return let(_shift(acc["x"], _keyed(key, "email", r, acc["y"]), False), lambda x1: F.struct(
                x1.alias("x"), _shift(acc["y"], _keyed(key, "email", -r, x1), False).alias("y")))

        def back(acc: Column, r: Column) -> Column:
            return let(_shift(acc["y"], _keyed(key, "email", -r, acc["x"]), True), lambda y1: F.struct(
                _shift(acc["x"], _keyed(key, "email", r, y1), True).alias("x"), y1.alias("y")))
        rounds = F.sequence(F.lit(ROUNDS), F.lit(1)) if reveal else F.sequence(F.lit(1), F.lit(ROUNDS))
        return F.aggregate(rounds, start, back if reveal else forth, lambda p: F.concat(p["x"], p["y"]))
    return F.concat(let(F.substring_index(m, "@", 1), parts), F.lit("@"), F.substring_index(m, "@", -1))


def kind_of(m: Column) -> Column:
    """Which of ``KINDS`` a found value has the form of."""
    return (F.when(m.contains("@"), "email").when(m.rlike(r"^\d+\.\d+\.\d+\.\d+$"), "ipv4")
            .when(m.rlike(r"^(?:.*\(|(?:\+?1[ .-])?\d{3}([ .-])\d{3}\1\d{4}$)"), "phone").when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(m.rlike(r"^\d{4}[/-]\d{2}[/-]\d{2}$"), "iso_date").when(m.contains("/"), "us_date").otherwise("card"))


def mark_of(m: Column) -> Column:
    """Struct (kind, lead, length): which stretch of a found value counts; length 0: nothing passes the check."""
    return let(kind_of(m), lambda kind: let(
        F.when(kind == "card", _stretch(m)).otherwise(F.struct(F.lit(0).alias("lead"), F.length(m).alias("length"))),
        lambda w: F.struct(kind.alias("kind"), w["lead"].alias("lead"), w["length"].alias("length"))))


def pseudonym(m: Column, mark: Column, key: str, reveal: bool = False) -> Column:
    """Replacement of one found value."""
    how = {"email": _email, "ipv4": _ipv4, "phone": _phone, "ssn": _ssn, "iso_date": _iso_date, "us_date": _us_date}
    out = _card(m, mark, key, reveal)
    for name, f in how.items():
        out = F.when(mark["kind"] == name, f(m, key, reveal)).otherwise(out)
    return out


def _found() -> Column:
    # texts without a digit or an @ sign cannot hold a value
    return F.coalesce(F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0))),
                      F.array().cast("array<string>"))


def _joined() -> Column:
    """The text with the new values of ``pairs`` between what stands around them."""
    text = F.array_join(F.flatten(F.zip_with(
        F.split("text", ANY), F.transform("pairs", lambda p: p["new"]),
        lambda a, b: F.array(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))), "")
    return F.when(F.col("pairs").isNull(), F.col("text")).otherwise(text)


def pseudonymize(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_values, n_<kind>..., marks) with every validated value replaced.

    One row per input row; a null text stays null with zero counts; the counts are of
    values replaced.  Everything between the values is kept byte for byte.  Null ids and
    repeated rows are kept.  Other columns are not read.  ``marks``: (kind, lead, length) per
    value found, in order, for :func:`reveal_text`.  Empty table: no rows.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select("*", _found().alias("found"))
    pairs = F.transform("found", lambda m: let(mark_of(m), lambda k: F.struct(
        m.alias("old"), pseudonym(m, k, key).alias("new"), k.alias("mark"))))
    rows = rows.select("doc_id", "text", F.when(F.size("found") > 0, pairs).alias("pairs"))

    def changed(kind: str | None = None) -> Column:
        hit = F.filter("pairs", lambda p: (p["old"] != p["new"]) & (F.lit(True) if kind is None
                                                                     else p["mark"]["kind"] == kind))
        return F.when(F.col("pairs").isNull(), F.lit(0)).otherwise(F.size(hit)).cast("long")
    marks = F.coalesce(F.transform("pairs", lambda p: p["mark"]),
                       F.array().cast("array<struct<kind:string,lead:int,length:int>>"))
    return rows.select("doc_id", _joined().alias("text"), changed().alias("n_values"),
                       *(changed(k).alias(f"n_{k}") for k in KINDS), marks.alias("marks"))


def reveal_text(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text",
                marks_col: str = "marks") -> DataFrame:
    """(doc_id, text) as before :func:`pseudonymize` with the same key, from its text and marks.

    The forms of values survive their replacement, so the n-th value found belongs to the
    n-th mark.  Null texts stay null; null ids and repeated rows are kept.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(marks_col).alias("marks")) \
        .select("*", _found().alias("found"))
    pairs = F.zip_with("found", "marks", lambda m, k: F.struct(pseudonym(m, k, key, True).alias("new")))
    return rows.select("doc_id", "text", F.when(F.size("found") > 0, pairs).alias("pairs")) \
        .select("doc_id", _joined().alias("text"))
