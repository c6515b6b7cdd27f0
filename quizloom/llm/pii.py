"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Each validated value is mapped by a keyed Feistel permutation of its own format: card
numbers keep their length, first digit and separators and get a right check digit, dates
become other valid dates, octets stay octets. The map is one to one, and depends on the
value and the key alone, so a value that occurs in several documents, also with other
separators, gets the same pseudonym everywhere. Whoever has the key can undo it.

Kinds: ``email`` (the part before the @), ``ip`` (IPv4), ``date`` (year-month-day, also
with slashes or dots, day.month.year, month/day/year or, where that is no date,
day/month/year), ``ssn``, ``phone`` (ten digits, also after a 1, or + with a country code
and 8 to 15 digits in any groups; the code stays), ``card`` (13 to 19 digits with a right
check digit).
What looks like one of them but is not valid stays as it is.

All of it is column expressions; no row depends on another and nothing is shuffled.

Defined results: NULL text stays NULL and has no values. Matches are leftmost and do not
overlap. Other columns stay; columns of the input with a name of a count are replaced.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.llm.text import hide
from quizloom.operators.columns import with_computed

KINDS = ("email", "ip", "date", "ssn", "phone", "card")
ROUNDS = 8

# Formats, in the order in which they are tried at one place.
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
_IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
_DATE = (
    r"(?<![0-9.-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?!-?[0-9])"
    r"|(?<![0-9.])[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?!\.?[0-9])"
    r"|(?<![0-9/])[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(?!/?[0-9])"
    r"|(?<![0-9/])[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}(?!/?[0-9])"
    r"|(?<![0-9.])[0-9]{4}\.[0-9]{1,2}\.[0-9]{1,2}(?!\.?[0-9])"
)
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])"
_GROUPED_CARD = r"[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}"
# After a + a country code and groups of any size; ten digits after the code 1.
_PHONE = (
    rf"(?<![0-9+])\+(?!(?:{_IP}|{_DATE}|{_GROUPED_CARD})(?![0-9]))"
    r"(?:1(?:[-./()\x20\xA0]{0,3}[0-9]){10}|[2-9](?:[-./()\x20\xA0]{0,3}[0-9]){7,14})(?![0-9])"
    r"|\([0-9]{3}\)\x20?[0-9]{3}[-.\x20][0-9]{4}(?![0-9])"
    r"|(?<![0-9-])(?:1[-./\x20])?[0-9]{3}[-.\x20][0-9]{3}[-.\x20][0-9]{4}(?![0-9])"
)
# Country codes of two digits; 1 and 7 have one, all others three.
_TWO_DIGIT_CODES = "^(?:2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_CARD = (
    rf"(?<![0-9])(?:[0-9]{{13,19}}|{_GROUPED_CARD})(?![0-9])"
)
PATTERN = "|".join((_EMAIL, _IP, _DATE, _SSN, _PHONE, _CARD))

# Dates of this span are permuted: FIRST_DAY and the 270 * 271 - 1 days after it.
FIRST_DAY = "1900-01-01"
_DATE_HIGH, _DATE_LOW = 270, 271


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _number(value: Column) -> Column:
    return value.cast("bigint")


def _keyed(key: str, kind: str, step: Column, value: Column, extra: Column | None = None) -> Column:
    """A 48-bit number that only the key's owner can foresee."""
    parts = [F.lit(f"{key}|{kind}"), step.cast("string"), value.cast("string")]
    if extra is not None:
        parts.append(extra.cast("string"))
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")


def feistel(key: str, kind: str, left: Column, right: Column, lefts: Column, rights: Column) -> Column:
    """Permute (left, right), left below ``lefts`` and right below ``rights``.

    Rounds change the halves in turn, each by a keyed function of the other.
    """

    def step(pair, i):
        odd = i % 2 == 1
        left, right = pair["l"], pair["r"]
        new_left = F.pmod(left + _keyed(key, kind, i, right), lefts)
        new_right = F.pmod(right + _keyed(key, kind, i, left), rights)
        return F.struct(
            F.when(odd, new_left).otherwise(left).alias("l"),
            F.when(odd, right).otherwise(new_right).alias("r"),
        )

    start = F.struct(_number(left).alias("l"), _number(right).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _padded(number: Column, width: Column) -> Column:
    return F.lpad(number.cast("string"), width, F.lit("0"))


def _refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, in order, by ``digits``."""

    def char(i):
        c = F.substr(form, i, F.lit(1))
        place = F.length(_digits(F.substr(form, F.lit(1), i)))
        return F.when(c.between("0", "9"), F.substr(digits, place, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), char), "")


def _luhn(digits: Column) -> Column:
    """Sum of a card number; a right one is a multiple of ten."""

    def add(total, i):
        digit = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        double = digit * 2
        weighed = F.when(i % 2 == 1, digit).otherwise(
            F.when(double > 9, double - 9).otherwise(double)
        )
        return total + weighed

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _card(key: str, value: Column) -> Column:
    def permute(digits):
        inner = F.length(digits) - 2
        half = F.floor(inner / 2).cast("int")
        left = F.substr(digits, F.lit(2), half)
        right = F.substr(digits, half + 2, inner - half)
        tens = [F.pow(F.lit(10.0), n).cast("bigint") for n in (half, inner - half)]

        def build(pair):
            start = F.concat(
                F.substr(digits, F.lit(1), F.lit(1)),
                _padded(pair["l"], half),
                _padded(pair["r"], inner - half),
            )
            return _let(
                start,
                lambda s: F.concat(
                    s, F.pmod(-_luhn(F.concat(s, F.lit("0"))), F.lit(10)).cast("string")
                ),
            )

        return _let(feistel(key, "card", left, right, *tens), build)

    return _let(
        _digits(value),
        lambda d: F.when(
            _luhn(d) % 10 == 0, _let(permute(d), lambda new: _refill(value, new))
        ),
    )


def _phone(key: str, value: Column) -> Column:
    """National digits permuted; a country code, its trunk zero or a leading 1 stay.

    Of ten digits, area codes and exchanges that begin with 2 to 9, as they should, still do
    so after; numbers that begin otherwise are permuted among themselves. So are numbers of
    another length that begin with a zero.
    """

    def of_ten(digits):
        area = _number(F.substr(digits, F.lit(1), F.lit(3)))
        rest = _number(F.substr(digits, F.lit(4), F.lit(7)))
        area_low, areas = [F.when(area < 200, a).otherwise(b) for a, b in ((0, 200), (200, 800))]
        rest_low, rests = [
            F.when(rest < 2_000_000, a).otherwise(b)
            for a, b in ((0, 2_000_000), (2_000_000, 8_000_000))
        ]
        pair = feistel(key, "phone", area - area_low, rest - rest_low, areas, rests)
        return _let(
            pair,
            lambda p: F.concat(
                _padded(p["l"] + area_low, F.lit(3)), _padded(p["r"] + rest_low, F.lit(7))
            ),
        )

    def of_any(digits):
        half = F.floor(F.length(digits) / 2).cast("int")
        others = F.length(digits) - half
        left = _number(F.substr(digits, F.lit(1), half))
        right = F.substr(digits, half + 1, others)
        least = F.pow(F.lit(10.0), half - 1).cast("bigint")
        low = F.when(left < least, 0).otherwise(least)
        lefts = F.when(left < least, least).otherwise(least * 9)
        rights = F.pow(F.lit(10.0), others).cast("bigint")
        pair = feistel(key, "phone", left - low, right, lefts, rights)
        return _let(
            pair, lambda p: F.concat(_padded(p["l"] + low, half), _padded(p["r"], others))
        )

    def permute(digits):
        code = (
            F.when(digits.rlike("^[17]"), 1).when(digits.rlike(_TWO_DIGIT_CODES), 2).otherwise(3)
        )
        trunk = value.rlike(r"^\+[0-9]{1,3}[-./\x20\xA0]?\(0\)").cast("int")
        kept = F.when(value.startswith("+"), code + trunk).otherwise(F.length(digits) - 10)

        def build(n):
            national = F.substr(digits, n + 1, F.length(digits))
            new = _let(
                national, lambda d: F.when(F.length(d) == 10, of_ten(d)).otherwise(of_any(d))
            )
            return F.concat(F.substr(digits, F.lit(1), n), new)

        return _let(_let(kept, build), lambda n: _refill(value, n))

    return _let(_digits(value), permute)


def _ssn(key: str, value: Column) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""

    def permute(digits):
        area = _number(F.substr(digits, F.lit(1), F.lit(3)))
        group = _number(F.substr(digits, F.lit(4), F.lit(2)))
        serial = _number(F.substr(digits, F.lit(6), F.lit(4)))
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        left = F.when(area > 666, area - 2).otherwise(area - 1)
        right = (group - 1) * 9999 + serial - 1
        pair = feistel(key, "ssn", left, right, F.lit(898), F.lit(99 * 9999))

        def build(p):
            place = F.when(p["l"] >= 665, p["l"] + 2).otherwise(p["l"] + 1)
            return F.concat(
                _padded(place, F.lit(3)),
                _padded(F.floor(p["r"] / 9999) + 1, F.lit(2)),
                _padded(p["r"] % 9999 + 1, F.lit(4)),
            )

        return F.when(valid, _let(_let(pair, build), lambda n: _refill(value, n)))

    return _let(_digits(value), permute)


def _ip(key: str, value: Column) -> Column:
    def permute(parts):
        octets = [_number(F.element_at(parts, i)) for i in range(1, 5)]
        valid = F.greatest(*octets) <= 255
        pair = feistel(
            key,
            "ip",
            octets[0] * 256 + octets[1],
            octets[2] * 256 + octets[3],
            F.lit(65536),
            F.lit(65536),
        )
        new = _let(
            pair,
            lambda p: F.concat_ws(
                ".",
                *[
                    part.cast("bigint").cast("string")
                    for half in ("l", "r")
                    for part in (F.floor(p[half] / 256), p[half] % 256)
                ],
            ),
        )
        return F.when(valid, new)

    return _let(F.split(value, r"\."), permute)


def _date(key: str, value: Column) -> Column:
    padded = F.length(value) == 10

    def as_form(form: str, short: str):
        day = F.try_to_timestamp(value, F.lit(short)).cast("date")
        number = _number(F.datediff(day, F.lit(FIRST_DAY).cast("date")))

        def permute(n):
            pair = feistel(
                key, "date", F.floor(n / _DATE_LOW), n % _DATE_LOW, F.lit(_DATE_HIGH), F.lit(_DATE_LOW)
            )
            new = _let(
                pair,
                lambda p: F.date_add(
                    F.lit(FIRST_DAY).cast("date"), (p["l"] * _DATE_LOW + p["r"]).cast("int")
                ),
            )
            text = _let(
                new,
                lambda d: F.when(padded, F.date_format(d, form)).otherwise(F.date_format(d, short)),
            )
            return F.when(n.between(0, _DATE_HIGH * _DATE_LOW - 1), text)

        return _let(number, permute)

    return (
        F.when(value.contains("-"), as_form("yyyy-MM-dd", "yyyy-M-d"))
        .when(value.rlike(r"^[0-9]{4}/"), as_form("yyyy/MM/dd", "yyyy/M/d"))
        .when(value.rlike(r"^[0-9]{4}\."), as_form("yyyy.MM.dd", "yyyy.M.d"))
        .when(value.contains("."), as_form("dd.MM.yyyy", "d.M.yyyy"))
        .otherwise(F.coalesce(as_form("MM/dd/yyyy", "M/d/yyyy"), as_form("dd/MM/yyyy", "d/M/yyyy")))
    )


def _shifted(text: Column, key: str, step: Column, by: Column) -> Column:
    """Letters and digits moved within their class by a keyed function of ``by``."""

    def char(i):
        c = F.substr(text, i, F.lit(1))
        amount = _keyed(key, "email", step, by, i)

        def moved(first: str, size: int):
            base = F.lit(ord(first))
            return F.char((F.pmod(F.ascii(c) - base + amount, F.lit(size)) + base).cast("int"))

        return (
            F.when(c.between("a", "z"), moved("a", 26))
            .when(c.between("A", "Z"), moved("A", 26))
            .when(c.between("0", "9"), moved("0", 10))
            .otherwise(c)
        )

    chars = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), char)
    return F.when(text == "", text).otherwise(F.array_join(chars, ""))


def _email(key: str, value: Column) -> Column:
    name = F.substring_index(value, "@", 1)
    half = F.floor(F.length(name) / 2).cast("int")
    start = F.struct(
        F.substr(name, F.lit(1), half).alias("l"),
        F.substr(name, half + 1, F.length(name)).alias("r"),
    )

    def step(pair, i):
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, _shifted(pair["l"], key, i, pair["r"])).otherwise(pair["l"]).alias("l"),
            F.when(odd, pair["r"]).otherwise(_shifted(pair["r"], key, i, pair["l"])).alias("r"),
        )

    new = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    joined = _let(new, lambda p: F.concat(p["l"], p["r"]))
    return F.concat(joined, F.lit("@"), F.substring_index(value, "@", -1))


def _kind_and_pseudonym(key: str, value: Column) -> Column:
    """Struct of a match's kind and pseudonym; both NULL where it is not valid."""

    def tagged(kind: str, new: Column) -> Column:
        return _let(
            new, lambda n: F.struct(F.when(n.isNotNull(), kind).alias("kind"), n.alias("new"))
        )

    return (
        F.when(value.contains("@"), tagged("email", _email(key, value)))
        .when(value.rlike(f"^(?:{_IP})$"), tagged("ip", _ip(key, value)))
        .when(value.rlike(f"^(?:{_DATE})$"), tagged("date", _date(key, value)))
        .when(value.rlike(f"^(?:{_SSN})$"), tagged("ssn", _ssn(key, value)))
        .when(value.rlike(f"^(?:{_PHONE})$"), tagged("phone", _phone(key, value)))
        .otherwise(tagged("card", _card(key, value)))
    )


def pseudonymise(documents: DataFrame, key: str) -> DataFrame:
    """``documents`` with personal values in ``text`` replaced, and ``n_<kind>`` counts."""
    base, show = hide(documents, "text")
    # Texts without a digit or an @ have no values; most never reach the long pattern.
    has = base.withColumn("_has", F.coalesce(F.col("text").rlike("[0-9@]"), F.lit(False)))
    matches = F.when(F.col("_has"), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    found = with_computed(has, "_found", matches)
    new = F.when(
        F.size("_found") > 0, F.transform("_found", lambda m: _kind_and_pseudonym(key, m))
    )
    mapped = with_computed(found, "_new", new)

    def piece(between, i):
        value = F.get("_found", i)
        return F.concat(between, F.coalesce(F.get("_new", i)["new"], value, F.lit("")))

    parts = F.transform(F.split("text", PATTERN), piece)
    text = F.when(F.size("_new") > 0, F.array_join(parts, "")).otherwise(F.col("text"))

    def count(kind: str) -> Column:
        of_kind = F.filter("_new", lambda m: m["kind"] == kind)
        return F.coalesce(F.size(of_kind), F.lit(0)).cast("bigint").alias(f"n_{kind}")

    columns = [text.alias("text") if c == "text" else F.col(c) for c in base.columns]
    counted = mapped.select(*columns, *[count(kind) for kind in KINDS])
    return show(counted, *[f"n_{kind}" for kind in KINDS])
