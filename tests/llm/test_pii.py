import datetime
import hashlib
import re

import pytest
from helpers import edge_documents, empty_documents
from pyspark.sql import functions as F

from quizloom.llm.pii import KINDS, PATTERN, ROUNDS, feistel, pseudonymise

KEY = "test key"


def keyed(kind, step, value, extra=None):
    parts = [f"{KEY}|{kind}", str(step), str(value)] + ([str(extra)] if extra is not None else [])
    return int(hashlib.sha256("|".join(parts).encode()).hexdigest()[:12], 16)


def permute(kind, left, right, lefts, rights):
    for i in range(1, ROUNDS + 1):
        if i % 2:
            left = (left + keyed(kind, i, right)) % lefts
        else:
            right = (right + keyed(kind, i, left)) % rights
    return left, right


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def refill(form, digits):
    left = iter(digits)
    return "".join(next(left) if c in "0123456789" else c for c in form)


def brute(value):
    """Pseudonym of one value by plain arithmetic; None where it is not valid."""
    digits = re.sub("[^0-9]", "", value)
    if "@" in value:
        name, domain = value.split("@")
        left, right = name[: len(name) // 2], name[len(name) // 2 :]

        def shift(text, step, by):
            out = ""
            for place, c in enumerate(text, 1):
                for first, size in (("a", 26), ("A", 26), ("0", 10)):
                    if ord(first) <= ord(c) < ord(first) + size:
                        c = chr(ord(first) + (ord(c) - ord(first) + keyed("email", step, by, place)) % size)
                        break
                out += c
            return out

        for i in range(1, ROUNDS + 1):
            if i % 2:
                left = shift(left, i, right)
            else:
                right = shift(right, i, left)
        return f"{left}{right}@{domain}"
    if value.count(".") == 3:
        o = [int(x) for x in value.split(".")]
        if max(o) > 255:
            return None
        a, b = permute("ip", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if re.fullmatch(r"\d{3}-\d{2}-\d{4}", value):
        area, group, serial = int(digits[:3]), int(digits[3:5]), int(digits[5:])
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        a, b = permute("ssn", area - 2 if area > 666 else area - 1, (group - 1) * 9999 + serial - 1, 898, 99 * 9999)
        return f"{a + 2 if a >= 665 else a + 1:03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"
    if re.search("[-./]", value) and len(digits) <= 8:
        forms = {"-": ["%Y-%m-%d"], ".": ["%d.%m.%Y"], "/": ["%m/%d/%Y", "%d/%m/%Y"]}
        sign = next(c for c in value if c in "-./")
        for form in forms[sign]:
            try:
                day = datetime.datetime.strptime(value, form).date()
            except ValueError:
                continue
            n = (day - datetime.date(1900, 1, 1)).days
            if not 0 <= n < 270 * 271:
                return None
            a, b = permute("date", n // 271, n % 271, 270, 271)
            new = datetime.date(1900, 1, 1) + datetime.timedelta(a * 271 + b)
            pad = len(value) == 10
            part = {"%Y": f"{new.year:04d}", "%m": f"{new.month:0{2 if pad else 1}d}", "%d": f"{new.day:0{2 if pad else 1}d}"}
            return sign.join(part[p] for p in form.split(sign))
        return None
    if len(digits) == 10:
        area, rest = int(digits[:3]), int(digits[3:])
        al, an = (200, 800) if area >= 200 else (0, 200)
        rl, rn = (2_000_000, 8_000_000) if rest >= 2_000_000 else (0, 2_000_000)
        a, b = permute("phone", area - al, rest - rl, an, rn)
        return refill(value, f"{a + al:03d}{b + rl:07d}")
    if not luhn(digits):
        return None
    inner = digits[1:-1]
    half = len(inner) // 2
    a, b = permute("card", int(inner[:half]), int(inner[half:]), 10**half, 10 ** (len(inner) - half))
    start = f"{digits[0]}{a:0{half}d}{b:0{len(inner) - half}d}"
    return refill(value, next(start + c for c in "0123456789" if luhn(start + c)))


VALUES = [
    "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005",
    "3782 822463 10005", "4111111111111112", "70.123.182.155", "300.1.2.3", "2024-02-29",
    "2023-02-29", "31.12.1999", "5.3.2020", "02/28/2001", "25/12/2010", "13/13/2010",
    "123-45-6789", "666-12-1234", "000-12-1234", "(988) 555-2485", "988-555-2485",
    "(017) 555-7713", "jane.doe_42@mail.example.com", "X@y.org", "1800-01-01",
]


def test_values_against_plain_arithmetic(spark):
    rows = [(i, f"a {v}, b") for i, v in enumerate(VALUES)]
    found = pseudonymise(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), KEY)
    for row in found.collect():
        value = VALUES[row.doc_id]
        new = brute(value)
        assert row.text == f"a {new if new is not None else value}, b"
        assert sum(row[f"n_{k}"] for k in KINDS) == (new is not None)


def test_equal_values_stay_linked(spark):
    texts = ["card 4111111111111111 and 4111 1111 1111 1111.", "x4111-1111-1111-1111"]
    rows = pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING"), KEY)
    digits = {re.sub("[^0-9]", "", d) for r in rows.collect() for d in re.findall(r"[0-9][0-9 -]{14,18}[0-9]", r.text)}
    assert len(digits) == 1 and luhn(digits.pop())


def pseudonyms(spark, values):
    rows = [(i, f"a {v}, b") for i, v in enumerate(values)]
    found = pseudonymise(spark.createDataFrame(rows, "doc_id INT, text STRING"), KEY)
    return {values[r.doc_id]: (r.text[2:-3], {k for k in KINDS if r[f"n_{k}"]}) for r in found.collect()}


def test_phones_with_country_codes(spark):
    plain = "555-123-4567"
    same = ["+1-555-123-4567", "1-555-123-4567", "1 555 123 4567", "+15551234567", "+1 (555) 123-4567",
            "+1 55 51 23 45 67", "1.555.123.4567"]
    foreign = [["+44 20 7946 0958", "+442079460958", "+44 (0)20 7946-0958"], ["+33 1 42 68 53 00", "+33142685300"],
               ["+4722123456", "+47 22 12 34 56"], ["+358 9 1234567", "+35891234567"], ["+8613812345678"]]
    others = ["+4111 1111 1111 1111", "+2024-01-02", "+70.123.182.155", "1-800-555-1234"]
    found = pseudonyms(spark, [plain, *same, *sum(foreign, []), *others])
    national = re.sub("[^0-9]", "", brute(plain))
    for value in same:
        assert found[value] == (refill(value, "1" + national), {"phone"})
    for group, code in zip(foreign, ("44", "33", "47", "358", "86")):
        new = set()
        for value in group:
            text, kinds = found[value]
            assert kinds == {"phone"} and text != value
            assert re.sub("[0-9]", "0", text) == re.sub("[0-9]", "0", value)
            assert text.startswith(f"+{code}") and ("(0)" in text) == ("(0)" in value)
            new.add(re.sub("[^0-9]", "", text.replace("(0)", "")))
        assert len(new) == 1
    assert [found[v][1] for v in others] == [{"card"}, {"date"}, {"ip"}, {"phone"}]


def test_dates_with_the_year_first(spark):
    found = pseudonyms(spark, ["2020-03-04", "2020/03/04", "2020.03.04", "2020/3/4", "2020/13/40", "2020.3.4.5"])
    new = brute("2020-03-04")
    day = datetime.date.fromisoformat(new)
    assert found["2020-03-04"] == (new, {"date"})
    assert found["2020/03/04"] == (new.replace("-", "/"), {"date"})
    assert found["2020.03.04"] == (new.replace("-", "."), {"date"})
    assert found["2020/3/4"] == (f"{day.year}/{day.month}/{day.day}", {"date"})
    assert found["2020/13/40"] == ("2020/13/40", set())
    assert found["2020.3.4.5"] == ("2020.3.4.5", set())


@pytest.mark.parametrize("lefts,rights", [(7, 11), (1, 5), (16, 16)])
def test_permutation(spark, lefts, rights):
    pairs = spark.range(lefts * rights).select(
        feistel(KEY, "t", F.expr(f"id div {rights}"), F.expr(f"id % {rights}"), F.lit(lefts), F.lit(rights)).alias("p")
    )
    assert pairs.distinct().count() == lefts * rights


def test_edge_rows(spark):
    docs = edge_documents(spark, "n_card")
    found = pseudonymise(docs, KEY)
    assert found.columns == [*[c for c in docs.columns if c != "n_card"], *[f"n_{k}" for k in KINDS]]
    key = lambda r: repr((r.doc_id, r.text))
    assert [r.text for r in sorted(found.collect(), key=key)] == [r.text for r in sorted(docs.collect(), key=key)]
    assert pseudonymise(empty_documents(spark), KEY).count() == 0


def test_long_runs_are_quick(spark):
    text = "a" * 300_000 + "1" * 300_000 + " " + "." * 100_000
    rows = spark.createDataFrame([(1, text)], "doc_id INT, text STRING")
    assert pseudonymise(rows, KEY).first().text == text
    assert "(?<!" in PATTERN
