import re

from tenura.llm.pii import IBAN_LENGTHS, listed, personal_data
from tests.llm.samples import SCHEMA, documents, messy_rows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


TEXTS = [
    "mail é😀 a.b+c@x-y.example.com, b@c d@e.f_g@h.i..j x@y.z.", "@a.b a@.b a@b. _%@1.2 a@b.c@d.e +++@q.r--",
    "1.2.3.4 255.255.255.255 256.1.1.1 1.2.3.4.5.6.7.8.9 0001.02.003.0255 1.2.3 99999999999999999999.1.1.1 1..2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1112 4222222222222 5 12 4111  1111 1111 1111 3782-822463-10005 0000000000000",
    "+1 (269) 555-3296 4524132264652876 and +49 30 123456. +123 +1234567890123456 ++44 20 7946 0958x +1-2",
    "日本 +81-3-1234-5678 4111111111111111日本 ünter@bücher.de", "1" * 40_000 + " 1.2.3.4", "a" * 60_000 + "@" + "b" * 50_000 + ".c",
    "4" + " 4" * 20_000 + " 1.1.1.1", ".".join(["7"] * 9_000), "+" + "1 " * 30_000, "x@y.z " * 700,
]


def test_base_kinds_against_brute_force(spark):
    rows = messy_rows() + [(100 + i, t, "en", "s") for i, t in enumerate(TEXTS)]
    found = personal_data(documents(spark, rows)).select("doc_id", listed("spans", True).alias("base")).collect()
    assert sorted([tuple(r) for r in found], key=repr) == sorted([(r[0], brute(r[1])) for r in rows], key=repr)


def spans(spark, text):
    return [(s.kind, s.start, s.end, s.text, s.score) for s in personal_data(documents(spark, [(1, text, "", "")])).first().spans]


def test_checksums_and_context_of_added_kinds(spark):
    assert ("iban", 5, 27, "DE89370400440532013000", 1.0) in spans(spark, "IBAN DE89370400440532013000.")
    assert [s[:3] for s in spans(spark, "GB82 WEST 1234 5698 7654 32") if s[0] == "iban"] == [("iban", 0, 27)]
    assert not [s for s in spans(spark, "DE88370400440532013000 XDE89370400440532013000") if s[0] == "iban"]
    assert [s[4] for s in spans(spark, "her social security number is 219-09-9999") if s[0] == "ssn"] == [0.6]
    for text in ("part 219-09-9999", "ssn 000-12-3456", "ssn 219-09-99991", "social order 219-09-9999"):
        assert not [s for s in spans(spark, text) if s[0] == "ssn"], text


def test_account_numbers_end_where_their_country_says(spark):
    numbers = ["AT61 1904 3002 3457 3201", "BE68 5390 0754 7034", "SA03 8000 0000 6080 1016 7519", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S"]
    for number in numbers:
        for after in (" BIC", " EUR 100", ".", " and more", ""):
            assert [s[3] for s in spans(spark, f"x {number}{after}") if s[0] == "iban"] == [number], (number, after)
    assert not [s for s in spans(spark, "AT61 1904 3002 3457 3202 ZZ61 1904 3002 3457 3201") if s[0] == "iban"]
    assert len({len(k) for k in IBAN_LENGTHS}) == 1 and max(IBAN_LENGTHS.values()) == 33


def test_secrets(spark):
    value = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    for text in (f'token = "{value}" rest', f"API_KEY={value}", f"the password: {value}.", f"Bearer {value}"):
        assert [s[3] for s in spans(spark, text) if s[0] == "secret"] == [value], text
    for text in (f"commit {value}", f'an example token = "{value}"', "token = " + "1" * 40, "token = " + "abcd" * 10 + "1", "token = " + "a" * 19 + "1",
                 f"token = x.{value}", "secret = " + "only-letters-of-a-long-name"):
        found = [s for s in spans(spark, text) if s[0] == "secret"]
        assert not found, (text, found)


def test_context_moves_the_score(spark):
    assert spans(spark, "call +49 30 1234567")[0][4] == 1.0
    assert spans(spark, "+49 30 1234567")[0][4] == 0.7
    assert spans(spark, "invoice +49 30 1234567")[0][4] == 0.4


def test_empty_table_and_native_plan(spark):
    assert personal_data(spark.createDataFrame([], SCHEMA)).count() == 0
    plan = personal_data(documents(spark, messy_rows()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
