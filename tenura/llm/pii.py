"""Personal data by patterns, checksums and context words, in SQL functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Total lengths of account numbers by country, as registered.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29,
    "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29,
    "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19,
    "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
    "YE": 30,
}
CONTEXT = 48  # code points looked at on either side of a span


@dataclass(frozen=True)
class Kind:
    """A kind of span: where a text is looked at, the pattern, the check of a match and what its surroundings are worth.

    Patterns use possessive repeats and may only start where a longer match could not have started, so long runs of
    letters or digits cost linear time and no stack. ``hint`` raises and ``doubt`` lowers the score by 0.3. ``edge``
    is what may not touch a match on either side.
    """

    name: str
    marker: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    hint: str
    doubt: str
    base: bool = True
    edge: str | None = None
    lead: str | None = None  # what has to stand right before, in lower case


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _chars(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.char_length(text)), lambda i: F.substring(text, i, F.lit(1)))


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is a multiple of ten."""

    def worth(char: Column, i: Column) -> Column:
        twice = char.cast("int") * (1 + i % 2)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(_chars(F.reverse(digits)), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(number: Column) -> Column:
    """Whether an account number, its first four characters moved to the end and letters read as 10 to 35, is 1 modulo 97."""
    turned = F.concat(F.substring(number, 5, 1000), F.substring(number, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(_chars(turned), F.lit(0), step) == 1


def _ip(match: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.char_length(bare) < 3) | ((F.char_length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(match, r"\."), small)


def _card(match: Column) -> Column:
    digits = _digits(match)
    return F.char_length(digits).between(13, 19) & luhn(digits)


def _iban(match: Column) -> Column:
    return mod97(F.replace(match, F.lit(" "), F.lit("")))


def iban_pattern() -> str:
    """Countries by the exact length of their numbers, so that a match ends where the number does."""
    countries: dict[int, list[str]] = {}
    for country, length in sorted(IBAN_LENGTHS.items()):
        countries.setdefault(length, []).append(country)
    parts = []
    for length, names in sorted(countries.items()):
        groups, rest = divmod(length - 4, 4)
        tail = f"(?: ?[A-Z0-9]{{{rest}}})" if rest else ""
        parts.append(f"(?:{'|'.join(names)})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}")
    return "(?:" + "|".join(parts) + ")"


def entropy(text: Column) -> Column:
    """Bits per character of a text by its own character counts."""
    chars = _chars(text)
    n = F.char_length(text).cast("double")

    def bits(total: Column, char: Column) -> Column:
        count = F.size(F.filter(chars, lambda c: c == char)).cast("double")
        return total + count * F.log2(count)

    return F.log2(n) - F.aggregate(F.array_distinct(chars), F.lit(0.0), bits) / n


def _secret(match: Column) -> Column:
    return match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (entropy(match) >= SECRET_BITS)


SECRET_PATTERN = r"[A-Za-z0-9+/_-]{20,}"
SECRET_BITS = 3.0
SECRET_LEAD = r"(token|secret|passwor[dt]|passwd|api[ _-]?key|access[ _-]?key|private[ _-]?key|credentials?|auth|bearer)[\"']?[ ]?[:=]?[ ]?[\"']?$"
SECRET_DOUBT = "example|sample|placeholder|dummy"

KINDS = [
    Kind(
        "email", "@",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True), 0.9, "mail|contact|write|kontakt|correo", "example|noreply",
    ),
    Kind(
        "ip", "[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip, 0.6, "server|host|address|adresse", "version|release|section",
    ),
    Kind(
        "card", "[0-9]", r"[0-9](?:[ -]?[0-9])++", _card, 0.7, "card|visa|credit|karte|tarjeta|carte", "order|invoice|isbn|serial",
    ),
    Kind(
        "phone", r"\+", r"\+[0-9][ ().0-9-]+[0-9]", lambda m: F.char_length(_digits(m)).between(9, 15), 0.7,
        "phone|call|tel|mobile|fax", "order|invoice|formula",
    ),
    Kind(
        "iban", "[0-9]", iban_pattern(), _iban, 0.8, "iban|account|bank|konto|cuenta|compte", "sample",
        base=False, edge="[A-Za-z0-9]",
    ),
    Kind(
        "ssn", "[0-9]", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        lambda m: ~m.rlike("^(000|666|9)") & ~m.rlike("-00-|-0000$"), 0.3, "ssn|social|security", "order|invoice|serial",
        base=False, edge="[0-9-]",
    ),
    Kind(
        "secret", "[0-9]", SECRET_PATTERN + "+", _secret, 0.3, "token|secret|passw|key|credential|auth|bearer", SECRET_DOUBT,
        base=False, edge="[A-Za-z0-9+/_-]", lead=SECRET_LEAD,
    ),
]
SPAN = "struct<kind:string,start:int,end:int,text:string,score:double>"


def _spans(text: Column, matches: Column, pieces: Column, kind: Kind) -> Column:
    """Spans of the valid matches. What lies between matches gives their places: the text is split by the same pattern."""
    lengths = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda piece, m: F.struct(piece.alias("gap"), F.char_length(m).alias("own")))
    placed = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["own"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"] + x["gap"])).alias("starts")
        ),
    )["starts"]

    def span(match: Column, start: Column) -> Column:
        low = F.greatest(start - CONTEXT, F.lit(0))
        end = start + F.char_length(match)
        before = F.substring(text, low + 1, start - low)
        after = F.substring(text, end + 1, F.lit(CONTEXT))
        around = F.lower(F.concat(before, F.lit(" "), after))
        score = F.lit(kind.score) + F.when(around.rlike(kind.hint), 0.3).otherwise(0.0) - F.when(around.rlike(kind.doubt), 0.3).otherwise(0.0)
        bare = F.lit(True)
        if kind.edge:
            bare = ~before.rlike(f"{kind.edge}$") & ~after.rlike(f"^{kind.edge}")
        if kind.lead:
            bare = bare & F.lower(before).rlike(kind.lead)
        return F.struct(
            F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), match.alias("text"),
            F.round(F.least(score, F.lit(1.0)), 2).alias("score"), bare.alias("bare"),
        )

    # The check runs on matches alone, so places are only worked out where one holds.
    zipped = F.zip_with(matches, placed, span)
    good = F.filter(zipped, lambda s: kind.valid(s["text"]) & (F.lit(True) if kind.base else s["bare"] & (s["score"] >= 0.5)))
    return F.transform(good, lambda s: s.dropFields("bare")).cast(f"array<{SPAN}>")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id and spans, an array of (kind, start, end, text, score) by kind and start.

    Matches are leftmost and do not overlap within a kind; one that fails its check is dropped. Spans of the base kinds
    (email, ip, card, phone) stay whatever their score; account and social-security numbers and secrets need 0.5. A secret is
    a run of 20 or more key characters with letters, digits and enough entropy behind a word that names it. Places count code points, the end is exclusive. NULL and empty texts have no spans; repeated rows and NULL ids give a row each;
    an empty table gives none; other columns are ignored.
    """
    df = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    text = F.col("_t")
    df = df.withColumns({
        f"_m_{k.name}": F.when(
            F.contains(text, F.lit(k.marker)) if len(k.marker) == 1 else text.rlike(k.marker), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))
        )
        for k in KINDS
    })
    df = df.withColumns({
        f"_p_{k.name}": F.when(
            F.exists(f"_m_{k.name}", k.valid), F.transform(F.split(text, k.pattern, -1), F.char_length)
        )
        for k in KINDS
    })
    found = [
        F.coalesce(_spans(text, F.col(f"_m_{k.name}"), F.col(f"_p_{k.name}"), k), F.array().cast(f"array<{SPAN}>")) for k in KINDS
    ]
    return df.select("doc_id", F.concat(*found).alias("spans"))


def listed(spans: Column | str, base_only: bool) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = [k.name for k in KINDS if k.base]
    chosen = F.filter(spans, lambda s: s["kind"].isin(names)) if base_only else spans
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
