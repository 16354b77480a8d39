"""Personal data in texts: built-in SQL functions only.

Regular expressions propose spans, checks confirm them (ranges of numbers, Luhn, mod 97), and words nearby decide on
proposals that are weak by themselves. The patterns use possessive repeats and start only where a run of their characters
starts or the last match ended, so a scan is linear in the text; they match what the plain forms beside them match.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizpulse.llm.common import free_name

#: Account numbers: countries by length, those that use the form without being in its registry included.
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """Groups of four with or without blanks between them, as many characters as the country's numbers have. For a country
    without a known length the longest run of groups, up to where a number of a known one begins."""
    known = "|".join(codes.replace(" ", "|") for codes in IBAN_COUNTRIES.values())
    forms = []
    for length, codes in IBAN_COUNTRIES.items():
        groups, rest = divmod(length - 4, 4)
        forms.append(rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{groups}}}" + (rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""))
    blank = rf"(?:\x20(?!(?:{known})[0-9]{{2}}))?"
    forms.append(rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:{blank}[A-Z0-9]{{4}}){{2,7}}(?:{blank}[A-Z0-9]{{1,3}})?")
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(forms)})(?![A-Za-z0-9])"


#: Base kinds, in the order in which they are reported, then the kinds that checks and context add.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban(),
    "ssn": r"(?<![A-Za-z0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![A-Za-z0-9-])",
}
BASE = ("email", "ip", "card", "phone")
#: A text without a match of this cannot have one of the kind: one cheap scan saves two.
HINTS = {"card": "[0-9](?:[ -]?[0-9]){15}", "iban": "[A-Z]{2}[0-9]{2}", "ssn": "[0-9]-[0-9]{2}-"}
#: Score of a confirmed proposal, words nearby that raise it, and by how much. Reported from `THRESHOLD` on.
SCORES = {
    "email": (0.9, "mail|contact|write", 0.1),
    "ip": (0.6, "ip|host|server|address|login", 0.3),
    "card": (0.8, "card|visa|credit|payment|debit", 0.2),
    "phone": (0.6, "phone|tel|call|mobile|fax", 0.3),
    "iban": (0.8, "iban|bank|account|transfer", 0.2),
    "ssn": (0.3, "ssn|social security|tax id|taxpayer", 0.5),
}
#: Words nearby that lower the score of the kinds that are not base, and by how much.
DOUBTS = {"iban": ("example|sample|dummy|placeholder", 0.4), "ssn": ("part|model|serial|order|invoice|version|example|sample|dummy", 0.4)}
THRESHOLD = 0.5
NEARBY = 60
#: Positions are summed up, and appended, in blocks of so many matches; texts are looked into in pieces of so many code points.
BLOCK, PIECE = 64, 256


def _no_spans() -> Column:
    return F.expr("CAST(array() AS array<struct<kind: string, start: bigint, end: bigint, text: string, score: double>>)")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits ends in 0."""

    def added(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = 2 * digit - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), added) % 10 == 0


def _mod97(text: Column) -> Column:
    """Whether an account number, its first four characters moved to the end and letters read as 10 to 35, is 1 mod 97."""
    plain = F.regexp_replace(text, " ", "")
    turned = F.split(F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4))), "")

    def step(rest: Column, c: Column) -> Column:
        value = F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        return F.when(value > 9, (rest * 100 + value) % 97).otherwise((rest * 10 + value) % 97)

    return F.aggregate(turned, F.lit(0), lambda rest, c: F.when(c == "", rest).otherwise(step(rest, c))) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.split(match, r"\.")
        return F.forall(parts, lambda p: p.cast("double") <= 255)
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(match, " ", "")).between(15, 34) & _mod97(match)
    return F.lit(True)


def find_pii(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add `pii`, an array of (kind, start, end, text, score) in code points, end exclusive, by kind, then start.

    Spans of the base kinds (email, ip, card, phone) are all proposals that pass their check, whatever the score; the other
    kinds also need `threshold`, which words nearby raise or lower them over. A proposal that fails is dropped and its characters are not tried again. Kinds may overlap.
    Null or empty text: an empty array. Rows that repeat are treated each. Time is linear in text and matches. A column of `docs` named `pii` is replaced; no other column is touched.
    """
    docs = docs.drop("pii")
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = {}
    for kind, pattern in PATTERNS.items():
        here = {"email": text.contains("@"), "phone": text.contains("+"), "ip": text.contains(".") & text.rlike(r"[0-9]\.[0-9]")}
        here = here[kind] if kind in here else text.rlike(HINTS[kind])
        name = free_name(docs, f"found_{kind}")
        value = F.struct(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"), F.split(text, pattern, -1).alias("gaps")
        )
        found[name] = (kind, F.when(here, value))
    docs_found = docs.withColumns({name: value for name, (_, value) in found.items()})
    pieces, any_found = free_name(docs, "found_pieces"), reduce(Column.__or__, [F.col(name).isNotNull() for name in found])
    cut = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))
    docs_found = docs_found.withColumn(pieces, F.when(any_found, cut))
    spans = [F.when(F.col(name).isNotNull(), _spans(kind, F.col(name), F.col(pieces), threshold)) for name, (kind, _) in found.items()]
    every = F.concat(*(F.coalesce(s, _no_spans()) for s in spans))
    return docs_found.withColumn("pii", every).drop(*found, pieces)


def _starts(matches: Column, gaps: Column) -> Column:
    """Places of matches: the text is gap 0, match 0, gap 1, ..., so lengths add up to positions. An append copies what is there,
    so positions are appended to short blocks, and these to the result."""
    none, nothing = F.expr("CAST(array() AS array<bigint>)"), F.expr("CAST(array() AS array<array<bigint>>)")

    def state(at: Column, here: Column, done: Column) -> Column:
        return F.struct(at.alias("at"), here.alias("here"), done.alias("done"))

    def one(s: Column, i: Column) -> Column:
        start = s["at"] + F.length(F.get(gaps, i))
        return state(start + F.length(F.get(matches, i)), F.concat(s["here"], F.array(start)), s["done"])

    def block(s: Column, b: Column) -> Column:
        own = F.sequence(b * BLOCK, F.least(b * BLOCK + BLOCK, F.size(matches)) - 1)
        return F.aggregate(own, state(s["at"], none, s["done"]), one, lambda s: state(s["at"], none, F.concat(s["done"], F.array(s["here"]))))

    blocks = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / BLOCK).cast("int"))
    summed = F.aggregate(blocks, state(F.lit(0).cast("bigint"), none, nothing), block, lambda s: F.flatten(s["done"]))
    return F.when(F.size(matches) > 0, summed).otherwise(none)


def _cut(pieces: Column, start: Column, end: Column) -> Column:
    """The text from `start` to `end`, at most one piece apart, from the two pieces that it lies in."""
    first = F.floor(start / PIECE).cast("int")
    two = F.concat(F.coalesce(F.get(pieces, first), F.lit("")), F.coalesce(F.get(pieces, first + 1), F.lit("")))
    return F.substr(two, (start % PIECE + 1).cast("int"), (end - start).cast("int"))


def _spans(kind: str, found: Column, pieces: Column, threshold: float) -> Column:
    base_score, words, more = SCORES[kind]

    def span(match: Column, start: Column) -> Column:
        end = start + F.length(match)
        low = F.greatest(start - NEARBY, F.lit(0))
        near = F.lower(F.concat(_cut(pieces, low, start), match, _cut(pieces, end, end + NEARBY)))
        score = F.lit(base_score) + F.when(near.rlike(rf"\b(?:{words})"), more).otherwise(0.0)
        if kind in DOUBTS:
            doubts, less = DOUBTS[kind]
            score = score - F.when(near.rlike(rf"\b(?:{doubts})"), less).otherwise(0.0)
        return F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), match.alias("text"), F.round(score, 3).alias("score")
        )

    spans = F.filter(F.zip_with(found["matches"], _starts(found["matches"], found["gaps"]), span), lambda s: _confirmed(kind, s["text"]))
    return spans if kind in BASE else F.filter(spans, lambda s: s["score"] >= threshold)
