"""Rules for stray personal data: patterns with fixed scores, and what is not personal."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from maskmetrics.functions.text import as_column, bind, strip

# The entity types acted on by default. Dates are left out on purpose.
DEFAULT_TYPES = (
    "PERSON", "ORGANIZATION", "EMAIL_ADDRESS", "PHONE_NUMBER", "LOCATION", "NRP",
    "CREDIT_CARD", "IBAN_CODE", "US_SSN", "US_BANK_NUMBER", "US_DRIVER_LICENSE",
    "US_PASSPORT", "IP_ADDRESS", "CRYPTO", "MEDICAL_LICENSE", "URL",
)
# Types whose values are numbers by nature.
NUMERIC_TYPES = (
    "PHONE_NUMBER", "CREDIT_CARD", "IBAN_CODE", "US_SSN", "US_BANK_NUMBER", "IP_ADDRESS", "CRYPTO",
)
SCORE_THRESHOLD = 0.7

# Words that are never personal data.
ALLOWED_WORDS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november",
    "december",
    "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
    "critical", "high", "medium", "low", "urgent", "normal",
    "open", "closed", "complete", "pending", "resolved", "escalated",
    "new", "active", "inactive", "waiting", "scheduled",
    "kritiek", "hoog", "gemiddeld", "laag", "dringend", "normaal",
    "nieuw", "gesloten", "voltooid", "wachtend", "opgelost",
    "ticket", "contract", "project", "service", "support", "backup", "patch", "alert", "device", "endpoint",
    "hours", "ratio", "sla", "count", "sum", "total", "average", "avg",
    "snapshot", "queue", "queues", "resource", "resources", "capacity",
    "divide", "calculate", "filter", "sumx", "countx", "countrows", "distinctcount", "averagex", "maxx", "minx",
    "rankx", "topn",
    "related", "summarize", "summarizecolumns", "addcolumns", "selectedvalue", "isblank", "switch", "values",
    "allexcept", "dateadd", "datesytd", "totalytd", "earlier", "coalesce", "format", "concatenate", "concatenatex",
)

# Shapes that are never personal data.
GUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
HEX_ID = r"(?i)^(?=[0-9a-f]*[a-f])[0-9a-f]{8,}$"
NUMBER_OR_DATE = r"^\d[\dT.,:/ \-]*$"
PRIORITY_LABEL = r"(?iU)^P[1-4]\b"


def is_false_positive(text: Column | str, entity_type: Column | str) -> Column:
    """True for a detection that is clearly not personal data."""
    kind = as_column(entity_type)
    return bind(strip(text), lambda s: (
        (s == "") | F.lower(s).isin(*ALLOWED_WORDS) | s.rlike(GUID)
        | s.rlike(HEX_ID)
        | (~kind.isin(*NUMERIC_TYPES) & s.rlike(NUMBER_OR_DATE))
        | s.rlike(PRIORITY_LABEL)))


def luhn_valid(c: Column) -> Column:
    return F.call_function("luhn_check", F.regexp_replace(c, "[ -]", ""))


def iban_valid(c: Column) -> Column:
    """Country and check digits go last, letters count 10..35, remainder by 97 is 1."""
    c = F.replace(c, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(c, 5, 1000), F.substring(c, 1, 4))

    def step(acc: Column, ch: Column) -> Column:
        digit = F.ascii(ch) - 48
        return F.when(digit < 10, (acc * 10 + digit) % 97).otherwise((acc * 100 + digit - 7) % 97)

    return F.aggregate(F.regexp_extract_all(moved, F.lit("."), F.lit(0)), F.lit(0), step) == 1


def dea_valid(c: Column) -> Column:
    """Odd digits plus twice the even ones end in the seventh digit."""
    d = [F.substring(c, i, 1).cast("int") for i in range(3, 10)]
    return (d[0] + d[2] + d[4] + 2 * (d[1] + d[3] + d[5])) % 10 == d[6]


# The digits of base 58 and of bech32, and the constants of the bech32 checksum.
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
BECH32_END, BECH32M_END = 1, 0x2BC830A3


def _characters(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("."), F.lit(0))


# Digits of base 58 that are taken in at once: 58 ** 6 times a limb of 24 bits is still a long.
BASE58_CHUNK = 6


def base58_hex(c: Column) -> Column:
    """The number that ``c`` writes in base 58, as 54 hexadecimal digits; its digits must be of that base."""
    bits = 24
    zero = F.array(*[F.lit(0).cast("long")] * 9)
    # A leading 1 is a zero.
    full = (F.ceil(F.greatest(F.char_length(c), F.lit(1)) / BASE58_CHUNK) * BASE58_CHUNK).cast("int")

    def number(digits: Column) -> Column:
        value = F.lit(0).cast("long")
        for i in range(1, BASE58_CHUNK + 1):
            value = value * 58 + F.instr(F.lit(BASE58), F.substring(digits, i, 1)) - 1
        return value

    def shifted_plus(limbs: Column, chunk: Column) -> Column:
        start = F.struct(chunk.alias("carry"), F.array().cast("array<bigint>").alias("out"))

        def step(acc: Column, limb: Column) -> Column:
            return bind(limb * 58 ** BASE58_CHUNK + acc["carry"], lambda value: F.struct(
                F.shiftright(value, bits).alias("carry"), F.concat(acc["out"], F.array(value.bitwiseAND(F.lit((1 << bits) - 1)))).alias("out")))

        return F.aggregate(limbs, start, step, lambda acc: acc["out"])

    def chunks(padded: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.char_length(padded), F.lit(BASE58_CHUNK)), lambda i: number(F.substring(padded, i, F.lit(BASE58_CHUNK))))

    # The lowest limb first.
    limbs = F.aggregate(bind(F.lpad(c, full, F.lit("1")), chunks), zero, shifted_plus)
    return F.array_join(F.transform(F.reverse(limbs), lambda x: F.lpad(F.hex(x), 6, "0")), "")


def base58check_valid(c: Column) -> Column:
    """25 bytes: a version, 20 bytes, and the first four of the doubled SHA-256 of these; one leading 1 per leading zero byte."""
    def check(digits: Column) -> Column:
        body = F.substring(digits, 5, 42)
        once = F.sha2(F.unhex(body), 256)
        ones = F.char_length(F.regexp_extract(c, "^1*", 0))
        zeros = F.floor(F.char_length(F.regexp_extract(F.substring(digits, 5, 50), "^0*", 0)) / 2)
        return ((F.substring(digits, 1, 4) == "0000") & (ones == zeros)
                & (F.substring(F.sha2(F.unhex(once), 256), 1, 8) == F.lower(F.substring(digits, 47, 8))))

    return bind(base58_hex(c), check)


def bech32_valid(c: Column) -> Column:
    """An address of the first witness version ends in the older checksum, one of a later version in the newer; never in mixed case."""
    low = F.lower(c)
    data = F.transform(_characters(F.substring(low, 4, 100)), lambda ch: (F.instr(F.lit(BECH32), ch) - 1).cast("long"))
    # The part before the 1, "bc": high bits, a zero, low bits.
    values = F.concat(F.array(*(F.lit(v).cast("long") for v in (3, 3, 0, 2, 3))), data)

    def step(sum_: Column, value: Column) -> Column:
        out = F.shiftleft(sum_.bitwiseAND(F.lit(0x1FFFFFF)), 5).bitwiseXOR(value)
        for i, constant in enumerate(BECH32_STEPS):
            out = out.bitwiseXOR(F.shiftright(sum_, 25 + i).bitwiseAND(F.lit(1)) * F.lit(constant))
        return out

    end = F.aggregate(values, F.lit(1).cast("long"), step)
    return ((c == low) | (c == F.upper(c))) & F.when(data[0] == 0, end == BECH32_END).otherwise(end == BECH32M_END)


def crypto_valid(c: Column) -> Column:
    return F.when(F.lower(F.substring(c, 1, 3)) == "bc1", bech32_valid(c)).otherwise(base58check_valid(c))


@dataclass(frozen=True)
class PatternDetector:
    """One entity type found by a Java regex.

    A text can only match when it contains one of ``literals`` or, where there are none,
    matches the cheap regex ``hint``. A pattern that says little by itself names ``context``:
    words of which one must be among the five before a match, to raise its score to ``raised``.
    """

    entity_type: str
    pattern: str
    score: float
    literals: tuple[str, ...] = ()
    hint: str = ""
    valid: object = None
    context: tuple[str, ...] = ()
    raised: float = 0.0

    @property
    def best(self) -> float:
        return max(self.score, self.raised)

    def score_behind(self, before: Column) -> Column:
        """The score of a match, given the text before it."""
        if not self.context:
            return F.lit(float(self.score))
        words = "|".join(self.context)
        near = rf"(?i)(?<![\p{{L}}\p{{N}}_])(?:{words})(?![\p{{L}}\p{{N}}_])(?:[^\p{{L}}\p{{N}}_]+[\p{{L}}\p{{N}}_]+){{0,{CONTEXT_WORDS - 1}}}[^\p{{L}}\p{{N}}_]*$"
        return F.when(F.right(before, F.lit(CONTEXT_CHARS)).rlike(near), float(self.raised)).otherwise(float(self.score))


# Words before a match among which its context stands, and characters at most.
CONTEXT_WORDS = 5
CONTEXT_CHARS = 100


def _weak(entity_type: str, pattern: str, score: float, *context: str) -> PatternDetector:
    return PatternDetector(entity_type, pattern, score, hint="(?i)" + "|".join(context), context=context, raised=0.75)


_OCTET = r"(?:25[0-5]|2[0-4]\d|[01]?\d?\d)"
_DIGITS = r"\d[\d.]"
_PIECE = "[0-9A-Fa-f]{1,4}"

PATTERN_DETECTORS = (
    PatternDetector("EMAIL_ADDRESS", r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
                    1.0, ("@",)),
    PatternDetector("CREDIT_CARD", r"\b\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}\b", 1.0,
                    hint=_DIGITS, valid=luhn_valid),
    # In one run, or in printed groups of four.
    PatternDetector("IBAN_CODE", r"\b[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b", 1.0,
                    hint=_DIGITS + r"|[A-Z]{2}\d{2} ", valid=iban_valid),
    PatternDetector("IP_ADDRESS", rf"\b(?:{_OCTET}\.){{3}}{_OCTET}\b", 0.95, hint=_DIGITS),
    # All eight groups, or three at least around the gap.
    PatternDetector("IP_ADDRESS", rf"\b(?:(?:{_PIECE}:){{7}}{_PIECE}|{_PIECE}(?::{_PIECE}){{1,5}}::{_PIECE}(?::{_PIECE}){{0,4}}"
                                  rf"|{_PIECE}::{_PIECE}(?::{_PIECE}){{1,5}})\b", 0.95, hint=f"::[0-9A-Fa-f]|(?:{_PIECE}:){{7}}"),
    PatternDetector("US_SSN", r"\b\d{3}-\d{2}-\d{4}\b", 0.85, hint=_DIGITS),
    PatternDetector("URL", r"\b(?:https?://|www\.)[^\s<>\"']+", 0.8, ("://", "www.")),
    PatternDetector("PHONE_NUMBER",
                    r"(?:\+\d{1,3} )?\(\d{3}\) \d{3}-\d{4}\b|\+\d{8,15}\b|\+\d{1,3}(?:[ -]\d{1,9}){2,5}\b|\b0\d{9}\b|\b0\d{1,3}-\d{6,8}\b"
                    r"|\b\d{3}[.-]\d{3}[.-]\d{4}\b",
                    0.75, hint=_DIGITS + r"|\+\d|\d-\d"),
    PatternDetector("MEDICAL_LICENSE", r"\b[ABCDEFGHJKLMNPQRSTUX][A-Z9]\d{7}\b", 1.0, hint=_DIGITS, valid=dea_valid),
    PatternDetector("CRYPTO", r"\b(?:[13][1-9A-HJ-NP-Za-km-z]{25,34}|bc1[02-9ac-hj-np-z]{11,71}|BC1[02-9AC-HJ-NP-Z]{11,71})\b", 1.0,
                    hint=r"\b(?:[13][1-9A-HJ-NP-Za-km-z]{25}|bc1[02-9ac-hj-np-z]{11}|BC1[02-9AC-HJ-NP-Z]{11})", valid=crypto_valid),
    _weak("US_BANK_NUMBER", r"\b\d{8,17}\b", 0.05, "account", "accounts", "acct", "bank", "debit", "savings", "checking"),
    _weak("US_PASSPORT", r"\b(?:[A-Z]\d{8}|\d{9})\b", 0.1, "passport", "passports", "travel document"),
    _weak("US_DRIVER_LICENSE", r"\b(?:[A-Z]{1,2}\d{4,14}|\d{7,9}[A-Z]{1,2}|\d{2}[A-Z]{3}\d{5,6})\b", 0.3, "driver", "drivers", "driving", "license", "licence", "permit"),
)


def may_match(text: Column, *detectors: PatternDetector) -> Column:
    """A cheap test that is true whenever one of the patterns can match."""
    literals = dict.fromkeys(x for d in detectors for x in d.literals)
    hints = dict.fromkeys(d.hint for d in detectors if not d.literals)
    test = F.lit(False)
    for literal in literals:
        test = test | F.contains(text, F.lit(literal))
    for hint in hints:
        test = test | text.rlike(hint)
    return test
