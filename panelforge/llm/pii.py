"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans; checks confirm them (Luhn for card numbers,
mod 97 for account numbers, ranges for addresses, digit counts for phones);
context words in the 48 characters before a span raise its score.  Base kinds
are always reported; the kinds that the method adds only from
``ADDED_SCORE`` on.

The expressions give the leftmost non-overlapping matches of the plain forms
in their comments, written so that long runs of their characters cost linear
time and no recursion.  A match that fails its check is dropped and not tried
again, except that account numbers are tried wherever one can start.  An account
number is as long as its country says; codes without a known length may have
any length up to the next other character.

Defined cases: null texts are empty; spans of different kinds may overlap and
are all reported; masking turns overlapping spans into the first one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm import spans
from panelforge.llm.common import fresh

ADDED_SCORE = 0.6
NEAR = 48


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The check digit of a string of digits is right."""
    char = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")

    def step(acc: Column, c: Column) -> Column:
        d = c.cast("int") * F.when(acc["odd"], 2).otherwise(1)
        return F.struct((~acc["odd"]).alias("odd"), (acc["sum"] + d - F.when(d > 9, 9).otherwise(0)).alias("sum"))

    return F.aggregate(char, F.struct(F.lit(False).alias("odd"), F.lit(0).alias("sum")), step, lambda acc: acc["sum"] % 10 == 0)


def mod97(m: Column) -> Column:
    """An account number's check digits are right: letters count 10 to 35."""
    code = F.regexp_replace(m, " ", "")
    moved = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))
    char = F.filter(F.split(moved, ""), lambda c: c != "")

    def step(acc: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97).cast("int")

    return F.aggregate(char, F.lit(0), step, lambda r: r == 1)


@dataclass(frozen=True)
class Kind:
    name: str
    regex: str
    valid: Callable[[Column], Column] | None
    score: float
    context: str
    raised: float
    anywhere: bool = False


def _between(n: Column, low: int, high: int) -> Column:
    return (n >= low) & (n <= high)


BASE = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None, 0.9, r"mail|contact|write to|correo|courriel", 1.0),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda m: F.regexp_like(m, F.lit(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")), 0.6, r"\bip\b|address|host|server|adresse", 0.9),
    # [0-9]([\x20-]?[0-9])+, 13 to 19 digits passing Luhn
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])", lambda m: luhn(_digits(m)), 0.8, r"card|visa|credit|karte|carte|tarjeta", 1.0),
    # \+[0-9][\x20().0-9-]+[0-9], 9 to 15 digits
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: _between(F.char_length(_digits(m)), 9, 15), 0.7, r"phone|call|tel|fax|mobile", 1.0),
)
#: Account numbers' lengths by country: the registry's, and those in use beside it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban() -> str:
    known = [f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()]
    other = f"(?!{'|'.join(' '.join(IBAN_LENGTHS.values()).split())})[A-Z]{{2}}[0-9]{{2}}(?:\\x20?[A-Z0-9]){{11,30}}+"
    return f"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})({'|'.join(known)}|{other})(?![A-Za-z0-9])"


ADDED = (
    Kind("iban", _iban(), mod97, 0.9, r"iban|account|konto|compte|cuenta", 1.0, anywhere=True),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", None, 0.3, r"\bssn\b|social security", 0.9),
)
KINDS = BASE + ADDED


def find(docs: DataFrame, text_col: str = "text", name: str = "found") -> DataFrame:
    """All columns and ``name``: an array of spans (start, rank, end, kind, score) by start."""

    def found(rank: int, kind: Kind) -> Column:
        score = lambda m, before: F.when(F.regexp_like(F.lower(before), F.lit(kind.context)), kind.raised).otherwise(kind.score)
        cut = spans.starts if kind.anywhere else spans.parts
        return spans.spans(cut(F.col(f"`{plain}`"), kind.regex), kind.name, rank, kind.valid, score, 0.0 if kind in BASE else ADDED_SCORE, NEAR, kind.anywhere)

    plain, each = fresh(docs, "plain"), [fresh(docs, f"spans{i}") for i in range(len(KINDS))]
    named = docs.withColumn(plain, spans.plain(F.col(f"`{text_col}`")))
    cut = named.select("*", *[found(i, k).alias(c) for i, (k, c) in enumerate(zip(KINDS, each))])
    return cut.select(*[F.col(f"`{c}`") for c in docs.columns], F.array_sort(F.concat(*each)).alias(name))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, the hash of their spans by kind and start, and all spans."""
    ids = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = find(ids).select("id", "found", F.filter("found", lambda s: s["rank"] < len(BASE)).alias("base"))
    by_kind = F.flatten(F.array(*[spans.of_kind(F.col("base"), k.name) for k in BASE]))
    by_kind_all = F.flatten(F.array(*[spans.of_kind(F.col("found"), k.name) for k in KINDS]))
    return out.select(F.col("id").alias(id_col), *[spans.count(F.col("base"), k.name).alias(f"n_{k.name}") for k in BASE],
                      F.sha2(spans.listed(by_kind), 256).alias("base_sha256"), spans.listed(by_kind_all).alias("spans"))


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its [KIND]; null texts stay
    null, ``n_chars`` follows the text where there is one."""
    name = fresh(docs, "found")
    text, some = F.col(f"`{text_col}`"), F.size(name) > 0
    out = find(docs, text_col, name).withColumn(text_col, F.when(some, spans.masked(text, F.col(name))).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(some, F.char_length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
