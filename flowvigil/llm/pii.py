"""Personal data: regular expressions propose, checksums confirm, context scores.

Proposals of the base kinds (``email``, ``ip``, ``card``, ``phone``) that pass
their check are always reported. The added kinds are ``iban`` (mod-97) and
``ssn``; they and every base span carry a score that nearby context words raise
or lower, and an added span is reported from ``threshold`` on.

Positions are code points, end exclusive. They come from one split of the text
per kind: the pieces between matches and the matches add up to the text. The
patterns are possessive and start at the edge of a run, so each takes time in
proportion to the text, however long a run of digits or letters is; they find
what the plain expressions of the docstrings find.

Defined cases: a null text is empty, an empty text has no spans, repeated rows
are scanned each for itself, other columns are ignored. No shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

#: Code points before a span in which context words count.
CONTEXT = 48


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    doubled = F.transform(
        F.reverse(F.split(number, "")),
        lambda digit, k: F.when(
            k % 2 == 1,
            F.when(digit.cast("int") > 4, digit.cast("int") * 2 - 9).otherwise(digit.cast("int") * 2),
        ).otherwise(digit.cast("int")),
    )
    total = F.aggregate(doubled, F.lit(0), lambda acc, value: acc + value)
    return (number != "") & (total % 10 == 0)


def mod97(iban: Column) -> Column:
    """Whether an IBAN without blanks passes the mod-97 check."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda acc, sign: F.when(F.ascii(sign) < 58, (acc * 10 + F.ascii(sign) - F.lit(48)) % 97)
        .otherwise((acc * 100 + F.ascii(sign) - F.lit(55)) % 97),
    )
    return rest == 1


def _email(match: Column) -> Column:
    return F.lit(True)


def _ip(match: Column) -> Column:
    return F.forall(
        F.split(match, r"\."),
        lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "").rlike(
            "^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
        ),
    )


def _card(match: Column) -> Column:
    number = digits(match)
    return F.length(number).between(13, 19) & luhn(number)


def _phone(match: Column) -> Column:
    return F.length(digits(match)).between(9, 15)


def _iban(match: Column) -> Column:
    compact = F.replace(match, F.lit(" "), F.lit(""))
    return F.length(compact).between(15, 34) & mod97(compact)


def _ssn(match: Column) -> Column:
    return ~match.rlike("^(?:000|666|9)") & ~match.rlike("-00-") & ~match.rlike("-0000$")


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A substring without which the pattern can't match; spares the search.
    needs: str | None
    confirmed: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True


KINDS = (
    Kind("email", EMAIL, "@", _email, 0.9, "mail|contact|write|@"),
    Kind("ip", IP, ".", _ip, 0.6, "ip|host|server|address|login"),
    Kind("card", CARD, None, _card, 0.7, "card|visa|credit|payment|karte|carte|tarjeta"),
    Kind("phone", PHONE, "+", _phone, 0.7, "phone|tel|call|mobile|fax|whatsapp"),
    Kind("iban", IBAN, None, _iban, 0.8, "iban|bank|account|konto|compte|cuenta", base=False),
    Kind("ssn", SSN, "-", _ssn, 0.3, "ssn|social security|social-security", base=False),
)

#: Words near a span that speak for an example or an identifier.
DOUBT = "example|sample|version|isbn|order no|invoice"


def kind_spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of a kind: ``array<struct<start, end, score>>``, in order."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    # The text before match k is as long as the first k + 1 gaps and k matches.
    lengths = F.zip_with(
        F.transform(gaps, lambda gap: F.length(gap)), F.transform(matches, lambda match: F.length(match)),
        lambda gap, match: F.struct(gap.alias("gap"), F.coalesce(match, F.lit(0)).alias("match")),
    )
    empty = F.array().cast("array<struct<start:int,end:int>>")
    placed = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda acc, step: F.struct(
            (acc["at"] + step["gap"] + step["match"]).alias("at"),
            F.when(
                step["match"] > 0,
                F.array_append(
                    acc["spans"],
                    F.struct(
                        (acc["at"] + step["gap"]).alias("start"),
                        (acc["at"] + step["gap"] + step["match"]).alias("end"),
                    ),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    checked = F.filter(
        F.zip_with(
            placed, matches,
            lambda span, match: F.struct(
                span["start"].alias("start"), span["end"].alias("end"), kind.confirmed(match).alias("ok")
            ),
        ),
        lambda span: span["ok"],
    )
    scored = F.transform(
        checked,
        lambda span: F.struct(
            span["start"].alias("start"), span["end"].alias("end"), _score(text, span, kind).alias("score")
        ),
    )
    none = F.array().cast("array<struct<start:int,end:int,score:double>>")
    seen = F.contains(text, F.lit(kind.needs)) if kind.needs else text.rlike(kind.pattern)
    return F.when(seen, scored).otherwise(none)


def _score(text: Column, span: Column, kind: Kind) -> Column:
    from_point = F.greatest(span["start"] - F.lit(CONTEXT), F.lit(0))
    before = F.lower(F.substring(text, from_point + 1, span["start"] - from_point))
    score = F.lit(kind.score)
    score = score + F.when(before.rlike(rf"(?:{kind.context})"), F.lit(0.3)).otherwise(F.lit(0.0))
    score = score - F.when(before.rlike(rf"(?:{DOUBT})"), F.lit(0.3)).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def _named(spans: Column, kind: Kind) -> Column:
    return F.transform(
        spans,
        lambda span: F.struct(
            F.lit(kind.name).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
            span["score"].alias("score"), F.lit(kind.base).alias("base"),
        ),
    )


def find_pii(
    documents: DataFrame, text: str = "text", threshold: float = 0.5
) -> DataFrame:
    """Add ``pii``: ``array<struct<kind, start, end, score, base>>``, by kind, then start."""
    whole = F.coalesce(F.col(text), F.lit(""))
    found = []
    for kind in KINDS:
        spans = kind_spans(whole, kind)
        if not kind.base:
            spans = F.filter(spans, lambda span: span["score"] >= threshold)
        found.append(_named(spans, kind))
    return documents.withColumn("pii", F.concat(*found))


def mask_pii(text: Column, pii: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlaps go to the earlier span."""
    ordered = F.array_sort(
        F.transform(pii, lambda span: F.struct(
            span["start"].alias("start"), span["end"].alias("end"), span["kind"].alias("kind")))
    )
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    folded = F.aggregate(
        ordered, start,
        lambda acc, span: F.when(span["start"] < acc["at"], acc).otherwise(
            F.struct(
                F.concat(
                    acc["out"], F.substring(text, acc["at"] + 1, span["start"] - acc["at"]),
                    F.lit("["), span["kind"], F.lit("]"),
                ).alias("out"),
                span["end"].alias("at"),
            )
        ),
    )
    return F.concat(folded["out"], F.substring(text, folded["at"] + 1, F.length(text)))
