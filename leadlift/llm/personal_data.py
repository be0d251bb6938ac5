"""Personal data in texts: spans with scores, and texts with the spans masked. DataFrame functions only.

Regular expressions propose spans; checks confirm them (Luhn for cards, mod 97 for bank accounts, value ranges for
addresses, digit counts for phones); words near a span raise its score. Spans of the base kinds that pass their check
always stay. Spans of the further kinds stay if their score reaches ``KEEP``.

The expressions equal the plain ones given beside them, match for match, but never look at a character again and again:
runs are taken without going back, and a run without a match is left as a whole. ``\\G`` lets a match start where the
one before it ended.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift.llm.expressions import let, running

KEEP = 0.5
CONTEXT_BEFORE, CONTEXT_AFTER = 40, 20
NEAR_WORD = 0.3
SPAN = "struct<kind:string,start:int,end:int,score:double>"


@dataclass(frozen=True)
class Kind:
    """What proposes a span, a cheap test that a text can hold one, and what speaks for it."""

    name: str
    pattern: str
    hint: str
    score: float
    words: str
    base: bool = True


KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        0.9,
        "mail|contact|write",
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, "ip|host|server|address"),
    # [0-9]([\x20-]?[0-9])+
    # the hint holds for every run of the 13 digits that the check asks for at least, however they are set apart
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        r"[0-9](?:[\x20-]?[0-9]){12}",
        0.8,
        "card|visa|master|credit|pay",
    ),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, "phone|tel|call|mobile|fax"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)"
        r"(?![A-Za-z0-9])",
        "[A-Z]{2}[0-9]{2}",
        0.9,
        "iban|account|bank",
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
        "[0-9]{3}-[0-9]{2}-",
        0.3,
        "ssn|social security",
        base=False,
    ),
)
BASE = tuple(kind.name for kind in KINDS if kind.base)


def small_number(part: Column) -> Column:
    """Whether a string of digits is at most 255, however many zeros it starts with."""
    digits = F.regexp_replace(part, "^0+(?=.)", "")
    return F.when(F.length(digits) <= 3, F.try_to_number(digits, F.lit("999")) <= 255).otherwise(F.lit(False))


def mod_97(account: Column) -> Column:
    """Remainder of a bank account number, its first four characters moved to the end, letters read as 10 to 35."""
    moved = F.concat(F.substring(account, 5, 1000), F.substring(account, 1, 4))
    values = F.transform(
        F.filter(F.split(moved, ""), lambda c: c != ""),
        lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55),
    )
    return F.aggregate(values, F.lit(0), lambda a, v: F.when(v > 9, a * 100 + v).otherwise(a * 10 + v) % 97)


def passes(kind: Kind, match: Column) -> Column:
    """The check of a proposed span."""
    if kind.name == "ip":
        return F.forall(F.split(match, r"\."), small_number)
    if kind.name == "card":
        return let(
            F.regexp_replace(match, "[ -]", ""),
            lambda d: F.when(F.length(d).between(13, 19), F.call_function("luhn_check", d)).otherwise(F.lit(False)),
        )
    if kind.name == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)
    if kind.name == "iban":
        return mod_97(F.regexp_replace(match, " ", "")) == 1
    return F.lit(True)


def score(kind: Kind, text: Column, start: Column, end: Column) -> Column:
    """The kind's score, raised by one of its words near the span."""
    low = F.greatest(start - CONTEXT_BEFORE, F.lit(0))
    before = F.substring(text, low + 1, start - low)
    after = F.substring(text, end + 1, F.lit(CONTEXT_AFTER))
    near = F.concat(before, F.lit("\n"), after).rlike(rf"(?i)\b(?:{kind.words})")
    return F.when(near, F.lit(min(1.0, kind.score + NEAR_WORD))).otherwise(F.lit(kind.score))


def proposed(kind: Kind, text: Column, matches: Column) -> Column:
    """(match, start) for each match: what lies between matches gives their places."""
    return let(
        F.split(text, kind.pattern, -1),
        lambda b: let(
            F.transform(matches, lambda m, i: F.length(F.get(b, i)) + F.length(m)),
            lambda s: F.zip_with(
                F.zip_with(running(s, F.lit(0), lambda a, x: a + x), s, lambda before, step: before + step),
                matches,
                lambda end, m: F.struct(m.alias("match"), (end - F.length(m)).alias("start"), end.alias("end")),
            ),
        ),
    )


def spans_of(kind: Kind, text: Column) -> Column:
    """Confirmed spans of one kind, in order."""
    nothing = F.array().cast(f"array<{SPAN}>")

    def confirmed(matches: Column) -> Column:
        good = F.filter(proposed(kind, text, matches), lambda s: passes(kind, s["match"]))
        scored = F.transform(
            good,
            lambda s: F.struct(
                F.lit(kind.name).alias("kind"),
                s["start"].cast("int").alias("start"),
                s["end"].cast("int").alias("end"),
                score(kind, text, s["start"], s["end"]).alias("score"),
            ),
        )
        return scored if kind.base else F.filter(scored, lambda s: s["score"] >= KEEP)

    found = let(
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)),
        # most texts' proposals all fail the check: only the others need places
        lambda ms: F.when(F.exists(ms, lambda m: passes(kind, m)), confirmed(ms)).otherwise(nothing),
    )
    return F.when(text.rlike(kind.hint), found).otherwise(nothing).cast(f"array<{SPAN}>")


def find_personal_data(docs: DataFrame, column: str = "pii_spans") -> DataFrame:
    """All columns of ``docs(doc_id, text, ..)`` and ``column``: confirmed spans by kind as listed, then start.

    Starts and ends are code points, ends exclusive. A null or empty text has no spans; repeated rows repeat theirs.
    If ``docs`` has a column of that name already, it is replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn(column, F.concat(*(spans_of(kind, text) for kind in KINDS)))


def span_list(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def mask(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by its (first) kind in brackets."""

    def pieces(s: Column, ends: Column) -> Column:
        kept = F.zip_with(
            s,
            ends,
            lambda x, before: F.when(
                x["start"] >= before,
                F.concat(
                    F.substring(text, before + 1, x["start"] - before), F.lit("["), F.upper(x["kind"]), F.lit("]")
                ),
            ).otherwise(F.lit("")),
        )
        last = F.array_max(F.transform(s, lambda x: x["end"]))
        return F.concat(F.array_join(kept, ""), F.substring(text, last + 1, F.length(text)))

    # of spans that start together the longest comes first
    by_start = F.array_sort(
        F.transform(spans, lambda x: F.struct(x["start"], (-x["end"]).alias("longest"), x["kind"], x["end"]))
    )
    masked = let(
        by_start,
        lambda s: let(
            running(F.transform(s, lambda x: x["end"]), F.lit(0), lambda a, b: F.greatest(a, b)),
            lambda ends: pieces(s, ends),
        ),
    )
    return F.when(F.size(spans) > 0, masked).otherwise(text)


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with the same columns, spans masked in ``text`` and ``n_chars`` (if there) set to the new length.

    A null text stays null, and its n_chars as it is.
    """
    spans = "pii_spans"
    while spans in docs.columns:
        spans += "_"
    out = find_personal_data(docs, spans).withColumn("text", mask(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, length).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
