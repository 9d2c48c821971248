"""Personal data: patterns propose spans, checksums confirm them, words nearby change the score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Code points before and after a span in which words count.
BEFORE, AFTER = 48, 16
# Spans of the added kinds need this score, in hundredths.
THRESHOLD = 50
# What a text must have for a kind to be looked for: this stands for any digit.
NUMBER = "0-9"
FAVOUR, AGAINST = 40, 30
# Places that one fold adds up before they are joined to those before them.
FOLD = 1024

Check = Callable[[Column, Column, Column], Column]


@dataclass(frozen=True)
class Kind:
    """A kind of span: what proposes it, what confirms it, and what its score depends on.

    ``pattern`` finds what ``plain`` finds, but in linear time: a run of characters is tried
    from its beginning only, and no quantifier gives back. ``check`` gets the span and what is
    before and after it. Words that favour it count on both sides, words against it only
    before. A base kind stays whatever its score.
    """

    name: str
    plain: str
    pattern: str
    needs: str
    check: Check
    base: bool
    prior: int
    favour: str
    against: str


def _digits(span: Column) -> Column:
    return F.translate(span, " -", "")


def _fold(text: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Fold the characters of a non-empty text, the last first, with their places from 1."""
    places = F.sequence(F.lit(1), F.length(text))
    return F.aggregate(
        places, F.lit(0), lambda acc, i: acc + step(F.substring(text, -i, F.lit(1)), i)
    )


def luhn(digits: Column) -> Column:
    """The Luhn check of a text of digits."""

    def step(digit: Column, i: Column) -> Column:
        value = digit.cast("int")
        double = F.when(value > 4, 2 * value - 9).otherwise(2 * value)
        return F.when(i % 2 == 0, double).otherwise(value)

    return _fold(digits, step) % 10 == 0


def mod97(account: Column) -> Column:
    """The check of an account number: letters are 10 to 35, and the first four come last."""
    turned = F.concat(F.substring(account, 5, 64), F.left(account, F.lit(4)))
    places = F.sequence(F.lit(1), F.length(turned))

    def step(acc: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code > 57, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(places, F.lit(0), step) == 1


def _proper_ip(span: Column, before: Column, after: Column) -> Column:
    def part(text: Column) -> Column:
        short = F.ltrim(text, F.lit("0"))
        return F.when(F.length(short) <= 3, F.coalesce(short.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(span, r"\."), lambda p: F.coalesce(part(p), F.lit(False)))


def _proper_card(span: Column, before: Column, after: Column) -> Column:
    digits = _digits(span)
    return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))


def _proper_phone(span: Column, before: Column, after: Column) -> Column:
    return F.length(F.translate(span, "+ ().-", "")).between(10, 15)


def _any(span: Column, before: Column, after: Column) -> Column:
    return F.lit(True)


def _alone(left: str, right: str) -> Check:
    """Neither follows what ends like ``left`` nor goes on like ``right``."""

    def check(span: Column, before: Column, after: Column) -> Column:
        return ~before.rlike(f"(?:{left})$") & ~after.rlike(f"^(?:{right})")

    return check


def _proper_account(span: Column, before: Column, after: Column) -> Column:
    account = F.translate(span, " ", "")
    fits = F.length(account).between(15, 34)
    apart = _alone("[A-Za-z0-9]", "[A-Za-z0-9]")(span, before, after)
    return F.when(fits & apart, mod97(account)).otherwise(F.lit(False))


LOCAL = "[A-Za-z0-9._%+-]"
LABEL = "[A-Za-z0-9-]"
# The base patterns, and the words that make a kind likelier or less likely.
KINDS = (
    Kind(
        "email",
        rf"{LOCAL}+@{LABEL}+(\.{LABEL}+)+",
        rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
        "@",
        _any,
        True,
        90,
        "mail|email|contact|write|from|to",
        "example|test|noreply",
    ),
    Kind(
        "ip",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        NUMBER,
        _proper_ip,
        True,
        60,
        "ip|address|host|server|login|client",
        "version|release|section|chapter",
    ),
    Kind(
        "card",
        r"[0-9]([\x20-]?[0-9])+",
        r"[0-9](?:[\x20-]?[0-9])++",
        NUMBER,
        _proper_card,
        True,
        80,
        "card|visa|mastercard|amex|credit|debit|payment",
        "isbn|order|tracking|serial",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "+",
        _proper_phone,
        True,
        70,
        "phone|tel|telephone|call|mobile|cell|fax",
        "equals|sum|version",
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}([A-Z0-9]{11,30}|(\x20[A-Z0-9]{4}){2,7}(\x20[A-Z0-9]{1,3})?)",
        r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)",
        NUMBER,
        _proper_account,
        False,
        80,
        "iban|account|bank|transfer|konto|compte|cuenta",
        "example|test|serial",
    ),
    Kind(
        "national_id",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        NUMBER,
        _alone(r"[0-9][\x20-]?", r"[\x20-]?[0-9]"),
        False,
        30,
        "ssn|social security|social security number|tax id",
        "isbn|order|part|serial|version",
    ),
    Kind(
        "local_phone",
        r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}",
        r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}",
        NUMBER,
        _alone(r"[0-9+][\x20().-]*", r"[.-]?[0-9]"),
        False,
        30,
        "phone|tel|telephone|call|mobile|cell|fax",
        "isbn|order|part|serial|version",
    ),
)
SPAN = "struct<start:int,rank:int,end:int,kind:string,score:double>"


def _places(gaps: Column, hits: Column) -> Column:
    """(start, end) of every hit, from the lengths of hits and of the gaps between them.

    Folded in stretches, as a fold copies what it has gathered at every step.
    """
    kind = "array<struct<start:int,end:int>>"
    steps = F.transform(
        hits,
        lambda hit, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), F.length(hit).alias("hit")),
    )

    def add(acc: Column, step: Column) -> Column:
        start = acc["at"] + step["gap"]
        end = start + step["hit"]
        place = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(place)).alias("out"))

    def stretch(acc: Column, first: Column) -> Column:
        begin = F.struct(acc["at"].alias("at"), F.array().cast(kind).alias("out"))
        found = F.aggregate(F.slice(steps, first, FOLD), begin, add)
        joined = F.transform(
            F.array(found),
            lambda part: F.struct(
                part["at"].alias("at"), F.concat(acc["out"], part["out"]).alias("out")
            ),
        )
        return F.get(joined, F.lit(0))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    firsts = F.sequence(F.lit(1), F.size(hits), F.lit(FOLD))
    return F.aggregate(firsts, begin, stretch)["out"]


def _mentions(near: Column, words: str) -> Column:
    return near.rlike(f"(?i)(^|[^A-Za-z])({words})([^A-Za-z]|$)")


def _spans(kind: Kind, rank: int, gaps: Column, hits: Column, places: Column) -> Column:
    """The spans of a kind that stand its check, with their scores."""

    def span(hit: Column, i: Column) -> Column:
        before = F.right(F.get(gaps, i), F.lit(BEFORE))
        # Right behind another hit of the kind, the hit itself is what goes before.
        before = F.when((i > 0) & (before == ""), "0").otherwise(before)
        after = F.left(F.get(gaps, i + 1), F.lit(AFTER))
        near = F.concat(before, F.lit(" "), after)
        score = F.least(
            F.lit(100),
            F.lit(kind.prior)
            + F.when(_mentions(near, kind.favour), FAVOUR).otherwise(0)
            - F.when(_mentions(before, kind.against), AGAINST).otherwise(0),
        )
        good = kind.check(hit, before, after)
        if not kind.base:
            good = good & (score >= THRESHOLD)
        place = F.get(places, i)
        return F.when(
            good,
            F.struct(
                place["start"].alias("start"),
                F.lit(rank).alias("rank"),
                place["end"].alias("end"),
                F.lit(kind.name).alias("kind"),
                (score / 100).alias("score"),
            ),
        )

    return F.filter(F.transform(hits, span), lambda s: s.isNotNull())


def find_personal(
    docs: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS
) -> DataFrame:
    """Add ``spans`` to every row: array of (start, rank, end, kind, score), in order.

    Places are code points, the end exclusive; ``rank`` is the kind's place in ``kinds``. Spans
    of one kind are leftmost and do not overlap; those of different kinds may. A span is kept
    if its checksum holds (Luhn, mod 97, parts of an address, number of digits) and, for kinds
    that are not base, if its score with the words around it reaches 0.5. Base spans are always
    kept. A NULL or empty text has none. Nothing is shuffled; repeated rows are found alike; a
    column named ``spans`` in the input is replaced; an empty input gives no rows.
    """
    docs = docs.drop("spans")
    # The input's columns travel in one, so that none can be taken for a column made here.
    rows = docs.select(
        F.struct(*docs.columns).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    )
    text = F.col("_text")
    rows = rows.withColumn("_number", text.rlike("[0-9]"))
    none = F.array().cast("array<string>")
    rows = rows.withColumns(
        {
            f"_hits{rank}": F.when(
                F.col("_number") if kind.needs == NUMBER else text.contains(kind.needs),
                F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)),
            ).otherwise(none)
            for rank, kind in enumerate(kinds)
        }
    )
    found = {
        rank: (F.col(f"_gaps{rank}"), F.col(f"_hits{rank}"), F.col(f"_places{rank}"))
        for rank in range(len(kinds))
    }
    rows = rows.withColumns(
        {
            f"_gaps{rank}": F.when(F.size(hits) > 0, F.split(text, kinds[rank].pattern, -1)).otherwise(none)
            for rank, (_, hits, _) in found.items()
        }
    ).drop("_text", "_number")
    rows = rows.withColumns(
        {
            f"_places{rank}": F.when(F.size(hits) > 0, _places(gaps, hits))
            for rank, (gaps, hits, _) in found.items()
        }
    )
    spans = [
        F.when(F.size(hits) > 0, _spans(kinds[rank], rank, gaps, hits, places)).otherwise(
            F.array().cast(f"array<{SPAN}>")
        )
        for rank, (gaps, hits, places) in found.items()
    ]
    return rows.select(
        *(F.col("_doc").getField(name).alias(name) for name in docs.columns),
        F.array_sort(F.concat(*spans)).alias("spans"),
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    one = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(one, ",")


def of_kinds(spans: Column, names: list[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(names))
