"""Column expressions for keys, categories, dates, ids and places.

Everything here is a built-in expression, so it stays inside code generation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def make_key(*parts: Column | str, sep: str = " ") -> Column:
    """Join texts with ``sep``; a NULL part makes the key NULL."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    pieces: list[Column] = []
    for column in columns:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(column.cast("string"))
    return F.concat(*pieces)


def similarity(distance: Column) -> Column:
    """Score of a distance."""
    return 1 - distance


def contains_any(column: Column, *needles: str) -> Column:
    """True where the text holds at least one of the needles."""
    return reduce(lambda a, b: a | b, [column.contains(n) for n in needles])


def none_of(column: Column, values: list[str]) -> Column:
    """Null-safe exclusion: a NULL value is kept."""
    return reduce(lambda a, b: a & b, [~column.eqNullSafe(F.lit(v)) for v in values])


def replace_first(column: Column, old: str, new: str) -> Column:
    """Replace only the first occurrence of a literal text."""
    at = F.instr(column, old)
    return F.when(at > 0, F.overlay(column, F.lit(new), at, F.lit(len(old)))).otherwise(column)


def canonicalise(column: Column, mapping: dict[str, str]) -> Column:
    """Map known spellings to one name; other values pass unchanged."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), column), column)


# Category spellings of the two sources.
CATEGORY_NAMES = {
    "Physics": "Physics",
    "Chemistry": "Chemistry",
    "Physiology or Medicine": "Medicine",
    "Economic Sciences": "Economics",
}


def short_category(column: Column) -> Column:
    """Category as used in prize ids: short spelling, lower case."""
    column = replace_first(column, "Physiology or Medicine", "Medicine")
    return F.lower(replace_first(column, "Economic Sciences", "Economics"))


def strict_long(column: Column) -> Column:
    """Text to integer; under ANSI a bad text fails the query."""
    return column.cast("long")


def strict_date(column: Column) -> Column:
    """``yyyy-MM-dd`` text to date; a bad text fails the query."""
    return F.to_date(column, "yyyy-MM-dd")


def repair_date(column: Column) -> Column:
    """Unknown month or day (``00``) becomes ``01``; what cannot be parsed is NULL."""
    text = F.replace(column, F.lit("-00-00"), F.lit("-01-01"))
    text = F.replace(text, F.lit("-00"), F.lit("-01"))
    return F.try_to_date(text, "yyyy-M-d")


def prefix_id(column: Column, prefix: str) -> Column:
    """Add the prefix unless the id already starts with it."""
    text = column.cast("string")
    return F.when(text.startswith(prefix), text).otherwise(F.concat(F.lit(prefix), text))


def _place_parts(column: Column) -> Column:
    return F.split(column, ", ")


def _is_filled(column: Column) -> Column:
    return column.isNotNull() & (column != "")


def person_city(column: Column) -> Column:
    """City of a person: the first part only if there are exactly two."""
    parts = _place_parts(column)
    return F.when(_is_filled(column) & (F.size(parts) == 2), parts[0]).otherwise(column)


def person_state(column: Column, current: Column | None = None) -> Column:
    """State of a person: the second of exactly two parts, else what was there."""
    parts = _place_parts(column)
    kept = F.lit(None).cast("string") if current is None else current
    return F.when(_is_filled(column) & (F.size(parts) == 2), parts[1]).otherwise(kept)


def affiliation_city(column: Column) -> Column:
    """City of an affiliation: always the first part."""
    return F.when(_is_filled(column), _place_parts(column)[0]).otherwise(column)


def affiliation_state(column: Column, current: Column | None = None) -> Column:
    """State of an affiliation: second of two parts, cleared for other counts."""
    parts = _place_parts(column)
    kept = F.lit(None).cast("string") if current is None else current
    return F.when(
        _is_filled(column), F.when(F.size(parts) == 2, parts[1]).otherwise(F.lit(None))
    ).otherwise(kept)


def kind_from_id(column: Column) -> Column:
    """Person kind from the first letter of the id."""
    return F.when(column.startswith("l"), "laureate").when(column.startswith("s"), "scholar")
