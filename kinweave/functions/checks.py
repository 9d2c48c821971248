"""Record validation: required fields and value domains."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Validated(NamedTuple):
    valid: DataFrame
    rejected: DataFrame  # input columns plus ``errors: array<string>``


def error_list(required: list[str], domain: dict[str, list[str]] | None = None) -> Column:
    """Array of messages, empty for a valid row."""
    found = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required]
    for name, allowed in (domain or {}).items():
        found.append(
            F.when(
                F.col(name).isNotNull() & ~F.col(name).isin(allowed), F.lit(f"bad {name}")
            )
        )
    return F.array_compact(F.array(*found))


def validate(
    df: DataFrame,
    required: list[str],
    domain: dict[str, list[str]] | None = None,
    on_error: str = "fail",
) -> Validated:
    """Split rows into valid and rejected ones.

    ``fail`` aborts the query at the first bad row, ``quarantine`` returns both parts.
    Columns outside ``required`` and ``domain`` are not looked at.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    marked = df.withColumn("errors", error_list(required, domain))
    rejected = marked.filter(F.size("errors") > 0)
    if on_error == "quarantine":
        return Validated(marked.filter(F.size("errors") == 0).drop("errors"), rejected)
    # The raise sits inside the filter, so no later projection can prune it away.
    stop = F.raise_error(F.concat(F.lit("invalid record: "), F.array_join("errors", ", ")))
    passed = marked.filter(F.when(F.size("errors") == 0, F.lit(True)).otherwise(stop.cast("boolean")))
    return Validated(passed.drop("errors"), rejected)


def vector_ok(vector: Column, dim: int | None = None) -> Column:
    """True for a vector of finite elements, and of the declared length if there is one."""
    # NaN is above all numbers: the ends of the range tell of it and of infinite elements.
    top, low, inf = F.array_max(vector), F.array_min(vector), F.lit(float("inf"))
    ends = F.isnan(top) | (F.abs(top) == inf) | (F.abs(low) == inf)
    bad = F.exists(vector, lambda x: x.isNull()) | F.coalesce(ends, F.lit(False))
    fits = F.lit(True) if dim is None else F.size(vector) == dim
    return F.coalesce(vector.isNotNull() & fits & ~bad, F.lit(False))
