"""String bucketing and extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_like(text: Column, rules: list[tuple[tuple[str, ...], str]], default: str) -> Column:
    """First rule with a matching LIKE pattern wins; NULL text gets the default."""
    out = None
    for patterns, label in rules:
        test = text.like(patterns[0])
        for pattern in patterns[1:]:
            test = test | text.like(pattern)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(default))


def first_below(value: Column, steps: list[tuple[float, str]], default: str) -> Column:
    """First step whose bound exceeds the value wins; NULL gets the default."""
    out = None
    for bound, label in steps:
        test = value < F.lit(bound)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(default))


def extract(text: Column, pattern: str) -> Column:
    """Group 1 of the first match, NULL when nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def age_band(age: Column, null_band: str | None = None) -> Column:
    """Age bucket. A NULL age gives ``null_band``; pass '45+' for what the reference does."""
    banded = first_below(age, [(25, "18-24"), (35, "25-34"), (45, "35-44")], "45+")
    return F.when(age.isNull(), F.lit(null_band).cast("string")).otherwise(banded)


def map_values(text: Column, mapping: dict[str, str]) -> Column:
    """Replace by a small literal map; a value that is not in it becomes NULL."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), text)
