"""Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from equitrace.spec import PILLAR_SUFFIX

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b; a zero or missing denominator gives null (never an error, inf or NaN)."""
    return F.try_divide(as_col(a), as_col(b))


def num(c: ColumnOrName) -> Column:
    """Text to double; text that is no number, and NaN, give null."""
    d = as_col(c).try_cast("double")
    return F.when(~F.isnan(d), d)


def total(c: ColumnOrName, places: int = 4) -> Column:
    """Sum without the float noise that depends on how the rows were partitioned."""
    return F.round(F.sum(c), places)


def half_even(c: ColumnOrName, places: int) -> Column:
    """Round to even on ties; the inner rounding removes float noise around a tie."""
    return F.bround(F.round(c, 9), places)


def clip(v: ColumnOrName, low: ColumnOrName, high: ColumnOrName) -> Column:
    """Winsorise; a null value stays null and a null bound does not cap."""
    v = as_col(v)
    return F.when(v.isNotNull(), F.least(F.greatest(v, as_col(low)), as_col(high)))


def mean_of_present(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Row mean of two columns that skips nulls."""
    a, b = as_col(a), as_col(b)
    return F.coalesce((a + b) / F.lit(2.0), a, b)


def clean_name(c: ColumnOrName) -> Column:
    """Metric names: ' - ' and blanks become '_', all lower case."""
    return F.lower(F.replace(F.replace(as_col(c), F.lit(" - "), F.lit("_")), F.lit(" "), F.lit("_")))


def title_case(c: ColumnOrName) -> Column:
    """Capital after every non-letter, not only after blanks."""
    pieces = F.split(F.lower(as_col(c)), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(pieces, F.initcap), "")


def percent_text(c: ColumnOrName) -> Column:
    return F.format_string("%.1f%%", half_even(c, 1))


def with_suffix(c: ColumnOrName, suffix: str = PILLAR_SUFFIX) -> Column:
    c = as_col(c)
    return F.when(c.endswith(suffix), c).otherwise(F.concat(c, F.lit(suffix)))


def without_suffix(c: ColumnOrName, suffix: str = PILLAR_SUFFIX) -> Column:
    return F.regexp_replace(as_col(c), f"{suffix}$", "")


def lookup(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Replace listed values; others stay as they are."""
    c = as_col(c)
    out = F.lit(None).cast("string")
    for old, new in mapping.items():
        out = F.when(c == old, F.lit(new)).otherwise(out)
    return F.coalesce(out, c)


def draw_key(keys: Sequence[ColumnOrName], seed: ColumnOrName) -> Column:
    """Seeded pseudo-random text per key: the same on every engine and every retry."""
    parts = [as_col(k).cast("string") for k in keys]
    seed_col = as_col(seed) if isinstance(seed, Column) else F.lit(seed)
    return F.md5(F.concat_ws("~", *parts, seed_col.cast("string")))


def week_ending(d: ColumnOrName) -> Column:
    """Saturday that closes the week of a date."""
    return F.next_day(F.date_sub(as_col(d).cast("date"), 1), "SAT")


def month_start(d: ColumnOrName) -> Column:
    return F.trunc(as_col(d).cast("date"), "month")
