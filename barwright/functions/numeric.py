"""Column expressions shared by all operators.  Everything here is a built-in
Spark expression, so it stays inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_EXACT = "decimal(38,8)"


def half_up(x: Column, digits: int) -> Column:
    """Round halves away from zero, after removing floating noise below 1e-8.

    Averages of two-digit prices often lie exactly half way between two rounded values;
    without the first step the last bit of the sum would decide.  The decimal keeps every
    digit that a double has down to the eighth place; what it cannot hold (infinite, NaN,
    30 digits and more) has no such digits and stays as it is."""
    return F.coalesce(F.round(x.try_cast(_EXACT), digits).cast("double"), x)


def round_doubles(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Round every double column for presentation; ``special`` overrides per column.  Columns
    of one precision are rounded as one array, which keeps the generated code short however
    wide the frame is."""
    groups: dict[int, list[str]] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, DoubleType):
            groups.setdefault(special.get(f.name, digits), []).append(f.name)
    place = {n: (d, i) for d, names in groups.items() for i, n in enumerate(names)}

    def rounded(names: list[str], to: int) -> Column:
        return F.transform(F.array(*[F.col(f"`{n}`") for n in names]), lambda x: half_up(x, to))

    packed = [rounded(names, d).alias(f"__round_{d}") for d, names in groups.items()]
    rest = [F.col(f"`{c}`") for c in df.columns if c not in place]
    return df.select(*rest, *packed).select(
        *[F.get(F.col(f"__round_{place[c][0]}"), F.lit(place[c][1])).alias(c) if c in place else F.col(f"`{c}`") for c in df.columns]
    )


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` with NULL for a zero divisor, also under ANSI mode."""
    return num / F.nullif(den, F.lit(0.0))


def pct_from(base: Column, value: Column) -> Column:
    """Change from ``base`` to ``value`` in percent."""
    return ratio(value - base, base) * 100.0


def flag(condition: Column) -> Column:
    """0/1 integer; a comparison with NULL counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def month_index(day: Column) -> Column:
    """Running number of the calendar month, so differences are months elapsed."""
    return F.year(day) * 12 + F.month(day)

