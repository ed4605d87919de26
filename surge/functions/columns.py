"""Column expressions shared by the operators.  All stay JVM-side (no UDFs)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_double() -> Column:
    return F.lit(None).cast("double")


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN is a value in Spark (it compares greater than every number and
    poisons ``avg``); the reference treats it as missing.  Used at ingest."""
    c = col(c).cast("double")
    return F.when(F.isnan(c), null_double()).otherwise(c)


def coerce_numeric(c: ColumnOrName) -> Column:
    """Lenient text -> double: anything unparsable becomes NULL.

    ``try_cast`` already turns '1,234', '' and 'abc' into NULL and accepts
    ' 5 ' and '1e3'; it also accepts Java float suffixes ('1.0d', '2f') that a
    strict decimal parser rejects, so those are refused first.
    """
    s = F.trim(col(c).cast("string"))
    parsed = s.try_cast("double")
    return F.when(s.rlike(r"(?i)[0-9.][df]$"), null_double()).otherwise(nan_to_null(parsed))


def canonical_key(c: ColumnOrName) -> Column:
    """Key canonicalisation: trim + lower case."""
    return F.lower(F.trim(col(c).cast("string")))


def parse_date(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Date from text or timestamp; unparsable text becomes NULL."""
    c = col(c)
    if fmt:
        return F.try_to_timestamp(c.cast("string"), F.lit(fmt)).cast("date")
    return c.cast("string").try_cast("timestamp").cast("date")


#: Date formats of the feeds, tried in this order: ISO days and times, then the month-first form of city exports.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "M/d/yyyy", "M/d/yyyy h:mm:ss a", "d MMM yyyy")


#: What a text of a format looks like at least; a format is tried only on such texts, as a failed parse costs an exception.
_YEAR = "[+-]?[0-9]{4,}"
DATE_SHAPES = {
    "yyyy-MM-dd": f"^{_YEAR}-[0-9]{{2}}-[0-9]{{2}}$",
    "yyyy-MM-dd'T'HH:mm:ss": f"^{_YEAR}-[0-9]{{2}}-[0-9]{{2}}[Tt][0-9:]+$",
    "yyyy-MM-dd HH:mm:ss": f"^{_YEAR}-[0-9]{{2}}-[0-9]{{2}} [0-9:]+$",
    "yyyy/MM/dd": f"^{_YEAR}/[0-9]{{2}}/[0-9]{{2}}$",
    "M/d/yyyy": f"^[0-9]+/[0-9]+/{_YEAR}$",
    "M/d/yyyy h:mm:ss a": f"^[0-9]+/[0-9]+/{_YEAR} [0-9:]+ .+$",
    "d MMM yyyy": f"^[0-9]+ .+ {_YEAR}$",
}


def parse_dates(c: ColumnOrName, formats: Iterable[str] = DATE_FORMATS) -> Column:
    """Date from text by the first of several formats that fits (white space around it ignored); NULL when none does.

    Other ISO forms that a cast accepts (fractions, zones) come last, so a format never changes what is plain ISO."""
    s = F.trim(col(c).cast("string"))

    def by(fmt: str) -> Column:
        day = F.try_to_timestamp(s, F.lit(fmt)).cast("date")
        return F.when(s.rlike(DATE_SHAPES[fmt]), day) if fmt in DATE_SHAPES else day

    tried = [by(f) for f in formats]
    return F.coalesce(*tried, parse_date(s))


def sanitize_name_expr(c: ColumnOrName, prefix: str = "AQ_") -> Column:
    """Pivot-value sanitising: space -> '_', drop '(' ')' '.', add prefix."""
    return F.concat(F.lit(prefix), F.translate(F.regexp_replace(col(c), " ", "_"), "().", ""))


def sanitize_name(name: str, prefix: str = "AQ_") -> str:
    return prefix + re.sub(r"[().]", "", name.replace(" ", "_"))


def rowwise_mean(cols: Iterable[ColumnOrName]) -> Column:
    """Mean of the non-missing values of a row; NULL if all are missing."""
    cols = [col(c) for c in cols]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    present = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in cols), F.lit(0))
    return F.try_divide(total, present.cast("double"))


def season(month: ColumnOrName) -> Column:
    """12,1,2 -> 1 (winter); 3-5 -> 2; 6-8 -> 3; 9-11 -> 4."""
    return (F.floor((col(month) % 12) / 3) + 1).cast("int")


def pct_change(value: ColumnOrName, base: ColumnOrName) -> Column:
    """(value - base) / base * 100; NULL when the base is 0 or missing."""
    return F.try_divide(col(value) - col(base), col(base)) * 100.0


def flag(cond: Column) -> Column:
    """Missing-safe predicate: a NULL comparison counts as false."""
    return F.coalesce(cond, F.lit(False))
