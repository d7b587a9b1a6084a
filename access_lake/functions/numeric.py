"""Safe casts, rates, bands and scores (JVM-side expressions)."""

from __future__ import annotations

from decimal import Decimal
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from access_lake.functions import fixed
from access_lake.functions.text import ColumnLike, col


def _number(c: ColumnLike) -> Column:
    """Text → double or NULL. Java's type suffixes ('12d', '1.5F') are no
    numbers; a text that ends with a digit has none."""
    text = F.trim(col(c).cast("string"))
    suffix = ~F.substring(text, -1, 1).between("0", "9") & text.rlike("[0-9.][dDfF]$")
    return F.when(~suffix, text.try_cast("double"))


def safe_float(c: ColumnLike, default: float = 0.0) -> Column:
    """Text → double, anything unparsable or missing → default (STD-2).
    'NaN' and 'inf' text stay, as Python's float() keeps them."""
    return F.coalesce(_number(c), F.lit(default))


def safe_int(c: ColumnLike, default: int = 0) -> Column:
    """Text → int through a double, so '12.7' → 12 (STD-3)."""
    return F.coalesce(_number(c).try_cast("int"), F.lit(default))


def safe_int_commas(c: ColumnLike, default: int = 0, type_: str = "bigint") -> Column:
    """Integer text with thousands separators; fractions such as '1234.0'
    are rejected like Python's int() does (STD-4)."""
    return F.coalesce(
        F.trim(F.regexp_replace(col(c).cast("string"), ",", "")).try_cast(type_),
        F.lit(default).cast(type_))


def truthy(c: ColumnLike) -> Column:
    """A payload value that was read as text → boolean (STD-5): missing,
    empty, 'false' and zero are false, any other text, a blank too, is true.
    Text cannot tell ``"false"`` from ``false``; :func:`truthy_json` can."""
    text = F.lower(col(c).cast("string"))
    return F.coalesce(~text.isin("", "false", "0", "0.0"), F.lit(False))


def truthy_json(c: ColumnLike) -> Column:
    """A JSON value read as VARIANT → boolean (STD-5): missing, null, false,
    zero of any spelling and empty text, list or object are false, any other
    value is true, so ``"false"``, ``"0"`` and ``" "`` are."""
    return F.coalesce(~F.to_json(col(c)).isin("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}"), F.lit(False))


def has_gps(lat: ColumnLike, lon: ColumnLike) -> Column:
    """Both coordinates non-zero (STD-10)."""
    return (col(lat) != 0.0) & (col(lon) != 0.0)


def count_if(cond: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)``: NULL counts as 0."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def rate_per(n: ColumnLike, pop: ColumnLike, per: int, digits: int = 2) -> Column:
    """``round(n / nullif(pop, 0) * per, digits)`` in double (SCL-6); a
    zero or missing population gives NULL, never a division error."""
    return F.round(col(n).cast("double") / F.nullif(col(pop), F.lit(0)) * F.lit(per), digits)


def ratio(n: ColumnLike, pop: ColumnLike) -> Column:
    """Unrounded ``n / nullif(pop, 0)``, the ranking key of the marts."""
    return col(n).cast("double") / F.nullif(col(pop), F.lit(0))


def below(c: ColumnLike, threshold: int) -> Column:
    """Threshold flag, NULL → false (SCL-8, SCL-17)."""
    return F.coalesce(col(c) < threshold, F.lit(False))


def is_zero(c: ColumnLike) -> Column:
    """Zero flag, NULL → false (SCL-9, SCL-17)."""
    return F.coalesce(col(c) == 0, F.lit(False))


def band(c: ColumnLike, bands: Iterable[tuple[float, int]] = fixed.DENSITY_BANDS,
         default: int = fixed.DENSITY_BAND_DEFAULT) -> Column:
    """Banded points: first upper bound the value is below wins; NULL falls
    to the default (SCL-10)."""
    src = col(c)
    out = None
    for upper, pts in bands:
        out = F.when(src < upper, F.lit(pts)) if out is None else out.when(src < upper, F.lit(pts))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def severity(band_points: Column, weights: dict[str, int] = fixed.SEVERITY_WEIGHTS) -> Column:
    """Band points plus a weight per true flag (SCL-11)."""
    total = band_points
    for flag, w in weights.items():
        total = total + F.when(F.col(flag), F.lit(w)).otherwise(F.lit(0))
    return total


def baseline_gap(pop: ColumnLike, n: ColumnLike,
                 per_10k: str = fixed.BASELINE_PER_10K) -> Column:
    """Facilities still needed to reach ``per_10k`` facilities per 10,000
    people (SCL-7).

    The reference divides decimals at the scale of the literal, so the
    quotient is rounded half-up to one decimal before ``ceil``; Spark keeps
    more scale, hence the explicit ``round(…, 1)``. ``greatest`` there is
    NULL when the population is NULL, unlike Spark's, hence the ``when``.
    """
    p = col(pop)
    rate = F.lit(Decimal(per_10k))
    needed = F.ceil(F.round(rate * p.cast("decimal(20,0)") / F.lit(10000), 1))
    return (F.when(p.isNull(), F.lit(None).cast("int"))
            .otherwise(F.greatest(F.lit(0), (needed - col(n)).cast("int"))))


def project_population(p: ColumnLike, growth: ColumnLike, years: ColumnLike) -> Column:
    """Compound growth ``round(p * (1 + g) ^ years)`` as bigint (SCL-15)."""
    return F.round(col(p) * F.pow(F.lit(1.0) + col(growth), col(years))).cast("bigint")


def severity_label(score: ColumnLike, labels: Iterable[tuple[int, str]] = fixed.SEVERITY_LABELS) -> Column:
    src = col(score)
    out = None
    for threshold, label in labels:
        out = F.when(src == threshold, F.lit(label)) if out is None else out.when(src == threshold, F.lit(label))
    return out if out is not None else F.lit(None).cast("string")

