"""Column expressions shared by all layers. Built-ins only, no UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = "yyyy-MM-dd"


# --- tolerant typing: bad text becomes null instead of failing the job ---------------------


def tolerant_cast(name: str, dtype: str) -> Column:
    return F.trim(F.col(name)).try_cast(dtype)


def tolerant_date(name: str, fmt: str = ISO_DATE) -> Column:
    """Text in exactly the given format to a date, anything else to null.

    The usual ISO form is checked digit by digit and cast, which is several times faster
    than parsing with a pattern.
    """
    text = F.trim(F.col(name))
    if fmt != ISO_DATE:
        return F.try_to_date(F.nullif(text, F.lit("")), fmt)
    shape = F.translate(text, "0123456789", "9999999999")
    return F.when(shape == "9999-99-99", text.try_cast("date"))


# --- text ----------------------------------------------------------------------------------


def title(name: str) -> Column:
    return F.initcap(F.trim(F.col(name)))


def code(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def null_or_blank(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(F.col(name)) == "")


def gender_label(name: str) -> Column:
    return F.when(F.col(name) == "M", "Male").when(F.col(name) == "F", "Female").otherwise("Other")


# --- dates ---------------------------------------------------------------------------------


def date_key(day: Column) -> Column:
    """yyyymmdd as int, by arithmetic rather than through text."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def age_in_years(birth: Column, as_of: Column) -> Column:
    return F.floor(F.datediff(as_of, birth) / 365).cast("int")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def fiscal_year(day: Column) -> Column:
    """Year in which the April-to-March fiscal year of `day` began."""
    return F.year(F.add_months(day, -3))


def fiscal_quarter(day: Column) -> Column:
    return F.quarter(F.add_months(day, -3))


# --- keys ----------------------------------------------------------------------------------


def surrogate_key(*parts: Column) -> Column:
    """Positive bigint that depends on the business key alone.

    60 bits of md5, so a rerun, another partitioning or another cluster gives the same key.
    About one collision is expected per 1.5 billion keys; the uniqueness checks watch for it.
    """
    key = parts[0].cast("string") if len(parts) == 1 else F.concat_ws("|", *parts)
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def tracked_hash(columns: Sequence[str]) -> Column:
    """Digest of the tracked columns that tells null from empty text."""
    marked = [
        F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns
    ]
    return F.sha2(F.to_json(F.array(*marked)), 256)


# --- finance -------------------------------------------------------------------------------


def equated_instalment(principal: Column, annual_rate: Column, months: Column) -> Column:
    """Monthly instalment P*r*(1+r)^n / ((1+r)^n - 1); a zero rate repays evenly."""
    p, n = principal.cast("double"), months.cast("double")
    r = annual_rate.cast("double") / F.lit(1200.0)
    growth = F.pow(F.lit(1.0) + r, n)
    return F.round(F.when(r == 0, F.try_divide(p, n)).otherwise(
        F.try_divide(p * r * growth, growth - 1)), 2)


def sales_profit(units: Column, price: Column, margin_pct: Column) -> Column:
    """units * price * margin percent, half-up to cents in decimal arithmetic."""
    revenue = units.cast("decimal(10,0)") * price.cast("decimal(12,2)")
    return (revenue * margin_pct.cast("decimal(5,2)") * F.lit("0.01").cast("decimal(3,2)")).cast(
        "decimal(14,2)"
    )


def segment_for(amount: Column) -> Column:
    return (
        F.when(amount >= 1_000_000, "PLATINUM")
        .when(amount >= 500_000, "GOLD")
        .when(amount >= 100_000, "SILVER")
        .otherwise("BASIC")
    )


def share(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to two places; one division, so exact halves round up."""
    return F.round(share(part.cast("double") * 100, whole), 2)


def round_half_up(value: Column, places: int) -> Column:
    """Half-up rounding of a double after dropping binary noise beyond ten places."""
    return F.round(value.cast("decimal(28,10)"), places)
