"""Column expressions: means, codes, safe casts and period arithmetic.

All of them are built-in Spark expressions, so they stay inside generated code.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricepanel.schema import BY_WEIGHT_CODES, LONG_PRODUCT_CODE, SHORT_PRODUCT_CODE, Period


def ln_positive(x: Column) -> Column:
    """Logarithm of positive values, null otherwise."""
    return F.when(x > 0, F.ln(x))


def geo_mean(x: Column) -> Column:
    """Geometric mean of the positive values; null if there is none."""
    return F.exp(F.avg(ln_positive(x)))


def w_geo_mean(x: Column, w: Column) -> Column:
    """Weighted geometric mean.

    A missing value drops out of the numerator while its weight stays in the
    denominator, so a group of missing values only has mean exp(0) = 1.
    """
    total = F.coalesce(F.sum(w * ln_positive(x)), F.lit(0.0))
    return F.exp(F.try_divide(total, F.sum(w)))


def base_price(price: Column, base_quantity: Column, quantity: Column) -> Column:
    """Price of the base quantity; null for a zero or missing quantity."""
    return F.nanvl(F.try_divide(price * base_quantity, quantity), F.lit(None).cast("double"))


def product_code(code: Column) -> Column:
    """Variety code without its last character, the one longer code shortened twice."""
    cut = F.substring(code, F.lit(1), F.length(code) - 1)
    return F.when(cut == LONG_PRODUCT_CODE, F.lit(SHORT_PRODUCT_CODE)).otherwise(cut)


def is_by_weight(codes: Iterable[str] = BY_WEIGHT_CODES) -> Column:
    """True for by-weight varieties; a null code is not one of them."""
    # One expression as text: a literal for each code would be as many calls to the driver's JVM.
    listed = ", ".join("'" + code.replace("\\", "\\\\").replace("'", "\\'") + "'" for code in codes)
    return F.expr(f"coalesce(codigo_articulo IN ({listed}), false)" if listed else "false")


def region_number(region: Column) -> Column:
    """Region as an integer, null where it is not a number."""
    return region.try_cast("int")


def period_ordinal(anio: Column, mes: Column) -> Column:
    return anio * 12 + mes


def year_of(ordinal: Column) -> Column:
    return F.floor((ordinal - 1) / 12).cast("int")


def month_of(ordinal: Column) -> Column:
    return ((ordinal - 1) % 12 + 1).cast("int")


def in_period(period: Period) -> Column:
    """Predicate on the bare partition columns, so that partitions are pruned."""
    return in_periods([period])


# Runs of months longer than this are bounded instead of listed.
_LISTED = 24


def in_periods(periods: Iterable[Period]) -> Column:
    """Like ``in_period`` for any of several months."""
    wanted = sorted(set(periods))
    if len(wanted) > _LISTED and wanted[-1].ordinal - wanted[0].ordinal == len(wanted) - 1:
        years = f"anio BETWEEN {wanted[0].anio} AND {wanted[-1].anio}"
        months = f"anio * 12 + mes BETWEEN {wanted[0].ordinal} AND {wanted[-1].ordinal}"
        return F.expr(f"{years} AND {months}")
    listed = (f"(anio = {p.anio} AND mes = {p.mes})" for p in wanted)
    return F.expr(" OR ".join(listed) or "false")
