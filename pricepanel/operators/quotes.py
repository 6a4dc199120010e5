"""Row-level operators on price quotes. None of them moves data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.functions import columns as C
from pricepanel.schema import REGIME, REGIME_PERIODS, Period


def period_quotes(quotes: DataFrame, period: Period) -> DataFrame:
    """Quotes of one month; a partition filter on a table stored by anio and mes."""
    return quotes.where(C.in_period(period))


def regime_filter(
    quotes: DataFrame,
    periods: Iterable[Period] = REGIME_PERIODS,
    regime: str = REGIME,
) -> DataFrame:
    """In the given months keep only quotes of the price regime; other months pass."""
    # A quote without regime or month makes the test null; only the listed months may drop it.
    listed = F.coalesce(C.in_periods(periods), F.lit(False))
    return quotes.where(~listed | (F.col("tipo_precio") == regime))


def with_base_price(quotes: DataFrame) -> DataFrame:
    """Add ``precio_base``, the price of the variety's base quantity."""
    return quotes.withColumn(
        "precio_base",
        C.base_price(F.col("precio_actual"), F.col("cantidad_base"), F.col("cantidad_actual")),
    )


def valid_quotes(quotes: DataFrame) -> DataFrame:
    """Add ``precio_base`` and drop quotes in which it is missing or zero."""
    priced = with_base_price(quotes)
    return priced.where(F.col("precio_base").isNotNull() & (F.col("precio_base") != 0))


def with_product_code(df: DataFrame) -> DataFrame:
    """Add ``cod_prod``, derived from the variety code."""
    return df.withColumn("cod_prod", C.product_code(F.col("codigo_articulo")))


def normalize_region(df: DataFrame) -> DataFrame:
    """Turn ``region`` into an integer, null where it is not a number."""
    return df.withColumn("region", C.region_number(F.col("region")))


def with_previous_period(df: DataFrame) -> DataFrame:
    """Add ``anio_ant`` and ``mes_ant``, the month before (anio, mes)."""
    before = C.period_ordinal(F.col("anio"), F.col("mes")) - 1
    return df.withColumns({"anio_ant": C.year_of(before), "mes_ant": C.month_of(before)})
