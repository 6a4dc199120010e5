"""Outlier bands: compare each quote with its cell's price in the adjacent month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.schema import BAND_FACTOR, LEVEL_KEYS
from pricepanel.tables import Table, lookup_join


def within_band(price: Column, reference: Column, factor: float = BAND_FACTOR) -> Column:
    return (price <= reference * factor) & (price >= reference / factor)


def outlier_band_following(
    quotes: DataFrame, following: DataFrame | Table, factor: float = BAND_FACTOR
) -> DataFrame:
    """Keep quotes close to the following month's department price, added as ``pgeo``.

    A quote without such a price is measured against itself, so it stays if it
    is positive. ``following`` holds the unfilled prices of that one month.
    """
    keys = ["codigo_articulo", "Departamento"]
    priced = lookup_join(quotes, _narrow(following, [*keys, "pgeo"]), keys)
    return priced.withColumn("pgeo", F.coalesce("pgeo", "precio_base")).where(
        within_band(F.col("precio_base"), F.col("pgeo"), factor)
    )


def outlier_band_previous(
    quotes: DataFrame,
    previous: DataFrame | Table,
    factor: float = BAND_FACTOR,
    keep_unreferenced: bool = False,
) -> DataFrame:
    """Keep quotes close to the previous month's stored price, given as ``pgeo_ant``.

    The region is part of the key here, and a quote without a previous price is
    dropped unless ``keep_unreferenced`` asks for it to be kept.
    """
    keys = list(LEVEL_KEYS["dep"])
    how = "left" if keep_unreferenced else "inner"
    priced = lookup_join(quotes, _narrow(previous, [*keys, "pgeo_ant"]), keys, how)
    reference = F.col("pgeo_ant")
    if keep_unreferenced:
        reference = F.coalesce(reference, F.col("precio_base"))
    return priced.where(within_band(F.col("precio_base"), reference, factor))


def _narrow(table: DataFrame | Table, columns: list[str]) -> DataFrame | Table:
    if isinstance(table, Table):
        return table.derive(table.df.select(*columns))
    return table.select(*columns)
