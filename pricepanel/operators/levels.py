"""Average prices at the four levels: department, region, variety, product."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.functions import columns as C
from pricepanel.operators.presentation import CELL, SIZE, vote_size
from pricepanel.operators.quotes import with_product_code
from pricepanel.schema import BY_WEIGHT_CODES, LEVEL_ATTRIBUTES, LEVEL_KEYS, PERIOD

# Attributes that follow from a cell. The first pass over the quotes groups by them instead of
# taking a minimum: text in an aggregation buffer would make Spark sort the quotes.
_CELL_ATTRIBUTES = ("region", "cantidad_base", "articulo", "producto_nombre")
_DEP_COLUMNS = (
    "codigo_articulo", "Departamento", "pgeo", "n", "producto_nombre",
    "cant_base", "articulo", "region", "mes", "anio",
)


def _sums_by_attributes(quotes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count and logarithm sums per key and attributes, in one hash aggregation."""
    return quotes.groupBy(*keys, *_CELL_ATTRIBUTES).agg(
        F.expr("count(*) AS n"),
        F.expr("count_if(precio_base > 0) AS n_positive"),
        F.expr("sum(CASE WHEN precio_base > 0 THEN ln(precio_base) END) AS ln_sum"),
    )


def _add_sums(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    added = (f"sum({c}) AS {c}" for c in ("n", "n_positive", "ln_sum"))
    kept = (f"min({c}) AS {c}" for c in _CELL_ATTRIBUTES)
    return sums.groupBy(*keys).agg(*map(F.expr, (*added, *kept)))


def _dep_from_sums(cells: DataFrame) -> DataFrame:
    priced = cells.withColumn("pgeo", F.exp(F.try_divide("ln_sum", "n_positive")))
    renamed = priced.withColumnRenamed("cantidad_base", "cant_base")
    return with_product_code(renamed.select(*_DEP_COLUMNS))


def dep_price(quotes: DataFrame) -> DataFrame:
    """Geometric mean and count per month, variety and department.

    ``n`` counts all quotes, also those without a positive price, which the
    mean skips.
    """
    return _dep_from_sums(_add_sums(_sums_by_attributes(quotes, CELL), CELL))


def size_sums(quotes: DataFrame, by_weight: Iterable[str] = BY_WEIGHT_CODES) -> DataFrame:
    """Sums per cell, package size and attributes, all that the vote and the mean need."""
    return _sums_by_attributes(quotes.withColumn("__size", vote_size(by_weight)), (*CELL, "__size"))


def counts_from_sums(sums: DataFrame) -> DataFrame:
    """Presentation counts out of ``size_sums``."""
    return sums.groupBy(*CELL, F.col("__size").alias(SIZE)).agg(F.sum("n").alias("count"))


def dep_price_from_sums(sums: DataFrame) -> DataFrame:
    """Vote and department price out of ``size_sums``, without going back to the quotes.

    The sums of a cell, a few rows, are brought together once. Votes of its sizes and the
    most of them come from windows on that partitioning, and the sums of the sizes with
    most votes are added up, on it too; only this last step has text in it.
    """
    size = Window.partitionBy(*CELL, "__size")
    marked = (
        sums.repartition(*(F.col(c) for c in CELL))
        .withColumn("votes", F.sum("n").over(size))
        .withColumn("most", F.max("votes").over(Window.partitionBy(*CELL)))
    )
    return _dep_from_sums(_add_sums(marked.where("votes = most"), CELL))


def roll_up(prices: DataFrame, level: str) -> DataFrame:
    """Count-weighted geometric mean of finer prices at ``level``, month by month.

    Logarithms add up, so any finer level gives the same result and the next
    coarser level can start from this one or from the departments.
    """
    keys = LEVEL_KEYS[level]
    attributes = LEVEL_ATTRIBUTES[level]
    return (
        prices.groupBy(*keys, *PERIOD)
        .agg(
            C.w_geo_mean(F.col("pgeo"), F.col("n")).alias("pgeo"),
            F.sum("n").alias("n"),
            *(F.min(a).alias(a) for a in attributes),
        )
        .select(*keys, "pgeo", "n", *attributes, "mes", "anio")
    )


def reg_price(dep: DataFrame) -> DataFrame:
    return roll_up(dep, "reg")


def var_price(reg: DataFrame) -> DataFrame:
    return roll_up(reg, "var")


def prod_price(var: DataFrame) -> DataFrame:
    return roll_up(var, "prod")


def price_levels(dep: DataFrame) -> DataFrame:
    """Region, variety and product prices together, with one shuffle, told apart by ``nivel``."""
    region = [*PERIOD, "codigo_articulo", "region"]
    variety = [*PERIOD, "codigo_articulo"]
    product = [*PERIOD, "cod_prod"]
    # Bits of the grouping id from left to right: codigo_articulo, region, cod_prod.
    level = (
        F.when(F.grouping_id() == 0b001, "reg")
        .when(F.grouping_id() == 0b011, "var")
        .otherwise("prod")
    )
    sets = [[F.col(c) for c in s] for s in (region, variety, product)]
    keys = [F.col(c) for c in (*PERIOD, "codigo_articulo", "region", "cod_prod")]
    return dep.groupingSets(sets, *keys).agg(
        level.alias("nivel"),
        C.w_geo_mean(F.col("pgeo"), F.col("n")).alias("pgeo"),
        F.sum("n").alias("n"),
    )
