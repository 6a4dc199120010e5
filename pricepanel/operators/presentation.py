"""The presentation vote: the usual package size of a variety in a department.

The vote never brings a cell's quotes together. Quotes are summed up per
(cell, size) with map-side combination, and everything after works on those sums,
so a cell with a large part of all quotes costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.functions import columns as C
from pricepanel.schema import BY_WEIGHT_CODES, PERIOD
from pricepanel.tables import Table, lookup_join, materialize

CELL = (*PERIOD, "codigo_articulo", "Departamento")
SIZE = "cantidad_actual"


def presentation_counts(quotes: DataFrame) -> DataFrame:
    """Quotes per month, variety, department and package size, as ``count``."""
    return quotes.groupBy(*CELL, SIZE).agg(F.count(F.lit(1)).alias("count"))


def winning_presentations(counts: DataFrame | Table) -> DataFrame:
    """The most frequent sizes of each cell, ties included, from ``count`` per size."""
    counts = counts if isinstance(counts, Table) else materialize(counts)
    if counts.fits_broadcast():
        most = F.max("count").over(Window.partitionBy(*CELL))
        marked = counts.df.withColumn("max_count", most)
    else:
        # One cell may have any number of sizes, too many to sort in one task.
        highest = counts.df.groupBy(*CELL).agg(F.max("count").alias("max_count"))
        marked = lookup_join(counts.df, highest, CELL, "inner")
    return marked.where(F.col("count") == F.col("max_count")).select(*CELL, SIZE)


def popular_presentation(
    quotes: DataFrame,
    by_weight: Iterable[str] = BY_WEIGHT_CODES,
    counts: DataFrame | Table | None = None,
) -> DataFrame:
    """Quotes of the usual package sizes; by-weight varieties pass untouched.

    ``counts`` may hand over counts per size that are already at hand.
    """
    exempt = C.is_by_weight(by_weight)
    if counts is None:
        counts = presentation_counts(quotes.where(~exempt))
    counts = counts if isinstance(counts, Table) else materialize(counts)
    winners = counts.derive(winning_presentations(counts))
    if counts.fits_broadcast():
        marked = counts.derive(winners.df.withColumn("__usual", F.lit(True)))
        voted = lookup_join(quotes, marked, [*CELL, SIZE])
        return voted.where(exempt | F.col("__usual")).drop("__usual")
    # Exempt rows have no part in a join that may shuffle.
    usual = lookup_join(
        quotes.where(~exempt), winners, [*CELL, SIZE], "left_semi", frequencies=counts.df
    )
    return usual.unionByName(quotes.where(exempt))


def vote_size(by_weight: Iterable[str] = BY_WEIGHT_CODES) -> Column:
    """Package size as a voting key: by-weight varieties share one."""
    return F.when(~C.is_by_weight(by_weight), F.col(SIZE))
