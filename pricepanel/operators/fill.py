"""Filling of missing months, backward from later months and forward from earlier ones."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.functions import columns as C
from pricepanel.schema import LEVEL_ATTRIBUTES, LEVEL_KEYS, PERIOD, Period


def _months(periods: Sequence[Period]) -> tuple[Column, Callable[[Column], Column]]:
    """The place of a row's month among ``periods``, and the month of a place."""
    ordinals = [p.ordinal for p in periods]
    month = C.period_ordinal(F.col("anio"), F.col("mes"))
    if ordinals[-1] - ordinals[0] == len(ordinals) - 1:
        return month - ordinals[0], lambda place: place + ordinals[0]
    listed = F.array(*map(F.lit, ordinals))
    return (F.array_position(listed, month) - 1).cast("int"), lambda place: F.get(listed, place)


def _with_fills(
    prices: DataFrame, level: str, periods: Sequence[Period], described: bool = True
) -> DataFrame:
    """Every key in every month, with what lies at or after and at or before the month.

    One shuffle, by key. A row stands for its month and for the months without a row before
    it, the last row of a key also for those after it, so each is expanded by the gap beside
    it: nothing depends on the number of months but the number of rows that come out. Grouping
    treats null keys as equal. If a key has several rows in a month, as in a stored panel with
    several descriptions, the highest price and count are taken. Of the attributes only those
    of the last month are gathered, and none unless ``described``.
    """
    if not periods:
        raise ValueError("a fill needs at least one month")
    keys = LEVEL_KEYS[level]
    attributes = LEVEL_ATTRIBUTES[level] if described else ()
    periods = sorted(set(periods))
    end = len(periods) - 1
    carry_from = min(1, end)
    place, month_at = _months(periods)

    n = F.col("n") if "n" in prices.columns else F.lit(None).cast("long")
    numbers = [F.max("pgeo").alias("pgeo"), F.max(n).alias("n")]
    if described:
        # Nulls are not collected, so one entry comes together, that of the last month.
        anchor = F.when(F.col("place") == end, F.struct(*attributes))
        numbers.append(F.array_min(F.collect_list(anchor)).alias("anchor"))
    observed = (
        prices.where(C.in_periods(periods))
        .withColumn("place", place)
        .repartition(*(F.col(k) for k in keys))
        .groupBy(*keys, "place")
        .agg(*numbers)
    )
    onward = Window.partitionBy(*keys).orderBy(F.col("place").desc())
    so_far = Window.partitionBy(*keys).orderBy("place")
    carries = F.col("place") >= carry_from
    runs = observed.withColumns(
        {
            "next_price": F.last("pgeo", ignorenulls=True).over(onward),
            "first": F.coalesce(F.lead("place").over(onward) + 1, F.lit(0)),
            "final": F.lag("place").over(onward).isNull(),
            **({"anchor": F.last("anchor", ignorenulls=True).over(onward)} if described else {}),
        }
    ).withColumn(
        "last_price", F.last(F.when(carries, F.col("pgeo")), ignorenulls=True).over(so_far)
    )
    until = F.when(F.col("final") & carries, end).otherwise(F.col("place"))
    spread = runs.withColumn("__place", F.explode(F.sequence(F.col("first"), until)))
    ahead = F.col("__place") <= F.col("place")
    return spread.select(
        *keys,
        month_at(F.col("__place")).alias("month"),
        F.when(F.col("__place") == F.col("place"), F.col("n")).alias("n"),
        F.when(ahead, F.col("next_price")).alias("next_price"),
        "last_price",
        ahead.alias("has_next"),
        *(F.col("anchor")[a].alias(a) for a in attributes),
    )


def _finish(filled: DataFrame, level: str, price: Column, described: bool = True) -> DataFrame:
    return filled.select(
        *LEVEL_KEYS[level],
        price.alias("pgeo"),
        "n",
        *(LEVEL_ATTRIBUTES[level] if described else ()),
        C.month_of(F.col("month")).alias("mes"),
        C.year_of(F.col("month")).alias("anio"),
    )


def backcast(prices: DataFrame, level: str, periods: Sequence[Period]) -> DataFrame:
    """Each month with its missing prices taken from the nearest later month.

    A key has a row in every month up to its last one, even if none of its
    prices is known. ``n`` is missing in filled rows. The attributes are those
    of the last month, which all months inherit.
    """
    filled = _with_fills(prices, level, periods).where("has_next")
    return _finish(filled, level, F.col("next_price"))


def panel(
    prices: DataFrame, level: str, periods: Sequence[Period], described: bool = True
) -> DataFrame:
    """Backcast, then missing prices taken from the nearest earlier month.

    The first month is not carried forward: the chain starts at the second. Without
    ``described`` the attributes are left out.
    """
    filled = _with_fills(prices, level, periods, described)
    return _finish(filled, level, F.coalesce("next_price", "last_price"), described)


def forward(prices: DataFrame, level: str, periods: Sequence[Period]) -> DataFrame:
    """The months of the panel that forward filling reaches: from the third on."""
    reached = sorted(periods)[2:]
    return panel(prices, level, periods).where(C.in_periods(reached))


def prior_slice(stored: DataFrame, level: str, period: Period) -> DataFrame:
    """Prices of one stored month as ``pgeo_ant``."""
    return stored.where(C.in_period(period)).select(
        *LEVEL_KEYS[level], F.col("pgeo").alias("pgeo_ant")
    )


def prior_prices(stored: DataFrame, level: str, period: Period) -> DataFrame:
    """The prior slice with one row per key.

    A code with several descriptions has a row for each in the stored panel, all with the
    same price; taken as they are, they would multiply every month.
    """
    keys = LEVEL_KEYS[level]
    return prior_slice(stored, level, period).groupBy(*keys).agg(F.min("pgeo_ant").alias("pgeo_ant"))


def stamp(df: DataFrame, period: Period) -> DataFrame:
    return df.withColumns(dict(zip(PERIOD, map(F.lit, period), strict=True)))
