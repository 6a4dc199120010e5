"""Monthly roll-forward: add one new month to a stored panel."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.functions import columns as C
from pricepanel.operators import dims, fill
from pricepanel.operators.levels import dep_price_from_sums, roll_up, size_sums
from pricepanel.operators.outliers import outlier_band_previous
from pricepanel.operators.presentation import popular_presentation
from pricepanel.operators.quotes import normalize_region, period_quotes, valid_quotes
from pricepanel.schema import (
    BAND_FACTOR,
    BY_WEIGHT_CODES,
    LEVEL_KEYS,
    ROLL_FORWARD_PERIOD,
    Period,
)
from pricepanel.tables import Table, lookup_join, materialize, null_safe_join


def carry_forward(prior: DataFrame, prices: DataFrame, level: str, period: Period) -> DataFrame:
    """New prices of ``period``, and the prior price for every key without one.

    ``prior`` has ``pgeo_ant``, one row per key, and so have ``prices``: a full join
    has no heavy keys.
    """
    keys = LEVEL_KEYS[level]
    joined = null_safe_join(prior, prices.select(*keys, "pgeo"), keys, "full")
    return _stamped(joined.withColumn("pgeo", F.coalesce("pgeo", "pgeo_ant")), level, period)


def carry_forward_departments(
    prior: DataFrame | Table, dep: DataFrame, level: str, period: Period
) -> DataFrame:
    """Like ``carry_forward``, but with the department prices on the new side.

    That is how the monthly program is written: one row per department, with its
    price, for each key that has new quotes. Such a key may have very many
    departments, so the full join is taken apart into a lookup, which splits heavy
    keys, and an anti join against distinct keys.
    """
    keys = LEVEL_KEYS[level]
    prior = prior if isinstance(prior, Table) else materialize(prior)
    fresh = lookup_join(dep.select(*keys, "pgeo"), prior, keys)
    fresh = fresh.withColumn("pgeo", F.coalesce("pgeo", "pgeo_ant"))
    stale = null_safe_join(prior.df, dep.select(*keys).distinct(), keys, "left_anti")
    stale = stale.withColumn("pgeo", F.col("pgeo_ant"))
    return _stamped(fresh.unionByName(stale), level, period)


def _stamped(df: DataFrame, level: str, period: Period) -> DataFrame:
    return fill.stamp(df.select(*LEVEL_KEYS[level], "pgeo"), period)


@dataclass(frozen=True)
class RollForward:
    """One new month and the panel tables that follow from it."""

    period: Period
    stored: Mapping[str, DataFrame]
    prior: dict[str, Table]
    banded: DataFrame
    dep: DataFrame
    by_weight: tuple[str, ...]
    as_written: bool

    def prices(self, level: str) -> DataFrame:
        return self.dep if level == "dep" else roll_up(self.dep, level)

    def carried(self, level: str) -> DataFrame:
        """Prices of the new month, carried over where there is no new one."""
        if level not in self.prior:
            slice_of = fill.prior_slice if self.as_written else fill.prior_prices
            period = self.period.previous()
            self.prior[level] = materialize(slice_of(self.stored[level], level, period))
        if self.as_written and level != "dep":
            return carry_forward_departments(self.prior[level], self.dep, level, self.period)
        return carry_forward(self.prior[level].df, self.prices(level), level, self.period)

    @cached_property
    def articles(self) -> Table:
        previous = self.stored["dep"].where(C.in_period(self.period.previous()))
        return materialize(dims.article_dim(previous, complete_only=False))

    def filled(self, level: str) -> DataFrame:
        return dims.fill_level(self.carried(level), level, self.articles)

    def panels(self) -> dict[str, DataFrame]:
        return {level: self.filled(level) for level in LEVEL_KEYS}

    def audit(self) -> DataFrame:
        """Quotes that entered the new month's prices, with ``pgeo_ant``."""
        return popular_presentation(self.banded, self.by_weight)


def roll_forward(
    quotes: DataFrame,
    stored: Mapping[str, DataFrame],
    period: Period = ROLL_FORWARD_PERIOD,
    *,
    factor: float = BAND_FACTOR,
    by_weight: Iterable[str] = BY_WEIGHT_CODES,
    as_written: bool = False,
    keep_unreferenced: bool = False,
) -> RollForward:
    """Clean one month against the stored panel's previous month and carry gaps forward.

    ``stored`` maps each level to its panel table. ``as_written`` carries region,
    variety and product prices forward against the new department prices, and takes every
    stored row of a key with several descriptions, so that rows multiply from month to
    month: it is for comparison with one month of the original program, not for a loop.
    """
    period = Period(*period)
    by_weight = tuple(by_weight)
    slice_of = fill.prior_slice if as_written else fill.prior_prices
    previous = materialize(slice_of(stored["dep"], "dep", period.previous()))
    rows = valid_quotes(period_quotes(normalize_region(quotes), period))
    banded = outlier_band_previous(rows, previous, factor, keep_unreferenced)
    dep = materialize(dep_price_from_sums(size_sums(banded, by_weight))).df
    return RollForward(period, stored, {"dep": previous}, banded, dep, by_weight, as_written)
