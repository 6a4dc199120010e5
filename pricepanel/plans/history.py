"""Back-history build: clean the months from the last to the first, then fill the gaps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame

from pricepanel.operators import dims, fill
from pricepanel.operators.levels import (
    counts_from_sums,
    dep_price_from_sums,
    roll_up,
    size_sums,
)
from pricepanel.operators.outliers import outlier_band_following
from pricepanel.operators.presentation import popular_presentation
from pricepanel.operators.quotes import (
    normalize_region,
    period_quotes,
    regime_filter,
    valid_quotes,
)
from pricepanel.plans.state import FoldState, month_fingerprints
from pricepanel.schema import (
    BAND_FACTOR,
    BY_WEIGHT_CODES,
    HISTORY_PERIODS,
    LEVEL_KEYS,
    REGIME,
    REGIME_PERIODS,
    Period,
)
from pricepanel.tables import Table, materialize


@dataclass(frozen=True)
class History:
    """Cleaned prices of several months and the tables that follow from them."""

    periods: tuple[Period, ...]
    dep_by_period: Mapping[Period, Table]
    banded: Mapping[Period, DataFrame]
    sums: Mapping[Period, Table]
    by_weight: tuple[str, ...]
    # Months whose stored result was taken, and months that were cleaned, last to first.
    reused: tuple[Period, ...] = ()
    cleaned: tuple[Period, ...] = ()

    @cached_property
    def dep(self) -> DataFrame:
        """Unfilled department prices of all months."""
        return reduce(DataFrame.unionByName, (t.df for t in self.dep_by_period.values()))

    def prices(self, level: str) -> DataFrame:
        """Unfilled prices at one level; filled prices never enter a mean."""
        return self.dep if level == "dep" else roll_up(self.dep, level)

    def backcast(self, level: str) -> DataFrame:
        return fill.backcast(self.prices(level), level, self.periods)

    def forward(self, level: str) -> DataFrame:
        return fill.forward(self.prices(level), level, self.periods)

    def panel(self, level: str) -> DataFrame:
        return fill.panel(self.prices(level), level, self.periods)

    @cached_property
    def articles(self) -> Table:
        """Descriptions come from the last month only; all other months inherit them."""
        return materialize(dims.article_dim(self.dep_by_period[self.periods[-1]].df))

    def filled(self, level: str) -> DataFrame:
        """A finished panel table, descriptions attached."""
        bare = fill.panel(self.prices(level), level, self.periods, described=False)
        return dims.fill_level(bare, level, self.articles)

    def panels(self) -> dict[str, DataFrame]:
        return {level: self.filled(level) for level in LEVEL_KEYS}

    def audit(self, period: Period) -> DataFrame:
        """Quotes of one month that entered its prices.

        Months but the last carry the reference price as ``pgeo``. The counts are
        those of the build if it kept them.
        """
        counts = None
        if period in self.sums:
            counts = self.sums[period].derive(counts_from_sums(self.sums[period].df))
        return popular_presentation(self.banded[period], self.by_weight, counts)


def build_history(
    quotes: DataFrame,
    periods: Sequence[Period] = HISTORY_PERIODS,
    *,
    regime_periods: Iterable[Period] = REGIME_PERIODS,
    regime: str = REGIME,
    factor: float = BAND_FACTOR,
    by_weight: Iterable[str] = BY_WEIGHT_CODES,
    keep_votes: bool = False,
    state: str | None = None,
) -> History:
    """Clean each month against the following one, starting from the last.

    A month's cleaning needs the following month's result, so the months are a
    sequence; each is one distributed pass over that month's quotes, and only its
    department prices are kept for the next step. ``keep_votes`` also keeps the sums
    per package size, which spares the audit export a second counting pass.

    ``state`` names a folder in which the months' results are kept for later runs: those
    clean only the months that a correction of quotes or another parameter can have changed.
    """
    periods = tuple(sorted(periods))
    if not periods:
        raise ValueError("a history needs at least one month")
    quotes = normalize_region(quotes)
    by_weight = tuple(by_weight)
    regime_periods = tuple(regime_periods)
    kept = None
    if state is not None:
        parameters = {"factor": factor, "by_weight": sorted(by_weight)}
        kept = FoldState(state, month_fingerprints(quotes, periods), parameters)
    cleaned: dict[Period, Table] = {}
    banded: dict[Period, DataFrame] = {}
    sums: dict[Period, Table] = {}
    following: Table | None = None
    for period in reversed(periods):
        rows = valid_quotes(regime_filter(period_quotes(quotes, period), regime_periods, regime))
        if following is not None:
            rows = outlier_band_following(rows, following, factor)
        if kept is not None:
            kept.begin(period, regime=regime if period in regime_periods else None)
        voted = size_sums(rows, by_weight)
        if keep_votes:
            sums[period] = kept.keep("sums", voted) if kept else materialize(voted)
            voted = sums[period].df
        dep = dep_price_from_sums(voted)
        following = kept.keep("dep", dep) if kept else materialize(dep)
        cleaned[period] = following
        banded[period] = rows
    runs = (kept.reused, kept.cleaned) if kept else ((), periods[::-1])
    return History(periods, cleaned, banded, sums, by_weight, *map(tuple, runs))
