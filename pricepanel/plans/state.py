"""The state of a history's fold over its months, kept between runs.

A month is cleaned against the following month's result, so what it comes to depends on its own
quotes, on the parameters and on all later months. Each month's result is stored under a name
that tells all of that: a digest of the parameters, of a fingerprint of the month's quotes,
and of the following month's name. A later run that arrives at the same name takes what is
stored. After a correction, only the months up to and including the corrected one are cleaned
again; a run that failed goes on where it stopped.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.functions import columns as C
from pricepanel.schema import QUOTE_SCHEMA, Period
from pricepanel.sources.published import Store
from pricepanel.tables import Table


def month_fingerprints(quotes: DataFrame, periods: Iterable[Period]) -> dict[Period, str]:
    """What tells a month's quotes from others, whatever their order: one row per month.

    Counts and sums of two hashes over the quote columns, with map-side combination, in one
    pass over all months.
    """
    columns = [F.col(f.name) for f in QUOTE_SCHEMA.fields]
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)
    sums = (
        quotes.where(C.in_periods(periods))
        .groupBy("anio", "mes")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(first.cast("decimal(20,0)")).alias("a"),
            F.sum(second.cast("decimal(20,0)")).alias("b"),
            F.bit_xor(first).alias("c"),
        )
        .collect()
    )
    found = {Period(r["anio"], r["mes"]): f"{r['n']}:{r['a']}:{r['b']}:{r['c']}" for r in sums}
    return {p: found.get(p, "none") for p in periods}


@dataclass
class FoldState:
    """Stored results of months, in a folder that all executors share."""

    path: str
    fingerprints: Mapping[Period, str]
    parameters: Mapping[str, object]
    reused: list[Period] = field(default_factory=list)
    cleaned: list[Period] = field(default_factory=list)
    _name: str = ""
    _own: Period | None = None

    def begin(self, period: Period, **own: object) -> None:
        """Go on to a month, whose name follows from that of the month before in the fold."""
        told = {
            "parameters": {**self.parameters, **own},
            "month": list(period),
            "quotes": self.fingerprints[period],
            "following": self._name,
        }
        text = json.dumps(told, sort_keys=True)
        self._name = f"{period.anio}-{period.mes:02}-{hashlib.sha256(text.encode()).hexdigest()}"
        self._own = period
        self.reused.append(period)

    def keep(self, kind: str, table: DataFrame) -> Table:
        """A result of the month, the stored one if there is one.

        It counts as stored once the mark beside it is there, which is made last.
        """
        spark = table.sparkSession
        store, folder = Store(spark), f"{self.path}/{self._name}"
        if f"{kind}.done" not in store.names(folder):
            table.write.mode("overwrite").parquet(f"{folder}/{kind}")
            store.create(f"{folder}/{kind}.done", "")
            if self._own in self.reused:
                self.reused.remove(self._own)
                self.cleaned.append(self._own)
        return Table(spark.read.schema(table.schema).parquet(f"{folder}/{kind}"))
