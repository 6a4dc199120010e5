"""Mixing sources to target weights by capped water-filling.

Sources share the size of the mix by weight, but no source is repeated more often than
its maximum of epochs. What a source cannot take is shared out again by weight among the
others, until none is above its maximum. A target is then met by whole repetitions of all
documents of the source and, for the rest, by a seeded share of them: documents are put in
the order of a hash of their id and text and taken from the start up to the target.

The order within a source is cut into buckets by the first digits of the hash. Only the
bucket in which the target falls is looked at document by document, so a source with
most of all documents needs no more than one small group at once. Rows that agree in source, id
and text are numbered, by ranges over all of them, and the number is part of what is hashed: no
two rows have one place, and many rows without an id do not share a bucket. The result of it
all is one row per source, which is looked up where the documents lie.

Edge cases: a null text has size 0 and adds nothing. A null source is a source of its own.
Of rows that agree in all, as many are taken as the target needs. Sources of size 0 get target 0. If all
sources at their maximum do not reach the size asked for, all get their maximum. An empty
table gives an empty result. Other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.llm.common import running_total, words_of, written
from pricepanel.tables import Table, lookup_join, materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix"
# Hexadecimal digits of the hash that name a bucket.
_DIGITS = 3


def source_weights(sources: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Give the sources in code point order, null last, the weights in turn."""
    ranked = running_total(
        sources.withColumn("__null", F.col("source").isNull()), ["__null", "source"], "__rank"
    )
    turn = F.array(*map(F.lit, weights))
    return ranked.withColumn(
        "weight", F.get(turn, (F.col("__rank") % len(weights)).cast("int"))
    ).drop("__null", "__rank")


def water_fill(
    sources: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """Add ``target`` to sources with ``source_size`` and ``weight``.

    Each round fixes the sources that would be above their maximum and raises the level of
    the others by what is left; three sums come back per round, and there are no more
    rounds than sources.
    """
    cap = max_epochs * F.col("source_size")
    size = sources.agg(F.sum("source_size")).first()[0] or 0
    level, n_capped = 0.0, -1
    while True:
        above = level * F.col("weight") > cap
        fixed, open_weight, capped = sources.agg(
            F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)
        ).first()
        if capped == n_capped:
            break
        n_capped = capped
        if not open_weight:
            level = float("inf")
            break
        level = max(level, (share * size - (fixed or 0)) / open_weight)
    above = F.lit(level) * F.col("weight") > cap
    target = F.when(above, cap.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return sources.withColumn("target", target)


_SAME = ["source", "doc_id", "digest"]


def numbered(rows: DataFrame) -> DataFrame:
    """Add ``nth``, the number of a row among those with its source, id and text, from 0.

    Only rows that have such others are put in order.
    """
    repeated = materialize(rows.groupBy(*_SAME).count().where("count > 1").select(*_SAME))
    if repeated.df.isEmpty():
        return rows.withColumn("nth", F.lit(0).cast("long"))
    tied = lookup_join(rows, repeated, _SAME, "left_semi")
    tied = written(tied.withColumn("__tie", F.monotonically_increasing_id()), "mix-ties")
    placed = written(running_total(tied, [*_SAME, "__tie"], "__place"), "mix-places")
    firsts = materialize(placed.groupBy(*_SAME).agg(F.min("__place").alias("__first")))
    among = lookup_join(placed, firsts, _SAME).withColumn(
        "nth", F.col("__place") - F.col("__first")
    )
    alone = lookup_join(rows, repeated, _SAME, "left_anti")
    return alone.withColumn("nth", F.lit(0).cast("long")).unionByName(
        among.drop("__tie", "__place", "__first")
    )


def with_order_key(rows: DataFrame, seed: str = SEED) -> DataFrame:
    """Add ``key``, the place of a row in the seeded order of its source."""
    told = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "digest", "nth"))
    return numbered(rows).withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), *told)))


def plan_mix(
    rows: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
) -> Table:
    """One row per source: size, weight, target, whole repetitions and last key of the rest.

    ``rows`` have ``source``, ``size`` and ``key``.
    """
    totals = materialize(
        rows.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    ).df
    weighted = materialize(source_weights(totals, weights)).df
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("int")
    planned = water_fill(weighted, share, max_epochs).withColumn("whole", whole)
    planned = materialize(
        planned.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    )

    bucket = F.substring("key", 1, _DIGITS)
    buckets = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("__size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = buckets.withColumn("__before", F.coalesce(F.sum("__size").over(before), F.lit(0)))
    placed = lookup_join(placed, planned.derive(planned.df.select("source", "rest")), ["source"])
    started = materialize(placed.where(F.col("__before") < F.col("rest"))).df
    split = materialize(started.where(F.col("__before") + F.col("__size") > F.col("rest")))

    inside = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    so_far = F.col("__before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    edge = lookup_join(
        rows.withColumn("bucket", bucket), split, ["source", "bucket"], "inner"
    ).withColumn("__so_far", so_far)
    # A document is taken if more than half of it lies before the target.
    edge = edge.where(2 * F.col("__so_far") + F.col("size") <= 2 * F.col("rest"))
    last = edge.select("source", "key").unionByName(
        # Every key of a bucket lies before its name followed by a letter beyond all digits.
        started.where(F.col("__before") + F.col("__size") <= F.col("rest")).select(
            "source", F.concat("bucket", F.lit("~")).alias("key")
        )
    )
    cut = materialize(last.groupBy("source").agg(F.max("key").alias("last_key")))
    return materialize(lookup_join(planned.df, cut, ["source"]))


def times_taken() -> Column:
    return F.col("whole") + F.coalesce(F.col("key") <= F.col("last_key"), F.lit(False)).cast("int")


def _rows(documents: DataFrame, doc_id: str, text: str, source: str, *kept: Column) -> DataFrame:
    return documents.select(
        *kept,
        F.col(doc_id).cast("string").alias("doc_id"),
        F.col(source).alias("source"),
        F.size(words_of(F.col(text))).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("digest"),
    )


def mix(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    *,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: its size, its source's size and target, and what the mix takes."""
    own = F.col(doc_id).alias("own_id")
    rows = written(_rows(documents, doc_id, text, source, own), "mix")
    rows = written(with_order_key(rows, seed), "mix")
    plan = plan_mix(rows, weights, share, max_epochs)
    taken = (times_taken() * F.col("size")).cast("long")
    return lookup_join(rows, plan, ["source"]).select(
        F.col("own_id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"),
        times_taken().alias("repetitions"),
    )


def mixed_documents(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    **options,
) -> DataFrame:
    """The documents of the mix, each as often as it is repeated, with the given columns."""
    seed = options.pop("seed", SEED)
    rows = written(_rows(documents, doc_id, text, source), "mix")
    plan = plan_mix(written(with_order_key(rows, seed), "mix"), **options)
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("__row")
    keyed = with_order_key(_rows(documents, doc_id, text, source, whole), seed)
    joined = lookup_join(keyed, plan, ["source"])
    copies = F.explode(F.array_repeat(F.lit(0), times_taken())).alias("__copy")
    return joined.select("__row", copies).select("__row.*")
