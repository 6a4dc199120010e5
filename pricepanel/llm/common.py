"""Helpers shared by the text operators: words, reading tables, order over all rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricepanel.tables import materialize, scratch_path

# A stretch of ASCII white space, which parts words.
GAP = "[ \\t\\n\\x0B\\f\\r]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` computed once into a table in the shared folder, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called that."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: Column) -> Column:
    """Words of a text: the stretches without ASCII white space; a null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it.

    Split over several projections, the optimiser may put the value's expression in
    every place that names it, inside of loops too.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def running_total(
    df: DataFrame, order: Sequence[str], name: str, weight: str | None = None
) -> DataFrame:
    """Add the total of ``weight`` over all rows before a row along ``order``.

    Without a weight rows are counted, so they are numbered from 0. No task sees all
    rows: ranges of the order are summed up apart from each other, and each starts with
    the total of those before it. Rows that agree in ``order`` follow in any order.
    """
    value = F.lit(1) if weight is None else F.col(weight)
    ranges = materialize(
        df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    ).df
    # One row per range, of which there are no more than shuffle partitions.
    sums = ranges.groupBy("__range").agg(F.sum(value).alias("__sum"))
    so_far = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("__range", F.coalesce(F.sum("__sum").over(so_far), F.lit(0)).alias("__start"))
    inside = (
        Window.partitionBy("__range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranges.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(F.broadcast(starts), "__range")
        .withColumn(name, F.col("__start") + F.col("__inside"))
        .drop("__range", "__inside", "__start")
    )
