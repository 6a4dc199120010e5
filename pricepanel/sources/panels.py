"""The stored panel and the audit export: tables partitioned by anio and mes.

Writing a month replaces that month's partition and leaves the others, so a run
may be repeated and the panel of one run is the prior panel of the next.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricepanel.schema import AUDIT_SCHEMA, LEVEL_KEYS, PERIOD, panel_columns, panel_schema


def write_by_period(df: DataFrame, path: str, source: str = "parquet") -> None:
    """Replace the months present in ``df``, each in files of even size."""
    (
        df.hint("rebalance", *PERIOD)
        .write.format(source)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PERIOD)
        .save(path)
    )


def write_panel(panels: Mapping[str, DataFrame], path: str, source: str = "parquet") -> None:
    """Write the panel tables side by side."""
    for level, table in panels.items():
        write_by_period(table, f"{path}/{level}", source)


def read_panel(spark: SparkSession, path: str, source: str = "parquet") -> dict[str, DataFrame]:
    """The four stored panel tables; a month filter prunes their partitions."""
    return {
        level: spark.read.format(source).schema(panel_schema(level)).load(f"{path}/{level}")
        for level in LEVEL_KEYS
    }


def conform_audit(quotes: DataFrame) -> DataFrame:
    """Audited quotes with the columns of every month, whichever price they were held against.

    Columns that are missing are null, and others, such as identifiers, are kept.
    """
    own = {f.name.lower() for f in quotes.schema.fields}
    missing = [f for f in AUDIT_SCHEMA.fields if f.name.lower() not in own]
    whole = quotes.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return whole.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in AUDIT_SCHEMA.fields})


def write_audit(quotes: DataFrame, path: str, source: str = "parquet") -> None:
    """Write the quotes used, in the audit schema."""
    write_by_period(conform_audit(quotes), path, source)


def read_audit(
    spark: SparkSession,
    path: str,
    source: str = "parquet",
    extra: T.StructType = T.StructType(),
) -> DataFrame:
    """The stored quotes of all months, in the audit schema and with the ``extra`` columns.

    Months written before a column was there have null in it.
    """
    schema = T.StructType([*extra.fields, *AUDIT_SCHEMA.fields])
    return spark.read.format(source).schema(schema).load(path)


def export_order(level: str) -> tuple[str, ...]:
    """Keys and month, then what else may tell rows apart."""
    first = (*LEVEL_KEYS[level], *PERIOD)
    return (*first, *(c for c in panel_columns(level) if c not in first))


def export_ordered(
    table: DataFrame,
    path: str,
    order: Sequence[str],
    source: str = "parquet",
    files: int | None = None,
    **options: str,
) -> None:
    """Write files that, read in the order of their names, have all rows in ``order``.

    Rows are dealt over files by ranges of the order and sorted within a file: no task sees
    more than its range. Nulls come first. Without ``files`` there are as many ranges as
    shuffle partitions, of which small neighbours are put together.
    """
    ranges = (
        table.repartitionByRange(files, *order) if files else table.repartitionByRange(*order)
    )
    (
        ranges.sortWithinPartitions(*order)
        .write.format(source)
        .options(**options)
        .mode("overwrite")
        .save(path)
    )


def read_ordered(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An ordered export with the place of each row in it, counted from 1, as ``orden``."""
    rows = spark.read.schema(schema).parquet(path)
    name, index = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    numbered = rows.select("*", name.alias("__file"), index.alias("__row"))
    # One row per file.
    before = "coalesce(sum(n) OVER (ORDER BY __file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    starts = numbered.groupBy("__file").agg(F.count("*").alias("n"))
    starts = starts.selectExpr("__file", f"{before} AS __before")
    place = (F.col("__before") + F.col("__row") + 1).cast("long")
    return (
        numbered.join(F.broadcast(starts), "__file")
        .withColumn("orden", place)
        .drop("__file", "__row", "__before")
    )
