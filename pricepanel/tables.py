"""Materialised tables and joins that hold up whatever the size and skew of the keys."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Sequence
from contextlib import suppress
from dataclasses import dataclass
from functools import cached_property

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_CONF = "pricepanel.broadcast.maxBytes"
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 1 / 2000
SALTS = 64


@dataclass(frozen=True)
class Table:
    """A materialised DataFrame, or one derived from it that cannot be larger."""

    df: DataFrame
    source: Table | None = None
    measured: int | None = None

    @cached_property
    def size(self) -> int:
        """Upper estimate in bytes, measured while the rows were materialised or by a pass."""
        if self.source is not None:
            return self.source.size
        if self.measured is not None:
            return self.measured
        return int(self.df.agg(F.sum(_row_bytes(self.df.schema))).first()[0] or 0)

    def derive(self, df: DataFrame) -> Table:
        """``df``, some rows and columns of this table, with this table's size as its bound."""
        return Table(df, self)

    def fits_broadcast(self) -> bool:
        return self.size <= broadcast_limit(self.df.sparkSession)


def broadcast_limit(spark: SparkSession) -> int:
    """Largest table to broadcast whole, in bytes; at -1 every table counts as too large."""
    return int(spark.conf.get(BROADCAST_CONF, str(BROADCAST_BYTES)))


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and scratch tables, which driver and executors share.

    The session names it in ``spark.checkpoint.dir``. Where it does not, a folder
    under the warehouse directory is taken, whatever the master.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        named = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or f"{warehouse.rstrip('/')}/_checkpoints")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new folder that all executors can reach, removed when the program ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark.sparkContext, path)
    return path


def _remove(sc: SparkContext, path: str) -> None:
    """Delete a folder of the shared store, as far as the session's JVM is still there."""
    with suppress(Exception):
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jvm.org.apache.hadoop.conf.Configuration()).delete(folder, True)


def materialize(df: DataFrame) -> Table:
    """Compute ``df`` once and keep it on storage that outlives an executor."""
    shared_dir(df.sparkSession)
    name = f"size-{uuid.uuid4().hex}"
    observed = df.observe(name, F.sum(_row_bytes(df.schema)).alias("bytes"))
    kept = observed.checkpoint(eager=True)
    # What the job has counted; without it the size is measured when it is asked for.
    counted = observed._jdf.queryExecution().observedMetrics().get(name)
    measured = int(counted.get().get(0) or 0) if counted.isDefined() else None
    return Table(kept, measured=measured)


def _row_bytes(schema: T.StructType) -> Column:
    """Bytes of one row in a hashed relation: fixed slots, padded strings, entry overhead."""
    texts = (f.name for f in schema.fields if isinstance(f.dataType, T.StringType))
    padded = (f"coalesce(octet_length(`{name.replace('`', '``')}`), 0) + 8" for name in texts)
    return F.expr(" + ".join((f"{40 + 16 * len(schema.fields)}L", *padded)))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys match each other, with one set of key columns."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    matches = " AND ".join(f"{k} <=> __right_{k}" for k in keys)
    joined = left.join(renamed, F.expr(matches), how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how == "full":
        joined = joined.withColumns(
            {k: F.coalesce(F.col(k), F.col(f"__right_{k}")) for k in keys}
        )
    return joined.drop(*(f"__right_{k}" for k in keys))


def lookup_join(
    rows: DataFrame,
    table: DataFrame | Table,
    keys: Sequence[str],
    how: str = "left",
    hot_share: float = HOT_SHARE,
    frequencies: DataFrame | None = None,
) -> DataFrame:
    """Join many rows to a table expected to be much smaller, without trusting that it is.

    A table measured below the broadcast limit is broadcast, so the rows never
    move. Beyond it both sides are shuffled, once. A key with more than ``hot_share``
    of the rows is hot; there are fewer than ``1 / hot_share`` of those. Its rows
    are dealt over ``SALTS`` tasks, and its part of the table is repeated for each.
    ``frequencies`` may hand over the rows per key, as ``count``, if they are known.
    ``how`` keeps rows of the left side only: left, inner, left_semi or left_anti.
    """
    table = table if isinstance(table, Table) else materialize(table)
    if table.fits_broadcast():
        return null_safe_join(rows, F.broadcast(table.df), keys, how)

    if frequencies is None:
        frequencies = materialize(rows.groupBy(*keys).count()).df
    total = frequencies.agg(F.sum("count")).first()[0] or 0
    hot = materialize(
        frequencies.where(F.col("count") > total * hot_share)
        .select(*keys)
        .withColumn("__hot", F.lit(True))
    ).df
    salted = _mark(rows, hot, keys).withColumn(
        "__salt",
        F.when(F.col("__hot"), F.monotonically_increasing_id() % SALTS).otherwise(0).cast("int"),
    )
    every = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
        F.array(F.lit(0))
    )
    repeated = _mark(table.df, hot, keys).withColumn("__salt", F.explode(every)).drop("__hot")
    joined = null_safe_join(salted, repeated, [*keys, "__salt"], how)
    return joined.drop("__hot", "__salt")


def _mark(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    return null_safe_join(df, F.broadcast(hot), keys, "left")
