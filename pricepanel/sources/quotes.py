"""Reading quotes from any table Spark reads, in the fixed schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricepanel.functions.columns import in_periods
from pricepanel.schema import QUOTE_SCHEMA, Period


def conform_quotes(raw: DataFrame) -> DataFrame:
    """Cast to the quote schema: what cannot be cast and NaN become null.

    Columns beyond the schema, such as identifiers, are kept as they are.
    """
    return raw.withColumns({field.name: _cast(field) for field in QUOTE_SCHEMA.fields})


def _cast(field: T.StructField):
    value = F.col(field.name).try_cast(field.dataType)
    if isinstance(field.dataType, T.DoubleType):
        return F.nanvl(value, F.lit(None).cast("double"))
    return value


def month_predicates(
    periods: Iterable[Period], parts: int = 1, column: str | None = None
) -> list[str]:
    """One SQL condition for each task of a database read; together they cover the months once.

    ``parts`` divide a month by the remainder of an integer column, whose nulls and negative
    values belong to a part too.
    """
    if parts < 1 or (parts > 1 and not column):
        raise ValueError("a month is divided by a column, into one part at least")
    found = []
    for anio, mes in sorted(set(periods)):
        month = f"anio = {anio} AND mes = {mes}"
        if parts == 1:
            found.append(month)
            continue
        rest = f"ABS({column}) % {parts}"
        found.append(f"{month} AND ({rest} = 0 OR {column} IS NULL)")
        found += [f"{month} AND {rest} = {k}" for k in range(1, parts)]
    return found


def read_quotes(
    spark: SparkSession,
    path: str | None = None,
    periods: Iterable[Period] | None = None,
    source: str = "parquet",
    extra: T.StructType = T.StructType(),
    **options: str,
) -> DataFrame:
    """Quotes of some months, or all.

    The schema is declared, so files are not read to infer it; ``extra`` declares columns
    beyond it, which stand before the quote columns in a format without names. Stored by
    ``anio`` and ``mes``, only the partitions asked for are read. From ``jdbc``, whose tables have
    a schema of their own, each month asked for is a query and a task of its own, or several
    with the option ``parts`` and an integer column ``partsColumn`` to divide by; without
    months it takes its partitioning as options. The month filter is on the bare columns so
    that it reaches the source.
    """
    if source == "jdbc" and periods is not None:
        parts, column = int(options.pop("parts", "1")), options.pop("partsColumn", None)
        predicates = month_predicates(periods, parts, column)
        url, table = options.pop("url"), options.pop("dbtable")
        if not predicates:
            raise ValueError("a database is read for one month at least")
        raw = spark.read.jdbc(url, table, predicates=predicates, properties=options)
        return conform_quotes(raw)
    reader = spark.read.format(source).options(**options)
    if source != "jdbc":
        reader = reader.schema(T.StructType([*extra.fields, *QUOTE_SCHEMA.fields]))
    raw = reader.load(path)
    if periods is not None:
        raw = raw.where(in_periods(periods))
    return conform_quotes(raw)
