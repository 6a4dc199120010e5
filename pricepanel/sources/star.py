"""Price quotes out of a star schema of sales lines, parts, suppliers and nations.

Every sales line is one quote. The seven ship years stand for the seven months
December 2023 to June 2024, variety codes come from part sizes and departments from
supplier nations. Some lines become the odd cases the panel has to deal with: null and
zero quantities, zero and negative prices, null codes and departments, an older price
regime, varieties that are quoted in some months only, and varieties with several
descriptions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.functions.columns import product_code
from pricepanel.schema import BY_WEIGHT_CODES

FIRST_YEAR = 1995


def _part_code() -> Column:
    """Variety code of a part, as it stands in most months."""
    size, group = F.col("p_size"), F.col("p_partkey") % 4
    weighed = F.array(*map(F.lit, BY_WEIGHT_CODES))
    return (
        F.when(size == 50, F.get(weighed, (F.col("p_partkey") % len(BY_WEIGHT_CODES)).cast("int")))
        .when(size == 49, "104000111")
        .otherwise((2000000 + size * 10 + group).cast("string"))
    )


def _variety() -> Column:
    """Variety code of a line: null at times, and some codes exist in some months only."""
    size, year = F.col("p_size"), F.col("year")
    return (
        F.when(F.col("l_orderkey") % 1009 == 0, F.lit(None))
        .when((size == 48) & (year == FIRST_YEAR), "2999001")
        .when((size == 47) & (year < FIRST_YEAR + 4), "2999011")
        .when((size == 46) & (year == FIRST_YEAR + 6), "2999021")
        .otherwise(F.col("part_code"))
    )


def _region() -> Column:
    """Region of a nation, which for some of them changes in March and for others in June."""
    nation, year = F.col("n_nationkey"), F.col("year")
    moved = ((nation % 6 == 1) & (year == FIRST_YEAR + 6)) | (
        (nation % 12 == 5) & (year < FIRST_YEAR + 3)
    )
    return F.when(moved, (F.col("n_regionkey") + 1) % 5).otherwise(F.col("n_regionkey"))


def _price() -> Column:
    price = (
        F.col("p_retailprice")
        * (1 - F.col("l_discount"))
        * (1 + 8 * F.col("l_tax"))
        * (1 + (F.col("l_orderkey") % 9973) / F.lit(999983.0))
        * F.ceil(F.col("l_quantity") / 10.0).cast("double")
    )
    return (
        F.when(F.col("l_orderkey") % 97 == 0, 0.0)
        .when(F.col("l_orderkey") % 101 == 0, -price)
        .otherwise(price)
    )


def star_quotes(spark: SparkSession, directory: str) -> DataFrame:
    """The quote table, one row per sales line, with the line's identifiers."""
    line, part, supplier, nation = (
        spark.read.parquet(f"{directory}/{t}.parquet")
        for t in ("lineitem", "part", "supplier", "nation")
    )
    # What depends on one table is worked out on that table, before the joins.
    line = line.withColumn("year", F.year("l_shipdate"))
    part = part.withColumn("part_code", _part_code())
    listed = F.col("s_suppkey") % 50 != 7
    quotes = (
        line.join(part, line.l_partkey == part.p_partkey)
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
        .select(
            "l_orderkey",
            "l_linenumber",
            _variety().alias("codigo_articulo"),
            F.when(listed, F.col("n_name")).alias("Departamento"),
            F.when(listed, _region()).cast("int").alias("region"),
            F.when(F.col("l_orderkey") % 89 == 0, F.lit(None))
            .when(F.col("l_orderkey") % 83 == 0, 0.0)
            .otherwise(F.ceil(F.col("l_quantity") / 10.0).cast("double"))
            .alias("cantidad_actual"),
            (1 + F.col("p_size") % 4 * F.lit(0.25)).alias("cantidad_base"),
            _price().alias("precio_actual"),
            F.when((F.col("l_linenumber") == 2) & (F.col("l_orderkey") % 53 == 0), F.lit(None))
            .when((F.col("l_linenumber") == 1) & (F.col("year") <= FIRST_YEAR + 1), "IPC-2010")
            .otherwise("IPC-2023")
            .alias("tipo_precio"),
            # Two of the four varieties of one product are described by region.
            F.when(
                (F.col("p_size") == 45) & (F.col("p_partkey") % 4 < 2),
                F.concat(F.lit("-R"), F.when(listed, F.col("n_regionkey"))),
            )
            .otherwise("")
            .alias("variant"),
            F.expr(f"CASE WHEN year = {FIRST_YEAR} THEN 12 ELSE year - {FIRST_YEAR} END AS mes"),
            F.expr(f"CASE WHEN year = {FIRST_YEAR} THEN 2023 ELSE 2024 END AS anio"),
        )
    )
    return quotes.withColumns(
        {
            "articulo": F.concat(F.lit("VAR-"), F.col("codigo_articulo"), F.col("variant")),
            "producto_nombre": F.concat(
                F.lit("PROD-"), product_code(F.col("codigo_articulo"))
            ),
        }
    ).drop("variant")
