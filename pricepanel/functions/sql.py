"""The column functions in SQL.

Spark's SQL functions may not hold aggregates, so the means come in two parts: a function of
each row, whose logarithms any sum or mean takes with map-side combination, and the text of
the whole expression for a statement.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from pricepanel.schema import LONG_PRODUCT_CODE, SHORT_PRODUCT_CODE

_FUNCTIONS = {
    "ln_positive(x DOUBLE) RETURNS DOUBLE": "CASE WHEN x > 0 THEN ln(x) END",
    "mean_of_logs(total DOUBLE, weight DOUBLE) RETURNS DOUBLE": (
        "exp(try_divide(coalesce(total, 0D), weight))"
    ),
    "base_price(price DOUBLE, base_quantity DOUBLE, quantity DOUBLE) RETURNS DOUBLE": (
        "nanvl(try_divide(price * base_quantity, quantity), CAST(NULL AS DOUBLE))"
    ),
    "product_code(code STRING) RETURNS STRING": (
        f"CASE WHEN substring(code, 1, length(code) - 1) = '{LONG_PRODUCT_CODE}' "
        f"THEN '{SHORT_PRODUCT_CODE}' ELSE substring(code, 1, length(code) - 1) END"
    ),
    "region_number(region STRING) RETURNS INT": "try_cast(region AS INT)",
}


def register_functions(spark: SparkSession) -> None:
    """Make the functions known to the session's SQL, under their own names."""
    for head, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


def geo_mean_sql(x: str) -> str:
    """The geometric mean of a column as SQL: that of the positive values."""
    return f"exp(avg(ln_positive({x})))"


def w_geo_mean_sql(x: str, w: str) -> str:
    """The weighted geometric mean as SQL; a missing value keeps its weight."""
    return f"mean_of_logs(sum({w} * ln_positive({x})), sum({w}))"
