from __future__ import annotations

import pytest
from conftest import quote, rows
from pyspark.sql import functions as F

from pricepanel.operators import quotes as qt
from pricepanel.schema import Period
from pricepanel.sources.quotes import conform_quotes


def test_base_price_is_per_base_quantity(quotes):
    df = qt.with_base_price(quotes(quote(price=30.0, size=2.0, base=0.5)))
    assert rows(df, "precio_base") == [(7.5,)]


@pytest.mark.parametrize(
    ("price", "size"), [(None, 1.0), (1.0, None), (0.0, 1.0), (1.0, 0.0), (0.0, 0.0)]
)
def test_invalid_base_prices_are_dropped_without_error(quotes, price, size):
    assert qt.valid_quotes(quotes(quote(price=price, size=size))).count() == 0


def test_negative_prices_are_valid(quotes):
    assert rows(qt.valid_quotes(quotes(quote(price=-5.0))), "precio_base") == [(-5.0,)]


def test_regime_applies_to_listed_months_only(quotes):
    df = quotes(
        quote(code="a", period=Period(2024, 1), regime="IPC-2010"),
        quote(code="b", period=Period(2024, 1)),
        quote(code="c", period=Period(2024, 2), regime="IPC-2010"),
        quote(code="d", period=Period(2023, 12), regime=None),
        quote(code="e", period=Period(2024, 2), regime=None),
        quote(code="f", period=Period(2023, 1), regime="IPC-2010"),
    )
    assert rows(qt.regime_filter(df), "codigo_articulo") == [("b",), ("c",), ("e",), ("f",)]


@pytest.mark.parametrize(
    ("code", "product"),
    [("1113011", "111301"), ("104000111", "1040001"), ("10400012", "1040001"), (None, None)],
)
def test_product_code(spark, code, product):
    df = spark.createDataFrame([(code,)], "codigo_articulo string")
    assert rows(qt.with_product_code(df), "cod_prod") == [(product,)]


def test_region_that_is_no_number_becomes_null(spark):
    df = spark.createDataFrame([("3",), ("IV",), (None,)], "region string")
    assert rows(qt.normalize_region(df)) == [(3,), (None,), (None,)]


@pytest.mark.parametrize(
    ("period", "before"),
    [(Period(2024, 1), Period(2023, 12)), (Period(2024, 12), Period(2024, 11)),
     (Period(2024, 6), Period(2024, 5))],
)
def test_previous_period(spark, period, before):
    df = spark.createDataFrame([period], "anio int, mes int")
    assert period.previous() == before
    assert rows(qt.with_previous_period(df), "anio_ant", "mes_ant") == [tuple(before)]


def test_conform_casts_and_keeps_other_columns(spark):
    raw = spark.createDataFrame(
        [(7, "1", "a", "p", "D", "x", "2", "nan", "9.5", "IPC-2023", "2024", "5")],
        "id int, codigo_articulo string, articulo string, producto_nombre string,"
        "Departamento string, region string, cantidad_actual string, cantidad_base string,"
        "precio_actual string, tipo_precio string, anio string, mes string",
    )
    row = conform_quotes(raw).first()
    assert row["id"] == 7
    assert row["region"] is None and row["cantidad_base"] is None
    assert (row["cantidad_actual"], row["precio_actual"], row["anio"]) == (2.0, 9.5, 2024)


def test_nan_price_counts_as_missing(quotes):
    df = quotes(quote()).withColumn("precio_actual", F.lit(float("nan")))
    assert qt.valid_quotes(df).count() == 0
