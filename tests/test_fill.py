from __future__ import annotations

import random

import pytest
from conftest import rows
from literal import fill_chain
from pyspark.sql import functions as F

from pricepanel.operators import fill
from pricepanel.schema import HISTORY_PERIODS, Period

SCHEMA = (
    "codigo_articulo string, pgeo double, n long, producto_nombre string, cod_prod string,"
    "cant_base double, articulo string, anio int, mes int"
)


def variety_prices(spark, observed):
    """{code: {month index: price}} as variety prices."""
    data = [
        (code, price, 1, "p", "c", 1.0, f"a{i}", HISTORY_PERIODS[i].anio, HISTORY_PERIODS[i].mes)
        for code, months in observed.items()
        for i, price in months.items()
    ]
    return spark.createDataFrame(data, SCHEMA)


def series(df):
    """{code: {month index: price}} of filled prices."""
    out = {}
    for code, anio, mes, pgeo in df.select("codigo_articulo", "anio", "mes", "pgeo").collect():
        months = out.setdefault(code, {})
        index = HISTORY_PERIODS.index((anio, mes))
        assert index not in months, "one row per key and month"
        months[index] = pgeo
    return out


@pytest.mark.parametrize(
    ("observed", "wanted"),
    [
        ({0: 1.0}, {0: 1.0}),
        ({1: 1.0}, dict.fromkeys(range(6), 1.0)),
        ({5: 1.0}, dict.fromkeys(range(6), 1.0)),
        ({1: 10.0, 4: 40.0}, {0: 10.0, 1: 10.0, 2: 40.0, 3: 40.0, 4: 40.0, 5: 40.0}),
        ({0: 5.0, 3: 7.0}, {0: 5.0, 1: 7.0, 2: 7.0, 3: 7.0, 4: 7.0, 5: 7.0}),
        ({5: None}, dict.fromkeys(range(6), None)),
        ({2: 3.0, 5: None}, dict.fromkeys(range(6), 3.0)),
        ({0: None}, {0: None}),
        ({0: 4.0, 1: None}, {0: 4.0, **dict.fromkeys(range(1, 6), None)}),
    ],
)
def test_panel_of_one_key(spark, observed, wanted):
    df = fill.panel(variety_prices(spark, {"x": observed}), "var", HISTORY_PERIODS)
    assert series(df) == {"x": wanted}


def test_fills_match_the_chain_of_joins(spark):
    rng = random.Random(11)
    observed = {}
    for i in range(600):
        months = {m: rng.choice([float(m + 1), None]) for m in range(6) if rng.random() < 0.35}
        if months:
            observed[f"k{i}" if i else None] = months
    by_month = [{c: ms[m] for c, ms in observed.items() if m in ms} for m in range(6)]
    adjusted, filled = fill_chain(by_month)
    prices = variety_prices(spark, observed)

    def by_code(months, start=0):
        out = {}
        for m, table in enumerate(months[start:], start):
            for code, price in table.items():
                out.setdefault(code, {})[m] = price
        return out

    assert series(fill.backcast(prices, "var", HISTORY_PERIODS)) == by_code(adjusted)
    assert series(fill.panel(prices, "var", HISTORY_PERIODS)) == by_code(filled)
    assert series(fill.forward(prices, "var", HISTORY_PERIODS)) == by_code(filled, 2)


def test_null_keys_of_two_months_are_one_key(spark):
    prices = variety_prices(spark, {None: {1: 2.0, 4: 3.0}})
    filled = series(fill.panel(prices, "var", HISTORY_PERIODS))
    assert filled == {None: {0: 2.0, 1: 2.0, 2: 3.0, 3: 3.0, 4: 3.0, 5: 3.0}}


def test_attributes_come_from_the_last_month_and_n_from_the_own(spark):
    prices = variety_prices(spark, {"x": {1: 1.0, 5: 2.0}, "y": {2: 3.0}})
    panel = fill.panel(prices, "var", HISTORY_PERIODS)
    assert {r[0] for r in rows(panel.where("codigo_articulo = 'x'"), "articulo")} == {"a5"}
    assert {r[0] for r in rows(panel.where("codigo_articulo = 'y'"), "articulo")} == {None}
    counted = rows(panel.where("n IS NOT NULL"), "codigo_articulo", "mes")
    assert counted == [("x", 1), ("x", 5), ("y", 2)]


def test_one_and_two_months(spark):
    prices = variety_prices(spark, {"x": {4: 1.0}, "y": {5: 2.0}})
    last = [Period(2024, 5)]
    assert rows(fill.panel(prices, "var", last), "codigo_articulo", "mes") == [("y", 5)]
    two = [Period(2024, 4), Period(2024, 5)]
    filled = rows(fill.panel(prices, "var", two), "codigo_articulo", "mes", "pgeo")
    # April is the first month and is not carried forward.
    assert filled == [("x", 4, 1.0), ("y", 4, 2.0), ("y", 5, 2.0)]


def test_fill_shuffles_once(spark):
    plan = fill.panel(variety_prices(spark, {"x": {1: 1.0}}), "var", HISTORY_PERIODS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text and "Cartesian" not in text


def test_a_stored_panel_with_several_rows_per_key_can_be_filled(spark):
    twice = variety_prices(spark, {"x": {1: 10.0, 4: 40.0}})
    twice = twice.unionByName(twice.withColumn("articulo", F.lit("other")))
    assert series(fill.panel(twice, "var", HISTORY_PERIODS)) == {
        "x": {0: 10.0, 1: 10.0, 2: 40.0, 3: 40.0, 4: 40.0, 5: 40.0}
    }
    bare = twice.drop("n", "articulo", "producto_nombre", "cant_base", "cod_prod")
    assert fill.panel(bare, "var", HISTORY_PERIODS, described=False).count() == 6


def test_text_is_gathered_for_the_last_month_at_most(spark):
    prices = variety_prices(spark, {"x": {1: 10.0, 5: 40.0}})
    bare = fill.panel(prices, "var", HISTORY_PERIODS, described=False)
    plan = bare._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    described = fill.panel(prices, "var", HISTORY_PERIODS).collect()
    assert {r["articulo"] for r in described} == {"a5"}


def test_no_months_are_refused(spark):
    with pytest.raises(ValueError, match="at least one month"):
        fill.panel(variety_prices(spark, {"x": {1: 1.0}}), "var", [])
