"""Fills over many months, the resumable fold, dependency checks and the means in SQL."""

from __future__ import annotations

import random

import pytest
from conftest import quote, rows
from pyspark.sql import functions as F

import pricepanel.plans.history as history_module
from pricepanel import Period, build_history
from pricepanel.functions import (
    geo_mean,
    geo_mean_sql,
    register_functions,
    w_geo_mean,
    w_geo_mean_sql,
)
from pricepanel.operators import dims, fill
from pricepanel.schema import HISTORY_PERIODS

LONG = [Period(2000 + k // 12, k % 12 + 1) for k in range(240)]
VAR = "codigo_articulo string, pgeo double, n long, producto_nombre string, cod_prod string, " \
    "cant_base double, articulo string, mes int, anio int"


def long_prices(spark, periods, keys=40, seed=1):
    rng = random.Random(seed)
    made = []
    for k in range(keys):
        code = None if k == 3 else f"c{k}"
        for p in periods:
            if rng.random() < (0.02, 0.3, 0.9)[k % 3] or (k == 5 and p == periods[0]):
                price = None if rng.random() < 0.3 else rng.random() + 1
                made.append((code, price, rng.randrange(9), "p", "c", 1.0, f"a{k}", p.mes, p.anio))
    return spark.createDataFrame(made, VAR), made


def plain_fill(made, periods):
    """Month by month: backward from the last, then forward from the second."""
    by_key = {}
    for code, price, n, *_, mes, anio in made:
        by_key.setdefault(code, {})[Period(anio, mes)] = (price, n)
    out = []
    for code, own in by_key.items():
        back, after, seen = {}, None, False
        for p in reversed(periods):
            seen |= p in own
            if seen:
                after = own[p][0] if p in own and own[p][0] is not None else after
                back[p] = after
        before = None
        for k, p in enumerate(periods):
            if k < 2:
                here = p in back
                price = back.get(p)
            else:
                here = p in back or before is not None
                price = back.get(p)
                price = before[0] if price is None and before is not None else price
            if here:
                out.append((code, price, own.get(p, (None, None))[1], p.mes, p.anio))
            if k >= 1:
                before = (price,) if here else None
    return sorted(((c, None if v is None else round(v, 6), n, m, a) for c, v, n, m, a in out), key=repr)


@pytest.mark.parametrize(
    "periods",
    [LONG, LONG[:1], LONG[:2], LONG[:3], LONG[::5], [*LONG[:4], *LONG[90:95], LONG[200]]],
    ids=["240", "one", "two", "three", "every-fifth", "apart"],
)
def test_long_fills_match_month_by_month(spark, periods):
    df, made = long_prices(spark, periods)
    got = fill.panel(df.repartition(5), "var", periods, described=False)
    assert rows(got, "codigo_articulo", "pgeo", "n", "mes", "anio") == plain_fill(made, periods)


def test_long_fills_shuffle_once_and_stay_small(spark):
    df, _ = long_prices(spark, LONG, keys=4)
    plans = []
    for periods in (LONG[:6], LONG):
        filled = fill.panel(df, "var", periods, described=False)
        plan = filled._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
        plans.append(filled._jdf.queryExecution().optimizedPlan().toString())
    # The plan does not grow with the months beyond their listing.
    assert len(plans[1]) < 2 * len(plans[0])


def test_attributes_of_the_last_month_fill_all_months(spark):
    periods = LONG[:5]
    last = periods[-1]
    made = [
        ("c", 1.0, 1, "old", "x", 1.0, "old", periods[1].mes, periods[1].anio),
        ("c", 2.0, 1, "new", "x", 1.0, "new", last.mes, last.anio),
        ("d", 2.0, 1, "gone", "x", 1.0, "gone", periods[2].mes, periods[2].anio),
    ]
    got = fill.panel(spark.createDataFrame(made, VAR), "var", periods)
    assert {(r["codigo_articulo"], r["articulo"]) for r in got.collect()} == {("c", "new"), ("d", None)}


def history_quotes(quotes, changed=()):
    made = []
    for k, period in enumerate(HISTORY_PERIODS):
        for d in range(4):
            price = 100.0 + d + k + (10 if period in changed else 0)
            made.append(quote(department=f"D{d}", price=price, period=period))
    return quotes(*made)


def test_a_correction_cleans_the_months_up_to_it(spark, quotes, tmp_path):
    path = str(tmp_path)
    first = build_history(history_quotes(quotes), state=path)
    assert first.reused == () and first.cleaned == HISTORY_PERIODS[::-1]
    again = build_history(history_quotes(quotes).repartition(3), state=path)
    assert again.cleaned == () and again.reused == HISTORY_PERIODS[::-1]
    march = HISTORY_PERIODS[3]
    corrected = history_quotes(quotes, [march])
    resumed = build_history(corrected, state=path)
    assert resumed.reused == HISTORY_PERIODS[:3:-1] and resumed.cleaned == HISTORY_PERIODS[3::-1]
    assert rows(resumed.dep) == rows(build_history(corrected).dep)
    assert rows(resumed.filled("dep")) == rows(build_history(corrected).filled("dep"))
    # Another factor is another fold, and the first one is still there.
    assert build_history(corrected, state=path, factor=1.5).reused == ()
    assert build_history(history_quotes(quotes), state=path).cleaned == ()


def test_a_failed_run_goes_on_where_it_stopped(spark, quotes, tmp_path, monkeypatch):
    path, df = str(tmp_path), history_quotes(quotes)
    whole, calls = history_module.dep_price_from_sums, []

    def failing(sums):
        calls.append(sums)
        if len(calls) == 3:
            raise RuntimeError("stopped")
        return whole(sums)

    monkeypatch.setattr(history_module, "dep_price_from_sums", failing)
    with pytest.raises(RuntimeError, match="stopped"):
        build_history(df, state=path, keep_votes=True)
    monkeypatch.undo()
    resumed = build_history(df, state=path, keep_votes=True)
    assert resumed.reused == HISTORY_PERIODS[:3:-1]
    assert rows(resumed.dep) == rows(build_history(df).dep)
    for period in HISTORY_PERIODS:
        assert resumed.audit(period).count() == build_history(df).audit(period).count()


def test_dependencies_that_do_not_hold_are_listed(quotes):
    df = quotes(
        quote("2000001", "A", region=1), quote("2000001", "A", region=2), quote("2000001", "A", region=2),
        quote("2000002", "B", region=3, base=1.0), quote("2000002", "B", region=3, base=2.0),
        quote("2000003", None, region=1), quote("2000003", None, region=None),
        quote("2000004", "C", articulo="x"), quote("2000004", "C", articulo=None),
    ).withColumn("cod_prod", F.lit("p"))
    got = dims.dependency_conflicts(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Scan") == 1
    assert rows(got) == sorted(
        [
            ("Departamento > region", "A", 2, "1", "2", 3),
            ("Departamento > region", None, 2, "1", "1", 2),
            ("codigo_articulo > cantidad_base", "2000002", 2, "1.0", "2.0", 2),
            ("codigo_articulo > articulo", "2000004", 2, "x", "x", 2),
            ("cod_prod > producto_nombre", "p", 4, "PROD-2000001", "PROD-2000004", 9),
        ],
        key=repr,
    )
    assert dims.dependency_conflicts(df.where("false")).count() == 0


def test_means_in_sql_are_those_of_the_functions(spark):
    register_functions(spark)
    df = spark.createDataFrame(
        [("a", 2.0, 1), ("a", 8.0, 3), ("a", None, 4), ("b", 0.0, 2), ("b", -1.0, None), ("c", None, 2)],
        "k string, x double, w long",
    )
    df.createOrReplaceTempView("means_in")
    wanted = df.groupBy("k").agg(
        geo_mean(F.col("x")).alias("g"), w_geo_mean(F.col("x"), F.col("w")).alias("v")
    )
    got = spark.sql(
        f"SELECT k, {geo_mean_sql('x')} AS g, {w_geo_mean_sql('x', 'w')} AS v FROM means_in GROUP BY k"
    )
    assert rows(got, "k", "g", "v") == rows(wanted, "k", "g", "v")
    assert rows(got, "k", "g") == [("a", 4.0), ("b", None), ("c", None)]
    odd = spark.sql("SELECT base_price(6D, 2D, 0D), base_price(6D, 2D, 3D), product_code('104000111')")
    assert tuple(odd.first()) == (None, 4.0, "1040001")
