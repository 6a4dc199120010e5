from __future__ import annotations

import math
import random

import pytest
from conftest import quote, rows
from literal import CODE, history_panels
from literal import roll_forward as literal_roll_forward
from pyspark.sql import functions as F

from pricepanel import build_history, read_panel, read_quotes, roll_forward, write_audit, write_panel
from pricepanel.operators import dims
from pricepanel.operators import levels as lv
from pricepanel.operators import quotes as qt
from pricepanel.operators.outliers import outlier_band_following, outlier_band_previous
from pricepanel.schema import (
    HISTORY_PERIODS,
    LEVEL_KEYS,
    QUOTE_SCHEMA,
    REGIME_PERIODS,
    ROLL_FORWARD_PERIOD,
    Period,
    panel_columns,
)
from pricepanel.sources.panels import write_by_period

APRIL, MAY, JUNE = Period(2024, 4), Period(2024, 5), ROLL_FORWARD_PERIOD


def random_quotes(seed, n=1500):
    rng = random.Random(seed)
    places = {"A": 1, "B": 1, "C": 2, "D": 3, None: None}
    codes = ["1113011", "104000111", None, *(f"200{i:03}1" for i in range(14))]
    out = []
    for _ in range(n):
        department = rng.choice(list(places))
        price = math.exp(rng.gauss(3, 0.2)) * rng.choice([1, 1, 1, 1, 1, 1, 1, 1, 0, -1])
        out.append(
            quote(
                code=rng.choice(codes),
                department=department,
                region=places[department],
                price=rng.choice([price] * 30 + [None]),
                size=rng.choice([1.0, 1.0, 1.0, 1.1, 0.0, None]),
                period=rng.choice([*HISTORY_PERIODS, JUNE]),
                regime=rng.choice(["IPC-2023"] * 5 + ["IPC-2010", None]),
            )
        )
    return out


def by_period(panel, level):
    out = {}
    for row in panel.select(*LEVEL_KEYS[level], "pgeo", "anio", "mes").collect():
        *key, price, anio, mes = row
        month = out.setdefault(Period(anio, mes), {})
        assert tuple(key) not in month, "one row per key and month"
        month[tuple(key)] = price
    return out


def assert_same(got, wanted):
    assert got.keys() == wanted.keys()
    for key, price in wanted.items():
        assert got[key] == (price if price is None else pytest.approx(price)), key


@pytest.fixture(scope="module")
def sample():
    return random_quotes(21)


@pytest.fixture(scope="module")
def built(spark, sample):
    df = spark.createDataFrame(sample, QUOTE_SCHEMA)
    return df, build_history(df, keep_votes=True)


def test_history_matches_the_literal_program(built, sample):
    wanted = history_panels(sample, HISTORY_PERIODS, REGIME_PERIODS)
    for level in LEVEL_KEYS:
        got = by_period(built[1].panel(level), level)
        assert got.keys() == wanted[level].keys()
        for period in HISTORY_PERIODS:
            assert_same(got[period], wanted[level][period])


def test_roll_forward_matches_the_literal_program(built, sample):
    panels = history_panels(sample, HISTORY_PERIODS, REGIME_PERIODS)
    wanted = literal_roll_forward(sample, panels, JUNE)
    # Without descriptions every key has one row, as in the literal tables.
    stored = {
        level: built[1].panel(level).select(*panel_columns(level)) for level in LEVEL_KEYS
    }
    rolled = roll_forward(built[0], stored)
    for level in LEVEL_KEYS:
        got = by_period(rolled.carried(level), level)
        assert got.keys() == {JUNE}
        assert_same(got[JUNE], wanted[level])


def test_audit_is_the_same_with_and_without_kept_counts(built):
    kept = built[1]
    counted = build_history(built[0])
    for period in (HISTORY_PERIODS[0], MAY):
        assert rows(kept.audit(period)) == rows(counted.audit(period))
    assert "pgeo" not in kept.audit(MAY).columns
    assert "pgeo" in kept.audit(APRIL).columns


def test_audited_quotes_give_the_department_prices(built):
    from pricepanel.operators.levels import dep_price

    columns = ["codigo_articulo", "Departamento", "pgeo", "n"]
    for period in HISTORY_PERIODS:
        audited = built[1].audit(period).drop("pgeo")
        assert rows(dep_price(audited), *columns) == rows(
            built[1].dep_by_period[period].df, *columns
        )


def test_history_of_keys_too_many_to_broadcast(spark, built, no_broadcast, sample):
    quotes = spark.createDataFrame(sample, QUOTE_SCHEMA)
    periods = HISTORY_PERIODS[-2:]
    wanted = history_panels(sample, periods, REGIME_PERIODS)["dep"]
    got = by_period(build_history(quotes, periods).filled("dep").distinct(), "dep")
    for period in periods:
        assert_same(got[period], wanted[period])


# Bands


def reference(spark, *data):
    return spark.createDataFrame(
        list(data), "codigo_articulo string, region int, Departamento string, pgeo double"
    )


def valid(quotes, *rows_):
    return qt.valid_quotes(quotes(*rows_))


def test_band_edges(spark, quotes):
    ref = reference(spark, ("2000001", 1, "A", 100.0))
    df = valid(quotes, *(quote(price=p) for p in (80.0, 125.0, 79.99, 125.01, 100.0)))
    following = outlier_band_following(df, ref)
    previous = outlier_band_previous(df, ref.withColumnRenamed("pgeo", "pgeo_ant"))
    assert rows(following, "precio_base") == [(100.0,), (125.0,), (80.0,)]
    assert rows(previous, "precio_base") == [(100.0,), (125.0,), (80.0,)]


def test_quotes_without_reference(spark, quotes):
    ref = reference(spark, ("2000001", 1, "A", None), ("2000002", 9, "A", 10.0))
    df = valid(
        quotes,
        quote(price=5.0),
        quote(price=-5.0),
        quote(code="new", price=7.0),
        quote(code="2000002", price=10.0),
    )
    kept = rows(outlier_band_following(df, ref), "codigo_articulo", "precio_base", "pgeo")
    assert kept == [("2000001", 5.0, 5.0), ("2000002", 10.0, 10.0), ("new", 7.0, 7.0)]
    prior = ref.withColumnRenamed("pgeo", "pgeo_ant")
    # The region differs from the stored one, so there is no previous price.
    assert outlier_band_previous(df, prior).count() == 0
    opened = outlier_band_previous(df, prior, keep_unreferenced=True)
    assert rows(opened, "codigo_articulo") == [("2000001",), ("2000002",), ("new",)]


# Descriptions


def test_article_absent_in_the_last_month_has_no_description(quotes):
    df = quotes(quote(code="old1", period=Period(2024, 2)), quote(code="new1", period=MAY))
    filled = build_history(df).filled("dep")
    assert {r for r in rows(filled, "codigo_articulo", "articulo")} == {
        ("old1", None),
        ("new1", "VAR-new1"),
    }
    assert filled.where("codigo_articulo = 'old1'").count() == 6


def test_two_descriptions_double_the_rows(quotes):
    df = quotes(
        quote(department="A", articulo="one"), quote(department="B", articulo="two")
    )
    history = build_history(df, [MAY])
    assert rows(history.filled("dep"), "Departamento", "articulo") == [
        ("A", "one"), ("A", "two"), ("B", "one"), ("B", "two"),
    ]
    assert rows(dims.description_conflicts(history.articles.df)) == [("2000001", 2)]
    # The stored panel has two rows per cell; the cell has one price and is described twice.
    rolled = roll_forward(quotes(quote(period=JUNE)), history.panels())
    assert rows(rolled.carried("dep"), "Departamento") == [("A",), ("B",)]
    assert rolled.filled("dep").count() == 4
    assert rolled.audit().count() == 1


def test_rows_do_not_multiply_from_month_to_month(spark, quotes, tmp_path):
    df = quotes(
        quote(department="A", articulo="one"), quote(department="B", articulo="two"),
        quote(code="2000002", price=7.0),
    )
    path = str(tmp_path / "panel")
    write_panel(build_history(df, [MAY]).panels(), path)
    for month in range(6, 10):
        new = quotes(quote(period=Period(2024, month)))
        rolled = roll_forward(new, read_panel(spark, path), Period(2024, month))
        write_panel(rolled.panels(), path)
        stored = read_panel(spark, path)["dep"].where(f"mes = {month}")
        assert rows(stored.groupBy("codigo_articulo", "Departamento").count()) == [
            ("2000001", "A", 2), ("2000001", "B", 2), ("2000002", "A", 1),
        ]


def test_descriptions_do_not_weigh_in_the_product_price(quotes):
    may = quotes(
        quote(department="A", price=10.0, articulo="one"),
        quote(department="B", price=10.0, articulo="two"),
        quote(code="2000002", department="A", price=40.0),
        quote(code="2000002", department="B", price=40.0),
    )
    june = quotes(
        *(
            quote(code=code, department=department, price=price, period=JUNE)
            for code, price in (("2000001", 10.0), ("2000002", 40.0))
            for department in ("A", "B")
        )
    )
    rolled = roll_forward(june, build_history(may, [MAY]).panels())
    assert rows(rolled.carried("prod"), "cod_prod", "pgeo") == [("200000", 20.0)]


def test_text_regions_become_numbers_in_both_jobs(quotes):
    text = quotes(quote(), quote(department="B")).withColumn(
        "region", F.expr("CASE Departamento WHEN 'A' THEN '1' ELSE 'IV' END")
    )
    history = build_history(text, [MAY])
    assert rows(history.filled("dep"), "Departamento", "region") == [("A", 1), ("B", None)]
    june = text.withColumn("mes", F.lit(6))
    rolled = roll_forward(june, history.panels())
    assert rows(rolled.audit(), "Departamento", "region") == [("A", 1), ("B", None)]


def test_no_months_are_refused(quotes):
    with pytest.raises(ValueError, match="at least one month"):
        build_history(quotes(quote()), [])


def test_incomplete_descriptions_are_left_out(quotes):
    df = quotes(quote(articulo=None), quote(department="B", producto=None))
    assert build_history(df, [MAY]).articles.df.count() == 0


# Roll-forward


@pytest.fixture
def stored(quotes):
    df = quotes(
        quote(department="A", price=10.0),
        quote(department="B", price=40.0),
        quote(code="2000002", department="A", price=3.0),
    )
    return build_history(df, [MAY]).panels()


def test_new_article_does_not_enter(quotes, stored):
    rolled = roll_forward(quotes(quote(code="9999991", price=1.0, period=JUNE)), stored)
    assert rows(rolled.filled("dep"), "codigo_articulo", "Departamento", "pgeo", "mes") == [
        ("2000001", "A", 10.0, 6), ("2000001", "B", 40.0, 6), ("2000002", "A", 3.0, 6),
    ]
    opened = roll_forward(
        quotes(quote(code="9999991", price=1.0, period=JUNE)), stored, keep_unreferenced=True
    )
    assert ("9999991",) in rows(opened.carried("var"), "codigo_articulo")


def test_region_price_as_intended_and_as_written(quotes, stored):
    june = quotes(
        quote(department="A", price=11.0, period=JUNE),
        quote(department="B", price=44.0, period=JUNE),
    )
    intended = roll_forward(june, stored).filled("reg")
    assert rows(intended, "codigo_articulo", "pgeo") == [("2000001", 22.0), ("2000002", 3.0)]
    written = roll_forward(june, stored, as_written=True).filled("reg")
    assert rows(written, "codigo_articulo", "pgeo") == [
        ("2000001", 11.0), ("2000001", 44.0), ("2000002", 3.0),
    ]


def test_january_follows_december(quotes):
    december, january = Period(2023, 12), Period(2024, 1)
    stored = build_history(quotes(quote(period=december)), [december]).panels()
    rolled = roll_forward(quotes(quote(price=110.0, period=january)), stored, january)
    assert rows(rolled.filled("prod"), "pgeo", "anio", "mes") == [(110.0, 2024, 1)]


# Storage


def test_written_panel_feeds_the_next_month(spark, quotes, stored, tmp_path):
    path = str(tmp_path / "panel")
    write_panel(stored, path)
    june = quotes(quote(department="A", price=11.0, period=JUNE))
    rolled = roll_forward(june, read_panel(spark, path))
    write_panel(rolled.panels(), path)
    write_panel(rolled.panels(), path)  # a repeated run replaces its own month only
    panel = read_panel(spark, path)
    assert panel["dep"].count() == 6
    assert rows(panel["dep"].where("Departamento = 'A' AND cod_prod = '200000'"), "mes", "pgeo") == [
        (5, 10.0), (5, 3.0), (6, 11.0), (6, 3.0),
    ]
    for level in LEVEL_KEYS:
        assert tuple(panel[level].columns) == panel_columns(level)


def test_panel_as_csv(spark, stored, tmp_path):
    path = str(tmp_path / "csv")
    write_panel(stored, path, "csv")
    panel = read_panel(spark, path, "csv")
    for level in LEVEL_KEYS:
        assert rows(panel[level]) == rows(stored[level])


def test_audit_is_stored_by_month(spark, built, tmp_path):
    path = str(tmp_path / "audit")
    for period in (MAY, APRIL):
        write_audit(built[1].audit(period), path)
    folders = {f"{p.parent.name}/{p.name}" for p in (tmp_path / "audit").glob("anio=*/mes=*")}
    assert folders == {"anio=2024/mes=4", "anio=2024/mes=5"}


@pytest.mark.parametrize("source", ["parquet", "orc", "json", "csv"])
def test_quotes_of_some_months(spark, quotes, tmp_path, source):
    path = str(tmp_path / source)
    df = quotes(quote(period=MAY), quote(code="z", period=APRIL), quote(period=JUNE, region=None))
    write_by_period(df, path, source)
    read = read_quotes(spark, path, [APRIL, MAY], source)
    if source != "json":
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "anio#" in plan[plan.index("PartitionFilters") :].partition("]")[0]
    assert rows(read, "codigo_articulo", "mes") == [("2000001", 5), ("z", 4)]
    assert rows(read_quotes(spark, path, source=source), *QUOTE_SCHEMA.names) == rows(df)


def test_a_month_is_aggregated_with_few_exchanges(quotes):
    priced = lv.dep_price_from_sums(lv.size_sums(valid(quotes, quote())))
    plan = priced._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    # Text is aggregated in the last step only, on the partitioning that is there.
    last = plan.index("Window")
    assert "SortAggregate" in plan[:last] and "SortAggregate" not in plan[last:]


def test_a_cleaning_step_reads_one_month(spark, quotes, tmp_path):
    path = str(tmp_path / "quotes")
    write_by_period(quotes(quote(period=MAY), quote(period=APRIL)), path)
    history = build_history(read_quotes(spark, path), [APRIL, MAY])
    plan = history.banded[APRIL]._jdf.queryExecution().executedPlan().toString()
    assert "(anio#" in plan[plan.index("PartitionFilters") :]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert {r[CODE] for r in history.banded[APRIL].collect()} == {"2000001"}
