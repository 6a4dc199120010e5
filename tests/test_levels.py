from __future__ import annotations

import math
import random

from conftest import quote, rows

from pricepanel.operators import levels as lv
from pricepanel.operators.quotes import valid_quotes


def prices(df, *keys):
    return {tuple(r[:-2]): (r[-2], r[-1]) for r in rows(df, *keys, "pgeo", "n")}


def test_negative_quote_counts_but_does_not_enter_the_mean(quotes):
    df = valid_quotes(quotes(quote(price=4.0), quote(price=9.0), quote(price=-5.0)))
    assert prices(lv.dep_price(df), "Departamento") == {("A",): (6.0, 3)}


def test_cell_without_positive_price_has_a_row_and_no_price(quotes):
    df = valid_quotes(quotes(quote(price=-5.0)))
    assert prices(lv.dep_price(df), "Departamento") == {("A",): (None, 1)}


def test_missing_price_keeps_its_weight(quotes):
    df = valid_quotes(quotes(quote(price=16.0), quote(price=-5.0, department="B")))
    assert prices(lv.reg_price(lv.dep_price(df)), "region") == {(1,): (4.0, 2)}


def test_group_of_missing_prices_only_has_mean_one(quotes):
    df = valid_quotes(quotes(quote(price=-5.0)))
    assert prices(lv.reg_price(lv.dep_price(df)), "region") == {(1,): (1.0, 1)}


def random_dep(quotes, seed=7, n=500):
    rng = random.Random(seed)
    places = {"A": 1, "B": 1, "C": 2, "D": None}
    data = []
    for _ in range(n):
        department = rng.choice(list(places))
        data.append(
            quote(
                code=rng.choice(["2000001", "2000002", "2000011", "104000111"]),
                department=department,
                region=places[department],
                price=math.exp(rng.gauss(3, 1)),
            )
        )
    return lv.dep_price(valid_quotes(quotes(*data)))


def test_cascade_equals_one_step(quotes):
    dep = random_dep(quotes)
    var = lv.var_price(lv.reg_price(dep))
    assert rows(var) == rows(lv.roll_up(dep, "var"))
    assert rows(lv.prod_price(var)) == rows(lv.roll_up(dep, "prod"))


def test_levels_together_equal_levels_apart(quotes):
    dep = random_dep(quotes)
    together = lv.price_levels(dep)
    for level, keys in (
        ("reg", ["codigo_articulo", "region"]),
        ("var", ["codigo_articulo"]),
        ("prod", ["cod_prod"]),
    ):
        part = together.where(f"nivel = '{level}'")
        assert prices(part, *keys) == prices(lv.roll_up(dep, level), *keys)


def test_quotes_are_summed_without_a_sort(quotes):
    """Text attributes must not turn the first pass over the quotes into a sort."""
    df = lv.dep_price_from_sums(lv.size_sums(valid_quotes(quotes(quote()))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    first_pass = plan[plan.rindex("Exchange") :]
    assert "HashAggregate" in first_pass
    assert "SortAggregate" not in first_pass and "Sort [" not in first_pass
