from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from conftest import quote, rows

from pricepanel.operators.levels import dep_price, dep_price_from_sums, size_sums
from pricepanel.operators.presentation import popular_presentation, presentation_counts
from pricepanel.operators.quotes import valid_quotes
from pricepanel.schema import BY_WEIGHT_CODES, Period


def sizes(df):
    return [r[0] for r in rows(df, "cantidad_actual")]


def test_there_are_42_by_weight_codes():
    assert len(set(BY_WEIGHT_CODES)) == 42


def test_ties_are_kept(quotes):
    df = quotes(*(quote(size=s) for s in (1.0, 1.0, 2.0, 2.0, 3.0)))
    assert sizes(popular_presentation(df)) == [1.0, 1.0, 2.0, 2.0]


def test_by_weight_codes_skip_the_vote(quotes):
    df = quotes(*(quote(code="1113011", size=s) for s in (1.0, 1.0, 2.0)))
    assert sizes(popular_presentation(df)) == [1.0, 1.0, 2.0]


def test_null_code_department_and_size_take_part(quotes):
    df = quotes(
        *(quote(code=None, size=s) for s in (1.0, 1.0, 2.0)),
        *(quote(department=None, size=s) for s in (4.0, 5.0, 5.0)),
        *(quote(department="B", size=s) for s in (None, None, 6.0)),
    )
    assert sizes(popular_presentation(df)) == [1.0, 1.0, 5.0, 5.0, None, None]


def test_months_vote_apart(quotes):
    df = quotes(
        *(quote(size=s, period=Period(2024, 4)) for s in (1.0, 1.0, 2.0)),
        *(quote(size=s, period=Period(2024, 5)) for s in (1.0, 2.0, 2.0)),
    )
    kept = rows(popular_presentation(df), "mes", "cantidad_actual")
    assert kept == [(4, 1.0), (4, 1.0), (5, 2.0), (5, 2.0)]


def test_vote_is_idempotent(quotes):
    once = popular_presentation(quotes(*(quote(size=s) for s in (1.0, 1.0, 2.0, 2.0, 3.0))))
    assert rows(popular_presentation(once)) == rows(once)


def random_quotes(seed, n=400):
    rng = random.Random(seed)
    return [
        quote(
            code=rng.choice(["2000001", "2000002", "1113011", None]),
            department=rng.choice(["A", "B", None]),
            size=rng.choice([1.0, 2.0, 3.0, 4.0, 5.0]),
            price=rng.choice([1.0, 2.0, 4.0, 8.0, -3.0]),
            # Descriptions that contradict each other must not change the count.
            articulo=rng.choice(["x", "y", None]),
        )
        for _ in range(n)
    ]


def brute_force(data):
    votes = defaultdict(Counter)
    for q in data:
        votes[q[0], q[3]][q[5]] += 1
    return [
        q
        for q in data
        if q[0] in BY_WEIGHT_CODES or votes[q[0], q[3]][q[5]] == max(votes[q[0], q[3]].values())
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_vote_matches_brute_force(quotes, seed):
    data = random_quotes(seed)
    wanted = sorted(map(tuple, brute_force(data)), key=repr)
    assert rows(popular_presentation(quotes(*data))) == wanted


def test_vote_of_a_table_too_large_to_broadcast(quotes, no_broadcast):
    data = random_quotes(3)
    wanted = sorted(map(tuple, brute_force(data)), key=repr)
    assert rows(popular_presentation(quotes(*data))) == wanted


@pytest.mark.parametrize("seed", [4, 5])
def test_vote_and_mean_from_sums_equal_the_two_steps(quotes, seed):
    valid = valid_quotes(quotes(*random_quotes(seed)))
    fused = dep_price_from_sums(size_sums(valid))
    stepwise = dep_price(popular_presentation(valid))
    assert rows(fused) == rows(stepwise)


def test_counts(quotes):
    df = quotes(*(quote(size=s) for s in (1.0, 1.0, 2.0)))
    assert rows(presentation_counts(df), "cantidad_actual", "count") == [(1.0, 2), (2.0, 1)]
