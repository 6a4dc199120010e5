from __future__ import annotations

import random

import pytest

from pricepanel.llm import mixing, oracle
from pricepanel.tables import BROADCAST_CONF

from .conftest import by_name


def corpus(n=600, sources=7, seed=2):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        source = None if k % 50 == 0 else f"s{min(rng.randrange(sources), rng.randrange(sources))}"
        rows.append((k, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(40))), source))
    return [*rows, (n, None, "s0"), (n + 1, "", "void"), (n + 2, "w " * 9000, "s1")]


def reference_targets(sizes, share, cap):
    """Give out by weight, clamp, share out the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(cap * sizes[s] for s in fixed)
        level = left / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not above:
            return {s: cap * sizes[s] if s in fixed else level * weight[s] for s in names}
        fixed |= above


@pytest.mark.parametrize("limit", [None, "-1"])
def test_mix_matches_sql_and_a_plain_water_fill(spark, documents, as_sql, limit):
    df = documents(*corpus(), extra=("size", "key", "target"))
    if limit:
        spark.conf.set(BROADCAST_CONF, limit)
    try:
        got = mixing.mix(df).cache()
        assert got.count() == df.count()
    finally:
        spark.conf.unset(BROADCAST_CONF)
    assert by_name(got.drop("repetitions")) == as_sql(oracle.MIXING, documents=df)
    source = {r["doc_id"]: r["source"] for r in df.collect()}
    rows = got.collect()
    sizes, taken, targets = {}, {}, {}
    for r in rows:
        s = source[r["doc_id"]]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        targets[s] = r["target"]
        assert r["taken"] in {k * r["size"] for k in (0, 1, 2)}
    wanted = reference_targets(sizes, 1.5, 2)
    assert targets == pytest.approx(wanted)
    largest = {s: max(r["size"] for r in rows if source[r["doc_id"]] == s) for s in sizes}
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in sizes)


def test_documents_are_repeated_as_planned(documents):
    df = documents(*corpus(), extra=("key", "whole", "__row"))
    plan = {r["doc_id"]: r["repetitions"] for r in mixing.mix(df).collect()}
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {k: n for k, n in plan.items() if n}
    again = mixing.mixed_documents(df.repartition(7))
    assert mixed.exceptAll(again).isEmpty() and again.exceptAll(mixed).isEmpty()


def test_another_seed_takes_other_documents(documents):
    df = documents(*corpus())
    first = {tuple(r) for r in mixing.mix(df).select("doc_id", "taken").collect()}
    second = {tuple(r) for r in mixing.mix(df, seed="other").select("doc_id", "taken").collect()}
    assert first != second


def test_all_sources_at_their_maximum(documents):
    df = documents((1, "a b", "x"), (2, "c d e", "y"))
    got = mixing.mix(df, share=5.0).select("doc_id", "taken").collect()
    assert sorted(map(tuple, got)) == [(1, 4), (2, 6)]


def test_repeated_rows_and_empty_tables(documents):
    df = documents((1, "a b", "x"), (1, "a b", "x"), (None, "a", None), (2, None, "y"))
    got = mixing.mix(df)
    assert got.count() == 4
    assert {r["taken"] for r in got.where("size = 0").collect()} == {0}
    nothing = df.where("false")
    assert mixing.mix(nothing).count() == 0 == mixing.mixed_documents(nothing).count()


@pytest.mark.parametrize("same_text", [True, False])
def test_rows_without_ids_end_near_the_target(spark, documents, as_sql, same_text):
    """Ties: a source of rows that agree in id, size and text, or in id and size."""
    text = "w " * 99
    rows = [(None, text + ("w" if same_text else f"w{k}"), "a") for k in range(450)]
    rows += [(k, "w " * 300, "b") for k in range(40)] + [(7, "v " * 100, "b")] * 60
    df = documents(*rows)
    got = mixing.mix(df).cache()
    taken, targets = {}, {}
    for r in got.collect():
        name = "a" if r["doc_id"] is None else "b"
        taken[name] = taken.get(name, 0) + r["taken"]
        targets[name] = r["target"]
    assert got.count() == 550
    assert abs(taken["a"] - targets["a"]) <= 100 and abs(taken["b"] - targets["b"]) <= 300
    assert by_name(got.drop("repetitions")) == as_sql(oracle.MIXING, documents=df)
    copies = mixing.mixed_documents(df)
    assert copies.columns == df.columns
    words = copies.selectExpr("source", "size(split(trim(text), ' ')) AS n").groupBy("source").sum("n")
    assert {r[0]: r[1] for r in words.collect()} == taken
