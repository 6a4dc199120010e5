from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricepanel.llm import oracle, quality_rules
from pricepanel.tables import BROADCAST_CONF

from .conftest import by_name

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(hit),
    )


def measured(df):
    m = F.col("m")
    shown = df.select("doc_id", quality_rules.measures(F.col("text")).alias("m"))
    rows = shown.select("doc_id", *(m[c].alias(c) for c in quality_rules.MEASURES)).collect()
    return {r["doc_id"]: tuple(r)[1:] for r in rows}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab \n\t\x0b#é|", max_size=40), min_size=1, max_size=12))
def test_measures_match_brute_force(documents, texts):
    got = measured(documents(*enumerate(texts)))
    assert got == {k: brute(t) for k, t in enumerate(texts)}


def test_many_repeated_windows_take_the_sorting_path(documents):
    words = [f"w{i}" for i in range(100)]
    twice = " ".join(words + words + ["tail"])
    overlapping = "a a a a a"
    assert measured(documents((1, twice), (2, overlapping))) == {
        1: brute(twice), 2: brute(overlapping),
    }


def test_edge_cases(documents, as_sql):
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    good = " ".join(f"w{i}" for i in range(60))
    df = documents(
        (1, None), (2, ""), (3, " \n\t"), (4, long), (5, good), (5, good, None), (6, "b " * 80),
        (None, good, None), extra=("kept", "host", "m", "__failed", "__host"),
    )
    judged = quality_rules.judge(df).drop("host_rejected")
    assert by_name(judged) == as_sql(oracle.QUALITY_RULES, documents=df)
    wanted = sorted(repr(r["doc_id"]) for r in judged.where("kept").collect())
    # Most documents of the host that has a name are bad, those without a host are good.
    assert wanted == ["5", "None"][: len(wanted)] and wanted
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == wanted


def test_an_empty_table(documents):
    df = documents((1, "x")).where("false")
    assert quality_rules.judge(df).count() == 0 == quality_rules.keep_good(df).count()


@pytest.mark.parametrize("limit", [None, "-1"])
def test_a_bad_host_loses_its_good_documents(spark, documents, limit):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "too short", "bad") for i in range(40)]
    rows += [(100 + i, good, "bad") for i in range(5)]
    rows += [(200 + i, good, f"h{i % 5}") for i in range(60)]
    if limit:
        spark.conf.set(BROADCAST_CONF, limit)
    try:
        judged = quality_rules.judge(documents(*rows)).collect()
        kept = {r["doc_id"] for r in quality_rules.keep_good(documents(*rows)).collect()}
    finally:
        spark.conf.unset(BROADCAST_CONF)
    assert {r["doc_id"] for r in judged if r["kept"]} == {200 + i for i in range(60)} == kept


def test_a_small_bad_host_is_shrunk_towards_the_others(documents):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "too short", "tiny"), (2, good, "tiny")]
    rows += [(10 + i, good if i % 10 else "short", f"h{i % 8}") for i in range(400)]
    judged = {r["doc_id"]: r for r in quality_rules.judge(documents(*rows)).collect()}
    assert judged[2]["kept"] and not judged[2]["host_rejected"]


def test_no_python_in_the_plan(documents):
    plan = quality_rules.keep_good(documents((1, "a")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
