from __future__ import annotations

from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pricepanel.tables import BROADCAST_CONF, lookup_join, materialize, null_safe_join


@pytest.fixture
def big(spark):
    """Half of the rows have one key; some keys are null or not in the table."""
    return spark.range(4000).select(
        F.when(F.col("id") < 2000, "hot")
        .when(F.col("id") % 50 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string")))
        .alias("k"),
        "id",
    )


@pytest.fixture
def table(spark):
    data = [("hot", 1), (None, 2), *((f"k{i}", 10 + i) for i in range(0, 40, 2))]
    return spark.createDataFrame(data, "k string, v int")


def expected(big, table, how):
    values = {r["k"]: r["v"] for r in table.collect()}
    out = Counter()
    for r in big.collect():
        if r["k"] in values:
            out[(r["k"], r["id"], values[r["k"]])] += 1
        elif how == "left":
            out[(r["k"], r["id"], None)] += 1
    return out


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_is_the_same_broadcast_or_split(spark, big, table, how):
    wanted = expected(big, table, how)
    small = lookup_join(big, table, ["k"], how)
    assert Counter(map(tuple, small.select("k", "id", "v").collect())) == wanted
    spark.conf.set(BROADCAST_CONF, "-1")
    try:
        split = lookup_join(big, table, ["k"], how, hot_share=0.1)
        assert Counter(map(tuple, split.select("k", "id", "v").collect())) == wanted
        none_hot = lookup_join(big, table, ["k"], how, hot_share=1.0)
        assert Counter(map(tuple, none_hot.select("k", "id", "v").collect())) == wanted
    finally:
        spark.conf.unset(BROADCAST_CONF)


def test_an_oversize_table_costs_one_scan_and_spreads_the_hot_key(no_broadcast, big, table, tmp_path):
    big.write.parquet(str(tmp_path / "big"))
    stored = big.sparkSession.read.parquet(str(tmp_path / "big"))
    joined = lookup_join(stored, table, ["k"], hot_share=0.1)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "SortMergeJoin" in plan and "Union" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("__salt") >= 4
    assert joined.where("k = 'hot'").count() == stored.where("k = 'hot'").count()


def test_duplicate_table_rows_fan_out(spark):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    assert rows(lookup_join(left, right, ["k"]), "k", "v") == [("a", 1), ("a", 2), ("b", None)]


def test_full_join_matches_null_keys(spark):
    left = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    right = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    joined = null_safe_join(left, right, ["k"], "full")
    assert rows(joined, "k", "a", "b") == [("x", 2, None), ("y", None, 4), (None, 1, 3)]


def test_materialized_tables_are_measured(spark, table):
    kept = materialize(table)
    assert rows(kept.df) == rows(table)
    assert kept.size > 22 * (40 + 2 * 16)
    assert materialize(table.where("v < 0")).size == 0


def test_wide_text_counts_towards_the_size(spark):
    narrow = spark.createDataFrame([("x",)], "k string")
    wide = spark.createDataFrame([("x" * 10_000,)], "k string")
    assert materialize(wide).size - materialize(narrow).size == 9_999


def test_checkpoints_go_where_the_session_says(spark):
    from pricepanel.tables import shared_dir

    assert spark.conf.get("spark.checkpoint.dir") in shared_dir(spark)


def test_without_a_named_folder_the_warehouse_holds_the_checkpoints(tmp_path):
    from types import SimpleNamespace

    from pricepanel.tables import shared_dir

    conf = {"spark.sql.warehouse.dir": f"file:{tmp_path}/house"}
    named = []
    context = SimpleNamespace(
        getCheckpointDir=lambda: named[-1] if named else None, setCheckpointDir=named.append
    )
    session = SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda k, default=None: conf.get(k, default))
    )
    assert shared_dir(session) == f"file:{tmp_path}/house/_checkpoints"
    conf["spark.checkpoint.dir"] = "store://shared"
    named.clear()
    assert shared_dir(session) == "store://shared"


def test_a_derived_table_is_bounded_by_its_source(table):
    kept = materialize(table)
    assert kept.derive(kept.df.where("v < 0")).size == kept.size


def test_known_frequencies_replace_the_count(no_broadcast, big, table):
    counted = big.groupBy("k").count()
    split = lookup_join(big, table, ["k"], "left_semi", 0.1, frequencies=counted)
    keys = {r["k"] for r in table.collect()}
    wanted = sorted(((r["k"], r["id"]) for r in big.collect() if r["k"] in keys), key=repr)
    assert rows(split, "k", "id") == wanted


def test_scratch_folders_are_shared_and_removed(spark):
    from pathlib import Path

    from pricepanel.tables import _remove, scratch_path, shared_dir

    path = scratch_path(spark, "kind")
    assert path.startswith(shared_dir(spark)) and path != scratch_path(spark, "kind")
    spark.range(3).write.parquet(path)
    local = Path(path.removeprefix("file:"))
    assert local.exists()
    _remove(spark.sparkContext, path)
    assert not local.exists()
