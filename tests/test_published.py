"""Publication of all panel tables together, ordered exports and the audit schema."""

from __future__ import annotations

import pytest
from conftest import quote, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricepanel import Period, read_audit, read_published, write_audit
from pricepanel.schema import AUDIT_SCHEMA, LEVEL_KEYS, QUOTE_SCHEMA, panel_columns, panel_schema
from pricepanel.sources import published as pb
from pricepanel.sources.panels import export_order, export_ordered, read_ordered
from pricepanel.sources.quotes import month_predicates, read_quotes


@pytest.fixture
def panels(spark):
    """Tables of some months with one price everywhere."""

    def make(price, *months):
        made = {}
        for level in LEVEL_KEYS:
            values = {
                "codigo_articulo": "20000", "region": 1, "Departamento": None, "pgeo": price,
                "articulo": "a", "cant_base": 1.0, "cod_prod": "2000", "producto_nombre": "p",
            }
            found = [{**values, "anio": 2024, "mes": m} for m in months]
            picked = [tuple(r[c] for c in panel_columns(level)) for r in found]
            made[level] = spark.createDataFrame(picked, panel_schema(level))
        return made

    return make


def prices(spark, path, number=None):
    found = read_published(spark, path, number)
    return {level: rows(table, "mes", "pgeo") for level, table in found.items()}


def everywhere(*pairs):
    return {level: sorted(pairs, key=repr) for level in LEVEL_KEYS}


def test_months_are_replaced_and_earlier_states_stay_readable(spark, panels, tmp_path):
    path = str(tmp_path)
    assert pb.publish_panel(panels(1.0, 4, 5), path) == 1
    assert pb.publish_panel(panels(2.0, 5, 6), path) == 2
    assert prices(spark, path) == everywhere((4, 1.0), (5, 2.0), (6, 2.0))
    assert prices(spark, path, 1) == everywhere((4, 1.0), (5, 1.0))
    with pytest.raises(FileNotFoundError):
        read_published(spark, path, 9)


class Killed(Exception):
    pass


def test_a_run_killed_after_two_tables_changes_nothing(spark, panels, tmp_path, monkeypatch):
    path = str(tmp_path)
    pb.publish_panel(panels(1.0, 5), path)
    new = panels(2.0, 5, 6)
    whole = pb.write_version

    def killed(tables, folder, version):
        whole({level: tables[level] for level in ("dep", "reg")}, folder, version)
        raise Killed

    monkeypatch.setattr(pb, "write_version", killed)
    with pytest.raises(Killed):
        pb.publish_panel(new, path)
    monkeypatch.undo()
    assert prices(spark, path) == everywhere((5, 1.0))
    # The run is repeated, and what the killed one has left can be removed.
    assert pb.publish_panel(new, path) == 2
    assert prices(spark, path) == everywhere((5, 2.0), (6, 2.0))
    gone = pb.remove_unpublished(spark, path)
    assert len(gone) == 4 + 2 * 2 + 1
    assert prices(spark, path) == everywhere((5, 2.0), (6, 2.0))


def test_an_unfinished_manifest_is_not_read(spark, panels, tmp_path):
    path = str(tmp_path)
    pb.publish_panel(panels(1.0, 5), path)
    (tmp_path / pb.MANIFESTS / "00000002.json").write_text('{"level": "dep"')
    assert prices(spark, path) == everywhere((5, 1.0))
    assert pb.publish_panel(panels(3.0, 6), path) == 3
    assert prices(spark, path) == everywhere((5, 1.0), (6, 3.0))


def test_of_two_publications_at_once_one_fails(spark, panels, tmp_path, monkeypatch):
    path = str(tmp_path)
    pb.publish_panel(panels(1.0, 5), path)
    whole = pb.write_version

    def meanwhile(tables, folder, version):
        whole(tables, folder, version)
        monkeypatch.undo()
        pb.publish_panel(panels(7.0, 5), path)

    monkeypatch.setattr(pb, "write_version", meanwhile)
    with pytest.raises(pb.PublicationConflict):
        pb.publish_panel(panels(2.0, 5), path)
    assert prices(spark, path) == everywhere((5, 7.0))


def test_a_month_filter_prunes_folders(spark, panels, tmp_path):
    pb.publish_panel(panels(1.0, 4, 5, 6), str(tmp_path))
    dep = read_published(spark, str(tmp_path))["dep"].where("anio = 2024 AND mes = 5")
    assert len(dep.inputFiles()) == 3  # before pruning
    plan = dep._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan and "(mes" in plan.split("PartitionFilters")[1]
    assert dep.count() == 1


def test_ordered_files_hold_all_rows_in_order(spark, tmp_path):
    level = "var"
    table = spark.range(5000).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("c"), F.col("id") * 7919 % 400)).alias(
            "codigo_articulo"
        ),
        (F.col("id") % 13 / 3).alias("pgeo"),
        F.lit("a").alias("articulo"), F.lit(1.0).alias("cant_base"), F.lit("p").alias("cod_prod"),
        F.when(F.col("id") % 3 > 0, "n").alias("producto_nombre"),
        (2020 + F.col("id") % 5).cast("int").alias("anio"),
        (1 + F.col("id") % 12).cast("int").alias("mes"),
    ).select(*panel_columns(level)).repartition(6)
    order = export_order(level)
    path = str(tmp_path / "ordered")
    export_ordered(table, path, order, files=5)
    files = sorted((tmp_path / "ordered").glob("part-*.parquet"))
    assert len(files) == 5
    read = [r for f in files for r in spark.read.parquet(str(f)).select(*order).collect()]
    wanted = sorted(
        (tuple(r) for r in table.select(*order).collect()),
        key=lambda r: tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in r),
    )
    assert [tuple(r) for r in read] == wanted
    placed = read_ordered(spark, path, panel_schema(level)).orderBy("orden").collect()
    assert [r["orden"] for r in placed] == list(range(1, 5001))
    assert [tuple(r[c] for c in order) for r in placed] == wanted
    # In text formats too.
    export_ordered(table, str(tmp_path / "text"), order, "csv", 3, header="true")
    assert len(list((tmp_path / "text").glob("part-*.csv"))) == 3


def test_audits_of_different_months_share_a_schema(spark, quotes, tmp_path):
    path = str(tmp_path)
    may = quotes(quote(), quote(price=5.0)).withColumn("precio_base", F.lit(1.0))
    april = quotes(quote(period=Period(2024, 4))).withColumns(
        {"precio_base": F.lit(2.0), "pgeo": F.lit(3.0), "line": F.lit(7).cast("long")}
    )
    june = quotes(quote(period=Period(2024, 6))).withColumns(
        {"precio_base": F.lit(2.0), "pgeo_ant": F.lit(4)}
    )
    for month in (may, april, june):
        write_audit(month, path)
    extra = T.StructType([T.StructField("line", T.LongType())])
    got = read_audit(spark, path, extra=extra)
    assert rows(got, "mes", "pgeo", "pgeo_ant", "line") == sorted(
        [(5, None, None, None)] * 2 + [(4, 3.0, None, 7), (6, None, 4.0, None)], key=repr
    )
    assert [f.name for f in read_audit(spark, path).schema] == [f.name for f in AUDIT_SCHEMA]
    write_audit(may.limit(0), path)  # nothing to replace
    assert read_audit(spark, path).count() == 4


def test_database_months_are_queries_of_their_own(spark, monkeypatch):
    """The read itself has not been run: no database is at hand here."""
    months = [Period(2024, 5), Period(2023, 12), Period(2024, 5)]
    assert month_predicates(months) == ["anio = 2023 AND mes = 12", "anio = 2024 AND mes = 5"]
    divided = month_predicates(months[:1], 3, "id")
    assert len(divided) == 3
    numbers = spark.range(-50, 50).selectExpr("id", "2024 AS anio", "5 AS mes")
    numbers = numbers.unionByName(numbers.selectExpr("CAST(NULL AS LONG) AS id", "anio", "mes"))
    assert sum(numbers.where(p).count() for p in divided) == numbers.count()
    with pytest.raises(ValueError):
        month_predicates(months, 2)

    asked = {}

    def jdbc(self, url, table, predicates=None, properties=None, **_):
        asked.update(url=url, table=table, predicates=predicates, properties=properties)
        return spark.createDataFrame([], QUOTE_SCHEMA)

    monkeypatch.setattr(type(spark.read), "jdbc", jdbc)
    read = read_quotes(
        spark, periods=months, source="jdbc", url="jdbc:x", dbtable="q", user="u", parts="2",
        partsColumn="id",
    )
    assert read.count() == 0 and len(asked["predicates"]) == 4
    assert asked["properties"] == {"user": "u"} and asked["table"] == "q"
