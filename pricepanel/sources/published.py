"""Publication of the four panel tables together, or of none of them.

A publication writes the months it has into folders of its own, and only then a manifest that
names, for every table and month, the folder that holds it. Readers take the last whole
manifest. A run that fails before that leaves folders that nothing names: readers see the
panel as it was, at all levels, and the run may be repeated. Earlier manifests stay, so an
earlier state of the panel can be read too.

A table and all its months are one relation with partitions by ``anio`` and ``mes``, however
many publications they come from. Manifests are small: a line per table and month.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricepanel.schema import LEVEL_KEYS, PERIOD, panel_columns, panel_schema

MANIFESTS = "_manifests"
VERSION = "version"


class PublicationConflict(RuntimeError):
    """Another publication was finished meanwhile; this one has left no trace."""


@dataclass(frozen=True)
class Store:
    """Folders and small files of the file system that Spark writes to."""

    spark: SparkSession

    def _path(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return folder, folder.getFileSystem(conf)

    def names(self, path: str) -> list[str]:
        """What a folder holds; nothing if there is none."""
        folder, fs = self._path(path)
        if not fs.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(folder))

    def create(self, path: str, text: str) -> None:
        """Write a file that must not exist yet."""
        file, fs = self._path(path)
        out = fs.create(file, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def text(self, path: str) -> str:
        file, fs = self._path(path)
        stream = fs.open(file)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        folder, fs = self._path(path)
        fs.delete(folder, True)


def _read_manifest(store: Store, path: str, number: int) -> dict[str, dict[str, str]] | None:
    """level to month to version, or None of a manifest that was not finished."""
    lines = store.text(f"{path}/{MANIFESTS}/{number:08}.json").splitlines()
    if not lines or lines[-1] != f"end {len(lines) - 1}":
        return None
    found: dict[str, dict[str, str]] = {}
    for entry in map(json.loads, lines[:-1]):
        found.setdefault(entry["level"], {})[entry["month"]] = entry["version"]
    return found


def publications(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all finished publications, first to last."""
    store = Store(spark)
    names = (n for n in store.names(f"{path}/{MANIFESTS}") if n.endswith(".json"))
    numbers = (int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())
    return [n for n in numbers if _read_manifest(store, path, n) is not None]


def _written_months(store: Store, folder: str, version: str) -> list[str]:
    """The months, as partition folders, that a version has written."""
    return [
        f"{year}/{month}"
        for year in store.names(folder)
        if year.startswith("anio=")
        for month in store.names(f"{folder}/{year}")
        if f"{VERSION}={version}" in store.names(f"{folder}/{year}/{month}")
    ]


def write_version(panels: Mapping[str, DataFrame], path: str, version: str) -> None:
    """The tables' months in folders that no manifest names yet."""
    for level, table in panels.items():
        (
            table.select(*panel_columns(level))
            .withColumn(VERSION, F.lit(version))
            .hint("rebalance", *PERIOD)
            .write.mode("append")
            .partitionBy(*PERIOD, VERSION)
            .parquet(f"{path}/{level}")
        )


def publish_panel(panels: Mapping[str, DataFrame], path: str) -> int:
    """Write the tables and switch readers to them; the number of the publication.

    Months that the tables have replace those published before, other months stay. If
    another publication has been finished since this one began, it fails with
    ``PublicationConflict``, as what it was computed from may have changed.
    """
    spark = next(iter(panels.values())).sparkSession
    store = Store(spark)
    done = publications(spark, path)
    current = _read_manifest(store, path, done[-1]) if done else {}
    number = 1 + max(
        (int(n.split(".")[0]) for n in store.names(f"{path}/{MANIFESTS}") if n[:8].isdigit()),
        default=0,
    )
    version = f"{number:08}-{uuid.uuid4().hex[:12]}"
    write_version(panels, path, version)
    merged = {level: dict(months) for level, months in current.items()}
    for level in panels:
        months = _written_months(store, f"{path}/{level}", version)
        merged.setdefault(level, {}).update(dict.fromkeys(months, version))
    lines = [
        json.dumps({"level": level, "month": month, "version": v})
        for level, months in sorted(merged.items())
        for month, v in sorted(months.items())
    ]
    if publications(spark, path) != done:
        raise PublicationConflict(path)
    try:
        # The one step that counts: a file that did not exist, whole once it has its last line.
        text = "\n".join([*lines, f"end {len(lines)}"])
        store.create(f"{path}/{MANIFESTS}/{number:08}.json", text)
    except Exception as failed:
        if f"{number:08}.json" in store.names(f"{path}/{MANIFESTS}"):
            raise PublicationConflict(path) from failed
        raise
    return number


def read_published(
    spark: SparkSession, path: str, number: int | None = None
) -> dict[str, DataFrame]:
    """The four tables of the last publication, or of an earlier one; months are pruned."""
    store = Store(spark)
    done = publications(spark, path)
    if not done or (number is not None and number not in done):
        raise FileNotFoundError(f"no such publication of {path}")
    manifest = _read_manifest(store, path, done[-1] if number is None else number)
    tables = {}
    for level in LEVEL_KEYS:
        schema = panel_schema(level)
        folders = [
            f"{path}/{level}/{month}/{VERSION}={version}"
            for month, version in sorted(manifest.get(level, {}).items())
        ]
        if folders:
            reader = spark.read.option("basePath", f"{path}/{level}")
            read = reader.schema(schema.add(VERSION, T.StringType())).parquet(*folders)
            tables[level] = read.select(*panel_columns(level))
        else:
            tables[level] = spark.createDataFrame([], schema)
    return tables


def remove_unpublished(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete folders that none of the last ``keep`` publications names, and earlier manifests.

    Not while a publication is running. Returns what was deleted.
    """
    store = Store(spark)
    done = publications(spark, path)
    kept = done[-keep:] if keep else []
    named = {
        f"{path}/{level}/{month}/{VERSION}={version}"
        for number in kept
        for level, months in _read_manifest(store, path, number).items()
        for month, version in months.items()
    }
    gone = [f"{path}/{MANIFESTS}/{n:08}.json" for n in done if n not in kept]
    for level in LEVEL_KEYS:
        for year in store.names(f"{path}/{level}"):
            for month in store.names(f"{path}/{level}/{year}") if year.startswith("anio=") else ():
                folder = f"{path}/{level}/{year}/{month}"
                versions = (n for n in store.names(folder) if n.startswith(f"{VERSION}="))
                gone += [f"{folder}/{n}" for n in versions if f"{folder}/{n}" not in named]
    for folder in gone:
        store.delete(folder)
    return gone
