"""Article descriptions and their re-attachment to the filled panels."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.schema import ARTICLE_COLUMNS, LEVEL_KEYS, PERIOD, panel_columns
from pricepanel.tables import Table, lookup_join, materialize


def article_dim(dep_panel: DataFrame, complete_only: bool = True) -> DataFrame:
    """Distinct article descriptions; the history leaves out incomplete ones."""
    described = dep_panel.select(*ARTICLE_COLUMNS)
    return (described.dropna("any") if complete_only else described).distinct()


def product_dim(articles: DataFrame) -> DataFrame:
    """Distinct product names."""
    return articles.select("cod_prod", "producto_nombre").distinct()


def description_conflicts(articles: DataFrame) -> DataFrame:
    """Codes with more than one description, which double their rows when attached."""
    return (
        articles.groupBy("codigo_articulo")
        .agg(F.count(F.lit(1)).alias("descripciones"))
        .where(F.col("descripciones") > 1)
    )


# What should follow from what: determining and dependent column.
DEPENDENCIES = (
    ("codigo_articulo", "articulo"),
    ("codigo_articulo", "producto_nombre"),
    ("codigo_articulo", "cantidad_base"),
    ("cod_prod", "producto_nombre"),
    ("Departamento", "region"),
)


def dependency_conflicts(
    quotes: DataFrame, dependencies: Sequence[tuple[str, str]] = DEPENDENCIES
) -> DataFrame:
    """Values that determine more than one value of a column that should follow from them.

    One row per dependency and determining value, with the number of dependent values (a
    missing one counts as a value), the smallest and largest of them as text, and the
    quotes concerned. All dependencies are counted in one pass by grouping sets, with
    map-side combination, so a value with most of the quotes costs no more than another.
    """
    columns = list(dict.fromkeys(c for pair in dependencies for c in pair))
    plain = [F.col(c) for c in columns]
    sets = [[F.col(left), F.col(right)] for left, right in dependencies]
    grouped = quotes.groupingSets(sets, *plain).agg(
        F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("__n")
    )

    def of_set(pick: Callable[[str, str], Column]) -> Column:
        """What ``pick`` gives for the dependency that a row belongs to."""
        chosen = F.lit(None)
        for left, right in dependencies:
            bits = "".join("0" if c in (left, right) else "1" for c in columns)
            chosen = F.when(F.col("__set") == int(bits, 2), pick(left, right)).otherwise(chosen)
        return chosen

    values = grouped.select(
        of_set(lambda left, right: F.lit(f"{left} > {right}")).alias("dependencia"),
        of_set(lambda left, right: F.col(left).cast("string")).alias("clave"),
        of_set(lambda left, right: F.col(right).cast("string")).alias("valor"),
        "__n",
    )
    return (
        values.groupBy("dependencia", "clave")
        .agg(
            F.count(F.lit(1)).alias("valores"),
            F.min("valor").alias("minimo"),
            F.max("valor").alias("maximo"),
            F.sum("__n").alias("precios"),
        )
        .where("valores > 1")
    )


def fill_level(panel: DataFrame, level: str, articles: DataFrame | Table) -> DataFrame:
    """A finished panel table: keys, price, month and the descriptions of the code."""
    bare = panel.select(*LEVEL_KEYS[level], "pgeo", *PERIOD)
    articles = articles if isinstance(articles, Table) else materialize(articles)
    if level == "prod":
        products = articles.derive(product_dim(articles.df))
        described = lookup_join(bare, products, ["cod_prod"])
    else:
        described = lookup_join(bare, articles, ["codigo_articulo"])
    return described.select(*panel_columns(level))
