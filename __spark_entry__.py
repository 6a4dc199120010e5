"""Registered queries: each operator of the price panel over the whole sample tables."""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping
from functools import reduce
from importlib import import_module
from pathlib import Path
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pricepanel import History, RollForward, build_history, roll_forward  # noqa: E402
from pricepanel.operators import dims, fill  # noqa: E402
from pricepanel.operators import levels as lv  # noqa: E402
from pricepanel.operators import quotes as qt  # noqa: E402
from pricepanel.operators.outliers import (  # noqa: E402
    outlier_band_following,
    outlier_band_previous,
)
from pricepanel.operators.presentation import (  # noqa: E402
    popular_presentation,
    presentation_counts,
)
from pricepanel.schema import (  # noqa: E402
    LEVEL_ATTRIBUTES,
    LEVEL_KEYS,
    PERIOD,
    ROLL_FORWARD_PERIOD,
    Period,
    panel_columns,
    panel_schema,
)
from pricepanel.functions import geo_mean_sql, register_functions, w_geo_mean_sql  # noqa: E402
from pricepanel.sources.panels import (  # noqa: E402
    export_order,
    export_ordered,
    read_audit,
    read_ordered,
    read_panel,
    write_audit,
    write_by_period,
    write_panel,
)
from pricepanel.sources.published import (  # noqa: E402
    publish_panel,
    read_published,
    write_version,
)
from pricepanel.sources.quotes import read_quotes  # noqa: E402
from pricepanel.sources.star import star_quotes  # noqa: E402
from pricepanel.tables import scratch_path  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

APRIL, MAY = Period(2024, 4), Period(2024, 5)
LINE_SCHEMA = T.StructType(
    [T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType())]
)
LINE = ("l_orderkey", "l_linenumber", "codigo_articulo", "Departamento", "mes", "anio")
PRICES = ("pgeo", "pgeo_ant", "precio_base")


def show(df: DataFrame, *columns: str) -> DataFrame:
    """Final projection; prices are rounded here only."""
    return df.select(*(F.round(c, 4).alias(c) if c in PRICES else F.col(c) for c in columns))


def show_prices(df: DataFrame, level: str) -> DataFrame:
    columns = (*LEVEL_KEYS[level], "pgeo", "n", *LEVEL_ATTRIBUTES[level], "mes", "anio")
    return show(df, *columns)


def show_panel(df: DataFrame, level: str) -> DataFrame:
    return show(df, *panel_columns(level))


_landed: dict[tuple[str, str], str] = {}


def landed_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quote table stored by month, written once per application and directory.

    The operators expect quotes this way: a month is then a partition, where the
    sample tables would be joined and read in full for each month.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        path = scratch_path(spark, "export")
        quotes = star_quotes(spark, sf_dir)
        write_by_period(quotes, path)
        _landed[key] = path
    return read_quotes(spark, _landed[key], extra=LINE_SCHEMA)


_built: dict[tuple[str, str], History] = {}


def history(spark: SparkSession, sf_dir: str) -> History:
    """The back history, its months cleaned once per application and directory."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        _built[key] = build_history(landed_quotes(spark, sf_dir))
    return _built[key]


def forget(landed: bool = False) -> None:
    """Clean the months anew at the next use, and land the quotes anew if asked for."""
    _built.clear()
    if landed:
        _landed.clear()


def new_month(spark: SparkSession, sf_dir: str, **options: bool) -> RollForward:
    """June, rolled forward from the panel of the months before."""
    stored = history(spark, sf_dir).panels()
    return roll_forward(landed_quotes(spark, sf_dir), stored, **options)


def all_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qt.valid_quotes(qt.regime_filter(landed_quotes(spark, sf_dir)))


def voted_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lv.dep_price_from_sums(lv.size_sums(all_valid(spark, sf_dir)))


# Row operators


def period_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = qt.period_quotes(landed_quotes(spark, sf_dir), MAY)
    return show(rows, *LINE, "precio_actual", "tipo_precio")


def previous_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qt.with_previous_period(star_quotes(spark, sf_dir).select(*PERIOD).distinct())


def base_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(qt.with_base_price(star_quotes(spark, sf_dir)), *LINE, "precio_base")


def valid_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(qt.valid_quotes(star_quotes(spark, sf_dir)), *LINE, "precio_base")


def regime_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(qt.regime_filter(star_quotes(spark, sf_dir)), *LINE, "tipo_precio")


def product_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = star_quotes(spark, sf_dir).groupBy("codigo_articulo").agg(F.expr("count(*) AS n"))
    return qt.with_product_code(codes)


def normalize_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Region 4 is spelled out, so that one region is not a number.
    text = F.when(F.col("region") == 4, "IV").otherwise(F.col("region").cast("string"))
    quotes = star_quotes(spark, sf_dir).withColumn("region", text)
    return show(qt.normalize_region(quotes), "l_orderkey", "l_linenumber", "Departamento", "region")


# Outliers and the presentation vote


def band_following(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = landed_quotes(spark, sf_dir)
    may = lv.size_sums(qt.valid_quotes(qt.period_quotes(quotes, MAY)))
    april = qt.valid_quotes(qt.period_quotes(quotes, APRIL))
    kept = outlier_band_following(april, lv.dep_price_from_sums(may))
    return show(kept, *LINE, "precio_base", "pgeo")


def band_previous(keep_unreferenced: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        quotes = landed_quotes(spark, sf_dir)
        stored = history(spark, sf_dir).filled("dep")
        prior = fill.prior_prices(stored, "dep", ROLL_FORWARD_PERIOD.previous())
        june = qt.valid_quotes(qt.period_quotes(quotes, ROLL_FORWARD_PERIOD))
        kept = outlier_band_previous(june, prior, keep_unreferenced=keep_unreferenced)
        return show(kept, *LINE, "precio_base", "pgeo_ant")

    return query


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentation_counts(all_valid(spark, sf_dir)).withColumnRenamed("count", "votos")


def popular(spark: SparkSession, sf_dir: str) -> DataFrame:
    voted = popular_presentation(all_valid(spark, sf_dir))
    return show(voted, *LINE, "cantidad_actual", "precio_base")


# Average prices


def dep_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_prices(lv.dep_price(popular_presentation(all_valid(spark, sf_dir))), "dep")


def voted_dep_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_prices(voted_prices(spark, sf_dir), "dep")


def reg_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_prices(lv.reg_price(voted_prices(spark, sf_dir)), "reg")


def var_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_prices(lv.var_price(lv.reg_price(voted_prices(spark, sf_dir))), "var")


def prod_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    varieties = lv.var_price(lv.reg_price(voted_prices(spark, sf_dir)))
    return show_prices(lv.prod_price(varieties), "prod")


def price_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = lv.price_levels(voted_prices(spark, sf_dir))
    return show(prices, "nivel", "codigo_articulo", "region", "cod_prod", "pgeo", "n", "mes", "anio")


# Back history


def cleaned_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_prices(history(spark, sf_dir).dep, "dep")


def article_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(spark, sf_dir).articles.df


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.product_dim(history(spark, sf_dir).articles.df)


def description_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.description_conflicts(history(spark, sf_dir).articles.df)


def audit_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = build_history(landed_quotes(spark, sf_dir), keep_votes=True)
    used = (built.audit(period) for period in built.periods)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), used)
    return show(stacked, *LINE, "precio_base", "pgeo")


def of_history(method: str, present: Callable[[DataFrame, str], DataFrame], level: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(getattr(history(spark, sf_dir), method)(level), level)

    return query


# Roll-forward


def prior(level: str, slice_of: Callable[[DataFrame, str, Period], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = history(spark, sf_dir).filled(level)
        prior = slice_of(stored, level, ROLL_FORWARD_PERIOD.previous())
        return show(prior, *LEVEL_KEYS[level], "pgeo_ant")

    return query


def rolled(level: str, **options: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        carried = new_month(spark, sf_dir, **options).carried(level)
        return show(carried, *LEVEL_KEYS[level], "pgeo", "mes", "anio")

    return query


def rolled_fill(level: str, **options: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return show_panel(new_month(spark, sf_dir, **options).filled(level), level)

    return query


def audit_new_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(new_month(spark, sf_dir).audit(), *LINE, "precio_base", "pgeo_ant")


# Sinks, read back


def written_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export")
    write_panel(history(spark, sf_dir).panels(), path)
    return every_level(read_panel(spark, path))


def every_level(panels: Mapping[str, DataFrame]) -> DataFrame:
    tables = (
        show_panel(table, level).withColumn("nivel", F.lit(level))
        for level, table in panels.items()
    )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def rolled_from_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """June rolled forward from a panel written and read back."""
    path = scratch_path(spark, "export")
    write_panel(history(spark, sf_dir).panels(), path)
    rolled = roll_forward(landed_quotes(spark, sf_dir), read_panel(spark, path))
    return every_level(rolled.panels())


def rolled_text_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """June with regions as text, one of them not a number."""
    text = F.when(F.col("region") == 4, "IV").otherwise(F.col("region").cast("string"))
    quotes = landed_quotes(spark, sf_dir).withColumn("region", text)
    carried = roll_forward(quotes, history(spark, sf_dir).panels()).carried("dep")
    return show(carried, *LEVEL_KEYS["dep"], "pgeo", "mes", "anio")


def written_history_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audits of all months, written one by one and read back together."""
    path = scratch_path(spark, "export")
    built = build_history(landed_quotes(spark, sf_dir), keep_votes=True)
    for period in built.periods:
        write_audit(built.audit(period), path)
    return show(read_audit(spark, path, extra=LINE_SCHEMA), *LINE, "precio_base", "pgeo")


def written_audits_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of both jobs in one audit table, each with the price it was held against."""
    path = scratch_path(spark, "export")
    built = build_history(landed_quotes(spark, sf_dir), keep_votes=True)
    write_audit(built.audit(APRIL), path)
    write_audit(built.audit(MAY), path)
    write_audit(new_month(spark, sf_dir).audit(), path)
    stored = read_audit(spark, path, extra=LINE_SCHEMA)
    return show(stored, *LINE, "precio_base", "pgeo", "pgeo_ant")


def written_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export")
    write_audit(new_month(spark, sf_dir).audit(), path)
    return show(spark.read.parquet(path), *LINE, "precio_base", "pgeo_ant")


def published_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History and June published one after the other, then a publication that fails half-way.

    Readers see all of the first two, and nothing of the last at any level.
    """
    path = scratch_path(spark, "export")
    publish_panel(history(spark, sf_dir).panels(), path)
    june = roll_forward(landed_quotes(spark, sf_dir), read_published(spark, path))
    publish_panel(june.panels(), path)
    stored = read_published(spark, path)
    wrong = {lv: stored[lv].withColumn("pgeo", F.col("pgeo") * 2) for lv in ("dep", "reg")}
    write_version(wrong, path, "unfinished")
    return every_level(read_published(spark, path))


def ordered_export(level: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "export")
        columns, order = panel_columns(level), export_order(level)
        # Rounded before it is put in order: other columns than the price come first.
        rounded = show_panel(history(spark, sf_dir).filled(level), level)
        export_ordered(rounded, path, order)
        return read_ordered(spark, path, panel_schema(level)).select(*columns, "orden")

    return query


# Long histories, corrections and checks

LONG_PERIODS = tuple(Period(2004 + k // 12, k % 12 + 1) for k in range(240))


def long_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quotes dealt over 240 months, most varieties with gaps."""
    place = F.pmod(F.col("l_orderkey") * 31 + F.col("l_linenumber") * 7, F.lit(240))
    month = F.when(place % 3 == 0, place).otherwise(place - place % 40).cast("int")
    return star_quotes(spark, sf_dir).withColumns(
        {"anio": (2004 + F.floor(month / 12)).cast("int"), "mes": (month % 12 + 1).cast("int")}
    )


def long_fill(level: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        cells = lv.dep_price_from_sums(lv.size_sums(qt.valid_quotes(long_quotes(spark, sf_dir))))
        filled = fill.panel(lv.roll_up(cells, level), level, LONG_PERIODS, described=False)
        return show(filled, *LEVEL_KEYS[level], "pgeo", "n", "mes", "anio")

    return query


def corrected_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history whose March is corrected: the stored later months are taken again."""
    state = scratch_path(spark, "state")
    quotes = landed_quotes(spark, sf_dir)
    build_history(quotes, state=state)
    march = (F.col("mes") == 3) & (F.col("l_orderkey") % 2 == 0)
    price = F.when(march, F.col("precio_actual") * 1.1).otherwise(F.col("precio_actual"))
    again = build_history(quotes.withColumn("precio_actual", price), state=state)
    if again.reused != (MAY, APRIL):
        raise AssertionError(f"reused {again.reused}")
    return show_prices(again.dep, "dep")


def dependency_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dependency_conflicts(qt.with_product_code(star_quotes(spark, sf_dir)))


def means_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region prices from SQL text alone: both means and the price of the base quantity."""
    register_functions(spark)
    cells = f"""
        SELECT anio, mes, codigo_articulo, Departamento, min(region) AS region,
               {geo_mean_sql("precio_base")} AS pgeo, count(*) AS n
        FROM (SELECT *, base_price(precio_actual, cantidad_base, cantidad_actual) AS precio_base
              FROM {{quotes}})
        WHERE precio_base <> 0 GROUP BY anio, mes, codigo_articulo, Departamento"""
    means = f"""
        SELECT codigo_articulo, region, {w_geo_mean_sql("pgeo", "n")} AS pgeo, sum(n) AS n,
               min(product_code(codigo_articulo)) AS cod_prod, mes, anio
        FROM ({cells}) GROUP BY codigo_articulo, region, mes, anio"""
    found = spark.sql(means, quotes=star_quotes(spark, sf_dir))
    return show(found, "codigo_articulo", "region", "pgeo", "n", "cod_prod", "mes", "anio")


# Text operators, which may be absent


def optional(name: str) -> ModuleType | None:
    """A module of the text operators, or None where it or what it needs is missing."""
    try:
        return import_module(name)
    except ImportError as missing:
        print(f"without {name}: {missing}", file=sys.stderr)
        return None


def entry(spark: SparkSession) -> DataFrame:
    """The department panel of the back-history build, descriptions attached."""
    return queries()["fill_dep"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {
        "period_quotes": period_quotes,
        "previous_period": previous_period,
        "base_price": base_price,
        "valid_quotes": valid_quotes,
        "regime_filter": regime_filter,
        "product_code": product_code,
        "normalize_region": normalize_region,
        "outlier_band_following": band_following,
        "outlier_band_previous": band_previous(False),
        "outlier_band_previous_open": band_previous(True),
        "presentation_counts": counts,
        "popular_presentation": popular,
        "dep_price": dep_price,
        "voted_dep_price": voted_dep_price,
        "reg_price": reg_price,
        "var_price": var_price,
        "prod_price": prod_price,
        "price_levels": price_levels,
        "cleaned_history": cleaned_history,
        "article_dim": article_dim,
        "product_dim": product_dim,
        "description_conflicts": description_conflicts,
        "audit_quotes": audit_quotes,
        "audit_quotes_roll_forward": audit_new_month,
        "write_panel": written_panel,
        "write_audit": written_audit,
        "write_audit_history": written_history_audit,
        "write_audit_together": written_audits_together,
        "publish_panel": published_panel,
        "export_ordered_var": ordered_export("var"),
        "export_ordered_dep": ordered_export("dep"),
        "fill_long_var": long_fill("var"),
        "fill_long_reg": long_fill("reg"),
        "resumed_history": corrected_history,
        "dependency_conflicts": dependency_conflicts,
        "means_in_sql": means_in_sql,
        "roll_forward_from_storage": rolled_from_storage,
        "roll_forward_dep_text_region": rolled_text_region,
        "roll_forward_dep_open": rolled("dep", keep_unreferenced=True),
    }
    for level in LEVEL_KEYS:
        registered[f"backcast_{level}"] = of_history("backcast", show_prices, level)
        registered[f"forward_{level}"] = of_history("forward", show_prices, level)
        registered[f"panel_{level}"] = of_history("panel", show_prices, level)
        registered[f"fill_{level}"] = of_history("filled", show_panel, level)
        registered[f"prior_slice_{level}"] = prior(level, fill.prior_slice)
        registered[f"prior_prices_{level}"] = prior(level, fill.prior_prices)
        registered[f"roll_forward_{level}"] = rolled(level)
        registered[f"roll_forward_fill_{level}"] = rolled_fill(level)
        if level != "dep":
            registered[f"roll_forward_{level}_as_written"] = rolled(level, as_written=True)
            registered[f"roll_forward_fill_{level}_as_written"] = rolled_fill(
                level, as_written=True
            )
    if text := optional("pricepanel.llm.queries"):
        registered |= text.queries()
    if corpus := optional("corpus_pipeline"):
        registered["pipeline"] = corpus.run
    return registered


def oracle_sql() -> dict[str, str]:
    import oracle

    written = oracle.build()
    if text := optional("pricepanel.llm.queries"):
        written |= text.oracle_sql()
    if (corpus := optional("corpus_pipeline")) and corpus.ORACLE_SQL:
        written["pipeline"] = corpus.ORACLE_SQL
    return written
