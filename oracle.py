"""The registered queries as DuckDB SQL, written out step by step with plain joins.

The months are chained by joins one after the other, unlike the Spark side, which
fills all months at once, so the two check each other.
"""

from __future__ import annotations

from pricepanel.schema import BY_WEIGHT_CODES, HISTORY_PERIODS, ROLL_FORWARD_PERIOD

BY_WEIGHT = ", ".join(f"'{code}'" for code in BY_WEIGHT_CODES)
IS_BY_WEIGHT = f"coalesce(codigo_articulo IN ({BY_WEIGHT}), false)"

# One name per month, first to last.
MONTHS = dict(zip(("dic", "ene", "feb", "mar", "abr", "may"), HISTORY_PERIODS, strict=True))

KEYS = {
    "dep": ["codigo_articulo", "region", "Departamento"],
    "reg": ["codigo_articulo", "region"],
    "var": ["codigo_articulo"],
    "prod": ["cod_prod"],
}
ATTRIBUTES = {
    "dep": ["producto_nombre", "cod_prod", "cant_base", "articulo"],
    "reg": ["producto_nombre", "cod_prod", "cant_base", "articulo"],
    "var": ["producto_nombre", "cod_prod", "cant_base", "articulo"],
    "prod": ["producto_nombre"],
}
FINER = {"reg": "dep", "var": "reg", "prod": "var"}
DESCRIBED = {
    "dep": ["articulo", "cant_base", "cod_prod", "producto_nombre"],
    "reg": ["articulo", "cant_base", "cod_prod", "producto_nombre"],
    "var": ["articulo", "cant_base", "cod_prod", "producto_nombre"],
    "prod": ["producto_nombre"],
}

QUOTES = f"""
SELECT q.*, 'VAR-' || codigo_articulo || variant AS articulo, 'PROD-' || cod AS producto_nombre
FROM (
  SELECT r.*,
         CASE WHEN codigo_articulo = '104000111' THEN '1040001'
              ELSE substring(codigo_articulo, 1, length(codigo_articulo) - 1) END AS cod
  FROM (
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_orderkey % 1009 = 0 THEN NULL
                WHEN p_size = 50 THEN [{BY_WEIGHT}][1 + p_partkey % {len(BY_WEIGHT_CODES)}]
                WHEN p_size = 49 THEN '104000111'
                WHEN p_size = 48 AND year(l_shipdate) = 1995 THEN '2999001'
                WHEN p_size = 47 AND year(l_shipdate) < 1999 THEN '2999011'
                WHEN p_size = 46 AND year(l_shipdate) = 2001 THEN '2999021'
                ELSE CAST(2000000 + p_size * 10 + p_partkey % 4 AS VARCHAR)
           END AS codigo_articulo,
           CASE WHEN s_suppkey % 50 <> 7 THEN n_name END AS Departamento,
           CAST(CASE WHEN s_suppkey % 50 <> 7 THEN
                  CASE WHEN n_nationkey % 6 = 1 AND year(l_shipdate) = 2001
                         OR n_nationkey % 12 = 5 AND year(l_shipdate) < 1998
                       THEN (n_regionkey + 1) % 5 ELSE n_regionkey END
                END AS INTEGER) AS region,
           CASE WHEN l_orderkey % 89 = 0 THEN NULL
                WHEN l_orderkey % 83 = 0 THEN CAST(0.0 AS DOUBLE)
                ELSE CAST(ceil(l_quantity / 10.0) AS DOUBLE) END AS cantidad_actual,
           1 + p_size % 4 * CAST(0.25 AS DOUBLE) AS cantidad_base,
           CASE WHEN l_orderkey % 97 = 0 THEN CAST(0.0 AS DOUBLE)
                WHEN l_orderkey % 101 = 0 THEN -1 ELSE 1 END
             * (p_retailprice * (1 - l_discount) * (1 + 8 * l_tax)
                * (1 + (l_orderkey % 9973) / CAST(999983.0 AS DOUBLE))
                * CAST(ceil(l_quantity / 10.0) AS DOUBLE)) AS precio_actual,
           CASE WHEN l_linenumber = 2 AND l_orderkey % 53 = 0 THEN NULL
                WHEN l_linenumber = 1 AND year(l_shipdate) <= 1996 THEN 'IPC-2010'
                ELSE 'IPC-2023' END AS tipo_precio,
           CASE WHEN p_size = 45 AND p_partkey % 4 < 2
                THEN '-R' || CASE WHEN s_suppkey % 50 <> 7 THEN n_regionkey END
                ELSE '' END AS variant,
           CAST(CASE WHEN year(l_shipdate) = 1995 THEN 12
                     ELSE year(l_shipdate) - 1995 END AS INTEGER) AS mes,
           CAST(CASE WHEN year(l_shipdate) = 1995 THEN 2023 ELSE 2024 END AS INTEGER) AS anio
    FROM lineitem
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
  ) r
) q"""

BASE_PRICE = "precio_actual * cantidad_base / nullif(cantidad_actual, 0) AS precio_base"
GEO_MEAN = "exp(avg(CASE WHEN precio_base > 0 THEN ln(precio_base) END))"
W_GEO_MEAN = "exp(coalesce(sum(CASE WHEN pgeo > 0 THEN n * ln(pgeo) END), 0) / sum(n))"


def commas(columns: list[str], prefix: str = "") -> str:
    return ", ".join(prefix + c for c in columns)


def on(keys: list[str], left: str = "a", right: str = "b") -> str:
    return " AND ".join(f"{left}.{k} IS NOT DISTINCT FROM {right}.{k}" for k in keys)


def merged(keys: list[str]) -> str:
    return ", ".join(f"coalesce(a.{k}, b.{k}) AS {k}" for k in keys)


def statement(ctes: dict[str, str], final: str) -> str:
    """Only the named tables that ``final`` leads to, each computed once."""
    needed: set[str] = set()
    pending = [final]
    while pending:
        words = set(pending.pop().replace(",", " ").replace("(", " ").replace(")", " ").split())
        found = (words & ctes.keys()) - needed
        needed |= found
        pending += [ctes[name] for name in found]
    kept = [f"{name} AS MATERIALIZED ({sql})" for name, sql in ctes.items() if name in needed]
    return "WITH " + ",\n".join(kept) + "\n" + final if kept else final


def valid(source: str) -> str:
    return (
        f"SELECT * FROM (SELECT *, {BASE_PRICE} FROM {source}) p"
        " WHERE precio_base IS NOT NULL AND precio_base <> 0"
    )


def popular(source: str, cell: list[str]) -> str:
    size = [*cell, "cantidad_actual"]
    return f"""
    SELECT a.* FROM (SELECT * FROM {source} WHERE NOT {IS_BY_WEIGHT}) a
    JOIN (
      SELECT c.* FROM
        (SELECT {commas(size)}, count(*) AS votes FROM {source} GROUP BY {commas(size)}) c
        JOIN (SELECT {commas(cell)}, max(votes) AS most FROM
                (SELECT {commas(size)}, count(*) AS votes FROM {source} GROUP BY {commas(size)}) v
              GROUP BY {commas(cell)}) m
        ON {on(cell, "c", "m")} AND c.votes = m.most
    ) b ON {on(size)}
    UNION ALL SELECT * FROM {source} WHERE {IS_BY_WEIGHT}"""


def dep(source: str) -> str:
    return f"""
    SELECT d.*, CASE WHEN cod = '10400011' THEN '1040001' ELSE cod END AS cod_prod FROM (
      SELECT codigo_articulo, Departamento, {GEO_MEAN} AS pgeo, count(*) AS n,
             min(producto_nombre) AS producto_nombre, min(cantidad_base) AS cant_base,
             min(articulo) AS articulo, min(region) AS region, mes, anio,
             substring(codigo_articulo, 1, length(codigo_articulo) - 1) AS cod
      FROM {source} GROUP BY codigo_articulo, Departamento, mes, anio) d"""


def level(name: str, source: str) -> str:
    kept = ", ".join(f"min({a}) AS {a}" for a in ATTRIBUTES[name])
    keys = commas(KEYS[name])
    return f"""
    SELECT {keys}, {W_GEO_MEAN} AS pgeo, CAST(sum(n) AS BIGINT) AS n, {kept}, mes, anio
    FROM {source} GROUP BY {keys}, mes, anio"""


def history_tables(quotes: str = QUOTES) -> dict[str, str]:
    t = {"quotes": quotes}
    following = None
    for name, (anio, mes) in reversed(MONTHS.items()):
        rows = f"SELECT * FROM quotes WHERE anio = {anio} AND mes = {mes}"
        if name in ("dic", "ene"):
            rows += " AND tipo_precio = 'IPC-2023'"
        t[f"bol_{name}"] = rows
        t[f"valid_{name}"] = valid(f"bol_{name}")
        source = f"valid_{name}"
        if following:
            t[f"banded_{name}"] = f"""
            SELECT * FROM (
              SELECT a.*, coalesce(b.pgeo, a.precio_base) AS pgeo FROM valid_{name} a
              LEFT JOIN dep_{following} b ON {on(["codigo_articulo", "Departamento"])}) j
            WHERE precio_base <= pgeo * 1.25 AND precio_base >= pgeo / 1.25"""
            source = f"banded_{name}"
        t[f"base_{name}"] = popular(source, ["codigo_articulo", "Departamento"])
        t[f"dep_{name}"] = dep(f"base_{name}")
        for coarse, fine in FINER.items():
            t[f"{coarse}_{name}"] = level(coarse, f"{fine}_{name}")
        following = name

    names = list(MONTHS)
    for lv, keys in KEYS.items():
        attributes = ATTRIBUTES[lv]
        columns = commas([*keys, "pgeo", "n", *attributes, "mes", "anio"])
        t[f"{lv}_may_adj"] = f"SELECT {columns} FROM {lv}_may"
        for name, after in reversed(list(zip(names, names[1:], strict=False))):
            anio, mes = MONTHS[name]
            t[f"{lv}_{name}_adj"] = f"""
            SELECT {merged(keys)}, coalesce(a.pgeo, b.pgeo) AS pgeo, a.n,
                   {commas(attributes, "b.")}, {mes} AS mes, {anio} AS anio
            FROM {lv}_{name} a FULL JOIN {lv}_{after}_adj b ON {on(keys)}"""
        t[f"{lv}_ene_imp"] = f"SELECT * FROM {lv}_ene_adj"
        for before, name in zip(names[1:], names[2:], strict=False):
            anio, mes = MONTHS[name]
            t[f"{lv}_{name}_imp"] = f"""
            SELECT {merged(keys)}, coalesce(b.pgeo, a.pgeo) AS pgeo, b.n,
                   {commas(attributes, "b.")}, {mes} AS mes, {anio} AS anio
            FROM {lv}_{before}_imp a FULL JOIN {lv}_{name}_adj b ON {on(keys)}"""

        def stack(parts: list[str], columns: str = columns) -> str:
            return " UNION ALL ".join(f"SELECT {columns} FROM {p}" for p in parts)

        t[f"{lv}_clean"] = stack([f"{lv}_{name}" for name in names])
        t[f"{lv}_adj"] = stack([f"{lv}_{name}_adj" for name in names])
        t[f"{lv}_imp"] = stack([f"{lv}_{name}_imp" for name in names[2:]])
        t[f"{lv}_panel"] = stack(
            [f"{lv}_{n}_adj" for n in names[:2]] + [f"{lv}_{n}_imp" for n in names[2:]]
        )
    articles = commas(["codigo_articulo", *DESCRIBED["dep"]])
    complete = " AND ".join(f"{c} IS NOT NULL" for c in ["codigo_articulo", *DESCRIBED["dep"]])
    t["articles"] = f"SELECT DISTINCT {articles} FROM dep_panel WHERE {complete}"
    for lv in KEYS:
        t[f"{lv}_fill"] = described(lv, f"{lv}_panel", "articles")
    return t


def described(lv: str, panel: str, articles: str) -> str:
    keys = KEYS[lv]
    key, source = "codigo_articulo", articles
    if lv == "prod":
        key, source = "cod_prod", f"(SELECT DISTINCT cod_prod, producto_nombre FROM {articles})"
    return f"""
    SELECT {commas([*keys, "pgeo"], "a.")}, {commas(DESCRIBED[lv], "b.")}, a.mes, a.anio
    FROM {panel} a LEFT JOIN {source} b ON {on([key])}"""


def roll_forward_tables() -> dict[str, str]:
    t = history_tables()
    anio, mes = ROLL_FORWARD_PERIOD
    before = ROLL_FORWARD_PERIOD.previous()
    for lv, keys in KEYS.items():
        t[f"{lv}_ant"] = f"""
        SELECT {commas(keys)}, pgeo AS pgeo_ant FROM {lv}_fill
        WHERE anio = {before.anio} AND mes = {before.mes}"""
        t[f"{lv}_one"] = f"""
        SELECT {commas(keys)}, min(pgeo_ant) AS pgeo_ant FROM {lv}_ant GROUP BY {commas(keys)}"""
    t["bol_jun"] = f"SELECT * FROM quotes WHERE anio = {anio} AND mes = {mes}"
    t["valid_jun"] = valid("bol_jun")
    cell = ["codigo_articulo", "Departamento"]
    # A run takes June's quotes, what stands for a missing prior price, and the prior prices:
    # one per key, or as the monthly program has them, one per key and description.
    runs = {
        "jun": ("valid_jun", "b.pgeo_ant", "dep_one"),
        "open_jun": ("valid_jun", "coalesce(b.pgeo_ant, a.precio_base)", "dep_one"),
        "written_jun": ("valid_jun", "b.pgeo_ant", "dep_ant"),
        "text_jun": ("valid_text_jun", "b.pgeo_ant", "dep_one"),
    }
    t["bol_text_jun"] = """
    SELECT * REPLACE (CASE WHEN region <> 4 THEN region END AS region) FROM bol_jun"""
    t["valid_text_jun"] = valid("bol_text_jun")
    for run, (rows, price, prior) in runs.items():
        t[f"banded_{run}"] = f"""
        SELECT a.*, b.pgeo_ant FROM {rows} a LEFT JOIN {prior} b ON {on(KEYS["dep"])}
        WHERE a.precio_base <= {price} * 1.25 AND a.precio_base >= {price} / 1.25"""
        t[f"base_{run}"] = popular(f"banded_{run}", cell)
        t[f"dep_{run}"] = dep(f"base_{run}")
    for coarse, fine in FINER.items():
        t[f"{coarse}_jun"] = level(coarse, f"{fine}_jun")

    def carried(lv: str, fresh: str, prior: str = "one") -> str:
        return f"""
        SELECT {merged(KEYS[lv])}, coalesce(b.pgeo, a.pgeo_ant) AS pgeo,
               {mes} AS mes, {anio} AS anio
        FROM {lv}_{prior} a FULL JOIN {fresh} b ON {on(KEYS[lv])}"""

    articles = commas(["codigo_articulo", *DESCRIBED["dep"]])
    t["articles_ant"] = f"""
    SELECT DISTINCT {articles} FROM dep_fill
    WHERE anio = {before.anio} AND mes = {before.mes}"""
    t["dep_open_carried"] = carried("dep", "dep_open_jun")
    t["dep_text_carried"] = carried("dep", "dep_text_jun")
    for lv in KEYS:
        t[f"{lv}_carried"] = carried(lv, f"{lv}_jun")
        t[f"{lv}_carried_written"] = carried(lv, "dep_written_jun", "ant")
        t[f"{lv}_fill_jun"] = described(lv, f"{lv}_carried", "articles_ant")
        t[f"{lv}_fill_written"] = described(lv, f"{lv}_carried_written", "articles_ant")
    return t


def show(source: str, columns: list[str]) -> str:
    """Final projection; prices are rounded here only."""
    prices = ("pgeo", "pgeo_ant", "precio_base")
    shown = [f"round({c}, 4) AS {c}" if c in prices else c for c in columns]
    return f"SELECT {commas(shown)} FROM {source}"


LINE = ["l_orderkey", "l_linenumber", "codigo_articulo", "Departamento", "mes", "anio"]


AUDITED = [*LINE, "precio_base", "pgeo", "pgeo_ant"]


def panel_columns(lv: str) -> list[str]:
    return [*KEYS[lv], "pgeo", *DESCRIBED[lv], "mes", "anio"]


def price_columns(lv: str) -> list[str]:
    return [*KEYS[lv], "pgeo", "n", *ATTRIBUTES[lv], "mes", "anio"]


def every_level(suffix: str) -> str:
    everything = panel_columns("dep")
    parts = []
    for lv in KEYS:
        own = panel_columns(lv)
        shown = [
            ("round(pgeo, 4) AS pgeo" if c == "pgeo" else c) if c in own else f"NULL AS {c}"
            for c in everything
        ]
        parts.append(f"SELECT '{lv}' AS nivel, {commas(shown)} FROM {lv}_{suffix}")
    return " UNION ALL ".join(parts)


# The quotes dealt over 240 months.
LONG_QUOTES = f"""
SELECT * REPLACE (CAST(2004 + long_month // 12 AS INTEGER) AS anio,
                  CAST(long_month % 12 + 1 AS INTEGER) AS mes)
FROM (SELECT *, CASE WHEN place % 3 = 0 THEN place ELSE place - place % 40 END AS long_month
      FROM (SELECT *, (l_orderkey * 31 + l_linenumber * 7) % 240 AS place FROM ({QUOTES})))"""

# March with half of its prices corrected.
CORRECTED_QUOTES = f"""
SELECT * REPLACE (CASE WHEN mes = 3 AND l_orderkey % 2 = 0 THEN precio_actual * CAST(1.1 AS DOUBLE)
                       ELSE precio_actual END AS precio_actual)
FROM ({QUOTES})"""


def long_fill(lv: str) -> str:
    """Every key in each of 240 months, filled by the nearest price after it, then before it."""
    keys = KEYS[lv]
    own = commas(keys, "g.")
    window = f"PARTITION BY {commas(keys)} ORDER BY place"
    return f"""
    SELECT {commas(keys)}, round(coalesce(after, before), 4) AS pgeo, n,
           CAST(place % 12 + 1 AS INTEGER) AS mes, CAST(2004 + place // 12 AS INTEGER) AS anio
    FROM (
      SELECT *, first_value(pgeo IGNORE NULLS) OVER ({window}
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after,
             last_value(CASE WHEN place >= 1 THEN pgeo END IGNORE NULLS) OVER ({window}
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before,
             max(seen) OVER (PARTITION BY {commas(keys)}) AS last_seen
      FROM (
        SELECT {own}, g.place, pgeo, n, CASE WHEN p.mes IS NOT NULL THEN g.place END AS seen
        FROM (SELECT * FROM (SELECT DISTINCT {commas(keys)} FROM {lv}_long),
                            (SELECT unnest(range(240)) AS place)) g
        LEFT JOIN {lv}_long p ON {on(keys, "g", "p")} AND g.place = (p.anio - 2004) * 12 + p.mes - 1
      ) observed
    ) spread WHERE place <= last_seen OR last_seen >= 1"""


def dependency(left: str, right: str) -> str:
    return f"""
    SELECT '{left} > {right}' AS dependencia, CAST({left} AS VARCHAR) AS clave,
           count(*) AS valores, min(CAST({right} AS VARCHAR)) AS minimo,
           max(CAST({right} AS VARCHAR)) AS maximo, CAST(sum(n) AS BIGINT) AS precios
    FROM (SELECT {left}, {right}, count(*) AS n FROM coded GROUP BY {left}, {right}) v
    GROUP BY {left} HAVING count(*) > 1"""


def ordered(lv: str) -> str:
    """The finished panel with the place of each row in the order of its columns."""
    first = [*KEYS[lv], "anio", "mes"]
    columns = [*first, *(c for c in panel_columns(lv) if c not in first)]
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    shown = show(f"{lv}_fill", panel_columns(lv))
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS orden FROM ({shown}) p"


def build() -> dict[str, str]:
    t = roll_forward_tables()
    cell = ["codigo_articulo", "Departamento", "mes", "anio"]
    t["regime"] = """
    SELECT * FROM quotes
    WHERE NOT ((anio = 2023 AND mes = 12) OR (anio = 2024 AND mes = 1))
       OR tipo_precio = 'IPC-2023'"""
    t["valid_all"] = valid("regime")
    t["base_all"] = popular("valid_all", cell)
    t["dep_all"] = dep("base_all")
    for coarse, fine in FINER.items():
        t[f"{coarse}_all"] = level(coarse, f"{fine}_all")

    t["long_quotes"] = LONG_QUOTES
    t["long_valid"] = valid("long_quotes")
    t["long_base"] = popular("long_valid", cell)
    t["dep_long"] = dep("long_base")
    for coarse, fine in FINER.items():
        t[f"{coarse}_long"] = level(coarse, f"{fine}_long")
    t["valid_any"] = valid("quotes")
    t["dep_any"] = dep("valid_any")
    t["reg_any"] = level("reg", "dep_any")
    t["coded"] = """
    SELECT *, CASE WHEN cod = '10400011' THEN '1040001' ELSE cod END AS cod_prod FROM quotes"""

    size = [*cell, "cantidad_actual"]
    final = {
        "period_quotes": show("bol_may", [*LINE, "precio_actual", "tipo_precio"]),
        "previous_period": """
            SELECT DISTINCT anio, mes, CASE WHEN mes = 1 THEN anio - 1 ELSE anio END AS anio_ant,
                   CASE WHEN mes = 1 THEN 12 ELSE mes - 1 END AS mes_ant FROM quotes""",
        "base_price": show(
            f"(SELECT *, {BASE_PRICE} FROM quotes)", [*LINE, "precio_base"]
        ),
        "valid_quotes": show(f"({valid('quotes')})", [*LINE, "precio_base"]),
        "regime_filter": show("regime", [*LINE, "tipo_precio"]),
        "product_code": """
            SELECT codigo_articulo, count(*) AS n,
                   CASE WHEN substring(codigo_articulo, 1, length(codigo_articulo) - 1)
                             = '10400011' THEN '1040001'
                        ELSE substring(codigo_articulo, 1, length(codigo_articulo) - 1)
                   END AS cod_prod FROM quotes GROUP BY codigo_articulo""",
        "normalize_region": """
            SELECT l_orderkey, l_linenumber, Departamento,
                   TRY_CAST(CASE WHEN region = 4 THEN 'IV' ELSE CAST(region AS VARCHAR) END
                            AS INTEGER) AS region FROM quotes""",
        "outlier_band_following": show("banded_abr", [*LINE, "precio_base", "pgeo"]),
        "outlier_band_previous": show("banded_jun", [*LINE, "precio_base", "pgeo_ant"]),
        "outlier_band_previous_open": show("banded_open_jun", [*LINE, "precio_base", "pgeo_ant"]),
        "presentation_counts": f"""
            SELECT {commas(size)}, count(*) AS votos FROM valid_all GROUP BY {commas(size)}""",
        "popular_presentation": show("base_all", [*LINE, "cantidad_actual", "precio_base"]),
        "price_levels": " UNION ALL ".join(
            f"""SELECT '{lv}' AS nivel, {', '.join(
                k if k in KEYS[lv] else f'NULL AS {k}'
                for k in ('codigo_articulo', 'region', 'cod_prod'))},
                round(pgeo, 4) AS pgeo, n, mes, anio FROM {lv}_all"""
            for lv in FINER
        ),
        "cleaned_history": show("dep_clean", price_columns("dep")),
        "article_dim": "SELECT * FROM articles",
        "product_dim": "SELECT DISTINCT cod_prod, producto_nombre FROM articles",
        "description_conflicts": """
            SELECT codigo_articulo, count(*) AS descripciones FROM articles
            GROUP BY codigo_articulo HAVING count(*) > 1""",
        "audit_quotes": " UNION ALL ".join(
            [show("base_may", [*LINE, "precio_base"]).replace(" FROM", ", NULL AS pgeo FROM")]
            + [show(f"base_{m}", [*LINE, "precio_base", "pgeo"]) for m in MONTHS if m != "may"]
        ),
        "audit_quotes_roll_forward": show("base_jun", [*LINE, "precio_base", "pgeo_ant"]),
        "write_panel": every_level("fill"),
        "write_audit": show("base_jun", [*LINE, "precio_base", "pgeo_ant"]),
        "write_audit_history": " UNION ALL ".join(
            [show("base_may", [*LINE, "precio_base"]).replace(" FROM", ", NULL AS pgeo FROM")]
            + [show(f"base_{m}", [*LINE, "precio_base", "pgeo"]) for m in MONTHS if m != "may"]
        ),
        "write_audit_together": " UNION ALL ".join(
            [
                show("(SELECT *, NULL AS pgeo, NULL AS pgeo_ant FROM base_may)", AUDITED),
                show("(SELECT *, NULL AS pgeo_ant FROM base_abr)", AUDITED),
                show("(SELECT *, NULL AS pgeo FROM base_jun)", AUDITED),
            ]
        ),
        "publish_panel": f"{every_level('fill')} UNION ALL {every_level('fill_jun')}",
        "export_ordered_var": ordered("var"),
        "export_ordered_dep": ordered("dep"),
        "fill_long_var": long_fill("var"),
        "fill_long_reg": long_fill("reg"),
        "dependency_conflicts": " UNION ALL ".join(
            dependency(left, right)
            for left, right in (
                ("codigo_articulo", "articulo"), ("codigo_articulo", "producto_nombre"),
                ("codigo_articulo", "cantidad_base"), ("cod_prod", "producto_nombre"),
                ("Departamento", "region"),
            )
        ),
        "means_in_sql": show(
            "reg_any", ["codigo_articulo", "region", "pgeo", "n", "cod_prod", "mes", "anio"]
        ),
        "roll_forward_from_storage": every_level("fill_jun"),
        "roll_forward_dep_text_region": show(
            "dep_text_carried", [*KEYS["dep"], "pgeo", "mes", "anio"]
        ),
        "roll_forward_dep_open": show(
            "dep_open_carried", [*KEYS["dep"], "pgeo", "mes", "anio"]
        ),
    }
    for lv in KEYS:
        final[f"{lv}_price"] = show(f"{lv}_all", price_columns(lv))
        final[f"backcast_{lv}"] = show(f"{lv}_adj", price_columns(lv))
        final[f"forward_{lv}"] = show(f"{lv}_imp", price_columns(lv))
        final[f"panel_{lv}"] = show(f"{lv}_panel", price_columns(lv))
        final[f"fill_{lv}"] = show(f"{lv}_fill", panel_columns(lv))
        final[f"prior_slice_{lv}"] = show(f"{lv}_ant", [*KEYS[lv], "pgeo_ant"])
        final[f"prior_prices_{lv}"] = show(f"{lv}_one", [*KEYS[lv], "pgeo_ant"])
        final[f"roll_forward_{lv}"] = show(
            f"{lv}_carried", [*KEYS[lv], "pgeo", "mes", "anio"]
        )
        final[f"roll_forward_fill_{lv}"] = show(f"{lv}_fill_jun", panel_columns(lv))
        if lv != "dep":  # the department level is carried the same way in both
            final[f"roll_forward_{lv}_as_written"] = show(
                f"{lv}_carried_written", [*KEYS[lv], "pgeo", "mes", "anio"]
            )
            final[f"roll_forward_fill_{lv}_as_written"] = show(
                f"{lv}_fill_written", panel_columns(lv)
            )
    final["voted_dep_price"] = final["dep_price"]
    written = {name: statement(t, sql) for name, sql in final.items()}
    corrected = history_tables(CORRECTED_QUOTES)
    written["resumed_history"] = statement(corrected, show("dep_clean", price_columns("dep")))
    return written
