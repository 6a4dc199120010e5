"""Column names, types, periods and the fixed code lists of the price panel."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Period(NamedTuple):
    """One calendar month."""

    anio: int
    mes: int

    @property
    def ordinal(self) -> int:
        """Months since year 0, so that consecutive months differ by one."""
        return self.anio * 12 + self.mes

    def previous(self) -> Period:
        return Period(self.anio - 1, 12) if self.mes == 1 else Period(self.anio, self.mes - 1)


# Defaults of the back-history build: December 2023 to May 2024, the last month being the anchor.
HISTORY_PERIODS = (
    Period(2023, 12),
    Period(2024, 1),
    Period(2024, 2),
    Period(2024, 3),
    Period(2024, 4),
    Period(2024, 5),
)
ROLL_FORWARD_PERIOD = Period(2024, 6)

# Only these months still mix price regimes and need the regime filter.
REGIME_PERIODS = (Period(2023, 12), Period(2024, 1))
REGIME = "IPC-2023"

# A quote may differ from its reference price by this factor either way.
BAND_FACTOR = 1.25

# Varieties priced by weight, which have no usual package size.
BY_WEIGHT_CODES = (
    "1113011", "1113021", "1113022", "1113041", "1125032", "1125034",
    "1145012", "1145042", "1143022", "1161011", "1161021", "1161031",
    "1161041", "1161051", "1161061", "1162011", "1162012", "1162021",
    "1165021", "1165031", "1171011", "1171021", "1171031", "1171041",
    "1171051", "1171061", "1171062", "1171071", "1171081", "1171091",
    "1172011", "1172021", "1172032", "1172041", "1172051", "1174011",
    "1174021", "1174041", "1174051", "4541011", "1230011", "1230012",
)

# The one product code that is two characters shorter than its variety code.
LONG_PRODUCT_CODE = "10400011"
SHORT_PRODUCT_CODE = "1040001"

PERIOD = ("anio", "mes")

# Columns that identify a price at each level, the period aside.
LEVEL_KEYS = {
    "dep": ("codigo_articulo", "region", "Departamento"),
    "reg": ("codigo_articulo", "region"),
    "var": ("codigo_articulo",),
    "prod": ("cod_prod",),
}

# Columns that describe a price at each level and follow from its keys.
LEVEL_ATTRIBUTES = {
    "dep": ("producto_nombre", "cod_prod", "cant_base", "articulo"),
    "reg": ("producto_nombre", "cod_prod", "cant_base", "articulo"),
    "var": ("producto_nombre", "cod_prod", "cant_base", "articulo"),
    "prod": ("producto_nombre",),
}

ARTICLE_COLUMNS = ("codigo_articulo", "articulo", "cant_base", "cod_prod", "producto_nombre")

QUOTE_SCHEMA = T.StructType(
    [
        T.StructField("codigo_articulo", T.StringType()),
        T.StructField("articulo", T.StringType()),
        T.StructField("producto_nombre", T.StringType()),
        T.StructField("Departamento", T.StringType()),
        T.StructField("region", T.IntegerType()),
        T.StructField("cantidad_actual", T.DoubleType()),
        T.StructField("cantidad_base", T.DoubleType()),
        T.StructField("precio_actual", T.DoubleType()),
        T.StructField("tipo_precio", T.StringType()),
        T.StructField("anio", T.IntegerType()),
        T.StructField("mes", T.IntegerType()),
    ]
)

# Quotes that entered a month's prices, and the price of the adjacent month they were held
# against: the following month's in the history, the previous one's in the roll-forward.
AUDIT_SCHEMA = T.StructType(
    [
        *(f for f in QUOTE_SCHEMA.fields if f.name not in PERIOD),
        T.StructField("precio_base", T.DoubleType()),
        T.StructField("pgeo", T.DoubleType()),
        T.StructField("pgeo_ant", T.DoubleType()),
        *(T.StructField(c, T.IntegerType()) for c in PERIOD),
    ]
)

_PANEL_TYPES = {
    "codigo_articulo": T.StringType(),
    "region": T.IntegerType(),
    "Departamento": T.StringType(),
    "pgeo": T.DoubleType(),
    "articulo": T.StringType(),
    "cant_base": T.DoubleType(),
    "cod_prod": T.StringType(),
    "producto_nombre": T.StringType(),
    "anio": T.IntegerType(),
    "mes": T.IntegerType(),
}


def panel_columns(level: str) -> tuple[str, ...]:
    """Columns of a finished panel table, partition columns last."""
    described = ("producto_nombre",) if level == "prod" else ARTICLE_COLUMNS[1:]
    return (*LEVEL_KEYS[level], "pgeo", *described, *PERIOD)


def panel_schema(level: str) -> T.StructType:
    return T.StructType([T.StructField(c, _PANEL_TYPES[c]) for c in panel_columns(level)])
