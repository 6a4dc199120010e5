from pricepanel.functions.columns import (
    base_price,
    geo_mean,
    is_by_weight,
    period_ordinal,
    product_code,
    region_number,
    w_geo_mean,
)
from pricepanel.functions.sql import geo_mean_sql, register_functions, w_geo_mean_sql

__all__ = [
    "base_price",
    "geo_mean",
    "geo_mean_sql",
    "is_by_weight",
    "period_ordinal",
    "product_code",
    "region_number",
    "register_functions",
    "w_geo_mean",
    "w_geo_mean_sql",
]
