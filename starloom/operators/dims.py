"""Type-1 dimensions (full overwrite): product and geography."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.keys import surrogate_key


def dim_product(stg_products: DataFrame, as_of=None) -> DataFrame:
    """One row per product, keyed by a hash of ``product_id``."""
    ts = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    return stg_products.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id", "product_name", "category", "subcategory", "brand",
        "cost_price", "list_price", "margin_pct", "weight_kg", "is_active", "launch_date",
        ts.alias("dw_updated_at"),
    )


def dim_geography(src_geography: DataFrame) -> DataFrame:
    """One row per (city, state, country), keyed by their hash."""
    return src_geography.select(
        surrogate_key("city", "state", "country").alias("geo_key"),
        "city", "state", "country", "region", "sub_region", "timezone", "latitude", "longitude",
    )
