"""Fixed values and defaults shared by the whole package.

Everything that must equal the modelled warehouse for results to agree is
collected here, in plain text, so that callers can override it per call.
"""

from __future__ import annotations

import datetime as _dt

# --- fixed values (must match the modelled warehouse) -----------------------

# Open end of a current SCD2 version.
SCD2_MAX_TS = "9999-12-31 23:59:59"

# Surrogate keys: md5 over the key columns joined by this separator, with
# NULLs replaced by the marker so that NULL and '' hash differently.
KEY_SEPARATOR = "-"
KEY_NULL_MARKER = "<null>"

# Tracked (version-opening) customer attributes.
CUSTOMER_TRACKED = ["customer_segment", "city", "state", "country", "is_active"]

# Customer attributes carried on every version.
CUSTOMER_ATTRIBUTES = [
    "email", "full_name", "first_name", "last_name", "acquisition_channel",
    "acquisition_date", "customer_segment", "lifetime_value", "city", "state",
    "country", "is_active",
]

# Sales channels, in order of ``order_id % 4``.
CHANNELS = ["web", "app", "marketplace", "retail"]

# Customer segments by running spend: (upper bound exclusive, name).
SEGMENT_BOUNDS = [(500_000, "Bronze"), (1_000_000, "Silver"), (2_000_000, "Gold")]
SEGMENT_TOP = "Platinum"

# Flat tax rate applied to net revenue.
TAX_RATE = "0.08"

# Late-data window of the incremental fact load, in days.
LOOKBACK_DAYS = 3

# First month of the fiscal year.
FISCAL_START_MONTH = 10

# Product cost as a share of list price in the staging mapping; margin in %.
COST_RATIO = "0.60"
MARGIN_PCT = "40.00"

# Shipping cost = base + per unit * quantity.
SHIPPING_BASE = "5.00"
SHIPPING_PER_UNIT = "0.10"

# Partition retention, days.
RETENTION_DAYS = 1825

# Group of lines whose dimension row is missing, in reports.
UNKNOWN = "(unknown)"

# Forecast uplift over the previous year's revenue.
FORECAST_UPLIFT = "1.05"

# Weights of level, trend and season in the smoothed forecast; exact in binary.
SMOOTHING = (0.25, 0.125, 0.5)

# Top-k size of the product report.
TOP_K = 20

# --- defaults for the bundled test tables ----------------------------------

# Reproducible "now" for the test tables (the day after the last order).
DEFAULT_AS_OF = _dt.datetime(2001, 8, 2, 0, 0, 0)

# Benchmark year window (the test tables span 1995..2001).
BENCH_YEAR = 2000
