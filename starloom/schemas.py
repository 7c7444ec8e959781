"""Feeds, warehouse tables and the fixed values of the business rules."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
OPEN_END = dt.date(9999, 12, 31)
CALL_LOOKBACK_DAYS = 14
BASELINE_MONTHS = 6
GROWTH_ASK = "1.08"
WATCH_FLOOR = "0.90"
DRILLDOWN_HCP_KEY = 742
# Below these the reports say little: distinct deciles and months, closed versions.
LEAST_SPREAD = {"distinct_deciles": 5, "distinct_months": 12, "closed_versions": 1}

REGIONS = ("North", "South", "East", "West", "Central")
CALL_TYPES = ("DETAIL", "SAMPLE", "FOLLOW_UP")

# product_code, brand_name, molecule, therapeutic_area, is_competitor
PRODUCTS = [
    ("RX-CARDIO-01", "Cardiova", "Atorvastatin", "Cardiology", False),
    ("RX-ENDO-01", "Glucoron", "Metformin", "Endocrinology", False),
    ("RX-RESP-01", "Pulmovent", "Salbutamol", "Respiratory", False),
    ("CM-CARDIO-01", "Lipitrex", "Atorvastatin", "Cardiology", True),
    ("CM-CARDIO-02", "Statinex", "Rosuvastatin", "Cardiology", True),
    ("CM-ENDO-01", "Glycomet", "Metformin", "Endocrinology", True),
    ("CM-RESP-01", "Airomax", "Salbutamol", "Respiratory", True),
    ("CM-RESP-02", "Bronchol", "Formoterol", "Respiratory", True),
]

INTEGER_BOUNDS = {
    "decile": (1, 10),
    "trx_count": (0, 2**31 - 1),
    "nrx_count": (0, 2**31 - 1),
    "duration_minutes": (0, 2**15 - 1),
    "samples_dropped": (0, 2**15 - 1),
}
ANY_LONG = (-(2**63), 2**63 - 1)

# ---------------------------------------------------------------------- typing
COLUMN_TYPES = {
    "decile": "smallint",
    "trx_count": "int",
    "nrx_count": "int",
    "units": "decimal(12,2)",
    "gross_sales": "decimal(14,2)",
    "duration_minutes": "smallint",
    "samples_dropped": "smallint",
}


# ----------------------------------------------------------------------- feeds
@dataclass(frozen=True)
class Feed:
    """A text extract: its columns in file order and the typing rules for its rows."""

    name: str
    columns: tuple[str, ...]
    dates: tuple[str, ...]
    integer: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def rules(self) -> dict:
        return dict(numeric=self.numeric, integer=self.integer, dates=self.dates,
                    required=self.required, allowed=self.allowed)


@dataclass(frozen=True)
class FactFeed(Feed):
    """A feed that becomes a fact table."""

    target: str = ""
    measures: tuple[str, ...] = ()

    @property
    def date_col(self) -> str:
        return self.dates[0]

    @property
    def fact_columns(self) -> list[str]:
        return ["date_key", "hcp_key", "product_key", "territory_key", *self.measures]


HCP_FEED = Feed(
    name="hcp",
    columns=("hcp_id", "full_name", "specialty", "decile", "territory_code", "effective_date"),
    integer=("decile",),
    dates=("effective_date",),
    required=("hcp_id", "full_name", "specialty"),
)
RX_FEED = FactFeed(
    name="prescriptions",
    columns=("rx_date", "hcp_id", "product_code", "trx_count", "nrx_count", "units", "gross_sales"),
    integer=("trx_count", "nrx_count"),
    numeric=("units", "gross_sales"),
    dates=("rx_date",),
    target="fact_prescriptions",
    measures=("trx_count", "nrx_count", "units", "gross_sales"),
)
CALL_FEED = FactFeed(
    name="sales_calls",
    columns=("call_date", "hcp_id", "product_code", "call_type", "duration_minutes",
             "samples_dropped"),
    integer=("duration_minutes", "samples_dropped"),
    dates=("call_date",),
    allowed={"call_type": CALL_TYPES},
    target="fact_sales_calls",
    measures=("call_type", "duration_minutes", "samples_dropped"),
)
FACT_FEEDS = (RX_FEED, CALL_FEED)
FEEDS = (HCP_FEED, *FACT_FEEDS)

PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_code", T.StringType(), False),
    T.StructField("brand_name", T.StringType(), False),
    T.StructField("molecule", T.StringType(), False),
    T.StructField("therapeutic_area", T.StringType(), False),
    T.StructField("is_competitor", T.BooleanType(), False),
])

# ------------------------------------------------------------ warehouse contract
NOT_NULL = {
    "dim_date": ("date_key", "full_date", "year", "quarter", "month", "month_name", "year_month"),
    "dim_product": ("product_key", "product_code", "brand_name", "molecule", "therapeutic_area",
                    "is_competitor"),
    "dim_territory": ("territory_key", "territory_code", "territory_name", "region", "country"),
    "dim_hcp": ("hcp_key", "hcp_id", "full_name", "specialty", "territory_key", "valid_from",
                "valid_to", "is_current"),
    "fact_prescriptions": ("date_key", "hcp_key", "product_key", "territory_key", "trx_count",
                           "nrx_count", "units", "gross_sales"),
    "fact_sales_calls": ("date_key", "hcp_key", "product_key", "territory_key", "call_type",
                         "duration_minutes", "samples_dropped"),
}
UNIQUE = {
    "dim_date": ("date_key", "full_date"),
    "dim_product": ("product_key", "product_code"),
    "dim_territory": ("territory_key", "territory_code"),
    "dim_hcp": ("hcp_key",),
}
# key column -> dimension that owns it
FACT_KEYS = {
    "date_key": "dim_date",
    "hcp_key": "dim_hcp",
    "product_key": "dim_product",
    "territory_key": "dim_territory",
}
