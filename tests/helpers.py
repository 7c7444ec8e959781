from __future__ import annotations

import datetime as dt
from decimal import Decimal

OPEN = dt.date(9999, 12, 31)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted plain tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def star(spark, rx=(), calls=(), versions=None, extra_days=()):
    """The reduced star of the report acceptance cases."""
    days = ["2024-05-31", "2024-06-01", "2024-06-20", *extra_days]
    versions = versions or [(1, 1, "2024-01-01", "2024-05-31"), (2, 2, "2024-06-01", "9999-12-31")]
    frame = spark.createDataFrame
    return {
        "dim_date": frame(
            [(int(d.replace("-", "")), day(d), d[:7], int(d[:4])) for d in days],
            "date_key int, full_date date, year_month string, year int"),
        "dim_product": frame(
            [(1, "CardioOwn", False, "Cardiology"), (2, "CardioCompetitor", True, "Cardiology"),
             (3, "EndoOwn", False, "Endocrinology")],
            "product_key int, brand_name string, is_competitor boolean, therapeutic_area string"),
        "dim_hcp": frame(
            [(k, "H1", "Dr A", "GP", 5, t, day(a), day(z), z == "9999-12-31")
             for k, t, a, z in versions],
            "hcp_key int, hcp_id string, full_name string, specialty string, decile int, "
            "territory_key int, valid_from date, valid_to date, is_current boolean"),
        "dim_territory": frame(
            [(1, "T1", "Territory 1", "North"), (2, "T2", "Territory 2", "South")],
            "territory_key int, territory_code string, territory_name string, region string"),
        "fact_prescriptions": frame(
            [(*r[:5], Decimal(r[5])) for r in rx],
            "date_key int, hcp_key int, product_key int, territory_key int, trx_count int, "
            "gross_sales decimal(14,2)"),
        "fact_sales_calls": frame(
            list(calls), "date_key int, hcp_key int, product_key int, territory_key int"),
    }
