"""Values offered by the dashboards' filter variables."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Board to the columns it offers, in dashboard order.
VARIABLES = {
    "ops": ("environment", "vendor_id"),
    "fun": ("vendor_id", "service", "loan_lifecycle_stage"),
    "lat": ("vendor_id", "endpoint"),
    "fail": ("vendor_id", "service"),
}


def var_values(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).distinct().orderBy(column)
