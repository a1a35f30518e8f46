"""Property-domain predicates as reusable Columns (composable, NULL-safe negation)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------------
GIRDWOOD_DISTRICT = "4"
PRIMARY_RESIDENCE = "OWNERS PRIMARY RESIDENCE"
ANCHORAGE_BBOX = (-151.0, -148.3, 60.6, 61.6)       # lon min/max, lat min/max of centroids
GIRDWOOD_VALLEY_BBOX = (-149.3, -148.9, 60.85, 61.05)
# ---------------------------------------------------------------------------------


def area_of() -> Column:
    return F.when(F.col("tax_district") == GIRDWOOD_DISTRICT, "Girdwood").otherwise("Rest of the Muni")


def is_residential() -> Column:
    return F.col("property_type") == "Residential"


def is_home() -> Column:
    return is_residential() & (F.col("appraised_building_value") > 0)


def has_pre() -> Column:
    return F.col("exemption_6_type") == PRIMARY_RESIDENCE


def not_(pred: Column) -> Column:
    """Three-valued-safe negation: NULL counts as FALSE before negating."""
    return ~F.coalesce(pred, F.lit(False))


def property_filter(kind: str) -> Column:
    return {"All": F.lit(True), "Residential": is_residential(), "Commercial": ~is_residential()}[kind]


def value_column(kind: str) -> Column:
    return F.col({"Land + structures": "appraised_total_value", "Land only": "appraised_land_value",
                  "Structures only": "appraised_building_value"}[kind])
