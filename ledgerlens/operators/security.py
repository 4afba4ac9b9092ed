"""Row-level security (F10): apply before any measure sees the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Roles of the semantic model.
FULL_ACCESS_ROLES = ("Executive",)
REGIONAL_ROLES = ("RegionalManager",)


def secure(df: DataFrame, role: str, principal: str | None = None,
           region_col: str = "territory_region") -> DataFrame:
    """Executive sees all rows; RegionalManager only rows whose region equals
    the principal (rows with a null region are hidden); any other role sees
    nothing.  The filter is a plain predicate, so it pushes into the scan."""
    if role in FULL_ACCESS_ROLES:
        return df
    if role in REGIONAL_ROLES:
        if principal is None:
            return df.filter(F.lit(False))
        return df.filter(F.col(region_col) == F.lit(principal))
    return df.filter(F.lit(False))


def secure_by_mapping(df: DataFrame, grants: DataFrame, principal: str,
                      region_col: str = "territory_region") -> DataFrame:
    """Principal -> regions from a grants table ``(principal, region)``; a
    principal may hold several regions.  ``left_semi`` keeps fact rows
    without duplicating them; AQE broadcasts the grant list after measuring
    it."""
    allowed = grants.filter(F.col("principal") == F.lit(principal)) \
        .select(F.col("region").alias("_rls_region")).distinct()
    return df.join(allowed, df[region_col] == allowed["_rls_region"], "left_semi")
