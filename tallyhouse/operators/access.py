"""Masked and row-filtered views of the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import mask_email


def masked_customers(customers: DataFrame, privileged: bool = False) -> DataFrame:
    """Customers with the address masked, unless the reader is privileged."""
    return customers if privileged else customers.withColumn("email", mask_email("email"))


def rows_for_user(df: DataFrame, geography: DataFrame, entitlements: DataFrame, user: str) -> DataFrame:
    """Fact rows of the cities a user may see.

    The entitlement is resolved to geography keys first, so the fact meets a
    short key list in one semi-join.
    """
    cities = entitlements.filter(F.col("user_name") == user).select("city_name")
    allowed = geography.join(cities, "city_name", "left_semi").select("geography_sk")
    return df.join(allowed, "geography_sk", "left_semi")
