"""Customer attributes of SFMC emails."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailfacts.operators.dedupe import distinct_keys, keep_matching

# Fixed value.
INTERNAL_REASON = "internal customer"


def flag_excluded(df: DataFrame, exclusion_list: DataFrame) -> DataFrame:
    """Add ``exclude_reason_desc``: set for customers on the list, null for all others.

    Every row stays, once, however often the list names its customer.
    """
    listed = distinct_keys(
        exclusion_list.select(F.col("QaCustomerID").alias("customer_id")), ["customer_id"]
    )
    reason = F.lit(INTERNAL_REASON).alias("exclude_reason_desc")
    return df.join(listed.select("customer_id", reason), "customer_id", "left")


def customer_shoppers(
    customers: DataFrame, shoppers: DataFrame, wanted: DataFrame | None
) -> DataFrame:
    """Customer to shopper with the shopper's country, of the customers in ``wanted`` if it is given.

    A run that meets few of all customers gives ``wanted``: customers are cut to them before they are
    made distinct, shoppers to those customers. Both are joined among themselves first, so that the
    facts are shuffled by customer only.
    """
    if wanted is not None:
        customers = keep_matching(customers, wanted.select("customer_id"), ["customer_id"])
    known = distinct_keys(customers, ["customer_id", "shopper_id"])
    if wanted is not None:
        shoppers = keep_matching(shoppers, known.select("shopper_id"), ["shopper_id"])
    return known.join(shoppers, "shopper_id", "left")


def add_customer(
    df: DataFrame,
    exclusion_list: DataFrame,
    customers: DataFrame,
    shoppers: DataFrame,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Exclusion reason, shopper and shopper country by ``customer_id``.

    ``wanted``, if given, has at least the customers of ``df``, and is cheaper to read than what it
    cuts from the dimensions.
    """
    return flag_excluded(df, exclusion_list).join(
        customer_shoppers(customers, shoppers, wanted), "customer_id", "left"
    )
