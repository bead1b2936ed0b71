"""Currency conversion, cached sales aggregates, product aggregates and spend per customer."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from millrace.functions.numbers import age_band
from millrace.operators.aggregates import keep_first, count_by, sum_by
from millrace.operators.skew import join_on


@contextmanager
def cached(df: DataFrame, materialise: bool = False) -> Iterator[DataFrame]:
    """Keep ``df`` (spilling to disk) for several actions and let it go afterwards."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if materialise:
            df.count()
        yield df
    finally:
        df.unpersist(blocking=False)


def convert_currency(transactions: DataFrame, rates: DataFrame) -> DataFrame:
    """Amount in dollars; a currency without a rate keeps its row with a null amount."""
    joined = join_on(transactions, rates, ["currency"], "left")
    return joined.withColumn("amount_usd", F.col("amount") * F.col("rate_to_usd"))


def amount_by_customer(sales: DataFrame) -> DataFrame:
    return sum_by(sales, ["customerId"], "amount", "total_amount")


def quantity_by_product(sales: DataFrame) -> DataFrame:
    return sum_by(sales, ["productId"], "quantity", "total_quantity")


def product_aggregates(sales: DataFrame) -> DataFrame:
    """Units and revenue per product name, rows without a name left out."""
    return (
        sales.filter(F.col("product_name").isNotNull())
        .groupBy("product_name")
        .agg(
            F.sum(F.col("quantity").cast("bigint")).alias("total_quantity"),
            F.round(F.sum("amount"), 2).alias("total_amount"),
        )
    )


def spend_by_customer(payments: DataFrame, customers: DataFrame) -> DataFrame:
    """Sum first, then add the name: the join sees one row per customer on either side."""
    totals = sum_by(payments, ["customerId"], "amount", "total_spent")
    return totals.join(customers.select("customerId", "name"), "customerId", "left")


def posts_per_age_band(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Posts are counted per user before the users are joined."""
    per_user = count_by(posts, ["userId"], "posts")
    banded = per_user.join(users.select("userId", age_band(F.col("age")).alias("age_band")), "userId")
    return sum_by(banded, ["age_band"], "posts", "posts")


def one_per_product(products: DataFrame) -> DataFrame:
    """product_id and category, one row per product; of several the first category by name."""
    return keep_first(products.select("product_id", "category"), ["product_id"], ["category"])
