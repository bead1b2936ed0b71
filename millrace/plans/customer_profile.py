"""Lifetime profile per customer, recomputed for the customers of new transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.aggregates import keep_first
from millrace.operators.joins import restrict_adaptive
from millrace.operators.rows import valid_transactions
from millrace.operators.skew import join_on
from millrace.plans.sales import one_per_product
from millrace.session import settle
from millrace.sinks.keyed import upsert

MONEY = "decimal(18,2)"


def clean_transactions(transactions: DataFrame) -> DataFrame:
    """Valid rows, one per transaction id; of several the earliest survives."""
    return keep_first(valid_transactions(transactions), ["txn_id"], ["txn_timestamp"])


def category_totals(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Spend, number, first and last time per (customer, category) of known products.

    The totals of two sets of transactions merge into those of both (``merged_totals``). Most customers buy a product once, so
    a sum per (customer, product) would move nearly all rows once more; the category is looked up first, where adaptive
    execution splits heavy products, and the sums combine before the shuffle, so a heavy customer costs no more than a light one.
    """
    known = join_on(transactions.drop("category"), one_per_product(products), ["product_id"])
    return known.groupBy("customer_id", "category").agg(
        F.sum("amount").alias("spend"),
        F.count("*").alias("n"),
        F.min("txn_timestamp").alias("first_at"),
        F.max("txn_timestamp").alias("last_at"),
    )


def merged_totals(totals: DataFrame) -> DataFrame:
    """One row per (customer, category) of any number of partial totals."""
    return (
        totals.repartition("customer_id")
        .groupBy("customer_id", "category")
        .agg(
            F.sum("spend").alias("spend"),
            F.sum("n").alias("n"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
        )
    )


def customer_profiles(transactions: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Spend, orders, first and last purchase and favourite category of known customers,
    over transactions of known products."""
    return profiles_of(category_totals(transactions, products), customers)


def profiles_of(per_category: DataFrame, customers: DataFrame) -> DataFrame:
    """Profiles from one row per (customer, category), which shrink to one per customer before the customer table is joined."""
    whole = Window.partitionBy("customer_id")
    leading = whole.orderBy(F.col("n").desc(), F.col("category").asc_nulls_last())
    totals = per_category.select(
        "customer_id",
        F.sum("spend").over(whole).cast(MONEY).alias("total_spend"),
        F.sum("n").over(whole).alias("total_transactions"),
        F.min("first_at").over(whole).alias("first_purchase"),
        F.max("last_at").over(whole).alias("last_purchase"),
        F.col("category").alias("favorite_category"),
        F.row_number().over(leading).alias("place"),
    ).filter("place = 1")
    average = (F.col("total_spend") / F.col("total_transactions")).cast(MONEY)
    # One row per customer on both sides, so this join has no heavy keys.
    return customers.join(totals, "customer_id").select(
        "customer_id",
        "name",
        "email",
        "gender",
        "total_spend",
        "total_transactions",
        average.alias("avg_order_value"),
        "first_purchase",
        "last_purchase",
        "favorite_category",
    )


def write_tasks(affected: int, cap: int) -> int:
    """Tasks for a profile write: four per affected customer, at least 8 and at most ``cap``."""
    return max(8, min(cap, max(1, affected * 4)))


def refresh_profiles(
    delta: DataFrame,
    transactions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    current: str | None,
    target: str,
    cap: int = 200,
) -> None:
    """Rebuild the profile of each customer with a new transaction from their whole history.

    The profiles under ``current`` (None before the first run) with these in their place go to
    ``target``, by as many tasks as the number of affected customers asks for.
    """
    # Written once: the customers are listed, counted and met, the profiles replace keys and add rows.
    changed = settle(delta.select("customer_id").filter("customer_id IS NOT NULL").distinct(), "changed")
    history = restrict_adaptive(transactions, changed, "customer_id")
    profiles = settle(customer_profiles(clean_transactions(history), customers, products), "profiles")
    affected = changed.count()
    upsert(profiles, ["customer_id"], current, target, tasks=write_tasks(affected, cap))


def denormalised_sales(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Customers, their orders and the items of those in one row per (customer, order, item).

    An order has one customer, so the items alone decide what is a copy: copies go before the
    joins, while the rows are still narrow.
    """
    single = keep_first(items, ["order_id", "item_id"], ["product_name", "quantity"])
    lines = join_on(single, orders, ["order_id"])
    wide = join_on(lines, customers, ["customer_id"])
    return wide.withColumn("order_date", F.col("order_date").cast("timestamp")).select(
        "customer_id", "name", "email", "city", "order_id", "order_date",
        "amount", "item_id", "product_name", "quantity",
    )
