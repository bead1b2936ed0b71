"""Daily totals per customer with the leading category, kept per day in a lake."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import restrict_adaptive
from millrace.operators.skew import join_on
from millrace.plans.sales import one_per_product
from millrace.sinks.files import replace_partitions


def daily_summary(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Amount, items and distinct products per day and customer; the top category by items.

    Totals count every transaction that names a product, the category only known products; a
    product that is listed twice counts once, with its first category. One aggregate per (day,
    customer, product) feeds both, so products are looked up once per group and not once per
    transaction. The groups of a day and customer then meet once, and no part is joined back.
    """
    per_product = (
        transactions.filter(F.col("product_id").isNotNull())
        .groupBy(F.to_date("txn_timestamp").alias("date"), "customer_id", "product_id")
        .agg(F.sum("amount").alias("amount"), F.sum("qty").alias("items"))
    )
    known = one_per_product(products).withColumn("known", F.lit(True))
    # Grouped and ranked, the rows of a task take many times the bytes that were moved, so tasks are not put together by these.
    partitions = int(products.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_category = (
        join_on(per_product, known, ["product_id"], "left")
        .repartition(partitions, "date", "customer_id")
        .groupBy("date", "customer_id", "category", "known")
        .agg(
            F.sum("amount").alias("amount"),
            F.sum("items").alias("items"),
            F.count("*").alias("products"),
        )
    )
    whole = Window.partitionBy("date", "customer_id")
    leading = whole.orderBy(F.col("known").desc_nulls_last(), F.col("items").desc(), F.col("category").asc_nulls_last())
    placed = per_category.withColumns(
        {
            "total_amount": F.sum("amount").over(whole).cast("decimal(20,2)"),
            "total_items": F.sum("items").over(whole),
            "distinct_products": F.sum("products").over(whole),
            "place": F.row_number().over(leading),
        }
    )
    return placed.filter("place = 1").select(
        "date",
        "customer_id",
        "total_amount",
        "total_items",
        "distinct_products",
        F.when(F.col("known"), F.col("category")).alias("top_category"),
    )


def refresh_days(delta: DataFrame, transactions: DataFrame, products: DataFrame, path: str) -> None:
    """Recompute every day the new rows touch, late ones included, and rewrite just those days."""
    day = F.to_date("txn_timestamp")
    days = delta.select(day.alias("day")).distinct()
    ends = days.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    if ends["first"] is None:
        return
    # The range on the plain column reaches the scan; the days within it are picked afterwards.
    after = F.lit(ends["last"] + timedelta(days=1))
    near = transactions.filter((F.col("txn_timestamp") >= F.lit(ends["first"])) & (F.col("txn_timestamp") < after))
    touched = restrict_adaptive(near.withColumn("day", day), days, "day").drop("day")
    replace_partitions(daily_summary(touched, products), path, ["date"])
