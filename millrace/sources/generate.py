"""Seeded table generators on ``spark.range``: the same seed gives the same rows on any cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The choices the generated tables draw from.
DEPARTMENTS = ("HR", "IT", "Sales", "Finance")
LOG_LEVELS = ("INFO", "WARN", "ERROR")
LOG_SERVICES = ("auth-service", "payment-service", "orders-service", "cache-service")
CATEGORIES = ("Electronics", "Clothes", "Books")
AREAS = (
    "MG Road", "Indira Nagar", "Koramangala", "Whitefield",
    "Marathahalli", "HSR Layout", "BTM", "Jayanagar",
)
VEHICLES = ("AUTO", "TAXI", "BIKE")
PAYMENTS = ("CASH", "UPI", "CARD")
CUSTOMER_EVENTS = ("LIKE", "WISHLIST", "CART_ADD")
USER_ACTIONS = ("click", "view", "purchase", "signup", "logout")
FX_TRANSACTIONS = (
    (1, 100.50, "USD"), (2, 75.20, "EUR"), (3, 5600.0, "INR"), (4, 350.0, "GBP"), (5, 999.99, "USD"),
    (6, 120.00, "EUR"), (7, 4500.0, "INR"), (8, 50.0, "JPY"), (9, 75.55, "EUR"), (10, 820.40, "GBP"),
    (11, 1000.0, "AUD"), (12, 2300.0, "INR"), (13, 63.50, "EUR"), (14, 180.0, "USD"), (15, 450.0, "GBP"),
)
FX_RATES = (
    ("USD", 1.0), ("EUR", 1.10), ("INR", 0.012), ("GBP", 1.25),
    ("JPY", 0.007), ("AUD", 0.66), ("CAD", 0.75), ("CHF", 1.08),
)


class Draw:
    """Independent random columns, each a hash of the row id, the seed and a running number."""

    def __init__(self, seed: int):
        self.seed = seed
        self.used = 0

    def _bits(self) -> Column:
        self.used += 1
        return F.xxhash64(F.col("id"), F.lit(self.seed), F.lit(self.used))

    def below(self, n: int) -> Column:
        return F.pmod(self._bits(), F.lit(n))

    def unit(self) -> Column:
        return F.pmod(self._bits(), F.lit(1 << 52)) / F.lit(float(1 << 52))

    def pick(self, values: Sequence[str]) -> Column:
        choices = F.array(*(F.lit(v) for v in values))
        return F.element_at(choices, (self.below(len(values)) + 1).cast("int"))

    def word(self, length: int) -> Column:
        return F.substring(F.sha2(self._bits().cast("string"), 256), 1, length)


def _rows(spark: SparkSession, n: int, parts: int, seed: int) -> tuple[DataFrame, Draw]:
    return spark.range(1, n + 1, 1, parts), Draw(seed)


def customers(spark: SparkSession, n: int, parts: int = 8, seed: int = 1, cities: int = 50) -> DataFrame:
    ids, r = _rows(spark, n, parts, seed)
    city = F.concat(F.lit("City_"), r.below(cities) + 1)
    return ids.select(F.col("id").alias("customerId"), r.word(10).alias("name"), (r.below(53) + 18).alias("age"), city.alias("city"))


def employees(spark: SparkSession, n: int, parts: int = 8, seed: int = 2) -> DataFrame:
    ids, r = _rows(spark, n, parts, seed)
    return ids.select(F.col("id").alias("empId"), r.word(7).alias("name"), r.pick(DEPARTMENTS).alias("department"), (r.below(70_000) + 30_000).alias("salary"))


def account_transactions(spark: SparkSession, n: int, parts: int = 8, seed: int = 3) -> DataFrame:
    ids, r = _rows(spark, n, parts, seed)
    return ids.select(F.concat(F.lit("ACC_"), r.below(100_000)).alias("accountId"), (r.unit() * 10_000).alias("amount"))


def log_lines(spark: SparkSession, n: int, now_millis: int, parts: int = 8, seed: int = 4) -> DataFrame:
    ids, r = _rows(spark, n, parts, seed)
    fields = (F.lit(now_millis) - r.below(10_000_000), r.pick(LOG_LEVELS), r.word(15), r.below(10_000))
    return ids.select(F.concat_ws("|", *(f.cast("string") for f in fields)).alias("value"))


def log_records(spark: SparkSession, n: int, as_of: Column, seed: int = 5) -> DataFrame:
    ids, r = _rows(spark, n, 8, seed)
    message = F.concat(F.lit("Log message "), F.col("id"))
    return ids.select(as_of.alias("timestamp"), r.pick(LOG_LEVELS).alias("level"), r.pick(LOG_SERVICES).alias("service"), message.alias("message"))


def payments(spark: SparkSession, n: int, n_customers: int, parts: int = 8, seed: int = 6) -> DataFrame:
    ids, r = _rows(spark, n, parts, seed)
    return ids.select(F.col("id").alias("txnId"), (r.below(n_customers) + 1).alias("customerId"), (r.unit() * 1000).alias("amount"))


def products(spark: SparkSession, n: int, parts: int = 8, seed: int = 7) -> DataFrame:
    ids, r = _rows(spark, n, parts, seed)
    return ids.select(F.col("id").alias("productId"), r.pick(CATEGORIES).alias("category"), (r.unit() * 2000).alias("price"), r.word(50).alias("description"))


def store_sales(spark: SparkSession, n: int, parts: int = 8, seed: int = 8, stores: int = 100) -> DataFrame:
    ids, r = _rows(spark, n, parts, seed)
    return ids.select(F.concat(F.lit("Store_"), r.below(stores) + 1).alias("storeId"), (r.unit() * 500).alias("amount"))


def sales_records(spark: SparkSession, n: int, seed: int = 9) -> DataFrame:
    ids, r = _rows(spark, n, 8, seed)
    return ids.select(
        r.below(100_000).cast("int").alias("customerId"),
        r.below(5_000).cast("int").alias("productId"),
        (r.below(10) + 1).cast("int").alias("quantity"),
        (r.unit() * 500 + 10).alias("amount"),
    )


def sensors(spark: SparkSession, n: int, parts: int = 8, seed: int = 10) -> DataFrame:
    ids, r = _rows(spark, n, parts, seed)
    return ids.select(
        F.concat(F.lit("DEV_"), r.below(5000)).alias("deviceId"),
        (r.unit() * 15 + 20).alias("temperature"),
        (r.unit() * 20 + 40).alias("humidity"),
        r.below(24).cast("int").alias("hour"),
    )


def users(spark: SparkSession, n: int, parts: int = 8, seed: int = 11) -> DataFrame:
    ids, r = _rows(spark, n, parts, seed)
    return ids.select(F.col("id").alias("userId"), r.word(8).alias("name"), (r.below(60) + 15).cast("int").alias("age"))


def posts(spark: SparkSession, n: int, n_users: int, parts: int = 8, seed: int = 12) -> DataFrame:
    ids, r = _rows(spark, n, parts, seed)
    return ids.select(F.col("id").alias("postId"), (r.below(n_users) + 1).alias("userId"), r.word(20).alias("text"))


def students(spark: SparkSession, n: int, parts: int = 8, seed: int = 13) -> DataFrame:
    ids, r = _rows(spark, n, parts, seed)
    return ids.select(F.col("id").alias("studentId"), r.word(6).alias("name"), r.below(100).cast("int").alias("score"))


def trips(spark: SparkSession, n: int, as_of: str, parts: int = 8, seed: int = 14) -> DataFrame:
    """Trips that begin within 100,000 minutes before ``as_of`` and last 5 to 54 minutes."""
    ids, r = _rows(spark, n, parts, seed)
    begin = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - r.below(100_000) * 60
    end = begin + (r.below(50) + 5) * 60
    distance = F.round(r.unit() * 15 + 1, 2)
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS"
    return ids.select(
        F.col("id").alias("trip_id"),
        r.below(5000).cast("int").alias("driver_id"),
        r.pick(VEHICLES).alias("vehicle_type"),
        F.date_format(F.timestamp_seconds(begin), iso).alias("start_time"),
        F.date_format(F.timestamp_seconds(end), iso).alias("end_time"),
        r.pick(AREAS).alias("start_location"),
        r.pick(AREAS).alias("end_location"),
        distance.alias("distance_km"),
        F.round(distance * (r.below(10) + 10), 2).alias("fare_amount"),
        r.pick(PAYMENTS).alias("payment_method"),
        F.round(r.unit() * 4 + 1, 2).alias("customer_rating"),
    )


def customer_events(spark: SparkSession, n: int, as_of: str, parts: int = 8, seed: int = 15) -> DataFrame:
    """Events of customers 1..5000; one like or wish in ten names no product, a cart entry always does."""
    ids, r = _rows(spark, n, parts, seed)
    kind, product = r.pick(CUSTOMER_EVENTS), (r.below(500) + 1).cast("int")
    missing = (r.unit() < 0.1) & (kind != "CART_ADD")
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(as_of).cast("timestamp")) + F.col("id"))
    return ids.select(
        F.concat_ws("-", r.word(8), r.word(12)).alias("event_id"),
        (r.below(5000) + 1).cast("int").alias("customer_id"),
        kind.alias("event_type"),
        F.when(~missing, product).alias("product_id"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_timestamp"),
    )


def user_events(spark: SparkSession, n: int, seed: int = 16) -> DataFrame:
    ids, r = _rows(spark, n, 4, seed)
    return ids.select(
        F.concat(F.lit("user"), r.below(10)).alias("userId"),
        r.pick(USER_ACTIONS).alias("action"),
        (r.unit() * 500).alias("value"),
    )


def fx_transactions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FX_TRANSACTIONS, "txn_id bigint, amount double, currency string")


def fx_rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FX_RATES, "currency string, rate_to_usd double")
