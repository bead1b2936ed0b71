"""Customer profiles from mergeable totals: a batch adds its own, and the history is not read again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.customer_profile import category_totals, clean_transactions, merged_totals, profiles_of
from millrace.session import settle
from millrace.sinks.files import delete_path, path_exists, replace_partitions, subfolders, write_lake
from millrace.sinks.keyed import BUCKETS, bucket_of, upsert_touched

TOTALS = (
    "customer_id bigint, category string, spend decimal(28,2), n bigint, "
    "first_at timestamp_ntz, last_at timestamp_ntz, bucket int, batch_id bigint"
)


@dataclass
class ProfileStates:
    """Totals per customer and category under ``path``, and the profiles made from them under ``profiles_path``.

    Totals lie by bucket of the customer and batch. A batch writes its own partitions, which it overwrites when it is
    repeated, and then makes the profiles of its customers from the totals of their buckets. ``compact`` folds the batches so far
    into one; the folder of the folded totals is named after the last of them, and that batch and those before it
    are ignored from then on. Transactions must reach one batch only (``processed.CompleteJob`` sees to that); copies
    within a batch count once. The category of a product is that of the time of its batch. For one writer at a time.
    """

    spark: SparkSession
    path: str
    profiles_path: str
    buckets: int = BUCKETS

    def folded(self) -> int:
        """The last batch that is folded in, -1 for none."""
        return max((int(n.split("-")[1]) for n in subfolders(self.spark, self.path) if n.startswith("upto-")), default=-1)

    def _folder(self, upto: int) -> str:
        return f"{self.path}/upto-{upto}" if upto >= 0 else f"{self.path}/start"

    def totals(self) -> DataFrame:
        """All partial totals, as they are stored."""
        folder = self._folder(self.folded())
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], TOTALS)
        return self.spark.read.schema(TOTALS).parquet(folder)

    def of_batch(self, delta: DataFrame, products: DataFrame, batch_id: int) -> DataFrame:
        """The totals of one batch; reads nothing but the batch and the products."""
        totals = category_totals(clean_transactions(delta), products)
        placed = totals.withColumn("bucket", bucket_of(["customer_id"], self.buckets)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        return self._typed(placed)

    def _typed(self, totals: DataFrame) -> DataFrame:
        kinds = [part.strip().split(" ") for part in TOTALS.split(", ")]
        return totals.select(*(F.col(name).cast(kind).alias(name) for name, kind in kinds))

    def add(self, delta: DataFrame, products: DataFrame, customers: DataFrame, batch_id: int) -> None:
        """Take up a batch of transactions and renew its customers' profiles; a repeat changes nothing."""
        folded = self.folded()
        if batch_id <= folded:
            return
        own = settle(self.of_batch(delta, products, batch_id), "totals")
        touched = [row[0] for row in own.select("bucket").distinct().collect()]
        if not touched:
            return
        replace_partitions(own, self._folder(folded), ["bucket", "batch_id"])
        near = self.totals().filter(F.col("bucket").isin(touched))
        affected = near.join(own.select("customer_id").distinct(), "customer_id", "left_semi")
        fresh = profiles_of(merged_totals(affected), customers)
        upsert_touched(fresh.withColumn("bucket", bucket_of(["customer_id"], self.buckets)), ["customer_id"], self.profiles_path, "bucket")

    def profiles(self) -> DataFrame:
        return self.spark.read.parquet(self.profiles_path).drop("bucket")

    def compact(self) -> None:
        """Fold the totals of all batches into one row per customer and category, in a new folder; the old one goes last."""
        before = self.folded()
        stored = self.totals()
        last = stored.agg(F.max("batch_id")).first()[0]
        if last is None or last == before:
            return
        folded = merged_totals(stored).withColumn("bucket", bucket_of(["customer_id"], self.buckets)).withColumn("batch_id", F.lit(last))
        # A whole write, which Spark marks as complete; until then the old folder counts.
        write_lake(self._typed(folded), self._folder(last), ["bucket", "batch_id"])
        if self.folded() != last:
            raise RuntimeError(f"the totals up to batch {last} are not complete")
        delete_path(self.spark, self._folder(before))
