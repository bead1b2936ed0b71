"""Connected components of a table of edges, without a driver or a task that sees a whole component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import settle

# At most so many hubs, from so many edges on, dealt over so many salts.
HUBS, HUB_EDGES, SALTS = 256, 1024, 64


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (node, root) per node of ``edges``; the root is the smallest node of its component.

    Alternating stars: every node hangs its larger neighbours on its smallest one, then its smaller
    neighbours likewise, until nothing changes. The number of rounds grows with the logarithm of the
    longest path. Minima combine before the shuffle, and the edges of a hub are dealt over salts. Each
    round is written to the shared folder, so a lost executor never reaches back further. Loops and
    repeated edges do not matter.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")
    current = settle(pairs.distinct(), "edges")
    before = _signature(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        # A node is a hub by its share of all edge ends, so there are at most HUBS of them.
        heavy = max(HUB_EDGES, 2 * before[0] // HUBS)
        hubs = [row["u"] for row in least.filter(F.col("n") > heavy).select("u").collect()]
        copies = F.when(F.col("u").isin(hubs), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        salt = F.when(F.col("u").isin(hubs), F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
        least = least.select("u", "m", F.explode(copies).alias("salt"))
        met = both.withColumn("salt", salt).join(least, ["u", "salt"]).filter("v > u")
        large = met.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = settle(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _signature(current)
        if after == before:
            break
        before = after
    roots = current.select("v").distinct()
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
