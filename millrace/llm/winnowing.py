"""Winnowing fingerprints of documents, in DataFrame functions only.

The text is cut into words, every run of ``k`` words gets the polynomial hash a rolling hash would
give it, and in each window of ``window`` consecutive hashes the smallest is chosen, the rightmost
among equals. A chosen hash is kept with its position (the number of its first word), so any run of
``window + k - 1`` words that two texts share is certain to give both a common hash.

Both the k-gram hashes and the window minima are formed by doubling: the value of 2n neighbours
comes from two values of n neighbours, so a window of 8 takes three passes over an array instead of
eight.

Defined cases: a null text counts as empty, and an empty text has no hashes; a text of fewer than
``k`` words has one hash, of all its words; fewer hashes than a window give one minimum. Two texts
without hashes are alike (1.0). Case is ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import table, words_of
from millrace.llm.registry import query

K_WORDS = 5
WINDOW = 8
PRIME = 2**31 - 1
BASE = 1_000_003
# Positions count down from here, so that the smaller of two equal hashes is the one to the right.
LAST_POSITION = 2**31 - 1


def _joined(left: Column, right: Column, shift: int, width: Column | int, merge) -> Column:
    """merge(left[i], right[i + shift]) for every i at which ``width`` values follow each other."""
    n = F.size(left) - width
    n = F.greatest(n, F.lit(0))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, 1 + shift, n), merge)


def _appended(width: int):
    """The hash of a run followed by one of ``width`` words."""
    factor = pow(BASE, width, PRIME)
    return lambda a, b: (a * factor + b) % PRIME


def _gram_hashes(df: DataFrame, k: int) -> DataFrame:
    """``__g``: the hash of every k-gram of the word hashes ``__h``."""
    df = df.withColumn("__p1", F.col("__h"))
    size = 1
    while size * 2 <= k:
        half = F.col(f"__p{size}")
        df = df.withColumn(f"__p{size * 2}", _joined(half, half, size, size, _appended(size)))
        size *= 2
    whole, have = f"__p{size}", size
    while have < k:
        part = 1
        while part * 2 <= k - have:
            part *= 2
        df = df.withColumn(f"__q{have}", _joined(F.col(whole), F.col(f"__p{part}"), have, part, _appended(part)))
        whole, have = f"__q{have}", have + part
    short = F.aggregate("__h", F.lit(0).cast("long"), lambda a, x: (a * BASE + x) % PRIME)
    few = F.when(F.size("__h") == 0, F.array().cast("array<bigint>")).otherwise(F.array(short))
    df = df.withColumn("__g", F.when(F.size("__h") >= k, F.col(whole)).otherwise(few))
    return df.drop(*[c for c in df.columns if c[:3] in ("__p", "__q") and c[3:].isdigit() or c == "__h"])


def _window_minima(df: DataFrame, window: int) -> DataFrame:
    """``__m``: the chosen hashes of ``__g``, packed as hash * 2^32 + (LAST_POSITION - position)."""
    packed = F.transform("__g", lambda h, i: h * F.lit(2**32) + (F.lit(LAST_POSITION) - i))
    df = df.withColumn("__m1", packed).drop("__g")
    least = lambda a, b: F.least(a, b)
    size = 1
    while size * 2 <= window:
        df = df.withColumn(f"__m{size * 2}", _joined(F.col(f"__m{size}"), F.col(f"__m{size}"), size, size, least))
        size *= 2
    last = f"__m{size}"
    if size < window:
        df = df.withColumn("__mw", _joined(F.col(last), F.col(last), window - size, window - size, least))
        last = "__mw"
    few = F.when(F.size("__m1") == 0, F.col("__m1")).otherwise(F.array(F.array_min("__m1")))
    df = df.withColumn("__m", F.array_distinct(F.when(F.size("__m1") >= window, F.col(last)).otherwise(few)))
    return df.drop(*[c for c in df.columns if c == "__mw" or c.startswith("__m") and c[3:].isdigit()])


def with_packed(df: DataFrame, text: str, out: str, k: int = K_WORDS, window: int = WINDOW) -> DataFrame:
    """``df`` with the fingerprint as one number per chosen hash, in order of position."""
    hashes = F.transform(F.col("__words"), lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME)))
    df = df.withColumn("__words", words_of(F.lower(text))).withColumn("__h", hashes).drop("__words")
    return _window_minima(_gram_hashes(df, k), window).withColumnRenamed("__m", out)


def hash_of(packed: Column) -> Column:
    return F.shiftright(packed, 32)


def position_of(packed: Column) -> Column:
    return (F.lit(LAST_POSITION) - packed % F.lit(2**32)).cast("int")


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K_WORDS, window: int = WINDOW) -> DataFrame:
    """``df`` with the array column ``out`` of structs (hash, position), in order of position."""
    unpacked = lambda v: F.struct(hash_of(v).alias("hash"), position_of(v).alias("position"))
    return with_packed(df, text, "__packed", k, window).withColumn(out, F.transform("__packed", unpacked)).drop("__packed")


def fingerprint_text(packed: str) -> Column:
    """A packed fingerprint as text: ``hash@position`` for each chosen hash."""
    one = lambda v: F.concat(F.lower(F.hex(hash_of(v))), F.lit("@"), position_of(v))
    return F.concat_ws(" ", F.transform(packed, one))


def likeness(left: Column, right: Column) -> Column:
    """Jaccard likeness of two arrays of hashes, 1.0 when both are empty."""
    both = F.size(F.array_union(left, right))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(left, right)) / both)


def hashes_of(packed: str) -> Column:
    return F.array_distinct(F.transform(packed, hash_of))


def with_next(df: DataFrame, key: str, tie: str, columns: dict[str, str], buckets: int | None = None) -> DataFrame:
    """Each row with columns of the row that follows in order of ``key``; the first follows the last.

    The key range is cut at approximate quantiles (at most ``buckets`` numbers reach the driver), and
    the row a bucket starts with is also sent, marked, to the end of the bucket before it. So the rows
    move once, and no bucket has to look into another. Rows of one key follow each other in order of
    ``tie``; rows without a key come last. ``columns`` maps the new names to the columns taken over.
    """
    spark = df.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = [i / buckets for i in range(buckets)]
    found = df.agg(F.min(key).alias("least"), F.percentile_approx(key, marks, max(10_000, 20 * buckets)).alias("cuts")).first()
    cuts = sorted({found["least"], *(found["cuts"] or [])} - {None})
    if cuts:
        step = max(1, int(len(cuts) ** 0.5))
        coarse, all_cuts = F.lit(cuts[::step]), F.lit(cuts)
        block = F.size(F.filter(coarse, lambda c: c <= F.col(key)))
        inside = F.filter(F.slice(all_cuts, (F.greatest(F.col("__block"), F.lit(1)) - 1) * step + 1, step), lambda c: c <= F.col(key))
        bucket = F.when(F.col(key).isNull(), len(cuts)).otherwise((F.col("__block") - 1) * step + F.size(inside))
        df = df.withColumn("__block", block).withColumn("__bucket", bucket.cast("int"))
        starts = F.col(key) == F.element_at(all_cuts, F.col("__bucket"))
        before = F.when(F.col("__bucket") == 1, F.lit(len(cuts))).otherwise(F.col("__bucket") - 1)
        own = F.struct(F.col("__bucket").alias("bucket"), F.lit(False).alias("guest"))
        guest = F.struct(before.cast("int").alias("bucket"), F.lit(True).alias("guest"))
        df = df.withColumn("__at", F.explode(F.when(F.coalesce(starts, F.lit(False)), F.array(own, guest)).otherwise(F.array(own))))
        df = df.drop("__block", "__bucket")
    else:
        df = df.withColumn("__at", F.struct(F.lit(1).alias("bucket"), F.lit(False).alias("guest")))
    order = Window.partitionBy("__at.bucket").orderBy("__at.guest", F.col(key).asc_nulls_last(), tie)
    follows = {new: F.lead(F.struct(F.col(old).alias("v"))).over(order) for new, old in columns.items()}
    df = df.withColumns(follows).filter(~F.col("__at.guest"))
    # Without any key there is no marked row, so the last row is its own successor.
    return df.withColumns({new: F.when(F.col(new).isNull(), F.col(old)).otherwise(F.col(f"{new}.v")) for new, old in columns.items()}).drop("__at")


def edited_copies(docs: DataFrame) -> DataFrame:
    """Documents with a fingerprint, the edited text, its fingerprint and both likenesses.

    The edited text ends in the start of the next document: its last floor(n/4) code points give way
    to the first as many of that one. The whole text moves in one shuffle; fingerprints are formed
    before it, so that the next document's hashes come along with its text.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = with_packed(own, "text", "__print")
    paired = with_next(own, "doc_id", "text", {"__next": "text", "__next_print": "__print"})
    paired = paired.withColumn("n_chars", F.char_length("text").cast("long"))
    paired = paired.withColumn("__cut", F.floor(F.col("n_chars") / 4).cast("int"))
    edited = F.concat(F.expr("left(text, cast(n_chars as int) - __cut)"), F.expr("left(__next, __cut)"))
    paired = paired.withColumn("edited_text", edited).drop("__cut", "__next")
    paired = with_packed(paired, "edited_text", "__edited_print")
    sets = {f"{name}_set": hashes_of(name) for name in ("__print", "__next_print", "__edited_print")}
    return paired.withColumns(sets).select(
        "doc_id",
        "n_chars",
        "text",
        "edited_text",
        fingerprint_text("__print").alias("fingerprint"),
        fingerprint_text("__edited_print").alias("edited_fingerprint"),
        likeness(F.col("__print_set"), F.col("__edited_print_set")).alias("near_edited"),
        likeness(F.col("__print_set"), F.col("__next_print_set")).alias("near_next"),
    )


@query()
def op8_winnowing(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited copy, and how alike they are."""
    out = edited_copies(table(spark, sf_dir, "documents"))
    return out.withColumn("edited_sha256", F.sha2(F.col("edited_text"), 256)).drop("text", "edited_text")
