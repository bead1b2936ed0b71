"""Join forms: semi/anti restriction, roles, bridges, integrity guards, length joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.skew import join_on

IN_LIST_LIMIT = 200


def restrict_to_keys(facts: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``facts`` whose key occurs in ``keys`` (duplicates in ``keys`` do not matter)."""
    return join_on(facts, keys.select(*on), on, "left_semi")


def restrict_adaptive(
    facts: DataFrame, keys: DataFrame, key: str, max_in_list: int = IN_LIST_LIMIT
) -> DataFrame:
    """Few keys become an ``IN`` list that the scan can push down; more become a semi-join."""
    listed = [row[0] for row in keys.select(key).distinct().limit(max_in_list + 1).collect()]
    if len(listed) <= max_in_list:
        return facts.filter(F.col(key).isin(listed))
    return restrict_to_keys(facts, keys, [key])


def join_roles(
    facts: DataFrame, people: DataFrame, person_key: str, roles: Mapping[str, str]
) -> DataFrame:
    """Left-join one table several times; ``roles`` maps an output struct to its fact column."""
    out = facts
    others = [c for c in people.columns if c != person_key]
    for role, fact_key in roles.items():
        side = people.select(F.col(person_key).alias(fact_key), F.struct(person_key, *others).alias(role))
        out = join_on(out, side, [fact_key], "left")
    return out


def join_bridge(
    members: DataFrame, bridge: DataFrame, targets: DataFrame, member_key: str, target_key: str
) -> DataFrame:
    """Many-to-many: the bridge rows of the given members, with the target columns."""
    kept = restrict_to_keys(bridge, members, [member_key])
    return join_on(kept, targets, [target_key])


def without_pending(
    candidates: DataFrame, existing: DataFrame, on: Sequence[str], pending: str = "pending"
) -> DataFrame:
    """Candidates for which no live pending row with the same key exists."""
    waiting = existing.filter((F.col("status") == pending) & ~F.col("is_deleted")).select(*on)
    return join_on(candidates, waiting, on, "left_anti")


def referential_split(
    children: DataFrame, parents: DataFrame, on: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``: children with and without a parent row."""
    known = parents.select(*on).distinct().withColumn("__known", F.lit(True))
    marked = join_on(children, known, on, "left")
    accepted, rejected = marked.filter("__known"), marked.filter("__known IS NULL")
    return accepted.select(*children.columns), rejected.select(*children.columns)


def length_pairs(left: DataFrame, right: DataFrame, left_text: str, right_text: str) -> DataFrame:
    """All pairs with ``length(left_text) >= length(right_text)``.

    An equi-join: each left row is listed under the distinct right lengths it reaches, so no row
    meets a partner it must drop. The list of lengths is one value, as long as the lengths differ.
    """
    lengths = right.agg(F.collect_set(F.length(right_text)))
    listed = (
        left.withColumn("__lens", lengths.scalar())
        .withColumn("__max", F.length(left_text))
        .withColumn("__len", F.explode(F.expr("filter(__lens, n -> n <= __max)")))
        .drop("__lens", "__max")
    )
    return join_on(listed, right.withColumn("__len", F.length(right_text)), ["__len"]).drop("__len")


def length_match_counts(left: DataFrame, right: DataFrame, left_text: str, right_text: str) -> DataFrame:
    """Per left row, how many right texts are no longer than it — without forming the pairs."""
    sizes = right.groupBy(F.length(right_text).alias("__len")).agg(F.count("*").alias("__n"))
    wanted = left.select(F.length(left_text).alias("__len")).distinct().withColumn("__n", F.lit(0))
    # One row per distinct text length, so a single ordered window over them stays small.
    steps = (
        sizes.unionByName(wanted)
        .groupBy("__len")
        .agg(F.sum("__n").alias("__n"))
        .withColumn("matches", F.sum("__n").over(Window.orderBy("__len")))
        .drop("__n")
    )
    return join_on(left.withColumn("__len", F.length(left_text)), steps, ["__len"]).drop("__len")
