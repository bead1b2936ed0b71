"""The state of many entities from a log of events, folded in parts that compose.

What a stretch of the log does to an entity is known without knowing the entity's state before it: for each state it could
be in, the state it ends in, and what was accepted on the way. Two stretches one after the other compose to one. So an entity
with very many events is folded in many tasks, and only one small row per stretch meets in the end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.aggregates import with_range

# Events of one entity that are folded at a time.
PART_EVENTS = 10_000

# The states of an item, and what each event makes of them; an event that a state does not name is refused.
ITEM_STATES = ("AVAILABLE", "ALLOCATED", "UNDER_MAINTENANCE", "RETIRED")
ITEM_EVENTS = {
    "ALLOCATED": {"AVAILABLE": "ALLOCATED"},
    "RETURNED": {"ALLOCATED": "AVAILABLE"},
    "RETURNED_DAMAGED": {"ALLOCATED": "UNDER_MAINTENANCE"},
    "REPAIRED": {"UNDER_MAINTENANCE": "AVAILABLE"},
    "RETIRED": {"AVAILABLE": "RETIRED", "UNDER_MAINTENANCE": "RETIRED"},
}


def _outcome(state: Column, accepted: Column, refused: Column, ref: Column) -> Column:
    kinds = zip(("state", "accepted", "refused", "ref"), ("int", "bigint", "bigint", "bigint"), (state, accepted, refused, ref))
    return F.struct(*(column.cast(kind).alias(name) for name, kind, column in kinds))


def _untouched(states: int) -> Column:
    """What no event at all does."""
    return F.array(*(_outcome(F.lit(s), F.lit(0), F.lit(0), F.lit(None)) for s in range(states)))


def _after_event(effects: Column, event: Column, moves: Column) -> Column:
    """The outcomes for each first state after one more event."""

    def step(now: Column) -> Column:
        # An event that is not known is refused by every state.
        to = F.coalesce(F.try_element_at(F.try_element_at(moves, event["action"]), now["state"] + 1), F.lit(-1))
        taken = to >= 0
        return _outcome(
            F.when(taken, to).otherwise(now["state"]),
            now["accepted"] + taken.cast("int"),
            now["refused"] + (~taken).cast("int"),
            F.when(taken, event["ref"]).otherwise(now["ref"]),
        )

    return F.transform(effects, step)


def _composed(first: Column, second: Column) -> Column:
    """The outcomes of one stretch of the log and the next."""

    def step(now: Column) -> Column:
        then = F.element_at(second, now["state"] + 1)
        ref = F.when(then["accepted"] > 0, then["ref"]).otherwise(now["ref"])
        return _outcome(then["state"], now["accepted"] + then["accepted"], now["refused"] + then["refused"], ref)

    return F.transform(first, step)


def fold_log(
    log: DataFrame,
    key: str,
    order: Sequence[str],
    states: Sequence[str] = ITEM_STATES,
    events: Mapping[str, Mapping[str, str]] = ITEM_EVENTS,
    part_events: int = PART_EVENTS,
    ranges: int | None = None,
) -> DataFrame:
    """(key, effects) per key of ``log``: for each first state, in order of ``states``, a struct of the last state's number, the
    events accepted and refused, and the ``ref`` of the last one accepted.

    ``log`` has the key, ``action``, ``ref`` (bigint) and the ``order`` columns. The rows move once, to
    ranges of key and order, whatever key they belong to. Within a range, stretches of ``part_events`` are folded and then
    composed without another move; one row per key and range is left.
    """
    number = {name: n for n, name in enumerate(states)}
    lists = {a: F.array(*(F.lit(number[to[s]] if s in to else -1) for s in states)) for a, to in events.items()}
    moves = F.create_map(*(c for a, to in lists.items() for c in (F.lit(a), to)))
    ranges = ranges or int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = with_range(log.filter(F.col(key).isNotNull()), [key, *order], "__range", ranges)
    # Events that are equal by ``order`` go by action and ref.
    place = F.row_number().over(Window.partitionBy("__range").orderBy(key, *order, "action", "ref"))
    parted = ranged.withColumn("__part", F.floor(place / part_events))
    # The whole ranges are in place, so none of these groups moves a row.
    listed = parted.groupBy("__range", key, "__part").agg(F.sort_array(F.collect_list(F.struct(*order, "action", "ref"))).alias("events"))
    folded = F.aggregate("events", _untouched(len(states)), lambda effects, event: _after_event(effects, event, moves))
    stretches = listed.select("__range", key, "__part", folded.alias("effects"))
    for level in (["__range", key], [key]):
        within = "__part" if "__range" in level else "__range"
        together = stretches.groupBy(*level).agg(F.sort_array(F.collect_list(F.struct(within, "effects"))).alias("parts"))
        whole = F.aggregate("parts", _untouched(len(states)), lambda effects, part: _composed(effects, part["effects"]))
        stretches = together.select(*level, whole.alias("effects"))
    return stretches


def states_after(entities: DataFrame, log: DataFrame, key: str, order: Sequence[str], state: str = "status", **how) -> DataFrame:
    """``entities`` (one row per key) with ``state`` moved on by the log, and accepted, refused and last_ref.

    An entity without events keeps its state; one whose state is not known to the rules refuses every event.
    """
    states: Sequence[str] = how.get("states", ITEM_STATES)
    effects = fold_log(log, key, order, **how)
    start = reduce(lambda rest, n: F.when(F.col(state) == states[n], n + 1).otherwise(rest), range(len(states)), F.lit(None).cast("int"))
    joined = entities.join(effects, key, "left").withColumn("__end", F.try_element_at("effects", start))
    names = F.array(*map(F.lit, states))
    refused_all = F.element_at("effects", 1)["accepted"] + F.element_at("effects", 1)["refused"]
    return joined.withColumns(
        {
            state: F.coalesce(F.try_element_at(names, F.col("__end.state") + 1), F.col(state)),
            "accepted": F.coalesce(F.col("__end.accepted"), F.lit(0)),
            "refused": F.coalesce(F.col("__end.refused"), refused_all, F.lit(0)),
            "last_ref": F.col("__end.ref"),
        }
    ).drop("effects", "__end")
