"""Hierarchical packing of documents into sequences of several lengths.

A document that is longer than the longest window fills whole windows; what remains is routed to the
smallest tier that holds it. The longest piece that waits opens a window of its tier, and the gap is
filled with the longest waiting pieces that fit, and at last with the head of the shortest piece, whose
rest goes on waiting. So every window but the last of a partition is full. Full windows are dealt, longest
first, to step groups of equal token counts.

Everything happens in one pass over each partition, without a shuffle: at most ``WAITING`` pieces wait
at a time. Sequence and group numbers carry the partition's number, so a task that runs again after an
executor is lost gives the same rows.

Defined cases: a null or empty text is the end id alone; repeated rows are packed as often as they come;
a null doc_id stays null; an empty table gives an empty table. One sequence per partition may be shorter
than its window; it alone needs padding.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import giving_back, in_parts, table
from millrace.llm.registry import query
from millrace.llm.tokens import END_ID, default_vocabulary, word_ids

TIERS = (256, 512, 1024, 2048)
WAITING = 4096
GROUP_TOKENS = 64 * 2048
GROUPS_AT_ONCE = 4

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)
ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("tier", pa.int32()),
        ("step_group", pa.int64()),
    ]
)


class Packer:
    """Windows of one partition. A piece is (length, number, doc_id, start, doc_tokens, ids)."""

    def __init__(self, tiers=TIERS, group_tokens=GROUP_TOKENS, waiting=WAITING):
        self.tiers, self.group_tokens, self.limit = tuple(sorted(tiers)), group_tokens, waiting
        self.longest = self.tiers[-1]
        self.waiting: list[tuple] = []
        self.full: list[tuple[int, list[tuple]]] = []
        self.full_tokens = 0
        self.pieces = 0

    def add(self, doc_id, ids: bytes) -> None:
        n, start = len(ids) // 4, 0
        while n - start >= self.longest:
            self._close(self.longest, [self._piece(doc_id, start, self.longest, n, ids)])
            start += self.longest
        if start < n:
            insort(self.waiting, self._piece(doc_id, start, n - start, n, ids))
        while len(self.waiting) > self.limit:
            self._window()

    def finish(self) -> None:
        while self.waiting:
            self._window()

    def _piece(self, doc_id, start, length, n, ids) -> tuple:
        # The running number makes pieces of one length comparable, in order of arrival.
        self.pieces += 1
        return (length, self.pieces, doc_id, start, n, ids[4 * start : 4 * (start + length)])

    def _close(self, tier: int, pieces: list[tuple]) -> None:
        self.full.append((tier, pieces))
        self.full_tokens += sum(p[0] for p in pieces)

    def _window(self) -> None:
        opened = self.waiting.pop()
        tier = next(t for t in self.tiers if t >= opened[0])
        inside, gap = [opened], tier - opened[0]
        while gap and self.waiting:
            place = bisect_right(self.waiting, (gap, float("inf")))
            if place:
                piece = self.waiting.pop(place - 1)
            else:
                length, number, doc_id, start, n, ids = self.waiting.pop(0)
                piece = (gap, number, doc_id, start, n, ids[: 4 * gap])
                insort(self.waiting, (length - gap, number, doc_id, start + gap, n, ids[4 * gap :]))
            inside.append(piece)
            gap -= piece[0]
        self._close(tier, inside)

    def groups(self, last: bool) -> list[list[tuple[int, list[tuple]]]]:
        """Windows dealt to groups of equal tokens; before the last call only when many are ready."""
        many = self.full_tokens // self.group_tokens
        if not self.full or not last and many < GROUPS_AT_ONCE:
            return []
        dealt: list[list] = [[] for _ in range(max(1, many))]
        loads = [0] * len(dealt)
        for tier, pieces in sorted(self.full, key=lambda w: -w[0]):
            least = loads.index(min(loads))
            dealt[least].append((tier, pieces))
            loads[least] += tier
        self.full, self.full_tokens = [], 0
        return dealt


def packed_batches(batches: Iterator[pa.RecordBatch], vocabulary: str, tiers=TIERS) -> Iterator[pa.RecordBatch]:
    """Token ids, windows and groups of one partition's documents (columns doc_id and text)."""
    ids, packer, end = word_ids(vocabulary), Packer(tiers), END_ID.to_bytes(4, "little")
    first = TaskContext.get().partitionId() << 33
    sequence = group = first

    def ready(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal sequence, group
        rows: list[tuple] = []
        for windows in packer.groups(last):
            for tier, pieces in windows:
                offset = 0
                for length, _, doc_id, start, n, piece in pieces:
                    rows.append((doc_id, start, length, piece, n, sequence, offset, tier, group))
                    offset += length
                sequence += 1
            group += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)

    for batch in in_parts(batches):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            packer.add(doc_id, ids.of(text.as_py()) + end)
            if packer.full_tokens >= GROUPS_AT_ONCE * GROUP_TOKENS:
                yield from ready(False)
    packer.finish()
    yield from ready(True)


def pack(docs: DataFrame, vocabulary_path: str | None = None, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """One row per piece of a document, with its ids, window and step group.

    The vocabulary file is read on the driver and sent to the executors (a few MB, whatever the data).
    """
    with open(vocabulary_path or default_vocabulary(), encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(giving_back(lambda batches: packed_batches(batches, shared.value, tiers)), SCHEMA)


@query()
def op5_packing(spark, sf_dir: str) -> DataFrame:
    """Every document in windows of at most 2048 tokens."""
    packed = pack(table(spark, sf_dir, "documents"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
