"""MinHash near-dedup with tensored banding.

A document is the set of its distinct five-word shingles (64-bit hashes), and equal sets count once. Two
small collections of ``m`` sub-keys each are formed, a sub-key from ``ROWS`` minhashes; a table key joins
one sub-key of the first collection with one of the second. So 2 * m * ROWS minhashes serve m * m tables,
where plain banding with keys as long would compute m * m * 2 * ROWS.

1. Sub-keys that no other set has are dropped first, so that only documents with a possible partner form
   table keys. Tables entries with the same members are one bucket.
2. In each bucket, sets whose minhashes agree well enough are joined to a spanning forest. A bucket or
   cluster above ``BLOCK`` members is first cut into blocks, each with its first member, which joins most of
   it. Then only what is still apart meets: the members outside of its largest part meet each other and that
   part, in pairs of blocks, so no task holds more than two blocks.
3. The components of these edges are clusters. Each cluster's full shingle sets meet (in the same two steps),
   intersections are counted, and a spanning forest of the confirmed links comes out.
4. The components of the confirmed links are the result.

No step lists the pairs of a group: what leaves a task is at most one edge per member. ``m`` is the smallest
number for which a pair exactly at the threshold is missed with a probability below ``MISS``; the minhash
agreement asked for in step 2 lies four standard deviations below the threshold.

Defined cases: A-Z are lower-cased and words end at ASCII white space; a text of fewer than five words is one
shingle; a null, empty or blank text has none and is linked with nothing; a row with a null doc_id is linked
with nothing and kept; rows that share a doc_id are compared by their own texts, equal rows are copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, giving_back, in_parts, table, text_check
from millrace.llm.components import components
from millrace.llm.registry import query
from millrace.session import discard, release, settle

SHINGLE_WORDS = 5
ROWS = 3
MISS = 2e-4
BLOCK = 512
# Buckets are joined in rounds, of so many sixteenths of them each.
ROUNDS = (1, 2, 4, 9)
PERCENT = 80
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def collection_size(percent: int) -> int:
    """m: one collection misses a pair at the threshold with half of ``MISS``."""
    return ceil(log(MISS / 2) / log(1 - (percent / 100) ** ROWS))


def least_agreement(percent: int) -> float:
    p, hashes = percent / 100, 2 * ROWS * collection_size(percent)
    return p - 4 * sqrt(p * (1 - p) / hashes)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (shift and multiply, twice)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, SHINGLE_WORDS)
    rolled = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        rolled = rolled * _MULTIPLIER + hashed[k : n - width + 1 + k]
    return np.unique(mixed(rolled))


def minhashes(found: np.ndarray, many: int) -> np.ndarray:
    """The smallest value of each of ``many`` multiplicative hashes, its upper 32 bits."""
    factors = mixed(np.arange(1, many + 1, dtype=np.uint64)) | np.uint64(1)
    least = np.full(many, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 4096):
        least = np.minimum(least, (found[at : at + 4096, None] * factors).min(axis=0))
    return (least >> np.uint64(32)).astype("<u4")


def _digest(found: np.ndarray) -> int:
    return int(np.add.reduce(mixed(found ^ _MULTIPLIER), dtype=np.uint64).astype(np.int64))


def sketches(docs: DataFrame, many: int) -> DataFrame:
    """doc_id, check (of the text), n_shingles, node (a digest of the set) and the minhashes of every row."""
    names = ["doc_id", "check", "n_shingles", "node", "signature"]

    @giving_back
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            sizes, nodes, signatures = [], [], []
            for text in batch.column(2):
                found = shingles(text.as_py())
                sizes.append(len(found))
                nodes.append(_digest(found))
                signatures.append(minhashes(found, many).tobytes())
            made = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], names=names)

    rows = docs.select(F.col("doc_id").cast("long"), text_check("text").alias("check"), F.col("text").cast("string"))
    return rows.mapInArrow(sketch, "doc_id long, check long, n_shingles long, node long, signature binary")


def table_entries(sets: DataFrame, m: int) -> DataFrame:
    """(bucket, node): the tensored table keys of sets (node, signature) that share sub-keys."""

    @giving_back
    def sub_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(n, 2 * m, ROWS).astype(np.uint64)
            key = np.broadcast_to(np.arange(2 * m, dtype=np.uint64), (n, 2 * m))
            for k in range(ROWS):
                key = mixed(key * _MULTIPLIER + values[:, :, k])
            node = np.repeat(batch.column(0).to_numpy(), 2 * m)
            place = np.tile(np.arange(2 * m, dtype=np.int32), n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(place), pa.array(key.ravel().astype(np.int64))], names=["node", "place", "sub"]
            )

    sub = sets.select("node", "signature").mapInArrow(sub_keys, "node long, place int, sub long")
    # The sub-key holds its place, so it tells the tables apart by itself.
    # Settled, so that both sides of the join are dealt out for it and a heavy sub-key can be split.
    shared = settle(sub.groupBy("sub").agg(F.count("*").alias("n")).filter("n > 1").select("sub"), "shared")
    kept = sub.join(shared, "sub", "left_semi")
    own = kept.groupBy("node").agg(
        F.collect_list(F.when(F.col("place") < m, F.col("sub"))).alias("first"),
        F.collect_list(F.when(F.col("place") >= m, F.col("sub"))).alias("second"),
    )
    keys = F.flatten(F.transform("first", lambda x: F.transform("second", lambda y: F.xxhash64(x, y))))
    return own.select(F.explode(keys).alias("bucket"), "node")


def distinct_buckets(entries: DataFrame) -> DataFrame:
    """(bucket, members, least) of buckets whose members are not all in one ``part`` yet; of buckets with equal members one."""
    sized = entries.groupBy("bucket").agg(
        F.count("*").alias("members"),
        F.bit_xor(F.xxhash64("node")).alias("all_nodes"),
        F.min("node").alias("least"),
        F.min("part").alias("first_part"),
        F.max("part").alias("last_part"),
    )
    alike = sized.filter("first_part <> last_part").groupBy("members", "all_nodes", "least")
    return alike.agg(F.min("bucket").alias("bucket")).select("bucket", "members", "least")


def in_blocks(rows: DataFrame, members: str, first: str) -> DataFrame:
    """``rows`` with the columns of ``in_block_pairs``: each group is cut into blocks of its nodes, with its ``first`` node in all."""
    blocks = F.ceil(F.col(members) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("__blocks")).cast("int")
    places = F.when(F.col("node") == F.col(first), F.sequence(F.lit(0), F.col("__blocks") - 1)).otherwise(F.array(own))
    cut = rows.withColumn("__blocks", blocks).withColumn("own_block", F.explode(places))
    return cut.select(*rows.columns, "own_block", F.col("own_block").alias("one"), F.col("own_block").alias("two"))


def largest_parts(rows: DataFrame, group: str) -> DataFrame:
    """(group, main, mains): the largest part and its number of nodes of each group of ``rows`` (group, node, part) with several parts."""
    sizes = rows.groupBy(group, "part").agg(F.count("*").alias("n"))
    most = sizes.groupBy(group).agg(F.max(F.struct("n", "part")).alias("most"), F.count("*").alias("parts")).filter("parts > 1")
    return settle(most.select(group, F.col("most.part").alias("main"), F.col("most.n").alias("mains")), "mains")


def in_parts_apart(rows: DataFrame, group: str, members: str, mains: DataFrame) -> DataFrame:
    """``in_block_pairs`` where the nodes of a group's largest part (``mains``, of groups above the bound) do not meet each other.

    The others have the first blocks, that part has the last. A node of it meets the blocks of the others alone, so few
    others make few rows, however large the group.
    """
    known = rows.join(mains, group, "left")
    others = F.col(members) - F.coalesce("mains", F.lit(0))
    inside = F.coalesce(F.col("part") == F.col("main"), F.lit(False))
    spread = F.xxhash64("node", F.lit(1))
    known = known.withColumns({
        "__others": F.greatest(F.ceil(others / BLOCK), F.lit(1)).cast("int"),
        "__mains": F.ceil(F.coalesce("mains", F.lit(0)) / BLOCK).cast("int"),
    })
    own = F.when(inside, F.col("__others") + F.pmod(spread, F.greatest("__mains", F.lit(1)))).otherwise(F.pmod(spread, F.col("__others")))
    last = F.col("__others") - 1 + F.when(inside, F.lit(0)).otherwise(F.col("__mains"))
    return _met(known.withColumn("own_block", own.cast("int")), F.sequence(F.lit(0), last), rows.columns)


def _met(rows: DataFrame, blocks: Column, columns: list[str]) -> DataFrame:
    """A row per pair of ``own_block`` and one of ``blocks``."""
    pairs = F.transform(
        blocks, lambda o: F.struct(F.least(F.col("own_block"), o).alias("one"), F.greatest(F.col("own_block"), o).alias("two"))
    )
    return rows.withColumn("__pair", F.explode(pairs)).select(*columns, "own_block", "__pair.one", "__pair.two")


def in_block_pairs(rows: DataFrame, group: str, members: str, node: str = "node", block: int = BLOCK) -> DataFrame:
    """``rows`` with columns ``one`` and ``two``: each group is dealt to pairs of blocks of its nodes.

    A group within the bound is the pair (0, 0). In a larger one each node meets every block.
    """
    blocks = F.ceil(F.col(members) / block).cast("int")
    own = F.pmod(F.xxhash64(node, F.lit(1)), F.col("__blocks")).cast("int")
    dealt = rows.withColumn("__blocks", blocks).withColumn("own_block", own)
    return _met(dealt, F.sequence(F.lit(0), F.col("__blocks") - 1), rows.columns)


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[list]]:
    """Runs of equal values in the first ``keys`` columns of sorted batches, each as a list of columns."""
    held: list[list] | None = None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        heads = list(zip(*columns[:keys]))
        at = 0
        while at < len(heads):
            stop = at + 1
            while stop < len(heads) and heads[stop] == heads[at]:
                stop += 1
            part = [c[at:stop] for c in columns]
            if held is not None and tuple(c[0] for c in held[:keys]) == heads[at]:
                for kept, new in zip(held, part):
                    kept.extend(new)
            else:
                if held is not None:
                    yield held
                held = part
            at = stop
    if held is not None:
        yield held


class Forest:
    """Union-find over the members of one group; remembers the links that joined two trees.

    Members of one of the ``parts``, if given, are joined from the start.
    """

    def __init__(self, n: int, parts: list[int] | None = None):
        self.root = np.arange(n) if parts is None else np.unique(parts, return_inverse=True)[1]
        self.links: list[tuple[int, int]] = []

    def join(self, i: int, others: np.ndarray) -> None:
        for j in others.tolist():
            a, b = self.root[i], self.root[j]
            if a != b:
                self.root[self.root == b] = a
                self.links.append((i, j))


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"]
    )


def _meetings(own: list[int], one: int, two: int) -> Iterator[tuple[int, np.ndarray]]:
    """Members, each with those it has to meet: all later ones, or where two blocks meet, the smaller one's with all of the other."""
    if one == two:
        yield from ((i, np.arange(i + 1, len(own))) for i in range(len(own) - 1))
    else:
        few, many = sorted((np.flatnonzero(np.array(own) == b) for b in (one, two)), key=len)
        yield from ((int(i), many) for i in few)


def alike_edges(members: DataFrame, many: int, agreement: float) -> DataFrame:
    """Spanning forests (a, b) of the members of each bucket whose minhashes agree, between their parts."""

    @giving_back
    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for _, one, two, own, nodes, parts, signatures in grouped(batches, 3):
            s = np.frombuffer(b"".join(signatures), "<u4").reshape(len(nodes), many)
            forest = Forest(len(nodes), parts)
            for i, others in _meetings(own, one[0], two[0]):
                others = others[forest.root[others] != forest.root[i]]
                forest.join(i, others[(s[others] == s[i]).sum(axis=1) >= agreement * many])
            found += [(nodes[i], nodes[j]) for i, j in forest.links]
            if len(found) > 10_000:
                yield _edges(found)
                found = []
        yield _edges(found)

    sorted_rows = (
        members.select("bucket", "one", "two", "own_block", "node", "part", "signature")
        .repartition("bucket", "one", "two")
        .sortWithinPartitions("bucket", "one", "two")
    )
    return sorted_rows.mapInArrow(forests, "a long, b long")


def confirmed_edges(sets: DataFrame, percent: int) -> DataFrame:
    """Spanning forests (a, b) of the links that the full sets of each cluster confirm, between their parts."""

    @giving_back
    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for _, one, two, own, nodes, parts, packed in grouped(batches, 3):
            sizes = np.array([len(p) // 8 for p in packed])
            _, flat = np.unique(np.frombuffer(b"".join(packed), "<u8"), return_inverse=True)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            forest, inside = Forest(len(nodes), parts), np.zeros(flat.max() + 1, bool)
            for i, others in _meetings(own, one[0], two[0]):
                if (forest.root[others] == forest.root[i]).all():
                    continue
                mine = flat[starts[i] : starts[i + 1]]
                inside[mine] = True
                common = np.add.reduceat(inside[flat], starts[:-1], dtype=np.int64)[others]
                inside[mine] = False
                forest.join(i, others[100 * common >= percent * (sizes[i] + sizes[others] - common)])
            found += [(nodes[i], nodes[j]) for i, j in forest.links]
            if len(found) > 10_000:
                yield _edges(found)
                found = []
        yield _edges(found)

    sorted_rows = (
        sets.select("cluster", "one", "two", "own_block", "node", "part", "shingles")
        .repartition("cluster", "one", "two")
        .sortWithinPartitions("cluster", "one", "two")
    )
    return sorted_rows.mapInArrow(forests, "a long, b long")


def _sets_of(rows: DataFrame) -> DataFrame:
    """Rows (cluster, members, node, part, text) with the packed shingle set in place of the text."""
    kind = "cluster long, members long, node long, part long, shingles binary"

    @giving_back
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            found = [shingles(t.as_py()) for t in batch.column(4)]
            # A doc_id may stand for several texts; only the one that gave the node is meant.
            keep = pa.array([_digest(s) == n for s, n in zip(found, batch.column(2).to_pylist())], pa.bool_())
            sets = pa.array([s.astype("<u8").tobytes() for s in found], pa.binary())
            out = pa.RecordBatch.from_arrays([*batch.columns[:4], sets], names=["cluster", "members", "node", "part", "shingles"])
            yield out.filter(keep)

    return rows.select("cluster", "members", "node", "part", "text").mapInArrow(packed, kind)


def candidate_clusters(entries: DataFrame, sets: DataFrame, many: int, agreement: float) -> DataFrame:
    """(node, root) of the components of agreeing members of all buckets.

    Copies of one text meet in nearly every table. So some of the buckets, chosen by their keys, are joined first, and in each
    round after only those count whose members are not yet together; within these, only what joins two components is looked for.
    The first round joins no more of a bucket above ``BLOCK`` than meets in its blocks; the second takes such buckets again.
    """
    joined, found, begin, end = None, None, 0, 0
    for sixteenths in ROUNDS:
        turn = F.pmod(F.col("bucket"), F.lit(sum(ROUNDS)))
        end += sixteenths
        rows = entries.filter((turn >= begin) & (turn < end))
        if joined is None:
            rows = rows.withColumn("part", F.col("node"))
        else:
            rows = rows.join(joined, "node", "left").withColumn("part", F.coalesce("root", "node")).drop("root")
            # Both what counts a bucket and what deals it out read the same rows.
            rows = settle(rows, "parts")
        chosen = distinct_buckets(rows)
        if joined is not None and begin == 0:
            chosen = chosen.filter((F.col("members") > BLOCK) | (turn >= ROUNDS[0]))
        members = settle(rows.join(chosen, "bucket"), "members")
        if joined is None:
            dealt = in_blocks(members, "members", "least")
        else:
            dealt = in_parts_apart(members, "bucket", "members", largest_parts(members.filter(F.col("members") > BLOCK), "bucket"))
            begin = end
        dealt = dealt.join(sets.select("node", "signature"), "node")
        edges = settle(alike_edges(dealt, many, agreement), "edges")
        discard(members)
        found = edges if found is None else found.unionByName(edges)
        joined = settle(components(found), "joined")
        release(entries.sparkSession)
    return joined


def confirmed_groups(docs: DataFrame, sets: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the components of the links that the full sets of ``clusters`` (node, root) confirm."""
    sizes = clusters.groupBy("root").agg(F.count("*").alias("members"))
    nodes = clusters.join(sizes, "root").select("node", F.col("root").alias("cluster"), "members")

    def sets_of(wanted: DataFrame, written: bool = False) -> DataFrame:
        wanted = wanted.join(sets.select("node", F.col("least_doc").alias("doc_id")), "node")
        # Few rows, once written, are known to be few, so that no other text moves to meet them.
        wanted = settle(wanted, "wanted") if written else wanted
        texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(wanted, "doc_id")
        # Copies of a row would meet themselves; they change no link.
        return _sets_of(texts)

    # The root of a cluster is one of its nodes.
    cut = in_blocks(sets_of(nodes.withColumn("part", F.col("node"))), "members", "cluster")
    edges = settle(confirmed_edges(cut, percent), "links")
    groups = settle(components(edges), "linked")
    release(docs.sparkSession)
    large = nodes.filter(F.col("members") > BLOCK).join(groups, "node", "left")
    large = settle(large.withColumn("part", F.coalesce("root", "node")).drop("root"), "large")
    mains = largest_parts(large, "cluster")
    if mains.isEmpty():
        return groups
    more = in_parts_apart(sets_of(large.join(mains.select("cluster"), "cluster"), written=True), "cluster", "members", mains)
    return components(edges.unionByName(confirmed_edges(more, percent)))


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, check, n_shingles, node, component_id, group and kept, one row per row of ``docs``.

    Documents whose sets have ``100 * intersection >= percent * union`` are linked; component_id is the
    smallest doc_id that links reach. ``group`` is the number of the component.
    """
    m = collection_size(percent)
    many = 2 * ROWS * m
    rows = settle(sketches(docs, many), "sketches")
    known = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = known.groupBy("node").agg(F.min("doc_id").alias("least_doc"), F.first("signature").alias("signature"))
    sets = settle(sets, "sets")
    entries = settle(table_entries(sets, m), "entries")
    clusters = candidate_clusters(entries, sets, many, least_agreement(percent))
    groups = confirmed_groups(docs, sets, clusters, percent)
    named = groups.join(sets.select("node", "least_doc"), "node")
    roots = named.groupBy("root").agg(F.min("least_doc").alias("component_id"))
    linked = groups.join(roots, "root").select("node", "component_id", F.col("root").alias("group"))
    by_node = sets.select("node", "least_doc").join(linked, "node", "left")
    by_node = by_node.select(
        "node", F.coalesce("component_id", "least_doc").alias("component_id"), F.coalesce("group", "node").alias("group")
    )
    # Settled like the sub-keys: a set that very many documents share is a heavy key below.
    by_node = settle(by_node, "groups")
    blank = rows.filter("n_shingles = 0 OR doc_id IS NULL")
    blank = blank.withColumns({"component_id": F.col("doc_id"), "group": F.lit(None).cast("long")})
    out = known.join(by_node, "node").unionByName(blank).drop("signature")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def dedupe(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id; all other rows stay.

    Rows of one group that share the smallest doc_id leave one of them. Blank texts and rows without a doc_id stay.
    """
    groups = near_groups(docs, percent).filter("kept AND group IS NOT NULL")
    first = groups.groupBy("group").agg(F.min(F.struct("doc_id", "check")).alias("row"))
    keepers = first.select(F.col("row.doc_id").alias("__id"), F.col("row.check").alias("__check")).distinct()
    keyed = docs.withColumn("__doc", F.struct(*docs.columns))
    linkable = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").cast("string").rlike(WORD), F.lit(False))
    chosen = keyed.filter(linkable).join(
        keepers, (F.col("doc_id").cast("long") == F.col("__id")) & (text_check("text") == F.col("__check"))
    )
    order = Window.partitionBy("__id", "__check").orderBy("text")
    one = chosen.withColumn("__n", F.row_number().over(order)).filter("__n = 1")
    return one.select("__doc.*").unionByName(keyed.filter(~linkable).select("__doc.*"))


@query()
def op2_minhash(spark, sf_dir: str) -> DataFrame:
    """The near-copy group of every document, at 85 of 100."""
    groups = near_groups(table(spark, sf_dir, "documents"), percent=85)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")
