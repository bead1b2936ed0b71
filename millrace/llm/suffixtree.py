"""Language-model scores from a probabilistic suffix tree over words.

Symbols are the words of a text (A-Z lower-cased) and one end. The root of the tree is the smoothed
distribution of single symbols. A context of up to ``MAX_CONTEXT`` words is looked at if it occurs ``LEAST``
times, however large the corpus, and it becomes a state only if what follows it differs from what
follows its longest shorter state: its count times the Kullback-Leibler divergence must exceed the cost of
describing its symbols. Each state names the symbols that follow it ``LEAST`` times, less a discount; what that
leaves goes to the shorter state, scaled so that each distribution sums to one. A symbol is scored by the
longest state that ends just before it.

The levels of the tree are tables that grow with the corpus, and a score is a sum of one weight per gram of the text
(see ``_tree_weights``). Texts are split once and written as numbers, in blocks of some megabytes of text. Words and grams go by 64-bit hashes, and a block asks for
each of its words and grams once: the most frequent are sent to the tasks, all others are met by a join of one row
per block and key, and the block gets what it asked for in one row. A bit map of at most ``MAP_WORDS`` words keeps
most grams that have no weight from being asked for. Pairs of words are nearly all rare, so they are first counted by a
part of their hash alone: where even a whole part stays below ``LEAST``, none of its pairs is a row of the exact count. Where
a corpus outgrows one of these maps, it lets more through, but the result stays the same.

Defined cases: a null text counts as empty and has the end alone; a null doc_id belongs to no fold, so it is
scored but not learnt from; repeated rows are learnt from and scored as often as they come. Without training
rows every symbol has probability one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import give_back, id_fold, in_parts, table
from millrace.llm.registry import query
from millrace.session import batch_bytes, discard, release, settle

# The most frequent words and weights of grams are sent to the tasks, at most so many: 24 and 16 bytes each.
COMMON_WORDS, COMMON_GRAMS = 2**17, 2**19
LEAST = 16
MAX_CONTEXT = 3
DISCOUNT = 0.5
END = b""
FOLDS, HELD_OUT = 7, 2
# Bytes of text in a block, unless one text has more, and documents.
BLOCK_BYTES, BLOCK_DOCS = 2**22, 4096
# Bytes of blocks, or one block, that a task of Python is given at a time.
BATCH_BYTES = 2**23
# Grams, parts of hashes, and words a task holds before it sends on what it has counted.
GRAMS_HELD, PARTS_HELD, WORDS_HELD = 2**21, 2**21, 2**17
# A task counts the grams it holds in ranges of their prefixes, one after the other, by so many upper bits.
RANGE_BITS = 4
# Hash parts of pairs lie in so many slices, and there are about as many parts as words, up to MAP_WORDS * 64.
SLICES = 128
# The bit map of keys has at most so many words of 64 bits (64 MB), and sixteen bits a key up to there.
MAP_WORDS = 2**23
KEY_BITS = 3
# The hash of a gram turns so far for each word.
TURN = 21
# Rows of a heavy context, one of at most HEAVY that have this part of all places, are dealt to so many groups where they meet it.
SALTS, HEAVY = 16, 2**12


def symbol_hashes(symbols: list[bytes]) -> np.ndarray:
    """What Spark's ``xxhash64`` gives for binary values."""
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), symbols), np.uint64, len(symbols)).view(np.int64)


_END_HASH = symbol_hashes([END])[0]


def words_and_end(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


class Block:
    """The symbols of some texts, one after the other, each text with its end.

    ``symbols`` are the numbers of the block's distinct words place by place (the end is the last number), ``hashes`` those
    of the words and the end, ``sizes`` the texts' lengths and ``starts`` the place where each begins.
    """

    def __init__(self, hashes: np.ndarray, symbols: np.ndarray, sizes: np.ndarray):
        self.hashes, self.symbols, self.sizes = hashes, symbols, sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)

    def only(self, chosen: np.ndarray) -> Block:
        """The block without the texts that are not chosen."""
        if chosen.all():
            return self
        return Block(self.hashes, self.symbols[np.repeat(chosen, self.sizes)], self.sizes[chosen])

    def grams(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per length from 2 to ``longest``: hashes of the grams that end at each place, those of the grams one shorter,
        and whether the text has the longer ones."""
        one = self.hashes[self.symbols]
        place = np.arange(len(one)) - np.repeat(self.starts, self.sizes)
        last = one
        for length in range(2, longest + 1):
            whole = one.copy()
            whole[1:] ^= _turned(last[:-1])
            yield whole, last, place >= length - 1
            last = whole


def split_texts(texts: pa.Array) -> tuple[list[bytes], Block]:
    """The distinct words of some texts, and the texts as a block."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, ends = parts.flatten(), parts.offsets.to_numpy()
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    # White space at either end of a text leaves an empty word there.
    before = np.concatenate([[0], np.cumsum(real)])
    sizes = np.diff(before[ends - ends[0]])
    coded = flat.filter(pa.array(real)).dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    symbols = np.full(int(sizes.sum()) + len(sizes), len(words), np.int64)
    inside = np.ones(len(symbols), bool)
    inside[np.cumsum(sizes + 1) - 1] = False
    symbols[inside] = coded.indices.to_numpy()
    return words, Block(np.append(symbol_hashes(words), _END_HASH), symbols, sizes + 1)


def text_blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows in parts of at most ``BLOCK_BYTES`` of text (or one row)."""
    for batch in in_parts(batches, BLOCK_DOCS):
        length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        ends = np.cumsum(length, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + BLOCK_BYTES, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def _one_row(values) -> pa.Array:
    made = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(made)], pa.int32()), made)


def tokens(docs: DataFrame, learn: Column | None = None) -> DataFrame:
    """The texts of ``docs`` in blocks, a row each: their ids, which of them to learn from, and their symbols, as numbers.

    Written once: all levels and the scores are made from it, so no text is split again.
    """
    names = ["doc_id", "learn", "sizes", "words", "hashes", "symbols"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_blocks(batches, 2):
            words, block = split_texts(part.column(2))
            # No word holds a space.
            packed = [block.sizes.astype(np.int64), b" ".join(words), block.hashes, block.symbols.astype(_kind(len(words) + 1))]
            cells = [pa.array([c if isinstance(c, bytes) else c.tobytes()], pa.binary()) for c in packed]
            yield pa.RecordBatch.from_arrays([_one_row(part.column(0)), _one_row(part.column(1)), *cells], names=names)
        give_back()

    learn = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), learn.alias("learn"), F.col("text").cast("string"))
    kind = "doc_id array<long>, learn array<boolean>, sizes binary, words binary, hashes binary, symbols binary"
    return settle(rows.mapInArrow(split, kind), "tokens", "zstd", wide=True)


def _kind(numbers: int) -> type:
    return np.uint16 if numbers <= 1 << 16 else np.uint32


def _stored(batches: Iterator[pa.RecordBatch], learnt: bool) -> Iterator[tuple[dict, Block]]:
    """The rows of a table of ``tokens``, each with its block, with ``learnt`` of the texts to learn from only."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: batch.column(name)[at] for name in batch.schema.names}
            hashes = np.frombuffer(row["hashes"].as_buffer(), np.int64)
            symbols = np.frombuffer(row["symbols"].as_buffer(), _kind(len(hashes)))
            block = Block(hashes, symbols, np.frombuffer(row["sizes"].as_buffer(), np.int64))
            if learnt:
                block = block.only(row["learn"].values.to_numpy(zero_copy_only=False))
            if len(block.sizes):
                yield row, block


def symbol_counts(coded: DataFrame) -> DataFrame:
    """(symbol, n): how often each word and the end occur in the texts to learn from."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, held, waiting = 0, [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            if held:
                found = pa.concat_tables(held).group_by("symbol").aggregate([("n", "sum")])
                yield from found.rename_columns({"n_sum": "n"}).select(["symbol", "n"]).to_batches()

        for row, block in _stored(batches, True):
            n = np.bincount(block.symbols, minlength=len(block.hashes))
            ends += int(n[-1])
            words = pa.array(row["words"].as_py().split(b" ") if len(n) > 1 else [], pa.binary())
            held.append(pa.table({"symbol": words, "n": n[:-1]}))
            waiting += len(words)
            if waiting > WORDS_HELD:
                yield from rows()
                held, waiting = [], 0
        held.append(pa.table({"symbol": pa.array([END], pa.binary()), "n": np.array([ends])}))
        yield from rows()
        give_back()

    parts = coded.select("learn", "sizes", "words", "hashes", "symbols").mapInArrow(counted, "symbol binary, n long")
    return parts.groupBy("symbol").agg(F.sum("n").alias("n")).filter("n > 0")


class KeyMap:
    """A bit map of key hashes: never false for a key it has, seldom true for one it has not.

    A key has one word of the map and there up to ``KEY_BITS`` bits, one only where the map has grown tight.
    """

    def __init__(self, keys: DataFrame):
        many = keys.count()
        self.words = min(MAP_WORDS, 1 << max(6, (many // 4).bit_length()))
        self.shift = self.words.bit_length() - 1
        self.fields = [self.shift + 6 * i for i in range(KEY_BITS if many <= 16 * self.words else 1)]
        bits = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(key, {at}) & 63 as int))" for at in self.fields)
        word = F.expr(f"key & {self.words - 1}").alias("word")
        rows = keys.groupBy(word).agg(F.expr(f"bit_or({bits})").alias("bits")).toArrow()
        self.bits = np.zeros(self.words, np.uint64)
        self.bits[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        k = keys.view(np.uint64)
        word, every = self.bits[k & np.uint64(self.words - 1)], np.uint64(1)
        for at in self.fields:
            every = every & (word >> ((k >> np.uint64(at)) & np.uint64(63)))
        return np.broadcast_to(every, k.shape).astype(bool)


def _find(ordered: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``keys`` in an array in order, and whether they are there."""
    if not len(ordered):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)
    return at, ordered[at] == keys


@dataclass
class Model:
    """A learnt tree: ``entries`` (key, n, weight) has every word's count and every weight, and stays with Spark.

    The tasks get the most frequent words (key, n, weight) and grams (key, weight) in order of their keys, and which keys of
    grams may have a weight.
    """

    total: int
    distinct: int
    lengths: int
    known: KeyMap
    words: tuple[np.ndarray, np.ndarray, np.ndarray]
    grams: tuple[np.ndarray, np.ndarray]
    entries: DataFrame | None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"entries": None}

    def log_root(self, n: np.ndarray | int) -> np.ndarray:
        return np.log10((n + 1) / (self.total + self.distinct + 1))


def _turned(hashes: np.ndarray) -> np.ndarray:
    h = hashes.view(np.uint64)
    return ((h << np.uint64(TURN)) | (h >> np.uint64(64 - TURN))).view(np.int64)


def _turned_column(key: Column) -> Column:
    return F.shiftleft(key, TURN).bitwiseOR(F.shiftrightunsigned(key, 64 - TURN))


def _candidates(block: Block, length: int, known: KeyMap) -> tuple[np.ndarray, np.ndarray]:
    """Keys and prefixes of the grams of a length that begin and end with frequent ones, as a frequent gram does."""
    *_, (whole, ends, there) = block.grams(length)
    often = known.has(block.hashes)[block.symbols] if length == 2 else known.has(ends)
    often[1:] &= often[:-1].copy()
    places = np.flatnonzero(there & often)
    return whole[places], ends[places - 1]


class HashParts:
    """The parts of hashes (upper bits) that occur ``LEAST`` times in a corpus: each gram that does has such a part."""

    def __init__(self, coded: DataFrame, length: int, known: KeyMap, total: int):
        self.bits = min((MAP_WORDS * 64).bit_length() - 1, max(14, total.bit_length()))
        width = (1 << self.bits) // SLICES
        shared, shift = coded.sparkSession.sparkContext.broadcast(known), np.uint64(64 - self.bits)

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, waiting = [], 0

            def rows() -> pa.RecordBatch:
                found, n = np.unique(np.concatenate(held), return_counts=True)
                cut = np.searchsorted(found, np.arange(SLICES + 1) * width)
                steps, often = [], np.minimum(n, LEAST).astype(np.uint8)
                for k in range(SLICES):
                    own = found[cut[k] : cut[k + 1]].astype(np.int64) - k * width
                    # Steps from one part to the next, lowest bytes first: most bytes are zero, which the shuffle compresses.
                    steps.append(np.diff(own, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())
                counts = [often[cut[k] : cut[k + 1]].tobytes() for k in range(SLICES)]
                made = [pa.array(np.arange(SLICES, dtype=np.int32)), pa.array(steps, pa.binary()), pa.array(counts, pa.binary())]
                return pa.RecordBatch.from_arrays(made, names=["slice", "steps", "counts"])

            for _, block in _stored(batches, True):
                keys, _ = _candidates(block, length, shared.value)
                held.append((keys.view(np.uint64) >> shift).astype(np.uint32))
                waiting += len(keys)
                if waiting >= PARTS_HELD:
                    yield rows()
                    held, waiting = [], 0
            if held:
                yield rows()
            give_back()

        def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, sums = None, np.zeros(width, np.uint32)

            def row() -> pa.RecordBatch:
                bits = np.packbits(sums >= LEAST, bitorder="little").tobytes()
                return pa.RecordBatch.from_arrays([pa.array([own], pa.int32()), pa.array([bits], pa.binary())], names=["slice", "bits"])

            for batch in batches:
                for number, steps, counts in zip(*(c.to_pylist() for c in batch.columns)):
                    if own is not None and number != own:
                        yield row()
                        sums[:] = 0
                    own = number
                    at = np.frombuffer(steps, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
                    sums[np.cumsum(at)] += np.frombuffer(counts, np.uint8)
            if own is not None:
                yield row()
            give_back()

        rows = coded.select("learn", "sizes", "hashes", "symbols").mapInArrow(counted, "slice int, steps binary, counts binary")
        dealt = rows.repartition(SLICES, "slice").sortWithinPartitions("slice")
        found = dealt.mapInArrow(met, "slice int, bits binary").toArrow()
        self.map = np.zeros((1 << self.bits) // 8, np.uint8)
        for number, bits in zip(found["slice"].to_pylist(), found["bits"].to_pylist()):
            self.map[number * width // 8 : (number + 1) * width // 8] = np.frombuffer(bits, np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        part = keys.view(np.uint64) >> np.uint64(64 - self.bits)
        return (self.map[part >> np.uint64(3)] >> (part & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _counted_grams(keys: list[np.ndarray], prefixes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(key, prefix, n) of grams, of which each distinct one makes one row; the lists are emptied.

    One range of prefixes after the other, as sorting all grams at once would take several times what they take themselves.
    Rows of one prefix are together, which the shuffle's compression makes use of.
    """
    key, prefix = (np.concatenate([np.zeros(0, np.int64), *parts]) for parts in (keys, prefixes))
    keys.clear()
    prefixes.clear()
    own = (prefix.view(np.uint64) >> np.uint64(64 - RANGE_BITS)).astype(np.uint8)
    for number in range(1 << RANGE_BITS):
        places = np.flatnonzero(own == number)
        if not len(places):
            continue
        found, at, n = np.unique(key[places], return_index=True, return_counts=True)
        before = prefix[places[at]]
        order = np.argsort(before, kind="stable")
        columns = [found[order], before[order], n[order]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "prefix", "n"])


def _gram_table(coded: DataFrame, shorter: DataFrame, length: int, total: int) -> DataFrame:
    """(key, prefix, n) of the grams of a length that occur often enough; ``shorter`` has those one word shorter."""
    often = KeyMap(shorter.select("key"))
    parts = HashParts(coded, length, often, total) if length < 4 else None
    shared = coded.sparkSession.sparkContext.broadcast((often, parts))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parts = shared.value
        keys, prefixes, waiting = [], [], 0
        for _, block in _stored(batches, True):
            whole, before = _candidates(block, length, known)
            if parts is not None:
                there = parts.has(whole)
                whole, before = whole[there], before[there]
            keys.append(whole)
            prefixes.append(before)
            waiting += len(whole)
            if waiting >= GRAMS_HELD:
                yield from _counted_grams(keys, prefixes)
                waiting = 0
        yield from _counted_grams(keys, prefixes)
        give_back()

    rows = coded.select("learn", "sizes", "hashes", "symbols").mapInArrow(counted, "key long, prefix long, n long")
    summed = rows.groupBy("key", "prefix").agg(F.sum("n").alias("n"))
    return settle(summed.filter(F.col("n") >= LEAST), "grams")


def _tree_weights(coded: DataFrame, counts: DataFrame, total: int, distinct: int, max_context: int) -> DataFrame:
    """(key, n, weight): the whole tree as one weight per gram.

    Where a gram is in the tree, so is all it ends with. Let ``best`` be the log-probability of a gram's last symbol after
    the longest state inside it. A gram after a state adds what its ``best`` differs from that of its suffix, and takes back
    the state's ``log_rest``, which the state itself adds wherever it occurs. So the weights of all grams of a text and
    the roots of its symbols sum to its score.
    """
    root = F.log10((F.col("n") + 1) / F.lit(float(total + distinct + 1)))
    above = counts.filter(F.col("n") >= LEAST).select(
        F.xxhash64("symbol").alias("key"), F.lit(0).cast("long").alias("suffix"), "n", root.alias("best")
    )
    above = settle(above, "level")
    weights = []
    for length in range(2, max_context + 2):
        heavy = F.col("n") * HEAVY >= total
        heavies = F.broadcast(above.filter(heavy).select(F.col("key").alias("prefix"), F.lit(SALTS).alias("salts")))
        grams = _gram_table(coded, above, length, total).join(heavies, "prefix", "left")
        grams = grams.withColumn("salt", F.pmod(F.xxhash64("key"), F.coalesce("salts", F.lit(1))).cast("int"))
        contexts = above.select(
            F.col("key").alias("prefix"), F.col("n").alias("size"), F.col("suffix").alias("rest_of"),
            F.explode(F.sequence(F.lit(0), F.when(heavy, SALTS - 1).otherwise(0))).alias("salt"),
        )
        symbol = F.col("key").bitwiseXOR(_turned_column(F.col("prefix")))
        grams = grams.join(contexts, ["prefix", "salt"]).select(
            "key", "prefix", "n", "size", _turned_column(F.col("rest_of")).bitwiseXOR(symbol).alias("suffix")
        )
        without = above.select(F.col("key").alias("suffix"), F.col("best").alias("shorter"))
        own = (F.col("n") - DISCOUNT) / F.col("size")
        grams = settle(grams.join(without, "suffix").withColumn("own", own), "met")
        shorter = F.pow(F.lit(10.0), F.col("shorter"))
        sums = grams.groupBy("prefix").agg(
            F.max("size").alias("size"),
            F.count("*").alias("symbols"),
            F.greatest(1 - F.sum("own"), F.lit(1e-12)).alias("rest"),
            F.greatest(1 - F.sum(shorter), F.lit(1e-12)).alias("shorter_rest"),
            F.sum(F.col("own") * F.log(F.col("own") / shorter)).alias("divergence"),
        )
        ratio = F.col("rest") / F.col("shorter_rest")
        cost = 0.5 * (F.col("symbols") + 1) * F.log("size")
        kept = sums.filter(F.col("size") * (F.col("divergence") + F.col("rest") * F.log(ratio)) > cost)
        states = settle(kept.select("prefix", "size", F.log10(ratio).alias("log_rest")), "states")
        joined = grams.join(states.select("prefix", "log_rest"), "prefix", "left")
        best = F.when(F.col("log_rest").isNotNull(), F.log10("own")).otherwise(F.col("shorter"))
        added = F.coalesce(F.log10("own") - F.col("shorter") - F.col("log_rest"), F.lit(0.0))
        above = settle(joined.select("key", "suffix", "n", best.alias("best"), added.alias("weight")), "level")
        release(coded.sparkSession)
        weights += [above.select("key", "n", "weight"), states.select(F.col("prefix").alias("key"), F.col("size").alias("n"), F.col("log_rest").alias("weight"))]
    every = weights[0]
    for part in weights[1:]:
        every = every.unionAll(part)
    every = every.groupBy("key").agg(F.max("n").alias("n"), F.sum("weight").alias("weight"))
    return settle(every.filter(F.col("weight") != 0), "weights")


def _least_common(counts: DataFrame, most: int) -> int:
    """A count that at most ``most`` rows reach: a power of two, then refined in sixteenths."""

    def reached(bounds: list[int]) -> list[int]:
        return list(counts.agg(*[F.count_if(F.col("n") >= b).alias(f"b{i}") for i, b in enumerate(bounds)]).first())

    powers = [2**i for i in range(63)]
    high = next(b for b, n in zip(powers, reached(powers)) if n <= most)
    steps = sorted({max(1, high * k // 16) for k in range(8, 17)})
    return next(b for b, n in zip(steps, reached(steps)) if n <= most)


def grow(coded: DataFrame, max_context: int = MAX_CONTEXT) -> Model:
    """The tree learnt from a table of ``tokens``."""
    with batch_bytes(coded.sparkSession, BATCH_BYTES):
        return _grown(coded, max_context)


def _grown(coded: DataFrame, max_context: int) -> Model:
    counts = settle(symbol_counts(coded), "symbols")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct")).first()
    total, distinct = sums["total"], sums["distinct"]
    weights = _tree_weights(coded, counts, total, distinct, max_context)
    # A word may have a weight too, as a state. ``seen`` is how often an entry occurs, ``n`` a word's count, 0 for longer grams.
    words = counts.select(F.xxhash64("symbol").alias("key"), F.col("n").alias("seen"), "n", F.lit(0.0).alias("weight"))
    grams = weights.select("key", F.col("n").alias("seen"), F.lit(0).cast("long").alias("n"), "weight")
    entries = words.unionAll(grams).groupBy("key").agg(F.max("seen").alias("seen"), F.max("n").alias("n"), F.sum("weight").alias("weight"))
    entries = settle(entries, "entries")
    common = []
    for chosen, most, columns in (("n > 0", COMMON_WORDS, ("key", "n", "weight")), ("n = 0", COMMON_GRAMS, ("key", "weight"))):
        own = entries.filter(chosen)
        bound = _least_common(own.select(F.col("seen").alias("n")), most)
        rows = own.filter(F.col("seen") >= bound).select(*columns).toArrow().sort_by("key")
        common.append(tuple(rows[c].to_numpy() for c in columns))
    model = Model(total, distinct, max_context + 1, KeyMap(weights.select("key")), *common, entries)
    discard(counts, weights)
    release(coded.sparkSession)
    return model


_ASKED = "block long, doc_id array<long>, n_tokens array<long>, n_known array<long>, base array<double>, score array<double>, " \
    "keys array<long>, words int, per_doc binary, place binary, times binary"


def _asked(model: Model, block: Block) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, int]:
    """Per text the known words, base and score by the common entries; and what is left to ask for.

    That is: for each text the number of keys, and for each of those, text by text, the key's place and how often it occurs;
    then the distinct keys, and how many of them are words, which come first.
    """
    many = len(block.starts)
    texts = np.repeat(np.arange(many), block.sizes)
    word_keys, word_n, word_weight = model.words
    gram_keys, gram_weight = model.grams
    at, is_word = _find(word_keys, block.hashes)
    root, own = np.zeros(len(at)), np.zeros(len(at))
    root[is_word], own[is_word] = model.log_root(word_n[at[is_word]]), word_weight[at[is_word]]
    known = is_word[block.symbols]
    base = np.bincount(texts, root[block.symbols], many)
    score = base + np.bincount(texts, own[block.symbols], many)
    # A word that is looked up brings its weight along.
    rare = np.flatnonzero(~known)
    asked, of = [block.hashes[block.symbols[rare]]], [texts[rare]]
    for found, _, there in block.grams(model.lengths):
        places = np.flatnonzero(there & model.known.has(found))
        spot, hit = _find(gram_keys, found[places])
        score += np.bincount(texts[places[hit]], gram_weight[spot[hit]], many)
        left = places[~hit]
        asked.append(found[left])
        of.append(texts[left])
    word, at_word = np.unique(asked[0], return_inverse=True)
    gram, at_gram = np.unique(np.concatenate([np.zeros(0, np.int64), *asked[1:]]), return_inverse=True)
    width = max(1, len(word) + len(gram))
    pair, times = np.unique(np.concatenate(of) * width + np.concatenate([at_word, at_gram + len(word)]), return_counts=True)
    sums = [np.bincount(texts, known, many).astype(np.int64), base, score]
    parts = [np.bincount(pair // width, minlength=many), pair % width, times]
    return sums, [p.astype(np.uint32) for p in parts], np.concatenate([word, gram]), len(word)


def scores(coded: DataFrame, model: Model, last: bool = False) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every text of a table of ``tokens``, which goes if this is its ``last`` use."""
    with batch_bytes(coded.sparkSession, BATCH_BYTES):
        return _scored(coded, model, last)


def _scored(coded: DataFrame, model: Model, last: bool) -> DataFrame:
    shared = coded.sparkSession.sparkContext.broadcast(model)
    names = [part.split(" ")[0] for part in _ASKED.split(", ")]

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for row, block in _stored(batches, False):
            sums, parts, keys, words = _asked(shared.value, block)
            lists = [_one_row(c) for c in (row["doc_id"].values, block.sizes, *sums, keys)]
            packed = [pa.array([p.tobytes()], pa.binary()) for p in parts]
            first, count = pa.array([number], pa.int64()), pa.array([words], pa.int32())
            yield pa.RecordBatch.from_arrays([first, *lists, count, *packed], names=names)
            number += 1
        give_back()

    seen = settle(coded.select("doc_id", "sizes", "hashes", "symbols").mapInArrow(asked, _ASKED), "asked", "zstd", wide=True)
    if last:
        discard(coded)
    release(coded.sparkSession)
    made = _answers(seen, model)
    discard(seen)
    release(coded.sparkSession)
    return made


def _answers(seen: DataFrame, model: Model) -> DataFrame:
    """The scores, written, of blocks that ask for the rows of ``seen``."""
    answer = ("met", "met_n", "met_weight")
    model_total = model.total + model.distinct + 1

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at] for n in batch.schema.names}
                lists = {n: row[n].values for n in ("doc_id", "n_tokens", "n_known", "base", "score", *answer)}
                per_doc, place, times = (np.frombuffer(row[n].as_buffer(), np.uint32) for n in ("per_doc", "place", "times"))
                n, weight = np.zeros(row["many"].as_py(), np.int64), np.zeros(row["many"].as_py())
                if lists["met"] is not None:
                    spot = lists["met"].to_numpy()
                    n[spot], weight[spot] = lists["met_n"].to_numpy(), lists["met_weight"].to_numpy()
                many, words = len(per_doc), row["words"].as_py()
                root, known = np.zeros(len(n)), np.zeros(len(n))
                root[:words], known[:words] = np.log10((n[:words] + 1) / model_total), n[:words] > 0
                doc = np.repeat(np.arange(many), per_doc)
                more = [np.bincount(doc, times * x[place], many) for x in (known, root, root + weight)]
                yield pa.RecordBatch.from_arrays(
                    [
                        lists["doc_id"],
                        lists["n_tokens"],
                        pa.array(lists["n_known"].to_numpy() + more[0].astype(np.int64)),
                        pa.array(lists["base"].to_numpy() + more[1]),
                        pa.array(lists["score"].to_numpy() + more[2]),
                    ],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    # A block asks once for a key, whatever its texts hold of it, and is answered by the key's place.
    wanted = seen.select("block", F.posexplode("keys").alias("place", "key")).join(model.entries.select("key", "n", "weight"), "key")
    # Lists of one aggregate have the same order, as no value is null; a struct a row would take twice the bytes.
    met = wanted.groupBy("block").agg(*[F.collect_list(c).alias(name) for c, name in zip(("place", "n", "weight"), answer)])
    out = seen.withColumn("many", F.size("keys")).drop("keys").join(met, "block", "left")
    made = out.mapInArrow(answered, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    # Written here, as the size of a batch is set only while a step runs.
    return settle(made, "scores")


@query()
def op6_suffix_tree(spark, sf_dir: str) -> DataFrame:
    """The probability of every text, learnt from six sevenths of them."""
    docs = table(spark, sf_dir, "documents")
    fold = id_fold("doc_id", FOLDS)
    coded = tokens(docs, fold != HELD_OUT)
    model = grow(coded)
    return scores(coded, model, last=True).withColumns(
        {"held_out": F.coalesce(fold == HELD_OUT, F.lit(False)), "train_tokens": F.lit(model.total).cast("long")}
    )
