"""Benchmark decontamination with suffix arrays of the training text.

A shard is some hundred documents of one task, as word numbers one after the other. Its suffix array lists the places of the shard in
the order of the words that follow. Every suffix of the benchmark is looked up in it by binary search:

1. Words get numbers from the benchmark's vocabulary; a word that no item has gets none. A place takes part only if a run
   of numbered words as long as the shortest window starts there, as no other can begin a match.
2. Places are sorted by the next ``WINDOW`` words, kept as fixed-width keys in byte order, so sorting and searching are
   comparisons of bytes.
3. Of each window of the benchmark, the binary search gives the range of places where it occurs, and of each benchmark suffix
   the neighbours in the order give the longest verbatim match and where it lies (``longest_matches``).
4. Words inside of an occurrence are hit, and the items whose windows occur are named. All of it happens where the document is
   read: no document is moved.

The benchmark goes to the tasks in parts of at most ``PART_WORDS`` words, each broadcast by itself; one with more words takes
one pass over the documents per part, and the passes' results are joined by document. An item longer than a part is cut into
parts that overlap by a window, so none is lost.

Defined cases: A-Z are lower-cased, words are runs of digits, letters and whatever lies beyond ASCII; an item of fewer than
``WINDOW`` words, but not none, is one window; a null text has no words; rows of the benchmark that share an item_id are one
item with the windows of all their texts; a null item_id is an item too and written as nothing in lists; rows of documents
that share a doc_id, or have none, are judged by their own texts; an empty benchmark hits nothing. Columns of the documents are kept
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import in_parts, table
from millrace.llm.registry import query
from millrace.session import settle

WINDOW = 10
# Words of a shard, above which the next begins; a document is never divided.
SHARD_WORDS = 1 << 19
# Words of the benchmark that one pass takes.
PART_WORDS = 1 << 18
# Documents that are parsed together.
_ROWS = 16
# Occurrences that are looked at together.
_STEP = 1 << 20

_BREAKS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_FOLD = bytes.maketrans(
    _BREAKS + bytes(range(65, 91)), b" " * len(_BREAKS) + bytes(range(97, 123))
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def suffix_keys(numbers: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` word numbers from each place on, up to a zero, as byte strings in the same order.

    ``numbers`` end in ``width`` zeros.
    """
    wide = numbers.astype(">u4")
    rows = wide[places[:, None] + np.arange(width)]
    rows[np.logical_or.accumulate(rows == 0, axis=1)] = 0
    return np.ascontiguousarray(rows).view(f"S{4 * width}").ravel()


class Part:
    """Some items of the benchmark, as the tasks need them: vocabulary, windows, and which items have each window."""

    def __init__(self, items: list[tuple[str, int, list[bytes]]], window: int = WINDOW):
        """``items``: name, which of the item's words comes first, and the words."""
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.names = sorted({name for name, _, _ in items})
        number = {name: n for n, name in enumerate(self.names)}
        tokens: list[int] = []
        item, start, left = [], [], []
        for name, first, words in items:
            for k, word in enumerate(words):
                tokens.append(self.vocabulary.setdefault(word, len(self.vocabulary) + 1))
                item.append(number[name])
                start.append(first + k)
                left.append(len(words) - k)
            tokens.append(0)
            item.append(-1)
            start.append(0)
            left.append(0)
        self.tokens = np.array(tokens + [0] * window, np.uint32)
        self.item, self.start, self.left = (np.array(x, np.int64) for x in (item, start, left))
        self.places = np.flatnonzero(self.left > 0)
        # A window starts where a whole one fits, or at the first word of a shorter item.
        whole = (self.left >= window) | ((self.start == 0) & (self.left > 0))
        at = np.flatnonzero(whole)
        size = np.minimum(self.left[at], window)
        keys = suffix_keys(self.tokens, at, window)
        self.least = int(size.min()) if len(size) else 0
        # Equal windows are looked up once. A short item's key ends in zeros, so it differs from any longer one.
        self.keys, first, group = np.unique(keys, return_index=True, return_inverse=True)
        self.sizes = size[first]
        pairs = np.unique(np.stack([group, self.item[at]]), axis=1) if len(at) else np.zeros((2, 0), np.int64)
        self.items_of = np.split(pairs[1], np.flatnonzero(np.diff(pairs[0])) + 1) if len(at) else []
        # The search ends of a window: itself, and itself followed by the largest number.
        upper = self.keys.view(">u4").reshape(-1, window).copy() if len(at) else np.zeros((0, window), ">u4")
        upper[np.arange(window) >= self.sizes[:, None]] = np.iinfo(np.uint32).max
        self.ends = np.ascontiguousarray(upper).view(f"S{4 * window}").ravel()


class Shard:
    """The words of some documents in a part's numbers, and the suffix array of the places that can begin a match."""

    def __init__(self, texts: list[np.ndarray], part: Part):
        window = part.window
        self.lengths = np.array([len(t) for t in texts], np.int64)
        # A zero parts the documents.
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + 1)[:-1]]).astype(np.int64)
        total = int((self.lengths + 1).sum())
        self.tokens = np.zeros(total + window, np.uint32)
        for at, numbers in zip(self.starts.tolist(), texts):
            self.tokens[at : at + len(numbers)] = numbers
        here = np.arange(total + window)
        gaps = np.where(self.tokens == 0, here, total + window)
        run = np.minimum.accumulate(gaps[::-1])[::-1] - here
        places = np.flatnonzero(run >= max(part.least, 1)) if part.least else np.zeros(0, np.int64)
        keys = suffix_keys(self.tokens, places, window)
        order = np.argsort(keys, kind="stable")
        self.array, self.keys = places[order], keys[order]

    @staticmethod
    def numbers(text: str | None, part: Part) -> np.ndarray:
        """A text's words as numbers of the part; a word that no item has is 0."""
        words = words_of(text)
        return np.fromiter(map(part.vocabulary.get, words, repeat(0)), np.uint32, len(words))

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1

    def ranges(self, part: Part) -> tuple[np.ndarray, np.ndarray]:
        """For each window of the part, from where to where it stands in the suffix array."""
        return np.searchsorted(self.keys, part.keys, "left"), np.searchsorted(self.keys, part.ends, "right")

    def occurrences(self, part: Part) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, place) of every occurrence, some at a time."""
        low, high = self.ranges(part)
        many = high - low
        found = np.flatnonzero(many)
        at = np.concatenate([[0], np.cumsum(many[found])])
        for a in range(0, int(at[-1]), _STEP):
            n = np.arange(a, min(a + _STEP, int(at[-1])))
            k = np.searchsorted(at, n, "right") - 1
            yield found[k], self.array[low[found[k]] + n - at[k]]

    def hits(self, part: Part) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Of each document the spans of hit words (rows of start and end) and the items, None where there are none."""
        size = len(self.tokens) + 1
        marks, pairs = np.zeros(size, np.int64), []
        for window, place in self.occurrences(part):
            marks += np.bincount(place, minlength=size) - np.bincount(place + part.sizes[window], minlength=size)
            pairs.append(np.unique(self.document(place) * len(part.keys) + window))
        out: list = [None] * len(self.lengths)
        if not pairs:
            return out
        doc, window = np.divmod(np.unique(np.concatenate(pairs)), len(part.keys))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(marks) > 0).view(np.int8), [0]])))
        spans = edges.reshape(-1, 2)
        of_span = self.document(spans[:, 0])
        known: dict[bytes, np.ndarray] = {}
        cut = np.flatnonzero(np.diff(doc)) + 1
        for d, windows in zip(doc[np.concatenate([[0], cut])].tolist(), np.split(window, cut)):
            # Copies have the same windows, so their items are put together once.
            items = known.get(windows.tobytes())
            if items is None:
                items = np.unique(np.concatenate([part.items_of[w] for w in windows]))
                known[windows.tobytes()] = items
            a, b = np.searchsorted(of_span, [d, d + 1])
            out[d] = spans[a:b] - self.starts[d], items
        return out

    def longest(self, part: Part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the part, length, place in the shard) of each benchmark suffix with a match of a shortest window or more."""
        if not len(self.array):
            return (np.zeros(0, np.int64),) * 3
        found = np.searchsorted(self.keys, suffix_keys(part.tokens, part.places, part.window), "left")
        best, where = np.zeros(len(part.places), np.int64), np.zeros(len(part.places), np.int64)
        for side in (found - 1, found):
            near = self.array[np.clip(side, 0, len(self.array) - 1)]
            length = self._common(part, part.places, near)
            # Past a window's length the order says nothing: all places with the same window are compared.
            better = length > best
            best[better], where[better] = length[better], near[better]
        full = np.flatnonzero(best >= part.window)
        if len(full):
            keys = suffix_keys(part.tokens, part.places[full], part.window)
            low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
            for k, a, b in zip(full.tolist(), low.tolist(), high.tolist()):
                for c in range(a, b, _STEP):
                    places = self.array[c : min(b, c + _STEP)]
                    length = self._common(part, np.full(len(places), part.places[k]), places)
                    top = int(length.argmax())
                    if length[top] > best[k]:
                        best[k], where[k] = length[top], places[top]
        enough = np.flatnonzero(best >= part.least)
        return part.places[enough], best[enough], where[enough]

    def _common(self, part: Part, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many words two suffixes share from their first on."""
        out, alive = np.zeros(len(one), np.int64), np.arange(len(one))
        while len(alive):
            a = part.tokens[one[alive] + out[alive]]
            alive = alive[(a != 0) & (a == self.tokens[two[alive] + out[alive]])]
            out[alive] += 1
        return out


def parts_of(benchmark: DataFrame, window: int = WINDOW, part_words: int = PART_WORDS) -> Iterator[Part]:
    """The benchmark in parts of at most ``part_words`` words (and one window more); items come to the driver a part at a time."""
    held, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    for name, text in rows.toLocalIterator():
        words = words_of(text)
        step = max(part_words, window)
        for at in range(0, max(1, len(words) - window + 1), step):
            piece = words[at : at + step + window - 1]
            if held and size + len(piece) > part_words:
                yield Part(held, window)
                held, size = [], 0
            held.append((name or "", at, piece))
            size += len(piece)
    yield Part(held, window)


def _shards(batches: Iterator[pa.RecordBatch], column: int, part: Part, shard_words: int) -> Iterator[tuple[list, Shard]]:
    """The rows in groups of about ``shard_words`` words, each with its suffix array."""
    held, texts, size = [], [], 0
    for batch in in_parts(batches, _ROWS):
        held.append(batch)
        for text in batch.column(column):
            texts.append(Shard.numbers(text.as_py(), part))
            size += len(texts[-1])
        if size >= shard_words:
            yield held, Shard(texts, part)
            held, texts, size = [], [], 0
    if held:
        yield held, Shard(texts, part)


HITS = "struct<n_words: bigint, spans: array<struct<start: bigint, stop: bigint>>, items: array<string>>"
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])


def scan(docs: DataFrame, part: Part, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with a struct ``__hits``: n_words, the spans of words hit (start, stop) and the items that hit them, in order."""
    shared = docs.sparkSession.sparkContext.broadcast(part)
    # Read by its place, so a column of any name may be there already.
    extra = "_" * (1 + max(map(len, docs.columns)))
    named = docs.withColumn(extra, F.col("text").cast("string"))
    at = len(docs.columns)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = shared.value
        for held, shard in _shards(batches, at, part, shard_words):
            found, row = shard.hits(part), 0
            for batch in held:
                spans, items = [], []
                for hit in found[row : row + batch.num_rows]:
                    spans.append([] if hit is None else [{"start": a, "stop": b} for a, b in hit[0].tolist()])
                    items.append([] if hit is None else [part.names[n] for n in hit[1]])
                lengths = pa.array(shard.lengths[row : row + batch.num_rows])
                made = [lengths, pa.array(spans, pa.list_(_SPAN)), pa.array(items, pa.list_(pa.string()))]
                hits = pa.StructArray.from_arrays(made, ["n_words", "spans", "items"])
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], hits], names=[*batch.schema.names[:at], "__hits"])
                row += batch.num_rows

    kind = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return named.mapInArrow(judge, f"{kind}, __hits {HITS}")


def joined_spans(spans: Column) -> Column:
    """Overlapping and adjoining spans of an array as one each, in order."""

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(grown))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] >= span["start"]), longer).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), F.slice(spans, 1, 0), add)


def with_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_words: int = PART_WORDS, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """``docs`` with the struct ``__hits`` of the whole benchmark, one row per row."""
    parts = parts_of(benchmark, window, part_words)
    out = scan(docs, next(parts), shard_words)
    keys = [F.col("doc_id").cast("string").alias("__id"), F.xxhash64("text").alias("__one"), F.crc32("text").alias("__two")]
    more = None
    for part in parts:
        # Written before the next part is sent; rows of equal texts and ids find the same.
        found = scan(docs.select("doc_id", "text"), part, shard_words).filter("size(__hits.items) > 0")
        found = settle(found.select(*keys, "__hits.spans", "__hits.items"), "part")
        more = found if more is None else more.unionByName(found)
    if more is None:
        return out
    named = [F.col("__id"), F.col("__one"), F.col("__two")]
    met = more.groupBy(*named).agg(
        F.flatten(F.collect_set("spans")).alias("__spans"), F.flatten(F.collect_set("items")).alias("__items")
    )
    met = met.select(*(c.alias(f"{n}_r") for c, n in zip(named, ("__id", "__one", "__two"))), "__spans", "__items")
    with_keys = out.select("*", *keys)
    same = [F.col(n).eqNullSafe(F.col(f"{n}_r")) for n in ("__id", "__one", "__two")]
    own = F.col("__hits")
    none = [F.slice(own["spans"], 1, 0), F.slice(own["items"], 1, 0)]
    hits = F.struct(
        own["n_words"].alias("n_words"),
        joined_spans(F.concat(own["spans"], F.coalesce("__spans", none[0]))).alias("spans"),
        F.array_sort(F.array_distinct(F.concat(own["items"], F.coalesce("__items", none[1])))).alias("items"),
    )
    return with_keys.join(met, same, "left").select(*docs.columns, hits.alias("__hits"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` no word of which is hit."""
    return with_hits(docs, benchmark, window).filter("size(__hits.items) = 0").drop("__hits")


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_words: int = PART_WORDS, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """(item_id, item_start, length, doc_id, doc_start): of every benchmark suffix the longest verbatim match and where it lies.

    Matches count from the shortest window of the suffix's part on, in words; of equally long ones the first by doc_id and
    place. Each task and each shard leaves at most one row per suffix.
    """
    found = None
    for part in parts_of(benchmark, window, part_words):
        shared = docs.sparkSession.sparkContext.broadcast(part)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            part = shared.value
            for held, shard in _shards(batches, 1, part, shard_words):
                ids = pa.concat_arrays([b.column(0) for b in held])
                at, length, where = shard.longest(part)
                doc = shard.document(where)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.names[n] for n in part.item[at]], pa.string()),
                        pa.array(part.start[at]),
                        pa.array(length),
                        ids.take(pa.array(doc)),
                        pa.array(where - shard.starts[doc]),
                    ],
                    names=["item_id", "item_start", "length", "doc_id", "doc_start"],
                )

        rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        kind = "item_id string, item_start long, length long, doc_id long, doc_start long"
        one = rows.mapInArrow(search, kind)
        found = one if found is None else found.unionByName(one)
    best = F.min(F.struct((-F.col("length")).alias("less"), "doc_id", "doc_start")).alias("best")
    return found.groupBy("item_id", "item_start").agg(best).select(
        "item_id", "item_start", (-F.col("best.less")).alias("length"), "best.doc_id", "best.doc_start"
    )


_SQL_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

HITS_SQL = f"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_SQL_WORDS} AS words FROM benchmark WHERE text IS NOT NULL
),
windows AS (
  SELECT DISTINCT item, least({WINDOW}, len(words)) AS size, array_to_string(words[i : i + {WINDOW - 1}], ' ') AS gram
  FROM (SELECT *, unnest(range(1, greatest(1, len(words) - {WINDOW - 1}) + 1)) AS i FROM items WHERE len(words) > 0)
),
docs AS (SELECT row_number() OVER () AS line, doc_id, coalesce({_SQL_WORDS}, []) AS words FROM documents),
grams AS (
  SELECT line, size, i, array_to_string(words[i : i + size - 1], ' ') AS gram
  FROM (SELECT line, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM windows))
),
found AS (SELECT line, i, size, item FROM grams JOIN windows USING (size, gram)),
hit AS (
  SELECT line, count(DISTINCT place) AS n_hit
  FROM (SELECT line, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT line, i, size FROM found)) GROUP BY line
),
named AS (
  SELECT line, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT line, item FROM found) GROUP BY line
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (line) LEFT JOIN named USING (line)
"""


@query(HITS_SQL)
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document stands in the benchmark, and in which items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = with_hits(docs, table(spark, sf_dir, "benchmark")).drop("text")
    hit = F.aggregate("__hits.spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return judged.select(
        "doc_id",
        F.col("__hits.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("__hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__hits.items", ","), 256).alias("items_sha256"),
        (F.size("__hits.items") > 0).alias("contaminated"),
    )
