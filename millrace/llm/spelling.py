"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words are near if one code point inserted, deleted or replaced turns one into the other. With ``length`` the
longer one's length, that is so exactly if their common prefix and common suffix together reach ``length - 1``.

1. Runs of letters are counted in the tasks, so one row per distinct word of some hundred texts is moved.
2. A word of ``length`` is cut at ``cuts(length)`` into ``SEGMENTS`` parts. One edit lies in one part, so the
   words agree before that part, counted from the front, and after it, counted from the back. Each word is filed
   under what it shows outside of each part, for its own length and for that of words one longer; every near pair meets in
   the file of the part its common prefix ends in, and in that file alone it counts.
3. Files are laid side by side into tiles of some hundred words. A tile holds its words as padded matrices of code
   points, flush left and flush right; column by column, all pairs at once, the common prefixes and suffixes grow,
   and their sum tells the near pairs. A file above ``BLOCK`` words is dealt to pairs of blocks.
4. What leaves a tile is one row per word: how many are near it, and the best of them. No pair is written.

A word's form is its most frequent near word (ties: the first by code point) if that is ``FACTOR`` times as frequent. Forms of forms
are followed by doubling: each step is at least ``FACTOR`` times as frequent, so the largest count bounds the rounds.

Defined cases: only A-Z are lower-cased; a null text has no words; a null doc_id is written as nothing where ids
count (``slip``); repeated rows count each time; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import give_back, in_parts, table
from millrace.llm.minhash import in_block_pairs
from millrace.llm.registry import query
from millrace.session import settle

LETTERS = "a-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
SLIP = 31
FACTOR = 10
SEGMENTS = 3
BLOCK = 512
TILE = 256
# Columns of a padded matrix, so that very long words take no more memory.
STRIP = 256
# Distinct words a task counts before it hands them on.
HELD = 1 << 17


def word_counts(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip: int | None = None
) -> DataFrame:
    """(word, n): lower-cased runs of letters of at least ``least_length`` code points that occur ``least_count`` times.

    With ``slip``, a run whose crc32 of ``<doc_id>:<run>`` that number divides first loses the code point at
    crc32 modulo its length, everywhere in that document.
    """
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def rows_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in in_parts(batches):
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                found = Counter(runs.findall((text.as_py() or "").encode().lower().decode()))
                if slip is None:
                    counts.update(found)
                    continue
                start = zlib.crc32(f"{doc_id.as_py() or ''}:".encode())
                for word, n in found.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % slip == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    counts[word] += n
                if len(counts) > HELD:
                    yield rows_of(counts)
                    counts = Counter()
        yield rows_of(counts)

    rows = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def cuts(length: int, segments: int = SEGMENTS) -> list[int]:
    """Where the segments of a word of ``length`` end; none begins after the word."""
    return [length * k // segments for k in range(1, segments + 1)]


def filed(words: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """``words`` (word, n) once for each file: length, segment and ``file``, a hash of what the word shows there."""
    size = F.char_length("word")
    places = F.array(*[F.struct((size + more).alias("length"), F.lit(k).alias("segment")) for more in (0, 1) for k in range(segments)])
    out = words.select("word", "n", F.inline(places))

    def cut(k: int | Column) -> Column:
        return F.floor(F.col("length") * k / segments).cast("int")

    front = F.substring("word", F.lit(1), cut(F.col("segment")))
    tail = F.col("length") - cut(F.col("segment") + 1)
    back = F.substring("word", size - tail + 1, tail)
    return out.withColumn("file", F.xxhash64("length", "segment", front, F.lit("\x00"), back))


def padded(words: list[str], width: int, flush_right: bool = False) -> np.ndarray:
    """The words' code points, one row each, padded to ``width`` with what equals no code point."""
    lengths = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    seen, small = np.unique(flat, return_inverse=True)
    column = np.arange(width)
    out = np.full((len(words), width), len(seen), np.uint8 if len(seen) < 255 else np.uint32)
    out[column >= width - lengths[:, None] if flush_right else column < lengths[:, None]] = small
    return out


def agreement(words: list[str], length: int, flush_right: bool = False) -> np.ndarray:
    """For every pair of distinct words the length of their common prefix (or suffix, flush right)."""
    n = len(words)
    alive, out = ~np.eye(n, dtype=bool), np.zeros((n, n), np.uint16 if length < 1 << 16 else np.uint32)
    for at in range(0, length, STRIP):
        width = min(STRIP, length - at)
        if flush_right:
            codes = padded([w[max(0, len(w) - at - width) : max(0, len(w) - at)] for w in words], width, True)[:, ::-1]
        else:
            codes = padded([w[at : at + width] for w in words], width)
        for j in range(width):
            alive &= codes[:, j, None] == codes[None, :, j]
            out += alive
        if not alive.any():
            break
    return out


def near_in_tile(words: list[str], length: int, segment: int, segments: int = SEGMENTS) -> np.ndarray:
    """Which pairs of distinct words are near, have ``length`` as the longer length and belong to ``segment``'s file."""
    prefix, suffix = agreement(words, length), agreement(words, length, flush_right=True)
    ends = [0, *cuts(length, segments)]
    near = (prefix + suffix >= length - 1) & (prefix >= ends[segment]) & (prefix < ends[segment + 1])
    longest = np.array([len(w) == length for w in words])
    return near & (longest[:, None] | longest[None, :])


def tiles(batches: Iterator[pa.RecordBatch], tile: int = TILE) -> Iterator[tuple]:
    """Whole (length, segment, file, one, two) groups of sorted rows, laid side by side up to ``tile`` rows of one length and segment."""
    held: pa.Table | None = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        held = held.combine_chunks()
        heads = [held.column(k).to_numpy() for k in range(5)]
        change = np.zeros(held.num_rows - 1, bool) if held.num_rows else np.zeros(0, bool)
        for h in heads:
            change |= h[1:] != h[:-1]
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        yield from _cut_tiles(held, heads, starts, tile)
        held = held.slice(starts[-1])
    if held is not None and held.num_rows:
        heads = [held.column(k).to_numpy() for k in range(5)]
        yield from _cut_tiles(held, heads, np.array([0, held.num_rows]), tile)


def _cut_tiles(held: pa.Table, heads: list[np.ndarray], starts: np.ndarray, tile: int) -> Iterator[tuple]:
    """Tiles of the groups between ``starts``; the rows after the last start are left."""
    if len(starts) < 2:
        return
    kind = heads[0] * 64 + heads[1]
    group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    a = 0
    for g in range(1, len(starts)):
        last = g == len(starts) - 1
        if last or starts[g + 1] - starts[a] > tile or kind[starts[g]] != kind[starts[a]]:
            at, stop = int(starts[a]), int(starts[g])
            part = held.slice(at, stop - at)
            yield (
                int(heads[0][at]),
                int(heads[1][at]),
                group[at:stop],
                heads[3][at:stop] == heads[4][at:stop],
                part.column(5).to_numpy(),
                part.column(6).to_pylist(),
                part.column(7).to_numpy(),
            )
            a = g


def near_words(words: DataFrame, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, best): for each of the distinct ``words`` (word, n) how many are near it, and the most frequent one.

    ``best`` is a struct of ``least`` (its n, negated) and ``word``, null without near words.
    """
    words = settle(words.select("word", "n"), "words")
    # Both sides are dealt out from the settled words, so that a heavy file can be split.
    sizes = filed(words, segments).groupBy("file").agg(F.count("*").alias("members")).filter("members > 1")
    members = in_block_pairs(filed(words, segments).join(settle(sizes, "files"), "file"), "file", "members", "word", block)
    members = members.select("length", "segment", "file", "one", "two", "own_block", "word", "n")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, segment, group, within, own, texts, n in tiles(batches):
            near = near_in_tile(texts, length, segment, segments)
            near &= group[:, None] == group[None, :]
            near &= within[:, None] | (own[:, None] != own[None, :])
            has = np.flatnonzero(near.any(axis=1))
            if not len(has):
                continue
            # Places by frequency, then by code point, so the best near word is the one with the smallest place.
            order = sorted(range(len(texts)), key=lambda i: (-n[i], texts[i]))
            place = np.empty(len(texts), np.int64)
            place[order] = np.arange(len(texts))
            best = np.where(near[has], place[None, :], len(texts)).min(axis=1)
            chosen = [order[b] for b in best]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([texts[i] for i in has], pa.string()),
                    pa.array(near[has].sum(axis=1), pa.int64()),
                    pa.array([-int(n[c]) for c in chosen], pa.int64()),
                    pa.array([texts[c] for c in chosen], pa.string()),
                ],
                names=["word", "n_near", "least", "other"],
            )
        give_back()

    heads = ["length", "segment", "file", "one", "two"]
    dealt = members.repartition("file", "one", "two").sortWithinPartitions(*heads)
    met = dealt.mapInArrow(compared, "word string, n_near long, least long, other string")
    best = F.when(F.col("other").isNotNull(), F.struct("least", F.col("other").alias("word")))
    found = met.select("word", F.lit(None).cast("long").alias("n"), "n_near", best.alias("best"))
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast(found.schema["best"].dataType).alias("best"))
    # A word has one row of its own and one per tile it has near words in; they combine before they move.
    return alone.unionByName(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def variants(words: DataFrame, factor: int = FACTOR, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the distinct ``words`` (word, n)."""
    form = F.when(-F.col("best.least") >= factor * F.col("n"), F.col("best"))
    near = near_words(words, segments, block).withColumn("best", form)
    rows = near.select("word", "n", "n_near", F.col("best.word").alias("form"), (-F.col("best.least")).alias("form_n"))
    rows = settle(rows, "forms")
    most = rows.agg(F.max("n")).first()[0] or 1
    steps = int(math.log(max(most, 1), factor)) + 1
    reached = rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # After each round a word knows its ancestor twice as far away.
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        reached = settle(reached, "roots")
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reached = reached.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    out = rows.join(settle(reached, "roots"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SPELLING_SQL = f"""
WITH runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL
),
hashed AS (
  -- Each byte is followed by eight shifts: crc32 with its usual polynomial.
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                     ELSE [(192 + (unicode(c) >> 6))::BIGINT, (128 + (unicode(c) & 63))::BIGINT] END)),
      lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step)
                           WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END)) AS h
  FROM runs
),
slipped AS (
  SELECT CASE WHEN h % {SLIP} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
),
holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
pairs AS (
  SELECT x.word AS word, y.word AS other, y.n AS other_n
  FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.a || h.b = w.word
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.a || h.b = w.word
),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM pairs GROUP BY word
),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= {FACTOR} * w.n THEN other END AS form, CASE WHEN other_n >= {FACTOR} * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best ON w.word = best.word
),
followed AS (
  WITH RECURSIVE up AS (
    SELECT word, word AS at FROM forms
    UNION ALL SELECT up.word, f.form FROM up JOIN forms f ON up.at = f.word WHERE f.form IS NOT NULL
  )
  SELECT up.word, up.at AS root FROM up JOIN forms f ON up.at = f.word WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN followed USING (word)
"""


@query(SPELLING_SQL)
def op11_spelling(spark, sf_dir: str) -> DataFrame:
    """The frequent spelling near every repeated word of at least seven letters."""
    return variants(word_counts(table(spark, sf_dir, "documents"), slip=SLIP))
