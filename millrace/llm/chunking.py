"""Substring dedup by content-defined chunking.

A gear hash rolls over the bytes of a text; where it falls below a threshold at the end of a word (or
before a character of a script without spaces) a chunk ends. The hash sees the last ``WINDOW`` bytes only,
so the same passage is cut in the same places whatever precedes it, and an insertion changes the chunks
around it alone. Chunks are compared by a 64-bit digest. The first occurrence of a chunk, by doc_id and
place, stays; a run of later occurrences is removed when it has at least ``MIN_WORDS`` words, so that short
phrases which documents share by chance are left alone. A short chunk may also occur earlier by chance, so a run
is taken from the first to the last chunk whose first occurrence lies as far from it, in the same document, as that
of another chunk of the run; chunks beyond these two are left in place. In scripts written without spaces (Han, Kana,
Thai, Lao, Khmer, Burmese), ``SPACELESS_A_WORD`` characters count as a word.

Skew: every task resolves the repeats among the ``HELD`` records it looks at together and sends on one occurrence
per chunk, so a passage that a third of all documents share costs one record per so many. Records travel as packed
arrays by bucket of digests, in one shuffle; the texts move once, to meet what is to be removed.

Defined cases: a null text stays null and an empty text stays empty; a null doc_id comes after all others;
rows with the same doc_id and text count as one document and are cut alike; rows with the same doc_id and
different texts are different documents. A text that consists of repeats becomes empty. Columns of the
input keep their names and values, except for ``text``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORD, give_back, giving_back, in_parts, table, text_check
from millrace.llm.registry import query

MIN_WORDS = 25
SPACELESS_A_WORD = 2
SPACELESS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
# One word end in four ends a chunk; the hash has as many bits as bytes are seen.
WINDOW = 16
WORD_END = 2**WINDOW // 4
WIDE_START = 2**WINDOW // 16
# Records a task holds before it sends on what it has.
HELD = 2**18
NO_ID = np.iinfo(np.int64).max
GEAR = np.array([xxhash.xxh3_64_intdigest(bytes([b]), seed=WINDOW) % 2**WINDOW for b in range(256)], np.uint16)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

RECORD = np.dtype([("digest", "<u8"), ("doc", "<i8"), ("check", "<u4"), ("index", "<u4")])
REPEAT = np.dtype([("doc", "<i8"), ("check", "<u4"), ("index", "<u4"), ("first_doc", "<i8"), ("first_index", "<u4")])
REPEATS = "doc long, check long, index int, first_doc long, first_index int"


def cuts(raw: bytes) -> np.ndarray:
    """The places at which chunks end, the last one the length of the text."""
    b = np.frombuffer(raw, np.uint8)
    h = GEAR[b]
    span = 1
    while span < WINDOW:
        # The hash of 2n bytes from two of n bytes: the older one has moved n bits to the left.
        older = np.zeros_like(h)
        older[span:] = h[:-span] << span if len(h) > span else 0
        h = h + older
        span *= 2
    wide = np.append(b[1:] >= 0xE0, False)
    ends = np.flatnonzero((SPACE[b] & (h < WORD_END)) | (wide & (h < WIDE_START))) + 1
    return ends if len(ends) and ends[-1] == len(b) else np.append(ends, len(b))


def words_in(raw: bytes) -> int:
    """The words of a passage; characters of scripts without spaces count by number."""
    if raw.isascii():
        return len(raw.split())
    rest, spaceless = SPACELESS.subn(" ", raw.decode())
    return len(rest.encode().split()) + spaceless // SPACELESS_A_WORD


def digests(raw: bytes) -> np.ndarray:
    """One digest per chunk of a text."""
    if not raw:
        return np.zeros(0, np.uint64)
    ends = cuts(raw).tolist()
    return np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip([0, *ends], ends)], np.uint64)


def _chunk_records(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The records of one document after the other, in blocks of some ``HELD`` records."""
    parts, held = [], 0
    for batch in in_parts(batches):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = (text.as_py() or "").encode()
            found = digests(raw)
            part = np.empty(len(found), RECORD)
            part["digest"], part["index"] = found, np.arange(len(found))
            part["doc"], part["check"] = NO_ID if doc_id is None else doc_id, zlib.crc32(raw)
            parts.append(part)
            held += len(part)
            if held >= HELD:
                yield np.concatenate(parts)
                parts, held = [], 0
    if parts:
        yield np.concatenate(parts)


def _split_repeats(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first record of every digest, and the later ones with what they repeat."""
    if not len(records):
        return records, np.empty(0, REPEAT)
    records = records[np.lexsort((records["index"], records["check"], records["doc"], records["digest"]))]
    opens = np.append(True, records["digest"][1:] != records["digest"][:-1])
    first = records[opens]
    of = first[np.cumsum(opens) - 1][~opens]
    later = records[~opens]
    # Equal rows give equal records, and a chunk does not repeat itself.
    itself = (later["doc"] == of["doc"]) & (later["check"] == of["check"]) & (later["index"] == of["index"])
    later, of = later[~itself], of[~itself]
    repeats = np.empty(len(later), REPEAT)
    for name in ("doc", "check", "index"):
        repeats[name] = later[name]
    repeats["first_doc"], repeats["first_index"] = of["doc"], of["index"]
    return first, repeats


def _recurring(records: np.ndarray) -> np.ndarray:
    """The records whose digest another record has too: a small part of them, as a rule."""
    ordered = np.sort(records["digest"])
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    if not len(again):
        return records[:0]
    at = np.minimum(np.searchsorted(again, records["digest"]), len(again) - 1)
    return records[again[at] == records["digest"]]


def repeated_chunks(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row per chunk that occurs earlier in the table (doc and first_doc are ``NO_ID`` for null ids)."""
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = pa.schema([("bucket", pa.int32()), ("records", pa.binary()), ("repeats", pa.binary())])

    @giving_back
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array([(k << 64) // buckets for k in range(buckets)], np.uint64)
        for records in _chunk_records(batches):
            first, repeats = _split_repeats(records)
            # Sorted by digest, so the records of a bucket of digests lie together.
            places = [*np.searchsorted(first["digest"], bounds).tolist(), len(first)]
            share = np.linspace(0, len(repeats), buckets + 1).astype(int)
            rows = []
            for k in range(buckets):
                own = np.sort(first[places[k] : places[k + 1]], order=("doc", "index"))
                done = repeats[share[k] : share[k + 1]]
                if len(own) or len(done):
                    rows.append((k, own.tobytes(), done.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

    @giving_back
    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, repeats = [np.empty(0, RECORD)], []
        for batch in batches:
            records += [np.frombuffer(x.as_py(), RECORD) for x in batch.column(1)]
            repeats += [np.frombuffer(x.as_py(), REPEAT) for x in batch.column(2)]
        records = np.concatenate(records)
        batch = None
        repeats.append(_split_repeats(_recurring(records))[1])
        del records
        for part in repeats:
            if len(part):
                columns = [part["doc"], part["check"].astype("i8"), part["index"].astype("i4")]
                columns += [part["first_doc"], part["first_index"].astype("i4")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(c)) for c in columns],
                    names=["doc", "check", "index", "first_doc", "first_index"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sent = rows.mapInArrow(dealt, "bucket int, records binary, repeats binary")
    return sent.repartition(buckets, "bucket").mapInArrow(met, REPEATS)


def removable_spans(raw: bytes, repeats: dict[int, tuple[int, int]], min_words: int) -> list[tuple[int, int, int]]:
    """(start, end, first doc) in bytes of the runs to remove; ``repeats`` maps a chunk to its first place."""
    ends = [0, *cuts(raw).tolist()] if raw else [0]
    out, indices, at = [], sorted(repeats), 0
    while at < len(indices):
        stop = at + 1
        while stop < len(indices) and indices[stop] == indices[stop - 1] + 1:
            stop += 1
        sources = [(repeats[i][0], i - repeats[i][1]) for i in indices[at:stop]]
        times = Counter(sources)
        shared = [k for k, source in enumerate(sources) if times[source] > 1]
        low, high = (at + shared[0], at + shared[-1]) if shared else (at, at)
        start, end = ends[indices[low]], ends[indices[high] + 1]
        if words_in(raw[start:end]) >= min_words:
            out.append((start, end, repeats[indices[low]][0]))
        at = stop
    return out


def _cut_out(texts: pa.Array, repeats: pa.Array, min_words: int) -> pa.Array:
    cleaned, spans = [], []
    for text, found in zip(texts, repeats):
        if not text.is_valid or not found.is_valid:
            cleaned.append(None)
            spans.append([])
            continue
        raw, kept, last, own = text.as_py().encode(), [], 0, []
        of = [found.values.field(name).to_pylist() for name in ("index", "first_doc", "first_index")]
        places = {i: (doc, index) for i, doc, index in zip(*of)}
        chars = 0
        for start, end, first in removable_spans(raw, places, min_words):
            before, inside = raw[last:start].decode(), raw[start:end].decode()
            kept.append(before)
            chars += len(before)
            own.append({"start": chars, "length": len(inside), "first_doc_id": None if first == NO_ID else first})
            chars += len(inside)
            last = end
        cleaned.append("".join(kept) + raw[last:].decode())
        spans.append(own)
    span = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("first_doc_id", pa.int64())])
    return pa.StructArray.from_arrays([pa.array(cleaned, pa.string()), pa.array(spans, pa.list_(span))], ["text", "spans"])


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the cleaned ``text`` and ``__removed``: spans (start, length, first_doc_id) in characters."""
    spans = "array<struct<start:int,length:int,first_doc_id:long>>"

    @F.arrow_udf(f"text string, spans {spans}")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, repeats in batches:
            yield _cut_out(texts, repeats, min_words)
        texts = repeats = None
        give_back()

    # Else a filter on the result is pushed below, and all texts are cut twice, by twice as many workers.
    cut = cut.asNondeterministic()

    repeats = repeated_chunks(docs)
    by_doc = repeats.groupBy("doc", "check").agg(
        F.collect_list(F.struct("index", "first_doc", "first_index")).alias("__repeats")
    )
    keyed = docs.withColumn("__doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))))
    keyed = keyed.withColumn("__check", text_check("text"))
    by_doc = by_doc.select(F.col("doc").alias("__doc"), F.col("check").alias("__check"), "__repeats")
    joined = keyed.join(by_doc, ["__doc", "__check"], "left")
    # Texts without repeats do not go through Python.
    joined = joined.withColumn("__cut", cut(F.when(F.col("__repeats").isNotNull(), F.col("text")), F.col("__repeats")))
    text = F.coalesce(F.col("__cut.text"), F.col("text")).alias("text")
    removed = F.coalesce(F.col("__cut.spans"), F.array().cast(spans)).alias("__removed")
    return joined.select(*[text if c == "text" else joined[c] for c in docs.columns], removed)


def dedupe(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents without the repeated passages; those of which no word is left are dropped.

    ``n_chars``, where the table has it, follows the text.
    """
    cleaned = without_repeats(docs, min_words)
    emptied = (F.size("__removed") > 0) & ~F.col("text").rlike(WORD)
    kept = cleaned.filter(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(F.size("__removed") > 0, length).otherwise(F.col("n_chars")))
    return kept.drop("__removed")


@query()
def op7_chunking(spark, sf_dir: str) -> DataFrame:
    """Every document without the passages that occur earlier, and what was removed where."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.char_length("text").cast("long").alias("n_chars"))
    cleaned = without_repeats(docs)
    return cleaned.select(
        "doc_id",
        "n_chars",
        F.aggregate("__removed", F.lit(0).cast("long"), lambda a, s: a + s["length"]).alias("removed_chars"),
        F.col("__removed").alias("spans"),
        F.array_distinct(F.transform("__removed", lambda s: s["first_doc_id"])).alias("first_doc_ids"),
        "text",
    )
