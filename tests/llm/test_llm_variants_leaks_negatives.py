"""Spelling variants, decontamination and hard negatives against brute force, with odd rows and forced splits."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontamination, hardnegatives, spelling

DOCS = "doc_id long, text string, word string, n int, file string, `a b` string, __text string"


def as_docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "f", "s", "t") for r in rows], DOCS)


# --- spelling variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {
        (w, form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts
    }


def got_variants(words, **how):
    return {tuple(r) for r in spelling.variants(words, **how).select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.mark.parametrize("block", [4, 512])
def test_variants_by_brute_force(spark, block):
    rnd = random.Random(7)
    counts = {}
    for _ in range(40):
        word = "".join(rnd.choice("abé") for _ in range(rnd.randint(7, 11)))
        for k in range(12):
            n = 10 ** rnd.randint(0, 5) * rnd.randint(1, 3) + 1
            counts.setdefault(word, n)
            at, how = rnd.randrange(len(word)), rnd.randrange(3)
            word = word[:at] + (rnd.choice("abéÿ") if how else "") + word[at + (how != 2) :]
            word = word if len(word) >= 7 else word + "aaa"
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = brute_variants(counts)
    assert got_variants(words, block=block) == want
    assert len({r[2] for r in want}) < len(want) and any(r[4] > 1 for r in want)
    assert any(r[1] is not None and r[1] != r[2] for r in want)


def test_variants_of_long_words_and_one_large_file(spark):
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcdefgh") for _ in range(700))
    # The first pair differs in another strip of columns, the last in length.
    long = {base: 500, base[:300] + "z" + base[301:]: 5, base[:650] + base[651:]: 7, base[::-1]: 3}
    # All of one file: the same front and back around every middle.
    many = {f"zzzzzz{a}{b}{c}yyyyyy": 2 for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefg"}
    counts = {**long, **many}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: (r["n_near"], r["form"]) for r in spelling.variants(words, block=64).collect()}
    assert got[base] == (2, None) and got[base[::-1]] == (0, None)
    assert [got[w] for w in list(long)[1:3]] == [(1, base), (1, base)]
    assert {got[w] for w in many} == {(9 + 9 + 6, None)}


def test_word_counts(spark):
    rows = [
        (1, "Straßen STRASSEN straßen x1straßen_abcdef Äpfelmus äpfelmus ×÷×÷×÷×"),
        (1, "strassen"),
        (None, "strassen ellipses"),
        (2, None),
        (3, ""),
        (4, "strassen " * 3000 + "ellipse’ellipses"),
    ]
    got = dict(spelling.word_counts(as_docs(spark, rows)).collect())
    # Only A-Z are lower-cased, so Ä and ä differ, and so do their words.
    assert got == {"straßen": 3, "strassen": 3003, "ellipses": 2}
    slipped, want = dict(spelling.word_counts(as_docs(spark, rows), least_count=1, slip=2).collect()), Counter()
    for doc_id, text in rows:
        for run in spelling.re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            run = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 2 == 0 else run
            want[run] += len(run) >= 7
    assert slipped == {w: n for w, n in want.items() if n}


def test_variants_of_nothing(spark):
    empty = spelling.word_counts(as_docs(spark, [(1, "a"), (2, None)]).limit(0))
    assert spelling.variants(empty).collect() == []
    one = spark.createDataFrame([("lonelyword", 4)], "word string, n long")
    assert got_variants(one) == {("lonelyword", None, "lonelyword", 4, 0, None)}


# --- decontamination


def split_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def brute_hits(docs, items, window):
    windows = defaultdict(set)
    for name, text in items:
        words = split_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            windows[tuple(words[i : i + window])].add("" if name is None else str(name))
    out = []
    for doc_id, text in docs:
        words, hit, found = split_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                names = windows.get(tuple(words[i : i + size]))
                if names:
                    hit |= set(range(i, i + size))
                    found |= names
        out.append((doc_id, len(words), tuple(sorted(hit)), tuple(sorted(found))))
    return sorted(out, key=repr)


def got_hits(df):
    out = []
    for r in df.collect():
        h = r["__hits"]
        hit = [i for s in h["spans"] for i in range(s["start"], s["stop"])]
        assert len(set(hit)) == len(hit)
        out.append((r["doc_id"], h["n_words"], tuple(hit), tuple(h["items"])))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def leaks():
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)] + ["Naïve", "漢字", "7", "É"]
    prose = lambda n, k: " ".join(rnd.choices(vocabulary[:k], k=n))
    items = [(i, prose(rnd.randint(4, 30), 300)) for i in range(30)]
    items += [(30, "w1 w2"), (31, ""), (32, None), (None, prose(9, 300)), (5, prose(15, 300)), (33, items[3][1]), (100, items[4][1][8:])]
    docs = []
    for i in range(60):
        text = prose(rnd.randint(0, 80), 300)
        if i % 3 == 0:
            name, leak = rnd.choice(items)
            words = (leak or "").split()
            a = rnd.randrange(max(1, len(words) - 5))
            text = f"{text}. {', '.join(words[a:]).upper()}!\n{prose(20, 300)}"
        docs.append((i, text))
    docs += [(1, None), (1, ""), (None, docs[0][1]), (None, None), docs[3], docs[3], (99, prose(30_000, 12))]
    return docs, items


@pytest.mark.parametrize("part_words,shard_words", [(1 << 18, 1 << 19), (40, 200)])
def test_hits_by_brute_force(spark, leaks, part_words, shard_words):
    docs, items = leaks
    rows, benchmark = as_docs(spark, docs).repartition(3), spark.createDataFrame(items, "item_id long, text string")
    for window in (10, 4):
        judged = decontamination.with_hits(rows, benchmark, window, part_words, shard_words)
        assert judged.columns == [*rows.columns, "__hits"]
        want = brute_hits(docs, items, window)
        assert got_hits(judged) == want
        assert 5 < sum(bool(w[2]) for w in want) < len(want)


def test_decontaminated_rows_are_those_without_hits(spark, leaks):
    docs, items = leaks
    rows, benchmark = as_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    left = decontamination.decontaminate(rows, benchmark)
    assert left.columns == rows.columns
    want = sorted((d for d, _, hit, _ in brute_hits(docs, items, 10) if not hit), key=repr)
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == want
    none = benchmark.limit(0)
    assert decontamination.decontaminate(rows, none).count() == len(docs)
    assert decontamination.decontaminate(rows.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("shard_words", [300, 1 << 19])
def test_longest_matches_by_brute_force(spark, leaks, shard_words):
    docs, items = leaks
    # The long text of few words has very many places with the same window.
    docs, items = [d for d in docs if d[1] and d[0] is not None and d[0] != 99], [i for i in items if i[0] not in (5, None, 32)]
    rows, benchmark = as_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["item_id"], r["item_start"]): r for r in decontamination.longest_matches(rows, benchmark, shard_words=shard_words).collect()}
    texts = defaultdict(list)
    for d, t in docs:
        texts[d].append(split_words(t))
    least = min(len(split_words(t)) for _, t in items if split_words(t))
    seen = 0
    for name, text in items:
        words = split_words(text)
        for start in range(len(words)):
            suffix, best = words[start:], 0
            for several in texts.values():
                for other in several:
                    for i in range(len(other)):
                        n = 0
                        while n < len(suffix) and i + n < len(other) and suffix[n] == other[i + n]:
                            n += 1
                        best = max(best, n)
            row = got.get((str(name), start))
            if best < least:
                assert row is None
                continue
            seen += best > 10
            assert row["length"] == best
            assert any(t[row["doc_start"] : row["doc_start"] + best] == suffix[:best] for t in texts[row["doc_id"]])
    assert seen > 5


def test_many_copies_of_one_passage(spark):
    passage = " ".join(f"common{i}" for i in range(25))
    docs = as_docs(spark, [(i, passage if i % 2 else f"own{i} " * 30) for i in range(3000)])
    benchmark = spark.createDataFrame([(i, passage) for i in range(40)], "item_id long, text string")
    got = decontamination.with_hits(docs, benchmark, shard_words=4000).select(
        "doc_id", F.size("__hits.items").alias("n"), F.size("__hits.spans").alias("s")
    )
    assert {(r["doc_id"] % 2, r["n"], r["s"]) for r in got.collect()} == {(1, 40, 1), (0, 0, 0)}


# --- hard negatives


def brute_negatives(rows, positives, negatives, low, high):
    kept = [
        (n, i, label, np.floor(np.array(x, np.float64) * 256).astype(np.int64))
        for n, (i, x, label) in enumerate(rows)
        if label is not None and x is not None and all(v is not None and np.isfinite(v) for v in x)
    ]
    out = []
    last = lambda i: (i is None, i)
    for n, i, label, x in kept:
        if i is None or i % 10:
            continue
        met = sorted(((-int(x @ y), last(j), other) for m, j, other, y in kept if m != n and len(y) == len(x)), key=lambda t: t[:2])
        for p, (_, pid), _ in [(s, j, o) for s, j, o in met if o == label][:positives]:
            inside = [(s, j) for s, j, o in met if o != label and low * -p <= 100 * -s <= high * -p]
            out += [(i, pid, r + 1, j[1], -p, -s) for r, (s, j) in enumerate(inside[:negatives])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def vectors():
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(3, 6))
    rows = []
    for i in range(160):
        label = int(rnd.choice(3, p=[0.6, 0.3, 0.1]))
        rows.append((i, (0.3 * centres[label] + 0.2 * rnd.normal(size=6)).round(2).tolist(), label))
    rows += [rows[10], rows[10], (10, rows[11][1], 1), (None, rows[10][1], 1), (None, rows[20][1], 0), (30, None, 1)]
    rows += [(200, [0.1] * 6, None), (201, [float("nan")] * 6, 0), (202, [float("inf")] + [0.0] * 5, 0), (203, [None] + [0.1] * 5, 1)]
    rows += [(210, [0.5, 0.5], 1), (211, [0.5, 0.5], 1), (212, [0.4, 0.3], 2), (220, [], 1), (221, [], 1), (222, [], 2)]
    rows += [(230, [0.0] * 6, 9), (231, [0.2] * 6, 9), (240, [9.0] * 6, 8)]
    return rows


@pytest.mark.parametrize("anchor_block,row_block", [(512, 8192), (3, 17)])
def test_hard_negatives_by_brute_force(spark, vectors, anchor_block, row_block):
    kind = "vec_id long, embedding array<double>, label int, row int, score string, slot string"
    table = spark.createDataFrame([(*v, 1, "s", "t") for v in vectors], kind).repartition(3)
    rows = hardnegatives.usable(table)
    for positives, negatives, low, high in ((5, 10, 30, 90), (2, 1, 0, 200), (7, 4, 80, 100)):
        got = hardnegatives.mine(rows, F.col("vec_id") % 10 == 0, positives, negatives, low, high, anchor_block, row_block)
        want = brute_negatives(vectors, positives, negatives, low, high)
        assert sorted((tuple(r) for r in got.select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        ).collect()), key=repr) == want
        assert len(want) > 20


def test_hard_negatives_of_little(spark, vectors):
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")
    anchors = F.col("vec_id") % 10 == 0
    assert hardnegatives.mine(hardnegatives.usable(table.limit(0)), anchors).count() == 0
    assert hardnegatives.mine(hardnegatives.usable(table.filter("label = 0")), anchors).count() == 0
    assert hardnegatives.mine(hardnegatives.usable(table.filter("vec_id = 10").limit(1)), anchors).count() == 0


def test_large_components_stay_exact(spark):
    big = 2.0**21
    rows = [(0, [big, 1.0], 1), (1, [big, 0.5], 1), (2, [big / 2, 0.25], 2), (3, [big / 2, 0.5], 2), (4, [big / 4, 7.0], 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hardnegatives.mine(hardnegatives.usable(table), F.col("vec_id") % 10 == 0)
    want = brute_negatives(rows, 5, 10, 30, 90)
    assert len(want) == 2 and sorted(tuple(r) for r in got.collect()) == want
