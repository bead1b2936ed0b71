"""Every registered query of the subpackage against its SQL or against brute force on the smallest tables."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, differences

import __spark_entry__ as entry
from millrace.llm import suffixtree, urlrules, winnowing
from millrace.llm.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def documents(con):
    return dict(con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall())


@pytest.fixture(scope="module")
def result(spark):
    done = {}

    def of(name):
        if name not in done:
            done[name] = QUERIES[name](spark, FOLDER).toPandas()
        return done[name]

    return of


def test_entry_names_all_queries():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(con, result, name):
    assert differences(result(name), con.execute(ORACLES[name]).df()) is None


@pytest.mark.parametrize("name", ["op8_winnowing", "op10_perspectives"])
def test_native_plans_hold_no_python(spark, plan, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_quality_on_held_out_labels(con, result):
    got = result("op1_quality").set_index("doc_id")
    assert len(got) == con.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert got["score"].between(0, 1).all()
    assert ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.iterrows())
    labels = con.execute("SELECT doc_id, quality FROM labels").df().set_index("doc_id")["quality"]
    held = got[got["held_out"]].join(labels, how="inner")
    assert (held["predicted"] == held["quality"]).mean() > 0.9


def brute_components(documents, percent):
    sets = {}
    for i, text in documents.items():
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_copies(documents, result):
    want = brute_components(documents, 85)
    got = result("op2_minhash")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert (got["kept"] == (got["doc_id"] == got["component_id"])).all()
    assert 0 < got["kept"].sum() < len(got)


def test_url_rules(con, result):
    got = result("op3_url_rules").set_index("page_id")
    rules = sorted(urlrules.RULES, key=lambda r: -len(r[1]))
    for page, url in con.execute("SELECT page_id, url FROM pages").fetchall():
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, tail = rest[:cut].lower(), rest[cut:]
        path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
        row = got.loc[page]
        assert (row["host"], row["path"]) == (host, path)
        fits = [
            (v, r)
            for v, r in rules
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])
        ]
        assert row["verdict"] in ("allow", "block")
        if fits:
            assert (row["verdict"], row["rule"]) == fits[0]
        else:
            assert row["rule"] is None


def test_top_scores(con, result):
    rows = con.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids = np.array([r[0] for r in rows])
    vectors = np.floor(np.array([r[1] for r in rows], np.float64) * 256).astype(np.int64)
    want = set()
    for q in np.flatnonzero(ids % 50 == 0):
        scores = vectors @ vectors[q]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[q]][:5]
        want |= {(int(ids[q]), n + 1, int(ids[j]), int(scores[j])) for n, j in enumerate(order)}
    got = result("op4_vafile")
    assert set(got[["query_id", "rank", "vec_id", "score"]].itertuples(index=False, name=None)) == want


def test_packing_round_trip(documents, result):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    got = result("op5_packing")
    sequences = got.sort_values("offset").groupby("sequence_id")
    for _, pieces in sequences:
        assert list(pieces["offset"]) == list(np.cumsum([0, *pieces["length"]])[:-1])
    lengths = sequences["length"].sum()
    assert lengths.max() <= 2048
    padded = lengths[(lengths & (lengths - 1)) != 0]
    assert len(padded) <= 1 and (2048 - padded).sum() < 0.02 * lengths.sum()
    for doc_id, pieces in got.sort_values("start").groupby("doc_id"):
        ids = np.array([*tokenizer.encode(documents[doc_id] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in pieces.itertuples():
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)


def test_language_model_counts(documents, result):
    got = result("op6_suffix_tree").set_index("doc_id")
    counts = Counter()
    for i, text in documents.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(suffixtree.words_and_end(text))
    total, distinct = sum(counts.values()), len(counts)
    for i, text in documents.items():
        words, row = suffixtree.words_and_end(text), got.loc[i]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        assert (row["n_tokens"], row["n_known"]) == (len(words), sum(counts[w] > 0 for w in words))
        assert row["train_tokens"] == total
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
    held = got[got["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()


def test_removed_passages_occur_earlier(documents, result):
    got = result("op7_chunking").set_index("doc_id")
    for i, row in got.iterrows():
        text, left, at = documents[i], [], 0
        for s in row["spans"]:
            passage = text[s["start"] : s["start"] + s["length"]]
            # Chunk by chunk the passage lies in the first text (which may be this one, earlier on).
            assert s["first_doc_id"] <= i
            first = documents[s["first_doc_id"]]
            assert passage.split()[0] in first
            left.append(text[at : s["start"]])
            at = s["start"] + s["length"]
        assert row["text"] == "".join(left) + text[at:]
        assert row["removed_chars"] == len(text) - len(row["text"])
    # Every word that is gone somewhere is still somewhere.
    before = {w for t in documents.values() for w in t.split()}
    after = {w for t in got["text"] for w in t.split()}
    assert before == after
    assert (got["removed_chars"] > 0).any()


def brute_fingerprint(text):
    import xxhash

    k, window, prime, base = winnowing.K_WORDS, winnowing.WINDOW, winnowing.PRIME, winnowing.BASE
    words = [w for w in text.lower().encode().split()]
    hashed = [(lambda h: h - 2**64 if h >= 2**63 else h)(xxhash.xxh64_intdigest(w, seed=42)) % prime for w in words]

    def gram(part):
        out = 0
        for h in part:
            out = (out * base + h) % prime
        return out

    grams = [gram(hashed[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [gram(hashed)] * bool(words)
    chosen = []
    for i in range(max(1, len(grams) - window + 1) if grams else 0):
        part = grams[i : i + window]
        place = max(j for j, h in enumerate(part) if h == min(part)) + i
        if place not in chosen:
            chosen.append(place)
    return [(grams[p], p) for p in chosen]


def test_fingerprints(documents, result):
    import hashlib

    got = result("op8_winnowing").set_index("doc_id")
    ids = sorted(documents)
    shown = lambda prints: " ".join(f"{h:x}@{p}" for h, p in prints)
    alike = lambda a, b: (len(a & b) / len(a | b)) if a | b else 1.0
    for n, i in enumerate(ids):
        text, after = documents[i] or "", documents[ids[(n + 1) % len(ids)]] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        own, changed, following = (brute_fingerprint(t) for t in (text, edited, after))
        row = got.loc[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (row["fingerprint"], row["edited_fingerprint"]) == (shown(own), shown(changed))
        sets = [{h for h, _ in p} for p in (own, changed, following)]
        assert row["near_edited"] == pytest.approx(alike(sets[0], sets[1]))
        assert row["near_next"] == pytest.approx(alike(sets[0], sets[2]))


def test_mix_comes_near_its_targets(result):
    got = result("op9_mixing")
    assert (got["taken"] <= 3 * got["size"]).all()
    assert got.groupby("source_size")["target"].nunique().max() >= 1
    assert got["taken"].sum() == pytest.approx(got["size"].sum(), rel=0.2)


def test_pipeline(spark, documents, result):
    import corpus_pipeline

    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs, tables = spark.read.parquet(f"{FOLDER}/documents.parquet"), [documents]
    columns = docs.columns
    by_stage = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns
        rows = docs.toPandas()
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        by_stage.append(rows)
    good, single, cut, mixed = by_stage
    labels = dict(tables and spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality").toPandas().values.tolist())
    assert sum(labels.get(i) == 1 for i in good["doc_id"]) >= 0.98 * sum(q == 1 for q in labels.values())
    want = brute_components(dict(zip(good["doc_id"], good["text"])), 80)
    assert set(single["doc_id"]) == {i for i, (_, root) in want.items() if i == root}
    assert set(cut["doc_id"]) <= set(single["doc_id"])
    assert (cut["n_chars"] == cut["text"].str.len()).all()
    assert set(mixed["doc_id"]) <= set(cut["doc_id"])
    copies = Counter(mixed["doc_id"])
    assert max(copies.values()) <= 3 and min(copies.values()) >= 1
    packed = corpus_pipeline.run(spark, FOLDER).toPandas()
    totals = defaultdict(int)
    for row in packed.itertuples():
        totals[row.doc_id] += row.length
        assert len(row.ids) == 4 * row.length
    each = packed.groupby("doc_id")["doc_tokens"].first()
    assert {i: n for i, n in totals.items()} == {i: copies[i] * each[i] for i in each.index}
