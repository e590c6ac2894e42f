"""The training-data operators against brute force, round trips and held-out accuracy, and their edge cases."""

import hashlib
import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from txnflow.llm import (
    decontaminate,
    language,
    licenses,
    near_duplicates,
    packing,
    quality,
    queries,
    repeats,
    secrets,
    top_k,
    url_filter,
)
from txnflow.llm.common import WordHashes, held_out, plain_words, table
from txnflow.session import scratch_table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TOKENIZER = public_tokenizers.path(queries.TOKENIZER)


def odd_rows():
    """Nulls, empty and long texts, repeated rows, a repeated id with another text."""
    base = " ".join(f"word{i}" for i in range(60))
    texts = [(1, base), (1, base), (2, None), (3, ""), (4, " \n\t"), (None, base), (5, base + " tail"), (6, "one two three")]
    texts += [(7, "one two three"), (8, "long " * 30_000 + base), (9, "###"), (10, "x " + base), (10, "other text here now"), (None, None)]
    return [(i, t, None if t is None else "en", "s", None if t is None else len(t)) for i, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    """With columns whose names the operators use themselves."""
    docs = spark.createDataFrame(odd_rows(), DOCS)
    return docs.withColumns({c: F.lit(1) for c in ("key", "score", "slice", "_key", "_spans", "_blob", "_possible", "_place")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return (text or "").encode().split()


def brute_components(rows, width):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w)} if 0 < len(w) < width else {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(spark, sf_dir, width):
    docs = table(spark, sf_dir, "documents")
    want = brute_components([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], width)
    got = near_duplicates.near_duplicates(docs, width=width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicate_family(spark):
    """Many edited copies of one text: components must be those of all pairs."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randrange(14)):
            own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 4)


def test_index_recall():
    """Signatures that differ in up to 19 of the 50 indexed positions always share a key."""
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**16, (2000, near_duplicates.POSITIONS)).astype(np.uint16)
    b = a.copy()
    for row in range(len(b)):
        at = rng.choice(50, 19, replace=False)
        b[row, at] += 1
    assert (near_duplicates.first_common(a, b) < 50).all()
    same = (near_duplicates.index_keys(a) == near_duplicates.index_keys(b)).any(1)
    assert same.all()


def test_repeats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    own = {r.doc_id: words(r.text) for r in docs.select("doc_id", "text").collect()}
    first = {}
    for i in sorted(own):
        for s in range(len(own[i]) - 12):
            first.setdefault(tuple(own[i][s : s + 13]), i)
    got = {r.doc_id: r for r in repeats.remove_repeats(docs).collect()}
    for i, w in own.items():
        gone = set()
        for s in range(len(w) - 12):
            if first[tuple(w[s : s + 13])] < i:
                gone.update(range(s, s + 13))
        assert got[i].n_words == len(w) and got[i].n_removed == len(gone)
        assert got[i].kept == b" ".join(x for n, x in enumerate(w) if n not in gone).decode()
        assert sorted(gone) == [n for s in got[i].repeats for n in range(s.start, s.end)]


def test_top_k(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    got = top_k.top_k(rows, F.col("vec_id") % 20 == 0).toPandas()
    p = rows.toPandas()
    x = np.floor(64 * np.array(p.embedding.tolist(), float)).astype(np.int64)
    for i in np.flatnonzero(p.vec_id.values % 20 == 0):
        scores = x @ x[i]
        best = [j for j in np.lexsort((p.vec_id.values, -scores)) if j != i][:20]
        mine = got[got.query_id == p.vec_id[i]].sort_values("rank")
        assert mine.vec_id.tolist() == p.vec_id.values[best].tolist() and mine.score.tolist() == scores[best].tolist()
    assert set(got.query_id) == {v for v in p.vec_id if v % 20 == 0}


def test_top_k_of_many_blocks(spark, monkeypatch):
    """Pivots with more blocks than one key of the join of blocks, one of them with a third of all rows."""
    monkeypatch.setattr(top_k, "BLOCK", 4)
    monkeypatch.setattr(top_k, "PIVOTS", 3)
    monkeypatch.setattr(top_k, "SHARE", 4)
    own = np.random.default_rng(3)
    x = own.normal(size=(600, 6))
    x[:200] = x[0] + own.normal(scale=0.05, size=(200, 6))
    ids = own.permutation(600)
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = top_k.top_k(rows, F.col("vec_id") % 20 == 0, k=7).toPandas()
    whole = np.floor(64 * x).astype(np.int64)
    for i in np.flatnonzero(ids % 20 == 0):
        scores = whole @ whole[i]
        best = [j for j in np.lexsort((ids, -scores)) if j != i][:7]
        mine = got[got.query_id == ids[i]].sort_values("rank")
        assert mine.vec_id.tolist() == ids[best].tolist() and mine.score.tolist() == scores[best].tolist()


def test_top_k_roots_beyond_a_broadcast(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(top_k, "BLOCK", 8)
    rows = table(spark, sf_dir, "embeddings").limit(300)
    want = top_k.top_k(rows, F.col("vec_id") % 20 == 0, k=5).toPandas()
    monkeypatch.setattr(top_k, "MOST_ROOTS", 0)
    got = top_k.top_k(rows, F.col("vec_id") % 20 == 0, k=5).toPandas()
    order = ["query_id", "rank"]
    assert len(got) and got.sort_values(order).values.tolist() == want.sort_values(order).values.tolist()


def test_top_k_odd_rows(spark):
    same = [0.5, 0.25]
    rows = [(i, same) for i in range(30)] + [(40, [float("nan"), 1.0]), (60, None), (80, [None, 1.0]), (None, same), (0, same)]
    rows += [(100, [1.0]), (101, [2.0]), (120, [float("inf"), 0.0])]
    got = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, k=3)
    by = {}
    for r in got.orderBy("query_id", "rank").collect():
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    score = 32 * 32 + 16 * 16
    assert by == {0: [(1, score), (2, score), (3, score)], 20: [(0, score), (1, score), (2, score)], 100: [(101, 64 * 128)]}


def test_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, TOKENIZER).collect()
    plain = Tokenizer.from_file(TOKENIZER)
    texts = {r.doc_id: r.text for r in docs.collect()}
    parts, sequences = {}, {}
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        parts.setdefault(r.doc_id, []).append((r.start, ids, r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, t in texts.items():
        ids = [x for _, own, _ in sorted(parts[i]) for x in own]
        assert ids == [*plain.encode(t or "", add_special_tokens=False).ids, 1] and parts[i][0][2] == len(ids)
    padding = 0
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert 0 < end <= 2048
        padding += 0 if end & (end - 1) == 0 else 2048 - end
    assert padding == 0


@pytest.mark.parametrize("sizes", [[1200] * 400, [2048, 1, 2047, 1024, 1024], [3], []])
def test_sum_of_squares(sizes):
    packer, done = packing.SumOfSquares(2048, max_open=16), []
    for i, n in enumerate(sizes):
        done += packer.add(i, np.arange(n, dtype=np.uint32))
        assert packer.n_open <= 17
    done += packer.finish()
    seen = {}
    for pieces in done:
        assert sum(len(x) for _, _, x in pieces) <= 2048
        for i, start, x in pieces:
            seen.setdefault(i, []).extend(range(start, start + len(x)))
    assert {i: sorted(x) for i, x in seen.items()} == {i: list(range(n)) for i, n in enumerate(sizes)}


def test_waiting_pieces_hold_no_whole_documents():
    """What waits in open sequences is bounded by them, not by the documents it was cut from."""
    packer = packing.SumOfSquares(2048)
    for doc in range(50):
        list(packer.add(doc, np.zeros(100 * 2048 + 7 + doc, np.uint32)))
    waiting = [ids for level in packer.open.values() for pieces in level for _, _, ids in pieces]
    assert waiting and sum((ids if ids.base is None else ids.base).nbytes for ids in waiting) <= 4 * 2048 * packer.n_open


def test_encoder_on_odd_texts():
    texts = ["ΟΔΟΣ. ΣΑΣ, Σ", "İ. Å! H̱ ẖ? don't x'll, 12.5 ² ½. ..", "<|endoftext|> <|ENDOFTEXT|>. a\x1cb \x1f x\x1fy", "日本語。👍🏽. ſK ẞß. ǅ", ""]
    plain = Tokenizer.from_file(TOKENIZER)
    got = packing.WordEncoder(TOKENIZER).encode([t.encode() for t in texts])
    assert [x.tolist() for x in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 3, 1)
    found = language.predict(docs, language.fit(docs.filter(~out))).filter(out).select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found) and all(0 <= r.score <= 1 for r in found)
    model = language.fit(docs)
    de, fr = (docs.filter(f"lang = '{x}' and n_chars > 800").first().text[:800] for x in ("de", "fr"))
    assert {x for x, _ in language.identify(model, de + " " + fr)[2]} == {"de", "fr"}


def test_quality(spark, sf_dir):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = quality.labelled(table(spark, "/root/testdata/sf0.01", "labels"), "quality")
    out = held_out(F.col("_key"), 5, 0)
    model = quality.fit(docs, labels.filter(~out))
    scored = docs.join(labels.filter(out), docs.doc_id == F.col("_key")).select("_label", quality.score(F.col("text"), model).alias("s"))
    rows = scored.collect()
    assert sum((r.s >= 0.3) == (r._label == 1) for r in rows) >= 0.95 * len(rows)


def test_repeated_grams_at_every_length(monkeypatch):
    """Word triples are counted exactly on both sides of the length from which they are numbered otherwise."""
    rng, at = random.Random(4), quality.FEATURES.index("repeated_grams")
    own = [b"w%d" % min(rng.randrange(1000), rng.randrange(1000)) for _ in range(2_000_050)]
    for n in (1_999_990, 2_000_050):
        distinct = len(set(zip(own[: n - 2], own[1 : n - 1], own[2:n])))
        assert quality.statistics(b" ".join(own[:n]))[at] == 1 - distinct / (n - 2)
    short = [b" ".join(own[:n]) for n in (1, 2, 3, 5000)]
    before = [quality.statistics(t) for t in short]
    monkeypatch.setattr(quality, "MOST_CODES", 0, raising=False)
    assert [quality.statistics(t) for t in short] == before


def test_secret_ledger_is_incremental(spark):
    first = spark.createDataFrame([("a", "password = hunter2hunter2 x"), ("b", "nothing"), ("c", "password = hunter2hunter2 x")], "path string, text string")
    ledger = scratch_table(spark, "ledger")
    secrets.scan(first, ledger)
    marks = secrets.read_ledger(spark, f"{ledger}/scanned", secrets.SCANNED)
    assert marks.count() == 2 * len(secrets.RULES)
    secrets.scan(first.union(spark.createDataFrame([("d", "AKIAABCDEFGHIJKL é"), ("e", None)], first.schema)), ledger)
    assert secrets.read_ledger(spark, f"{ledger}/scanned", secrets.SCANNED).count() == 4 * len(secrets.RULES)
    newer = (*secrets.RULES, secrets.Rule("note", "nothing", 1))
    secrets.scan(first, ledger, newer)
    assert secrets.read_ledger(spark, f"{ledger}/scanned", secrets.SCANNED).count() == 4 * len(secrets.RULES) + 2
    got = secrets.findings(first, ledger, newer).withColumn("clean", secrets.redacted(F.col("text"), F.col("_spans"))).collect()
    assert {r.path: r.clean for r in got} == {"a": "[SECRET] x", "b": "[SECRET]", "c": "[SECRET] x"}


def test_url_index(spark):
    pages = [(1, "http://A.Example.org/en/12?x"), (2, None), (3, "nothing"), (4, "https://notexample.org/en/1"), (5, "x://org#a"), (6, "x://b.cheap.com/p"), (6, "x://b.cheap.com/p")]
    entries = [("org/", 0), ("example.org/en/1", 1), ("cheap.com/", 2), (None, 1), ("", 0), ("org/", 0)]
    index = url_filter.build_index(spark, entries)
    got = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string"), index).collect()
    assert [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in sorted(got)] == [
        (1, "a.example.org", "/en/12", "example.org/en/1", "block"),
        (2, "", "", None, "allow"),
        (3, "", "", None, "allow"),
        (4, "notexample.org", "/en/1", "org/", "allow"),
        (5, "org", "", None, "allow"),
        (6, "b.cheap.com", "/p", None, "block"),
        (6, "b.cheap.com", "/p", None, "block"),
    ]


def test_licenses(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = {(r.doc_id, r.license) for r in licenses.scan(docs).collect()}
    grams = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    want = set()
    for r in docs.collect():
        own = plain_words((r.text or "").encode())
        for name, text in licenses.TEMPLATES.items():
            t = plain_words(text.encode())
            size = len(t) + max(1, len(t) // 4) if len(t) >= 8 else len(t)
            if any(5 * len(grams(t) & grams(own[s : s + size])) >= 4 * len(grams(t)) for s in range(max(1, len(own) - size + 1))):
                want.add((r.doc_id, name))
    assert got == want


def test_registered_licenses():
    """Whole licenses, headers and parts are found by name, in any case and layout, and not in other words."""
    index, hashes = licenses.Index(licenses.registered(), 5, 80, 10_000), WordHashes()
    around = [b"q%d" % i for i in range(300)]
    for name, text in licenses.registered().items():
        own = plain_words(text.upper().replace(" ", "\n * ").encode())
        found = {index.names[n]: (lo, hi, c) for n, lo, hi, c in index.matches(hashes.of(around[:117] + own + around[117:]))}
        assert found[name][2] >= 0.99 and found[name][:2] == (117, 117 + len(own))
    for name in ("gpl-3-text", "mpl-2.0-text", "agpl-3-header", "lgpl-2.1-header", "isc-text", "cc0-1.0-text", "mit-warranty", "bsd-conditions", "cc-by-4.0-line"):
        assert name in index.names
    assert not list(index.matches(hashes.of(around)))
    assert licenses.TEMPLATES.items() <= licenses.registered().items()


def test_decontamination_recall(spark, sf_dir):
    """Items with the largest allowed number of edits inside other text: recall 0.9 at least; clean texts stay."""
    items = [(r.item_id, plain_words(r.text.encode())) for r in table(spark, sf_dir, "benchmark").collect()]
    index = decontaminate.build(table(spark, sf_dir, "benchmark"))
    rng, hashes, found, asked = random.Random(3), WordHashes(), 0, 0
    for item, own in items:
        edited = list(own)
        for _ in range(len(own) // 5):
            at = rng.randrange(len(edited))
            edited[at : at + rng.randrange(2)] = [b"zz%d" % rng.randrange(10**6)] * rng.randrange(2)
        around = [b"q%d" % rng.randrange(10**6) for _ in range(100)]
        asked += 1
        found += any(m[1] == item for m in index.matches([hashes.of(around[:50] + edited + around[50:])]))
        assert not list(index.matches([hashes.of(around)]))
    assert found >= 0.9 * asked


@pytest.mark.parametrize("size", [250, 500, 1000, 2000])
@pytest.mark.parametrize("kind", ["exact", "insert", "delete"])
def test_decontamination_recall_of_long_items(size, kind, monkeypatch):
    """As above for items of many words; exact copies begin at any word."""
    rng, hashes, found = random.Random(size), WordHashes(), 0
    for trial in range(20):
        own = [b"w%d" % rng.randrange(10**6) for _ in range(size)]
        index = decontaminate.Index([(7, b" ".join(own).decode()), (8, "one two three four five six")], 20, 5, 10_000)
        edited = list(own)
        for _ in range(size // 5 if kind != "exact" else 0):
            at = rng.randrange(len(edited))
            edited[at : at + (kind == "delete")] = [b"zz%d" % rng.randrange(10**9)] * (kind == "insert")
        around, at = [b"q%d" % rng.randrange(10**9) for _ in range(400)], rng.randrange(400)
        text = hashes.of(around[:at] + edited + around[at:])
        matches = list(index.matches([text]))
        found += any(m[1] == 7 and m[2] <= size // 5 for m in matches)
        assert not list(index.matches([hashes.of(around)]))
        if kind == "exact":
            assert matches == [(0, 7, 0, at, at + size)]
        monkeypatch.setattr(decontaminate, "MOST_HITS", 10, raising=False)
        assert list(index.matches([text])) == matches
        monkeypatch.undo()
    assert found >= 19


def test_plain_words_beyond_ascii():
    """Case and marks of any script play no part, in items, templates and texts."""
    item = "¿Dónde está el niño que comió la piña después de la canción? Über große Straßen, l’été où j’étais là."
    index, hashes = decontaminate.Index([(1, item)], 20, 5, 1000), WordHashes()
    copies = [item.upper(), "«" + item.replace(" ", "” “") + "»…", unicodedata.normalize("NFD", item), item.replace("a", "a\u00ad")]
    for copy in copies:
        assert plain_words(copy.encode()) == plain_words(item.encode())
        found = list(index.matches([hashes.of(plain_words(f"antes de esto {copy} y más".encode()))]))
        assert [(m[1], m[2]) for m in found] == [(1, 0)]
    assert plain_words("“Qué—no” ¡SÍ!".encode()) == ["qué".encode(), b"no", "sí".encode()]
    assert plain_words(b"It's \xff A-b_9") == [b"it", b"s", b"a", b"b", b"9"]


def test_odd_rows(spark, odd):
    benchmark = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(20, 40))), (2, None), (3, ""), (None, "a b c d e f")], "item_id long, text string")
    near = near_duplicates.near_duplicates(odd, width=4).collect()
    assert len(near) == 14 and {r.component_id for r in near if r.doc_id in (1, 5, 10)} <= {1, 10}
    assert {r.component_id for r in near if r.doc_id in (6, 7)} == {6} and all(r.kept for r in near if r.doc_id is None)
    cut = repeats.remove_repeats(odd).collect()
    assert len(cut) == 14 and [r.n_removed for r in cut if r.doc_id == 1] == [0, 0] and sorted(r.n_removed for r in cut if r.doc_id == 10) == [0, 60]
    leaks = decontaminate.leaks(odd, decontaminate.build(benchmark)).collect()
    assert {(r.doc_id, r.item_id) for r in leaks} == {(1, 1), (None, 1), (5, 1), (8, 1), (10, 1)}
    model = language.fit(odd)
    kinds = {(r.doc_id, r.lang_pred) for r in language.predict(odd, model).collect()}
    assert (2, "und") in kinds and (9, "und") in kinds and (6, "en") in kinds
    assert licenses.scan(odd).count() == 0
    pieces = packing.pack(odd, TOKENIZER).collect()
    assert sum(r.length for r in pieces if r.doc_id in (2, 3, 4)) == 3
    labels = spark.createDataFrame([(1, 1), (1, 0), (9, 0), (3, None), (None, 1), (99, 1)], "doc_id long, quality int")
    fitted = quality.fit(odd, quality.labelled(labels, "quality"))
    assert all(0 <= r.s <= 1 for r in odd.select(quality.score(F.col("text"), fitted).alias("s")).collect())
    ledger = scratch_table(spark, "ledger")
    secrets.scan(odd, ledger)
    assert secrets.findings(odd, ledger).count() == 14


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert near_duplicates.near_duplicates(empty).count() == 0
    assert repeats.remove_repeats(empty).count() == 0
    assert decontaminate.leaks(empty, decontaminate.build(none)).count() == 0
    assert language.predict(empty.drop("lang"), language.fit(empty)).count() == 0
    assert licenses.scan(empty).count() == 0 and packing.pack(empty, TOKENIZER).count() == 0
    model = quality.fit(empty, quality.labelled(spark.createDataFrame([], "doc_id long, quality int"), "quality"))
    assert model.score(np.zeros((1, len(quality.FEATURES)))).tolist() == [0.5]
    assert top_k.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0
    ledger = scratch_table(spark, "ledger")
    secrets.scan(empty, ledger)
    assert secrets.findings(empty, ledger).count() == 0
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string"), url_filter.build_index(spark, [])).count() == 0


def test_pipeline_stages(spark, sf_dir):
    """Each stage on its own input, against brute force; the last packs exactly what is left."""
    docs = table(spark, sf_dir, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert out.columns == docs.columns
            path = scratch_table(spark, "stage")
            out.write.parquet(path)
            before, docs = {r.doc_id: r for r in docs.collect()}, spark.read.parquet(path)
            kept.append({r.doc_id: r for r in docs.collect()})
        if name == "near duplicates":
            want = brute_components([(i, r.text) for i, r in before.items()], 5)
            assert set(kept[-1]) == {c for _, c in want.values()}
        if name == "benchmark decontamination":
            items = [b" %s " % b" ".join(plain_words(r.text.encode())) for r in table(spark, sf_dir, "benchmark").collect()]
            hit = {i for i, r in before.items() if any(x in b" %s " % b" ".join(plain_words((r.text or "").encode())) for x in items)}
            assert hit.isdisjoint(kept[-1])
            assert set(before) - hit - set(kept[-1]) <= {i for i in before if i not in hit}
        if name == "secret scans":
            assert set(kept[-1]) == set(before) and not any("AKIA" in (r.text or "") for r in kept[-1].values())
    pieces = out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t")).collect()
    assert {r.doc_id for r in pieces} == set(kept[-1]) and all(r.n == r.t for r in pieces)


def test_digests(spark, sf_dir):
    row = queries.op6_packing(spark, sf_dir).first()
    piece = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER).filter(f"doc_id = {row.doc_id} and start = {row.start}").first()
    assert row.ids_crc32 == zlib.crc32(piece.ids)
    cut = queries.op10_substring_dedup(spark, sf_dir).orderBy("doc_id").first()
    text = table(spark, sf_dir, "documents").filter(f"doc_id = {cut.doc_id}").first().text
    assert cut.n_removed > 0 or cut.kept_sha256 == hashlib.sha256(b" ".join(words(text))).hexdigest()
