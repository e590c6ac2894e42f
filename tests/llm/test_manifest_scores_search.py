"""The Merkle manifest, the language model and the ranked search against plain Python, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnflow.llm import kneser_ney, lexical, merkle, queries
from txnflow.llm.common import held_out
from txnflow.session import scratch_table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def with_clashing_names(df):
    names = ("key", "text_", "group", "tree", "size", "position", "chunk", "leaf", "row", "part", "at", "other", "level", "index", "shard")
    return df.withColumns({c: F.lit("x") for c in (*names, "held_out", "score", "term", "terms", "rank", "doc", "item", "n_tokens", "root")})


def folder(spark, **tables):
    path = scratch_table(spark, "tables")
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return path


# ---- Merkle manifest --------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) for rows (doc_id, source, lang, n_chars, text)."""
    leaf = lambda r: H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
        return out

    def path(tree, i):
        for level in tree[:-1]:
            a = i // 3 * 3
            yield level[a:i], level[i + 1 : a + 3]
            i //= 3

    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted(groups[s], key=lambda x: x[:3]) for s in names}
    trees = {s: levels([x[2] for x in own[s]]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, digest, r) in enumerate(own[s]):
            way = [*path(trees[s], i), *path(top, k)]
            fold = digest
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                fold = leaf((*r[:4], r[4].replace("\n", "")))
            for left, right in way:
                fold = H(*left, fold, *right)
            root = top[-1][0]
            out.append((r[0], digest, trees[s][-1][0], root, H(*[x for sides in way for side in sides for x in side]), fold, fold == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("height", [1, 2, 7])
def test_manifest(spark, monkeypatch, height):
    """Groups of one to many blocks, null and repeated ids, null groups, equal rows, texts that tampering leaves alone."""
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rng = random.Random(height)
    sources = [None, "", "ü", "b", *["a"] * 30, *(f"s{i}" for i in range(25))]
    texts = [None, "", "x\ny", "z", "\n", "long " * 9999]
    rows = [(rng.choice([None, *range(200)]), rng.choice(texts), None, rng.choice(sources), rng.choice([None, 3])) for _ in range(400)]
    path = folder(spark, documents=with_clashing_names(spark.createDataFrame(rows, DOCS)))
    got = sorted(map(tuple, queries.op11_merkle_manifest(spark, path).collect()), key=str)
    assert got == brute_manifest([(i, s, la, n, t) for i, t, la, s, n in rows])


@pytest.mark.parametrize("rows", [[], [(7, "only\none", "en", "s", 8)], [(i, "t", "en", None, 1) for i in range(4)], [(i, "t", "en", str(i), 1) for i in range(9)]])
def test_manifest_of_few_rows(spark, rows):
    path = folder(spark, documents=spark.createDataFrame(rows, DOCS))
    got = sorted(map(tuple, queries.op11_merkle_manifest(spark, path).collect()), key=str)
    assert got == (brute_manifest([(i, s, la, n, t) for i, t, la, s, n in rows]) if rows else [])


def test_multiproof_is_minimal():
    """With the known leaves, the coordinates asked for give every proof, and without any one of them some is lost."""
    rng = random.Random(1)
    for _ in range(40):
        size = rng.randrange(1, 60)
        known = sorted(rng.sample(range(size), rng.randrange(1, size + 1)))
        leaves = [H(str(i)).encode() for i in range(size)]
        nodes, level = {(0, i): d for i, d in enumerate(leaves)}, 0
        for level, (first, digests) in enumerate(merkle.lifted(0, leaves, size, 99), 1):
            assert first == 0
            nodes.update({(level, i): d for i, d in enumerate(digests)})
        asked = [(lv, int(i)) for lv, at in merkle.missing(np.array(known), size) for i in at]
        assert len(set(asked)) == len(asked)
        tree = merkle.Tree(size, {i: leaves[i] for i in known}, {c: nodes[c] for c in asked})
        assert tree.root == nodes[level, 0]
        assert all(merkle.folded(leaves[i], tree.path(i)) == tree.root for i in known)
        for gone in asked:
            with pytest.raises(KeyError):
                merkle.Tree(size, {i: leaves[i] for i in known}, {c: nodes[c] for c in asked if c != gone})


# ---- language model ---------------------------------------------------------


def brute_scores(rows):
    """(doc_id, held out, tokens, known tokens, training tokens, base score, score) for rows (doc_id, text)."""
    out_of = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    tokens = lambda t: [0, *(t or "").encode().lower().split(), 1]
    count, pair = Counter(), Counter()
    for i, t in rows:
        if not out_of(i):
            s = tokens(t)
            count.update(s[1:])
            pair.update(zip(s, s[1:]))
    n, v = sum(count.values()), len(count)
    before, context, follow = Counter(w for _, w in pair), Counter(), defaultdict(Counter)
    for (a, _), c in pair.items():
        context[a] += c
        follow[a][min(c, 3)] += 1
    estimate = lambda counts: kneser_ney.discounts([sum(c == k for c in counts) for k in (1, 2, 3, 4)])
    d2, d1 = estimate(list(pair.values())), estimate(list(before.values()))
    of = lambda c, d: c - (0, *d)[min(c, 3)]
    share = sum((0, *d1)[min(c, 3)] for c in before.values()) / len(pair) if pair else 1.0
    lower = lambda w: max(of(before[w], d1), 0) / max(1, len(pair)) + share / (v + 1)

    def p(w, a):
        if not context[a]:
            return lower(w)
        return (max(of(pair[a, w], d2), 0) + sum(d2[k - 1] * follow[a][k] for k in (1, 2, 3)) * lower(w)) / context[a]

    for a in [*list(context)[:5], "never seen"]:
        assert math.isclose(sum(p(w, a) for w in count) + p("unknown", a), 1)
    out = []
    for i, t in rows:
        s = tokens(t)
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in s[1:])
        score = sum(math.log10(p(w, a)) for a, w in zip(s, s[1:]))
        out.append((i, out_of(i), len(s) - 1, sum(count[w] > 0 for w in s[1:]), n, base, score))
    return out


def same_scores(got, want):
    key = lambda r: (str(r[:5]), r[5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    close = lambda a, b: all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a, b))
    return len(got) == len(want) and all(g[:5] == w[:5] and close(g[5:], w[5:]) for g, w in zip(got, want))


def scored(spark, rows, **tables):
    path = folder(spark, documents=with_clashing_names(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)))
    return [tuple(r)[:7] for r in queries.op12_lm_scoring(spark, path).collect()]


def test_language_model(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op12_lm_scoring(spark, sf_dir).collect()]
    assert same_scores([g[:7] for g in got], brute_scores(rows))
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held) and all(math.isclose(g[7], 10 ** (-g[6] / g[2])) for g in held)


def test_language_model_on_odd_rows(spark):
    """Nulls, empty and very long texts, a pair that occurs more than 255 times, repeated rows, any case of A-Z."""
    rng = random.Random(3)
    word = lambda: f"w{min(rng.randrange(40), rng.randrange(40))}"
    rows = [(i, " ".join(word() for _ in range(rng.randrange(30)))) for i in range(60)]
    rows += [(None, "A b\x0bA\u00a0b"), (1, None), (2, ""), (3, " \n"), (4, "same same " * 400), (4, "same same " * 400), (5, "É é Q q"), (6, "x" * 100_000)]
    assert same_scores(scored(spark, rows), brute_scores(rows))


def test_pair_counts_come_back_and_take_little_room():
    rng = random.Random(5)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(200)).encode() for _ in range(200)]
    part = kneser_ney.Slice.of(texts)
    left, right, n = part.pairs()
    left, right = part.words[left], part.words[right]
    found = [kneser_ney.read_pairs(*block) for _, *block in kneser_ney.pair_blocks(part, 2)]
    pairs = lambda parts: sorted(tuple(map(int, p)) for block in parts for p in zip(*block, strict=True))
    assert pairs(found) == pairs([(left, right, n)])
    plain = 0
    for _, at in kneser_ney.by_shard(kneser_ney.pair_keys(left, right), 2):
        plain += sum(len(kneser_ney.zstandard.ZstdCompressor(level=1).compress(x[at].tobytes())) for x in (left, right, n))
    assert sum(len(b) for _, *block in kneser_ney.pair_blocks(part, 2) for b in block) < 0.9 * plain


@pytest.mark.parametrize("rows", [[], [(42, "held out alone")], [(1, None)]])
def test_language_model_of_few_rows(spark, rows):
    assert same_scores(scored(spark, rows), brute_scores(rows))


# ---- ranked search ----------------------------------------------------------


def brute_search(docs, items, k=10):
    terms = lambda t: [m.lower() if m.isascii() else re.sub("[A-Z]", lambda x: x[0].lower(), m) for m in re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n, total, df = len(own), sum(m for *_, m in own), Counter(t for _, c, _ in own for t in c)
    asked = defaultdict(set)
    for item, t in items:
        asked[item].update(terms(t))
    out = []
    for item, wanted in asked.items():
        found = []
        for i, c, size in own:
            norm = 100 - 90 + 90 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * norm)) for t in wanted if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def searched(spark, docs, items, **options):
    docs = with_clashing_names(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCS))
    found = lexical.ranked(docs, spark.createDataFrame(items, "item_id long, text string"), **options)
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 300}, {"most_terms": 5, "block_bytes": 2000}])
def test_search(spark, options):
    """Many ties, common and rare terms, nulls, repeated and very long rows, items without a match, several blocks."""
    rng = random.Random(7)
    word = lambda: f"W{min(rng.randrange(30), rng.randrange(30))}"
    docs = [(rng.choice([None, *range(300)]), " ".join(word() for _ in range(rng.randrange(12)))) for _ in range(250)]
    docs += [(400, None), (401, ""), (402, "--- ..."), (403, "w1_É w2 É\u00a0x " * 5000), (404, "É"), (405, "é"), (7, "w1 w2"), (7, "w1 w2")]
    items = [(i, " ".join(word() for _ in range(1 + i % 6))) for i in range(12)]
    items += [(20, "w1 w2"), (20, "É w3"), (21, None), (22, "?"), (23, "absent"), (None, "w4 w4"), (24, " ".join(f"w{i}" for i in range(30)))]
    assert searched(spark, docs, items, **options) == brute_search(docs, items)


def test_search_of_empty_tables(spark):
    assert searched(spark, [], [(1, "a b")]) == searched(spark, [(1, "a b")], []) == searched(spark, [(1, None)], [(1, "a")]) == []


def test_nra_reads_no_further_than_it_must():
    """Exact at every bound, and lists that cannot change the result are not read to their ends."""
    rng = np.random.default_rng(5)
    for trial in range(60):
        size = int(rng.integers(1, 400))
        ids = rng.permutation(size * 2)[:size]
        lists, total = [], np.zeros(size, np.int64)
        for _ in range(int(rng.integers(1, 6))):
            places = rng.permutation(size)[: int(rng.integers(1, size + 1))]
            impacts = np.sort(rng.integers(1, 8 if trial % 2 else 10_000, len(places)))[::-1]
            total[places] += impacts
            lists.append((places, impacts))
        want = [i for i in np.lexsort((ids, -total)) if total[i]][:10]
        at, scores = lexical.nra(lists, ids, 10, step=4)
        assert at.tolist() == want and scores.tolist() == total[want].tolist()
        least = int(np.median(total))
        at, scores = lexical.nra(lists, ids, 10, least, step=4)
        kept = [i for i in want if total[i] >= least]
        assert [a for a, s in zip(at.tolist(), scores.tolist()) if s >= least] == kept

    class Watched:
        def __init__(self, a):
            self.a, self.deepest = a, 0

        def __len__(self):
            return len(self.a)

        def __getitem__(self, at):
            self.deepest = max(self.deepest, at if isinstance(at, int) else at.stop)
            return self.a[at]

    impacts = Watched(np.r_[np.full(10, 1000), np.full(100_000, 1)])
    lexical.nra([(np.arange(100_010), impacts)], np.arange(100_010), 10)
    assert impacts.deepest < 1000


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op13_lexical_search"])
def test_statements(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    from txnflow.llm.oracles import ORACLES

    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    found = queries.QUERIES[name](spark, sf_dir)
    want = con.sql(ORACLES[name])
    assert found.columns == want.columns and sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want.fetchall()))
