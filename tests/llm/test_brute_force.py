"""Language sets, boosted trees and decontamination against plain enumerations."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from txnflow.llm import boosting, components, decontaminate, language, near_duplicates
from txnflow.llm.common import WordHashes, plain_words, table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ---- language ---------------------------------------------------------------


def test_mixture_is_the_likeliest(spark, sf_dir):
    """EM against a grid of proportions, for texts of one and of two languages."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs)
    texts = {r.lang: r.text for r in docs.filter("n_chars between 300 and 3000").collect()}
    a, b = sorted(texts)[:2]
    columns = [model.languages.index(x) for x in (a, b)]
    for text in (texts[a], texts[b], texts[a][:300] + " " + texts[b][:300], texts[a][:100] + " " + texts[b]):
        buckets, n = np.unique(language.trigrams(text), return_counts=True)
        p = model.probabilities[buckets][:, columns]
        share, found = language.mixture(p, n.astype(float), steps=2000, tolerance=1e-9)
        grid = [float(n @ np.log(p @ np.array([w, 1 - w]))) for w in np.linspace(0.0005, 0.9995, 1000)]
        assert found >= max(grid) - 0.01 and abs(share[0] - np.linspace(0.0005, 0.9995, 1000)[int(np.argmax(grid))]) < 0.01


def test_language_sets_against_all_sets(spark, sf_dir):
    """The penalised likelihood of the chosen set is that of the best of all sets."""
    docs = table(spark, sf_dir, "documents")
    model, penalty = language.fit(docs), 4.0
    own = {}
    for r in docs.filter("n_chars > 200").orderBy("doc_id").collect():
        own.setdefault(r.lang, []).append(r.text)
    names = sorted(own)
    texts = [own[x][i][:600] for x in names for i in range(3)]
    texts += [own[x][0][:500] + " " + own[y][0][:500] for x, y in itertools.combinations(names, 2)]
    for text in texts:
        buckets, n = np.unique(language.trigrams(text), return_counts=True)
        p, n = model.probabilities[buckets], n.astype(float)

        def value(chosen, p=p, n=n):
            likelihood = language.mixture(p[:, list(chosen)], n, steps=500, tolerance=1e-7)[1]
            return likelihood - penalty * np.log(max(2.0, n.sum())) / 2 * (len(chosen) - 1)

        every = [s for k in range(1, len(names) + 1) for s in itertools.combinations(range(len(model.languages)), k)]
        picked = tuple(sorted(model.languages.index(x) for x, _ in language.identify(model, text, penalty)[2]))
        assert value(picked) >= max(map(value, every)) - 0.5


# ---- boosted trees ----------------------------------------------------------


def walk(model, row):
    total = model.base
    for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        total += leaf[node - len(feature)]
    return 1 / (1 + np.exp(-total))


def plain_tree(x, gradient, curve, edges, depth, ridge, least):
    """(feature, threshold, left, right) or a leaf value: the best split of all by trying each."""
    value = -gradient.sum() / (curve.sum() + ridge)
    if not depth:
        return value
    score = lambda g, h: g**2 / (h + ridge)
    best = (1e-9, None, None)
    for j, cuts in enumerate(edges):
        for cut in cuts:
            left = x[:, j] <= cut
            g, h = gradient[left].sum(), curve[left].sum()
            if h >= least and curve.sum() - h >= least:
                gain = score(g, h) + score(gradient.sum() - g, curve.sum() - h) - score(gradient.sum(), curve.sum())
                if gain > best[0] + 1e-9:
                    best = (gain, j, cut)
    _, j, cut = best
    if j is None:
        return (None, None, plain_tree(x, gradient, curve, edges, depth - 1, ridge, least), None)
    left = x[:, j] <= cut
    sides = [plain_tree(x[m], gradient[m], curve[m], edges, depth - 1, ridge, least) for m in (left, ~left)]
    return (j, cut, *sides)


def plain_value(tree, row):
    while isinstance(tree, tuple):
        j, cut, left, right = tree
        tree = left if j is None or row[j] <= cut else right
    return tree


@pytest.mark.parametrize("seed", range(4))
def test_boosting_against_a_plain_recursion(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(300, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] + x[:, 2] > 0)).astype(float)
    y[rng.random(300) < 0.1] = 0.5
    trees, depth, rate, bins, ridge, least = 6, 3, 0.3, 16, 1.0, 2.0
    model = boosting.fit(x, y, trees, depth, rate, bins, ridge, least)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    share = (y.sum() + 0.5) / (len(y) + 1)
    total = np.full(len(x), np.log(share / (1 - share)))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        tree = plain_tree(x, p - y, p * (1 - p), edges, depth, ridge, least)
        total += rate * np.array([plain_value(tree, row) for row in x])
    want = 1 / (1 + np.exp(-total))
    got = model.score(x)
    assert np.allclose(got, [walk(model, row) for row in x]) and np.allclose(got, want, atol=1e-6)


# ---- decontamination --------------------------------------------------------


def nearest_run(item, words):
    """The fewest edits to the item of any run of the words, by the plain table."""
    row = [0] * (len(words) + 1)
    for i, w in enumerate(item, 1):
        above, row = row, [i]
        for j, v in enumerate(words, 1):
            row.append(min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (w != v)))
    return min(row)


def test_decontamination_against_all_runs(spark):
    """Every pair reported is within the edits, with its distance; nine in ten of all such pairs are reported, at least."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(300)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(8, 40)))) for i in range(12)]
    items += [(90, items[0][1]), (91, None), (92, "too few words")]
    docs = []
    for d in range(60):
        own = [word() for _ in range(rng.randrange(60))]
        if d % 2:
            planted = rng.choice(items[:12])[1].split()
            for _ in range(rng.randrange(len(planted) // 5 + 2)):
                at = rng.randrange(len(planted))
                planted[at : at + rng.randrange(2)] = [word()] * rng.randrange(2)
            at = rng.randrange(len(own) + 1)
            own[at:at] = planted
        docs.append((d, " ".join(own)))
    index = decontaminate.build(spark.createDataFrame(items, "item_id long, text string"))
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), index).collect()
    want = {}
    for d, text in docs:
        for i, item in items:
            own = (item or "").split()
            if len(own) >= decontaminate.LEAST_WORDS:
                edits = nearest_run(own, text.split())
                if edits <= len(own) * decontaminate.EDITS // 100:
                    want[d, i] = edits
    got = {}
    for r in found:
        got[r.doc_id, r.item_id] = min(r.distance, got.get((r.doc_id, r.item_id), 999))
        run = plain_words(docs[r.doc_id][1].encode())[r.start : r.end]
        assert nearest_run([w.encode() for w in dict(items)[r.item_id].split()], run) <= r.distance
    assert got.items() <= want.items() and len(got) >= 0.9 * len(want) and len(want) >= 25
    assert isinstance(WordHashes(), dict)


# ---- near duplicates and the pipeline ---------------------------------------


def test_components_of_a_long_path(spark, monkeypatch):
    """A path whose smallest node is at its end takes few rounds."""
    path, written, real = [*range(2, 802), 1], [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, name: (written.append(name), real(df, name))[1])
    got = components.components(spark.createDataFrame(list(zip(path, path[1:])), "a long, b long")).collect()
    assert {r.label for r in got} == {1} and len(got) == 801 and written.count("trees") <= 15


def odd_documents(spark, order=1):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(5, a), (5, b), (9, a + " t"), (11, b + " t"), (None, "same text"), (None, "same text"), (None, a), (None, None)]
    rows += [(20, "z y x w v"), (20, "z y x w v"), (21, "z Y x w v"), (22, None), (22, None), (23, ""), (24, "password = hunter2hunter2 x")]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows][::order]
    names = ("_possible", "_blob", "_spans", "_place", "_bucket", "_row", "key", "content", "row", "group", "mark", "stays", "label")
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("own") for c in names})


@pytest.mark.parametrize("order", [1, -1])
def test_each_text_of_a_repeated_id_has_its_links(spark, order):
    docs = odd_documents(spark, order)
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates.near_duplicates(docs).collect()}
    assert {(5, 5, True), (9, 5, False), (11, 5, False), (21, 20, False), (22, 22, True), (None, None, True)} <= got


@pytest.mark.parametrize("order", [1, -1])
def test_stages_on_odd_rows(spark, sf_dir, order):
    """Nulls, repeated ids and rows, and columns named as the stages name theirs."""
    docs = odd_documents(spark, order)
    left = corpus_pipeline.without_near_duplicates(spark, docs, sf_dir)
    assert left.columns == docs.columns and left.filter("_possible = 'own' and content = 'own'").count() == left.count()
    texts = sorted((str(r.doc_id), (r.text or "")[:2]) for r in left.collect())
    assert texts == sorted(
        [("5", "a0"), ("5", "b0"), ("20", "z "), ("22", ""), ("22", ""), ("23", ""), ("24", "pa")]
        + [("None", "sa"), ("None", "sa"), ("None", "a0"), ("None", "")]
    )
    clean = corpus_pipeline.without_secrets(spark, docs, sf_dir)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert clean.filter("doc_id = 24").select("text", "n_chars", "_spans", "_blob").first() == ("[SECRET] x", 10, "own", "own")
    assert clean.filter("text is null").count() == docs.filter("text is null").count()
    for stage in (corpus_pipeline.good_quality, corpus_pipeline.without_benchmark):
        assert stage(spark, docs, sf_dir).columns == docs.columns


def test_stages_on_empty_tables(spark, sf_dir):
    empty = odd_documents(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0, name
