import functools
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import language_id, lm_scoring, toxicity
from skein.llm.common import shared_dir
from tests.conftest import DATA
from tests.llm.conftest import ODD


def held(i, n=5):
    return zlib.crc32(str(i).encode()) % n


def held_out_scores(spark, folder):
    """(score, label) of the labelled rows that op3 has not learnt from."""
    got = {r.doc_id: r for r in toxicity.op3_toxicity(spark, folder).collect()}
    assert all(r.held_out == (held(i) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    return [(got[r.doc_id].score, r.toxic) for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if got[r.doc_id].held_out]


def area(pairs):
    wins = [(a > b) + (a == b) / 2 for a, y in pairs if y == 1 for b, z in pairs if z == 0]
    return sum(wins) / len(wins)


def test_toxicity_on_held_out_rows(spark):
    """Of the labelled toxic rows of sf0.1 some 5 % hold nothing that others of them do; an answer of always 0 catches none."""
    pairs = held_out_scores(spark, "/root/testdata/sf0.1")
    toxic, ordinary = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    assert area(pairs) > 0.95
    assert sum(s >= 0.5 for s in toxic) > 0.88 * len(toxic)
    assert sum(s >= 0.5 for s in ordinary) < 0.015 * len(ordinary)


def test_toxicity_of_few_labels(spark):
    assert area(held_out_scores(spark, "/root/testdata/sf0.01")) > 0.85


def plain_toxicity(words, order, discount, weight):
    """The class models with dictionaries: log P(letter | context, toxic) - log P(letter | context, ordinary).

    `words`: a count of words for each class (ordinary, toxic).
    """
    spell = lambda w: [2] * (order - 1) + list(map(ord, w)) + [3]
    grams = [Counter(), Counter()]
    for y in (0, 1):
        for w, n in words[y].items():
            s = spell(w)
            for i in range(order - 1, len(s)):
                grams[y][tuple(s[i - order + 1 : i + 1])] += n
    both = grams[0] + grams[1]
    levels = {order: both}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    uniform = 1 / (len({g[-1] for g in both}) + 1)

    @functools.cache
    def shared(g):
        k = len(g)
        if not k:
            return uniform
        own = {h: n for h, n in levels[k].items() if h[:-1] == g[:-1]}
        if not own:
            return shared(g[1:])
        total = sum(own.values())
        return max(levels[k][g] - discount, 0) / total + discount * len(own) / total * shared(g[1:])

    @functools.cache
    def log_p(g, y):
        own = {h: n for h, n in grams[y].items() if h[:-1] == g[:-1]}
        total, kept = sum(own.values()), sum(max(n - discount, 0) for n in own.values())
        p = (max(grams[y][g] - discount, 0) + (total - kept + weight) * shared(g)) / (total + weight)
        return math.log(p)

    def evidence(w):
        s = spell(w)
        at = [tuple(s[i - order + 1 : i + 1]) for i in range(order - 1, len(s))]
        known = {g[:-1] for g in both}
        return sum(log_p(g, 1) - log_p(g, 0) for g in at if g[:-1] in known)

    letters = {g[-1] for g in both}
    sums = {g[:-1]: sum(math.exp(log_p((*g[:-1], c), y)) for c in letters) for g in both for y in (0, 1)}
    return evidence, sums


@pytest.mark.parametrize("order,discount,weight", [(4, 0.75, 5.0), (2, 0.5, 100.0), (6, 0.9, 0.5)])
def test_class_models_equal_a_dictionary_model(order, discount, weight):
    ordinary = Counter({"ideal": 7, "the": 50, "idle": 3, "Ünï": 2, "dale": 1})
    toxic = Counter({"idiot": 5, "the": 40, "idle": 1, "dote": 1})
    evidence, sums = plain_toxicity((ordinary, toxic), order, discount, weight)
    assert all(0.5 < p <= 1 + 1e-9 for p in sums.values())  # what is left is for letters never met
    every = list(ordinary.keys() | toxic.keys())
    symbols, at, word = toxicity.spelt(every, order)
    rows = np.column_stack([symbols[at - k] for k in range(order - 1, -1, -1)])
    grams, where = np.unique(rows, axis=0, return_inverse=True)
    n = [np.bincount(where.ravel(), np.array([c[w] for w in every])[word]).astype(float) for c in (toxic, ordinary)]
    tables = toxicity.Tables(grams, *n, discount=discount, weight=weight)
    new = [*every, "idiots", "theidiot", "x", "zzz", "d"]
    assert np.allclose(tables.words(new, order), [evidence(w) for w in new], atol=1e-5)
    scorer = toxicity.Scorer(tables, order, 3, memo=2)
    texts = ["the idiot the idle idiot ideal", "", "idiot", " ".join(new) * 3000]
    for t, e in zip(texts, scorer.evidence(texts), strict=True):
        assert e == pytest.approx(sum(sorted(map(evidence, t.lower().split()), reverse=True)[:3]) / 3, abs=1e-4)


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (3, 1), (6, 0), (None, 1), (99, 1), (8, 7)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    found = model.evidence(odd, keep=["doc_id"], name="e").withColumn("p", model.score(F.col("e"))).collect()
    assert len(found) == len(ODD) and all(0 <= r.p <= 1 for r in found)
    none = toxicity.fit(odd, labels.filter("false"))
    assert [r[0] for r in none.evidence(odd).select(none.score(F.col("evidence")).alias("p")).distinct().collect()] == [0.5]
    assert toxicity.fit(empty, labels).evidence(empty).count() == 0


def test_language_on_held_out_rows(spark, documents):
    got = {r.doc_id: r for r in language_id.op7_language_id(spark, DATA).collect()}
    rows = documents.collect()
    assert all(got[r.doc_id].held_out == (held(r.doc_id) == 0) for r in rows)
    right = [got[r.doc_id].lang_pred == r.lang for r in rows if got[r.doc_id].held_out]
    assert sum(right) / len(right) > 0.95


def test_collapsed_scores_are_the_kernel_machines():
    r = np.random.default_rng(1)
    x = (r.random((40, language_id.BITS)) < 0.01).astype(np.uint8)
    y = np.where(r.random((40, 3)) < 0.5, 1.0, -1.0)
    marks = np.arange(0, 40, 4)
    weights = language_id.solve(np.packbits(x, axis=1), y, marks, 1e-3)
    unit = x / np.sqrt(x.sum(axis=1, keepdims=True))
    kernel = unit @ unit[marks].T
    values, vectors = np.linalg.eigh(unit[marks] @ unit[marks].T)
    features = kernel @ (vectors / np.sqrt(values))
    want = features @ np.linalg.solve(features.T @ features + 1e-3 * 40 * np.eye(len(marks)), features.T @ y)
    assert np.allclose(unit @ weights, want, atol=1e-3)


def test_language_of_odd_rows(odd, empty):
    found = language_id.fit(odd).predict(odd, keep=["doc_id"], names=("l", "s", "b")).collect()
    assert len(found) == len(ODD) and {r.l for r in found} == {"en", "und"}
    assert all(r.l == "und" and r.s == 0 and not r.b for r in found if r.doc_id in (3, 4, 5, 10))
    assert {r.l for r in language_id.fit(empty).predict(odd, names=("l", "s", "b")).collect()} == {"und"}
    assert language_id.fit(odd).predict(empty, names=("l", "s", "b")).count() == 0


def plain_grams(text, longest=4):
    t = "".join(" " if ord(c) < 97 or 122 < ord(c) < 128 else c for c in text.lower())
    return {t[i : i + n] for n in range(1, longest + 1) for i in range(len(t) - n + 1)}


def test_query_equals_a_plain_kernel_machine(spark, documents):
    """The whole query against sets of n-grams as they are: kernels, landmarks and ridge regression without hashing."""
    rows = [r for r in documents.collect() if r.text and r.lang]
    fit_rows = [r for r in rows if held(r.doc_id) != 0]
    grams = {r.doc_id: plain_grams(r.text) for r in rows}
    languages = sorted({r.lang for r in fit_rows})
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    marks = [r for lang in languages for r in [x for x in fit_rows if x.lang == lang][:20]]
    own = np.array([[kernel(grams[a.doc_id], grams[b.doc_id]) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(own)
    root = vectors[:, values > 1e-6] / np.sqrt(values[values > 1e-6])
    features = lambda rs: np.array([[kernel(grams[a.doc_id], grams[b.doc_id]) for b in marks] for a in rs]) @ root
    x, y = features(fit_rows), np.array([[1.0 if r.lang == lang else -1.0 for lang in languages] for r in fit_rows])
    w = np.linalg.solve(x.T @ x + 1e-4 * len(x) * np.eye(x.shape[1]), x.T @ y)
    want = {r.doc_id: languages[k] for r, k in zip(rows, (features(rows) @ w).argmax(axis=1), strict=True)}
    got = {r.doc_id: r.lang_pred for r in language_id.op7_language_id(spark, DATA).collect()}
    assert sum(got[i] == want[i] for i in want) >= 0.98 * len(want)


def test_samples_of_any_count():
    """A share of a huge count is not rounded away; the limits hold that share of all 64-bit hashes."""
    for n in (1, 600, 601, 10**6, 7 * 10**8, 10**10, 10**15):
        share = (language_id.hash_limit(600 / n) + 2**63) / 2**64
        assert share == pytest.approx(min(1.0, 600 / n), rel=1e-6, abs=1e-18)


def test_what_belongs_to_no_language(spark, documents):
    """Scripts and jumbles that no language has are told from the texts of those learnt, which are kept."""
    r = random.Random(3)
    jumble = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (60, 300, 2000)]
    jumble += [" ".join("".join(r.choice("bcdfghjklmnpqrstvwxz") for _ in range(r.randint(2, 9))) for _ in range(n)) for n in (15, 100, 900)]
    strange = [*jumble, "это предложение на русском языке которое ни один из языков не знает", "这是一个中文句子用于测试语言识别的效果", "これは日本語の文章です。拒否されるべきです。", "αυτό είναι ένα κείμενο στα ελληνικά"]
    model = language_id.fit(documents)
    found = model.predict(spark.createDataFrame([(t,) for t in strange], "text string")).collect()
    assert [x.text[:20] for x in found if x.belongs] == []
    assert model.predict(documents).filter("NOT belongs").count() == 0


def tokens(text):
    return (text or "").encode().lower().split() + [b"<end>"]


def plain_model(texts):
    """Interpolated modified Kneser-Ney of pairs, with dictionaries."""
    pairs = Counter()
    for t in texts:
        w = tokens(t)
        pairs.update(zip([b"<begin>", *w[:-1]], w, strict=True))
    context, kinds, cont = Counter(), {}, Counter()
    for (u, v), n in pairs.items():
        context[u] += n
        kinds.setdefault(u, Counter())[min(n, 3)] += 1
        cont[v] += 1
    vocabulary = len(cont)

    def discounts(counts):
        n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        return lm_scoring.discounts(n)

    d, e, types = discounts(pairs.values()), discounts(cont.values()), len(pairs)
    mass = sum(e[min(c, 3)] for c in cont.values()) / types

    def p(u, v):
        low = max(cont[v] - e[min(cont[v], 3)], 0) / types + mass / (vocabulary + 1)
        if not context[u]:
            return low
        back = sum(d[k] * n for k, n in kinds[u].items()) / context[u]
        return max(pairs[u, v] - d[min(pairs[u, v], 3)], 0) / context[u] + back * low

    return p, set(cont)


def test_lm_query_against_plain_model(spark, documents):
    rows = documents.collect()
    train = [r.text for r in rows if held(r.doc_id, 7) != 2]
    p, vocabulary = plain_model(train)
    counts = Counter(w for t in train for w in tokens(t))
    n, v = counts.total(), len(counts)
    got = {r.doc_id: r for r in lm_scoring.op9_lm_scoring(spark, DATA).collect()}
    assert len(got) == len(rows)
    for r in rows:
        w, g = tokens(r.text), got[r.doc_id]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (held(r.doc_id, 7) == 2, len(w), sum(x in counts for x in w), n)
        assert g.base_score == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
        assert g.score == pytest.approx(sum(math.log10(p(a, b)) for a, b in zip([b"<begin>", *w[:-1]], w, strict=True)), rel=1e-9)
        assert g.perplexity == pytest.approx(10 ** (-g.score / len(w)), rel=1e-9)
    assert not list(Path(shared_dir(spark).removeprefix("file://")).glob("kneser-ney-*"))
    unseen = [g for g in got.values() if g.held_out]
    assert sum(g.score for g in unseen) > sum(g.base_score for g in unseen)
    for u in list(vocabulary)[:5] + [b"<begin>", b"never seen"]:
        assert sum(p(u, x) for x in vocabulary) + p(u, b"another") == pytest.approx(1, abs=1e-9)


def test_lm_of_odd_rows(odd, empty, monkeypatch):
    model = lm_scoring.train(odd)
    found = lm_scoring.scored(odd, model).collect()
    assert len(found) == len(ODD)
    p, _ = plain_model([t for _, t in ODD])
    by, by_row = {r.doc_id: r.score for r in found}, [r.score for r in found]
    for i, t in ODD:
        w = tokens(t)
        assert by[i] == pytest.approx(sum(math.log10(p(a, b)) for a, b in zip([b"<begin>", *w[:-1]], w, strict=True)), rel=1e-9)
    model.delete()
    monkeypatch.setattr(lm_scoring, "MAPS", 2)
    again = lm_scoring.train(odd)
    assert sorted(r.score for r in lm_scoring.scored(odd, again).collect()) == pytest.approx(sorted(by_row))
    again.delete()
    none = lm_scoring.train(empty)
    assert {r.score for r in lm_scoring.scored(odd, none).collect()} == {0.0}
    assert lm_scoring.scored(empty, none).count() == 0


def test_many_shards_add_up_to_the_same_model(spark, documents, monkeypatch):
    some = documents.limit(60)
    scores = []
    for direct in (128, 2):
        monkeypatch.setattr(lm_scoring, "DIRECT", direct)
        monkeypatch.setattr(lm_scoring, "partitions_for", lambda *_: 20)
        model = lm_scoring.train(some)
        scores.append(sorted((r.doc_id, r.score, r.n_known) for r in lm_scoring.scored(some, model).collect()))
        model.delete()
    assert [(i, k) for i, _, k in scores[0]] == [(i, k) for i, _, k in scores[1]]
    assert [x for _, x, _ in scores[0]] == pytest.approx([x for _, x, _ in scores[1]])


def test_a_failing_score_leaves_no_files(spark, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError("stopped")

    monkeypatch.setattr(lm_scoring, "scored", fail)
    with pytest.raises(RuntimeError, match="stopped"):
        lm_scoring.op9_lm_scoring(spark, DATA)
    assert not list(Path(shared_dir(spark).removeprefix("file://")).glob("kneser-ney-*"))


def test_packed_arrays():
    arrays = [np.array([], dtype=np.uint64), np.array([1, 255]), np.array([256]), np.array([2**63], dtype=np.uint64), np.array([70000] * 3)]
    for a, b in zip(arrays, lm_scoring.unpack(lm_scoring.pack(*arrays)), strict=True):
        assert a.tolist() == b.tolist()
