import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash

from skein.llm import decontamination, simhash_dedup
from skein.llm.common import shared_dir
from skein.llm.components import Rounds, components
from tests.conftest import DATA
from tests.llm.conftest import ODD


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, radius=4):
    """(id, fingerprint) rows to component ids, by comparing all."""
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    low = {}
    for i, f in pairs:
        if i is not None:
            low[find(f)] = min(low.get(find(f), i), i)
    return [(i, f, low.get(find(f))) for i, f in pairs]


def test_query_against_brute_force(spark, documents):
    found = simhash_dedup.op5_simhash_dedup(spark, DATA).collect()
    assert all(len(r.fingerprint) == 16 for r in found)
    got = sorted((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in found)
    assert got == sorted(plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in documents.collect()]))


def test_odd_rows(odd, empty):
    found = simhash_dedup.near_duplicates(odd).collect()
    want = plain_components([(i, plain_fingerprint(t)) for i, t in ODD])
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in found), key=repr) == sorted(want, key=repr)
    assert simhash_dedup.near_duplicates(empty).count() == 0


def test_links_of_crowded_fingerprints(spark, monkeypatch):
    """Thousands of near fingerprints around a few centres, in tiles far smaller than the groups."""
    monkeypatch.setattr(simhash_dedup, "TILE", 64)
    r = random.Random(3)
    values = set()
    for _ in range(3):
        centre = r.getrandbits(64)
        for _ in range(120):
            v = centre
            for b in r.sample(range(64), r.randint(0, 7)):
                v ^= 1 << b
            values.add(v)
    values |= {r.getrandbits(64) for _ in range(300)}
    signed = [v - 2**64 if v >> 63 else v for v in values]
    edges = simhash_dedup.links(spark.createDataFrame([(v,) for v in signed], "fp long"))
    labels = {n.node: n.label for n in components(edges).collect()}
    mine = Counter(labels.get(v, v) for v in signed)
    want = Counter(c for _, _, c in plain_components([(v, v % 2**64) for v in signed]))
    assert sorted(mine.values()) == sorted(want.values())
    for e in edges.collect():
        assert labels[e.a] == labels[e.b]


def plain_labels(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    return {x: find(x) for x in list(root)}


def same_partition(got, want):
    assert got.keys() == want.keys()
    pairs = {(got[x], want[x]) for x in got}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_components_of_a_long_chain(spark, monkeypatch):
    """Ten thousand nodes in a row take some log n rounds, two writes a round and one more on the way back."""
    order = list(range(10_000))
    random.Random(1).shuffle(order)
    pairs = [(min(a, b), max(a, b)) for a, b in zip(order, order[1:], strict=False)] + [(100_000, 100_001)]
    writes = []
    monkeypatch.setattr(Rounds, "write", lambda self, df, f=Rounds.write: writes.append(1) or f(self, df))
    found = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    same_partition({r.node: r.label for r in found}, plain_labels(pairs))
    assert len(writes) <= 3 * 20
    assert not [p for p in Path(shared_dir(spark).removeprefix("file://")).glob("components-*") if p.exists()]


def test_components_of_random_graphs(spark):
    r = random.Random(5)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(7, 1000 + i) for i in range(200)] + [(2000, 2000)]
    found = components(spark.createDataFrame(pairs, "a long, b long").repartition(3)).collect()
    got = {n.node: n.label for n in found}
    want = plain_labels(pairs)
    same_partition({k: v for k, v in got.items() if k != 2000}, {k: v for k, v in want.items() if k != 2000})
    assert all(got[v] == v for v in got.values())
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def words(n, seed):
    r = random.Random(seed)
    return [f"w{r.randrange(10**6)}" for _ in range(n)]


def grams_of(ws, size=5):
    return Counter(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)) if len(ws) >= size else Counter([tuple(ws)] if ws else [])


def plain_contaminated(docs, items, size=5, similarity=0.8):
    """Every window of every item's length in every document, cut to the text, by multiset similarity alone."""
    out = set()
    for i, t in docs:
        ws = (t or "").lower().split()
        own = grams_of(ws, size).keys()
        for k, it in items:
            w = (it or "").lower().split()
            if not w:
                continue
            b = grams_of(w, size)
            if len(w) >= size and not b.keys() & own:
                continue  # no window can share a shingle
            for s in range(1 - len(w), len(ws)):
                a = grams_of(ws[max(s, 0) : s + len(w)], size)
                inter = sum((a & b).values())
                if inter and inter / (a | b).total() >= similarity:
                    out.add((i, k))
                    break
    return out


def test_decontamination(spark):
    items = [(k, " ".join(words(30 + k, k))) for k in range(8)] + [(8, "only three words"), (9, ""), (10, None), (11, " ".join(["same"] * 20))]
    docs = []
    for d in range(60):
        ws = words(100, 100 + d)
        k = d % 8
        part = items[k][1].split()
        if d % 3 == 0:
            part[0] = "Changed"
        if d % 5 == 0:
            part[len(part) // 2 :] = words(len(part) // 2, d)
        if d % 2:
            ws[d % 50 : d % 50] = part
        docs.append((d, " ".join(ws).upper() if d % 4 == 1 else " ".join(ws)))
    docs += [(100, items[3][1]), (101, "say only three words now"), (102, None), (103, ""), (104, "same " * 30), (105, " ".join(items[2][1].split()[:10])), (105, items[5][1]), (None, items[1][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    found = decontamination.contaminated(df, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == plain_contaminated(docs, items)
    assert all(r.similarity >= 0.8 and r.hamming <= 17 for r in found.collect())
    assert decontamination.contaminated(df.filter("false"), bench).count() == 0
    assert decontamination.contaminated(df, bench.filter("false")).count() == 0


def test_decontamination_query(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in decontamination.op6_decontamination(spark, DATA).collect()}
    assert got == plain_contaminated([(r.doc_id, r.text) for r in documents.collect()], items)


def test_index_meets_what_is_within_the_radius(spark):
    """Fingerprints at every distance from an item's: all within the radius are met, and under a tenth of strangers."""
    r = random.Random(12)
    items = [(k, 30, r.getrandbits(64) - 2**63) for k in range(40)]
    windows = [(1000 * k + d, 30, None, None, f ^ sum(1 << b for b in r.sample(range(63), d))) for k, _, f in items for d in range(25)]
    w = spark.createDataFrame([(k, n, f) for k, n, _, _, f in windows], "key long, n int, fp long")
    index = spark.createDataFrame(items, "item_id long, n int, item_fp long")
    met = decontamination.candidates(w, index, 17, 4).select("key", "item_id").distinct()
    met = {(m.key, m.item_id) for m in met.collect()}
    assert all((1000 * k + d, k) in met for k in range(40) for d in range(18))
    assert sum(i != k // 1000 for k, i in met) < 0.12 * len(windows) * 39
    assert decontamination.candidates(w.filter("false"), index, 17, 4).count() == 0
    for radius, blocks in ((0, 4), (5, 8)):
        met = {(m.key, m.item_id) for m in decontamination.candidates(w, index, radius, blocks).select("key", "item_id").collect()}
        assert all((1000 * k + d, k) in met for k in range(40) for d in range(radius + 1))


@pytest.mark.parametrize("n", [8, 20, 60])
def test_recall_of_edited_items(spark, n):
    """Items of n words with words changed here and there, in texts short and long: what brute force finds is found."""
    r = random.Random(n)
    items = [(k, " ".join(words(n, 1000 * n + k))) for k in range(12)]
    docs = []
    for d in range(60):
        part = items[d % 12][1].split()
        for at in r.sample(range(n), min(n // 12, d % 3)):
            part[at] = "edited"
        part = part[d % 4 if d % 5 == 0 else 0 :]
        before, after = (words(r.randrange(0, 40), d), words(0 if d % 7 == 0 else r.randrange(0, 3000 if d % 9 == 0 else 60), 500 + d))
        docs.append((d, " ".join(before + part + after)))
    want = plain_contaminated(docs, items)
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontamination.contaminated(df, bench).collect()}
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) >= 10


def test_native_plans_have_no_python(spark, documents):
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    plan = decontamination.contaminated(documents, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_similarity_of_multisets(spark):
    from pyspark.sql import functions as F

    from skein.llm.native import numbered, shared_share

    r = random.Random(6)
    rows = [([r.randrange(6) for _ in range(r.randrange(9))], [r.randrange(6) for _ in range(r.randrange(9))]) for _ in range(300)]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>").select("a", "b", shared_share(numbered(F.col("a")), numbered(F.col("b"))).alias("s"))
    for row in df.collect():
        a, b = Counter(row.a), Counter(row.b)
        assert row.s == pytest.approx((a & b).total() / (a | b).total() if row.a or row.b else 0)


def test_native_simhash_is_the_majority(spark):
    from pyspark.sql import functions as F

    from skein.llm.native import simhash

    r = random.Random(2)
    sets = [[r.getrandbits(64) - 2**63 for _ in range(n)] for n in (0, 1, 2, 5, 40)]
    df = spark.createDataFrame([(s,) for s in sets], "a array<long>").select("a", simhash(F.col("a")).alias("f"))
    for row in df.collect():
        bits = np.array([[(x >> b) & 1 for b in range(64)] for x in row.a]).reshape(-1, 64)
        want = sum(1 << b for b in range(64) if 2 * bits[:, b].sum() > len(row.a))
        assert row.f % 2**64 == want


def test_reordered_passages_are_found(spark):
    """An item whose halves or thirds have changed places, anywhere in a text, against every window of the text."""
    items = [(k, " ".join(words(60, 900 + k))) for k in range(3)]
    docs = []
    for d, at in enumerate((0, 1, 100, 140)):
        for k, cuts in enumerate(((30,), (25,), (20, 40))):
            w, around = items[k][1].split(), words(140, 50 + d)
            parts = [w[a:b] for a, b in zip((0, *cuts), (*cuts, 60), strict=True)]
            docs.append((10 * d + k, " ".join(around[:at] + sum(reversed(parts), []) + around[at:])))
    want = plain_contaminated(docs, items)
    assert len(want) >= 8
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench).collect()} == want
