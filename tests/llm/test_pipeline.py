import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skein.llm import near_copies
from tests.conftest import DATA
from tests.llm.test_simhash import plain_contaminated, plain_labels
from tests.llm.test_tokens import check_pieces


def five_grams(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def plain_survivors(rows):
    """Least ids of the groups of rows (id, text) that a Jaccard of 0.8 links, by comparing all that share a shingle."""
    sets = [five_grams(t) for _, t in rows]
    holders, pairs = {}, []
    for i, s in enumerate(sets):
        for g in s or [()]:
            holders.setdefault(g, []).append(i)
    seen = set()
    for some in holders.values():
        for i, a in enumerate(some):
            for b in some[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    x, y = sets[a], sets[b]
                    if (not x and not y) or 5 * len(x & y) >= 4 * len(x | y):
                        pairs.append((a, b))
    labels = plain_labels([*pairs, *((i, i) for i in range(len(rows)))])
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[labels[i]] = min(low.get(labels[i], doc), doc)
    return sorted(low.values())


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_what_they_should(spark, documents):
    """Each stage against a plain version of its decision, on its own input."""
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "language", "near_dedup", "decontamination", "packing"]
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    kept = stages["language"](spark, documents, DATA)
    assert kept.columns == documents.columns and ids(kept) == sorted(i for i, _ in rows)
    once = stages["near_dedup"](spark, documents, DATA)
    assert once.columns == documents.columns and ids(once) == plain_survivors(rows)
    clean = stages["decontamination"](spark, documents, DATA)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    bad = {i for i, _ in plain_contaminated(rows, items)}
    assert clean.columns == documents.columns and ids(clean) == sorted(i for i, _ in rows if i not in bad)


def test_toxicity_stage_decides_as_the_labels_do(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = corpus_pipeline.toxicity_stage(spark, docs.join(labels, "doc_id", "left_semi"), folder)
    left, known = set(ids(kept)), {r.doc_id: r.toxic for r in labels.collect()}
    assert sorted(kept.columns) == sorted(docs.columns)
    assert sum(i not in left for i, y in known.items() if y) > 0.9 * sum(known.values())
    assert sum(i in left for i, y in known.items() if not y) > 0.99 * sum(not y for y in known.values())


def test_packing_stage_packs_all(spark, documents):
    rows = corpus_pipeline.packing_stage(spark, documents, DATA).collect()
    used, room = check_pieces(rows, {r.doc_id: [r.text] for r in documents.collect()})
    assert used > 0.98 * room


def test_stages_of_odd_rows(spark, odd, empty):
    """Nulls, empty, very long and repeated texts, null and repeated ids, and columns named like the stages' own."""
    clashing = ["evidence", "belongs", "Lang_Pred", "of_id", "of_key", "stays", "own_key", "held_key", "text_key", "key", "a.b"]
    docs = odd
    for c in clashing:
        docs = docs.drop(c).withColumn(c, F.lit(7))
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, DATA)
        found = [(r.doc_id, r.text) for r in kept.collect()]
        assert kept.columns == docs.columns and Counter(found) <= Counter(rows), name
        assert {tuple(r[c] for c in clashing) for r in kept.collect()} <= {(7,) * len(clashing)}
        none = stage(spark, docs.filter("false"), DATA)
        assert none.count() == 0 and none.columns == docs.columns
        if name == "language":
            assert {i for i, _ in found} <= {i for i, t in rows if t and any(map(str.isalpha, t))}
        if name == "near_dedup":
            assert len(found) == len({five_grams(t) for _, t in rows}) and (3, None) in found and (6, "word") in found
        if name == "decontamination":
            assert Counter(found) == Counter(rows)
    check_pieces(corpus_pipeline.packing_stage(spark, docs, DATA).collect(), {i: [t for k, t in rows if k == i] for i, _ in rows})
    assert corpus_pipeline.packing_stage(spark, empty, DATA).count() == 0


def test_language_stage_rejects_what_belongs_to_none(spark, documents):
    strange = ["это предложение на русском языке которое ни один из языков не знает", "qx zvk wjp bnm rtx qqz kkw vvx pzj qwk jxz mnz bvq zzk", None, "", "123 456"]
    extra = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(strange)], "doc_id long, text string")
    both = documents.unionByName(extra, allowMissingColumns=True)
    assert ids(corpus_pipeline.language_stage(spark, both, DATA)) == ids(documents)


def test_rows_of_one_id_have_their_own_fate(spark):
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").first().text
    rows = [(None, f"some words before {item} and after"), (None, "a clean text of some words"), (4, item), (4, "another clean text")]
    kept = corpus_pipeline.decontamination_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), DATA)
    assert sorted((r.text for r in kept.collect())) == ["a clean text of some words", "another clean text"]


def test_run(spark, documents):
    rows = corpus_pipeline.run(spark, DATA).collect()
    kept = {r.doc_id for r in rows}
    assert 0.5 * documents.count() < len(kept) < documents.count()
    for i in kept:
        own = [r for r in rows if r.doc_id == i]
        assert sum(r.length for r in own) == own[0].doc_tokens


def near_dedup(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, corpus_pipeline.dedup_stage(spark, df, DATA).collect()), key=repr)


def test_near_copies_of_similarity_four_fifths(spark):
    """Pairs around a Jaccard of 0.8, whose fingerprints differ in many bits, against the definition; null ids too."""
    r = random.Random(8)
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    rows, gone = [], 0
    for k in range(40):
        a = [f"w{r.randrange(10**6)}" for _ in range(120)]
        b = list(a)
        for at in r.sample(range(10, 110), 1 + k % 4):
            b[at] = "changed"
        x, y = grams(a), grams(b)
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
        gone += len(x & y) / len(x | y) >= 0.8
    assert 10 < gone < 40
    assert len(near_dedup(spark, rows)) == len(rows) - gone


def test_hot_shingles_are_dealt_and_miss_nothing(spark, monkeypatch):
    """Hundreds of texts with shingles in common, some of them near copies, every common shingle dealt over parts."""
    r = random.Random(4)
    base = [f"w{r.randrange(10**6)}" for _ in range(80)]
    rows = []
    for k in range(160):
        own = list(base[: r.choice([20, 60, 80])])
        for at in r.sample(range(len(own)), r.choice([0, 1, 2])):
            own[at] = f"x{r.randrange(3)}"
        rows.append((k, " ".join(own + [f"y{r.randrange(4)}" for _ in range(r.choice([0, 3]))])))
    want = len(plain_survivors(rows))
    assert len(near_dedup(spark, rows)) == want
    monkeypatch.setattr(near_copies, "HOT", 5)
    monkeypatch.setattr(near_copies, "SAMPLE", 60)
    assert len(near_dedup(spark, rows)) == want


@pytest.mark.parametrize("sample", [5_000, 1])
def test_a_large_group_makes_no_square_of_candidates(spark, monkeypatch, sample):
    """Near copies that only those of few edits hold together, and strangers with most of the same passage, whether
    their common shingles are known to be common or not."""
    r = random.Random(6)
    base = [f"w{r.randrange(10**6)}" for _ in range(140)]
    rows = []
    for k in range(400):
        own = list(base)
        for at in r.sample(range(len(own)), r.choice([1, 2, 3, 3, 3, 6, 9])):
            own[at] = f"x{r.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    counts, plain = [], near_copies.verified

    def verified(tables, pairs, *args):
        counts.append(pairs.count())
        return plain(tables, pairs, *args)

    monkeypatch.setattr(near_copies, "SAMPLE", sample)
    monkeypatch.setattr(near_copies, "verified", verified)
    assert sorted(i for i, _ in near_dedup(spark, rows)) == plain_survivors(rows)
    assert sum(counts) < 20 * len(rows), counts


def test_rows_of_null_and_repeated_ids_keep_their_texts(spark):
    texts = [f"text number {k} of its own with words like {k * 7} and {k * 13} to tell it from the others" for k in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (3, texts[2]), (3, texts[3]), (3, texts[3]), (4, texts[3]), (None, texts[4]), (9, texts[4]), (10, texts[5])]
    want = [(None, texts[0]), (None, texts[1]), (3, texts[2]), (3, texts[3]), (9, texts[4]), (10, texts[5])]
    assert near_dedup(spark, rows) == sorted(want, key=repr)
    assert near_dedup(spark, [(None, None), (None, ""), (1, " ")]) == [(1, " ")]


def test_every_stage_shrinks_heaps_first(spark, documents):
    """Stages run in one session, and an executor's memory holds what earlier ones have grown its heap to."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans
    full = lambda: sum(b.getCollectionCount() for b in beans() if "Old" in b.getName() or "MarkSweep" in b.getName())
    for name, stage in corpus_pipeline.STAGES:
        if name in ("language", "decontamination", "packing"):  # toxicity's fit collects on its own; near_dedup takes long
            before = full()
            stage(spark, documents.filter("false"), DATA)
            assert full() > before, name
