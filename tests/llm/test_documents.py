import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from skein.llm import chat, license_scan, sketches
from tests.conftest import DATA
from tests.llm.conftest import ODD


M64 = 2**64 - 1


def xx64(numbers, seed):
    """Spark's xxhash64 of longs, one after the other."""
    for x in numbers:
        seed = xxhash.xxh64_intdigest((x & M64).to_bytes(8, "little"), seed)
    return seed


def plain_sketch(text, size=5, fraction=0.25):
    """The hashes of a text's shingles below the fraction, and the least, as unsigned numbers."""
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.split("[\x20\x09-\x0d]+", (text or "").lower()) if w]
    runs = [words[i : i + size] for i in range(len(words) - size + 1)] if len(words) >= size else [words] * bool(words)
    hashes = {xx64(r, 42) for r in runs}
    return {h for h in hashes if h < fraction * 2**64 or h == min(hashes)}


def plain_likeness(a, b):
    least = min(len(a), len(b))
    return len(a & b) / least if least else float(len(a) == len(b))


def test_query_equals_a_plain_version(spark, documents):
    """Edited texts, fingerprints and both likenesses of every row."""
    rows = sorted(((r.doc_id, r.text) for r in documents.collect()), reverse=True)
    got = {r.doc_id: r for r in sketches.op10_fingerprints(spark, DATA).collect()}
    written = lambda s: "".join(f"{h:016x}" for h in sorted(s))
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        n, after = len(t) // 3, rows[(k + 1) % len(rows)][1]
        want = t[: len(t) - n] + after[:n]
        g, own, edited = got[i], plain_sketch(t), plain_sketch(want)
        assert (g.n_chars, g.edited_sha256) == (len(t), hashlib.sha256(want.encode()).hexdigest())
        assert (g.fingerprint, g.edited_fingerprint) == (written(own), written(edited))
        assert g.near_edited == pytest.approx(plain_likeness(own, edited))
        assert g.near_next == pytest.approx(plain_likeness(own, plain_sketch(after)))


def test_sketch_of_odd_rows(odd, empty):
    found = sketches.edited(odd).select("doc_id", "n_chars", sketches.as_text(F.col("sketch")).alias("f"), sketches.likeness(F.col("sketch"), F.col("next_sketch")).alias("x")).collect()
    assert len(found) == len(ODD) and all(0 <= r.x <= 1 for r in found)
    by = {r.doc_id: r for r in found}
    assert by[1].f == by[2].f != "" and by[3].f == by[4].f == by[5].f == "" and by[3].n_chars == 0
    assert sketches.edited(empty).count() == 0


def test_sketches_merge_and_estimate_containment(spark):
    r = random.Random(4)
    ws = [f"w{r.randrange(10**6)}" for _ in range(6000)]
    df = spark.createDataFrame([(" ".join(ws), " ".join(ws[:600]), " ".join(ws[3000:]), " ".join(ws[:3004]))], "a string, part string, tail string, head string")
    s = lambda c: sketches.sketch(F.col(c))
    got = df.select(sketches.containment(s("part"), s("a")), sketches.containment(s("a"), s("part")), sketches.merge(s("head"), s("tail")) == s("a"), sketches.likeness(s("part"), s("a"))).first()
    assert got[0] == 1 and abs(got[1] - 0.1) < 0.03 and got[2] and got[3] == 1


def test_native_plan(spark):
    plan = sketches.op10_fingerprints(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_alignment_is_increasing_and_finds_notices():
    r = random.Random(9)
    for _ in range(200):
        a, b = ([r.choice("abcdefgh") for _ in range(r.randint(0, 14))] for _ in range(2))
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    assert len(license_scan.align(list("abcdefg"), list("abxdefg"))) == 6
    assert license_scan.increasing([3, 1, 2, 5, 4]) in ([1, 2, 4], [1, 2, 3])


def plain_spans(scanner, text):
    """Every window of every notice, aligned without any bound before it."""
    words, out = license_scan.words_of(text), set()
    for k, (name, i, notice) in enumerate(scanner.notices):
        for start in range(0, len(words), max(1, len(notice) // 4)):
            pairs = license_scan.align(words[start : start + 2 * len(notice)], notice)
            if pairs and len(pairs) >= scanner.need[k]:
                out.add((name, len(pairs) / len(notice), i, start + pairs[0][0], start + pairs[-1][0] + 1))
    return out


def test_scanner_equals_a_plain_one():
    """Notices with words taken out, put in and repeated, among words of theirs and others, at any place."""
    r = random.Random(21)
    scanner = license_scan.Scanner(license_scan.NOTICES, 0.85, 0.7)
    pool = sorted(scanner.vocabulary)
    hits = 0
    for n in range(80):
        words = []
        for _ in range(r.randrange(1, 4)):
            words += [r.choice(pool) if r.random() < 0.5 else f"w{r.randrange(50)}" for _ in range(r.randrange(0, 60))]
            notice = r.choice(scanner.notices)[2]
            some = [w for w in notice if r.random() > 0.05 * (n % 5)]
            for _ in range(len(some) * (n % 4) // 12):
                some.insert(r.randrange(len(some)), r.choice(pool))
            words += some
        text = " ".join(words)
        found = set(scanner.spans(text))
        assert found == plain_spans(scanner, text)
        best = scanner.scan(text)
        held = sorted((f[3], f[4]) for f in best)
        assert set(best) <= found and len({f[0] for f in best}) == len(best)
        assert all(a[1] <= b[0] for a, b in zip(held, held[1:], strict=False))
        hits += bool(found)
    assert hits > 50


def test_notices_at_every_offset_and_beside_better_ones():
    """Foreign words in a notice's middle and its place in the text decide nothing; a license that lost one span keeps another."""
    scanner = license_scan.Scanner(license_scan.NOTICES, 0.85, 0.7)
    notice = license_scan.NOTICES["GPL-3.0"][1].split()
    for offset in range(0, 90, 7):
        text = ["x"] * offset + notice[:30] + ["y"] * 14 + notice[30:] + ["z"] * 50
        assert [f[0] for f in scanner.scan(" ".join(text))] == ["GPL-3.0"], offset
    cc = "Licensed under CC BY-NC 4.0. " + "word " * 40 + "Licensed under CC BY 4.0."
    assert {f[0] for f in scanner.scan(cc)} == {"CC-BY-NC-4.0", "CC-BY-4.0"}
    for name, notices in license_scan.NOTICES.items():
        for notice in notices:
            words = notice.split()
            assert [f[0] for f in scanner.scan(" ".join(words))] == [name]
            if len(words) >= license_scan.LONG:
                assert [f[0] for f in scanner.scan(" ".join(words[:9] + words[10:]))] == [name]


def test_licenses(spark, odd, empty):
    noise = "thing and other words " * 60
    cases = {
        1: (noise + "Licensed under the Apache License, Version 2.0. " + noise, {"Apache-2.0"}),
        2: ("RELEASED under the\nMIT license!! " + noise + " Licensed under CC BY-NC 4.0.", {"MIT", "CC-BY-NC-4.0"}),
        3: (noise + license_scan.NOTICES["GPL-3.0"][1].replace("redistribute", "share"), {"GPL-3.0"}),
        4: (noise + "licensed under nothing, released under the moon", set()),
        5: ("This work is licensed under the GNU General Public License, version 3. " * 50, {"GPL-3.0"}),
        6: (None, set()),
    }
    df = spark.createDataFrame([(i, t) for i, (t, _) in cases.items()], "doc_id long, text string")
    found = {}
    for row in license_scan.scan_licenses(df).collect():
        found.setdefault(row.doc_id, set()).add(row.license)
        words = license_scan.words_of(cases[row.doc_id][0])[row.first_word : row.end_word]
        assert row.coverage >= 0.7 and words[0] in license_scan.words_of(license_scan.NOTICES[row.license][row.notice])
    assert found == {i: s for i, (_, s) in cases.items() if s}
    assert license_scan.scan_licenses(odd).count() == 0 and license_scan.scan_licenses(empty).count() == 0


def test_license_query_has_no_false_finds(spark, documents):
    """Each find's words, against the notice: nothing that is not the notice, but for the share that may be missing."""
    texts = {r.doc_id: license_scan.words_of(r.text) for r in documents.collect()}
    found = license_scan.op8_license_scan(spark, DATA).collect()
    assert found
    for r in found:
        notice = license_scan.words_of(license_scan.NOTICES[r.license][r.notice])
        assert len(license_scan.align(texts[r.doc_id][r.first_word : r.end_word], notice)) >= 0.7 * len(notice)
    scanner = license_scan.Scanner(license_scan.NOTICES, 0.85, 0.7)
    for i, words in texts.items():
        if len(words) < 400:
            want = {f[0] for f in plain_spans(scanner, " ".join(words))}
            assert {r.license for r in found if r.doc_id == i} <= want and bool(want) == any(r.doc_id == i for r in found)


def test_license_query_against_plain_search(spark, documents):
    found = {(r.doc_id, r.license) for r in license_scan.op8_license_scan(spark, DATA).collect()}
    plain = {(r.doc_id, name) for r in documents.collect() for name, ts in license_scan.NOTICES.items() for t in ts if t in r.text}
    assert plain <= found


def test_preferences(spark):
    turns = [("a", 0, "user", "hi"), ("a", 1, "assistant", "yes"), ("b", 0, "user", "hi"), ("b", 1, "assistant", "no"), ("b", 2, "user", None), ("c", 0, None, "lone")]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id string, turn int, role string, text string, side int")
    turns_df = chat.turns_of(df)
    convs = chat.conversations(turns_df)
    rows = sorted(chat.preferences(chat.pair_up(turns_df)).collect(), key=lambda r: r.pair_id)
    assert len(rows) == 2 and {i for r in rows for i in (r.chosen_id, r.rejected_id)} == {"a", "b", "c", None}
    pair = convs.alias("x").join(convs.alias("y"), F.expr("x.conv_id = 'a' AND y.conv_id = 'b'")).selectExpr("0 AS pair_id", "x.conv_id AS chosen_id", "x.turns AS chosen", "y.conv_id AS rejected_id", "y.turns AS rejected")
    r = chat.preferences(pair).first()
    assert (r.n_common, r.prompt, r.chosen, r.rejected) == (1, "<|user|>\nhi\n", "<|assistant|>\nyes\n", "<|assistant|>\nno\n<|user|>\n\n")
    assert sum(m.chars for m in r.rejected_mask) == len(r.rejected) and [tuple(m) for m in r.chosen_mask] == [(14, False), (4, True)]
    assert chat.preferences(chat.pair_up(chat.turns_of(df.filter("false")))).count() == 0


def sql_rows(df, conversations):
    """The query's SQL over a table, and the query's rows in its columns' order."""
    import duckdb

    con = duckdb.connect()
    con.register("conversations", conversations)
    rel = con.sql(chat.OP1_SQL)
    return sorted(map(tuple, df.select(*rel.columns).collect()), key=repr), sorted(rel.fetchall(), key=repr)


def test_preferences_against_sql(spark):
    got, want = sql_rows(entry.queries()["op1_chat_preferences"](spark, DATA), spark.read.parquet(f"{DATA}/conversations.parquet").toArrow())
    assert got == want


def test_preferences_of_odd_rows_against_sql(spark, tmp_path):
    """Equal openings in groups of every size, null ids, roles, texts and numbers, repeated turns, ties, a long text, columns that clash."""
    r = random.Random(11)
    rows = []
    for c in range(60):
        n = r.randrange(1, 5)
        rows += [(c, k, r.choice(["user", "assistant", None]), r.choice(["hi", "yes", "no", None, ""])) for k in range(n)]
    rows += [(None, 0, "user", "hi"), (None, 1, "assistant", "yes"), (None, 1, "assistant", "yes"), (70, None, "user", "hi"), (70, None, "user", "ho")]
    rows += [(71, 0, "user", "hi"), (71, 0, "user", "hi"), (72, 0, "user", "long " * 50_000), (73, 0, "user", "long " * 50_000 + "more")]
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "conv_id long, turn long, role string, text string, side int, pair_id int")
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got, want = sql_rows(chat.op1_chat_preferences(spark, str(tmp_path)), df.select("conv_id", "turn", "role", "text").toArrow())
    assert got == want and len(got) > 25


def test_all_that_open_alike_are_paired(spark):
    """Groups of every size, one of them over many ranges: only one of an odd group is paired with a stranger."""
    sizes = [1, 2, 3, 1, 2, 200, 5, 4, 1, 75]
    rows = [(100 * 1000 * k + j, 0, "user", f"opening {k}") for k, n in enumerate(sizes) for j in range(n)]
    opening = {i: text for i, _, _, text in rows}
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(4)
    got = chat.preferences(chat.pair_up(chat.turns_of(df))).collect()
    assert sorted(i for r in got for i in (r.chosen_id, r.rejected_id) if i is not None) == sorted(opening)
    assert len({r.pair_id for r in got}) == len(got) and sum(r.rejected_id is None for r in got) == sum(sizes) % 2
    assert sum(r.n_common == 1 for r in got) == sum(n // 2 for n in sizes)


@pytest.mark.parametrize("name", ["text_bytes", "edited_texts"])
def test_queries_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    rel = con.sql(entry.oracle_sql()[name])
    df = entry.queries()[name](spark, DATA)
    assert sorted(map(tuple, df.select(*rel.columns).collect())) == sorted(rel.fetchall())
