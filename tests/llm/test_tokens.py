import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skein.llm import packing, token_counts
from skein.llm.encoder import ChunkEncoder
from tests.conftest import DATA
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER, ENCODER = token_counts.TokenCounter(PATH), ChunkEncoder(PATH)

PIECES = [" ", "  ", "\n", "\t", "a", "foo", "'s", "É", "<|endoftext|>", "<|end", "1", ".", " ", "　", "日本", "😀", "\x85", "\x1c", "_", "٣", "aaaa", "hahaha", "...", "the"]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=4)), max_size=14).map("".join))
def test_ids_and_counts_are_the_librarys(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ENCODER.encode([text]) == [np.array(ids(text), dtype="<u4").tobytes()]
    assert COUNTER.count([text]) == [len(ids(text))]


def test_long_pretokens_and_small_memos():
    r = random.Random(5)
    long = ["a" * 50000, "".join(r.choice("abcdefghij") for _ in range(20000)), "-" * 9999]
    assert COUNTER.count(long) == [len(ids(t)) for t in long]
    assert ENCODER.encode([f"x {t} y" for t in long]) == [np.array(ids(f"x {t} y"), dtype="<u4").tobytes() for t in long]
    assert max(map(len, ENCODER.memo)) <= 48
    han = ["".join(chr(0x4E00 + r.randrange(5000)) for _ in range(3000)) for _ in range(4)]
    assert COUNTER.count(han) == [len(ids(t)) for t in han]
    assert max(map(len, COUNTER.memo)) <= 48
    small = token_counts.TokenCounter(PATH, memo=2)
    texts = ["one two three", "three four", "one five"] * 3
    assert [small.count([t])[0] for t in texts] == [len(ids(t)) for t in texts]
    little = ChunkEncoder(PATH, memo=1)
    assert [little.encode([t])[0] for t in texts] == [np.array(ids(t), dtype="<u4").tobytes() for t in texts]


def test_counts_query(spark, documents):
    got = {r.doc_id: r for r in token_counts.op4_token_counts(spark, DATA).collect()}
    want = {r.doc_id: r.text for r in documents.collect()}
    assert len(got) == len(want)
    for i, t in want.items():
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(t.encode()), len(ids(t)), len(ids(t)) > 1024)


def test_counts_of_odd_rows(odd, empty):
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(odd, PATH).collect()), key=repr)
    assert got == sorted(((i, len((t or "").encode()), len(ids(t))) for i, t in ODD), key=repr)
    assert token_counts.count_tokens(empty, PATH).count() == 0


def check_pieces(rows, want, capacity=1024):
    """Pieces restore every sequence, windows have no gaps or overlaps, and none is over full."""
    docs, windows = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
    for i, texts in want.items():
        tokens = [ids(t) + [0] for t in texts]
        if len(tokens) == 1:
            at = 0
            for r in sorted(docs[i], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(tokens[0])
                assert r.ids_crc32 == zlib.crc32(np.array(tokens[0][at : at + r.length], dtype="<u4").tobytes())
                at += r.length
            assert at == len(tokens[0])
        else:
            assert sum(r.length for r in docs[i]) == sum(map(len, tokens))
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
    return sum(r.length for r in rows), len(windows) * capacity


def test_packing_round_trip(spark, documents):
    want = {r.doc_id: [r.text] for r in documents.collect()}
    rows = packing.op2_packing(spark, DATA).collect()
    used, room = check_pieces(rows, want)
    assert used > 0.98 * room
    short = {}
    for r in rows:
        if r.doc_tokens <= 1024:
            short.setdefault(r.doc_id, set()).add(r.sequence_id)
    assert sum(map(len, short.values())) <= 1.5 * len(short)


def test_packing_of_odd_rows(odd, empty):
    want = {}
    for i, t in ODD:
        want.setdefault(i, []).append(t)
    check_pieces(packing.packed(odd).collect(), want)
    assert packing.packed(empty).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60), st.sampled_from([0.0, 0.05, 10.0]))
def test_windows_hold_their_parts(sizes, padding):
    """Every token of every part is in one window, none is over full, and few parts are cut."""
    windows = packing.pack_parts(np.array(sizes), 64, padding)
    pieces = sorted(p for w in windows for p in w)
    assert [p for p in pieces if p[2] <= 0] == [] and all(sum(p[2] for p in w) <= 64 for w in windows)
    for i, size in enumerate(sizes):
        at = 0
        for _, start, length in (p for p in pieces if p[0] == i):
            assert start == at
            at += length
        assert at == size
    least = -(-sum(sizes) // 64)
    assert least <= len(windows) <= max(least, -(-sum(sizes) * (1 + padding) // 64))
    if padding == 10.0:
        assert len(pieces) == len(sizes)


def plain_differencing(sizes, k):
    """Largest differencing with whole arrays of k loads: the least spread that is left."""
    parts = [[0] * (k - 1) + [s] for s in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1])
        a, b = parts.pop(0), parts.pop(0)
        loads = sorted(x + y for x, y in zip(a, reversed(b), strict=True))
        parts.append([x - loads[0] for x in loads])
    return parts[0][-1]


@pytest.mark.parametrize("k", [2, 3, 7, 20])
def test_differencing_equals_a_plain_version(k):
    r = random.Random(k)
    sizes = r.sample(range(1, 10**9), 50)  # distinct, so that no tie decides
    groups = packing.differencing(np.array(sizes), k)
    sums = [sum(sizes[i] for i in g) for g in groups]
    assert max(sums) - min(sums) == plain_differencing(sizes, k)


def test_differencing_is_near_equal():
    sizes = np.array([8, 7, 6, 5, 4])
    assert sorted(sum(sizes[g]) for g in packing.differencing(sizes, 2)) == [14, 16]
    assert [len(g) for g in packing.differencing(np.array([5]), 3)].count(1) == 1


@pytest.mark.parametrize("k", [1, 2, 5])
def test_differencing_keeps_all(k):
    sizes = np.arange(1, 40)
    assert sorted(i for g in packing.differencing(sizes, k) for i in g) == list(range(39))
