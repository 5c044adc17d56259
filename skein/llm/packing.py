"""Packing of tokenised texts into fixed windows by multiway differencing.

A text longer than a window gives whole windows first; what is left of it is one part. The parts of one batch are dealt
over k windows by Karmarkar-Karp multiway differencing: each part starts as a partial partition of its own, and the two
partial partitions of the largest imbalance are merged, the heaviest loads of one on the lightest of the other, until
one is left: near-equal windows. k starts at the least count that could hold the batch, and rises while a window exceeds
its capacity, as long as the batch's padding stays within `padding`. What then still exceeds is cut off the largest part
of its window and fills the gaps of others, the largest pieces first, each in the smallest gap that holds it; so a part
is cut only where windows of whole parts would be padded further. Batches are bounded, so memory and time a batch are
too, and every task packs its own.

Nulls count as empty text (its sequence is the end token alone); repeated rows, ties and null ids are packed as they
are; a very long text is encoded whole and leaves whole windows; an empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import chunks, small_batches, table, texts
from skein.llm.encoder import MEMO, worker_encoder

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def differencing(sizes: np.ndarray, k: int) -> list[list[int]]:
    """k groups of the sizes' positions, of near-equal sums, by multiway largest differencing.

    A partial partition is the ascending loads of those of its k groups that have members, and these members; the other
    groups' loads are zero. Its imbalance is the largest load less the least.
    """
    if k == 1:
        return [list(range(len(sizes)))]
    heap = [(-size, i, [size], [[i]]) for i, size in enumerate(sizes.tolist())]
    heapq.heapify(heap)
    n = len(heap)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        if len(a) < len(b):
            a, in_a, b, in_b = b, in_b, a, in_a
        n += 1
        if len(b) == 1:  # on the lightest of a, or into an empty group
            load, group = b[0], in_b[0]
            if len(a) == k:
                load, group = load + a.pop(0), group + in_a.pop(0)
            at = bisect_left(a, load)
            a.insert(at, load)
            in_a.insert(at, group)
            heapq.heappush(heap, ((a[0] if len(a) == k else 0) - a[-1], n, a, in_a))
            continue
        shared = len(a) + len(b) - k  # so many groups have members in both: the lightest of each, crosswise
        loads, members = a[max(shared, 0) :] + b[max(shared, 0) :], in_a[max(shared, 0) :] + in_b[max(shared, 0) :]
        for i in range(shared):
            loads.append(a[i] + b[shared - 1 - i])
            members.append(in_a[i] + in_b[shared - 1 - i])
        order = sorted(range(len(loads)), key=loads.__getitem__)
        loads, members = [loads[i] for i in order], [members[i] for i in order]
        heapq.heappush(heap, ((loads[0] if len(loads) == k else 0) - loads[-1], n, loads, members))
    return [sorted(g) for g in heap[0][3]]


def pack_parts(sizes: np.ndarray, capacity: int, padding: float) -> list[list[tuple[int, int, int]]]:
    """Windows of (position, start, length): the parts of `sizes`, each at most `capacity`, whole or cut."""
    total = int(sizes.sum())
    k, most = max(1, math.ceil(total / capacity)), max(1, math.ceil(total * (1 + padding) / capacity))
    while True:
        groups = differencing(sizes, k)
        if k == most or max(int(sizes[g].sum()) for g in groups) <= capacity:
            break
        k += max(1, (most - k) // 2)
    windows = [[(i, 0, int(sizes[i])) for i in g] for g in groups]
    room = [capacity - sum(p[2] for p in w) for w in windows] + [capacity] * (k - len(windows))
    windows += [[] for _ in range(k - len(windows))]
    over: list[tuple[int, int, int]] = []
    for w, r in zip(windows, room, strict=True):
        while r < 0:
            at = max(range(len(w)), key=lambda j: w[j][2])
            i, start, length = w.pop(at)
            cut = min(length, -r)
            if cut < length:
                w.append((i, start, length - cut))
            over.append((i, start + length - cut, cut))
            r += cut
    gaps = sorted((r, j) for j, r in enumerate(room) if r > 0)
    for i, start, length in sorted(over, key=lambda p: -p[2]):
        while length:
            at = min(bisect_left(gaps, (length, -1)), len(gaps) - 1)
            r, j = gaps.pop(at)
            size = min(r, length)
            windows[j].append((i, start, size))
            if r > size:
                insort(gaps, (r - size, j))
            start, length = start + size, length - size
    return [w for w in windows if w]


def packer(path: str, capacity: int, padding: float, end: int, batch: int, memo: int):
    """A mapInArrow function from (doc_id, text) to rows of SCHEMA."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, memo)
        tail = np.array([end], dtype="<u4").tobytes()
        base, used = TaskContext.get().partitionId() << 40, 0
        schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())])
        waiting: list[tuple] = []  # (doc_id, start, doc_tokens, bytes)

        def deal(parts: list[tuple]) -> list[tuple]:
            nonlocal used
            rows = []
            for window in pack_parts(np.array([len(p[3]) // 4 for p in parts], dtype=np.int64), capacity, padding):
                at = 0
                for i, start, length in window:
                    doc_id, begun, n, ids = parts[i]
                    rows.append((doc_id, begun + start, length, n, base | used, at, ids[4 * start : 4 * (start + length)]))
                    at += length
                used += 1
            return rows

        def arrow(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

        for chunk in chunks(batches, 1):
            rows = []
            for doc_id, ids in zip(chunk.column(0).to_pylist(), encoder.encode(texts(chunk.column(1))), strict=True):
                ids += tail
                n = len(ids) // 4
                whole = n // capacity * capacity
                for at in range(0, whole, capacity):
                    rows.append((doc_id, at, capacity, n, base | used, 0, ids[4 * at : 4 * (at + capacity)]))
                    used += 1
                if whole < n:
                    waiting.append((doc_id, whole, n, ids[4 * whole :]))
                if len(waiting) >= batch:
                    rows += deal(waiting)
                    waiting = []
            if rows:
                yield arrow(rows)
        if waiting:
            yield arrow(deal(waiting))

    return run


def pack(df: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, padding: float = 0.01, end: int = 0, batch: int = 512, memo: int = MEMO) -> DataFrame:
    """Pieces of the documents' id sequences (each with `end` added), packed into windows of `capacity` tokens.

    Columns: doc_id, start, length, doc_tokens, sequence_id, offset, and ids, the piece's little-endian uint32 ids.
    Windows are made within a task, so nothing is shuffled; a task adds less than a window of padding beyond its batches'.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return small_batches(rows).mapInArrow(packer(tokenizer, capacity, padding, end, batch, memo), SCHEMA)


def packed(documents: DataFrame, memo: int = MEMO) -> DataFrame:
    """Pieces by byte_bpe_50k.json, with the checksum of their ids in place of the ids."""
    import public_tokenizers

    pieces = pack(documents, public_tokenizers.path("byte_bpe_50k.json"), memo=memo)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
