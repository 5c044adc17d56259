"""SimHash near-duplicate detection with pigeonhole blocks.

Texts: A-Z lower-cased, words split at ASCII white space, shingles of `size` words (all of them, repeats included; a
shorter text is one shingle), XXH64 with seed 42 of each, and a 64-bit fingerprint whose bit is set where over half of
the hashes have it. No word gives fingerprint zero.

Links: two fingerprints within `radius` bits agree on at least `blocks - radius` of `blocks` blocks, so both fall into
one bucket of some choice of `blocks - radius` blocks: the candidate search misses nothing. Copies are one fingerprint
from the start. Within a bucket only a star for each linked set is emitted, never its pairs; a bucket of more than
`TILE` fingerprints is dealt over tiles so that any two of its members meet in one of them. Linked fingerprints are
verified by their Hamming distance before they count.

Nulls count as empty text, whose fingerprint is zero and links like any other; a null id keeps its row but is never a
component's id unless all ids of the component are null; repeated rows and ids each keep a row; an empty table gives
none; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import chunks, cut, small_batches, table, texts
from skein.llm.components import components

#: The most fingerprints of a bucket that one tile's side holds.
TILE = 2048

#: Groups up to this size are compared by shifted arrays.
SHIFTS = 8


def shingle_hashes(text: str, size: int) -> np.ndarray:
    words = text.encode().lower().split()
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(b" ".join(words), 42)] if words else [], dtype=np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    n = len(words) - size + 1
    return np.fromiter((digest(joined[a : b - 1], 42) for a, b in zip(starts[:n], ends[size - 1 :], strict=True)), dtype=np.uint64, count=n)


def fingerprint(hashes: np.ndarray) -> int:
    """The fingerprint as a signed 64-bit number."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 4) -> DataFrame:
    """(doc_id, fp) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 1):
            fps = [fingerprint(shingle_hashes(t, size)) for t in texts(chunk.column(1))]
            yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return small_batches(rows).mapInArrow(run, "doc_id long, fp long")


def block_masks(blocks: int, agree: int) -> list[int]:
    """Masks (signed) of every choice of `agree` of `blocks` near-equal blocks of 64 bits."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    single = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    sums = (sum(c) for c in combinations(single, agree))
    return [m - (1 << 64) if m >> 63 else m for m in sums]


def stars(fps: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) that join the linked members of each group; `group` is sorted. Bits are counted unsigned."""
    fps = fps.view(np.uint64)
    left, right = [], []
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    length = np.diff(np.r_[start, len(group)])
    of = np.repeat(length, length)
    small = np.flatnonzero((of > 1) & (of <= SHIFTS))
    for shift in range(1, min(SHIFTS, len(small))):
        i, j = small[:-shift], small[shift:]
        ok = (group[i] == group[j]) & (np.bitwise_count(fps[i] ^ fps[j]) <= radius)
        left.append(fps[i[ok]])
        right.append(fps[j[ok]])
    for s, n in zip(start[length > SHIFTS].tolist(), length[length > SHIFTS].tolist(), strict=True):
        rest = np.unique(fps[s : s + n])
        while len(rest) > 1:
            root, frontier, rest = rest[0], rest[:1], rest[1:]
            while len(frontier) and len(rest):
                near = np.zeros(len(rest), dtype=bool)
                for f in frontier.tolist():
                    near |= np.bitwise_count(rest ^ np.uint64(f)) <= radius
                frontier, rest = rest[near], rest[~near]
                left.append(np.full(len(frontier), root))
                right.append(frontier)
    none = np.array([], dtype=np.uint64)
    return np.concatenate([none, *left]).view(np.int64), np.concatenate([none, *right]).view(np.int64)


def linker(radius: int):
    """A mapInArrow function over rows (kind, key, tile, fp) sorted by the first three: the edges of their buckets."""
    names = ["a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def edges(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            change = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
            a, b = stars(rows[:, 3].copy(), np.cumsum(np.r_[0, change]), radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            last = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
            same = held and (held[-1][-1, :3] == rows[-1, :3]).all()
            if not len(last) and same:
                held.append(rows)
                continue
            at = last[-1] + 1 if len(last) else 0
            yield from edges(np.concatenate([*held, rows[:at]])) if held or at else ()
            held = [rows[at:]]
        if held:
            yield from edges(np.concatenate(held))

    return run


def links(fps: DataFrame, *, radius: int = 4, blocks: int = 6) -> DataFrame:
    """Edges (a, b) between distinct values of `fps` (fp) that together join all values within `radius` bits."""
    masks = block_masks(blocks, blocks - radius)
    spread = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("kind", "key")
    keyed = cut(fps.select("fp", spread))
    sizes = keyed.groupBy("kind", "key").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = cut(sizes.withColumn("sides", F.ceil(F.col("n") / TILE).cast("long")))
    side = F.pmod(F.xxhash64("fp"), F.col("sides"))
    met = keyed.join(sizes, ["kind", "key"]).select("kind", "key", "fp", "sides", side.alias("side"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)).alias("other")
    tile = F.least("side", "other") * F.col("sides") + F.greatest("side", "other")
    dealt = met.select("kind", "key", "fp", "sides", "side", other).select("kind", "key", tile.alias("tile"), "fp")
    dealt = dealt.repartition("kind", "key", "tile").sortWithinPartitions("kind", "key", "tile")
    return dealt.mapInArrow(linker(radius), "a long, b long").distinct()


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 4, radius: int = 4, blocks: int = 6) -> DataFrame:
    """doc_id, fp and component_id (the least doc_id reachable over links) of every row."""
    fps = cut(fingerprints(df, id_col=id_col, text_col=text_col, size=size))
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    edges = cut(links(distinct.select("fp"), radius=radius, blocks=blocks))
    labels = cut(components(edges))
    labelled = distinct.join(labels, distinct.fp == labels.node, "left").select("fp", "low", F.coalesce("label", "fp").alias("label"))
    labelled = cut(labelled)
    least = cut(labelled.groupBy("label").agg(F.min("low").alias("component_id")))
    ids = cut(labelled.join(least, "label").select("fp", "component_id"))
    return fps.join(ids, "fp").select("doc_id", "fp", "component_id")


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
