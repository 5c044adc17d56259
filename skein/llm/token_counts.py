"""Token counts of whole texts by rank-synchronous merging of ragged arrays.

A text is cut into space-led chunks (a boundary no pre-token crosses), whose counts are kept in a bounded memo. Chunks
not met before are pre-tokenised together and laid out as one ragged array of byte symbols. In each round every
sequence finds the lowest rank among its adjacent pairs and merges all non-overlapping occurrences of that pair, all
sequences at once; sequences without a known pair are done. What survives is counted.

Null text counts as empty (0 bytes, 0 tokens); texts of any length, repeated rows and null ids give one row each; an
empty table gives none; other columns are not looked at. A special token's string is one token, as the library has it.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import chunks, small_batches, table, texts
from skein.llm.encoder import PATTERN, byte_alphabet

#: Chunks whose counts one worker holds, and the longest of them in characters; beyond it the memo starts anew.
MEMO, MEMO_LETTERS = 250_000, 48

#: Byte symbols merged in one go.
MERGE_BYTES = 1 << 20


class RankMerger:
    """Counts of the symbols that are left of pre-tokens, given as UTF-8 bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.size = len(vocab) + 1
        self.byte_ids = np.array([vocab[c] for c in byte_alphabet()], dtype=np.int64)
        codes = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes = codes[order]
        self.ranks = order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.none = np.int32(len(pairs))
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left * self.size + right
        at = np.searchsorted(self.codes, code)
        at[at == len(self.codes)] = 0
        return np.where(self.codes[at] == code, self.ranks[at], self.none)

    def counts(self, pretokens: list[bytes]) -> np.ndarray:
        length = np.fromiter(map(len, pretokens), dtype=np.int64, count=len(pretokens))
        out = length.copy()
        live = np.flatnonzero(length > 1)
        if not len(live):
            return out
        data = self.byte_ids[np.frombuffer(b"".join([pretokens[i] for i in live.tolist()]), dtype=np.uint8)]
        seq = np.repeat(np.arange(len(live)), length[live])
        rank = self._ranks(data, seq)
        while len(data):
            start = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            least = np.minimum.reduceat(rank, start)
            ids = seq[start]
            ends = np.r_[start[1:], len(seq)]
            done = least == self.none
            if done.any():
                out[live[ids[done]]] = (ends - start)[done]
                keep = np.repeat(~done, ends - start)
                data, seq, rank = data[keep], seq[keep], rank[keep]
                if not len(data):
                    break
                least = least[~done]
                lengths = (ends - start)[~done]
            else:
                lengths = ends - start
            hit = rank == np.repeat(least, lengths)
            at = np.flatnonzero(hit)
            # Of a run of neighbouring hits (equal symbols), every second one is used, from the left.
            run = np.r_[True, np.diff(at) != 1]
            first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            data[at] = self.made[rank[at]]
            keep = np.ones(len(data), dtype=bool)
            keep[at + 1] = False
            data, seq, rank = data[keep], seq[keep], rank[keep]
            # Only pairs beside a merged symbol have changed.
            merged = at - np.arange(len(at))
            touched = np.unique(np.r_[merged, merged[merged > 0] - 1])
            rank[touched] = self._ranks_at(data, seq, touched)
        return out

    def _ranks(self, data: np.ndarray, seq: np.ndarray) -> np.ndarray:
        rank = np.full(len(data), self.none, dtype=np.int32)
        inner = np.flatnonzero(seq[1:] == seq[:-1])
        rank[inner] = self.rank(data[inner], data[inner + 1])
        return rank

    def _ranks_at(self, data: np.ndarray, seq: np.ndarray, at: np.ndarray) -> np.ndarray:
        rank = np.full(len(at), self.none, dtype=np.int32)
        inner = np.flatnonzero((at + 1 < len(data)) & (seq[at] == seq[np.minimum(at + 1, len(data) - 1)]))
        rank[inner] = self.rank(data[at[inner]], data[at[inner] + 1])
        return rank


class TokenCounter:
    """count(texts) -> number of tokens of each text."""

    def __init__(self, path: str, memo: int = MEMO):
        self.merger = RankMerger(path)
        self.pattern = regex.compile(PATTERN)
        self.split = regex.compile("|".join(map(regex.escape, self.merger.special))) if self.merger.special else None
        self.memo_limit = memo
        self.memo: dict[str, int] = {}

    def pretokens(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and the number of special tokens between them."""
        if self.split is None or not any(s in text for s in self.merger.special):
            return self.pattern.findall(text), 0
        parts = self.split.split(text)
        return [p for part in parts for p in self.pattern.findall(part)], len(parts) - 1

    def _learn(self, new: list[str]) -> dict[str, int]:
        """The counts of chunks, of which the memo keeps the short ones."""
        flat: list[bytes] = []
        ends, specials = [], []
        for c in new:
            if len(c) < 64 and c.isascii() and c[1:].isalpha() and c[0] == " ":
                flat.append(c.encode())
                specials.append(0)
            else:
                pre, special = self.pretokens(c)
                flat.extend(p.encode() for p in pre)
                specials.append(special)
            ends.append(len(flat))
        total = np.zeros(len(flat) + 1, dtype=np.int64)
        at, size, begun = 0, 0, 0
        for at, p in enumerate(flat):
            size += len(p)
            if size >= MERGE_BYTES:
                total[begun + 1 : at + 2] = self.merger.counts(flat[begun : at + 1])
                begun, size = at + 1, 0
        if begun < len(flat):
            total[begun + 1 :] = self.merger.counts(flat[begun:])
        total = np.cumsum(total)[ends]
        counts = np.diff(total, prepend=0) + np.array(specials, dtype=np.int64)
        found = dict(zip(new, counts.tolist(), strict=True))
        self.memo.update((c, n) for c, n in found.items() if len(c) <= MEMO_LETTERS)
        return found

    def count(self, batch: list[str]) -> list[int]:
        """A chunk is a run of white space and what follows it up to the next white space; see the module's text."""
        if len(self.memo) > self.memo_limit:
            self.memo.clear()
        cut = [self.cut(t) for t in batch]
        new = {c for p in cut for c in p if c not in self.memo}
        long = {c: n for c, n in self._learn(list(new)).items() if len(c) > MEMO_LETTERS} if new else {}
        memo = self.memo
        return [sum([long[c] if len(c) > MEMO_LETTERS else memo[c] for c in p]) for p in cut]

    @staticmethod
    def cut(text: str) -> list[str]:
        """Chunks whose concatenation is `text`; a chunk starts at a space after a non-space character."""
        parts = text.split(" ")
        if len(parts) == 1:
            return [text] if text else []
        out = [parts[0]] if parts[0] else []
        carry = " "
        for p in parts[1:]:
            if not p:
                carry += " "
            else:
                out.append(carry + p)
                carry = " "
        if len(carry) > 1:
            out.append(carry[:-1])
        return out if not TokenCounter._loose(out) else [text]

    @staticmethod
    def _loose(parts: list[str]) -> bool:
        """Whether a chunk but the last ends in white space, so that its boundary may be inside a pre-token."""
        return any(p[-1].isspace() for p in parts[:-1])


@functools.lru_cache(maxsize=1)
def worker_counter(path: str) -> TokenCounter:
    """The counter of this worker process: its tables and memo outlive a task."""
    return TokenCounter(path)


def counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_counter(path)
        for chunk in chunks(batches, 1):
            n = pa.array(tokens.count(texts(chunk.column(1))), pa.int64())
            yield pa.RecordBatch.from_arrays([chunk.column(0), chunk.column(2), n], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(df: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row, by the byte-level BPE vocabulary in `tokenizer` (a .json file)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return small_batches(rows).mapInArrow(counter(tokenizer), "doc_id long, n_bytes long, n_tokens long")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)
