"""Byte-level BPE ids of whole texts, as the tokenizers library gives them, with a bounded memo of space-led chunks.

The vocabulary's pre-tokenizer never joins a non-space character with the white space after it, so a text may be cut
before every such space and its chunks encoded on their own. Splitting at single spaces gives such chunks unless a
chunk is empty or ends in white space; texts with such chunks are encoded whole, by the library. Chunks of plain Latin
text, for which all regular expression engines agree, are merged by tiktoken with the file's own vocabulary, whose ids
are its ranks; all others (other scripts, special tokens' strings, very long ones) go through the library.
"""

from __future__ import annotations

import functools
import json
import os
import struct
from collections.abc import Callable

import numpy as np

#: Chunks held in memory by one worker, and the longest that is held; beyond it the memo starts anew.
MEMO, MEMO_LETTERS = 500_000, 48

#: Chunks of more characters are left to the library, whose time stays near linear.
LONG = 1000

#: Fixed value: the vocabulary's pre-tokenisation pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where visible in Latin-1, else the next free code point from 256."""
    visible = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in visible else free))
        free += b not in visible
    return out


class Memo(dict):
    """A dict that makes the value of a key not met before, and keeps it unless the key is long."""

    def __init__(self, make: Callable, longest: int = MEMO_LETTERS):
        super().__init__()
        self.make, self.longest = make, longest

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            self[key] = value
        return value


class ChunkEncoder:
    """encode(texts) -> one bytes object of little-endian uint32 ids for each text."""

    def __init__(self, path: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.merger = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.piece = self.merger._core_bpe.encode_single_piece
        self.memo_limit = memo
        self.memo = Memo(self._bytes)

    def _chunk(self, c: str) -> list[int]:
        """Ids of " " + c."""
        if max(c) > "ɏ" or len(c) > LONG:
            return self.tokenizer.encode(" " + c, add_special_tokens=False).ids
        if c.isalpha():
            return self.piece((" " + c).encode())
        if c[-1] in ".,;:!?" and c[:-1].isalpha():
            return self.piece((" " + c[:-1]).encode()) + self.piece(c[-1].encode())
        if any(s in c for s in self.special):
            return self.tokenizer.encode(" " + c, add_special_tokens=False).ids
        return self.merger.encode_ordinary(" " + c)

    def _bytes(self, c: str) -> bytes | None:
        if c == "" or c[-1].isspace():
            return None
        ids = self._chunk(c)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        get, out = self.memo.__getitem__, []
        for text in texts:
            if len(self.memo) > self.memo_limit:
                self.memo.clear()
            p = text.split(" ")
            head = p[0]
            if len(p) == 1 or (head and head[-1].isspace()):
                out.append(self._whole(text))
                continue
            try:
                tail = b"".join(map(get, p[1:]))
            except TypeError:  # an empty chunk or one that ends in white space
                out.append(self._whole(text))
                continue
            out.append((self._whole(head) if head else b"") + tail)
        return out


@functools.lru_cache(maxsize=1)
def worker_encoder(path: str, memo: int = MEMO) -> ChunkEncoder:
    """The encoder of this worker process: its tables and memo outlive a task."""
    return ChunkEncoder(path, memo)
