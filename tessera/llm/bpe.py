"""Encoding of a text column with a byte-level BPE vocabulary.

The merges of a pre-token run on a rank queue: a bucket per merge rank holds the places of linked-list nodes whose
pair merges at that rank, and a three-level bitmap over the ranks finds the next bucket by find-first-set. Entries
made stale by other merges are skipped when they come up. A pre-token of n bytes takes O(n log n), however long.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.session import spread

#: Where the public vocabularies lie on every node; a parameter of ``encode``.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the public pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens kept with their ids in a worker; a full memory is emptied. Only speed depends on it.
MEMORY = 300_000
_SHIFT = 17


class RankQueue:
    """A queue of (rank, place) that hands out the lowest rank first, and of a rank the leftmost place."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, place: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [place]
            self.low[rank >> 6] |= 1 << (rank & 63)
            self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
            self.top |= 1 << (rank >> 12)
        else:
            heappush(bucket, place)

    def pop(self) -> tuple[int, int] | None:
        if not self.top:
            return None
        a = (self.top & -self.top).bit_length() - 1
        word = self.mid[a]
        b = a << 6 | (word & -word).bit_length() - 1
        word = self.low[b]
        rank = b << 6 | (word & -word).bit_length() - 1
        bucket = self.buckets[rank]
        place = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.low[b] &= self.low[b] - 1
            if not self.low[b]:
                self.mid[a] &= self.mid[a] - 1
                if not self.mid[a]:
                    self.top &= self.top - 1
        return rank, place


class Encoder:
    """Byte-level BPE by a rank file (lines of base64 token and rank; the rank is the id)."""

    def __init__(self, rank_file: bytes, pattern: str = PATTERN):
        import regex

        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in rank_file.splitlines() if line)}
        self.find = regex.compile(pattern).findall
        self.bytes = [ranks[bytes([i])] for i in range(256)]
        # a pair merges to the token that its bytes make, so every split of a token into two tokens counts
        self.pairs = {
            a << _SHIFT | b: r
            for t, r in ranks.items()
            for i in range(1, len(t))
            if (a := ranks.get(t[:i])) is not None and (b := ranks.get(t[i:])) is not None
        }
        self.whole = ranks
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.memory: dict[str, list[int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        if (whole := self.whole.get(piece)) is not None:
            return [whole]
        ids = [self.bytes[x] for x in piece]
        n, pairs, queue = len(ids), self.pairs, self.queue
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for i in range(n - 1):
            if (r := pairs.get(ids[i] << _SHIFT | ids[i + 1])) is not None:
                queue.push(r, i)
        while (entry := queue.pop()) is not None:
            rank, i = entry
            j = after[i] if ids[i] >= 0 else n
            if j >= n or pairs.get(ids[i] << _SHIFT | ids[j]) != rank:
                continue  # stale
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := pairs.get(rank << _SHIFT | ids[k])) is not None:
                    queue.push(r, i)
            if (h := before[i]) >= 0 and (r := pairs.get(ids[h] << _SHIFT | rank)) is not None:
                queue.push(r, h)
        return [x for x in ids if x >= 0]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text as it is, without special tokens; none for null and empty texts."""
        out: list[int] = []
        memory = self.memory
        for piece in self.find(text or ""):
            ids = memory.get(piece)
            if ids is None:
                ids = self.merge(piece.encode("utf-8", "replace"))
                if len(piece) < 64:
                    if len(memory) >= MEMORY:
                        memory.clear()
                    memory[piece] = ids
            out += ids
        return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str = PATTERN) -> Encoder:
    """The encoder of a rank file, built once per worker process."""
    if (path, pattern) not in _ENCODERS:
        with open(path, "rb") as f:
            _ENCODERS[path, pattern] = Encoder(f.read(), pattern)
    return _ENCODERS[path, pattern]


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """Rows (id, ids array of int), one per row of ``df``: the whole text's ids in a public byte-level vocabulary.

    Null and empty texts have an empty list, blank texts are encoded like any other, and strings that look like
    special tokens are ordinary text. Repeated rows stay; other columns are dropped. No shuffle but for the
    rebalancing of an input of few splits; a text of any length is encoded in one piece.
    """
    path = f"{folder}/{vocabulary}.tiktoken"

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in it:
            keys, texts = batch.column(0), batch.column(1)
            start, size, rows = 0, 0, []
            for i, text in enumerate(texts):
                rows.append(enc.encode(text.as_py()))
                size += len(rows[-1])
                if size > 2_000_000 or i == len(texts) - 1:
                    yield pa.RecordBatch.from_arrays([keys.slice(start, len(rows)), pa.array(rows, pa.list_(pa.int32()))], ["id", "ids"])
                    start, size, rows = i + 1, 0, []

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return spread(df.select(id_col, text_col)).mapInArrow(batches, schema).withColumnRenamed("id", id_col)
