"""Token counts by heap-and-linked-list byte-pair merging (operator 13).

A text is divided at special strings and into pre-tokens.  A pre-token's bytes
are a linked list of symbols; a heap holds its adjacent pairs that can merge,
by rank and then position.  The lowest is popped, merged if it still stands, and
the two pairs it makes with its neighbours are pushed.  The count is the number
of bytes less the number of merges; no ids are written out.

Texts are counted where they are read: no shuffle.  A task remembers the counts
of up to ``CACHE_PIECES`` short pre-tokens; longer ones are merged each time.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.byte_level import PATTERN, ByteLevelFile, byte_characters
from tidemark.llm.common import plus_fields, steps, text_bytes

LIMIT = 1024
#: Counts a task remembers, and the longest pre-token (in characters) that is remembered.
CACHE_PIECES, CACHE_CHARS = 400_000, 48
#: Characters beyond this are divided by the tokenizer file's own library, whose Unicode version may differ from ours.
_KNOWN = "[^\x00-ɏ]"
_PIECES_AT_ONCE = 1_000_000


class MergeCounter:
    """Number of tokens of a text by the merges of a byte-level BPE file."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        file = ByteLevelFile(path)
        ids = file.ids
        self.first = [ids[bytes([b])] for b in range(256)]
        #: (left symbol, right symbol) -> (rank, merged symbol); of a pair listed twice, the later rank holds.
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(file.merges)}
        self.special = file.special_pattern
        self.pieces = regex.compile(PATTERN)
        self.unknown = regex.compile(_KNOWN)
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.byte_of = byte_characters()

        counter = self

        class Remembered(dict):
            def __missing__(self, piece: str) -> int:
                n = counter.merge(piece.encode())
                if len(piece) <= CACHE_CHARS and len(self) < CACHE_PIECES:
                    self[piece] = n
                return n

        self.known = Remembered()

    def merge(self, data: bytes) -> int:
        """Symbols left of one pre-token."""
        n = len(data)
        if n < 2:
            return n
        merges = self.merges
        symbol = [self.first[b] for b in data]
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        # A heap entry is rank * n + position: one integer, ordered by rank and then from the left.
        heap = [found[0] * n + i for i in range(n - 1) if (found := merges.get((symbol[i], symbol[i + 1])))]
        heapq.heapify(heap)
        merged = 0
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            j = after[i]
            found = merges.get((symbol[i], symbol[j])) if j < n else None
            if found is None or found[0] != rank:
                continue  # one of the two was merged meanwhile
            symbol[i], symbol[j] = found[1], -1
            k = after[i] = after[j]
            merged += 1
            if k < n:
                before[k] = i
                if found := merges.get((symbol[i], symbol[k])):
                    heapq.heappush(heap, found[0] * n + i)
            h = before[i]
            if h >= 0 and (found := merges.get((symbol[h], symbol[i]))):
                heapq.heappush(heap, found[0] * n + h)
        return n - merged

    def _part(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if self.unknown.search(text):
            return sum(self.merge(bytes(map(self.byte_of.__getitem__, piece)))
                       for piece, _ in self.library.pre_tokenize_str(text))
        if len(text) <= _PIECES_AT_ONCE:
            return sum(map(self.known.__getitem__, self.pieces.findall(text)))
        return sum(self.known[m[0]] for m in self.pieces.finditer(text))

    def count(self, text: str) -> int:
        """Tokens of a text; each special string in it is one token."""
        total, at = 0, 0
        for m in self.special.finditer(text):
            total += 1 + (self._part(text[at : m.start()]) if m.start() > at else 0)
            at = m.end()
        return total + (self._part(text[at:]) if at < len(text) else 0)


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """``id_col``, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every row of ``docs``.

    ``tokenizer_path`` names a plain byte-level BPE file; others raise
    ``ValueError`` when the first task opens it.  Null texts are empty (no
    bytes, no tokens).  Rows with null or repeated ids are counted like others;
    columns other than the two are not read, so their names can't clash.
    Memory beside the cache is some 100 bytes per byte of the longest pre-token.
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in steps(batches):
            counter = counter or MergeCounter(tokenizer_path)
            n_bytes = np.diff(text_bytes(batch.column("text"))[1])
            texts = batch.column("text").to_pylist()
            n = np.array([counter.count(t) if t else 0 for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_bytes), pa.array(n), pa.array(n > limit)],
                                             names=["id", "n_bytes", "n_tokens", "over_limit"])

    out = plus_fields(docs.select("id"), ("n_bytes", "long"), ("n_tokens", "long"), ("over_limit", "boolean"))
    return docs.mapInArrow(run, out).withColumnRenamed("id", id_col)
