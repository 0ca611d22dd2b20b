"""Cost-balanced packing of documents into token sequences (operator 2).

A piece of n tokens costs ``linear * n + quadratic * n^2`` (attention stays
within a piece).  Documents of a full sequence or more first fill sequences of
their own.  The rest are taken in descending order, each to the lowest-cost
sequence that has room for it; one that fits nowhere whole is cut over the
lowest-cost sequences with remaining capacity.  There are just enough
sequences for the tokens, so padding stays below one sequence per window.

Documents are packed where they are read, in windows of ``window_tokens``
tokens: no shuffle, memory bounded by a window (or one longer document), and
a lost task packs its own rows again.  Small partitions are read together, by
tasks of ``task_bytes`` on average, so that padding hangs on the size of the
data and not on how many files hold it.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.byte_level import PATTERN, ByteLevelFile
from tidemark.llm.common import steps

SEQUENCE_TOKENS = 2048
#: Relative cost of a token, and of a token attending to a token (a model some 1000 units wide).
LINEAR, QUADRATIC = 1.0, 1 / 6144
WINDOW_TOKENS = 2_000_000

#: Bytes of text (and end ids) that a task packs on average, however small the files are.
TASK_BYTES = 2_000_000
#: Texts with a run this long of one class are left to the tokenizer file's own library.
_LONG_RUN = re.compile(r"\S{20000}|\s{20000}")


class FileTokenizer:
    """Ids of whole texts as a tokenizers file gives them, special tokens not added.

    The vocabulary of a plain byte-level BPE is handed to ``tiktoken``, which
    merges the same pairs several times faster.  Texts that spell a special
    token or hold very long runs, and all texts if the file is of another kind
    (a normalizer, another pre-tokenizer), are encoded by ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        try:
            said = ByteLevelFile(path)
        except ValueError:
            self.fast = None
        else:
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=said.ids, special_tokens={})
            self.special = said.special_pattern

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, as one byte string."""
        return [array("I", self.tokenizer.encode(t, add_special_tokens=False).ids
                      if self.fast is None or self.special.search(t) or _LONG_RUN.search(t)
                      else self.fast.encode_ordinary(t)).tobytes()
                for t in texts]


def pack(lengths: np.ndarray, room: int = SEQUENCE_TOKENS, linear: float = LINEAR,
         quadratic: float = QUADRATIC) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of documents of these lengths: rows (document, start, length, sequence, offset); cost per sequence."""
    lengths = np.asarray(lengths, np.int64)
    cost = lambda n: linear * n + quadratic * n * n
    whole = lengths // room
    doc = np.repeat(np.arange(len(lengths)), whole)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)
    pieces = [np.stack([doc, nth * room, np.full_like(doc, room), np.arange(len(doc)), np.zeros_like(doc)], 1)]
    rest = lengths - whole * room
    n_open = -(-int(rest.sum()) // room)
    costs, free = np.zeros(n_open), np.full(n_open, room, np.int64)
    placed = []
    for d in np.argsort(-rest, kind="stable"):
        left = int(rest[d])
        start = int(lengths[d]) - left
        while left:
            fits = free >= left
            if not fits.any():
                fits = free > 0
            at = int(np.where(fits, costs, np.inf).argmin())
            size = min(left, int(free[at]))
            placed.append((d, start, size, len(doc) + at, room - free[at]))
            costs[at] += cost(size)
            free[at] -= size
            start, left = start + size, left - size
    pieces.append(np.array(placed, np.int64).reshape(-1, 5))
    return np.concatenate(pieces), np.concatenate([np.full(len(doc), cost(room)), costs])


SCHEMA = ("start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
          "sequence_cost double")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   end_id: int = 1, room: int = SEQUENCE_TOKENS, linear: float = LINEAR,
                   quadratic: float = QUADRATIC, window_tokens: int = WINDOW_TOKENS,
                   task_bytes: int = TASK_BYTES) -> DataFrame:
    """Pieces of all documents: ``id_col``, start, length, ids, doc_tokens, sequence_id, offset, sequence_cost.

    ``ids`` are the piece's token ids, 32-bit little-endian.  A document is its
    text's ids and ``end_id``, so a null or empty text is one token.  Each row
    is a document of its own, whatever its id.  Offsets run through a sequence
    without gaps.  Sequence ids are unique, and rise by window.  Text sizes are
    summed when called, in a job of its own.
    """
    docs = docs.select(id_col, text_col)
    # A document's end id counts too, so that empty texts never all go to one task.
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(4))).first()[0] or 0
    docs = docs.coalesce(max(1, size // task_bytes))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = FileTokenizer(tokenizer_path)
        end = array("I", [end_id]).tobytes()
        base, used = TaskContext.get().partitionId() << 40, 0
        ids: list[bytes] = []
        keys: list[pa.Array] = []
        held = 0

        def window() -> pa.RecordBatch:
            nonlocal used
            lengths = np.array([len(x) // 4 for x in ids], np.int64)
            pieces, costs = pack(lengths, room, linear, quadratic)
            doc, start, length, sequence, offset = pieces.T
            cut = [ids[d][4 * s : 4 * (s + n)] for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
            first, used = base + used, used + len(costs)
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(keys).take(pa.array(doc)), pa.array(start), pa.array(length),
                 pa.array(cut, pa.binary()), pa.array(lengths[doc]), pa.array(first + sequence), pa.array(offset),
                 pa.array(costs[sequence])],
                names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_cost"])

        for batch in steps(batches, text_col):
            texts = batch.column(text_col).fill_null("").to_pylist()
            ids += [x + end for x in tokenizer.encode(texts)]
            keys.append(batch.column(id_col))
            held += sum(map(len, ids[-len(texts) :])) // 4
            if held >= window_tokens:
                yield window()
                ids, keys, held = [], [], 0
        if ids:
            yield window()

    return docs.mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")
