"""Alignment of two tokenizers' tokens over the same bytes (operator 12).

Byte offsets where tokens of both end cut a text into groups; an A and a B
token are linked where their byte ranges overlap.

1. Windows of texts are encoded and linked in numpy and written once, packed: a
   document's distinct id pairs and how often each occurs.  An identity map
   gives each A id the B id of the same bytes.  Pairs of this kind (all exact
   one-to-one groups are) are counted in a vector of vocabulary length; the
   others (irregular) as a window's distinct pairs.
2. The vectors are added up.  Irregular pairs are summed by id pair, the only
   shuffle of pairs; each A id's best count is a vector again.  Vectors go to
   all tasks: their length is the vocabulary's, whatever the corpus holds.
3. The counts of its irregular pairs return to each window, whose documents'
   links are then weighed by numpy.

A pair common to many documents is one row per window, never one per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.byte_level import PATTERN, ByteLevelFile
from tidemark.llm.common import staged, steps, text_bytes

#: Text bytes of a window (or one longer text).
WINDOW_BYTES = 1_000_000
#: Texts with a run this long of one class are encoded by the file's own library.
_LONG_RUN = r"\S{20000}|\s{20000}"


class TokenPair:
    """Both tokenizers: ids, bytes of ids, and the identity map from A ids to B ids."""

    def __init__(self, a_path: str, b_path: str):
        import re

        import sentencepiece
        import tiktoken

        file = ByteLevelFile(a_path)
        self.a_path, self._a_library = a_path, None
        self.a_bytes = file.token_bytes()
        self.a_fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=file.ids, special_tokens={})
        self.long_run = re.compile(_LONG_RUN)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        n = self.b.vocab_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        # Of several B ids of the same bytes, whole pieces come before byte pieces, then the lowest id.
        by_bytes: dict[bytes, int] = {}
        for i in sorted(range(n), key=lambda i: (self.b.is_byte(i), i)):
            by_bytes.setdefault(self.b_bytes[i], i)
        self.identity = np.array([by_bytes.get(x, -1) for x in self.a_bytes], np.int64)
        self.a_len, self.b_len = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        #: Texts of the codes 2 * id + (last of its group), A ids first.
        self.words = [f"{i}{c}" for i in range(len(self.a_bytes)) for c in ",|"]
        self.words += [f"{i}{c}" for i in range(n) for c in ",;"]

    def a_library(self):
        """The file's own library, loaded when a text first needs it."""
        if self._a_library is None:
            from tokenizers import Tokenizer

            self._a_library = Tokenizer.from_file(self.a_path)
            self._a_library.encode_special_tokens = True
        return self._a_library

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """A and B ids of each text; none of either where the joined bytes are not those of a space and the text."""
        a = [self.a_library().encode(f" {t}", add_special_tokens=False).ids if self.long_run.search(t)
             else self.a_fast.encode_ordinary(f" {t}") if t else [] for t in texts]
        b = self.b.encode(texts, num_threads=1) if texts else []
        for i, t in enumerate(texts):
            want = f" {t}".encode() if t else b""
            if (b"".join(map(self.a_bytes.__getitem__, a[i])) != want
                    or b"".join(map(self.b_bytes.__getitem__, b[i])) != want):
                a[i], b[i] = [], []
        return a, b


class Links:
    """Groups and links of a window's documents."""

    def __init__(self, pair: TokenPair, texts: list[str]):
        a_ids, b_ids = pair.encode(texts)
        docs = len(texts)
        self.n_a, self.n_b = (np.array(list(map(len, x)), np.int64) for x in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))
                for ids, n in ((a_ids, self.n_a), (b_ids, self.n_b)))
        a_end, b_end = np.cumsum(pair.a_len[a]), np.cumsum(pair.b_len[b])
        size = int(a_end[-1]) if len(a_end) else 0
        at_a, at_b = np.zeros(size + 1, np.int32), np.zeros(size + 1, np.int32)
        at_a[a_end], at_b[b_end] = 1, 1
        both = at_a & at_b
        any_ = np.flatnonzero(at_a | at_b)
        ends = np.cumsum(both, dtype=np.int64)  # common ends up to each offset
        doc_of_a = np.repeat(np.arange(docs), self.n_a)
        # Groups: a token's group is the number of common ends before its last byte.
        a_last, b_last = both[a_end] == 1, both[b_end] == 1
        self.n_groups = np.bincount(doc_of_a[a_last], minlength=docs)
        self.shas = self._digests(pair, a, b, ends[a_end - 1], ends[b_end - 1], a_last, b_last)
        # Links: between two successive ends of any kind lies one A and one B token.
        of_a, of_b = (np.cumsum(at, dtype=np.int64)[any_ - 1] for at in (at_a, at_b))
        link_doc, n_b = doc_of_a[of_a], len(pair.b_bytes)
        self.n_links = np.bincount(link_doc, minlength=docs)
        key = (link_doc * len(pair.a_bytes) + a[of_a]) * n_b + b[of_b]
        key.sort()
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        key = key[first]
        #: Distinct (document, A id, B id), in this order, and how often each is linked there.
        self.times = np.diff(np.append(first, len(new)))
        id_pair = key % (len(pair.a_bytes) * n_b)
        self.doc = key // (len(pair.a_bytes) * n_b)
        self.a, self.b = id_pair // n_b, id_pair % n_b
        self.same = pair.identity[self.a] == self.b

    def _digests(self, pair: TokenPair, a, b, a_group, b_group, a_last, b_last) -> list[str]:
        """SHA-256 of each document's groups as text ('' without tokens)."""
        code = np.concatenate([2 * a + a_last, 2 * (len(pair.a_bytes) + b) + b_last])
        # A group's A tokens come before its B tokens; both are in text order already.
        place = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        words = list(map(pair.words.__getitem__, code[place].tolist()))
        out, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            text = "".join(words[at : at + n])[:-1]
            out.append(hashlib.sha256(text.encode()).hexdigest() if n else "")
            at += n
        return out


def _steps_up(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Differences of values that rise within each run; a run's first value stays.  Small numbers pack well."""
    out = np.diff(values, prepend=0)
    out[starts] = values[starts]
    return out


def _back(steps_: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Inverse of :func:`_steps_up` for runs of these sizes."""
    total = np.cumsum(steps_)
    starts = np.cumsum(size) - size
    full = size > 0
    lead = total[starts[full]] - steps_[starts[full]]
    return total - np.repeat(lead, size[full])


def _runs(doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.bincount(doc, minlength=docs)
    starts = np.cumsum(size) - size
    return size, starts[size > 0]


WINDOW = T.StructType([T.StructField("window", T.LongType())] + [
    T.StructField(n, T.BinaryType()) for n in
    ("n_a", "n_b", "n_groups", "n_links", "same_size", "same_a", "same_times", "odd_size", "odd_at", "odd_times",
     "vector_a", "vector_n")] + [
    T.StructField("shas", T.ArrayType(T.StringType())), T.StructField("pairs", T.ArrayType(T.LongType())),
    T.StructField("pair_docs", T.ArrayType(T.IntegerType()))])


def link_windows(docs: DataFrame, a_path: str, b_path: str, window_bytes: int) -> DataFrame:
    """One packed row per window of ``docs`` (id, text): its documents, links and pair counts."""
    schema = T.StructType([*WINDOW.fields, T.StructField("ids", T.ArrayType(docs.schema["id"].dataType))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, base, n = None, TaskContext.get().partitionId() << 33, 0
        held: list[pa.RecordBatch] = []
        size = 0

        def window() -> pa.RecordBatch:
            ids = pa.concat_arrays([x.column("id") for x in held])
            texts = [t or "" for x in held for t in x.column("text").to_pylist()]
            found, docs = Links(pair, texts), len(texts)
            same, odd = found.same, ~found.same
            u32 = lambda x: np.ascontiguousarray(x, np.uint32).tobytes()
            same_size, same_starts = _runs(found.doc[same], docs)
            odd_size, odd_starts = _runs(found.doc[odd], docs)
            vector = np.bincount(found.a[same], minlength=len(pair.a_bytes))
            in_use = np.flatnonzero(vector)
            pairs, at, pair_docs = np.unique(found.a[odd] * len(pair.b_bytes) + found.b[odd],
                                             return_inverse=True, return_counts=True)
            blobs = [u32(found.n_a), u32(found.n_b), u32(found.n_groups), u32(found.n_links),
                     u32(same_size), u32(_steps_up(found.a[same], same_starts)), u32(found.times[same]),
                     u32(odd_size), u32(_steps_up(at, odd_starts)), u32(found.times[odd]),
                     u32(in_use), u32(vector[in_use])]
            whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.RecordBatch.from_arrays(
                [pa.array([base + n], pa.int64()), *(pa.array([x], pa.binary()) for x in blobs),
                 whole(pa.array(found.shas, pa.string())), whole(pa.array(pairs)),
                 whole(pa.array(pair_docs.astype(np.int32))), whole(ids)], names=schema.names)

        for batch in steps(batches, limit=window_bytes):
            pair = pair or TokenPair(a_path, b_path)
            held.append(batch)
            size += int(text_bytes(batch.column("text"))[1][-1])
            if size >= window_bytes:
                yield window()
                held, size, n = [], 0, n + 1
        if held:
            yield window()

    return docs.mapInArrow(run, schema)


def pair_counts(windows: DataFrame) -> DataFrame:
    """(pair, n): how many documents hold each irregular id pair linked (pair: A id * size of B + B id)."""
    rows = windows.select(F.explode(F.arrays_zip("pairs", "pair_docs")).alias("x"))
    return rows.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.pair_docs").alias("n"))


def identity_counts(windows: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each A id linked to the B id of its bytes: the windows' vectors, added up.

    A task adds its windows' vectors and sends its entries over 0; the driver gets
    a row per A id at most.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for a, n in zip(batch.column("vector_a").to_pylist(), batch.column("vector_n").to_pylist(), strict=True):
                total[np.frombuffer(a, np.uint32)] += np.frombuffer(n, np.uint32)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["a", "n"])

    rows = (windows.select("vector_a", "vector_n").mapInArrow(add, "a long, n long")
            .groupBy("a").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(size, np.int64)
    for a, n in rows:
        out[a] = n
    return out


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          window_bytes: int = WINDOW_BYTES) -> DataFrame:
    """``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs``.

    A (a byte-level BPE file) encodes a space and the text, B (a sentencepiece
    model that adds the space) the text; special strings are plain text.  Null and
    empty texts, and texts whose joined A or B bytes are not those of a space
    and the text (such as those with U+2581), have no tokens: zeros, and ''
    as digest.  A pair's count is the number of rows of ``docs`` that hold it linked, so
    rows of null or repeated ids are documents of their own.  ``n_best`` counts the links whose
    pair has its A id's highest count (ties included), ``count_sum`` adds up
    the counts over links.  Columns other than the two are not read.
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    windows = staged(link_windows(docs, a_path, b_path, window_bytes), "align-windows")
    probe = TokenPair(a_path, b_path)
    n_a, n_b = len(probe.a_bytes), len(probe.b_bytes)
    counts = staged(pair_counts(windows), "align-counts")
    same = identity_counts(windows, n_a)
    best = same.copy()
    # One row per A id at most: as long as the vocabulary.
    for a, n in counts.groupBy(F.floor(F.col("pair") / n_b).alias("a")).agg(F.max("n")).collect():
        best[a] = max(best[a], n)

    # Counts return to the windows that hold the pair; a window's pairs are bounded by its texts.
    wanted = windows.select("window", F.posexplode("pairs").alias("at", "pair"))
    returned = (wanted.join(counts, "pair").groupBy("window")
                .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "n"))), lambda x: x["n"]).alias("counts")))
    returned = returned.select(F.col("window").alias("of_window"), "counts")
    id_type = docs.schema["id"].dataType

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = lambda c: np.frombuffer(batch.column(c)[i].as_buffer(), np.uint32).astype(np.int64)  # noqa: E731, B023
                n_docs = len(row("n_a"))
                of_pair = batch.column("counts")[i].values
                of_pair = np.zeros(0, np.int64) if of_pair is None else of_pair.to_numpy()
                pairs = batch.column("pairs")[i].values.to_numpy()
                n_best, total = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
                for kind in ("same", "odd"):
                    size, times = row(f"{kind}_size"), row(f"{kind}_times")
                    doc = np.repeat(np.arange(n_docs), size)
                    if kind == "same":
                        a = _back(row("same_a"), size)
                        n = same[a]
                    else:
                        at = _back(row("odd_at"), size)
                        n, a = of_pair[at], pairs[at] // n_b
                    np.add.at(n_best, doc, times * (n == best[a]))
                    np.add.at(total, doc, times * n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, *(pa.array(row(c)) for c in ("n_a", "n_b", "n_groups", "n_links")),
                     pa.array(n_best), pa.array(total), batch.column("shas")[i].values],
                    names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    out = T.StructType([T.StructField("id", id_type), *(T.StructField(c, T.LongType()) for c in (
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), T.StructField("groups_sha256", T.StringType())])
    needed = windows.drop("vector_a", "vector_n", "pair_docs")
    joined = needed.join(returned, F.col("window") == F.col("of_window"), "left").drop("of_window", "window")
    return joined.mapInArrow(weigh, out).withColumnRenamed("id", id_col)
