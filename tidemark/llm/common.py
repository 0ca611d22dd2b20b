"""Helpers shared by the operators: tables, scratch tables and text as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

#: A word is a run of characters other than these.
SPACE_CHARS = "\t\n\x0b\x0c\r "
#: Bytes of text that one numpy step works on (one longer text is a step of its own).
STEP_BYTES = 2_000_000
#: A table joined to a larger one is broadcast up to this many rows.
BROADCAST_ROWS = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it again: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_plain(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it holds at most ``limit`` narrow rows, else as it is.

    Only for staged tables: counting them reads file footers.
    """
    return F.broadcast(df) if df.count() <= limit else df


def plus_fields(df: DataFrame, *fields: tuple[str, str]) -> T.StructType:
    """The schema of ``df`` with further fields (name, DDL type)."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields))])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores in front as no column of ``df`` has it (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def fresh_prefix(df: DataFrame, prefix: str) -> str:
    """``prefix`` with as many underscores in front as no column of ``df`` begins with it."""
    while any(c.lower().startswith(prefix.lower()) for c in df.columns):
        prefix = "_" + prefix
    return prefix


def schema_of(*fields: tuple[str, pa.DataType]) -> pa.Schema:
    return pa.schema([pa.field(n, t) for n, t in fields])


# --- text columns as bytes -------------------------------------------------

def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins (n + 1 offsets from 0).  Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n or column.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batches: Iterable[pa.RecordBatch], column: str = "text",
          limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices whose texts take ``limit`` bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = text_bytes(batch.column(column))[1]
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            upto = min(max(upto, at + 1), batch.num_rows)
            yield batch.slice(at, upto - at)
            at = upto


_SPACES = np.zeros(256, bool)
_SPACES[[ord(c) for c in SPACE_CHARS]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end byte and text number of each word, in order."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_SPACES[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | begins[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:-1]
    first = np.flatnonzero(starts)
    text = np.searchsorted(offsets, first, "right") - 1
    return first, np.flatnonzero(ends) + 1, text


# --- hashes ----------------------------------------------------------------

def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (splitmix finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """64-bit hashes of any spans of a byte array, from prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        base = pow(0x9E3779B97F4A7C15, 2 * seed + 1, 2**64)
        n = len(data) + 1
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        self.back = np.full(n, pow(base, -1, 2**64), np.uint64)
        self.back[0] = 1
        np.cumprod(self.back, out=self.back)
        values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(2654435761 * (2 * seed + 1)))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(values[data] * powers[:-1], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def shingles(words: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each ``n`` successive words of one text, and the text's number."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = len(words) - n + 1
    h = np.zeros(size, np.uint64)
    for i in range(n):
        h = mix(h + words[i : i + size]) * np.uint64(0x2545F4914F6CDD1D)
    same = text[:size] == text[n - 1 :]
    return mix(h[same]), text[:size][same]


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` (one per byte) over each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
