"""Removal of repeated byte strings by suffix arrays (operator 4).

Every start of a ``length``-byte string (a *window*) has a fingerprint: the
hash of the 64-byte string inside it whose hash is least, the first of equals.
Equal windows have equal fingerprints at equal places, wherever they stand, so
only texts that share a fingerprint are compared.  Neighbouring windows that
owe their fingerprint to the same place form a *cell*; no two are equal.

1. Cells whose fingerprint occurs once hold nothing repeated.  Cells that are
   equal as a whole are repeated as a whole.
2. The bytes of the other shared cells (one of each kind) are dealt to shards
   by fingerprint.  A shard builds the suffix array of its bytes by
   Larsson-Sadakane refinement (rank by 8 bytes, then double the compared
   length for suffixes not yet told apart) and Kasai's common prefixes; runs
   of suffixes with ``length`` bytes in common are repeated windows.
3. A fingerprint with very many different cells is split over several shards.
   These hand on sorted digests of their windows, in ranges; each range is
   merged across shards by binary search.

Matches are found on the input; all covered bytes are then removed together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.common import Rolling, plus_fields, steps, text_bytes

LENGTH, GRAM = 200, 64
SHARD_BYTES, SPLIT_CELLS = 2_000_000, 4096
#: Bits of a place within one slice of hashes.
PLACE_BITS = 28
#: Small steps keep the rolling minimum's arrays in the processor's cache.
SCAN_BYTES = 300_000


#: Spark's setting to delete an execution's shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``common.staged``, after which the write's shuffle files go: nothing reads them again."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return common.staged(df, name)
    finally:
        if before is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, before)


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` successive values."""
    done = 1
    while done * 2 <= width:
        h = np.minimum(h[:-done], h[done:])
        done *= 2
    rest = width - done
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def least_places(h: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each ``width`` successive hashes stands, by their top bits, the first of equals.

    Longer arrays go in overlapping slices, so that as many bits decide in all.
    """
    bits = np.uint64(PLACE_BITS)
    out = np.empty(len(h) - width + 1, np.int64)
    step = (1 << PLACE_BITS) - width
    for a in range(0, len(out), step):
        part = h[a : a + step + width - 1]
        # The place is carried in the low bits, so that the least value tells it.
        low = sliding_min((part >> bits << bits) | np.arange(len(part), dtype=np.uint64), width)
        out[a : a + len(low)] = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64) + a
    return out


def cells_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text number, start, number of windows, fingerprint and digest of each cell of some texts."""
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    at = np.arange(len(data) - gram + 1)
    h = Rolling(data, 1).spans(at, at + gram)
    low = least_places(h, length - gram + 1)
    start = np.arange(len(low))
    text = np.searchsorted(offsets, start, "right") - 1
    valid = start + length <= offsets[text + 1]
    new = valid.copy()
    new[1:] &= (low[1:] != low[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new)
    cell = np.cumsum(new) - 1
    windows = np.bincount(cell[valid], minlength=len(first))
    digest = Rolling(data, 2).spans(first, first + windows + length - 1)
    return text[first], first - offsets[text[first]], windows, h[low[first]], digest


def cell_table(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """id, hash, start, windows, f (fingerprint) and c (digest) of all cells of ``docs`` (id, hash, text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, limit=SCAN_BYTES):
            text, start, windows, f, c = cells_of(*text_bytes(batch.column("text")), length, gram)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(text)), batch.column("hash").take(pa.array(text)), pa.array(start),
                 pa.array(windows), pa.array(f.view(np.int64)), pa.array(c.view(np.int64))],
                names=["id", "hash", "start", "windows", "f", "c"])

    return docs.mapInArrow(run, f"id {kind}, hash long, start long, windows long, f long, c long")


# --- suffix arrays ---------------------------------------------------------

def eight_bytes(data: np.ndarray, pad: int) -> np.ndarray:
    """The 8 bytes from each position on as one big-endian number; zeros follow the end."""
    padded = np.zeros(len(data) + pad + 8, np.uint64)
    padded[: len(data)] = data
    out = np.zeros(len(data) + pad, np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i : i + len(out)]
    return out


def suffix_array(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, and the 8-byte keys (padded by ``length`` and a word).

    Larsson-Sadakane: once suffixes are ranked by h bytes, ranks at distance h
    order them by 2 h; only suffixes that share a rank are sorted again.
    """
    n = len(data)
    keys = eight_bytes(data, length + 8)
    order = np.argsort(keys[:n], kind="stable")
    sorted_keys = keys[:n][order]
    head = np.ones(n, bool)
    head[1:] = sorted_keys[1:] != sorted_keys[:-1]
    rank = np.full(n + 1, -1, np.int64)
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[order] = group
    h = 8
    while h < n:
        alone = head & np.append(head[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        at = order[slots]
        key = rank[at] * (n + 2) + rank[np.minimum(at + h, n)] + 1
        resort = np.argsort(key, kind="stable")
        at, key = at[resort], key[resort]
        order[slots] = at
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        head[slots] = new
        rank[at] = np.maximum.accumulate(np.where(new, slots, 0))
        h *= 2
    return order, keys


def common_prefixes(order: np.ndarray, keys: np.ndarray, length: int, lane: int = 256) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in ``order``, up to ``length`` (Kasai).

    From one position to the next the value falls by one at most.  Lanes of
    ``lane`` successive positions are walked side by side.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    starts = np.arange(0, n, lane)
    h = np.zeros(len(starts), np.int64)
    steps_ = np.array([1 << s for s in range(8, 65, 8)][:-1], np.uint64)
    for j in range(min(lane, n)):
        p = starts + j
        p = p[p < n]
        h = np.maximum(h[: len(p)] - 1, 0)
        q = before[p]
        h[q < 0] = 0
        live = np.flatnonzero((q >= 0) & (h < length))
        while len(live):
            differ = keys[p[live] + h[live]] ^ keys[q[live] + h[live]]
            equal = np.where(differ == 0, 8, 7 - np.searchsorted(steps_, differ, "right"))
            h[live] += equal
            live = live[(equal == 8) & (h[live] < length)]
        out[p] = np.minimum(h, length)
    return out[order]


def repeated_windows(data: np.ndarray, valid: np.ndarray, weight: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For each position: whether a valid window there occurs again (by weight), and its run's number."""
    order, keys = suffix_array(data, length)
    run = np.cumsum(common_prefixes(order, keys, length) < length)
    total = np.bincount(run, weights=np.where(valid, weight, 0)[order], minlength=run[-1] + 1 if len(run) else 0)
    again, number = np.zeros(len(data), bool), np.zeros(len(data), np.int64)
    again[order] = total[run] > 1
    number[order] = run
    return again & valid, number


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def shard_spans(cells: DataFrame, length: int, split_cells: int, shard_bytes: int) -> DataFrame:
    """Spans (id, hash, start, end) of single cells' windows that occur in other cells of their fingerprint.

    ``cells`` (staged): id, hash, start, windows, f, c, n (how often the cell occurs) and bytes.
    """
    total = cells.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    kinds = staged(cells.groupBy("f").agg(F.ceil(F.count(F.lit(1)) / split_cells).cast("int").alias("parts"))
                   .where("parts > 1"), "substring-parts")
    dealt = (cells.join(kinds, "f", "left").fillna(1, ["parts"])
             .withColumn("part", F.pmod("c", F.col("parts")).cast("int"))
             .withColumn("shard", F.when(F.col("parts") > 1, F.concat_ws("/", "f", "part"))
                         .otherwise(F.pmod(F.xxhash64("f"), F.lit(shards)).cast("string"))))
    id_kind = cells.schema["id"].dataType.simpleString()
    columns = ["f", "slot", "id", "hash", "start", "end", "d1", "d2", "owner", "at"]
    schema = (f"f long, slot int, id array<{id_kind}>, hash array<long>, start array<long>, end array<long>, "
              "d1 binary, d2 binary, owner binary, at binary")

    def sort_shard(rows: pd.DataFrame) -> pd.DataFrame:
        data = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
        size = rows["bytes"].map(len).to_numpy()
        base = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(rows)), size)
        inside = np.arange(len(data)) - base[owner]
        valid = inside < rows["windows"].to_numpy()[owner]
        n = rows["n"].to_numpy()
        again, number = repeated_windows(data, valid, n[owner], length)
        ids, hashes, begin = rows["id"].tolist(), rows["hash"].tolist(), rows["start"].to_numpy()
        out = []
        single = again & (n[owner] == 1)
        # Cells touch in ``data``, but a cell's last bytes start no window, so runs stay within cells.
        a, b = _runs(single)
        if len(a):
            o = owner[a]
            out.append((0, -1, [ids[k] for k in o], [hashes[k] for k in o], (begin[o] + inside[a]).tolist(),
                        (begin[o] + inside[b - 1] + length).tolist(), b"", b"", b"", b""))
        parts = int(rows["parts"].iloc[0])
        if parts > 1:
            # One entry for each repeated window's run, without owner, and one for every other window.
            r1, r2 = Rolling(data, 3), Rolling(data, 4)
            known = np.flatnonzero(again)
            known = known[np.unique(number[known], return_index=True)[1]]
            fresh = np.flatnonzero(valid & ~again)
            at = np.concatenate([known, fresh])
            mark = np.concatenate([np.full(len(known), -1), owner[fresh]]).astype(np.int64)
            d1, d2 = r1.spans(at, at + length), r2.spans(at, at + length)
            place = np.where(mark < 0, 0, begin[owner[at]] + inside[at])
            slot = (((d1 >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((d2, d1))
            at_slot = np.searchsorted(slot[order], np.arange(parts + 1))
            for k in range(parts):
                x = order[at_slot[k] : at_slot[k + 1]]
                own, named = np.unique(mark[x], return_inverse=True)
                shift = int(len(own) > 0 and own[0] < 0)
                out.append((int(rows["f"].iloc[0]), k, [ids[i] for i in own[shift:]], [hashes[i] for i in own[shift:]],
                            [], [], d1[x].tobytes(), d2[x].tobytes(), (named - shift).astype(np.int64).tobytes(),
                            place[x].astype(np.int64).tobytes()))
        return pd.DataFrame(out, columns=columns)

    sorted_ = staged(dealt.select("shard", "id", "hash", "start", "windows", "n", "bytes", "parts", "f")
                     .groupBy("shard").applyInPandas(sort_shard, schema), "substring-shards")
    spans = sorted_.where("slot < 0").select(F.explode(F.arrays_zip("id", "hash", "start", "end")).alias("x")).select("x.*")

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        lists = [[np.frombuffer(r[k], t) for k, t in (("d1", np.uint64), ("d2", np.uint64), ("owner", np.int64),
                                                      ("at", np.int64))] for _, r in rows.iterrows()]
        # Each shard's digests are sorted; where their union, sorted, holds one twice, shards share it.
        pair = np.dtype([("a", np.uint64), ("b", np.uint64)])
        packed = []
        for d1, d2, _, _ in lists:
            p = np.empty(len(d1), pair)
            p["a"], p["b"] = d1, d2
            packed.append(p)
        union = np.concatenate(packed)
        union = union[np.lexsort((union["b"], union["a"]))]
        first = union["a"]
        found = []
        for (d1, d2, owner, at), (_, r) in zip(lists, rows.iterrows(), strict=True):
            low, high = np.searchsorted(first, d1, "left"), np.searchsorted(first, d1, "right")
            shared = high - low > 1
            for k in np.flatnonzero(shared & (owner >= 0)).tolist():
                if (union["b"][low[k] : high[k]] == d2[k]).sum() > 1:
                    o = int(owner[k])
                    found.append((r["id"][o], r["hash"][o], int(at[k]), int(at[k]) + length))
        return pd.DataFrame(found, columns=["id", "hash", "start", "end"])

    split = sorted_.where("slot >= 0")
    if split.isEmpty():
        return spans
    merged = split.groupBy("f", "slot").applyInPandas(merge, f"id {id_kind}, hash long, start long, end long")
    return spans.unionByName(staged(merged, "substring-merged"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, split_cells: int = SPLIT_CELLS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``id_col``, n_bytes, n_removed, spans (start, end; of bytes) and kept (binary) of every document row.

    Every byte covered by a ``length``-byte string that starts somewhere else
    too, in any row, goes.  Texts are UTF-8 bytes (null: empty); what stays may
    begin or end inside a character.  Repeated rows are copies of each other
    like any two equal texts.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    cells = staged(cell_table(rows.where(F.octet_length("text") >= length), length, gram), "substring-cells")
    # Staged, as below, so that joins are between plain tables and a common fingerprint's cells are split over tasks.
    shared = staged(cells.groupBy("f").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("f"),
                    "substring-fingerprints")
    cells = staged(cells.join(shared, "f", "left_semi"), "substring-shared")
    kinds = staged(cells.groupBy("f", "c", "windows").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "hash", "start")).alias("one")), "substring-kinds")
    whole = (cells.join(kinds.where("n > 1").select("f", "c", "windows"), ["f", "c", "windows"], "left_semi")
             .select("id", "hash", "start", (F.col("start") + F.col("windows") + (length - 1)).alias("end")))
    several = staged(kinds.groupBy("f").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("f"),
                     "substring-several")
    compared = (kinds.join(several, "f", "left_semi")
                .select("one.*", "f", "c", "windows", F.least(F.col("n"), F.lit(2)).alias("n"))
                .groupBy("id", "hash").agg(F.collect_list(F.struct("f", "c", "n", "start", "windows")).alias("cells")))
    compared = staged(compared, "substring-compared")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            data, offsets = text_bytes(batch.column("text"))
            lists = batch.column("cells")
            text = lists.value_parent_indices().to_numpy() if hasattr(lists, "value_parent_indices") else np.repeat(
                np.arange(len(lists)), lists.value_lengths().to_numpy())
            flat = lists.flatten()
            start, windows = flat.field("start").to_numpy(), flat.field("windows").to_numpy()
            begin = offsets[text] + start
            parts = [data[a:b].tobytes() for a, b in zip(begin.tolist(), (begin + windows + length - 1).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(text)), batch.column("hash").take(pa.array(text)),
                 *(flat.field(k) for k in ("start", "windows", "f", "c", "n")), pa.array(parts, pa.binary())],
                names=["id", "hash", "start", "windows", "f", "c", "n", "bytes"])

    keyed = compared.select(F.col("id").alias("_id"), F.col("hash").alias("_hash"), "cells")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    distinct = rows.where(F.octet_length("text") >= length)
    kind = rows.schema["id"].dataType.simpleString()
    bytes_ = (distinct.join(keyed, same).select("id", "hash", "text", "cells").mapInArrow(
        cut, f"id {kind}, hash long, start long, windows long, f long, c long, n long, bytes binary")
        # A row that is repeated gives its cells again.
        .dropDuplicates(["f", "c", "windows"]))
    bytes_ = staged(bytes_, "substring-bytes")
    spans = whole.unionByName(shard_spans(bytes_, length, split_cells, shard_bytes))
    spans = staged(spans.groupBy(F.col("id").alias("_id"), F.col("hash").alias("_hash"))
                   .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans")), "substring-spans")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            data, offsets = text_bytes(batch.column("text"))
            lists, kept, spans_, removed = batch.column("spans"), [], [], []
            bounds = lists.value_lengths().fill_null(0).to_numpy()
            flat = lists.flatten()
            starts, ends = flat.field("start").to_numpy(), flat.field("end").to_numpy()
            at = 0
            for i, n in enumerate(bounds.tolist()):
                text = data[offsets[i] : offsets[i + 1]]
                if not n:
                    kept.append(text.tobytes())
                    spans_.append([])
                    removed.append(0)
                    continue
                s, e = starts[at : at + n], np.maximum.accumulate(ends[at : at + n])
                at += n
                gap = np.flatnonzero(s[1:] > e[:-1])  # spans that touch are one run
                s, e = s[np.concatenate([[0], gap + 1])], e[np.concatenate([gap, [n - 1]])]
                edges = np.zeros(len(text) + 1, np.int8)
                edges[s] += 1
                edges[e] -= 1
                kept.append(text[np.cumsum(edges[:-1]) == 0].tobytes())
                spans_.append([{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist(), strict=True)])
                removed.append(int((e - s).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
                 pa.array(spans_, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary())], names=["id", "n_bytes", "n_removed", "spans", "kept"])

    joined = rows.join(spans, same, "left").select("id", "text", "spans")
    schema = plus_fields(joined.select("id"), ("n_bytes", "long"), ("n_removed", "long"),
                         ("spans", "array<struct<start:long,end:long>>"), ("kept", "binary"))
    return joined.mapInArrow(strip, schema).withColumnRenamed("id", id_col)
