"""Exact Jaccard join of word-shingle sets by several global token orders (operator 5).

1. Equal sets are one class, known by a 128-bit digest; a class is represented
   by its smallest document id.
2. A set linked at similarity t shares at least t of its tokens with one other
   set, so at least that many of its tokens must occur in some other set.
   Tokens are exchanged by hash range as packed arrays, counted, and the
   counts returned to the sets; sets of mostly unique tokens drop out here.
3. The remaining sets' tokens get a document frequency.  Under any global
   order, linked sets share a token among the first n - ceil(t n) + 1.  Three
   orders are used, all rare tokens first, with different hashes and frequency
   steps; sets that share a prefix token under the first are in one block, and
   a pair of a block is a candidate if it shares prefix tokens under each.
4. Candidates of a block are verified exactly.  A pair already connected by
   verified links is not looked at, so a group of thousands of near copies
   needs few verifications.  Large blocks are split: every part is verified by
   itself and with the first; whatever then lies outside the block's dominant
   component is verified against the sets it shares prefix tokens with.  No pair
   that could connect two components is left out, and no task holds more than
   two parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    Rolling, fresh, lower_ascii, mix, shingles, small_or_plain, staged, steps, text_bytes, words_of)
from tidemark.llm.graph import components

WORDS, PERCENT = 5, 75
#: Text bytes per hash range and tokens per exchanged window.
RANGE_BYTES, WINDOW_TOKENS = 16_000_000, 1_000_000
#: Slots that one window is dealt to, and text bytes whose tokens are dealt again in one task.
FANOUT, DEAL_BYTES = 4096, 1_000_000_000
PART_SETS = 1024
CELL_SETS = 1024
ORDERS = 3


def token_sets(data: np.ndarray, offsets: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens (hashed shingles) of all texts, sorted by (text, token), and their text numbers.

    A text with fewer than ``n_words`` words is one token, its whole word sequence.
    """
    data = lower_ascii(data)
    first, end, text = words_of(data, offsets)
    words = Rolling(data).spans(first, end)
    token, of = shingles(words, text, n_words)
    count = np.bincount(text, minlength=len(offsets) - 1)
    begin = np.cumsum(count) - count
    for n in range(1, n_words):
        short = np.flatnonzero(count == n)
        h = np.full(len(short), n, np.uint64)
        for i in range(n):
            h = mix(h + words[begin[short] + i]) * np.uint64(0xD6E8FEB86659FD93)
        token, of = np.concatenate([token, mix(h)]), np.concatenate([of, short])
    order = np.lexsort((token, of))
    token, of = token[order], of[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (of[1:] != of[:-1])
    return token[new], of[new]


def digests(token: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two order-free 64-bit digests of each of ``n`` sets."""
    size = np.bincount(of, minlength=n)
    out = []
    for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        total = np.zeros(len(token) + 1, np.uint64)
        np.cumsum(mix(token ^ np.uint64(salt)), out=total[1:])
        upto = np.cumsum(size)
        out.append(mix(total[upto] - total[upto - size] + size.astype(np.uint64)))
    return size, *out


def set_digests(docs: DataFrame, n_words: int = WORDS) -> DataFrame:
    """id, hash (of the text), n_shingles, d1 and d2 of every row of ``docs`` (id, hash, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            token, of = token_sets(*text_bytes(batch.column("text")), n_words)
            size, d1, d2 = digests(token, of, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("hash"), pa.array(size), pa.array(d1.view(np.int64)),
                 pa.array(d2.view(np.int64))], names=["id", "hash", "n_shingles", "d1", "d2"])

    return docs.mapInArrow(run, "id long, hash long, n_shingles long, d1 long, d2 long")


def _range_of(h: np.ndarray, n: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _sum_by(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    unique, where = np.unique(key, return_inverse=True)
    return unique, *(np.bincount(where, weights=v, minlength=len(unique)).astype(np.int64) for v in values)


def _levels(ranges: int) -> list[int]:
    """Ranges per slot of every level of dealing: a slot of one level has at most ``FANOUT`` of the next."""
    out = [1]
    while out[0] * FANOUT < ranges:
        out.insert(0, out[0] * FANOUT)
    return out


def _groups(key: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, begin, end) of the runs of a sorted array."""
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
    for k, a, b in zip(key[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(key)], strict=False):
        yield k, a, b


def deal_tokens(t: np.ndarray, d: np.ndarray, common: np.ndarray, own: tuple[np.ndarray, ...], ranges: int,
                per_slot: int, within: tuple[int, int]) -> pa.RecordBatch:
    """Tokens ``t`` of sets ``d``, tokens without a set and the sets' own counts as one packed row per slot.

    ``within``: the ranges (begin, end) that all tokens lie in; a slot of them
    carries ``own``.  In the last level (``per_slot`` = 1) tokens lose their
    upper half, which follows from the range but for a few.
    """
    kind = np.uint32 if per_slot == 1 else np.uint64
    r = _range_of(t, ranges) // per_slot
    order = np.lexsort((d, r))
    t, d, r = t[order], d[order], r[order]
    where = _range_of(common, ranges) // per_slot
    order = np.argsort(where, kind="stable")
    common, where = common[order], where[order]
    rows: dict[int, list[bytes]] = {}

    def row(k: int) -> list[bytes]:
        return rows.setdefault(k, [b""] * 7)

    for k, a, b in _groups(r):
        head = np.append(True, d[a + 1 : b] != d[a : b - 1])  # runs of one set
        size = np.diff(np.append(np.flatnonzero(head), b - a))
        row(k)[:3] = d[a:b][head].tobytes(), size.astype(np.uint32).tobytes(), t[a:b].astype(kind).tobytes()
    for k, a, b in _groups(where):
        row(k)[3] = common[a:b].astype(kind).tobytes()
    if len(own[0]):
        begin, end = within
        home = begin + int(own[0][0] % np.uint64(end - begin))
        row(home // per_slot)[4:] = [x.tobytes() for x in own]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(rows), pa.int32()), *(pa.array([x[i] for x in rows.values()], pa.binary()) for i in range(7))],
        names=["slot", "sets", "sizes", "tokens", "common", "own", "n", "local"])


def _by_slot(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(slot, bytes of each packed column) of rows sorted by slot, joined up to ``limit`` bytes."""
    at, parts, held = -1, [], 0
    for batch in batches:
        columns = [text_bytes(batch.column(i)) for i in range(1, batch.num_columns)]
        sizes = np.cumsum(sum(np.diff(offsets) for _, offsets in columns))
        for k, a, b in _groups(batch.column(0).to_numpy()):
            while a < b:
                if parts and (k != at or held >= limit):
                    yield at, [np.concatenate(p) for p in zip(*parts, strict=True)]
                    parts, held = [], 0
                before = int(sizes[a - 1]) if a else 0
                upto = min(b, max(a + 1, int(np.searchsorted(sizes, before + limit - held, "right"))))
                parts.append([data[offsets[a] : offsets[upto]].copy() for data, offsets in columns])
                at, held, a = k, held + int(sizes[upto - 1]) - before, upto
    if parts:
        yield at, [np.concatenate(p) for p in zip(*parts, strict=True)]


def _gathered(packed: DataFrame, ranges: int, per_slot: int) -> DataFrame:
    """Packed rows with those of a slot together, a large slot in several tasks."""
    turns = max(1, per_slot * RANGE_BYTES // DEAL_BYTES)
    turn = F.pmod(F.xxhash64(*packed.columns[1:]), F.lit(turns))
    return (packed.withColumn("turn", turn).repartition(-(-ranges // per_slot) * turns, "slot", "turn")
            .drop("turn").sortWithinPartitions("slot"))


def with_shared_tokens(docs: DataFrame, percent: int, n_words: int, total_bytes: int) -> DataFrame:
    """d1 of the sets of which at least ``percent`` % of the tokens occur in another set (or in a few more).

    Tokens travel as their low 32 bits within a hash range, which can only
    make more of them look shared.  A token found in several sets of one
    window travels once, without their digests, so what a common token sends
    follows the windows and not the documents.  A window sends at most
    ``FANOUT`` rows: beyond so many ranges it deals to slots of ranges first, whose
    rows are joined to windows and dealt again, and counts go back the same way.
    """
    ranges = max(16, -(-total_bytes // RANGE_BYTES))
    levels = _levels(ranges)
    window, limit = WINDOW_TOKENS, WINDOW_TOKENS * 8

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, sets, seen, held = [], [], set(), 0

        def flush() -> pa.RecordBatch:
            t, d = np.concatenate(tokens), np.concatenate(sets)
            order = np.argsort(t, kind="stable")
            ts = t[order]
            start = np.ones(len(ts), bool)
            start[1:] = ts[1:] != ts[:-1]
            run = np.cumsum(start) - 1
            length = np.bincount(run)
            single = np.zeros(len(ts), bool)
            single[order] = length[run] == 1
            own = _sum_by(d, np.ones(len(d)), ~single)
            return deal_tokens(t[single], d[single], ts[start][length > 1], own, ranges, levels[0], (0, ranges))

        for batch in steps(batches):
            token, of = token_sets(*text_bytes(batch.column("text")), n_words)
            _, d1, _ = digests(token, of, batch.num_rows)
            new = np.zeros(batch.num_rows, bool)
            for i, d in enumerate(d1.tolist()):  # copies within a window are one set
                if d not in seen:
                    seen.add(d)
                    new[i] = True
            keep = new[of]
            tokens.append(token[keep])
            sets.append(d1[of[keep]])
            held += int(keep.sum())
            if held >= window:
                yield flush()
                tokens, sets, seen, held = [], [], set(), 0
        if held:
            yield flush()

    def deal_again(above: int, per_slot: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for slot, columns in _by_slot(batches, limit):
                sets, sizes, token, common, *own = (
                    x.view(k) for x, k in zip(columns, (np.uint64, np.uint32, np.uint64, np.uint64, np.uint64,
                                                        np.int64, np.int64), strict=True))
                yield deal_tokens(token, np.repeat(sets, sizes), np.unique(common), tuple(own), ranges, per_slot,
                                  (slot * above, min(ranges, (slot + 1) * above)))
        return run

    def gather(column: pd.Series, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(column), kind)

    def home_rows(key: np.ndarray, total: np.ndarray, most: np.ndarray, per_slot: int) -> tuple[list, ...]:
        """Counts of sorted keys as one packed row per slot."""
        found = list(_groups(_range_of(key, ranges) // per_slot))
        return [k for k, _, _ in found], *([x[a:b].tobytes() for _, a, b in found] for x in (key, total, most))

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        token, common = gather(rows["tokens"], np.uint32), gather(rows["common"], np.uint32)
        of = np.repeat(gather(rows["sets"], np.uint64), gather(rows["sizes"], np.uint32))
        kinds, times = np.unique(np.concatenate([token, common, common]), return_counts=True)
        shared = times[np.searchsorted(kinds, token)] > 1
        own, n, local = (gather(rows[c], k) for c, k in (("own", np.uint64), ("n", np.int64), ("local", np.int64)))
        of = of[shared]
        key, total, most = _sum_by(np.concatenate([of, own]), np.concatenate([np.ones(len(of)), local]),
                                   np.concatenate([np.zeros(len(of)), n]))
        slot, sets, total, most = home_rows(key, total, most, levels[0])
        return pd.DataFrame({"slot": np.array(slot, np.int32), "sets": sets, "total": total, "n": most})

    def count_again(per_slot: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, (key, total, most) in _by_slot(batches, limit):
                order = np.argsort(key.view(np.uint64), kind="stable")
                slot, *packed = home_rows(*(x.view(k)[order] for x, k in (
                    (key, np.uint64), (total, np.int64), (most, np.int64))), per_slot)
                yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), *(pa.array(x, pa.binary()) for x in packed)],
                                                 names=["slot", "sets", "total", "n"])
        return run

    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        # A set met in several windows has its size in each, and its local counts too: more than it needs, never less.
        key, where = np.unique(gather(rows["sets"], np.uint64), return_inverse=True)
        total = np.bincount(where, weights=gather(rows["total"], np.int64), minlength=len(key))
        n = np.full(len(key), np.iinfo(np.int64).max)
        sizes = gather(rows["n"], np.int64)
        np.minimum.at(n, where, np.where(sizes > 0, sizes, np.iinfo(np.int64).max))
        return pd.DataFrame({"d1": key[100 * total >= percent * n].view(np.int64)})

    token_rows = "slot int, sets binary, sizes binary, tokens binary, common binary, own binary, n binary, local binary"
    count_rows = "slot int, sets binary, total binary, n binary"
    packed = docs.mapInArrow(windows, token_rows)
    for above, per_slot in pairwise(levels):
        packed = _gathered(packed, ranges, above).mapInArrow(deal_again(above, per_slot), token_rows)
    counted = packed.groupBy("slot").applyInPandas(count, count_rows)
    for above, per_slot in pairwise(levels):
        counted = _gathered(counted, ranges, above).mapInArrow(count_again(per_slot), count_rows)
    return counted.groupBy("slot").applyInPandas(decide, "d1 long")


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return n + (-percent * n) // 100 + 1


def verify_block(rep: np.ndarray, sets: list[np.ndarray], prefixes: list[list[np.ndarray]], side: np.ndarray,
                 group: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (index pairs) that connect all of what the pairs of this block connect.

    ``side`` 0 and 1: pairs of two rows of side 0 are left out (they are
    verified elsewhere).  ``group``: components known before.  Pairs whose
    rows are connected already are not verified.
    """
    m = len(rep)
    parent = list(range(m))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first_of: dict[int, int] = {}
    for i, g in enumerate(group.tolist()):
        parent[i] = first_of.setdefault(g, i)

    def inverted(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(x) for x in lists])
        values, where = np.unique(np.concatenate(lists), return_inverse=True)
        row = np.repeat(np.arange(m), size)
        order = np.argsort(where, kind="stable")
        return where, row[order], np.concatenate([[0], np.cumsum(np.bincount(where, minlength=len(values)))])

    def hits(index: tuple, begin: int, end: int) -> np.ndarray:
        where, rows, bounds = index
        own = where[begin:end]
        if not len(own):
            return np.zeros(0, np.int64)
        return np.concatenate([rows[bounds[t] : bounds[t + 1]] for t in own.tolist()])

    n = np.array([len(s) for s in sets])
    indexes = [inverted([p[o] for p in prefixes]) for o in range(ORDERS)]
    prefix_at = [np.concatenate([[0], np.cumsum([len(p[o]) for p in prefixes])]) for o in range(ORDERS)]
    full, full_at = None, np.concatenate([[0], np.cumsum(n)])
    links = []
    roots = np.array([find(i) for i in range(m)])
    for i in range(m):
        open_ = (np.arange(m) > i) & (roots != roots[i])
        if not side[i]:
            open_ &= side == 1
        if not open_.any():
            continue
        open_ &= (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
        for index, at in zip(indexes, prefix_at, strict=True):
            if not open_.any():
                break
            met = np.zeros(m, bool)
            met[hits(index, at[i], at[i + 1])] = True
            open_ &= met
        if not open_.any():
            continue
        if full is None:
            full = inverted(sets)
        common = np.bincount(hits(full, full_at[i], full_at[i + 1]), minlength=m)
        linked = np.flatnonzero(open_ & (100 * common >= percent * (n + n[i] - common)))
        for j in linked.tolist():
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((i, j))
        if len(linked):
            roots = np.array([find(x) for x in range(m)])
    return links


def _classes_and_links(docs: DataFrame, n_words: int, percent: int, part_sets: int) -> DataFrame:
    """id, hash, n_shingles, component (a number) and least (its smallest id) of every row of ``docs`` (id, hash, text).

    Rows without words or without id in their class have no component.
    """
    rows = docs
    sets = staged(set_digests(rows, n_words), "jaccard-digests")
    # Classes go by a number of their own (fixed once written): one id may name rows of several classes.
    classes = staged(sets.where("n_shingles > 0 AND id IS NOT NULL").groupBy("n_shingles", "d1", "d2")
                     .agg(F.min("id").alias("rep")).withColumn("cls", F.monotonically_increasing_id()), "jaccard-classes")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    alive = staged(with_shared_tokens(rows, percent, n_words, total), "jaccard-alive")
    reps = staged(classes.join(small_or_plain(alive), "d1", "left_semi"), "jaccard-reps")

    # The remaining classes' token sets; from here on, id is the class number.
    member = F.struct("n_shingles", "d1", "d2", "cls")
    wanted = small_or_plain(reps.select(F.col("rep").alias("id"), member.alias("set"))
                            .groupBy("id").agg(F.collect_set("set").alias("wanted")))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            token, of = token_sets(*text_bytes(batch.column("text")), n_words)
            size, d1, d2 = digests(token, of, batch.num_rows)
            upto = np.cumsum(size)
            lists = [token[e - n : e].view(np.int64) for e, n in zip(upto.tolist(), size.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(size),
                 pa.array(lists, pa.list_(pa.int64())), batch.column("wanted")],
                names=["d1", "d2", "n", "tokens", "wanted"])

    kind = reps.select(F.array(member)).schema[0].dataType.simpleString()
    found = F.filter("wanted", lambda w: (w["d1"] == F.col("d1")) & (w["d2"] == F.col("d2")))
    owned = (rows.select("id", "text").join(wanted, "id").mapInArrow(
        tokens, f"d1 long, d2 long, n long, tokens array<long>, wanted {kind}")
        .select(F.get(found, F.lit(0))["cls"].alias("id"), "d1", "n", "tokens")
        .where("id IS NOT NULL").dropDuplicates(["id"]))
    owned = staged(owned, "jaccard-sets")

    # Prefixes under each order.  Tokens of one set only come first in all orders and join nothing.
    flat = owned.select("id", "d1", "n", F.explode("tokens").alias("token"))
    # Staged, so that the join is between plain tables and a common token's sets are split over tasks.
    frequency = staged(flat.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "jaccard-frequency")
    shared = (flat.join(frequency, "token").groupBy("id", "d1", "n")
              .agg(F.collect_list(F.struct("df", "token")).alias("shared")))
    allowed = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("shared"))

    def ordered(step, salt: int) -> F.Column:
        by = F.array_sort(F.transform("shared", lambda s: F.struct(
            step(s["df"]).alias("step"), F.xxhash64(F.lit(salt), s["token"]).alias("hash"), s["token"].alias("token"))))
        return F.transform(F.slice(by, F.lit(1), F.col("allowed")), lambda s: s["token"])

    exact = lambda df: df.cast("int")
    rough = lambda df: F.floor(F.log2(df)).cast("int")
    prefixed = staged(shared.withColumn("allowed", allowed.cast("int")).where("allowed > 0").select(
        "id", "d1", ordered(exact, 1).alias("p0"), ordered(exact, 2).alias("p1"), ordered(rough, 3).alias("p2")),
        "jaccard-prefixes")
    met = staged(prefixed.select("id", F.explode("p0").alias("token")), "jaccard-prefix-tokens")
    least = met.groupBy("token").agg(F.min("id").alias("least"))
    blocks = components(met.join(least, "token").where("id <> least").select(
        F.col("id").alias("a"), F.col("least").alias("b")), "jaccard-blocks")

    members = (owned.select("id", "d1", "tokens").join(prefixed, ["id", "d1"])
               .join(blocks.select(F.col("node").alias("id"), F.col("component").alias("block")), "id"))
    sizes = members.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / part_sets).cast("int").alias("parts"))
    members = staged(members.join(sizes, "block")
                     .withColumn("part", F.pmod(F.xxhash64("id", "d1"), F.col("parts")).cast("int")), "jaccard-members")
    n_members = members.count()
    cells = max(1, -(-n_members // CELL_SETS))

    def check(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in frame.groupby("task", sort=False):
            prefix = [[np.asarray(p, np.int64) for p in three] for three in zip(g["p0"], g["p1"], g["p2"], strict=True)]
            rep = g["id"].to_numpy()
            links = verify_block(rep, [np.asarray(x, np.int64) for x in g["tokens"]], prefix, g["side"].to_numpy(),
                                 g["known"].to_numpy(), percent)
            out += [(rep[i], rep[j]) for i, j in links]
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    def verified(tasks: DataFrame, name: str) -> DataFrame:
        cell = F.pmod(F.xxhash64("task"), F.lit(cells))
        return staged(tasks.select(cell.alias("cell"), "task", "side", "known", "id", "tokens", "p0", "p1", "p2")
                      .groupBy("cell").applyInPandas(check, "a long, b long"), name)

    # Every part by itself (side 1), together with the block's part 0 (side 0).
    own = members.withColumn("with", F.col("part")).withColumn("side", F.lit(1))
    zero = (members.where("parts > 1 AND part = 0")
            .withColumn("with", F.explode(F.sequence(F.lit(1), F.col("parts") - 1))).withColumn("side", F.lit(0)))
    links = verified(own.unionByName(zero).withColumn("task", F.concat_ws("/", "block", "with"))
                     .withColumn("known", F.xxhash64("id", "d1")), "jaccard-links")
    large = members.where("parts > 1")
    if not large.isEmpty():
        so_far = components(links, "jaccard-so-far")
        placed = (large.join(so_far, F.col("id") == F.col("node"), "left")
                  .withColumn("known", F.coalesce("component", "id")).drop("node", "component"))
        placed = staged(placed, "jaccard-large")
        main = (placed.groupBy("block", "known").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("block").agg(F.max_by("known", F.struct("n", "known")).alias("main")))
        outside = staged(placed.join(main, "block").where("known <> main").drop("main"), "jaccard-outside")
        links = links.unionByName(_links_by_token(placed, outside, met, verified, percent, part_sets))
    joined = components(links, "jaccard-components")
    grouped = staged(classes.join(joined, F.col("cls") == F.col("node"), "left")
                     .withColumn("component", F.coalesce("component", "cls")).drop("node", "cls"), "jaccard-groups")
    named = grouped.groupBy("component").agg(F.min("rep").alias("least")).withColumnRenamed("component", "_component")
    per_class = (grouped.join(named, F.col("component") == F.col("_component"))
                 .select(F.col("n_shingles").alias("_n"), F.col("d1").alias("_d1"), F.col("d2").alias("_d2"),
                         "component", "least"))
    same = (F.col("n_shingles") == F.col("_n")) & (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2"))
    return sets.join(per_class, same, "left").select("id", "hash", "n_shingles", "component", "least")


def _links_by_token(placed: DataFrame, outside: DataFrame, met: DataFrame, verified, percent: int,
                    hot: int) -> DataFrame:
    """Links between sets ``outside`` their block's main component and any of the block's others.

    Linked sets share a prefix token.  A token of at most ``hot`` sets gives
    pairs of ids, which must pass the length filter and the other two orders
    before their tokens are fetched; so what is handed to verification follows
    the pairs that share rare tokens, not the block's size.  Sets of a token
    that more hold meet part by part in numpy, as blocks do.
    """
    # Tokens of the sets in question: those that some outside set has, and how many sets have them.
    of_outside = met.join(outside.select("id").distinct(), "id", "left_semi").select("token").distinct()
    holders = met.join(of_outside, "token", "left_semi")
    counted = staged(holders.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1"), "jaccard-holders")
    rare = holders.join(counted.where(F.col("sets") <= hot).select("token"), "token", "left_semi")
    left = rare.join(outside.select("id", "known"), "id").select("token", F.col("id").alias("a"), F.col("known").alias("ka"))
    right = rare.join(placed.select("id", "known"), "id").select("token", F.col("id").alias("b"), F.col("known").alias("kb"))
    pairs = staged(left.join(right, "token").where("ka <> kb").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jaccard-pairs")
    small = placed.select("id", F.size("tokens").alias("n"), "p1", "p2")
    sides = pairs
    for side in "ab":
        sides = sides.join(small.select(*[F.col(c).alias(f"{c}_{side}") for c in small.columns]),
                           F.col(side) == F.col(f"id_{side}")).drop(f"id_{side}")
    sides = sides.where((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
                        & F.arrays_overlap("p1_a", "p1_b") & F.arrays_overlap("p2_a", "p2_b")).select("a", "b")
    sides = staged(sides, "jaccard-candidates")
    full = placed.select("id", "tokens")
    checked = (sides.join(full.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a")
               .join(full.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b"))
    common = F.size(F.array_intersect("x", "y"))
    links = staged(checked.withColumn("common", common).where(
        100 * F.col("common") >= percent * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b"), "jaccard-rare-links")

    often = staged(holders.join(counted.where(F.col("sets") > hot).select("token"), "token", "left_semi")
                   .select("id").distinct(), "jaccard-often")
    if often.isEmpty():
        return links
    out = outside.join(often, "id", "left_semi")
    rest = placed.join(often, "id", "left_semi")
    rest_parts = rest.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / hot).cast("int").alias("rests"))
    out_parts = out.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / hot).cast("int").alias("outs"))
    number = lambda name: F.pmod(F.xxhash64("d1", "id"), F.col(name)).cast("int")
    out = (out.join(rest_parts, "block").join(out_parts, "block").withColumn("out", number("outs"))
           .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("rests") - 1))).withColumn("side", F.lit(1)))
    rest = (rest.join(rest_parts, "block").join(out_parts, "block").withColumn("with", number("rests"))
            .withColumn("out", F.explode(F.sequence(F.lit(0), F.col("outs") - 1))).withColumn("side", F.lit(0)))
    more = verified(out.unionByName(rest).withColumn("task", F.concat_ws("/", "block", "with", "out")), "jaccard-more-links")
    return links.unionByName(more)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = WORDS,
                       percent: int = PERCENT, part_sets: int = PART_SETS) -> DataFrame:
    """``id_col``, n_shingles and component_id of every document row.

    A set holds the distinct ``n_words``-word shingles of the text with A-Z
    lower-cased (fewer words: the whole sequence as one; null or wordless
    text: empty, linked with nothing).  Rows link when 100 * intersection is
    at least ``percent`` * union; the component is the smallest id reachable,
    the row's own included.  Ids are integers.  Rows that repeat an id are each
    judged by their own text.  Rows with a null id get the component of their
    class, if it has an id, and connect nothing.  Other columns are not read.
    """
    found = _classes_and_links(_rows(docs, id_col, text_col), n_words, percent, part_sets)
    return found.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("least", "id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = WORDS,
             percent: int = PERCENT, part_sets: int = PART_SETS) -> DataFrame:
    """One row of each group of linked documents, unchanged: that of the smallest id.

    If several texts of a group have that id, the one with the smallest text
    hash stays; of rows that repeat id and text, one.  Rows without words are
    linked with nothing and all stay.  Of rows without id, one of each text
    stays.
    """
    found = staged(_classes_and_links(_rows(docs, id_col, text_col), n_words, percent, part_sets), "jaccard-found")
    worded = found.where("n_shingles > 0")
    one = (worded.where("id IS NOT NULL").groupBy("component").agg(F.min(F.struct("id", "hash")).alias("one"))
           .select("one.*").distinct())
    id_, hash_ = fresh(docs, "_keep_id", "_keep_hash")
    stays = staged(one.unionByName(worded.where("id IS NULL").select("id", "hash").distinct())
                   .select(F.col("id").alias(id_), F.col("hash").alias(hash_)), "jaccard-stays")
    text = F.col(f"`{text_col}`").cast("string")
    own_id = F.col(f"`{id_col}`").cast("long")
    same = own_id.eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(hash_))
    wordless = ~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = docs.where(~wordless).join(stays, same, "left_semi")
    again = staged(worded.groupBy("id", "hash").count().where("count > 1")
                   .select(F.col("id").alias(id_), F.col("hash").alias(hash_)), "jaccard-repeated")
    out = docs.where(wordless)
    if again.isEmpty():
        return out.unionByName(kept)
    repeated = kept.join(again, same, "left_semi").dropDuplicates([id_col, text_col])
    return out.unionByName(kept.join(again, same, "left_anti")).unionByName(repeated)
