"""Sharding on a consistent-hash ring with virtual nodes and bounded loads (operator 7).

Each shard owns ``vnodes`` points of a hash ring; a key belongs to the next
point clockwise.  A shard takes keys until it holds (1 + slack) times the mean
load; further keys go on clockwise to the next shard with room.  So a shard
exceeds that bound only by a unit that fits nowhere (a single large document
at the end of the walk goes to the least loaded shard), and a new shard moves
only what its points take over plus what overflows differently.

The ring is walked over *units*: equal slices of the ring, each one shard's
worth / ``units_per_shard`` on average.  A text's place is its hash, so copies
lie together; a slice that holds more than a unit's load (a hot group of
copies) is cut further by the hash of the document id.  Unit loads are one
aggregation; the walk sees at most ``2 * shards * units_per_shard`` + shards
numbers whatever the input's size, and the resulting unit table is bounded by
the same figure.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

VNODES = 64
SLACK = 0.001
UNITS_PER_SHARD = 2048


def ring_points(shards: int, vnodes: int = VNODES) -> tuple[list[float], list[int]]:
    """Sorted places in [0, 1) of all virtual nodes, and their shards."""
    points = sorted((int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") / 2**64, s)
                    for s in range(shards) for v in range(vnodes))
    return [p for p, _ in points], [s for _, s in points]


def walk(units: list[tuple[float, int, int]], shards: int, vnodes: int = VNODES, slack: float = SLACK) -> list[int]:
    """A shard for each unit (place on the ring, order within the place, load).

    Units claim their own shard in the order of a hash of their identity, so that
    no part of the ring is favoured; a unit for which its shard has no room goes
    on clockwise.  Where no shard has room for it (a document larger than what
    is left anywhere), the least loaded one takes it.
    """
    points, owners = ring_points(shards, vnodes)
    bound = (1 + slack) * sum(u[2] for u in units) / shards
    load, out = [0] * shards, [0] * len(units)
    claim = [hashlib.sha256(f"{place!r}/{sub}".encode()).digest() for place, sub, _ in units]
    for i in sorted(range(len(units)), key=claim.__getitem__):
        place, _, size = units[i]
        at = bisect.bisect_left(points, place) % len(points)
        tried: set[int] = set()
        while owners[at] in tried or load[owners[at]] + size > bound:
            tried.add(owners[at])
            if len(tried) == shards:
                break
            at = (at + 1) % len(points)
        shard = owners[at] if len(tried) < shards else min(range(shards), key=load.__getitem__)
        out[i] = shard
        load[shard] += size
    return out


def assign_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                  vnodes: int = VNODES, slack: float = SLACK, units_per_shard: int = UNITS_PER_SHARD) -> DataFrame:
    """``id_col``, size, text_crc32, shard and slot of every document row.

    Size is the text's UTF-8 bytes plus 1 (null text: 1; it is placed like an
    empty one).  Slots number a shard's rows from 0 without gaps.  Rows that
    are equal in id and text lie in one unit.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                              F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.xxhash64(text).alias("place")),
                  "ring-rows")
    cells = shards * units_per_shard
    cell = (F.pmod(F.col("place"), F.lit(2**40)) / F.lit(2.0**40 / cells)).cast("int")
    rows = rows.withColumn("cell", cell)
    by_cell = {r["cell"]: (r["load"], r["n"]) for r in
               rows.groupBy("cell").agg(F.sum("size").alias("load"), F.count(F.lit(1)).alias("n")).collect()}
    total = sum(load for load, _ in by_cell.values())
    # Cells above a unit's load are cut into as many parts as they hold units, by the hash of the id.
    parts = {c: int(min(-(-load * cells // total), n)) for c, (load, n) in by_cell.items() if load * cells > 2 * total}
    spark = docs.sparkSession
    hot = spark.createDataFrame([(c, p) for c, p in parts.items() if p > 1], "_cell int, _parts int")
    rows = (rows.join(F.broadcast(hot), F.col("cell") == F.col("_cell"), "left")
            .withColumn("part", F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64("id", "text_crc32"), F.col("_parts")))
                        .otherwise(F.lit(0)).cast("int")).drop("_cell", "_parts"))
    units = sorted((r["cell"], r["part"], r["load"], r["n"]) for r in
                   rows.groupBy("cell", "part").agg(F.sum("size").alias("load"), F.count(F.lit(1)).alias("n")).collect())
    homes = walk([((c + 0.5) / cells, p, load) for c, p, load, _ in units], shards, vnodes, slack)
    first, table = [0] * shards, []
    for (c, p, _, n), shard in zip(units, homes, strict=True):
        table.append((c, p, shard, first[shard]))
        first[shard] += n
    homes_df = spark.createDataFrame(table, "_cell int, _part int, shard int, first long")
    rows = rows.join(F.broadcast(homes_df), (F.col("cell") == F.col("_cell")) & (F.col("part") == F.col("_part")))
    within = F.row_number().over(Window.partitionBy("cell", "part").orderBy("place", "id", "size", "text_crc32")) - 1
    return rows.select(F.col("id").alias(id_col), "size", "text_crc32", "shard",
                       (F.col("first") + within).cast("long").alias("slot"))
