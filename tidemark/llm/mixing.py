"""Mixing sources to target weights by weighted fair queueing (operator 3).

Each source queues its documents in a fixed shuffled order, again and again
for as many rounds as the size limit allows.  A copy's virtual finish time is
the source's cumulative size up to and including it, divided by the source's
target.  All copies are sorted by finish time and served until the budget is
spent, so that at any moment each source has had its share, up to one document.

Both cumulative sums (per source, and over the global order) are taken in two
steps: sums per range of the sort key, then running sums inside each range.
Ranges hold a bounded share of the rows, so a source with a third of all rows,
or the whole corpus, is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, small_or_plain, staged

#: Rows per range of a distributed running sum, on average.
RANGE_ROWS = 4_000
#: Cells that one task adds up.
SPAN_CELLS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_sum(df: DataFrame, value: str, group: list[str], cell: Column, order: list[str], out: str,
                name: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over rows of the same group up to and including the row.

    Rows are ordered by (cell, order); ``cell`` must rise with the order.  Cell
    sums are added up along the cells of a span, and these along the spans of a group,
    so one task sees at most a cell's rows, SPAN_CELLS cells or a group's spans.
    """
    df = df.withColumn("_cell", cell)
    cells = staged(df.groupBy(*group, "_cell").agg(F.sum(value).alias("_sum")), name)
    # Cells in turn are summed over spans of SPAN_CELLS, so that no task sees all cells of a large group.
    cells = cells.withColumn("_span", F.floor(F.col("_cell") / SPAN_CELLS).cast("long"))
    spans = cells.groupBy(*group, "_span").agg(F.sum("_sum").alias("_in_span"))
    earlier = Window.partitionBy(*group).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_spans", F.coalesce(F.sum("_in_span").over(earlier), F.lit(0)))
    spans = spans.select(*[F.col(g).alias(f"_s{i}") for i, g in enumerate(group)], F.col("_span").alias("_of"), "_spans")
    of_span = F.col("_span") == F.col("_of")
    for i, g in enumerate(group):
        of_span = of_span & F.col(g).eqNullSafe(F.col(f"_s{i}"))
    before = Window.partitionBy(*group, "_span").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (cells.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).join(spans, of_span)
             .withColumn("_before", F.col("_before") + F.col("_spans")))
    cells = cells.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                         F.col("_cell").alias("_c"), "_before")
    same = F.col("_cell").eqNullSafe(F.col("_c"))
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    inside = Window.partitionBy(*group, "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn(out, F.sum(value).over(inside)).join(cells, same)
            .withColumn(out, F.col(out) + F.col("_before"))
            .drop("_cell", "_c", "_before", *[f"_g{i}" for i in range(len(group))]))


def default_weights(sources: DataFrame, source_col: str = "source") -> DataFrame:
    """Sources by code point, null last, weigh 1, 2, 3, repeating (one row per source)."""
    place = F.row_number().over(Window.orderBy(F.col(source_col).asc_nulls_last())) - 1
    return sources.select(source_col).distinct().select(source_col, (place % 3 + 1).cast("double").alias("weight"))


def targets(sources: DataFrame, budget: float, max_repeats: int = 3) -> DataFrame:
    """``target`` of each source (with weight and source_size): its share of the budget by weight.

    No target exceeds ``max_repeats`` times its source's size; what such
    sources leave is shared by weight among the others until none is above.
    Only two sums per round reach the driver.
    """
    cap = F.col("source_size") * max_repeats
    full = F.lit(False)
    rate = None
    while True:
        free, weights, n = sources.select(
            F.lit(float(budget)) - F.coalesce(F.sum(F.when(full, cap)), F.lit(0)),
            F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))).first()
        if not weights:
            return sources.withColumn("target", cap.cast("double"))
        rate = F.lit(max(0.0, float(free))) * F.col("weight") / F.lit(float(weights))
        over = full | (rate > cap)
        if sources.where(over).count() == n:
            return sources.withColumn("target", F.when(full, cap.cast("double")).otherwise(rate))
        full = over


def content_hash(docs: DataFrame) -> Column:
    """Tells rows of one id apart (map columns are not looked at)."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, t in docs.dtypes if "map<" not in t])


def mix_sources(docs: DataFrame, sizes: Column, weights: DataFrame | None = None, id_col: str = "doc_id",
                source_col: str = "source", max_repeats: int = 3, budget: float | None = None,
                seed: int = 0, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``id_col``, row hash, size, source, source_size, target, copies, part and taken of every document row.

    ``sizes`` is a long expression over ``docs``; ``budget`` defaults to the sum
    of all sizes.  ``weights`` has ``source_col`` and weight (default:
    :func:`default_weights`; null-safe; sources without one weigh 0).  A row's
    ``copies`` (0 to ``max_repeats``) are served whole; of the copy that a source is
    serving when the budget ends it takes a ``part``, up to the source's target (identical
    rows share theirs).  ``taken`` is both together, and the budget is not exceeded.  The order inside a source is a hash of id,
    text row and ``seed``; identical rows are queued one after the other.
    Rows of size 0 are taken once and cost nothing.  Null sources are a
    source of their own.
    """
    # One row per distinct (id, source, size, content); n identical rows are one entry served n times as large.
    content = content_hash(docs)
    queue = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                         F.coalesce(sizes, F.lit(0)).cast("long").alias("size"), content.alias("row"))
             .groupBy("id", "source", "size", "row").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("key", F.xxhash64(F.lit(seed), "id", "row")).withColumn("load", F.col("size") * F.col("n")))
    queue = staged(queue, "mix-queue")
    sources = queue.groupBy("source").agg(F.sum("load").alias("source_size"),
                                          F.ceil(F.count(F.lit(1)) / range_rows).alias("ranges"))
    total, rows = queue.agg(F.sum("load"), F.count(F.lit(1))).first()
    budget = float(total or 0) if budget is None else float(budget)
    weights = default_weights(sources) if weights is None else weights
    weights = weights.select(F.col(weights.columns[0]).alias("_w_source"), F.col("weight"))
    sources = (sources.join(weights, F.col("source").eqNullSafe(F.col("_w_source")), "left").drop("_w_source")
               .fillna(0.0, ["weight"]))
    sources = staged(targets(staged(sources, "mix-sources"), budget, max_repeats), "mix-targets").select(
        F.col("source").alias("_s"), "source_size", "target", "ranges")
    known = small_or_plain(sources)

    # Queue positions: ranges of the 64-bit key, as many as the source's rows ask for.
    queue = queue.join(known, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    cell = F.floor(F.col("key") / (F.lit(2.0**64) / F.col("ranges")))
    queue = running_sum(queue, "load", ["source"], cell, ["key", "id", "row"], "upto", "mix-source-sums")

    n_ranges = max(1, -(-rows // range_rows))
    # Copies with their virtual finish times; a whole round of a source takes source_size / target.
    turn = F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("turn")
    finish = (F.col("turn") * F.col("source_size") + F.col("upto")) / F.col("target")
    copies = (queue.where((F.col("load") > 0) & (F.col("target") > 0))
              .select("source", "key", "id", "row", "load", "source_size", "target", "upto", turn)
              .withColumn("finish", finish))
    # At virtual time 1 every source has had its target and the budget is spent: later copies need no sorting.
    copies = copies.where(F.col("finish") <= 1)
    served = running_sum(copies, "load", [], F.floor(F.col("finish") * n_ranges).cast("long"),
                         ["finish", F.col("source").asc_nulls_last(), "turn", "key", "id", "row"], "spent",
                         "mix-global-sums")
    served = served.where(F.col("spent") <= budget).select("id", "row", "source", "key")
    served = served.groupBy("id", "row", "source", "key").agg(F.count(F.lit(1)).alias("copies"))
    out = queue.join(served.select(*[F.col(c).alias(f"_{c}") for c in served.columns]),
                     F.col("id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")) & (F.col("key") == F.col("_key"))
                     & F.col("source").eqNullSafe(F.col("_source")), "left")
    copies = F.when(F.col("load") == 0, F.lit(1)).otherwise(F.coalesce("_copies", F.lit(0))).cast("int")
    # The copy a source is serving when the budget ends: what lies before the source's target.
    start = copies * F.col("source_size") + F.col("upto") - F.col("load")
    part = F.least(F.greatest(F.floor("target") - start, F.lit(0)), F.col("load"))
    part = F.when((F.col("load") > 0) & (copies < max_repeats), F.floor(part / F.col("n"))).otherwise(F.lit(0)).cast("long")
    return out.select(F.col("id").alias(id_col), "row", "n", F.col("source").alias(source_col), "size", "source_size",
                      "target", copies.alias("copies"), part.alias("part"), (copies * F.col("size") + part).alias("taken"))


def repeat_rows(docs: DataFrame, sizes: Column, id_col: str = "doc_id", source_col: str = "source", **kw) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix_sources` takes it; columns unchanged.

    Rows stay whole: a part counts as a copy if it is at least half of the row.
    """
    mixed = mix_sources(docs, sizes, id_col=id_col, source_col=source_col, **kw)
    times = F.col("copies") + F.when((F.col("part") > 0) & (2 * F.col("part") >= F.col("size")), 1).otherwise(0)
    own_id, own_row, own_times, turn = fresh(docs, "_mix_id", "_mix_row", "_mix_copies", "_mix_turn")
    copies = staged(mixed.withColumn("times", times).where("times > 0").select(
        F.col(id_col).alias(own_id), F.col("row").alias(own_row), F.col("times").alias(own_times)), "mix-copies")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(own_id)) & (content_hash(docs) == F.col(own_row))
    taken = docs.join(copies, same)
    return (taken.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(own_times).cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
