"""Transpose of matrices of any size: tiles are exchanged, each is turned inside a task.

``reshape.transpose`` has a column per position.  Here positions and columns
are rows of the result: a matrix row is cut into pieces of ``tile_cols``
values, the pieces of ``tile_rows`` consecutive positions meet in one tile, and
the tile is turned there.  One shuffle moves each value once; a task holds one
tile at a time, so neither a long series nor a wide matrix is ever gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.recent import _as_list
from tidemark.sources.records import barrier

TILE_ROWS, TILE_COLS = 4096, 64


def transpose_matrix(df: DataFrame, row_col: str, array_col: str, series_cols: str | Sequence[str] = (),
                     tile_rows: int = TILE_ROWS, tile_cols: int = TILE_COLS) -> DataFrame:
    """Rows of a matrix -> its columns, in blocks of ``tile_rows`` values.

    ``row_col`` is the row's position (a whole number from 0, as of
    ``reshape.row_positions``), ``array_col`` its values; rows may differ in
    length.  Result: the series columns, ``column`` (from 0), ``block``,
    ``start`` (= block * tile_rows) and ``values``, where ``values[i]`` is the
    entry at position ``start + i``.

    Entries that are not there (a missing position, a row too short) are null;
    ``values`` ends at the last position that has a piece in its tile, and tiles
    without any have no row.  A null or empty array adds nothing.  A
    null, negative or repeated position of another row fails the job.  Other
    columns are left out.
    """
    if tile_rows < 1 or tile_cols < 1:
        raise ValueError("tile_rows and tile_cols must be >= 1")
    series = _as_list(series_cols)
    own = [f"__s{i}" for i in range(len(series))]
    none = F.lit(None).cast(df.schema[array_col].dataType.elementType)
    pos = F.col(row_col).cast("long")
    sound = F.when(pos >= 0, pos).otherwise(F.raise_error(F.concat(
        F.lit("transpose needs positions from 0, got "), F.coalesce(pos.cast("string"), F.lit("null")))))
    rows = (df.where(F.size(array_col) > 0)
            .select(*[F.col(s).alias(o) for s, o in zip(series, own, strict=True)],
                    sound.alias("__pos"), F.col(array_col).alias("__data")))
    pieces = rows.select(*own, "__pos", "__data", F.explode(
        F.sequence(F.lit(0), F.expr(f"cast((size(__data) - 1) div {tile_cols} as int)"))).alias("__cb"))
    cut = pieces.select(*own, "__cb", F.expr(f"__pos div {tile_rows}").alias("__rb"), F.struct(
        F.col("__pos").alias("pos"),
        F.slice("__data", F.col("__cb") * tile_cols + 1, F.lit(tile_cols)).alias("piece")).alias("__part"))
    tiles = cut.groupBy(*own, "__rb", "__cb").agg(F.array_sort(F.collect_list("__part")).alias("__parts"))
    tiles = barrier(tiles, *own, "__rb", "__cb", __parts=_with_gaps(F.col("__parts"), F.col("__rb") * tile_rows))
    width = F.array_max(F.transform("__parts", lambda r: F.size(r.getField("piece"))))
    gaps = F.exists("__parts", lambda r: r.getField("gap") > 0)
    tiles = barrier(tiles, *own, "__rb", "__cb", "__parts", __width=width, __gaps=gaps)

    def entries(c: Column) -> Column:
        dense = F.transform("__parts", lambda r: F.get(r.getField("piece"), c))
        holes = F.flatten(F.transform("__parts", lambda r: F.concat(
            F.array_repeat(none, r.getField("gap")), F.array(F.get(r.getField("piece"), c)))))
        return F.when(F.col("__gaps"), holes).otherwise(dense)

    turned = F.transform(F.sequence(F.lit(0), F.col("__width") - 1), entries)
    return (tiles.select(*own, "__rb", "__cb", F.posexplode(turned).alias("__c", "__values"))
            .select(*[F.col(o).alias(s) for s, o in zip(series, own, strict=True)],
                    (F.col("__cb").cast("long") * tile_cols + F.col("__c")).alias("column"),
                    F.col("__rb").alias("block"), (F.col("__rb") * tile_rows).alias("start"),
                    F.col("__values").alias("values")))


def _with_gaps(parts: Column, start: Column) -> Column:
    """Ordered parts ``(pos, piece)`` of a tile -> ``(gap, piece)``: the missing positions before each."""
    def gap(r: Column, i: Column) -> Column:
        before = F.when(i == 0, start - 1).otherwise(F.get(parts, i - 1).getField("pos"))
        found = r.getField("pos") - before - 1
        return F.when(found >= 0, found).otherwise(F.raise_error(F.concat(
            F.lit("transpose met position "), r.getField("pos").cast("string"), F.lit(" twice"))))
    return F.transform(parts, lambda r, i: F.struct(gap(r, i).cast("int").alias("gap"), r.getField("piece").alias("piece")))


def transpose_fields(df: DataFrame, fields: Sequence[str], position_col: str, series_cols: str | Sequence[str] = (),
                     size: int = TILE_ROWS) -> DataFrame:
    """Instants x fields -> fields x instants, for any number of instants.

    Like ``reshape.transpose``, with blocks of ``size`` positions in place of a
    column per position: the series columns, ``field``, ``block``, ``start`` and
    ``values`` (double).  Null, missing and repeated positions as in
    :func:`transpose_matrix`.
    """
    series = _as_list(series_cols)
    own = [f"__t{i}" for i in range(len(series))]
    wide = df.select(*[F.col(s).alias(o) for s, o in zip(series, own, strict=True)], F.col(position_col).alias("__at"),
                     F.array(*[F.col(f).cast("double") for f in fields]).alias("__row"))
    turned = transpose_matrix(wide, "__at", "__row", own, size, max(1, len(fields)))
    names = F.array(*[F.lit(f) for f in fields])
    return turned.select(*[F.col(o).alias(s) for s, o in zip(series, own, strict=True)],
                         F.get(names, F.col("column").cast("int")).alias("field"), "block", "start", "values")
