"""Near-duplicate embeddings by cross-polytope hashing (operator 6).

Each table turns a unit vector by a pseudo-random rotation (three rounds of
random signs and a fast Hadamard transform) and hashes it to the signed axis it
lies nearest to; ``k`` such hashes make a bucket.  A vector also goes into the
buckets of its next nearest axes (multiprobe).  Equal vectors are one row with
a count.  In a bucket all pairs are verified by cosine in double precision; a
pair that meets in several buckets counts only in the first of them, which
both vectors' bucket lists tell.  Buckets of more than ``block`` vectors are
verified by pairs of blocks, so no task holds more than two blocks of a bucket,
and nothing is dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.llm.graph import components, local_roots

TABLES, PROBES, BLOCK = 10, 3, 1024
#: Vectors of one label that a bucket may hold on average; beyond, another hash joins the bucket key.
BUCKET_VECTORS = 512
CELL_ROWS = 20_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def bucket_codes(x: np.ndarray, tables: int, k: int, probes: int, seed: int = 0) -> np.ndarray:
    """For each row of ``x`` its ``tables * probes`` bucket codes (table in the top bits), nearest axes first."""
    n, dim = x.shape
    d = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, d))
    padded[:, :dim] = x
    codes = []
    for t in range(tables):
        ranked, code = np.zeros((n, 1)), np.zeros((n, 1), np.int64)
        for i in range(k):
            rng = np.random.default_rng([seed, t, i])
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], d))
            near = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :probes]
            value = np.take_along_axis(y, near, 1)
            axis = 2 * near + (value < 0)
            # All continuations of the probes so far; the best ``probes`` by summed projection stay.
            ranked = (ranked[:, :, None] + np.abs(value)[:, None, :]).reshape(n, -1)
            code = (code[:, :, None] * (2 * d) + axis[:, None, :]).reshape(n, -1)
            best = np.argsort(-ranked, axis=1, kind="stable")[:, :probes]
            ranked, code = np.take_along_axis(ranked, best, 1), np.take_along_axis(code, best, 1)
        codes.append(code + (np.int64(t) << 56))
    return np.concatenate(codes, 1)


def tables_for(k: int) -> int:
    """Tables that keep the recall above 0.9 at the threshold: a table with more hashes finds a pair less often."""
    return TABLES * 2 ** max(0, k - 3)


def links_between(a: np.ndarray, b: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with a dot product of at least ``threshold``: i < j within ``a``, or between ``a`` and ``b``."""
    if b is None:
        i, j = np.nonzero(a @ a.T >= threshold)
        return i[i < j], j[i < j]
    return np.nonzero(a @ b.T >= threshold)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.93, tables: int | None = None, probes: int = PROBES, k: int | None = None,
                    block: int = BLOCK, seed: int = 0) -> DataFrame:
    """``id_col``, n_links, component_id and kept of every row.

    Two rows link if their labels are equal and not null and their cosine is at
    least ``threshold``.  Vectors that are null, empty, zero, or hold null or
    non-finite components, and rows with a null id, link with nothing (their
    component is their own id).  Rows of one id are vectors of their own, each
    with the links of its own vector; vectors of different lengths are never compared.
    Other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite
              & F.exists("v", lambda c: c != 0))
    rows = staged(rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
                  .withColumn("class", F.when(F.col("usable"), F.struct(
                      F.xxhash64("label", "v").alias("h1"), F.xxhash64(F.lit(1), "label", "v").alias("h2")))),
                  "vector-rows")
    # Classes go by a number of their own (fixed once written): one id may name rows of several classes.
    classes = staged(rows.where("usable").groupBy("class").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
        .withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    if k is None:
        largest, longest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).agg(
            F.max("n"), F.max("d")).first()
        axes = 2 << max(1, ((longest or 2) - 1).bit_length())
        k = max(1, math.ceil(math.log(max(2, (largest or 1) * probes / BUCKET_VECTORS), axes)))
    tables = tables or tables_for(k)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.diff(batch.column("v").offsets.to_numpy())
            for d in np.unique(size).tolist():
                part = batch.take(pa.array(np.flatnonzero(size == d)))
                x = part.column("v").flatten().to_numpy().reshape(-1, d)
                x = x / np.abs(x).max(1, keepdims=True)
                x = x / np.sqrt((x * x).sum(1, keepdims=True))
                codes = bucket_codes(x, tables, k, probes, seed)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep"), part.column("n"), part.column("label"),
                     pa.array(np.full(len(x), d, np.int32)),
                     pa.array([r.tobytes() for r in x], pa.binary()), pa.array(codes.tolist(), pa.list_(pa.int64()))],
                    names=["rep", "n", "label", "dim", "x", "codes"])

    unit = staged(classes.select("rep", "n", "label", "v").mapInArrow(
        hashed, "rep long, n long, label string, dim int, x binary, codes array<long>"), "vector-codes")
    placed = unit.select("label", "dim", "rep", F.explode("codes").alias("code"))
    sizes = placed.groupBy("label", "dim", "code").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = sizes.select("label", "dim", "code", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    n_rows = placed.count()
    # A bucket of b blocks is verified as b * (b + 1) / 2 pairs (i <= j); a vector of block i is in those with i.
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda o: F.struct(F.least(o, F.col("mine")).alias("i"), F.greatest(o, F.col("mine")).alias("j")))
    spread = (placed.join(sizes, ["label", "dim", "code"]).withColumn("mine", mine)
              .select("label", "dim", "code", "rep", "mine", F.explode(pairs).alias("pair")))
    spread = spread.join(unit.select("rep", "n", "x", "codes"), "rep")
    cells = max(1, n_rows // CELL_ROWS)
    spread = spread.withColumn("cell", F.pmod(F.xxhash64("label", "dim", "code", "pair"), F.lit(cells)))

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, d, code, i, j), g in rows.groupby(["label", "dim", "code", "i", "j"], sort=False):
            x = np.frombuffer(b"".join(g["x"]), np.float64).reshape(-1, d)
            rep, n, block_of = g["rep"].to_numpy(), g["n"].to_numpy(), g["mine"].to_numpy()
            if i == j:
                a, b = links_between(x, None, threshold)
            else:
                left, right = np.flatnonzero(block_of == i), np.flatnonzero(block_of == j)
                a, b = links_between(x[left], x[right], threshold)
                a, b = left[a], right[b]
            if not len(a):
                continue
            codes = np.stack(g["codes"].to_numpy())
            links = np.zeros(len(rep), np.int64)
            for s in range(0, len(a), 4096):
                ai, bi = a[s : s + 4096], b[s : s + 4096]
                common = (codes[ai][:, :, None] == codes[bi][:, None, :]).any(2)
                first = np.where(common, codes[ai], np.iinfo(np.int64).max).min(1) == code
                np.add.at(links, ai[first], n[bi[first]])
                np.add.at(links, bi[first], n[ai[first]])
            order = np.argsort(rep, kind="stable")
            place = np.argsort(order, kind="stable")
            root = rep[order][local_roots(len(rep), place[a], place[b])][place]
            linked = np.unique(np.concatenate([a, b]))
            out.append(pd.DataFrame({"rep": rep[linked], "root": root[linked], "links": links[linked]}))
        return pd.concat(out) if out else pd.DataFrame({"rep": [], "root": [], "links": []}, dtype=np.int64)

    found = staged(spread.select("cell", "label", "dim", "code", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"),
                                 "mine", "rep", "n", "x", "codes")
                   .groupBy("cell").applyInPandas(verify, "rep long, root long, links long"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), "vector-components")
    placed = staged(classes.select("class", "rep", "least", "n").join(links, "rep", "left")
                    .join(groups, F.col("rep") == F.col("node"), "left")
                    .withColumn("group", F.coalesce("component", "rep")).drop("component", "node"), "vector-groups")
    named = placed.groupBy("group").agg(F.min("least").alias("component"))
    per_class = (placed.join(named, "group")
                 .select(F.col("class").alias("_class"), "component",
                         (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links")))
    component = F.coalesce("component", "id")
    return (rows.join(per_class, F.col("class") == F.col("_class"), "left")
            .select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")))
