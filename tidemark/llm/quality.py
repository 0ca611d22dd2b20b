"""Quality rules with risk-controlled cutoffs (operator 1).

Text statistics become signals (symbols per word, share of capitals, ...).  A
document fails a rule when a signal exceeds the rule's cutoff, and falls if any
rule fails.  Cutoffs are chosen per stratum from labelled documents: all rules
are tightened along one fixed sequence, cutoff by cutoff.  A step is certified
while the exact (Clopper-Pearson) upper bound of the rate at which good
documents fall stays within ``max_false_rejection``.  Testing stops at the first
step that is not, so a sequence needs no correction of its own; over all
sequences the error probability ``delta`` is divided by their number
(Bonferroni).  Strata with too few good labels for any proof are not tested and
not counted.  The order of the steps comes from junk labels and unlabelled
documents only, so it is fixed as far as the good labels are concerned.  Among
certified steps the one with the largest surplus of rejected junk over rejected
good documents is used, the last of equals (each step catches labelled junk of
some stratum).

One more sequence is tested on all labels together, the pool.  Strata that
certify nothing of their own, also those without labels, use the pool's cutoffs,
unless more than ``max_false_rejection`` of their own good labels would fall.
With probability 1 - delta no stratum with cutoffs of its own loses more than
``max_false_rejection`` of its good documents to the rules, nor does the pool as
a whole; for a single stratum that uses the pool's cutoffs nothing is proven.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    Rolling, fresh_prefix, per_text, plus_fields, shingles, small_or_plain, staged, steps, text_bytes, words_of)

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Signals as (numerator, denominator) and their cutoffs, safest first.
RULES = {
    "symbols_per_word": (("n_symbols", "n_words"), [2.0, 1.0, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12, 0.08, 0.05]),
    "upper_share": (("n_upper", "word_chars"), [0.9, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12]),
    "repeat_share": (("n_repeat_words", "n_words"), [0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05]),
    "dup_line_share": (("n_dup_lines", "n_lines"), [0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1]),
}


def _flags(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


def count_text(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All of COUNTS for each text of a byte array."""
    n = len(offsets) - 1
    first, end, text = words_of(data, offsets)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, first, 1)
    np.subtract.at(inside, end, 1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool) if len(data) else np.zeros(0, bool)
    lead = (data & 0xC0) != 0x80
    out = {
        "n_words": np.bincount(text, minlength=n),
        "word_chars": per_text(inside & lead, offsets),
        "n_symbols": per_text(_flags(SYMBOLS)[data], offsets),
        "n_upper": per_text((data >= 65) & (data <= 90), offsets),
    }
    rolling = Rolling(data)
    words = rolling.spans(first, end)
    # Words within 3-word windows that occur twice or more in their text.
    window, of = shingles(words, text, 3)
    at = np.flatnonzero(text[: max(0, len(words) - 2)] == text[2:]) if len(words) > 2 else np.zeros(0, np.int64)
    again = _repeated(of, window)
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[at[again] + i] = True
    out["n_repeat_words"] = np.bincount(text[covered], minlength=n)
    # Lines with a word; all but the first of equal ones count.
    breaks = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_text = np.searchsorted(offsets, line_start, "right") - 1
    own = np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, "right") - 1])
    start = np.concatenate([offsets[:-1], breaks + 1])
    order = np.lexsort((start, own))
    line_text, start = own[order], start[order]
    stop = np.concatenate([start[1:], [0]]) - 1
    last = np.concatenate([line_text[1:] != line_text[:-1], [True]]) if n else np.zeros(0, bool)
    stop[last] = offsets[line_text[last] + 1]
    out["n_lines"] = np.bincount(line_text, minlength=n)
    has_word = np.searchsorted(first, stop) > np.searchsorted(first, start)
    line, of = rolling.spans(start[has_word], stop[has_word]), line_text[has_word]
    order = np.lexsort((line, of))
    line, of = line[order], of[order]
    equal = (line[1:] == line[:-1]) & (of[1:] == of[:-1])
    out["n_dup_lines"] = np.bincount(of[1:][equal], minlength=n)
    return out


def _repeated(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which (group, value) pairs occur more than once."""
    order = np.lexsort((value, group))
    g, v = group[order], value[order]
    equal = (g[1:] == g[:-1]) & (v[1:] == v[:-1])
    twice = np.zeros(len(g), bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    out = np.zeros(len(g), bool)
    out[order] = twice
    return out


def with_counts(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` and a long column ``prefix + name`` for each of COUNTS.  Null text: empty.

    Columns of ``df`` that have such a name are replaced.
    """
    names = [prefix + c for c in COUNTS]
    df = df.drop(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            counts = count_text(*text_bytes(batch.column(text)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(counts[c].astype(np.int64)) for c in COUNTS)],
                names=[*batch.schema.names, *names])

    return df.mapInArrow(run, plus_fields(df, *[(name, "long") for name in names]))


def base_failed(prefix: str = "") -> F.Column:
    """Fewer than 50 words, or over half of the words in repeated 3-word windows."""
    words, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)


def signal(rule: str, prefix: str = "") -> F.Column:
    above, below = RULES[rule][0]
    return F.coalesce(F.try_divide(F.col(prefix + above).cast("double"), F.col(prefix + below)), F.lit(0.0))


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exactly."""
    if k >= n or p <= 0:
        return 1.0
    i = np.arange(k + 1)
    log_choose = np.concatenate([[0.0], np.cumsum(np.log((n - i[:-1]) / (i[:-1] + 1.0)))])
    terms = log_choose + i * math.log(p) + (n - i) * math.log1p(-p)
    top = terms.max()
    return float(min(1.0, math.exp(top) * np.exp(terms - top).sum()))


def upper_bound(k: int, n: int, alpha: float) -> float:
    """Clopper-Pearson upper bound: the largest rate at which k or fewer of n has probability alpha."""
    if n == 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if binomial_cdf(k, n, mid) > alpha else (low, mid)
    return high


def tightening(bins: np.ndarray, junk: np.ndarray, other: np.ndarray) -> list[list[int]]:
    """Sequence of cutoffs, as the number taken of each rule's, from the safest on; each catches more junk.

    ``bins`` holds a row per cell with the number of cutoffs exceeded of each
    rule, ``junk`` and ``other`` the cell's labelled junk and unlabelled
    documents.  The next rule is the one that catches the most new junk per
    unlabelled document that newly falls (and ten, so that one junk document
    alone does not make a rule the best).
    """
    sizes = np.array([len(cuts) for _, cuts in RULES.values()])
    need = sizes - bins + 1  # cutoffs to take of a rule until it catches the cell
    taken, free, out = np.zeros(len(sizes), np.int64), np.ones(len(bins), bool), []
    while True:
        best = None
        for r in range(len(sizes)):
            left = free & (junk > 0) & (bins[:, r] > 0)
            if not left.any():
                continue
            upto = need[left, r].min()
            falls = free & (need[:, r] <= upto)
            worth = junk[falls].sum() / (other[falls].sum() + 10)
            if best is None or worth > best[0]:
                best = (worth, r, upto, falls)
        if best is None:
            return out
        taken[best[1]] = best[2]
        free &= ~best[3]
        out.append(taken.tolist())


def choose_cutoffs(signals: DataFrame, labels: DataFrame, id_col: str = "doc_id", stratum: str = "stratum",
                   label: str = "quality", max_false_rejection: float = 0.02, delta: float = 0.05) -> DataFrame:
    """One row per stratum: its label counts, a cutoff per rule (null: not used) and the bound of all together.

    ``pooled`` marks cutoffs taken from the pool of all strata.  ``signals``
    holds id, stratum and a double column per rule; ``labels`` id and 1 (good)
    or 0 (junk).  Null ids or labels are left out; an id labelled both ways counts
    as good.  Only counts per (stratum, bins of all rules) leave the
    aggregation; they follow the strata, not the documents.
    """
    names, sizes = list(RULES), np.array([len(cuts) for _, cuts in RULES.values()])
    marks = (labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
             .groupBy(id_col).agg((F.max(label) == 1).alias("good")))
    bins = [sum((F.col(rule) > F.lit(c)).cast("int") for c in cuts).alias(rule)  # cutoffs exceeded
            for rule, (_, cuts) in RULES.items()]
    good, one = F.col("good").cast("long"), F.lit(1).cast("long")
    cells = (signals.select(stratum, *bins, F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("junk"),
                            one.alias("other"))
             .unionByName(signals.join(marks, id_col).select(
                 stratum, *bins, good.alias("good"), (one - good).alias("junk"), F.lit(-1).cast("long").alias("other")))
             .groupBy(stratum, *names).agg(*[F.sum(c).alias(c) for c in ("good", "junk", "other")]))
    cells = staged(cells, "quality-bins")
    # So many good labels prove the bound if none falls and two sequences share delta: the least of all.
    least = math.log(delta / 2) / math.log1p(-max_false_rejection)
    tested = cells.groupBy(stratum).agg(F.sum("good").alias("n")).where(F.col("n") >= least).count()
    alpha = delta / (tested + 1)
    # At most one row for each combination of bins.
    pool = cells.groupBy(*names).agg(*[F.sum(c).alias(c) for c in ("good", "junk", "other")]).toPandas()

    def falling(rows: pd.DataFrame, step: list[int]) -> np.ndarray:
        return (rows[names].to_numpy() > sizes - np.array(step)).any(axis=1)

    def certify(rows: pd.DataFrame) -> tuple[int, list[int] | None, float | None]:
        """Certified steps, and the cutoffs and bound of the best (none: nothing gained)."""
        both = rows.merge(pool[[*names, "junk"]], on=names, how="outer", suffixes=("", "_any")).fillna(0)
        n, best, steps_ = int(rows["good"].sum()), (0, None, None), 0
        for step in tightening(both[names].to_numpy(np.int64), both["junk_any"].to_numpy(), both["other"].to_numpy()):
            falls = falling(rows, step)
            lost, caught = int(rows["good"][falls].sum()), int(rows["junk"][falls].sum())
            bound = upper_bound(lost, n, alpha)
            if bound > max_false_rejection:
                break
            steps_ += 1
            if caught - lost >= best[0]:
                best = (caught - lost, step, bound)
        return steps_, best[1], best[2]

    _, pool_step, pool_bound = certify(pool)

    def one_stratum(rows: pd.DataFrame) -> pd.DataFrame:
        n, pooled = int(rows["good"].sum()), False
        steps_, step, bound = certify(rows) if n >= least else (0, None, None)
        if not steps_ and pool_step is not None:
            pooled = bool(rows["good"][falling(rows, pool_step)].sum() <= max_false_rejection * n)
            step, bound = (pool_step, pool_bound) if pooled else (None, None)
        out = {stratum: rows[stratum].iloc[0], "pooled": pooled, "n_good": n, "n_junk": int(rows["junk"].sum())}
        for r, (rule, (_, cuts)) in enumerate(RULES.items()):
            used = step is not None and step[r] > 0
            out |= {rule: cuts[step[r] - 1] if used else None, f"{rule}_bound": bound if used else None}
        return pd.DataFrame([out])

    fields = ", ".join(f"`{r}` double, `{r}_bound` double" for r in RULES)
    return staged(cells.groupBy(stratum).applyInPandas(
        one_stratum, f"`{stratum}` string, pooled boolean, n_good long, n_junk long, {fields}"), "quality-cutoffs")


def judge(df: DataFrame, cutoffs: DataFrame, stratum: F.Column, prefix: str = "") -> DataFrame:
    """``df`` (with counts) plus ``prefix`` base_failed, kept, and failed_rules (names, null: none)."""
    own = fresh_prefix(df, "_cut_")
    cut = small_or_plain(cutoffs.select(F.col("stratum").alias(f"{own}stratum"),
                                        *[F.col(r).alias(f"{own}{r}") for r in RULES]))
    joined = df.join(cut, stratum.eqNullSafe(F.col(f"{own}stratum")), "left")
    failed = F.concat_ws(",", *[F.when(signal(r, prefix) > F.col(f"{own}{r}"), F.lit(r)) for r in RULES])
    return (joined.withColumn(prefix + "base_failed", base_failed(prefix))
            .withColumn(prefix + "failed_rules", F.when(failed != "", failed))
            .withColumn(prefix + "kept", ~F.col(prefix + "base_failed") & F.col(prefix + "failed_rules").isNull())
            .drop(f"{own}stratum", *[f"{own}{r}" for r in RULES]))


def fit(counted: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """Cutoffs from a narrow table of doc_id, stratum and COUNTS.

    Documents that the base rules fail are judged without cutoffs, so they are
    left out of the labelled holdout.
    """
    held = counted.where(~base_failed()).select("doc_id", "stratum", *[signal(r).alias(r) for r in RULES])
    return choose_cutoffs(held, labels.select("doc_id", "quality"), **kw)


def quality(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """doc_id, stratum, COUNTS, base_failed, failed_rules and kept of every document.

    The stratum is the language (null: one of its own).  Null or empty texts
    have no words and fail the base rules; repeated rows are judged alike.
    Other columns of ``docs`` are not read.
    """
    counted = staged(with_counts(docs.select("doc_id", F.col("lang").cast("string").alias("stratum"), "text"))
                     .drop("text"), "quality-counts")
    return judge(counted, fit(counted, labels, **kw), F.col("stratum"))


def keep_good(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that :func:`quality` keeps, unchanged."""
    counted = staged(with_counts(docs.select("doc_id", F.col("lang").cast("string").alias("stratum"), "text"))
                     .drop("text"), "quality-counts")
    cutoffs = fit(counted, labels, **kw)
    prefix = fresh_prefix(docs, "_quality_")
    judged = judge(with_counts(docs, prefix=prefix), cutoffs, F.col("lang").cast("string"), prefix)
    return judged.where(F.col(prefix + "kept")).select(*docs.columns)
