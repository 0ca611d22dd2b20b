"""Personal data: fixed patterns, and bootstrapped contextual extraction of what they miss (operator 10).

Seeds are matches of the base patterns.  Around every seed, and around every
string that only looks like an identifier of one of the kinds (a card number
failing its check digit, a phone number without its plus, ...), the words
nearby form lexical patterns.  Spark scores the bipartite graph of patterns
and instances in rounds: a pattern is as good as the share of trusted
instances among all it meets, an instance as good as its best patterns;
instances above the threshold join the trusted ones.  Trusted instances that
are not seeds are the discoveries, and every occurrence of theirs is a span.

Texts are read once.  The graph holds only identifier-like strings and their
contexts, counted per (pattern, instance) before anything is joined, so a
pattern or an identifier in a third of all documents is one row per partner.
"""

from __future__ import annotations

import bisect
import itertools
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_text, plus_fields, small_or_plain, staged, steps, text_bytes

KINDS = ("email", "ip", "card", "phone")
#: A pattern needs this share of trusted instances and so many of them; an instance this score.
MIN_CONFIDENCE, MIN_SUPPORT, MIN_SCORE = 0.8, 5, 0.8

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_BARE_PHONE = re.compile(r"(?<![\w.+/-])\(?[0-9](?:[\x20().-]{0,2}+[0-9]){6,11}+(?![\w/]|[\x20.-]?[0-9])")
#: Up to 15 digits, or 00 and up to 15.
_LONG_PHONE = re.compile(r"(?<![\w.+/-])(?:\(?[0-9](?:[\x20().-]{0,2}+[0-9]){6,14}+|\(?00(?:[\x20().-]{0,2}+[0-9]){7,15}+)"
                         r"(?![\w/]|[\x20.-]?[0-9])")
_ADDRESS = re.compile(r"[^\s\"'<>(),;:@]{1,64}")
_WORD = re.compile(r"[^\W\d_]+|\d+")
_REACH = 64


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Spans of the base patterns, and matches that failed their check (numbers of a kind's form only)."""
    found, failed = [], []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            found.append(("email", start, domain.end()))
            end = domain.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", end)
    for m in _IP.finditer(text):
        good = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
        (found if good else failed).append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
        elif 13 <= len(digits) <= 19:
            failed.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
        else:
            failed.append(("phone", *m.span()))
    return found, failed


def phone_prefixes(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Beginnings of a phone match that hold 8 to 15 digits and end where a group of digits does."""
    out, n = [], 0
    for i in range(start, end - 1):
        if "0" <= text[i] <= "9":
            n += 1
            if n > 15:
                break
            if n >= 8 and not "0" <= text[i + 1] <= "9":
                out.append((start, i + 1))
    return out


def candidate_spans(text: str, found: list, failed: list) -> list[tuple[str, int, int]]:
    """Strings that look like a kind, apart from words on both sides, and overlap no base span.

    A string is offered under each kind whose form it has, and candidates may
    overlap: which of them is an identifier is for the patterns to tell.
    """
    more = list(failed)
    more += [("phone", *m.span()) for form in (_BARE_PHONE, _LONG_PHONE) for m in form.finditer(text)]
    more += [("phone", *p) for kind, s, e in failed if kind == "phone" for p in phone_prefixes(text, s, e)]
    at = text.find("@")
    while at >= 0:
        start = max((text.rfind(c, max(0, at - _REACH), at) for c in " \t\n\r\"'<>(),;:@"), default=-1) + 1
        m = _ADDRESS.match(text, at + 1)
        if m and 0 < at - start < _REACH:
            more.append(("email", start, m.end() - (text[m.end() - 1] == ".")))
        at = text.find("@", at + 1)
    taken: list[list[int]] = []  # where base spans lie: apart and rising
    for s, e in sorted((s, e) for _, s, e in found):
        if taken and s <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    begins = [s for s, _ in taken]
    out = []
    for kind, s, e in sorted(set(more), key=lambda x: x[1:]):
        if (s and (text[s - 1].isalnum())) or (e < len(text) and text[e].isalnum()):
            continue
        before = bisect_left(begins, e) - 1  # the last base span that begins before the candidate's end
        if before >= 0 and taken[before][1] > s:
            continue
        out.append((kind, s, e))
    return out


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a place: two words before it; one before and one after (with what joins them)."""
    left = text[max(0, start - _REACH) : start].lower()
    right = text[end : end + _REACH].lower()
    before = [m[0] for m in _WORD.finditer(left)][-2:]
    after = _WORD.search(right)
    joint = left[-1:].strip() or "_"
    out = []
    if len(before) == 2:
        out.append(f"L {before[0]} {before[1]} {joint}")
    if before and after:
        out.append(f"M {before[-1]} {joint} * {after[0]}")
    return out


def instance(kind: str, text: str) -> str:
    """How an identifier is compared: emails lower-cased, numbers by their digits (ip: with dots)."""
    return text.lower() if kind == "email" else text if kind == "ip" else _digits(text)


_FIELDS = (("n_email", "long"), ("n_ip", "long"), ("n_card", "long"), ("n_phone", "long"),
           ("base", "array<struct<kind:int,start:long,end:long>>"),
           ("places", "array<struct<kind:int,start:long,end:long,instance:string,seed:boolean,patterns:array<string>>>"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, base spans and identifier-like places of every row (no texts)."""
    rows = docs.select(F.col(id_col), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    schema = plus_fields(rows.drop("text"), *_FIELDS)
    telling = np.zeros(256, bool)
    telling[[*range(48, 58), 64]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            data, offsets = text_bytes(batch.column("text"))
            texts = batch.column("text")
            base, places = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
            for i in np.flatnonzero(per_text(telling[data], offsets)).tolist():
                text = texts[i].as_py()
                found, failed = base_spans(text)
                found.sort(key=lambda x: (KINDS.index(x[0]), x[1]))
                base[i] = [{"kind": KINDS.index(k), "start": s, "end": e} for k, s, e in found]
                places[i] = [{"kind": KINDS.index(k), "start": s, "end": e, "instance": instance(k, text[s:e]),
                              "seed": seed, "patterns": contexts(text, s, e)}
                             for seed, spans in ((True, found), (False, candidate_spans(text, found, failed)))
                             for k, s, e in spans]
            counts = [pa.array([sum(x["kind"] == k for x in b) for b in base], pa.int64()) for k in range(4)]
            span = [("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]
            place = [*span, ("instance", pa.string()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *counts, pa.array(base, pa.list_(pa.struct(span))),
                 pa.array(places, pa.list_(pa.struct(place)))], names=[id_col, "text_hash", *(n for n, _ in _FIELDS)])

    return rows.mapInArrow(run, schema)


def discover(places: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_support: int = MIN_SUPPORT,
             min_score: float = MIN_SCORE) -> DataFrame:
    """Trusted (kind, instance) pairs that are not seeds, with their score.

    ``places`` has kind, instance, seed and patterns, one row per occurrence.
    From round to round trusted instances and their scores only grow, so the
    rounds end by themselves: when no instance joins and the scores stand still.
    """
    edges = staged(places.select("kind", "instance", "seed", F.explode("patterns").alias("pattern"))
                   .groupBy("kind", "pattern", "instance")
                   .agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n")), "pii-edges")
    seeds = edges.where("seed").select("kind", "instance").distinct().withColumn("score", F.lit(1.0))
    open_edges = edges.join(seeds.select("kind", "instance"), ["kind", "instance"], "left_anti")
    trusted, known, sum_known = seeds, 0, 0.0
    for turn in itertools.count():
        scored = edges.join(trusted, ["kind", "instance"], "left").fillna(0.0, ["score"])
        patterns = (scored.groupBy("kind", "pattern")
                    .agg((F.sum(F.col("n") * F.col("score")) / (F.sum("n") + 1)).alias("confidence"),
                         F.sum((F.col("score") >= min_score).cast("int")).alias("support"))
                    .where((F.col("confidence") >= min_confidence) & (F.col("support") >= min_support)))
        found = staged(open_edges.join(patterns, ["kind", "pattern"]).groupBy("kind", "instance")
                       .agg(F.max("confidence").alias("score")).where(F.col("score") >= min_score),
                       f"pii-found-{turn}")
        n, total = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("score"), F.lit(0.0))).first()
        # Growing scores can still lift a pattern over its threshold.
        if n == known and total <= sum_known * (1 + 1e-9):
            return found
        known, sum_known, trusted = n, total, seeds.unionByName(found)


def apart(spans: list[dict]) -> list[dict]:
    """Spans that do not overlap: those not ``odd`` first, of them the best score, the longest, the first."""
    starts, ends, out = [], [], []
    for x in sorted(spans, key=lambda x: (x["odd"], -x["score"], x["start"] - x["end"], x["start"], x["kind"])):
        i = bisect.bisect_left(starts, x["end"])  # the first taken span at or after this one's end
        if i and ends[i - 1] > x["start"]:
            continue
        starts.insert(i, x["start"])
        ends.insert(i, x["end"])
        out.append({k: x[k] for k in ("kind", "start", "end")})
    return out


def best_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        more = pa.array([apart(x) for x in batch.column("_more").to_pylist()], kind)
        yield pa.RecordBatch.from_arrays([batch.column("_doc"), batch.column("_hash"), more], names=["_doc", "_hash", "_more"])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``id_col``, base counts (n_email, n_ip, n_card, n_phone), base and spans of every document row.

    ``base`` and ``spans`` are arrays of (kind number, start, end) in code
    points, ordered by kind and start; ``spans`` holds the base spans and the
    discovered ones, which overlap no base span nor each other.  Null texts have none.
    Repeated rows get the same spans each.  Other columns are not read.
    """
    scanned = staged(scan(docs, id_col, text_col), "pii-places")
    places = scanned.select(F.col(id_col).alias("_doc"), F.col("text_hash").alias("_hash"),
                            F.explode("places").alias("p")).select("_doc", "_hash", "p.*")
    found = discover(places, **kw)
    # A phone with a number of digits that no phone has yields to any other reading of its place.
    odd = (F.col("kind") == KINDS.index("phone")) & ~F.col("instance").rlike("^(00)?[0-9]{7,15}$")
    more = (places.where(~F.col("seed")).join(small_or_plain(found), ["kind", "instance"])
            .groupBy("_doc", "_hash").agg(F.collect_set(F.struct("kind", "start", "end", "score", odd.alias("odd"))).alias("_more")))
    more = more.mapInArrow(best_apart, plus_fields(more.drop("_more"), ("_more", "array<struct<kind:int,start:long,end:long>>")))
    joined = scanned.join(more, F.col(id_col).eqNullSafe(F.col("_doc")) & F.col("text_hash").eqNullSafe(F.col("_hash")),
                          "left")
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return joined.select(id_col, "n_email", "n_ip", "n_card", "n_phone", "base",
                         F.array_sort(F.concat("base", F.coalesce("_more", none))).alias("spans"))


def as_text(spans: F.Column) -> F.Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
