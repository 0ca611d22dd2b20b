"""Operators 12 and 13 against the tokenizers' own libraries and a literal alignment."""

import hashlib
import json
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SF_CHECK
from tests.llm.helpers import DOC_SCHEMA, documents, prose, vocabulary
from tidemark.llm import alignment, counts
from tidemark.llm.byte_level import ByteLevelFile, byte_characters
from tidemark.llm.common import read_table
from tidemark.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def odd_texts(seed=0, n=150):
    rng = np.random.default_rng(seed)
    texts = [None, "", " ", "  a  b\n\n\tc ", "x<|endoftext|>y <|endoftext|>", "<|endoftext|><|endoftext", "don't we'll 12 3",
             "\x85 \x1c\x1f a\x00", "﻿　z", "é" * 50, "z" * 30_000, " " * 30_000, "中文 テスト ñandú ³½٣", "▁under ▁▁",
             "aaaa" * 9, "😀👍🏽 flags 🇩🇪", "<s> </s> <unk> <0x41>", "ß".join("abc"), "͸ฺᪿ x", "a" * 9000 + " b"]
    texts += ["".join(map(chr, rng.integers(1, 0x3000, 60))) for _ in range(n)]
    texts += ["".join(map(chr, rng.integers(32, 0x250, 80))) for _ in range(n)]
    vocab = vocabulary(rng)
    return texts + [prose(rng, vocab, int(rng.integers(1, 200))) for _ in range(n)]


# --- counts ----------------------------------------------------------------

def test_counts_are_the_librarys(spark):
    texts = odd_texts()
    docs = documents(spark, texts).withColumn("n_tokens", F.lit("clash")).withColumn("id", F.lit(None).cast("int"))
    got = {r["doc_id"]: r for r in counts.count_tokens(docs.repartition(5), A, limit=40).collect()}
    library = Tokenizer.from_file(A)
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((t or "").encode()), n > 40), repr(t)


def test_counts_odd_rows(spark):
    repeated = documents(spark, ["a b", "a b", None], ids=[5, 5, None])
    rows = sorted(map(tuple, counts.count_tokens(repeated, A).collect()), key=str)
    assert rows == [(5, 3, 2, False), (5, 3, 2, False), (None, 0, 0, False)]
    empty = counts.count_tokens(spark.createDataFrame([], DOC_SCHEMA), A)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_merges_follow_rank_then_position():
    counter = counts.MergeCounter(A)
    library = Tokenizer.from_file(A)
    rng = np.random.default_rng(4)
    for size in (1, 2, 3, 17, 400):
        for _ in range(60):
            word = "".join(rng.choice(list("aabbeinstrh"), size))
            assert counter.merge(word.encode()) == len(library.encode(word, add_special_tokens=False).ids)


def test_a_long_pre_token_is_merged_in_bounded_time():
    counter = counts.MergeCounter(A)
    assert counter.merge(b"ab" * 150_000) > 0


def test_other_files_are_refused(tmp_path):
    said = json.load(open(A, encoding="utf-8"))
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}},
                   {"model": said["model"] | {"ignore_merges": True}},
                   {"model": said["model"] | {"vocab": {k: v for k, v in said["model"]["vocab"].items() if k != "a"}}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(said | change))
        with pytest.raises(ValueError):
            ByteLevelFile(str(path))


def test_counts_query(spark):
    docs = read_table(spark, SF_CHECK, "documents").select("doc_id", "text").collect()
    library = Tokenizer.from_file(A)
    got = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op13_token_counts"](spark, SF_CHECK).collect()}
    assert got == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in docs}


# --- alignment -------------------------------------------------------------

def literal_alignment(texts):
    """(n_a, n_b, groups text, links) of each text, by walking both token lists."""
    a_lib = Tokenizer.from_file(A)
    a_lib.encode_special_tokens = True
    of = byte_characters()
    a_text = {i: t for t, i in a_lib.get_vocab().items()}
    b_lib = sentencepiece.SentencePieceProcessor(model_file=B)
    out = []
    for text in texts:
        want = f" {text}".encode() if text else b""
        a = a_lib.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        a_bytes = [bytes(of[c] for c in a_text[i]) for i in a]
        b_bytes = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i)
                   else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            a, b, a_bytes, b_bytes = [], [], [], []
        spans = []
        for tokens in (a_bytes, b_bytes):
            ends = np.cumsum([len(x) for x in tokens]).tolist()
            spans.append(list(zip([0, *ends][:-1], ends, strict=True)))
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, start = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, sp, strict=True) if start <= s and e <= end)
                                   for ids, sp in zip((a, b), spans, strict=True)))
            start = end
        links = [(i, j) for i, (s, e) in zip(a, spans[0], strict=True)
                 for j, (u, v) in zip(b, spans[1], strict=True) if s < v and u < e]
        out.append((len(a), len(b), groups, links))
    return out


def expected(texts):
    rows = literal_alignment(texts)
    held = Counter(p for *_, links in rows for p in set(links))
    best = {}
    for (i, _), n in held.items():
        best[i] = max(best.get(i, 0), n)
    return [(n_a, n_b, len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "") for n_a, n_b, groups, links in rows]


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("window_bytes", [500, 1_000_000])
def test_alignment_is_the_literal_one(spark, window_bytes):
    texts = [t if t is None or len(t) < 2000 else t[:300] for t in odd_texts(1, 60)]
    texts += [texts[-1]] * 40 + ["the same hot words"] * 200
    docs = documents(spark, texts).withColumn("n_a", F.lit("clash")).withColumn("window", F.lit(1))
    got = alignment.align(docs.repartition(4), A, B, window_bytes=window_bytes).collect()
    got = {r["doc_id"]: tuple(r[c] for c in FIELDS) for r in got}
    assert got == dict(enumerate(expected(texts)))


def test_alignment_odd_rows(spark):
    texts = ["a b", "a b", None, "z" * 25_000]
    docs = documents(spark, texts, ids=[5, 5, None, None])
    got = sorted(tuple(r[c] for c in FIELDS) for r in alignment.align(docs, A, B).collect())
    rows = expected(["a b", "a b", None])
    assert got[0] == rows[2] and got[1:3] == rows[:2] and got[3][3] > 0
    empty = alignment.align(spark.createDataFrame([], DOC_SCHEMA), A, B)
    assert empty.count() == 0 and empty.columns == ["doc_id", *FIELDS]


def test_identity_map_and_packing():
    pair = alignment.TokenPair(A, B)
    for i in (0, 10, 262, 1000, 40_000):
        j = pair.identity[i]
        assert j < 0 or pair.a_bytes[i] == pair.b_bytes[j]
    doc = np.array([0, 0, 2, 2, 2, 5])
    values = np.array([3, 9, 1, 4, 100, 7])
    size, starts = alignment._runs(doc, 7)
    assert alignment._back(alignment._steps_up(values, starts), size).tolist() == values.tolist()


def test_alignment_query(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r[c] for c in FIELDS)
           for r in QUERIES["op12_align_tokens"](spark, "/root/testdata/sf0.001").collect()}
    assert got == dict(zip([i for i, _ in docs], expected([t for _, t in docs]), strict=True))
