"""Operators 4, 5, 6 and 9 against brute force, with the odd rows each docstring defines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOC_SCHEMA, documents, jaccard, prose, roots, strip_repeats, vocabulary
from tidemark.llm import embeddings, jaccard as join, lines, substrings
from tidemark.llm.common import lower_ascii, text_bytes, words_of
from tidemark.llm.graph import components

ODD = [None, "", " \n\t ", "one", "One", "a b c d", "A B C D", "a b c d e", "ÄÖ é x y z 中文 q"]


def near_copies(rng, n_groups=6, size=6, words=120):
    vocab = vocabulary(rng)
    out = []
    for _ in range(n_groups):
        text = prose(rng, vocab, words).split()
        for _ in range(size):
            copy = list(text)
            for at in rng.integers(0, words, rng.integers(0, 12)):
                copy[at] = str(rng.choice(vocab))
            out.append(" ".join(copy))
    return out


def test_words_keep_to_their_texts():
    import pyarrow as pa
    data, offsets = text_bytes(pa.array(["ab c", None, "", "d\x0be ", "É"]))
    first, end, text = words_of(data, offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(first, end, strict=True)] == ["ab", "c", "d", "e", "É"]
    assert text.tolist() == [0, 0, 3, 3, 4]
    assert bytes(lower_ascii(data)).decode() == "ab cd\x0be É"


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, x) for x in range(101, 130)] + [(7, 7), (200, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(21)} | {i: 100 for i in range(100, 130)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("part_sets", [2048, 2])
def test_jaccard_components(spark, part_sets):
    rng = np.random.default_rng(3)
    texts = ODD + near_copies(rng) + ["x " * 3000]
    texts += texts[9:14]
    docs = documents(spark, texts).withColumn("n_shingles", F.lit("clash")).withColumn("d1", F.lit(0))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in join.jaccard_components(docs, part_sets=part_sets).collect()}
    assert got == dict(enumerate(jaccard(texts)))


def test_tokens_are_dealt_in_levels(spark, monkeypatch):
    rng = np.random.default_rng(12)
    texts = ODD + near_copies(rng, 8, 5, 300) + [prose(rng, vocabulary(rng, 3000), 200) for _ in range(40)]
    texts += texts[9:20]
    total = sum(len((t or "").encode()) for t in texts)
    monkeypatch.setattr(join, "RANGE_BYTES", total // 200)
    monkeypatch.setattr(join, "WINDOW_TOKENS", 500)
    monkeypatch.setattr(join, "DEAL_BYTES", total // 20)
    rows = documents(spark, texts).select(F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("hash"), "text").repartition(5)
    alive = []
    for fanout, levels in ((10**6, 1), (16, 2), (4, 4)):
        monkeypatch.setattr(join, "FANOUT", fanout)
        assert len(join._levels(-(-total // (total // 200)))) == levels
        found = sorted(r["d1"] for r in join.with_shared_tokens(rows, 75, 5, total).collect())
        assert len(found) == len(set(found))
        alive.append(found)
    assert alive[0] == alive[1] == alive[2]
    component = [c for _, c in jaccard(texts)]
    linked = {i for i, c in enumerate(component) if component.count(c) > 1 and texts[i]}
    sets = {r["id"]: r["d1"] for r in join.set_digests(rows).collect()}
    different = {i for i in linked if len({sets[k] for k in linked if component[k] == component[i]}) > 1}
    assert len(different) > 5 and {sets[i] for i in different} <= set(alive[0])
    assert len(alive[0]) < len(set(sets.values())) - 40  # sets of unique tokens drop out


def test_a_window_sends_at_most_one_row_per_slot():
    rng = np.random.default_rng(2)
    ranges, t = 5000, rng.integers(0, 2**64, 40_000, np.uint64)
    d, common = rng.integers(0, 50, len(t)).astype(np.uint64), rng.integers(0, 2**64, 3000, np.uint64)
    own = (np.arange(50, dtype=np.uint64) + np.uint64(7), np.ones(50, np.int64), np.zeros(50, np.int64))
    first = join.deal_tokens(t, d, common, own, ranges, 64, (0, ranges))
    assert first.num_rows <= -(-ranges // 64)
    sent, shared, owned = [], [], 0
    for slot, columns in join._by_slot(iter([first.slice(0, 30), first.slice(30)]), 2000):
        sets, sizes, tokens, more, ids = (x.view(k) for x, k in zip(
            columns[:5], (np.uint64, np.uint32, np.uint64, np.uint64, np.uint64), strict=True))
        assert set(join._range_of(tokens, ranges) // 64) | set(join._range_of(more, ranges) // 64) <= {slot}
        sent += zip(tokens.tolist(), np.repeat(sets, sizes).tolist(), strict=True)
        shared += more.tolist()
        owned += len(ids)
        again = join.deal_tokens(tokens, np.repeat(sets, sizes), more, (ids, ids, ids), ranges, 1, (slot * 64, min(ranges, slot * 64 + 64)))
        assert all(r // 64 == slot for r in again.column("slot").to_pylist()) and again.num_rows <= 64
    assert sorted(sent) == sorted(zip(t.tolist(), d.tolist(), strict=True)) and sorted(shared) == sorted(common.tolist())
    assert owned == 50


def test_jaccard_nulls_repeats_and_empty(spark):
    words = "the quick brown fox jumps over the lazy dog again"
    docs = documents(spark, [words, words, words, None, words.upper()], ids=[7, 7, None, 3, 9])
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["component_id"])
                 for r in join.jaccard_components(docs).collect())
    assert got == [(-1, 7), (3, 3), (7, 7), (7, 7), (9, 7)]
    assert sorted(r["doc_id"] or -1 for r in join.keep_one(docs).collect()) == [-1, 3, 7]
    assert join.jaccard_components(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


def test_a_prefix_alone_is_no_link(spark):
    vocab = [f"w{i}" for i in range(400)]
    shared = " ".join(vocab[:60])
    docs = documents(spark, [f"{shared} {' '.join(vocab[60 + 60 * i:120 + 60 * i])}" for i in range(5)])
    assert all(r["doc_id"] == r["component_id"] for r in join.jaccard_components(docs).collect())


@pytest.mark.parametrize("split_cells, shard_bytes", [(4096, 2_000_000), (2, 4000)])
def test_substrings(spark, split_cells, shard_bytes):
    rng = np.random.default_rng(5)
    vocab = vocabulary(rng)
    passages = [prose(rng, vocab, 60) for _ in range(3)]
    texts = [None, "", "short", "a" * 199, "a" * 200, "b" * 500, "ab" * 300, "é" * 260]
    for i in range(24):
        texts.append(prose(rng, vocab, int(rng.integers(5, 80))) + passages[i % 3] + prose(rng, vocab, 30))
    texts += [texts[10], texts[11] + "x", "y" + texts[11], passages[0] + passages[0]]
    docs = documents(spark, texts).withColumn("hash", F.lit(1)).withColumn("spans", F.lit("clash"))
    got = substrings.remove_repeats(docs, split_cells=split_cells, shard_bytes=shard_bytes).collect()
    rows = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got}
    assert len(got) == len(texts)
    assert rows == dict(enumerate(strip_repeats(texts)))


def test_cells_of_long_texts_are_those_of_short_ones(monkeypatch):
    data, offsets = np.random.default_rng(3).integers(0, 256, 2_000_000, dtype=np.uint8), np.array([0, 2_000_000])
    whole = substrings.cells_of(data, offsets, 200, 64)
    monkeypatch.setattr(substrings, "PLACE_BITS", 16)  # slices of 65,536 bytes
    assert all(np.array_equal(x, y) for x, y in zip(whole, substrings.cells_of(data, offsets, 200, 64), strict=True))


def test_substrings_of_many_equal_rows_collect_each_span_once(spark, monkeypatch):
    rng = np.random.default_rng(11)
    a, b = (bytes(rng.integers(97, 123, 900, dtype=np.uint8)).decode() for _ in range(2))
    rows = [(None, a)] * 300 + [(1, b), (2, a[:500] + b[300:]), (3, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    tables, write = {}, substrings.common.staged
    monkeypatch.setattr(substrings.common, "staged", lambda df, name: tables.setdefault(name, write(df, name)))
    before = spark.conf.get(substrings.SHUFFLE_CLEANUP)
    got = substrings.remove_repeats(docs).collect()
    assert {(r["doc_id"], r["n_removed"]) for r in got} == {(None, 900), (1, 600), (2, 1100), (3, 0)} and len(got) == 303
    spans = tables["substring-spans"].select("spans").collect()
    assert all(len({tuple(x) for x in r["spans"]}) == len(r["spans"]) for r in spans)
    assert max(len(r["spans"]) for r in spans) < 40
    assert spark.conf.get(substrings.SHUFFLE_CLEANUP) == before


def test_substrings_of_repeated_and_null_ids(spark):
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(400))
    docs = documents(spark, [text, text, "other", None], ids=[1, 1, None, None])
    got = sorted((r["doc_id"] or 0, r["n_removed"], bytes(r["kept"])) for r in substrings.remove_repeats(docs).collect())
    assert got == [(0, 0, b""), (0, 0, b"other"), (1, 400, b""), (1, 400, b"")]
    assert substrings.remove_repeats(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(1)
    data = np.concatenate([rng.integers(97, 100, 700), np.tile(rng.integers(97, 123, 90), 5)]).astype(np.uint8)
    order, keys = substrings.suffix_array(data, 64)
    raw = data.tobytes()
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    lcp = substrings.common_prefixes(order, keys, 64, lane=50)
    for k in range(1, len(raw)):
        a, b = raw[order[k - 1] :], raw[order[k] :]
        n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert lcp[k] >= min(n, 64) and (lcp[k] == min(n, 64) or n == min(len(a), len(b)))


def test_lines(spark):
    common = "This line is common and has more than forty characters in it"
    texts = [f"{common}\nown {i}\n  {common.upper()}\t" for i in range(6)] + [None, "", "\n\n", common + "x"]
    docs = documents(spark, texts).withColumn("keep", F.lit("clash"))
    got = {r["doc_id"]: r for r in lines.dedup_lines(docs).collect()}
    assert [got[i]["n_dropped"] for i in range(10)] == [2] * 5 + [0] * 5
    assert [got[i]["kept_text"] for i in range(10)] == [f"own {i}" for i in range(5)] + [texts[5], "", "", "\n\n", texts[9]]
    assert [(r["start"], r["length"]) for r in got[0]["keep"]] == [(1, 1)]
    assert [got[i]["n_lines"] for i in (0, 6, 7, 8)] == [3, 1, 1, 3]


def test_lines_with_null_and_repeated_ids(spark):
    common = "a line of some forty characters, more or less: yes"
    docs = documents(spark, [common] * 8, ids=[1, 2, 3, 4, 4, 4, None, None])
    got = sorted((r["doc_id"] or 0, r["n_dropped"]) for r in lines.dedup_lines(docs).collect())
    assert got == [(0, 1), (0, 1), (1, 1), (2, 1), (3, 1), (4, 0), (4, 0), (4, 0)]
    assert all(r["n_dropped"] == 0 for r in lines.dedup_lines(docs.where("doc_id is not null")).collect())
    assert lines.dedup_lines(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


def embed(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


@pytest.mark.parametrize("k, block", [(None, 1024), (2, 16)])
def test_embeddings(spark, k, block):
    rng = np.random.default_rng(8)
    rows, n = [], 0
    for label in (0, 1):
        for _ in range(40):
            center = rng.normal(size=64)
            for _ in range(int(rng.integers(1, 9))):
                v = center + rng.normal(size=64) * rng.choice([0.0, 0.15, 0.27])
                rows.append((n, [float(np.float32(x)) for x in v], label))
                n += 1
    df = embed(spark, rows).withColumn("links", F.lit(1)).withColumn("rep", F.lit("clash"))
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(df, k=k, block=block).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    found = np.array([got[i]["n_links"] for i in range(n)])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.95 * near.sum()
    if found.sum() == near.sum():
        assert [got[i]["component_id"] for i in range(n)] == roots(n, zip(*np.nonzero(near), strict=True))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_embeddings_that_link_with_nothing(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(0, v, 1), (1, [2.0, 4.0, 6.0], 1), (2, v, None), (3, v, 2), (4, None, 1), (5, [0.0] * 3, 1),
            (6, [1.0, None, 3.0], 1), (7, [1.0, float("nan"), 3.0], 1), (8, [float("inf"), 2.0, 3.0], 1), (9, [], 1),
            (10, [1.0, 2.0], 1), (11, v, 1), (None, v, 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in embeddings.near_duplicates(embed(spark, rows)).collect()}
    linked = {0: (2, 0, True), 1: (2, 0, False), 11: (2, 0, False), None: (0, None, True)}
    assert got == {i: (0, i, True) for i in range(2, 11)} | linked
    assert embeddings.near_duplicates(embed(spark, [])).count() == 0


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = rng.uniform(0.931, 0.96)
        rows += [(2 * i, a.tolist(), 0), (2 * i + 1, (c * a + np.sqrt(1 - c * c) * b).tolist(), 0)]
    for k in (1, 2):
        links = embeddings.near_duplicates(embed(spark, rows), k=k).agg(F.sum("n_links")).first()[0]
        assert links >= 0.9 * 600, (k, links)
