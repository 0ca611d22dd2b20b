"""Operators 1, 8 and 10 against brute force, with the odd rows each docstring defines."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOC_SCHEMA, base_spans, documents, prose, statistics, vocabulary
from tidemark.llm import pii, quality, urls

ODD = [None, "", " \n\t ", "one", "a b c a b c", "x\nx\n\nx \n x", "#*$%&|<> é# 中|", "a\n" * 30, "w " * 4000,
       "a b c d a b c e a b", "\n".join(f"line {i % 3} ~" for i in range(20))]


def test_statistics(spark):
    rng = np.random.default_rng(1)
    vocab = vocabulary(rng, 12)
    texts = ODD + ["\n".join(prose(rng, vocab, int(rng.integers(0, 9))) for _ in range(12)) for _ in range(20)]
    docs = documents(spark, texts).withColumn("n_words", F.lit("clash"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in quality.with_counts(docs).collect()}
    assert got == {i: statistics(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("k, n", [(0, 10), (3, 50), (49, 50), (7, 2000)])
def test_binomial_bound_is_exact(k, n):
    alpha = 0.01
    p = quality.upper_bound(k, n, alpha)
    cdf = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert cdf == pytest.approx(alpha, rel=1e-6)
    assert quality.upper_bound(n, n, alpha) == quality.upper_bound(0, 0, alpha) == 1.0


def labelled(spark, n_good, n_bad, noisy=0):
    """Good documents, junk full of symbols, and ``noisy`` good documents that look like junk."""
    words = [f"w{i}" for i in range(300)]
    clean, junk = " ".join(words[:90]), " ".join(w + "%%%" for w in words[:90])
    texts = [clean] * (n_good - noisy) + [junk] * (noisy + n_bad)
    docs = documents(spark, texts)
    labels = [(i, int(i < n_good)) for i in range(n_good + n_bad)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int")


def verdicts(docs, labels, **kw):
    return {r["doc_id"]: r["kept"] for r in quality.quality(docs, labels, **kw).collect()}


def test_certified_cutoffs_reject_junk_and_keep_good(spark):
    docs, labels = labelled(spark, 2000, 200)
    kept = verdicts(docs, labels)
    assert all(kept[i] == (i < 2000) for i in kept)
    fitted = quality.fit(quality.with_counts(docs.select("doc_id", F.col("lang").alias("stratum"), "text")), labels)
    row = fitted.first()
    assert (row["n_good"], row["n_junk"]) == (2000, 200)
    assert row["symbols_per_word_bound"] <= 0.02 / len(quality.RULES)


def test_no_cutoff_without_proof(spark):
    few, marks = labelled(spark, 100, 100)
    assert all(verdicts(few, marks).values())  # too few good documents to bound the rate
    noisy, marks = labelled(spark, 2000, 200, noisy=200)
    assert all(verdicts(noisy, marks).values())  # one good document in ten would go


def test_quality_odd_rows(spark):
    docs, labels = labelled(spark, 1500, 50)
    more = spark.createDataFrame([(None, 1), (3, None), (5, 0), (5, 1), (10**9, 0)], "doc_id long, quality int")
    odd = documents(spark, [None, "", "two words", None], ids=[None, 7, 7, 99], lang=None)
    got = quality.quality(docs.unionByName(odd).withColumn("stratum", F.lit(1)), labels.unionByName(more)).collect()
    assert len(got) == 1554 and all(r["base_failed"] and not r["kept"] for r in got if r["stratum"] is None)
    assert sum(r["kept"] for r in got) == 1500
    kept = quality.keep_good(docs.unionByName(odd), labels)
    assert kept.columns == docs.columns and kept.count() == 1500
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert quality.quality(empty, labels).count() == 0
    assert quality.quality(docs, labels.limit(0)).where("kept").count() == 1550


def of_language(spark, lang, first, n_good, n_bad, noisy=0):
    docs, labels = labelled(spark, n_good, n_bad, noisy)
    return (docs.withColumns({"doc_id": F.col("doc_id") + first, "lang": F.lit(lang)}),
            labels.withColumn("doc_id", F.col("doc_id") + first))


def test_junk_falls_in_languages_with_few_labels(spark):
    parts = [of_language(spark, "en", 0, 1200, 60), of_language(spark, "fr", 10_000, 300, 20),
             of_language(spark, "es", 20_000, 40, 10), of_language(spark, "de", 30_000, 400, 30, noisy=80),
             of_language(spark, "pt", 40_000, 30, 10, noisy=5), of_language(spark, "it", 50_000, 20, 10)]
    docs, labels = parts[0]
    for i, (d, m) in enumerate(parts[1:]):
        docs, labels = docs.unionByName(d), labels.unionByName(m) if i < 4 else labels  # no labels for "it"
    kept = {(r["stratum"], r["good"]): r["kept"] for r in quality.quality(docs, labels).groupBy(
        "stratum", ((F.col("doc_id") % 10_000) < F.create_map(*[F.lit(x) for x in (
            "en", 1200, "fr", 300, "es", 40, "de", 320, "pt", 25, "it", 20)])[F.col("stratum")]).alias("good"))
        .agg(F.sum(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept["en", True] == 1200 and kept["en", False] == 0
    assert kept["fr", True] == 300 and kept["fr", False] == 0  # 300 good labels of its own suffice
    assert kept["de", False] == 110 and kept["pt", False] == 15  # their own good documents would go


def test_pool_serves_languages_without_proof_of_their_own(spark):
    parts = [of_language(spark, "en", 0, 1200, 60), of_language(spark, "es", 10_000, 40, 10),
             of_language(spark, "it", 20_000, 20, 10)]
    docs = parts[0][0].unionByName(parts[1][0]).unionByName(parts[2][0])
    labels = parts[0][1].unionByName(parts[1][1])  # none for "it"
    kept = verdicts(docs, labels)
    assert all(kept[i] == (i % 10_000 < {0: 1200, 1: 40, 2: 20}[i // 10_000]) for i in kept)
    counted = quality.with_counts(docs.select("doc_id", F.col("lang").alias("stratum"), "text"))
    rows = {r["stratum"]: r for r in quality.fit(counted, labels).collect()}
    assert {k: r["pooled"] for k, r in rows.items()} == {"en": False, "es": True, "it": True}


def test_a_bad_rule_does_not_block_a_good_one():
    # Half of all documents exceed the second rule's cutoffs, junk alone those of the first.
    bins = np.array([[0, 0, 0, 0], [0, 7, 0, 0], [10, 7, 0, 0], [10, 0, 0, 0], [0, 7, 1, 0]])
    steps = quality.tightening(bins, np.array([0, 0, 50, 50, 3]), np.array([500, 500, 40, 40, 20]))
    assert steps[0] == [1, 0, 0, 0] and steps[-1] in ([1, 0, 8, 0], [1, 1, 0, 0])


# --- url rules -------------------------------------------------------------

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "", "allow"), ("example.com", "/en/a/", "allow"), ("com", "/ü", "block"),
         (None, "/", "block"), ("org", None, "block"), ("dup.org", "/", "allow"), ("dup.org", "/", "block")]


def judge(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in sorted(r for r in RULES if None not in r)
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("per_sweep", [5000, 2])
def test_url_rules(spark, per_sweep):
    urls_ = [None, "", "no scheme", "http://", "http://COM", "http://com/", "https://a.example.com/en/x?y#z",
             "http://www.example.com/en/", "http://www.example.com/en/a/b", "http://www.example.com/en",
             "http://x.www.example.com/en/a/", "ftp://b.net/es/q", "http://net", "http://net?x/es/", "http://b.net#/es/",
             "http://notexample.com/en/", "http://example.com/ü/1", "http://dup.org/x", "http://a..com/", "x://y://z/en/",
             "http://example.com/EN/", "http://com./", "http://example.com/en/a/" + "p" * 9000, "http://u\ncom/en"]
    urls_ += [f"http://h{i}.example.com/en/{'a/' * (i % 3)}{i}" for i in range(40)]
    rows = [(i, u, "clash") for i, u in enumerate(urls_)] + [(None, "http://b.net/es/", "x"), (5, "http://com/", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = urls.match_rules(df, rules, per_sweep=per_sweep).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([tuple(r) for r in got], key=key) == sorted([(i, *judge(u)) for i, u, _ in rows], key=key)


def test_urls_without_rules_or_rows(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [tuple(r) for r in urls.match_rules(df, rules).collect()] == [(1, "a.com", "/", None, "allow")]
    assert urls.match_rules(df.limit(0), rules).count() == 0


# --- personal data ---------------------------------------------------------

SEEDS = ["a.b+c@x-y.example.com", "@no", "x@y", "u@v@w.org", "a@b.c.d.e", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1",
         "0001.2.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "41111111111111111111", "+1 (974) 555-3436",
         "+12", "+1234567", "+1 2 3 4 5 6 7 8 ", "é@x.y", "12345 6789", "1.2.3", "x+1-800-555-0100.", "a" * 3000 + "@b.c"]


def test_base_spans_match_the_patterns(spark):
    rng = np.random.default_rng(4)
    texts = [None, "", "plain words"] + SEEDS
    alphabet = list("0123456789.@+-() ab%é")
    texts += ["".join(rng.choice(alphabet, 60)) for _ in range(300)]
    texts += [" ".join(rng.choice(SEEDS, 6)) for _ in range(50)]
    docs = documents(spark, texts).withColumn("base", F.lit("clash"))
    got = {r["doc_id"]: r for r in pii.find_pii(docs).collect()}
    for i, t in enumerate(texts):
        spans = base_spans(t)
        assert [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in got[i]["base"]] == spans, t
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]


def luhn_valid(rng):
    digits = "4" + "".join(map(str, rng.integers(0, 10, 14)))
    return next(digits + str(c) for c in range(10) if pii.luhn(digits + str(c)))


def test_patterns_discover_unseen_identifiers(spark):
    rng = np.random.default_rng(6)
    texts = [f"please charge card number {luhn_valid(rng)} today" for _ in range(30)]
    texts += ["please charge card number 4929123412341234 today"]  # fails its check digit
    texts += ["the old ledger shows 4929123412341234 again", "lot 5555123412341239 shipped from the depot"]
    texts += [f"call our office at +1 415 555 {i:04d} now" for i in range(20)] + ["call our office at 415 555 0199 now"]
    got = {r["doc_id"]: r for r in pii.find_pii(documents(spark, texts)).collect()}
    found = lambda i: [texts[i][s["start"]:s["end"]] for s in got[i]["spans"]]
    assert found(30) == found(31) == ["4929123412341234"]
    assert found(32) == []
    assert found(53) == ["415 555 0199"]
    assert all(got[i]["spans"] == got[i]["base"] for i in range(30))


LONG = ["00442079460958", "0044 20 7946 0958", "001 415 555 0199", "415 555 0123"]


def test_phones_with_prefix_and_beginnings_of_longer_numbers(spark):
    texts = [f"call our office at +1 415 555 {i:04d} now" for i in range(80)]
    texts += [f"call our office at {x} now" for x in LONG]
    texts += ["call our office at +1 415 555 0177 20240501 now", "room 301 415 555 0123 again", "lot 00442079461111 of goods"]
    got = {r["doc_id"]: r for r in pii.find_pii(documents(spark, texts)).collect()}
    found = [[(pii.KINDS[s["kind"]], texts[i][s["start"]:s["end"]]) for s in got[i]["spans"]] for i in range(80, len(texts))]
    assert found[:4] == [[("phone", x)] for x in LONG]
    assert found[4] == [("phone", "+1 415 555 0177")]
    assert found[5:] == [[("phone", "415 555 0123")], []]


def test_candidates_under_every_kind():
    def offered(text):
        return {(k, text[s:e]) for k, s, e in pii.candidate_spans(text, *pii.base_spans(text))}

    assert {("card", "00442079460958"), ("phone", "00442079460958")} <= offered("at 00442079460958 now")
    assert {("phone", "+1 415 555 0199 20240501"), ("phone", "+1 415 555 0199")} <= offered("+1 415 555 0199 20240501")
    assert ("phone", "00 44 1234 567890123") in offered("at 00 44 1234 567890123 now")  # 00 and 15 digits
    assert ("phone", "1234567890123456") not in offered("at 1234567890123456 now")


def test_discovered_spans_lie_apart():
    span = lambda k, s, e, score, odd=False: {"kind": k, "start": s, "end": e, "score": score, "odd": odd}
    spans = [span(2, 0, 9, 0.8), span(3, 0, 9, 0.9), span(3, 9, 12, 0.8), span(3, 20, 40, 0.9, True), span(3, 20, 30, 0.9),
             span(3, 25, 40, 0.85), span(3, 30, 35, 0.8)]
    assert sorted((x["kind"], x["start"], x["end"]) for x in pii.apart(spans)) == [
        (3, 0, 9), (3, 9, 12), (3, 20, 30), (3, 30, 35)]


def test_discovery_follows_chains_of_any_length(spark):
    # Instances of a link stand once in the pattern of the link before, which trusts them, and often in their own.
    links, size = 9, 6
    rows = [("phone", f"{link}-{i}", link == 0, [f"p{p}"]) for link in range(links) for i in range(size)
            for p in [max(0, link - 1)] + [link] * 100]
    places = spark.createDataFrame(rows, "kind string, instance string, seed boolean, patterns array<string>")
    found = {r["instance"] for r in pii.discover(places).collect()}
    assert found == {f"{link}-{i}" for link in range(1, links) for i in range(size)}


def test_personal_data_odd_rows(spark):
    docs = documents(spark, ["mail a@b.org", "mail a@b.org", None, "1" * 100_000, "@" * 20_000], ids=[1, 1, None, 2, 3])
    got = pii.find_pii(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_email"]) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 0), (3, 0)]
    assert pii.find_pii(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
