"""Brute-force versions that the operators are held against."""

import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None, source="s", lang="en"):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, lang, source, None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def vocabulary(rng, n=400):
    letters = np.array(list("abcdefghijklmnoprstuvwz"))
    return ["".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(n)]


def prose(rng, words, n):
    return " ".join(rng.choice(words, n))


def roots(n, links):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingles(text, n=5):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def jaccard(texts, percent=75):
    """(set size, smallest linked index) of each text."""
    sets = [shingles(t) for t in texts]
    held, links = defaultdict(list), []
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in held[x])
        links += [(j, i) for j, k in common.items() if 100 * k >= percent * (len(s) + len(sets[j]) - k)]
        for x in s:
            held[x].append(i)
    return list(zip([len(s) for s in sets], roots(len(texts), links), strict=True))


def strip_repeats(texts, length=200):
    """(bytes, removed, spans, kept) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, int)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        begins = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(d), int(gone.sum()), begins, np.frombuffer(d, np.uint8)[~gone].tobytes()))
    return out


def base_spans(text):
    """Base spans by the literal patterns, kind by kind."""
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                          ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 16 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0,
                    "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered))
