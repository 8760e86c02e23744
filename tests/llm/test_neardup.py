import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tillmart.llm import neardup


def brute(rows):
    """doc_id -> (set size, component), straight from the definition."""
    sets = {}
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        sets[i] = grams or ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = defaultdict(list)
    for i in sets:
        shared = defaultdict(int)
        for g in sets[i]:
            for j in seen[g]:
                shared[j] += 1
            seen[g].append(i)
        for j, k in shared.items():
            if 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def result(df):
    return {
        r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
        for r in neardup.near_duplicates(df).collect()
    }


def check(documents, rows):
    want = brute(rows)
    got = result(documents(rows))
    assert {i: v[:2] for i, v in got.items()} == want
    assert all(kept == (i == c) for i, (_, c, kept) in got.items())


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_chains_groups_and_shared_passages(documents):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for _ in range(40):  # groups of near copies, some of copies of copies
        words = rng.choices(vocabulary, k=rng.randint(30, 300))
        for _ in range(rng.randint(1, 12)):
            text = edited(rng, words, rng.randint(0, max(1, len(words) // 25)))
            rows.append((len(rows), text))
            if rng.random() < 0.3:
                words = text.split()
    for _ in range(150):  # a passage that makes up a good part of short texts
        rows.append((len(rows), " ".join(rng.choices(vocabulary, k=rng.randint(5, 60)) + passage)))
    rng.shuffle(rows)
    check(documents, rows)


def test_short_texts(documents):
    texts = ["a b c d", "A  b\tc d", "a b c", "a b c d e", "a b c d e f", "a b c d e f g", "a b c d e f g h i",
             "a b c d e f g h j", "", " ", "\x1ca b c d", "É b c d", "é b c d"]
    check(documents, list(enumerate(texts)))


def test_large_group_of_near_copies(documents):
    rng = random.Random(9)
    words = [f"v{i}" for i in range(120)]
    rows = [(i, edited(rng, words, 2)) for i in range(400)]
    check(documents, rows)


def test_odd_rows(documents, odd_rows):
    got = [tuple(r) for r in neardup.near_duplicates(documents(odd_rows)).collect()]
    assert len(got) == len(odd_rows)
    assert (None, 1, None, True) in got
    assert (1, 0, 1, True) in got and (2, 0, 2, True) in got and (3, 0, 3, True) in got
    assert got.count((4, 2, 4, True)) == 2 and (5, 2, 4, False) in got
    kept = neardup.keep_one(documents(odd_rows))
    assert kept.columns == documents([]).columns
    assert kept.count() == len(odd_rows) - 1


def test_ids_that_repeat_with_other_texts(documents):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(12)) for x in "abcd")
    rows = [(3, a), (5, a), (5, b), (7, c), (8, d), (8, d), (8, b + " more"), (9, c), (2, "")]
    rows += [(2, d + " end"), (None, a), (11, None), (11, b), (6, "x y"), (6, "y x")]
    got = sorted(map(str, neardup.near_duplicates(documents(rows)).collect()))
    kept = [(r.doc_id, r.text) for r in neardup.only(neardup.keep_one(documents(rows)), "doc_id", "text").collect()]
    assert len(got) == len(rows)
    # A row goes only where a kept row of another id stands for its very text.
    texts = {t: brute([(i, t) for i, t in enumerate({t for _, t in rows})]) for t in [a]}[a]
    alike = {t: texts[i][1] for i, t in enumerate({t for _, t in rows})}
    for i, t in rows:
        assert any(alike[t] == alike[u] for _, u in kept), (i, t)
    assert (5, a) not in kept and (5, b) in kept and (3, a) in kept and (11, b) not in kept
    assert kept.count((8, d)) == 0 and (2, d + " end") in kept and (8, b + " more") not in kept
    assert {(6, "x y"), (6, "y x"), (None, a), (11, None), (2, "")} <= set(kept)


def test_empty(documents):
    assert neardup.near_duplicates(documents([])).collect() == []


@pytest.mark.parametrize("size", [30, 200, 3000])
def test_estimate_is_close(size):
    rng = np.random.default_rng(size)
    for share in (0.3, 0.75, 0.95):
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        b = a.copy()
        b[: int(size * (1 - share) / (1 + share))] += np.uint64(1)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        ra, rb = neardup.sketch(np.unique(a)), neardup.sketch(np.unique(b))
        same, used = ((ra == rb) & (ra != 0)).sum(), ((ra != 0) | (rb != 0)).sum()
        assert abs(same / used - true) < 0.25


def test_expected_collisions_match_unrelated_sets():
    rng = np.random.default_rng(2)
    found = 0
    for _ in range(300):
        a, b = (neardup.sketch(np.unique(rng.integers(0, 2**63, 1000, dtype=np.uint64))) for _ in "ab")
        found += int(((a == b) & (a != 0)).sum())
    expected = 300 * float(neardup.expected_collisions(1000, 1000))
    assert abs(found - expected) < 5 * max(1.0, expected) ** 0.5


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r["id"]: r["component"] for r in neardup.components(edges, "test").collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}
    empty = spark.createDataFrame([], "a long, b long")
    assert neardup.components(empty, "test").collect() == []
