"""Near-duplicate classes against all pairs, by plain alignment."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from gamegrain.llm import near
from gamegrain.llm.components import components

SCHEMA = "doc_id long, text string, label string, key string, kept int"


def plain_similarity(a, b):
    """Longest common subsequence of occurrence-labelled shingles, over all of them."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    shared = row[-1]
    return shared / (len(a) + len(b) - shared)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]

    def edited(base, n):
        out = list(base)
        for _ in range(n):
            at = rng.randrange(len(out))
            out[at : at + rng.choice((0, 1))] = [rng.choice(words)]
        return out

    passage = rng.choices(words, k=25)
    texts = []
    for _ in range(3):  # groups whose copies are edited independently, and copies of copies
        base = rng.choices(words, k=rng.randint(60, 90))
        copies = [edited(base, rng.randint(0, 6)) for _ in range(14)]
        texts += [base, *copies, *[edited(c, 1) for c in copies[:4]]]
    texts += [rng.choices(words, k=30) + passage + rng.choices(words, k=30) for _ in range(25)]
    texts += [rng.choices(words, k=rng.randint(1, 80)) for _ in range(20)] + [["the"] * 60, ["the"] * 55, ["the"] * 40]
    rows = [(i, " ".join(t), "x", "y", 1) for i, t in enumerate(texts)]
    rows += [(500, None, None, None, None), (501, "", "", "", 0), (None, "  ", "", "", 0), (502, "A b  C d", "", "", 0), (503, "a B c D", "", "", 0)]
    return rows + rows[:2] + [(504, " ".join(rng.choices(words, k=20_000)), "", "", 0)]


def test_against_all_pairs(spark, rows):
    shingles = near.Shingles()
    grams = [shingles(r[1] or "").tolist() for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        a, b = grams[i], grams[j]
        if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(set(a) & set(b)) >= near.needed(len(a), len(b)):
            if plain_similarity(a, b) >= 0.8:
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r[0])
    out = near.near_classes(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    want = sorted((i, min((x for x in g if x is not None), default=None), len(g)) for g in groups.values() for i in g if i is not None)
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in out if r.doc_id is not None) == want
    assert len(out) == len(rows) and sum(r.kept for r in out) == len(groups)
    assert all(r.doc_id == r.class_id for r in out if r.kept)


def test_alignment_is_the_plain_one():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        a = rng.permutation(60)[:n].astype(np.uint64)
        b = a.copy()
        for _ in range(int(rng.integers(0, 4))):
            b[rng.integers(0, n)] = rng.integers(100, 1000)
        b = np.unique(np.roll(b, int(rng.integers(0, 3)) if rng.random() < 0.5 else 0)) if rng.random() < 0.1 else b
        if len(set(b.tolist())) < len(b):
            continue
        want = plain_similarity(a.tolist(), b.tolist())
        assert abs(near.similarity(a, b) - (want if want >= 0.8 - 1e-12 else 0)) < 1e-12


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (100, 102), (103, 100), (7, 7)]
    labels = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({labels[i] for i in range(41)}) == 1 and len({labels[i] for i in range(100, 104)}) == 1
    assert labels[0] != labels[100]


def test_empty(spark):
    assert near.near_classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_short_texts_meet():
    """Texts of 8 to 40 words and the same with a word more at an end, as unlike as near texts may be: all meet."""
    rng = random.Random(3)
    shingles, pairs = near.Shingles(), 0
    while pairs < 4_000:
        words = [f"w{rng.randrange(10**9)}" for _ in range(rng.choice((8, 9, 10, 12, 24, 28, 29, 30, 33, 36, 40)))]
        other = list(words)
        while True:
            longer = [*other, "more"] if rng.random() < 0.5 else ["more", *other]
            a, b = shingles(" ".join(words)), shingles(" ".join(longer))
            if near.similarity(a, b) == 0:
                break
            other = longer
        a, b = shingles(" ".join(words)), shingles(" ".join(other))
        if len(a) < len(b):
            assert set(near.sketch(a).tolist()) & set(near.sketch(b).tolist())
            pairs += 1
