"""Counts, base scores and model scores by brute force; each context sums to one."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gamegrain.llm import katz

SCHEMA = "doc_id long, text string, lang string, score string, batch int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["The", "of", "and"] * 30 + [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60))), "en", "x", 1) for i in range(300)]
    rows += [(301, None, None, None, None), (None, "the\tof\x1cÀ　b", None, None, None), (302, "of the " * 30_000, "", "", 2)]
    return rows + rows[:3]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0D]+", text) + [None]


def sizes_of(counts):
    return np.bincount(np.minimum(list(counts.values()), katz.TRUSTED + 2), minlength=katz.TRUSTED + 3).astype(float)


def brute_force(rows):
    """Counts of the training words, and the lower order, what is left for unseen words, and each context's table."""
    words, pairs = Counter(), Counter()
    for r in rows:
        if not held(r[0]):
            ts = tokens(r[1])
            words.update(ts)
            pairs.update(zip(["<start>", *ts], ts))
    n, d = sum(words.values()), katz.good_turing(sizes_of(words))
    kept = {w: c * (d[c] if c <= katz.TRUSTED else 1) / n for w, c in words.items()}
    unseen = max(1 - math.fsum(kept.values()), 0.5 / (n + 1))
    single = {w: p * (1 - unseen) / math.fsum(kept.values()) for w, p in kept.items()}
    d = katz.good_turing(sizes_of(pairs))
    after, contexts = {}, Counter()
    for (a, b), c in pairs.items():
        after.setdefault(a, {})[b] = c
        contexts[a] += c

    def table(a):
        """Probabilities of the words seen after ``a``, and the weight of all others."""
        seen, total = after.get(a, {}), contexts[a]
        if not seen:
            return {}, 1.0
        p = {b: c * (d[c] if c <= katz.TRUSTED else 1) / total for b, c in seen.items()}
        if all(c > katz.TRUSTED for c in seen.values()):
            p = {b: v * total / (total + 1) for b, v in p.items()}
        return p, (1 - math.fsum(p.values())) / (1 - math.fsum(single[b] for b in seen))

    return words, single, unseen, table


@pytest.mark.parametrize("share", [1.0, 1 / 100])
def test_against_brute_force(spark, rows, monkeypatch, share):
    monkeypatch.setattr(katz, "BATCH_CHARS", 3000)
    monkeypatch.setattr(katz, "WORDS_PER_SHARD", 100)
    monkeypatch.setattr(katz, "TOKENS_PER_SHARD", 20_000)
    monkeypatch.setattr(katz, "SHARE", share)
    out = katz.score_documents(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    counts, single, unseen, table = brute_force(rows)
    tables = {a: table(a) for a in [*counts, "<start>", "never"]}
    n, v = sum(counts.values()), len(counts)
    for p, weight in tables.values():
        rest = unseen + math.fsum(q for w, q in single.items() if w not in p)
        assert abs(math.fsum(p.values()) + weight * rest - 1) < 1e-9
    want, scores = Counter(), {}
    for r in rows:
        ts = tokens(r[1])
        base = math.fsum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        want[r[0], held(r[0]), len(ts), sum(counts[t] > 0 for t in ts), n, round(base, 4)] += 1
        steps = [(*tables.get(a, ({}, 1.0)), t) for a, t in zip(["<start>", *ts], ts)]
        scores[r[0]] = math.fsum(math.log10(p.get(t, w * single.get(t, unseen))) for p, w, t in steps)
    assert Counter((*tuple(r)[:5], round(r.base_score, 4)) for r in out) == want
    assert all(r.score == pytest.approx(scores[r.doc_id], rel=1e-9) for r in out)
    assert sum(r.score for r in out if r.held_out) > sum(r.base_score for r in out if r.held_out)


def test_discounts():
    for sizes in (np.zeros(8), np.array([0, 5, 0, 0, 0, 0, 0, 1.0]), np.array([0, 900, 300, 150, 90, 60, 40, 80.0])):
        assert ((katz.good_turing(sizes)[1:] > 0) & (katz.good_turing(sizes)[1:] < 1)).all()


def test_pack():
    arrays = np.arange(5, dtype=np.uint64), np.zeros(0, np.int64), np.array([True, False])
    back = katz.unpack(katz.pack(*arrays), np.uint64, np.int64, bool)
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, back, strict=True))


def test_edges(spark):
    assert katz.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    only_held = [i for i in range(50) if held(i)]
    docs = spark.createDataFrame([(i, "a b", "", "", 0) for i in only_held], SCHEMA)
    out = katz.score_documents(docs).collect()
    assert len(out) == len(only_held) and all(r.n_known == 0 and r.train_tokens == 0 and r.score == r.base_score for r in out)
