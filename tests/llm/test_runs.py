"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from gamegrain.llm import queries, runs

SCHEMA = "doc_id long, text string, n_runs string, start int"


def plain_runs(words, exponent=3, length=24):
    """Every maximal stretch of every period; of the periods of one stretch the smallest."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(length, exponent * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = [w for w in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


def sequence(rng):
    """Words with repeats inside repeats, and repeats that are broken now and then."""
    out = []
    for _ in range(rng.randrange(1, 7)):
        unit = [rng.randrange(rng.choice((2, 3, 50))) for _ in range(rng.randrange(1, 30))]
        if rng.random() < 0.3:
            unit = unit[:3] * rng.randrange(1, 12) + unit
        out += (unit * 12)[: rng.randrange(1, 9 * len(unit))]
        if rng.random() < 0.4:
            out[rng.randrange(len(out))] = 99
    return out


@pytest.mark.parametrize("appended", [1, 7, 64, 1 << 16])
def test_every_run_is_caught(appended):
    rng = random.Random(appended)
    for _ in range(25 if appended < 64 else 250):
        words = sequence(rng)
        assert runs.find_runs(np.array(words, np.int64), appended) == plain_runs(words), words


@pytest.mark.parametrize("exponent, length", [(2, 1), (2, 10), (3, 1), (3, 24), (4, 5), (5, 100)])
def test_other_least_runs(exponent, length):
    rng = random.Random(exponent * length)
    for _ in range(60):
        words = sequence(rng)
        catcher = runs.SquareCatcher(exponent, length)
        for at in range(0, len(words), 50):
            catcher.append(np.array(words[at : at + 50], np.int64))
            assert catcher.runs() == plain_runs(words[: at + 50], exponent, length)


def test_one_word_many_times():
    """A run of period 1 agrees at every shift; it is found once, in time that follows its length."""
    words = np.zeros(400_000, np.int64)
    assert runs.find_runs(words) == [(0, 400_000, 1)]
    words[200_000] = 1
    assert runs.find_runs(words) == [(0, 200_000, 1), (200_001, 199_999, 1)]
    assert runs.find_runs(np.arange(300_000) % 50_000) == [(0, 300_000, 50_000)]


def test_rows(spark):
    rng = random.Random(3)
    texts = [" ".join(f"w{x}" for x in sequence(rng)) for _ in range(120)]
    texts += [None, "", " \t\n", "a", "a " * 23, "a " * 24, "A a " * 30, "x y " * 30, "a\x0bb\x0cc " * 30, "é ü " * 40, "q\x1cq " * 50]
    rows = [(i, t, "own", 5) for i, t in enumerate(texts)] + [(None, "a b " * 20, "own", 5), (7, texts[7], "own", 5), (7, texts[8], None, 5)]
    out = runs.periodic_runs(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted((plain_row(r[0], r[1]) for r in rows), key=repr)
    assert runs.periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark, sf_dir):
    """The whole table; plain search on the documents of up to 2,000 words, all others by their collapsed text."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = queries.op12_square_runs(spark, sf_dir).collect()
    assert len(out) == len(docs) and sum(r.n_runs for r in out) > 0
    for row in out:
        if len((docs[row.doc_id] or "").split()) <= 2_000:
            assert tuple(row) == plain_row(row.doc_id, docs[row.doc_id])
