"""SimHash components against all pairs of plain fingerprints."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gamegrain.llm import queries, simhash
from gamegrain.llm.components import components

SCHEMA = "doc_id long, text string, fingerprint string, own boolean, cell int"


def plain_print(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def plain_components(prints):
    """Position of the first print that is reachable, for each of them."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return [root(i) for i in range(len(prints))]


def expected(rows):
    prints = sorted({plain_print(r[1]) for r in rows})
    root = dict(zip(prints, plain_components(prints), strict=True))
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            label = root[plain_print(text)]
            first[label] = min(doc_id, first.get(label, doc_id))
    return sorted(((r[0], f"{plain_print(r[1]):016x}", first.get(root[plain_print(r[1])])) for r in rows), key=repr)


def scattered(rng, n):
    """Prints in clouds: chains of small steps, and others that are just too far away."""
    out = set()
    while len(out) < n:
        at = rng.getrandbits(64)
        for _ in range(rng.choice((1, 2, 30))):
            out.add(at)
            for bit in rng.sample(range(64), rng.randrange(1, 7)):
                at ^= 1 << bit
    return sorted(out)


@pytest.mark.parametrize("block", [1_000, 3])
def test_no_link_is_lost(spark, block):
    prints = scattered(random.Random(block), 900)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    links = simhash.grid_links(spark.createDataFrame([(p,) for p in signed], "print long").repartition(4), block=block)
    assert all((a ^ b).bit_count() <= 3 for a, b in ((r.a & 2**64 - 1, r.b & 2**64 - 1) for r in links.collect()))
    label = {r.node: r.label for r in components(links).collect()}
    groups = {}
    for p, root in zip(signed, plain_components(prints), strict=True):
        groups.setdefault(root, set()).add(label.get(p, p))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_a_crowded_cell_gives_few_links(spark):
    """All prints within one bit of each other's neighbours: 2,017 prints have 60,000 links and more."""
    prints = [0] + [1 << i for i in range(63)] + [1 << i | 1 << j for i in range(63) for j in range(i)]
    links = simhash.grid_links(spark.createDataFrame([(p,) for p in prints], "print long"))
    assert links.count() < 40 * len(prints)
    assert {r.label for r in components(links).collect()} == {0}


def test_counts_bound_the_distance():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 500).astype(np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    counts = lambda x: np.unpackbits(x.view(np.uint8)).reshape(len(x), 32, 2).sum(axis=2)
    manhattan = np.abs(counts(a).astype(int) - counts(b)).sum(axis=1)
    assert (manhattan == np.bitwise_count(simhash.thermometer(a) ^ simhash.thermometer(b))).all()
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


def test_rows(spark):
    rng = random.Random(8)
    words = [f"W{i}" for i in range(200)]
    rows = []
    for _ in range(60):
        text = rng.choices(words, k=rng.choice((1, 2, 3, 40, 400)))
        for _ in range(rng.randrange(1, 6)):
            rows.append((len(rows), " ".join(text), "own", True, 1))
            text[rng.randrange(len(text))] = rng.choice(words)
    rows += [(500, None, None, None, None), (501, "", None, None, None), (502, " \n\t", None, None, None), (None, "", None, None, None)]
    rows += [(None, "only this text has no id", None, None, None), rows[3], rows[3], (503, "É ß a\x0bb\x1cc D", None, None, None)]
    out = simhash.simhash_components(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(map(tuple, out.collect()), key=repr) == expected(rows)
    assert simhash.simhash_components(spark.createDataFrame([], SCHEMA)).collect() == []


def test_digest_is_the_engines(spark):
    found = spark.createDataFrame([("ein kleines wort",), ("é x y",)], "text string").select("text", F.xxhash64("text").alias("h"))
    for row in found.collect():
        assert row.h & 2**64 - 1 == simhash._digest(row.text.encode())


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = queries.op11_segment_popcounts(spark, sf_dir)
    assert sorted(map(tuple, out.collect()), key=repr) == expected(docs)
