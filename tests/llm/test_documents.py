"""Brute force against the document operators, over awkward rows and an empty table."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gamegrain.llm import bytebpe, exact, packing, sharding
from gamegrain.llm.perfect import PerfectHash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, digest string, shard string"
WORD = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def rows():
    texts = [None, "", " ", "Of The", "of the", "of the", "ÀB à", "àb à", "word, word. don't  run\n on ", "x" * 5000,
             "long text. " * 9000, "İ. 中文 #1", "a\x1cb"]
    rows = [(i, t, "en", "s", None, 1, "d", "x") for i, t in enumerate(texts)]
    return rows + rows[3:5] + [(None, "of the", None, None, None, None, None, None), (None, None) + (None,) * 6]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_perfect_hash():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**63, (3000, 2)).astype(np.uint64)
    table = PerfectHash.from_bytes(PerfectHash.build(keys[:, 0], keys[:, 1]).to_bytes())
    assert sorted(table.slots(keys[:, 0], keys[:, 1]).tolist()) == list(range(3000))
    assert PerfectHash.build(keys[:0, 0], keys[:0, 1]).slots(keys[:2, 0], keys[:2, 1]).tolist() == [-1, -1]


def test_exact(docs, rows, empty):
    groups = defaultdict(list)
    for r in rows:
        groups[low(r[1])].append(r[0])
    out = exact.exact_dedup(docs).collect()
    assert len(out) == len(rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = Counter()
    for r in out:
        ids = by_digest[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}
    assert exact.exact_dedup(empty).count() == 0


def test_exact_without_history(docs, rows, monkeypatch):
    """A first delivery: nothing is indexed, the digests are spread all the same, and the classes are what they are."""
    monkeypatch.setattr(exact, "KEYS_PER_SHARD", 3)
    found = []
    for history in (F.lit(False), F.lit(True), F.col("doc_id") % 3 == 0):
        found.append(sorted(map(tuple, exact.exact_classes(docs, history).drop("kept").collect()), key=repr))
    assert found[0] == found[1] == found[2]
    few = docs.select(F.col("doc_id").alias("digest"))
    assert exact.shards_for(few.limit(0), few.limit(10)) == exact.shards_for(few.limit(10), few.limit(0)) == 4


def test_sharding(docs, rows, empty):
    out = sharding.shard_documents(docs).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
    together = defaultdict(set)
    slots = defaultdict(list)
    for r in out:
        together[r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in together.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(empty).count() == 0


def plain_lpt(loads, shards):
    total = [0] * shards
    for load in sorted(loads, reverse=True):
        total[total.index(min(total))] += load
    return total


def test_schedule_takes_the_least_loaded_shard():
    rng = random.Random(6)
    for shards in (1, 2, 5, 24):
        for _ in range(40):
            loads = [rng.choice((0, 1, 3, 7, rng.randrange(1, 60), rng.randrange(1, 4000))) for _ in range(rng.randrange(1, 900))]
            total, places = [0] * shards, Counter()
            for load, first, last, shard in sharding.schedule(list(Counter(loads).items()), shards):
                total[shard] += load * (last - first)
                places.update((load, i) for i in range(first, last))
            assert total == plain_lpt(loads, shards)
            assert places == Counter((x, i) for x, n in Counter(loads).items() for i in range(n))


def test_shards_are_those_of_the_plain_schedule(spark):
    rng = random.Random(7)
    rows = [(i, f"g{rng.randrange(150)}", rng.randrange(0, 40)) for i in range(800)] + [(900 + i, "hot", 30) for i in range(60)]
    rows += [(2000 + i, f"one{i}", 5) for i in range(300)] + [(5000, None, 3)]
    out = sharding.lpt_shards(spark.createDataFrame(rows, "id int, g string, size int"), F.col("g"), F.col("size"), 7, "g").collect()
    groups, total, homes = Counter(), Counter(), defaultdict(set)
    for r in out:
        groups[r.g] += r.size
        total[r.shard] += r.size
        homes[r.g].add(r.shard)
    assert len(out) == len(rows) and all(len(h) == 1 for h in homes.values())
    assert sorted(total[s] for s in range(7)) == sorted(plain_lpt(groups.values(), 7))


def test_bpe(docs, rows, empty):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in rows:
        ids, raw = coder.encode_ordinary(r[1] or ""), (r[1] or "").encode()
        want[(r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(raw).hexdigest())] += 1
    out = bytebpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    assert Counter(tuple(r) for r in out.collect()) == want
    assert bytebpe.encode_documents(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_packing(docs, rows, empty):
    coder = Tokenizer.from_file(WORD)
    want = Counter()
    for r in rows:
        ids = [*coder.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[(r[0], piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    out = packing.pack_documents(docs, WORD).collect()
    assert Counter(tuple(r)[:5] for r in out) == want
    places = defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    for place in places.values():
        end = 0
        for offset, length in sorted(place):
            assert offset == end
            end += length
        assert end <= 4096
    assert packing.pack_documents(empty, WORD).count() == 0


def test_plan_holds_every_piece_and_is_tight():
    rng = np.random.default_rng(2)
    counts = Counter(np.minimum(100, rng.zipf(1.3, 5000)).tolist())
    steps = packing.plan(counts, 100)
    for length, n in counts.items():
        assert sum(s[2] * s[3] for s in steps if s[0] == length) == n
    assert (steps[:, 3] + steps[:, 4]).max() <= -(-sum(k * v for k, v in counts.items()) // 100) + 2
    # 60 + 30 leaves 10; 40 is the two-fit's better use of the same gap.
    assert sorted(packing.plan({60: 1, 30: 1, 20: 2}, 100)[:, 0].tolist()) == [20, 30, 60]


def test_signs_behind_a_word_are_remembered_apart():
    """Of words that differ only in the signs behind them one is encoded; ids are those of the tokenizer."""
    coder = packing.Coder(public_tokenizers.path("word_bpe_49k.json"))
    asked, encode = [], coder._encode
    coder._encode = lambda words: asked.extend(words) or encode(words)
    text = "straße### straße!! straße%%% straße., straße's straße' 7## _- don't!? é́## Straße_ #"
    assert coder.encode([text]) == [coder.whole(text)]
    assert asked.count("straße") == 1 and not {"straße###", "straße!!", "straße%%%", "straße.,"} & set(asked)


def test_words_are_remembered_in_lower_case():
    """Of words that differ only in case one is encoded; ids are those of the tokenizer."""
    coder = packing.Coder(WORD)
    asked, encode = [], coder._encode
    coder._encode = lambda words: asked.extend(words) or encode(words)
    text = "straße Straße STRAßE Straße! élan Élan ÉLAN, the The THE"
    assert coder.encode([text]) == [coder.whole(text)]
    assert sorted(asked) == ["!", ",", "straße", "the", "élan"]


def test_ids_of_odd_signs_and_special_tokens_are_those_of_the_tokenizer(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 3)
    coder = packing.Coder(WORD)
    signs = [chr(at) for at in [*range(1, 0x250), 0x301, 0x30C, 0x3A3, 0x3C2, 0x1E9E, 0x2126, 0x212A, 0x212B, 0x4E2D]]
    texts = [f"A{sign} {sign}B x{sign}y {sign * 2}'S. É{sign}É {sign}" for sign in signs]
    texts += ["J\u030c Ǆa ΑΣ ΣΑ. İSTANBUL", "word<|endoftext|> a", "<|ENDOFTEXT|> Word", "Don'T X'Ll 12³½ ñandú.", "the of " * 9]
    for text in texts:
        assert coder.encode([text]) == [coder.whole(text)], text
    assert len(coder.memory) <= 3 and len(coder.memory.old) <= 3
