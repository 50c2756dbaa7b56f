"""Alignment of two tokenizers against a plain one over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import public_tokenizers
import pytest

from gamegrain.llm import alignment, queries

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
SCHEMA = "doc_id long, text string, range long, valid string"


@pytest.fixture(scope="module")
def known():
    return alignment.vocabularies(*PATHS)


def plain_byte(sign):
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return ord(sign) if ord(sign) in own else [b for b in range(256) if b not in own][ord(sign) - 256]


def plain_groups(known, text):
    """Lists of ids of both, group by group; nothing if a tokenizer changes the text."""
    if not text:
        return []
    encoded = known.a.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(map(plain_byte, token))) for i, token in zip(encoded.ids, encoded.tokens, strict=True)]
    b = []
    for i in known.b.encode(text):
        piece = known.b.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if known.b.is_byte(i) else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
        return []
    groups, at_a, at_b, mine, other = [], 0, 0, [], []
    a, b = a[::-1], b[::-1]
    while a or b:
        if at_a <= at_b and a:
            i, x = a.pop()
            mine.append(i)
            at_a += len(x)
        else:
            i, x = b.pop()
            other.append(i)
            at_b += len(x)
        if at_a == at_b:
            groups.append((mine, other))
            mine, other = [], []
    return groups


def expected(known, rows):
    found = [(r[0], plain_groups(known, r[1])) for r in rows]
    links = Counter((a[-1], b[-1]) for _, groups in found for a, b in groups)
    best = defaultdict(int)
    for (_, b), n in links.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, groups in found:
        listed = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        pairs = [(a[-1], b[-1]) for a, b in groups]
        out.append((
            doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(pairs),
            sum(links[p] == best[p[1]] for p in pairs), sum(links[p] for p in pairs),
            hashlib.sha256(listed.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


def mixed_text(rng, n):
    words = ["the", "internationalisation", "naïve", "日本語テキスト", "🙂🙃", "3.14159", "don't", "<|endoftext|>", "</s>", "  ", "\n", "\t\t", "ﬁ", "é", "Straße,", "(x)", " ", "<0x41>", "aaaaaaaaaaaaaaaaaaaaa"]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.mark.parametrize("size", [16, 100, 1 << 16])
def test_rows(spark, known, size):
    rng = random.Random(size)
    texts = [mixed_text(rng, rng.choice((1, 5, 60, 300))) for _ in range(30)]
    texts += [None, "", " ", "  a", "a  ", "x", "a▁b", "without breaks " + "語" * 150, "b" * 300, "tail \n", "\x00 nul", " lead"]
    rows = [(i, t, i, "own") for i, t in enumerate(texts)] + [(None, texts[0], 1, None), (3, texts[3], 2, ""), (3, texts[3], 2, "")]
    out = alignment.align_documents(spark.createDataFrame(rows, SCHEMA).repartition(3), *PATHS, size=size, fan=2)
    assert sorted(map(tuple, out.collect()), key=repr) == expected(known, rows)
    assert alignment.align_documents(spark.createDataFrame([], SCHEMA), *PATHS).collect() == []


def test_fragments_are_a_monoid(known):
    """Any way of putting neighbouring fragments together gives the same groups."""
    rng = random.Random(4)
    for _ in range(30):
        text = mixed_text(rng, 20).replace("  ", "x")
        part = (" " + text).encode()
        a, b = known.tokens(part)
        cuts = sorted({0, len(part), *(rng.randrange(len(part)) for _ in range(9))})
        made = []
        for low, high in zip(cuts, cuts[1:], strict=False):
            made.append(alignment.fragment(known, a, b, low, high)[0])
        left = reduce(alignment.Fragment.__add__, made, alignment.EMPTY)
        right = reduce(lambda x, y: y + x, reversed(made), alignment.EMPTY)
        listed = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in plain_groups(known, text))
        assert left.groups() == right.groups() == listed.encode()


def test_ranges_hold_the_whole_text():
    text = ("word " * 50 + "語" * 100 + " more, words here" * 20).encode()
    for size in (7, 50, 64, 1_000_000):
        ranges = alignment.byte_ranges(text, size)
        assert [r[0] for r in ranges] == [0, *(r[1] for r in ranges[:-1])] and ranges[-1][1] == len(text)
        assert all(begin <= low < high <= end for low, high, begin, end in ranges)
    assert len(alignment.byte_ranges("語".encode() * 1000, 64)) == 1


def test_query(spark, sf_dir, known):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op13_fragment_alignment(spark, sf_dir).collect()), key=repr) == expected(known, docs)
