"""Byte-level BPE by rank file: whole pre-tokens through a perfect hash, the rest through a heap over linked bytes."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamegrain.llm.common import prepare, text_of
from gamegrain.llm.perfect import PerfectHash

# Remembered chunks of text; beyond that the older half is forgotten, so memory is bounded whatever the vocabulary.
MEMO = 350_000
STOPS = (".", ",")
# Two ranks in one number; a rank and a place in one number.
PAIR, PLACE = 24, 40
PLACES = (1 << PLACE) - 1
# White space before a space: such a run of white space spans a cut at the space.
RUN = re.compile(r"\s ")
# \s of the ``re`` module holds four separators that are no white space in the tokenizer's pattern.
ODD_SPACE = re.compile("[\x1c-\x1f]")


class ByteBpe:
    """Encoder and decoder of one rank file, for one pattern of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern).findall
        self.ranks = ranks
        self.name_of = {token: str(rank) for token, rank in ranks.items()}
        self.names = [str(rank) for rank in range(max(ranks.values()) + 1)]
        self.single = [ranks[bytes([i])] for i in range(256)]
        # Every two tokens that make a token, with the rank of what they make.
        self.pairs = {
            ranks[token[:i]] << PAIR | ranks[token[i:]]: rank
            for token, rank in ranks.items() for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self.bytes_of = {str(rank): token for token, rank in ranks.items()}
        low, high = zip(*(self._key(token) for token in ranks), strict=True)
        low, high = np.array(low, np.uint64), np.array(high, np.uint64)
        self.hash = PerfectHash.build(low, high)
        self.held: list[bytes] = [b""] * len(ranks)
        for slot, token in zip(self.hash.slots(low, high).tolist(), ranks, strict=True):
            self.held[slot] = token
        self.new: dict[str, str] = {}
        self.old: dict[str, str] = {}

    @staticmethod
    def _key(token: bytes) -> tuple[int, int]:
        value = xxhash.xxh3_128_intdigest(token)
        return value & 0xFFFFFFFFFFFFFFFF, value >> 64

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines)
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def known(self, pieces: list[bytes]) -> list[bool]:
        """First tier: is the whole pre-token in the vocabulary? The bytes held in its slot are compared."""
        if not pieces:
            return []
        low, high = (np.array(part, np.uint64) for part in zip(*map(self._key, pieces), strict=True))
        held = self.held
        slots = self.hash.slots(low, high).tolist()
        return [slot >= 0 and held[slot] == piece for slot, piece in zip(slots, pieces, strict=True)]

    def merge(self, piece: bytes) -> list[int]:
        """Second tier: the lowest rank first (ties: leftmost), over a linked list of parts."""
        single, pair = self.single, self.pairs.get
        n, parts = len(piece), [single[byte] for byte in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        made = [pair(a << PAIR | b, -1) for a, b in zip(parts, parts[1:])] + [-1]
        heap = [rank << PLACE | i for i, rank in enumerate(made) if rank >= 0]
        heapq.heapify(heap)
        while heap:
            first = heapq.heappop(heap)
            rank, i = first >> PLACE, first & PLACES
            if made[i] != rank:
                continue  # one of the two parts has been merged since
            j = after[i]
            parts[i], parts[j], made[j] = rank, -1, -1
            after[i] = k = after[j]
            made[i] = -1
            if k < n:
                before[k] = i
                made[i] = found = pair(rank << PAIR | parts[k], -1)
                if found >= 0:
                    heapq.heappush(heap, found << PLACE | i)
            h = before[i]
            if h >= 0:
                made[h] = found = pair(parts[h] << PAIR | rank, -1)
                if found >= 0:
                    heapq.heappush(heap, found << PLACE | h)
        return [part for part in parts if part >= 0]

    def _learn(self, chunks: set[str]) -> None:
        """Adds stretches of text to the memory: all their pre-tokens go through the first tier at once."""
        new, old, stops, cut = self.new, self.old, {}, {}
        for chunk in chunks:
            if (found := old.get(chunk)) is not None:
                new[chunk] = found
            elif chunk[-1:] in STOPS and chunk[-2:-1].isalpha():
                stops[chunk] = chunk[:-1]  # letters and stops are pre-tokens of their own
            else:
                cut[chunk] = None
        for stem in stops.values():
            if stem not in new:
                cut[stem] = None
        for chunk in cut:
            cut[chunk] = [chunk] if chunk[1:].isalpha() and chunk[0] == " " else self.split(chunk)
        pieces = [piece.encode() for split in cut.values() for piece in split]
        hits = iter(zip(pieces, self.known(pieces), strict=True))
        names, name_of, merge = self.names, self.name_of, self.merge
        for chunk, split in cut.items():
            ids = []
            for _ in split:
                piece, hit = next(hits)
                ids += [name_of[piece]] if hit else [names[part] for part in merge(piece)]
            new[chunk] = " ".join(ids)
        for chunk, stem in stops.items():
            new[chunk] = f"{new[stem]} {name_of[chunk[-1].encode()]}"

    def _stretches(self, text: str) -> list[str]:
        """A text is cut before each space that follows other than white space: no pre-token crosses such a place."""
        if RUN.search(text) or ODD_SPACE.search(text):
            return self.split(text)
        first, *rest = text.split(" ")
        stretches = [" " + part for part in rest]
        return [first, *stretches] if first else stretches

    def encode(self, texts: list[str]) -> list[str]:
        """Ids of each text as decimal text, joined by spaces."""
        split = [self._stretches(text) for text in texts]
        wanted = set().union(*split)
        missing = wanted.difference(self.new)
        if len(self.new) + len(missing) > MEMO:
            self.old, self.new = self.new, {}
            missing = wanted
        self._learn(missing)
        ids = self.new.__getitem__
        return [" ".join(map(ids, stretches)) for stretches in split]

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.split(" "))) if ids else b""


@lru_cache(maxsize=2)
def loaded(path: str, pattern: str) -> ByteBpe:
    """One encoder for each Python worker."""
    return ByteBpe.load(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row; nothing is shuffled.

    NULL and empty texts have no tokens and the digests of nothing. Ids are those of each match of the pattern by
    itself, without special tokens; bytes are decoded from the ids. Of equal ranks the leftmost pair is merged first.
    Repeated rows each give their row; an empty table gives an empty result; other columns are not read. A very long text
    is one row, a very long match goes through the heap.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = loaded(path, pattern)
        for pdf in batches:
            rows = []
            for ids in coder.encode(pdf["text"].tolist()):
                rows.append((ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                             hashlib.sha256(coder.decode(ids)).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", pdf["doc_id"])
            yield out

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return narrow.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
