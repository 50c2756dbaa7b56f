"""Best-two-fit packing of token pieces into sequences of fixed capacity."""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from string import punctuation

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from gamegrain.llm.common import ROW, numbered, prepare, ranked, text_of

CAPACITY = 4096
END_ID = 1
MEMO = 700_000  # stretches that a worker remembers, of this generation and of the one before; changes no result

# ASCII signs that the tokenizer takes together when they follow a letter: all but the apostrophe of 's, 't and the like.
SIGNS = "".join(set(punctuation) - {"'"})

# A word of letters below U+0100, in lower case: NFC leaves them as they are, and the tokenizer makes one pre-token of them.
LATIN = re.compile("[a-zªµºß-öø-ÿ]+")
# How the vocabulary writes the bytes of the signs from U+0080 to U+00FF.
BYTES = {at: ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(at))[0][0] for at in range(128, 256)}
# White space for str.split, but not for the tokenizer.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Memory(dict):
    """What ``learn`` gives for a word, of at most ``MEMO`` words and as many before them."""

    def __init__(self, learn: Callable[[str], bytes]):
        super().__init__()
        self.learn = learn
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.learn(word)
        if len(self) >= MEMO:
            self.old.clear()
            self.old.update(self)
            self.clear()
        self[word] = ids
        return ids


def folded(text: str) -> str:
    """The text in lower case, as the tokenizer has it, if all its signs are below U+0100; others stay as they are."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


class Coder:
    """Token ids of a text as bytes (unsigned 32 bit, little-endian).

    The tokenizer drops white space and joins nothing across it, so each stretch between white space is encoded by
    itself and remembered; the memory is bounded.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokens = self.tokenizer.model.tokenize
        self.memory = Memory(self._learn)
        # Texts with one of these are encoded whole; the tokenizer looks for its special tokens before all else.
        self.apart = (*SEPARATORS, *(token.content for token in self.tokenizer.get_added_tokens_decoder().values()))

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, found = self.memory.__getitem__, []
        for text in texts:
            low = folded(text)
            found.append(self.whole(text) if any(c in low for c in self.apart) else b"".join(map(ids, low.split())))
        return found

    def _learn(self, word: str) -> bytes:
        """A word with signs after its last letter is that word and the signs, two pre-tokens."""
        if word[-1] in SIGNS and (stem := word.rstrip(SIGNS)) and stem.lower()[-1].isalpha():
            return self.memory[stem] + self.memory[word[len(stem):]]
        return self._encode([word])[0]

    def _encode(self, words: list[str]) -> list[bytes]:
        """Words of Latin letters go to the model without the steps before it."""
        found = []
        for word in words:
            low = word.lower()
            if LATIN.fullmatch(low):
                tokens = self.tokens(low if low.isascii() else low.translate(BYTES))
                found.append(array("I", [token.id for token in tokens]).tobytes())
            else:
                found.append(self.whole(word))
        return found


@lru_cache(maxsize=1)
def coder(path: str) -> Coder:
    return Coder(path)


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of each document: its ids and the end id, cut every ``capacity`` ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = coder(path).encode, np.array([END_ID], "<u4").tobytes()
        for pdf in batches:
            owner, start, length, checksum = [], [], [], []
            for row, ids in enumerate(encode(pdf["text"].tolist())):
                ids += end
                for at in range(0, len(ids), 4 * capacity):
                    part = ids[at : at + 4 * capacity]
                    owner.append(row)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    checksum.append(zlib.crc32(part))
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].astype("Int64").take(owner).array, "piece": np.array(start, np.int64) // capacity,
                "start": start, "length": length, "ids_crc32": checksum})

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return narrow.mapInPandas(run, PIECES)


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, pieces of that length per sequence, sequences, first sequence, offset).

    Only the number of pieces of each length matters, so a sequence is planned once and used as often as the
    numbers allow; that gives the sequences of the same steps done one at a time. Each plan uses up a length,
    so the table is bounded by the capacity, whatever the number of pieces.
    """
    left = dict(counts)
    lengths = sorted(left)
    used = dict.fromkeys(left, 0)
    rows, sequence = [], 0

    def drop(length: int) -> None:
        if left[length] == taken.get(length, 0):
            lengths.pop(bisect_right(lengths, length) - 1)

    while left:
        taken: dict[int, int] = {}
        gap = capacity
        while (at := bisect_right(lengths, gap) - 1) >= 0:  # fill: always the longest that still fits
            length = lengths[at]
            most = min(left[length] - taken.get(length, 0), gap // length)
            taken[length] = taken.get(length, 0) + most
            gap -= most * length
            drop(length)
        smallest = min(taken)
        if gap and lengths and sum(taken.values()) > 1:  # two unpacked pieces for the smallest, if they fit more tightly
            room = gap + smallest
            free = np.array(lengths[: bisect_right(lengths, room)])
            if len(free):
                partner = np.searchsorted(free, room - free, "right") - 1
                single = np.array([left[x] - taken.get(x, 0) < 2 for x in free.tolist()])
                partner = np.where((partner == np.arange(len(free))) & single, partner - 1, partner)
                sums = np.where(partner >= 0, free + free[partner], 0)
                best = int(np.argmax(sums))
                if smallest < sums[best]:
                    taken[smallest] -= 1
                    if left[smallest] - taken[smallest] == 1:
                        lengths.insert(bisect_right(lengths, smallest), smallest)
                    for length in (int(free[best]), int(free[partner[best]])):
                        taken[length] = taken.get(length, 0) + 1
                        drop(length)
        taken = {k: v for k, v in taken.items() if v}
        times = min(left[k] // v for k, v in taken.items())
        offset = 0
        for length, n in sorted(taken.items(), reverse=True):
            rows.append((length, used[length], n, times, sequence, offset))
            offset += n * length
            used[length] += n * times
            left[length] -= n * times
            if not left[length]:
                del left[length]
        sequence += times
        lengths = sorted(left)
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    The plan is made on the driver from one number per length. A piece finds its place by its rank among the pieces
    of its length. Empty table: empty result.
    """
    spark = prepare(pieces.sparkSession)
    rows = numbered(pieces, "pieces")
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}
    table = spark.sparkContext.broadcast(plan(counts, capacity))
    placed = ranked(rows, "length", "_rank").drop(ROW)

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = table.value
        keys = (steps[:, 0] << 48) + steps[:, 1]
        for pdf in batches:
            if len(pdf):
                rank, length = pdf.pop("_rank").to_numpy(np.int64), pdf["length"].to_numpy(np.int64)
                step = steps[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
                inside = rank - step[:, 1]
                pdf["sequence_id"] = step[:, 4] + inside % step[:, 3]
                pdf["offset"] = step[:, 5] + inside // step[:, 3] * length
                if "doc_id" in pdf:
                    pdf["doc_id"] = pdf["doc_id"].astype("Int64")
                yield pdf

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return placed.mapInPandas(locate, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every row.

    NULL and empty texts are a piece of one id, the end. Repeated rows are packed as often as they come. A very long text
    is one row, cut into as many pieces as it needs. Other columns are not read; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    return pack(cut_pieces(docs, path, capacity), capacity)
