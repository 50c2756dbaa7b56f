"""Alignment of two tokenizers over one text, put together from fragments of byte ranges."""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from gamegrain.llm.common import ROW, numbered, prepare, write_out

RANGE = 1 << 16  # bytes of a range
MEMO, MEMO_BYTES = 150_000, 64  # stretches that a worker remembers, and the longest of them
LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")
AT_ONCE = 2_000  # stretches in one call of a tokenizer
FAN = 8  # neighbouring fragments that one task puts together
# A single space between two signs that are no white space: neither tokenizer has a token across its left side.
BREAK = re.compile(rb"(?<=[!-~]) (?=[!-~])")

FRAGMENT = (
    f"doc_id long, {ROW} long, range long, ranges long, valid boolean, n_a long, n_b long, n_groups long, cut boolean, "
    "before_a binary, before_b binary, closed binary, after_a binary, after_b binary, links array<int>, "
    "groups_sha256 string"
)


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the pairs of tokens that can ever end together.

    If two tokens end at one byte, the bytes of one are the last bytes of the other. So the vocabularies alone bound the
    number of pairs, whatever the corpus is.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        octets = byte_signs()
        names = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (1 + max(names.values()))
        for name, i in names.items():
            self.bytes_a[i] = bytes(map(octets.__getitem__, name)) if all(c in octets for c in name) else name.encode()
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        if any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(len(self.bytes_b))):
            raise ValueError("a piece goes across a space, so texts cannot be cut there")
        self.lengths_a, self.lengths_b = (np.array([*map(len, x)], np.int64) for x in (self.bytes_a, self.bytes_b))
        self.keys = self._pairs()
        self.width = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [b"%d%b" % (i, sign) for sign in (b",", b"|", b";") for i in range(self.width)]
        # Signs that are a token of their own after a letter, at the end of a stretch: no piece holds both.
        pieces = [*map(self.b.id_to_piece, range(len(self.bytes_b)))]
        self.stops = {}
        for sign in ".,":
            ends = self.a.encode("a" + sign, add_special_tokens=False).ids[1:], self.b.encode("a" + sign)[-1:]
            alone = [self.bytes_a[i] for i in ends[0]] == [self.bytes_b[i] for i in ends[1]] == [sign.encode()]
            if alone and not any(re.search("[A-Za-z]" + re.escape(sign), piece) for piece in pieces):
                a, b = np.array(ends[0]), np.array(ends[1])
                self.stops[ord(sign)] = Stretch(one_group((a, b)), 1, 1, self._numbers(a * len(self.bytes_b) + b))

    def _pairs(self) -> np.ndarray:
        by_bytes = []
        for tokens in (self.bytes_a, self.bytes_b):
            same: dict[bytes, list[int]] = {}
            for i, token in enumerate(tokens):
                same.setdefault(token, []).append(i)
            by_bytes.append(same)
        (a, b), width, found = by_bytes, len(self.bytes_b), array("q")
        for x, ids in a.items():
            found.extend(i * width + j for k in range(len(x)) for j in b.get(x[k:], ()) for i in ids)
        for x, ids in b.items():
            found.extend(i * width + j for k in range(len(x)) for i in a.get(x[k:], ()) for j in ids)
        return np.unique(np.frombuffer(found, np.int64))

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of pairs that end together."""
        return np.searchsorted(self.keys, a * len(self.bytes_b) + b).astype(np.int32)

    def second(self) -> np.ndarray:
        """The id of the second tokenizer in each pair."""
        return self.keys % len(self.bytes_b)

    def tokens(self, part: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both tokenizers for bytes that begin with a space; nothing if a tokenizer does not give them back."""
        try:
            text = part.decode()
        except UnicodeDecodeError:
            return None
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        if b"".join(map(self.bytes_a.__getitem__, a)) != part:
            return None
        b = self.b.encode(text[1:])
        if b"".join(map(self.bytes_b.__getitem__, b)) != part:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def stretches(self, wanted: set[bytes]) -> dict[bytes, Stretch | None]:
        """What is known of each stretch after its space; None if a tokenizer does not give it back.

        Stretches that begin and end with printable signs are tokenized as one text, since no token goes across the
        spaces between them; the others one by one.
        """
        found: dict[bytes, Stretch | None] = {}
        easy = [word for word in wanted if word and 32 < word[0] < 127 and 32 < word[-1] < 127]
        for at in range(0, len(easy), AT_ONCE):
            self._learn(easy[at : at + AT_ONCE], found)
        for word in wanted.difference(found):
            self._learn([word], found)
        return found

    def _learn(self, words: list[bytes], found: dict[bytes, Stretch | None]) -> None:
        tokens = self.tokens(b" " + b" ".join(words))
        if tokens is not None:
            found.update(zip(words, self._cut(words, *tokens), strict=True))
        elif len(words) == 1:
            found[words[0]] = None
        else:  # one of them is not given back: halves, until it is alone
            self._learn(words[: len(words) // 2], found)
            self._learn(words[len(words) // 2 :], found)

    def _cut(self, words: list[bytes], a: np.ndarray, b: np.ndarray) -> Iterator[Stretch]:
        """Stretches of neighbouring words from the tokens of their text; where a word ends, tokens of both end."""
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        last_a, last_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        # A group is written with its tokens of the first kind, then those of the second, each with the sign after it.
        names = np.empty(len(a) + len(b), np.int64)
        names[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = a + np.where(last_a, self.width, 0)
        names[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = b + np.where(last_b, 2 * self.width, 0)
        written = [*map(self.written.__getitem__, names.tolist())]
        text = b"".join(written)
        ends = np.cumsum([1 + len(word) for word in words])
        upto_a, upto_b = (np.searchsorted(e, ends, side="right") for e in (ends_a, ends_b))
        sizes = np.concatenate([[0], np.cumsum(np.fromiter(map(len, written), np.int64, len(written)))])
        cuts = sizes[upto_a + upto_b].tolist()
        groups = np.concatenate([[0], np.cumsum(last_a)])[upto_a]
        links, link_cuts = self._numbers(a[last_a] * len(self.bytes_b) + b[last_b]), (4 * groups).tolist()
        n_a, n_b = np.diff(upto_a, prepend=0).tolist(), np.diff(upto_b, prepend=0).tolist()
        begins, link_begins = [0, *cuts], [0, *link_cuts]
        for i in range(len(words)):
            yield Stretch(text[begins[i] : cuts[i]], n_a[i], n_b[i], links[link_begins[i] : link_cuts[i]])

    def _numbers(self, keys: np.ndarray) -> bytes:
        return np.searchsorted(self.keys, keys).astype(np.int32).tobytes()


class Stretch(NamedTuple):
    """A whole stretch between two breaks: its groups are closed, and so is what is known of it."""

    groups: bytes
    n_a: int
    n_b: int
    links: bytes


class Memory:
    """Stretches that occurred before; how many are kept is bounded, and changes no result."""

    def __init__(self, known: Vocabularies):
        self.known, self.new, self.old = known, {}, {}
        self.long: list[bytes] = []  # stretches too long to be kept beyond the texts that hold them

    def __call__(self, parts: list[list[bytes]]) -> dict[bytes, Stretch | None]:
        """All stretches of some texts."""
        for word in self.long:
            self.new.pop(word, None)
        wanted = set().union(*parts)
        missing = wanted.difference(self.new)
        if len(self.new) + len(missing) > MEMO:
            self.new, self.old, missing = {}, self.new, wanted
        again = {word: self.old[word] for word in missing if word in self.old}
        self.new.update(again)
        missing = missing.difference(again)
        stops = self.known.stops
        ended = [w for w in missing if len(w) > 1 and w[-1] in stops and (w[-2] | 32) in LETTERS]
        rest = missing.difference(ended).union([word[:-1] for word in ended]).difference(self.new)
        found = self.known.stretches(rest)
        for word in ended:  # a stretch with a stop after a letter is that stretch and the stop
            stem, stop = word[:-1], stops[word[-1]]
            known = self.new[stem] if stem in self.new else found[stem]
            found[word] = known and Stretch(known.groups + stop.groups, known.n_a + 1, known.n_b + 1, known.links + stop.links)
        self.new.update(found)
        self.long = [word for word in found if len(word) > MEMO_BYTES]
        return self.new


@lru_cache(maxsize=1)
def remembered(path_a: str, path_b: str) -> Memory:
    """One memory for each Python worker, kept from task to task."""
    return Memory(vocabularies(path_a, path_b))


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in byte-level vocabularies: printable ones stand for themselves, the others
    follow from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


@dataclass
class Fragment:
    """What a byte range knows of the groups: tokens of a group that began before it, groups closed within it, tokens
    of a group that goes on after it. Without a cut all its tokens are in ``before``.

    ``+`` is associative, and the empty fragment changes nothing: fragments of neighbouring ranges can be put together in
    any grouping, as long as they stay in order.
    """

    before: tuple[np.ndarray, np.ndarray]
    cut: bool = False
    closed: tuple[bytes, ...] = ()
    after: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def __add__(self, other: Fragment) -> Fragment:
        if not self.cut:
            before = _joined(self.before, other.before)
            return Fragment(before, other.cut, other.closed, other.after)
        middle = _joined(self.after, other.before)
        if not other.cut:
            return Fragment(self.before, True, self.closed, middle)
        return Fragment(self.before, True, (*self.closed, one_group(middle), *other.closed), other.after)

    def groups(self) -> bytes:
        """The groups of a whole text: nothing is open at its ends."""
        return b"".join((one_group(self.before), *self.closed))[:-1]


EMPTY = Fragment((np.zeros(0, np.int64), np.zeros(0, np.int64)))


def _joined(x, y):
    return tuple(np.concatenate(pair) for pair in zip(x, y, strict=True))


def one_group(tokens: tuple[np.ndarray, np.ndarray]) -> bytes:
    return b"|".join(b",".join(b"%d" % i for i in ids.tolist()) for ids in tokens) + b";"


def fragment(known: Vocabularies, a: np.ndarray, b: np.ndarray, low: int | None = None, high: int | None = None) -> tuple[Fragment, np.ndarray]:
    """Fragment of the tokens that end after ``low`` and not after ``high`` (all without them), and the pairs that end
    together there. A token belongs to the range that holds its last byte."""
    ends_a, ends_b = np.cumsum(known.lengths_a[a]), np.cumsum(known.lengths_b[b])
    if low is not None:
        s, t = (slice(*np.searchsorted(ends, (low, high), side="right")) for ends in (ends_a, ends_b))
        a, b, ends_a, ends_b = a[s], b[t], ends_a[s], ends_b[t]
    last_a, last_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
    cuts_a, cuts_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
    if not len(cuts_a):
        return Fragment((a, b)), np.zeros(0, np.int32)
    groups = zip(np.split(a, cuts_a)[1:-1], np.split(b, cuts_b)[1:-1], strict=True)
    closed = b"".join(map(one_group, groups))
    made = Fragment((a[: cuts_a[0]], b[: cuts_b[0]]), True, (closed,), (a[cuts_a[-1] :], b[cuts_b[-1] :]))
    return made, known.pair(a[last_a], b[last_b])


def range_fragment(known: Vocabularies, words: list[bytes], of: dict, low: int, high: int) -> tuple[Fragment, int, int, np.ndarray] | None:
    """Fragment of a range, counts of its tokens of both kinds, and its links; nothing if a stretch is not given back.

    Stretches within the range are closed; of those across its ends the tokens tell which belong to it. The first
    stretch that begins within it is taken apart as well: what it has before its first cut may belong to a group that
    began earlier.
    """
    ends = np.cumsum([1 + len(word) for word in words])
    made, n_a, n_b, links, at, begun = EMPTY, 0, 0, [], 0, False
    for word, end in zip(words, ends.tolist(), strict=True):
        begin, at = at, end
        if end <= low or begin >= high:
            continue
        if of[word] is None:
            return None
        if begin >= low and end <= high and begun:
            stretch = of[word]
            made = Fragment(made.before, True, (*made.closed, stretch.groups), EMPTY.after)
            n_a, n_b = n_a + stretch.n_a, n_b + stretch.n_b
            links.append(np.frombuffer(stretch.links, np.int32))
            continue
        a, b = known.tokens(b" " + word)
        some, pairs = fragment(known, a, b, low - begin, high - begin)
        inside = [
            int(np.diff(np.searchsorted(np.cumsum(sizes[ids]), (low - begin, high - begin), side="right"))[0])
            for sizes, ids in ((known.lengths_a, a), (known.lengths_b, b))
        ]
        made, n_a, n_b = made + some, n_a + inside[0], n_b + inside[1]
        links.append(pairs)
        # A stretch that ends within the range ends with a cut, so the next one is closed by itself.
        begun = end <= high
    return made, n_a, n_b, np.concatenate(links) if links else np.zeros(0, np.int32)


def byte_ranges(text: bytes, size: int) -> list[tuple[int, int, int, int]]:
    """Ranges of ``size`` bytes of a text as ``low, high, begin, end``: the part from begin to end holds the range, and
    no token of either tokenizer goes across its ends.

    A range that finds no such places near its end goes on to the next multiple of ``size``, so parts overlap by less
    than ``size``.
    """
    ranges, low, begin, n = [], 0, 0, len(text)
    for high in range(size, n, size):
        after = BREAK.search(text, high, high + size)
        before = [m.start() for m in BREAK.finditer(text, max(begin + 1, high - size), high + 2)]
        if after and before:
            ranges.append((low, high, begin, after.start()))
            low, begin = high, before[-1]
    return [*ranges, (low, n, begin, n)]


def _packed(ids: np.ndarray) -> bytes:
    return ids.astype("<i4").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i4").astype(np.int64)


NAMES = [field.split()[0] for field in FRAGMENT.split(", ")]


def fragments(parts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``FRAGMENT`` of each range; a text of one range has its digest already and needs no tokens any more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, memory = vocabularies(path_a, path_b), remembered(path_a, path_b)
        none = np.zeros(0, np.int32)
        nothing = (False, 0, 0, 0, *packed(EMPTY), none, "")
        for pdf in batches:
            # Neither tokenizer has a token across a break, so stretches between breaks are aligned by themselves.
            split = [BREAK.split(part[1:]) if len(part) > 1 else [] for part in pdf["part"]]
            of, out = memory(split), []
            columns = (pdf[name] for name in ("doc_id", ROW, "range", "ranges", "low", "high"))
            for doc_id, row, number, ranges, low, high, words in zip(*columns, split, strict=True):
                place = (None if pd.isna(doc_id) else int(doc_id), row, number, ranges)
                if ranges == 1:
                    stretches = [of[word] for word in words]
                    if not words or None in stretches:
                        out.append((*place, *nothing))
                        continue
                    links = np.frombuffer(b"".join([x.links for x in stretches]), np.int32)
                    digest = hashlib.sha256(b"".join([x.groups for x in stretches])[:-1]).hexdigest()
                    counts = sum([x.n_a for x in stretches]), sum([x.n_b for x in stretches]), len(links)
                    out.append((*place, True, *counts, *packed(EMPTY), links, digest))
                elif (found := range_fragment(known, words, of, low, high)) is None:
                    out.append((*place, *nothing))
                else:
                    made, n_a, n_b, links = found
                    out.append((*place, True, n_a, n_b, len(links), *packed(made), links, None))
            yield pd.DataFrame(out, columns=NAMES).astype({"doc_id": "Int64"})

    return parts.mapInPandas(run, FRAGMENT)


def packed(made: Fragment) -> tuple:
    return (made.cut, _packed(made.before[0]), _packed(made.before[1]), b"".join(made.closed), _packed(made.after[0]), _packed(made.after[1]))


def put_together(rows: Iterable[pd.Series]) -> Fragment:
    """Fragments of neighbouring ranges, in order, as one."""
    read = (
        Fragment((_unpacked(r.before_a), _unpacked(r.before_b)), bool(r.cut), (bytes(r.closed),), (_unpacked(r.after_a), _unpacked(r.after_b)))
        for r in rows
    )
    return reduce(Fragment.__add__, read, EMPTY)


def reduced(long: DataFrame, most: int, fan: int = FAN) -> DataFrame:
    """One fragment for each text of many ranges, by a tree: each level puts ``fan`` neighbours together, texts and
    stretches of a text in tasks of their own."""
    wanted = f"{ROW} long, range long, cut boolean, before_a binary, before_b binary, closed binary, after_a binary, after_b binary"
    names = [field.split()[0] for field in wanted.split(", ")]

    def level(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("range")
        made = put_together(pdf.itertuples(index=False))
        return pd.DataFrame([(pdf[ROW].iloc[0], pdf["range"].iloc[0] // fan, *packed(made))], columns=names)

    tree, left = long.select(*names), most
    while left > 1:
        tree = tree.groupBy(ROW, F.floor(F.col("range") / fan).alias("_over")).applyInPandas(level, wanted)
        left = -(-left // fan)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            digests = [hashlib.sha256(put_together([r]).groups()).hexdigest() for r in pdf.itertuples(index=False)]
            yield pd.DataFrame({ROW: pdf[ROW], "groups_sha256": digests})

    return tree.mapInPandas(finish, f"{ROW} long, groups_sha256 string")


def align_documents(docs: DataFrame, path_a: str, path_b: str, size: int = RANGE, fan: int = FAN) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row.

    Byte offsets where tokens of both tokenizers end cut a text into groups; a link is a pair of tokens that end
    together, and its count is how often the two ids are linked in the whole table. A link is best if no other id of the
    first tokenizer is linked to its second id more often; ties are best as well. A text that is NULL, empty, or not
    given back byte by byte by a tokenizer has no tokens: zeros and an empty digest, and it adds nothing to counts.
    Repeated rows each count and each give their row; an empty table gives an empty result; other columns are not read.

    Texts are cut into ranges of ``size`` bytes that are tokenized apart, in parts that begin and end where neither
    tokenizer has a token across; a text without such a place is one part. The driver holds the counts of pairs: the
    vocabularies bound their number.
    """
    spark = docs.sparkSession
    prepare(spark)
    text = F.concat(F.lit(" "), F.coalesce("text", F.lit(""))).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    long_texts = numbered(rows.where(F.length("text") > size), "long-texts")
    number = F.lit(0).cast("long")
    short = rows.where(F.length("text") <= size).select(
        "doc_id", number.alias(ROW), number.alias("range"), F.lit(1).cast("long").alias("ranges"), number.alias("low"),
        F.length("text").cast("long").alias("high"), F.col("text").alias("part"))
    names = short.columns

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for doc_id, row, text in zip(pdf["doc_id"], pdf[ROW], pdf["text"], strict=True):
                ranges = byte_ranges(text, size)
                yield pd.DataFrame(
                    [(doc_id, row, i, len(ranges), low - begin, high - begin, text[begin:end])
                     for i, (low, high, begin, end) in enumerate(ranges)], columns=names,
                ).astype({"doc_id": "Int64"})

    parts = long_texts.select("doc_id", ROW, "text").mapInPandas(cut, short.schema)
    # The ranges of a very long text go to tasks of their own.
    parts = short.unionByName(parts.repartition(F.xxhash64(ROW, "range")))
    made = write_out(fragments(parts, path_a, path_b), "fragments")

    one, many = made.where("ranges = 1 AND groups_sha256 IS NOT NULL"), made.where("ranges > 1")
    whole = many.groupBy(ROW).agg(F.first("doc_id").alias("doc_id"), F.min("valid").alias("valid"), F.max("ranges").alias("ranges"))
    whole = write_out(whole, "whole")
    many = many.drop("valid", "ranges", "doc_id").join(whole.where("valid").select(ROW), ROW)
    links = one.select("links").union(many.select("links"))
    counts = links.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")).collect()

    known = vocabularies(path_a, path_b)
    table, most = np.zeros(len(known.keys), np.int64), np.zeros(len(known.bytes_b), np.int64)
    for row in counts:
        table[row.pair] = row.n
    np.maximum.at(most, known.second(), table)
    shared = spark.sparkContext.broadcast((table, table == most[known.second()]))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        times, best = shared.value
        for pdf in batches:
            found = pdf.pop("links")
            pdf["n_best"] = [int(best[x].sum()) for x in found]
            pdf["count_sum"] = [int(times[x].sum()) for x in found]
            yield pdf

    sums = ["n_a", "n_b", "n_groups", "n_best", "count_sum"]
    numbers = ", ".join(f"{name} long" for name in sums)
    short_rows = one.select("doc_id", "groups_sha256", *sums[:3], "links").mapInPandas(
        measure, f"doc_id long, groups_sha256 string, {numbers}")
    of_ranges = many.select(ROW, *sums[:3], "links").mapInPandas(measure, f"{ROW} long, {numbers}")
    most_ranges = whole.agg(F.max("ranges")).first()[0] or 1
    long_rows = whole.select(ROW, "doc_id").join(of_ranges.groupBy(ROW).agg(*(F.sum(n).alias(n) for n in sums)), ROW, "left")
    long_rows = long_rows.join(reduced(many, most_ranges, fan), ROW, "left").fillna(0, sums).fillna("", "groups_sha256")
    return short_rows.unionByName(long_rows.drop(ROW)).select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
