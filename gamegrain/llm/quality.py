"""Quality classifier: perplexity under an interpolated modified Kneser-Ney trigram model of trusted text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamegrain.llm.common import ROW, SHUFFLE, likely, many_rows, numbered, prepare, text_of, without_rows, write_out

# Trusted documents of each language: all. Words of each language, and shapes, whose pairs are held by every task, the most
# frequent ones: all others are as good words, their pairs and trigrams are joined. Changes no result.
SAMPLE, WORDS = None, 2_000
# Threshold of a language: this quantile of the score of its trusted documents that the model has not seen, times the
# slack. The score is the perplexity with PRIOR tokens of the language's mean added, so that a short text is not
# rejected for a few rare words.
QUANTILE, SLACK, PRIOR = 0.995, 1.5, 20
POOLED = ""  # the model of all trusted text, for languages that have none of their own
LANGUAGES = 64  # languages with most trusted rows that have a model of their own, however many names ``lang`` holds
LEAST_TRUSTED = 20

UNKNOWN, START, END, REPEAT, LONG_RUN = 0, 1, 2, 3, 5
FIRST_ID = 6
BITS, HIGH_BITS = 21, 10  # bits of an id in a key, and those above them, which are kept apart
MEMO = 300_000
SHAPE = "\x00"
SHARD_ROWS = 500_000  # trigrams of a shard, about
HOT = 1_000_000  # trigrams and pairs, the most frequent ones, that are broadcast instead of joined; changes no result
FILTER_BITS = 28  # the others have 2**28 bits at most, by which those that no text may hold are not asked for; changes no result
WORDS_HELD = 400_000
HELD, HELD_ROWS = 2_000_000, 8_192  # trigrams and texts that are packed at once
AT_ONCE = 200_000  # tokens that are looked up at once
UNIT = 1 << 32  # parts of a natural log
CODEC = pa.Codec("zstd", compression_level=1)
COUNTS = "lang string, part long, size long, keys binary, counts binary"  # counts of many trigrams, in a row
FACTS = ("n", "ones", "twos", "kinds", "total")
WANTED = ("n", "after", "ones", "twos", "kinds")
PART_CHARS = 8_000_000  # signs of the texts for each part that trigrams are summed in
SHAPES = ((re.compile(r"\d+"), "0"), (re.compile(r"[^\W\d_]+"), "a"))


def shape_of(word: str) -> str:
    """What a word outside the vocabulary counts as: case, other signs as they are, and length."""
    letters = sum(map(str.isalpha, word))
    case = "U" if letters > 1 and word.isupper() else "T" if word[:1].isupper() else "l"
    for pattern, sign in SHAPES:
        word = pattern.sub(sign, word)
    return f"{SHAPE}{case}{word[:8]}{min(letters, 15) // 4}"


def look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values by sorted key, and which keys were there."""
    if not len(keys):
        return missing, np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return np.where(hit, values[at], missing), hit


def keys_of(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of trigrams: ``BITS`` of each id, and what the ids have above them (0 for nearly all)."""
    mask = (1 << BITS) - 1
    high = (a >> BITS) << 2 * HIGH_BITS | (b >> BITS) << HIGH_BITS | c >> BITS
    return (a & mask) << 2 * BITS | (b & mask) << BITS | c & mask, high


def parts_of(keys: np.ndarray, high: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mask, upper = (1 << BITS) - 1, (1 << HIGH_BITS) - 1
    return tuple((keys >> i * BITS & mask) | (high >> i * HIGH_BITS & upper) << BITS for i in (2, 1, 0))


def xxhash64(values: np.ndarray) -> np.ndarray:
    """Spark's function of that name, of whole numbers."""
    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return x << np.uint64(by) | x >> np.uint64(64 - by)

    p1, p2, p3, p4, p5 = map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    h = turned(values.view(np.uint64) * p2, 31) * p1 ^ (np.uint64(42 + 8) + p5)
    h = turned(h, 27) * p1 + p4
    h = (h ^ h >> np.uint64(33)) * p2
    h = (h ^ h >> np.uint64(29)) * p3
    return (h ^ h >> np.uint64(32)).view(np.int64)


def digests(words: Iterable[str]) -> np.ndarray:
    return np.frombuffer(b"".join(blake2b(word.encode(), digest_size=8).digest() for word in words), "<i8")


class Words(dict):
    """Ids of a language's most frequent words and shapes. All others of its vocabulary are told by their digests, sorted in
    ``rest``: the first has the id behind those of the frequent ones. ``signs`` are those that all its shapes are written with."""

    def __init__(self, held: Iterable[str], rest: np.ndarray, signs: set[str]):
        super().__init__((word, FIRST_ID + i) for i, word in enumerate(held))
        self.core, self.rest, self.signs = FIRST_ID + len(self), rest, signs

    def __reduce__(self) -> tuple:
        return Words, ([*self], self.rest, self.signs)

    @property
    def size(self) -> int:
        return self.core + len(self.rest)


def _known(words: list[str], known: dict[str, int]) -> list[int | None]:
    """Ids of the words that are in the vocabulary."""
    found = [*map(known.get, words)]
    rest = getattr(known, "rest", ())
    if len(rest):
        at = [i for i, x in enumerate(found) if x is None]
        wanted = digests(words[i] for i in at)
        places = np.minimum(np.searchsorted(rest, wanted), len(rest) - 1)
        for i, place, hit in zip(at, places.tolist(), (rest[places] == wanted).tolist(), strict=True):
            if hit:
                found[i] = known.core + place
    return found


class Few:
    """An array with few different values: a small number for each place."""

    def __init__(self, values: np.ndarray):
        self.values, codes = np.unique(values, return_inverse=True)
        self.codes = codes.astype(np.min_scalar_type(max(len(self.values) - 1, 0)))

    def __len__(self) -> int:
        return len(self.codes)

    def __getitem__(self, at: np.ndarray | slice) -> np.ndarray:
        return self.values[self.codes[at]]


class Pairs:
    """A set of pairs of ids below ``size`` that tells the place of each among all, sorted: a bit for each possible pair,
    and how many pairs come before each 64 of them."""

    def __init__(self, keys: np.ndarray, size: int):
        self.size = size
        at = self._at(np.sort(keys))
        words, first = np.unique(at >> 6, return_index=True)
        self.bits = np.zeros((size * size >> 6) + 1, np.uint64)
        if len(at):
            self.bits[words] = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first)
        counts = np.bitwise_count(self.bits).astype(np.int64)
        self.before = (np.cumsum(counts) - counts).astype(np.uint32)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> BITS) * self.size + (keys & (1 << BITS) - 1)

    def key(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Keys of pairs of ids; (UNKNOWN, UNKNOWN), which is never in a set, for pairs of other ids."""
        return np.where((x < self.size) & (y < self.size), x << BITS | y, 0)

    def keys(self) -> np.ndarray:
        at = np.nonzero(np.unpackbits(self.bits.view(np.uint8), bitorder="little"))[0]
        return at // self.size << BITS | at % self.size

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key stands, and whether it is there; if not, its place is any that an array of values has."""
        at = self._at(keys)
        word, bit = at >> 6, np.uint64(1) << (at & 63).astype(np.uint64)
        bits = self.bits[word]
        hit = (bits & bit) != 0
        return np.where(hit, self.before[word] + np.bitwise_count(bits & (bit - np.uint64(1))), 0), hit

    def look(self, values: np.ndarray, wanted: np.ndarray, missing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values by pair, and which pairs were there."""
        if not len(values):
            return missing, np.zeros(len(wanted), bool)
        at, hit = self.places(wanted)
        return np.where(hit, values[at], missing), hit


@dataclass
class Model:
    """Tables of one language. Those of pairs hold the ids below ``words.core``, of a context and a token; what other pairs and
    trigrams are worth is joined, apart from the most frequent ones."""

    words: Words
    first: Few | np.ndarray  # probability by id; that of UNKNOWN is shared by all shapes that are not in ``words``
    context2: Few  # weight of the lower order by id
    total2: Few  # pairs by the id of their context
    cuts2: np.ndarray  # discounts of counts 1, 2 and more
    cuts3: np.ndarray
    pairs2: Pairs
    prob2: np.ndarray
    pairs3: Pairs
    weight3: np.ndarray
    keys3: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # trigrams, if a driver holds them all
    prob3: np.ndarray = field(default_factory=lambda: np.zeros(0))
    hot3: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # frequent trigrams and pairs
    worth3: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # what they take off the loss, in 1/UNIT
    joined: int = 0  # how many others there are
    salt: int = 0
    bits: np.ndarray | None = None  # of a filter of all other trigrams and pairs, of all languages

    def __post_init__(self) -> None:
        # Signs that the kept shapes are written with, SHAPE as their end among them, and one for all other signs.
        self.sign = float(np.log(1 + len(self.words.signs)))

    @property
    def contexts3(self) -> np.ndarray:
        return self.pairs3.keys()

    def spelling(self, words: list[str], ids: np.ndarray) -> float:
        """Negative log of the part of UNKNOWN's probability that the unknown shapes have: equal signs, sign by sign."""
        return self.sign * sum(len(shape_of(words[at - 2])) for at in np.nonzero(ids == UNKNOWN)[0].tolist())

    def lower(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(c | a b) of trigrams that were not seen: the lower order times the context's weight; and whether their last and
        first pairs were seen. Pairs that are not held count as not seen."""
        second, pair = self.pairs2.look(self.prob2, self.pairs2.key(b, c), self.context2[b] * self.first[c])
        weight, context = self.pairs3.look(self.weight3, self.pairs3.key(a, b), np.ones(len(a)))
        return weight * second, pair, context

    def probability(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """P(c | a b): the table's value if the trigram was seen."""
        return look(self.keys3, self.prob3, keys_of(a, b, c)[0], self.lower(a, b, c)[0])[0]

    def worth(self, keys: np.ndarray, high: int, facts: dict[str, np.ndarray]) -> np.ndarray:
        """What seen trigrams and pairs take off the loss, in 1/UNIT, by ``WANTED``: how often trigrams were seen, behind how many words
        their last two, and how many words are behind their first two, once, twice and in all.

        A trigram: log of how many times more probable it is than if it had not been seen. A pair (its first id is UNKNOWN): the
        same, if it has words before it; log of its weight as a context, if it has words behind it and none before."""
        a, b, c = parts_of(keys, high)
        n, after, kinds = facts["n"], facts["after"], facts["kinds"]
        freed = facts["ones"] * self.cuts3[0] + facts["twos"] * self.cuts3[1] + (kinds - facts["ones"] - facts["twos"]) * self.cuts3[2]
        below, total = self.context2[b] * self.first[c], self.total2[b]
        seen = (after - self.cuts2[np.clip(after, 1, 3) - 1]) / np.maximum(total, 1)
        triple = a != UNKNOWN
        with np.errstate(all="ignore"):
            value = np.where(
                triple, np.log1p((n - self.cuts3[np.minimum(n, 3) - 1]) / np.where(triple, freed, 1) / (seen + below)),
                np.where(after > 0, np.log1p(seen / below), np.log(np.where(kinds > 0, freed, 1) / n)))
        return np.rint(value * UNIT).astype(np.int64)

    def may_be(self, keys: np.ndarray) -> np.ndarray:
        """Which trigrams and pairs may be among those that are joined."""
        if self.bits is None:
            return np.ones(len(keys), bool)
        at = xxhash64(keys ^ self.salt) & 8 * len(self.bits) - 1
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def word_ids(words: list[str], known: dict[str, int], memo: dict[str, int]) -> np.ndarray:
    """Ids of a document, with two starts before and the end after; the first, second and further repetitions of
    a word in a row are three tokens of their own: natural text has the first two.

    ``memo`` holds the id of a word that came before, and above it a number that no other word there has.
    """
    missing = set(words).difference(memo)
    if len(memo) + len(missing) > MEMO:
        memo.clear()
        missing = set(words)
    if missing:
        new = [*missing]
        found = _known(new, known)
        others = [i for i, x in enumerate(found) if x is None]
        for i, shape in zip(others, _known([shape_of(new[i]) for i in others], known), strict=True):
            found[i] = UNKNOWN if shape is None else shape
        for word, number in zip(new, found, strict=True):
            memo[word] = len(memo) << 32 | number
    ids = np.full(len(words) + 3, START, np.int64)
    ids[-1] = END
    numbers = np.array([*map(memo.__getitem__, words)], np.int64)
    ids[2:-1] = numbers & (1 << 32) - 1
    same = numbers[1:] == numbers[:-1]
    if same.any():
        at = np.arange(len(numbers))
        first = np.concatenate([[True], ~same])
        again = at - np.maximum.accumulate(np.where(first, at, 0))
        ids[2:-1] = np.where(again > 0, np.minimum(REPEAT + again - 1, LONG_RUN), ids[2:-1])
    return ids


def trusted_rows(labels: DataFrame) -> DataFrame:
    """Ids labelled good and nowhere toxic, each once, in two halves: ``fit`` true for the model's half."""
    grouped = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    good = grouped.agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")).where("q = 1 AND t = 0")
    return good.select("doc_id", (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("fit"))


def fit_sample(docs: DataFrame, labels: DataFrame, per_language: int | None = SAMPLE) -> DataFrame:
    """``lang, text`` of the trusted documents of the model's half, each once: all of them unless ``per_language`` is given.

    Languages beyond the ``LANGUAGES`` with most rows come as ``POOLED``; the pool itself is all rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit(POOLED)).alias("lang"),
                        text_of().alias("text"))
    half = trusted_rows(labels).where("fit").select("doc_id")
    found = numbered(likely(texts, half, "doc_id"), "found")
    once = found.select("doc_id", ROW).join(half, "doc_id").groupBy("doc_id").agg(F.min(ROW).alias(ROW))
    others = write_out(found.select(ROW).join(once.select(ROW), ROW, "left_anti"), "others")
    trusted = found if others.isEmpty() else without_rows(found, others)
    if per_language is not None:
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id"))
        trusted = trusted.withColumn("_n", place).where(F.col("_n") <= per_language)
    trusted = trusted.select("lang", "text")
    counted = trusted.where(F.col("lang") != POOLED).groupBy("lang").count().orderBy(F.desc("count"), "lang")
    own = [row.lang for row in counted.limit(LANGUAGES).collect()]
    return trusted.withColumn("lang", F.when(F.col("lang").isin(own), F.col("lang")).otherwise(F.lit(POOLED)))


def vocabulary(sample: DataFrame, words: int | None, docs: DataFrame | None = None) -> dict[str, Words]:
    """Per language, and for the pool of all, every word and every shape of a word that stands there twice or more. The
    ``words`` most frequent ones (all with None) come as text, the others as digests.

    What stands there once is what unknown words are told by: it counts as its shape, or as UNKNOWN. With ``docs`` the pool
    is left out if every row of it has a language with a vocabulary.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush() -> Iterator[pd.DataFrame]:
            for lang, found in seen.items():
                shapes: Counter = Counter()
                for word, n in found.items():
                    shapes[shape_of(word)] += n
                yield pd.DataFrame({"lang": lang, "word": [*found, *shapes], "n": [*found.values(), *shapes.values()]})

        seen: dict[str, Counter] = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                seen.setdefault(lang, Counter()).update(text.split())
            if sum(map(len, seen.values())) > WORDS_HELD:
                yield from flush()
                seen = {}
        yield from flush()

    parts = sample.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    parts = write_out(parts, "words")
    counts = parts.where((F.col("lang") != POOLED) & (F.col("n") > 1))
    own = [row.lang for row in counts.select("lang").distinct().collect()]
    if docs is None or not docs.where(~F.coalesce(F.col("lang").isin(own), F.lit(False))).isEmpty():
        pool = parts.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
        counts = counts.unionByName(pool.select(F.lit(POOLED).alias("lang"), "word", "n"))
    shape = F.col("word").startswith(SHAPE)
    held = counts
    if words is not None:
        place = F.row_number().over(Window.partitionBy("lang", shape).orderBy(F.desc("n"), "word"))
        held = counts.withColumn("place", place).where(F.col("place") <= words)
    rows = held.select("lang", "word").collect()
    texts = {lang: sorted(row.word for row in rows if row.lang == lang) for lang in sorted({row.lang for row in rows})}
    if not texts:
        return {}

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"lang": pdf["lang"], "digest": digests(pdf["word"])})

    number = _by_language({lang: i for i, lang in enumerate(texts)}).cast("int").alias("lang")
    every = _arrays(counts.select(number, "word").mapInPandas(digest, "lang int, digest long"))
    signs = counts.where(shape).select("lang", F.explode(F.split("word", "")).alias("sign")).distinct().collect()
    return {lang: Words(own, np.setdiff1d(every["digest"][every["lang"] == i], digests(own)), {row.sign for row in signs if row.lang == lang})
            for i, (lang, own) in enumerate(texts.items())}


def _discounts(table: DataFrame, n: str) -> dict[str, np.ndarray]:
    """Per language the three discounts of modified Kneser-Ney from the counts of counts."""
    counted = table.groupBy("lang").agg(*[F.count(F.when(F.col(n) == i, 1)).alias(f"n{i}") for i in range(1, 5)])
    cuts = {}
    for row in counted.collect():
        y = row.n1 / (row.n1 + 2 * row.n2) if row.n1 else 0.0
        pairs = ((1, row.n2, row.n1), (2, row.n3, row.n2), (3, row.n4, row.n3))
        cut = [i - (i + 1) * y * upper / lower if row.n1 and lower else 0.5 * i for i, upper, lower in pairs]
        cuts[row.lang] = np.array([max(min(x, 0.95 * i), 0.05) for i, x in zip((1, 2, 3), cut, strict=True)])
    return cuts


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, as compressed differences."""
    return CODEC.compress(np.diff(values, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(CODEC.decompress(data, 8 * n, asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel())


def _packed_small(values: np.ndarray) -> bytes:
    """Numbers below 2**16, compressed."""
    return CODEC.compress(values.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), asbytes=True)


def _unpacked_small(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(CODEC.decompress(data, 2 * n, asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(2, -1).T).view("<u2").ravel()


def _packed_plain(values: np.ndarray) -> bytes:
    """Numbers of which most are small, compressed as they are."""
    return _squeezed(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)


def _unpacked_plain(data: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(_restored(data, 8 * n).reshape(8, -1).T).view("<i8").ravel()


def _squeezed(octets: np.ndarray) -> bytes:
    return CODEC.compress(octets.tobytes(), asbytes=True)


def _restored(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(CODEC.decompress(data, n, asbytes=True), np.uint8)


def _by_part(keys: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The order of keys by part, sorted within it, and from where to where each part goes."""
    order = np.argsort(keys)
    order = order[np.argsort(part[order], kind="stable")]
    cuts = [*np.nonzero(np.diff(part[order], prepend=-1))[0].tolist(), len(keys)]
    return order, [*zip(cuts, cuts[1:])]


def _pack_counts(name: str, keys: np.ndarray, counts: np.ndarray, part: np.ndarray) -> list[tuple]:
    """Rows of ``COUNTS``: the keys of a part, sorted, with how often each stands."""
    order, cuts = _by_part(keys, part)
    keys, counts, part = keys[order], counts[order], part[order]
    return [(name, int(part[low]), high - low, _packed(keys[low:high]), _packed(np.cumsum(counts[low:high]))) for low, high in cuts]


def _unpack_counts(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of rows of ``COUNTS``, at least one."""
    parts = [*rows[["size", "keys", "counts"]].itertuples(index=False)]
    return (np.concatenate([_unpacked(part.keys, part.size) for part in parts]),
            np.concatenate([np.diff(_unpacked(part.counts, part.size), prepend=0) for part in parts]))


def _alike(high: np.ndarray) -> Iterator[tuple[int, np.ndarray | slice]]:
    """The values of what keys leave out, few, and where each stands."""
    if not high.any():
        yield 0, slice(None)
        return
    for value in np.unique(high).tolist():
        yield value, np.nonzero(high == value)[0]


def _pack_facts(name: str, keys: np.ndarray, high: np.ndarray, part: np.ndarray, facts: dict[str, np.ndarray]) -> list[tuple]:
    """``lang, part, high, size, keys`` and the facts: the keys of a part, sorted, with what is known of them."""
    rows = []
    for value, at in _alike(high):
        order, cuts = _by_part(keys[at], part[at])
        own, where = keys[at][order], part[at][order]
        known = [values[at][order] for values in facts.values()]
        rows += [(name, int(where[low]), value, to - low, _packed(own[low:to]), *[_packed_plain(x[low:to]) for x in known])
                 for low, to in cuts]
    return rows


def _unpack_facts(rows: pd.DataFrame, names: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Keys, what they leave out, and facts of rows of ``_pack_facts``, at least one."""
    parts = [*rows[["high", "size", "keys", *names]].itertuples(index=False)]
    keys = np.concatenate([_unpacked(part.keys, part.size) for part in parts])
    high = np.repeat([part.high for part in parts], [part.size for part in parts])
    return keys, high, {name: np.concatenate([_unpacked_plain(getattr(part, name), part.size) for part in parts]) for name in names}


def _packed_schema(names: tuple[str, ...]) -> str:
    return "lang string, part long, high long, size long, keys binary, " + ", ".join(f"{name} binary" for name in names)


def _sum_contexts(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
    """Trigrams, each once, with ``FACTS``: how often each stands, how many words stand behind its first two once, twice and in all,
    and at one trigram of each two how often these stand before a word."""
    context = a << 32 | b
    order = np.lexsort((c, context))
    context, c, n = context[order], c[order], n[order]
    first = np.nonzero((np.diff(context, prepend=-1) != 0) | (np.diff(c, prepend=-1) != 0))[0]
    context, c, n = context[first], c[first], np.add.reduceat(n, first)
    first = np.nonzero(np.diff(context, prepend=-1))[0]
    sizes = np.diff(first, append=len(context))
    total = np.zeros(len(n), np.int64)
    total[first] = np.add.reduceat(n, first)
    ones, twos = (np.repeat(np.add.reduceat((n == i).astype(np.int64), first), sizes) for i in (1, 2))
    facts = {"n": n, "ones": ones, "twos": twos, "kinds": np.repeat(sizes, sizes), "total": total}
    return context >> 32, context & (1 << 32) - 1, c, facts


def _sum_pairs(b: np.ndarray, c: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of trigrams, each once: how many words stand before the last two; at one trigram of each two how often these stand."""
    pair = b << 32 | c
    order = np.argsort(pair, kind="stable")
    first = np.nonzero(np.diff(pair[order], prepend=-1))[0]
    sizes = np.diff(first, append=len(pair))
    after, times = np.empty(len(pair), np.int64), np.zeros(len(pair), np.int64)
    after[order] = np.repeat(sizes, sizes)
    times[order[first]] = np.add.reduceat(n[order], first)
    return after, times


def trigrams(sample: DataFrame, known: dict[str, Words]) -> DataFrame:
    """``lang, high, k, n``: how often each trigram of ids stands in the texts of each language that has words in ``known``;
    ``after, ones, twos, kinds``: its two pairs' words; ``times, total``: how often the last and the first pair stand, at one
    trigram of each pair.

    What tasks count goes packed to the parts in which it is summed, parts of about the same text at every size: dealt by the
    first two words, then by the last two, so that no part holds more than a vocabulary's words for a key.
    """
    shared = sample.sparkSession.sparkContext.broadcast(known)
    n_parts = (sample.agg(F.sum(F.length("text"))).first()[0] or 0) // PART_CHARS | 1

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memos: dict[str, dict[str, int]] = {lang: {} for lang in shared.value}
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pd.DataFrame]:
            for name, texts in held.items():
                ids = np.concatenate(texts)
                a, b, c = ids[:-2], ids[1:-1], ids[2:]
                inside = c != START
                a, b, c = a[inside], b[inside], c[inside]
                keys, high = keys_of(a, b, c)
                rows = []
                for value, at in _alike(high):
                    k, n = np.unique(keys[at], return_counts=True)
                    first, second, _ = parts_of(k, value)
                    rows += [(*row, value) for row in _pack_counts(name, k, n, (first << 32 | second) % n_parts)]
                yield pd.DataFrame(rows, columns=counted)

        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                split = text.split()
                for name in {lang, POOLED}.intersection(memos):
                    ids = word_ids(split, shared.value[name], memos[name])
                    held.setdefault(name, []).append(ids)
                    size += len(ids)
            if size > HELD:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    def by_context(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _unpack_counts(rows)
        a, b, c, facts = _sum_contexts(*parts_of(keys, np.repeat(rows["high"].to_numpy(), rows["size"].to_numpy())), counts)
        keys, high = keys_of(a, b, c)
        return pd.DataFrame(_pack_facts(key[0], keys, high, (b << 32 | c) % n_parts, facts),
                            columns=["lang", "part", "high", "size", "keys", *FACTS])

    def by_pair(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys, high, facts = _unpack_facts(rows, FACTS)
        _, b, c = parts_of(keys, high)
        after, times = _sum_pairs(b, c, facts["n"])
        found = pd.DataFrame({"lang": key[0], "high": high, "k": keys, "after": after, "times": times, **facts})
        return found.iloc[np.lexsort((keys, high))]

    counted = [*[column.split()[0] for column in COUNTS.split(", ")], "high"]
    parts = sample.mapInPandas(grams, f"{COUNTS}, high long").groupBy("lang", "part")
    parts = parts.applyInPandas(by_context, _packed_schema(FACTS)).groupBy("lang", "part").applyInPandas(
        by_pair, "lang string, high long, k long, after long, times long, " + ", ".join(f"{name} long" for name in FACTS))
    return write_out(parts, "trigrams")


def _by_language(values: dict[str, float]) -> Column:
    """The value of each row's language."""
    return F.create_map(*[F.lit(x) for item in values.items() for x in item])[F.col("lang")]


def _arrays(table: DataFrame) -> dict[str, np.ndarray]:
    """A table of numbers on the driver."""
    found = table.toArrow()
    return {name: found[name].to_numpy() for name in found.column_names}


def fit_tables(
    docs: DataFrame, labels: DataFrame, per_language: int | None = SAMPLE, words: int | None = WORDS, idle_pool: bool = True
) -> tuple[dict[str, Model], DataFrame | None]:
    """Models without what is joined, and that as a table: ``lang, high, k`` and ``WANTED``, of every trigram, and of pairs that
    the models do not hold, once as words with a word before them and once as a context (their first id is UNKNOWN, which
    no trigram there begins with).

    Counts are taken from all trusted documents of the model's half, and every repeated word has its own. The driver collects
    and broadcasts a few figures of each word, and the pairs of the ``words`` most frequent words and shapes; other pairs and the
    trigrams grow with the text and stay a table. Without ``idle_pool`` the pool is left out if every row of ``docs`` has a
    language with a model.
    """
    prepare(docs.sparkSession)
    sample = fit_sample(docs, labels, per_language)
    known = vocabulary(sample, words, None if idle_pool else docs)
    if not known:
        return {}, None
    tri = trigrams(sample, known)
    mask, upper = (1 << BITS) - 1, (1 << HIGH_BITS) - 1
    a, b, c = (F.shiftright("k", i * BITS).bitwiseAND(mask) + F.shiftleft(F.shiftright("high", i * HIGH_BITS).bitwiseAND(upper), BITS)
               for i in (2, 1, 0))
    core, number = _by_language({lang: own.core for lang, own in known.items()}), _by_language({lang: i for i, lang in enumerate(known)}).cast("int")
    pairs, contexts = tri.where("times > 0"), tri.where((F.col("total") > 0) & (a != UNKNOWN) & (b != UNKNOWN))
    uni = pairs.groupBy("lang", c.cast("int").alias("c")).agg(F.count("*").alias("n"))
    uni = write_out(uni, "words-behind")
    ones, twos = (F.count(F.when(F.col("after") == i, 1)) for i in (1, 2))
    behind = pairs.where(b != UNKNOWN).groupBy("lang", b.cast("int").alias("b")).agg(
        F.sum("after").alias("total"), ones.alias("ones"), twos.alias("twos"), F.count("*").alias("kinds"))
    cuts1, cuts2, cuts3 = _discounts(uni, "n"), _discounts(pairs, "after"), _discounts(tri, "n")
    tables = {
        "uni": uni.select(number.alias("lang"), "c", "n"), "behind": behind.withColumn("lang", number),
        "pairs": pairs.where((b != UNKNOWN) & (b < core) & (c < core)).select(number.alias("lang"), b.alias("b"), c.alias("c"), "after"),
        "contexts": contexts.where((a < core) & (b < core)).select(
            number.alias("lang"), (F.shiftleft(a, BITS) + b).alias("k"), "total", "ones", "twos", "kinds"),
    }
    data = {name: _arrays(df) for name, df in tables.items()}

    def freed(rows: dict[str, np.ndarray], cuts: np.ndarray) -> np.ndarray:
        return rows["ones"] * cuts[0] + rows["twos"] * cuts[1] + (rows["kinds"] - rows["ones"] - rows["twos"]) * cuts[2]

    models = {}
    for i, (lang, vocab) in enumerate(known.items()):
        own = {name: {column: values[columns["lang"] == i] for column, values in columns.items()} for name, columns in data.items()}
        n = own["uni"]["n"]
        off = cuts1[lang][np.minimum(n, 3) - 1]
        first = np.full(vocab.size, off.sum() / n.sum() / vocab.size)
        first[own["uni"]["c"]] += (n - off) / n.sum()
        context2, total2 = np.ones(vocab.size), np.zeros(vocab.size, np.int64)
        rows = own["behind"]
        context2[rows["b"]], total2[rows["b"]] = freed(rows, cuts2[lang]) / rows["total"], rows["total"]
        x, y, after = own["pairs"]["b"], own["pairs"]["c"], own["pairs"]["after"]
        prob2 = (after - cuts2[lang][np.minimum(after, 3) - 1]) / total2[x] + context2[x] * first[y]
        key2, rows = x << BITS | y, own["contexts"]
        order2, order3 = np.argsort(key2), np.argsort(rows["k"])
        models[lang] = Model(
            vocab, Few(first), Few(context2), Few(total2), cuts2[lang], cuts3[lang], Pairs(key2, vocab.core), prob2[order2],
            Pairs(rows["k"], vocab.core), (freed(rows, cuts3[lang]) / rows["total"])[order3], salt=i << 56)
    zero = F.lit(0).cast("long")
    triples = tri.where((a != UNKNOWN) & (b != UNKNOWN)).select("lang", "high", "k", *WANTED)
    last = pairs.where((b != UNKNOWN) & ((b >= core) | (c >= core))).select(
        "lang", F.col("high").bitwiseAND((1 << 2 * HIGH_BITS) - 1).alias("high"), F.col("k").bitwiseAND((1 << 2 * BITS) - 1).alias("k"),
        F.col("times").alias("n"), "after", zero.alias("ones"), zero.alias("twos"), zero.alias("kinds"))
    heads = contexts.where((a >= core) | (b >= core)).select(
        "lang", F.shiftright("high", HIGH_BITS).alias("high"), F.shiftright("k", BITS).alias("k"), F.col("total").alias("n"),
        zero.alias("after"), "ones", "twos", "kinds")
    return models, triples.unionByName(last).unionByName(heads)


def with_hot(models: dict[str, Model], tri: DataFrame) -> DataFrame:
    """Gives the models the trigrams and pairs that are most frequent, ``HOT`` at most, and a filter of the others; returns these."""
    number = _by_language({lang: i for i, lang in enumerate(models)}).cast("int")
    counted: Counter = Counter()
    for row in tri.groupBy("lang", "n", (F.col("high") == 0).alias("low")).count().collect():
        models[row.lang].joined += row["count"]
        if row.low:
            counted[row.n] += row["count"]
    times, least, taken = sorted(counted.items(), reverse=True), None, 0
    for n, kinds in times:
        taken += kinds
        if taken > HOT:
            break
        least = n
    others = tri
    if least is not None:
        hot = (F.col("n") >= least) & (F.col("high") == 0)
        others = tri.where(~hot)
        rows = _arrays(tri.where(hot).select(number.alias("lang"), "k", *WANTED))
        for i, model in enumerate(models.values()):
            own = {name: values[rows["lang"] == i] for name, values in rows.items()}
            model.hot3, at = np.unique(own["k"], return_inverse=True)
            model.worth3 = np.zeros(len(model.hot3), np.int64)
            np.add.at(model.worth3, at, model.worth(own["k"], 0, own))
            model.joined -= len(at)
    rest = sum(kinds for n, kinds in times if least is None or n < least)
    bits = _filter(others.where("high = 0").select(F.col("k").bitwiseXOR(F.shiftleft(number.cast("long"), 56)).alias("k")), rest)
    for model in models.values():
        model.bits = bits
    return others


def _filter(keys: DataFrame, n: int) -> np.ndarray:
    """Bits by the hashes of so many keys, by which ``Model.may_be`` tells what may be among them."""
    size, parts = 1 << min(max((16 * n).bit_length(), 15), FILTER_BITS) - 3, 64

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, some = np.zeros(size, np.uint8), False
        for pdf in batches:
            at = xxhash64(pdf["k"].to_numpy(np.int64)) & 8 * size - 1
            np.bitwise_or.at(bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
            some = some or len(pdf) > 0
        if some:
            for part, own in enumerate(np.split(bits, parts)):
                yield pd.DataFrame([(part, _squeezed(own))], columns=["part", "bits"])

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = np.zeros(size // parts, np.uint8)
        for data in rows["bits"]:
            found |= _restored(data, len(found))
        return pd.DataFrame([(key[0], found.tobytes())], columns=["part", "bits"])

    bits = np.zeros((parts, size // parts), np.uint8)
    merged = keys.mapInPandas(mark, "part int, bits binary").groupBy("part").applyInPandas(merge, "part int, bits binary")
    with many_rows(keys.sparkSession):
        for row in merged.collect():
            bits[row.part] = np.frombuffer(row.bits, np.uint8)
    return bits.ravel()


def fit(docs: DataFrame, labels: DataFrame, per_language: int | None = SAMPLE, words: int | None = None) -> dict[str, Model]:
    """Models with all their pairs and trigrams in the driver's memory: for texts that a driver can hold."""
    models, tri = fit_tables(docs, labels, per_language, words)
    if models:
        rows = tri.toPandas()
        for lang, model in models.items():
            own = rows[rows["lang"] == lang].sort_values("k")
            keys = own["k"].to_numpy(np.int64)
            gain = model.worth(keys, 0, {name: own[name].to_numpy() for name in WANTED}) / UNIT
            model.first = model.first[:]
            model.prob3 = np.exp(gain) * model.probability(*parts_of(keys))
            model.keys3 = keys
    return models


def id_type(model: Model) -> str:
    return "<u2" if len(model.first) <= 1 << 16 else "<u4"


def coded(docs: DataFrame, models: dict[str, Model], shared: Broadcast, *carry: Column) -> DataFrame:
    """``_row, doc_id, lang, _name`` (the model's), ``n_tokens``, ``loss`` as if no trigram and no pair had been seen but those the
    model holds, ``hot`` (what its frequent ones take off), for each trigram (``asked``) and each pair (``asked2``) whether
    it may be among the others that were seen, the ids (UNKNOWN where no such one is, which makes them small), and the
    columns in ``carry``. Written out, nothing is shuffled."""
    def look_up(model: Model, found: list[tuple[int, list[str], np.ndarray]], rows: list) -> None:
        """Several texts of a model at once: what is looked up across their borders is left out."""
        ids = np.concatenate([own for _, _, own in found])
        p, pair, context = model.lower(ids[:-2], ids[1:-1], ids[2:])
        core, empty = model.words.core, np.zeros(1, np.int64)
        x, y = ids[:-1], ids[1:]
        loose = np.nonzero(((x >= core) | (y >= core)) & (x != UNKNOWN))[0]
        keys, high = keys_of(empty, x[loose], y[loose])
        hot2, held = look(model.hot3, model.worth3, keys, np.zeros(len(keys), np.int64))
        held &= high == 0
        asked2, seen2, worth2 = np.zeros(len(x), bool), np.zeros(len(x), bool), np.zeros(len(x), np.int64)
        asked2[loose] = ~held & (model.may_be(keys) | (high != 0))
        seen2[loose] = held | asked2[loose]
        worth2[loose] = np.where(held, hot2, 0)
        asked, worth = np.zeros(len(p), bool), np.zeros(len(p), np.int64)
        some = np.nonzero((pair | seen2[1:]) & (context | seen2[:-1]) & (ids[:-2] != UNKNOWN) & (ids[1:-1] != UNKNOWN))[0]
        keys, high = keys_of(ids[some], ids[some + 1], ids[some + 2])
        hot, held = look(model.hot3, model.worth3, keys, np.zeros(len(keys), np.int64))
        held &= high == 0
        asked[some], worth[some] = ~held & (model.may_be(keys) | (high != 0)), np.where(held, hot, 0)
        log, at = np.log(p), 0
        for row, words, own in found:
            part, part2 = slice(at, at + len(own) - 2), slice(at, at + len(own) - 1)
            spelt, needed = model.spelling(words, own), np.zeros(len(own), bool)
            for shift in range(3):
                needed[shift : shift + len(own) - 2] |= asked[part]
            for shift in range(2):
                needed[shift : shift + len(own) - 1] |= asked2[part2]
            own = np.where(needed, own, UNKNOWN)
            rows[row] = (len(own) - 2, spelt - float(log[part].sum()), int(worth[part].sum() + worth2[part2].sum()),
                         own.astype(id_type(model)).tobytes(), np.packbits(asked[part]).tobytes(), np.packbits(asked2[part2]).tobytes())
            at += len(own)

    @F.pandas_udf("n_tokens long, loss double, hot long, ids binary, asked binary, asked2 binary")
    def measure(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        memos: dict[str, dict[str, int]] = {}
        for langs, texts in parts:
            rows: list = [None] * len(texts)
            held: dict[str, list] = {}
            n: Counter = Counter()
            for row, (name, text) in enumerate(zip(langs.tolist(), texts.tolist(), strict=True)):
                model, words = shared.value[name], text.split()
                ids = word_ids(words, model.words, memos.setdefault(name, {}))
                held.setdefault(name, []).append((row, words, ids))
                n[name] += len(ids)
                if n[name] > AT_ONCE:
                    look_up(model, held.pop(name), rows)
                    n[name] = 0
            for name, found in held.items():
                look_up(shared.value[name], found, rows)
            yield pd.DataFrame(rows, columns=["n_tokens", "loss", "hot", "ids", "asked", "asked2"])

    name = F.when(F.col("lang").isin([m for m in models if m != POOLED]), F.col("lang")).otherwise(F.lit(POOLED))
    none = F.lit(None).cast("struct<n_tokens: bigint, loss: double, hot: bigint, ids: binary, asked: binary, asked2: binary>")
    measured = measure(name, text_of()) if models else none
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang"), name.alias("_name"), *carry, measured.alias("_m"))
    return numbered(rows.select("*", "_m.*").drop("_m"), "coded")


def gains(rows: DataFrame, shared: Broadcast, tri: DataFrame) -> DataFrame:
    """``_row, gain``: what the trigrams and pairs that were seen take off the loss, in 1/UNIT; rows without any are missing.

    A join of the trigrams and pairs of all texts with their counts: both sides are dealt to shards of a language by trigram, and a
    text meets a shard's counts in one cogroup. Both sides are packed, many texts or counts to a row, as the texts' is many
    times the input otherwise; so are the answers, whose sums are taken pack by pack. Sums are of whole numbers, so their order changes
    nothing.
    """
    spark = rows.sparkSession
    shards = {lang: -(-model.joined // SHARD_ROWS) | 1 for lang, model in shared.value.items() if model.joined}
    if not shards:
        return spark.createDataFrame([], f"{ROW} long, gain long")
    dealt = spark.sparkContext.broadcast(shards)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush() -> Iterator[pd.DataFrame]:
            places = np.array(held, np.int64)
            out = []
            for name, parts in keys.items():
                every, high, at = (np.concatenate(x) for x in zip(*parts, strict=True))
                for value, own in _alike(high):
                    k, places_of = every[own], at[own]
                    order, cuts = _by_part(k, k % dealt.value[name])
                    k, places_of = k[order], places_of[order]
                    for low, to in cuts:
                        texts, inside = np.unique(places_of[low:to], return_inverse=True)
                        out.append((name, int(k[low] % dealt.value[name]), value, held[0], to - low, _packed(k[low:to] // dealt.value[name]),
                                    _packed_small(inside), len(texts), _packed(places[texts])))
            yield pd.DataFrame(out, columns=["lang", "part", "high", "pack", "n", "keys", "texts", "n_rows", "rows"])

        held: list[int] = []
        keys: dict[str, list] = {}
        n = 0
        for pdf in batches:
            for row, name, ids, asked, asked2 in zip(pdf[ROW], pdf["_name"], pdf["ids"], pdf["asked"], pdf["asked2"], strict=True):
                if name not in dealt.value:
                    continue
                ids = np.frombuffer(ids, id_type(shared.value[name])).astype(np.int64)
                asked, asked2 = (np.nonzero(np.unpackbits(np.frombuffer(bits, np.uint8), count=len(ids) - i))[0]
                                 for bits, i in ((asked, 2), (asked2, 1)))
                if len(asked) or len(asked2):
                    a, b = np.append(ids[asked], np.zeros(len(asked2), np.int64)), np.append(ids[asked + 1], ids[asked2])
                    found, high = keys_of(a, b, np.append(ids[asked + 2], ids[asked2 + 1]))
                    keys.setdefault(name, []).append((found, high, np.full(len(found), len(held), np.int64)))
                    held.append(row)
                    n += len(found)
                if n > HELD or len(held) == HELD_ROWS:
                    yield from flush()
                    held, keys, n = [], {}, 0
        if held:
            yield from flush()

    asked = rows.select(ROW, "_name", "ids", "asked", "asked2").mapInPandas(
        ask, "lang string, part long, high long, pack long, n long, keys binary, texts binary, n_rows long, rows binary")

    def counts_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush() -> Iterator[pd.DataFrame]:
            out = []
            for name, rows in pd.concat(held).groupby("lang"):
                k, high = rows["k"].to_numpy(np.int64), rows["high"].to_numpy(np.int64)
                out += _pack_facts(name, k, high, k % dealt.value[name], {x: rows[x].to_numpy(np.int64) for x in WANTED})
            yield pd.DataFrame(out, columns=["lang", "part", "high", "size", "keys", *WANTED])

        held: list[pd.DataFrame] = []
        size = 0
        for pdf in batches:
            held.append(pdf)
            size += len(pdf)
            if size > HELD:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    table = tri.select("lang", "high", "k", *WANTED).mapInPandas(counts_of, _packed_schema(WANTED))

    def answer(key: tuple, asked: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asked) and len(table):
            name, shard, high = key
            keys, _, facts = _unpack_facts(table, WANTED)
            keys, at = np.unique(keys, return_inverse=True)
            every, worth = shared.value[name].worth(keys[at], int(high), facts), np.zeros(len(keys), np.int64)
            np.add.at(worth, at, every)
            for pack, n, k, texts, n_rows, places in asked[["pack", "n", "keys", "texts", "n_rows", "rows"]].itertuples(index=False):
                k = _unpacked(k, n) * dealt.value[name] + shard
                at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                sums = np.zeros(n_rows, np.int64)
                np.add.at(sums, _unpacked_small(texts, n), np.where(keys[at] == k, worth[at], 0))
                some = sums != 0
                if some.any():
                    found.append((pack, int(some.sum()), _packed(_unpacked(places, n_rows)[some]), _packed(sums[some])))
        return pd.DataFrame(found, columns=["pack", "n", "rows", "gains"])

    def total(answers: pd.DataFrame) -> pd.DataFrame:
        parts = [*answers[["n", "rows", "gains"]].itertuples(index=False)]
        places, at = np.unique(np.concatenate([_unpacked(part.rows, part.n) for part in parts]), return_inverse=True)
        sums = np.zeros(len(places), np.int64)
        np.add.at(sums, at, np.concatenate([_unpacked(part.gains, part.n) for part in parts]))
        return pd.DataFrame({ROW: places, "gain": sums})

    by = ("lang", "part", "high")
    answers = asked.groupBy(*by).cogroup(table.groupBy(*by)).applyInPandas(answer, "pack long, n long, rows binary, gains binary")
    return answers.groupBy("pack").applyInPandas(total, f"{ROW} long, gain long")


def scored(docs: DataFrame, models: dict[str, Model], tri: DataFrame | None, *carry: Column) -> tuple[DataFrame, DataFrame]:
    """``_row, doc_id, lang, _name, n_tokens, loss`` of every row, written out; and the columns in ``carry`` by ``_row``."""
    others = with_hot(models, tri) if models else None
    shared = docs.sparkSession.sparkContext.broadcast(models)
    rows = coded(docs, models, shared, *carry)
    narrow = rows.select(ROW, "doc_id", "lang", "_name", "n_tokens", "loss", "hot")
    if models:
        off = (F.col("hot") + F.coalesce(F.col("gain"), F.lit(0))) / F.lit(float(UNIT))
        narrow = narrow.join(gains(rows, shared, others), ROW, "left").withColumn("loss", F.col("loss") - off).drop("gain")
    carried = [c for c in rows.columns if c not in (*narrow.columns, "ids", "asked", "asked2")]
    narrow = narrow.drop("hot")
    with many_rows(docs.sparkSession):
        return write_out(narrow, "losses"), rows.select(ROW, *carried)


def _judged(
    docs: DataFrame, labels: DataFrame, *carry: Column, per_language: int | None = SAMPLE, words: int | None = WORDS
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``classify`` by ``_row``, without what is carried, and that by ``_row``."""
    models, tri = fit_tables(docs, labels, per_language, words, idle_pool=False)
    rows, carried = scored(docs, models, tri, *carry)
    unseen = rows.select("doc_id", "_name", "n_tokens", "loss").join(
        trusted_rows(labels).where("NOT fit").select("doc_id"), "doc_id"
    )
    unseen = write_out(unseen.where("loss IS NOT NULL"), "unseen")
    score = F.exp((F.col("loss") + PRIOR * F.col("_mean")) / (F.col("n_tokens") + PRIOR))
    mean, count = F.sum("loss") / F.sum("n_tokens"), F.count("*")
    # One row for each language of the model and one for all: bounded by the sample.
    means = unseen.groupBy("_name").agg(mean.alias("_mean"), count.alias("_n")).where(F.col("_n") >= LEAST_TRUSTED)
    overall = unseen.agg(mean).first()[0]

    def with_mean(df: DataFrame) -> DataFrame:
        joined = df.join(F.broadcast(means.select("_name", "_mean")), "_name", "left")
        return joined.withColumn("_mean", F.coalesce("_mean", F.lit(overall).cast("double"))).withColumn("score", score)

    known = with_mean(unseen)
    cut = F.percentile_approx("score", F.lit(QUANTILE), F.lit(10_000)) * SLACK
    own = known.groupBy("_name").agg(cut.alias("_own"), count.alias("_n")).where(F.col("_n") >= LEAST_TRUSTED)
    limits = with_mean(rows).join(F.broadcast(own.select("_name", "_own")), "_name", "left")
    threshold = F.coalesce("_own", F.lit(known.agg(cut).first()[0]).cast("double"))
    return limits.select(
        ROW, "doc_id", "lang", "n_tokens", F.exp(F.col("loss") / F.col("n_tokens")).alias("perplexity"), "score",
        threshold.alias("threshold"), F.coalesce(F.col("score") <= threshold, F.lit(True)).alias("keep"),
    ), carried


def classify(
    docs: DataFrame, labels: DataFrame, *carry: Column, per_language: int | None = SAMPLE, words: int | None = WORDS
) -> DataFrame:
    """``doc_id, lang, n_tokens, perplexity, score, threshold, keep`` for every row, and the columns in ``carry``.

    The model is fitted on all trusted rows of one half; means and thresholds come from all of the other half. A language with fewer than 20 of those takes the threshold of all. Without any
    trusted rows there is no model, and every document is kept with NULL perplexity. NULL and empty texts are scored
    as texts without words, their end alone. A score that equals its threshold is kept. Repeated rows each give their
    row; a document that is trusted and repeated counts as often in means and thresholds. A very long text is one row.
    Other columns are not read, those in ``carry`` come back as they are. Empty documents: empty result.
    """
    rows, carried = _judged(docs, labels, *carry, per_language=per_language, words=words)
    more = [c for c in carried.columns if c != ROW]
    if carry:
        rows = rows.join(carried.hint(SHUFFLE), ROW)
    return rows.select("doc_id", "lang", *more, "n_tokens", "perplexity", "score", "threshold", "keep")


def kept(docs: DataFrame, labels: DataFrame, *carry: Column) -> DataFrame:
    """The columns in ``carry`` of the rows that ``classify`` keeps. What may have been dropped is looked up by a join, all other
    rows stay where they are: texts are not shuffled to be kept."""
    rows, carried = _judged(docs, labels, *carry)
    dropped = write_out(rows.where("NOT keep").select(ROW), "dropped")
    return without_rows(carried, dropped).drop(ROW)
