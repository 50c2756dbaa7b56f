"""Katz backoff language model: word and bigram counts of all training text, scores of all text.

Words are 64-bit digests. A batch of documents is kept as word places into the batch's own words, so counts can be asked
for and given back as arrays, one for each batch and shard, instead of a row for each token. Both orders of the model
are tables partitioned in this way: word shards hold the counts of words, pair shards those of bigrams, and every word
and bigram of the training text has its own entry. A token's probability is its discounted bigram where that was seen,
else the context's backoff weight times the discounted word, else the weight times what is left for unseen words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamegrain.llm.common import prepare, text_of, write_out

# Text of a batch; a longer document is a batch of its own. A batch becomes a few binary cells of some megabytes.
BATCH_CHARS = 16_000_000
# Distinct words of all batches that a word shard handles, and tokens for each pair shard.
WORDS_PER_SHARD = 400_000
TOKENS_PER_SHARD = 2_000_000
# Contexts with at least this share of the training tokens are hot: their bigrams are spread over all pair shards and
# their sums added up afterwards. There are at most 1 / SHARE of them (and the start and end), whatever the corpus.
SHARE = 1 / 50_000
# Counts above this are trusted as they are (Good-Turing discounts the others).
TRUSTED = 5

END, START = 0, 1  # digests of the end of a text, and of the context before its first word

BATCHES = "batch long, tokens long, trained long, distinct long, data binary"
BATCH_COLUMNS = ["batch", "tokens", "trained", "distinct", "data"]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value, byte planes apart; ``unpack`` needs their types."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]
    lengths = np.array([len(a) for a in arrays], np.int64)
    return zstandard.compress(b"".join([lengths.tobytes(), *planes]), 3)


def unpack(value: bytes, *types: type) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(value), np.uint8)
    out, at = [], 8 * len(types)
    for n, kind in zip(raw[:at].view(np.int64).tolist(), types):
        size = np.dtype(kind).itemsize
        planes = raw[at : at + n * size].reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * size
    return out


def word_digest(word: bytes) -> int:
    return max(xxhash.xxh3_64_intdigest(word), START + 1)


def encode_batches(docs: DataFrame, held_out: Column) -> DataFrame:
    """Documents as batches of arrays (``BATCHES``); words are ``[^ \\t-\\r]+`` after lower-casing A-Z, then one end."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[bytes, int] = {}
        ids: list[int] = []
        has: list[bool] = []
        out: list[bool] = []
        ends: list[int] = []
        tokens: list[np.ndarray] = []
        chars = n = 0
        part = None

        def batch() -> pd.DataFrame:
            words, places, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
            # Frequent words first: small places compress well.
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            lengths = np.diff(ends, prepend=0)
            cells = (np.array(ids, np.int64), np.array(has), np.array(out), lengths, rank[places], words[order])
            trained = int(lengths[~cells[2]].sum())
            return pd.DataFrame([(part, n, trained, len(words), pack(*cells))], columns=BATCH_COLUMNS)

        for pdf in parts:
            columns = (pdf[name] for name in ("doc_id", "has_id", "held", "text", "row"))
            for doc_id, known, held, text, row in zip(*columns, strict=True):
                if part is None:
                    part = row
                words = text.encode().lower().split()
                missing = [w for w in set(words) if w not in memo]
                if len(memo) + len(missing) > 400_000:
                    memo.clear()
                    missing = set(words)
                for word in missing:
                    memo[word] = word_digest(word)
                tokens.append(np.array([*map(memo.__getitem__, words), END], np.uint64))
                n += len(words) + 1
                ids.append(doc_id)
                has.append(known)
                out.append(held)
                ends.append(n)
                chars += len(text)
                if chars >= BATCH_CHARS:
                    yield batch()
                    ids, has, out, ends, tokens, chars, n, part = [], [], [], [], [], 0, 0, None
        if ids:
            yield batch()

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("has_id"),
        F.coalesce(held_out, F.lit(False)).alias("held"), text_of().alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.mapInPandas(run, BATCHES)


@dataclass
class Batch:
    """A batch of documents taken apart: ``places`` of its tokens in ``words``, the documents' ``ends`` in it."""

    ids: np.ndarray
    has: np.ndarray
    held: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    places: np.ndarray
    words: np.ndarray

    @classmethod
    def of(cls, data: bytes) -> Batch:
        ids, has, held, lengths, places, words = unpack(data, np.int64, bool, bool, np.int64, np.uint32, np.uint64)
        ends = np.cumsum(lengths)
        return cls(ids, has, held, ends - lengths, ends, places.astype(np.int64), words)

    def training(self) -> np.ndarray:
        """Whether each token is of the training text."""
        return ~np.repeat(self.held, self.ends - self.starts)


def ask_counts(batches: DataFrame, shards: int) -> DataFrame:
    """Training counts of each batch's words, one row for each shard; shards are ranges of the digest."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        edges = np.array([(i << 64) // shards for i in range(1, shards)], np.uint64)
        for pdf in parts:
            for row in pdf.itertuples():
                b = Batch.of(row.data)
                order = np.argsort(b.words)
                words = b.words[order]
                counts = np.bincount(b.places[b.training()], minlength=len(words))[order].astype(np.uint32)
                cuts = [0, *np.searchsorted(words, edges).tolist(), len(words)]
                yield pd.DataFrame([
                    (row.batch, shard, pack(words[i:j], counts[i:j]))
                    for shard, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i
                ], columns=["batch", "shard", "data"])

    return batches.mapInPandas(run, "batch long, shard int, data binary")


ANSWER = "kind string, batch long, shard int, data binary, value long, n long"


def answer_counts(asked: DataFrame, tokens: int) -> DataFrame:
    """Word shards: sums over the batches. Gives back the sums in the order asked (``batch``), the number of words by
    count (``size``), and the words that are frequent (``frequent``)."""
    bound = tokens * SHARE

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        words, asked = zip(*(unpack(value, np.uint64, np.uint32) for value in pdf["data"]), strict=True)
        counts = np.concatenate(asked)
        distinct, at = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)
        rows, start = [], 0
        for batch, own in zip(pdf["batch"], words):
            rows.append(("batch", batch, shard, pack(total[at[start : start + len(own)]]), 0, 0))
            start += len(own)
        low = np.minimum(total, TRUSTED + 2)
        rows += [("size", 0, shard, None, r, int(n)) for r, n in enumerate(np.bincount(low)) if r and n]
        often = np.nonzero((total >= bound) | (distinct == END))[0]
        rows += [("frequent", 0, shard, None, int(distinct[i].astype(np.int64)), int(total[i])) for i in often]
        return pd.DataFrame(rows, columns=["kind", "batch", "shard", "data", "value", "n"])

    return asked.groupBy("shard").applyInPandas(run, ANSWER)


def good_turing(sizes: np.ndarray) -> np.ndarray:
    """Discounts by count (1 above TRUSTED) from ``sizes[r]``, the number of types seen r times.

    Where the counts of counts are too few or not falling, the absolute discount n1 / (n1 + 2 n2) is used; it always
    leaves something for the unseen.
    """
    k = TRUSTED
    out = np.ones(k + 1)
    n1, n2 = sizes[1], sizes[2]
    absolute = n1 / (n1 + 2 * n2) if n1 else 0.5
    rest = (k + 1) * sizes[k + 1] / n1 if n1 else 1.0
    for r in range(1, k + 1):
        ratio = (r + 1) * sizes[r + 1] / (r * sizes[r]) if sizes[r] else 1.0
        d = (ratio - rest) / (1 - rest) if rest < 1 else 0.0
        out[r] = d if 0 < d < 1 else 1 - min(absolute, 0.9) / r
    return out


def discounted(counts: np.ndarray, discounts: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= TRUSTED, discounts[np.minimum(counts, TRUSTED)], 1.0)


@dataclass
class Katz:
    """What every task needs of the model; all bounded. ``hot`` are the digests of hot contexts, sorted, with the words'
    own ``counts``; ``sums`` are the contexts' figures (``context_sums``)."""

    hot: np.ndarray
    counts: np.ndarray
    tokens: int
    types: int
    discounts: np.ndarray
    unseen: float  # probability of all unseen words together
    mass: float  # what the discounts leave to the seen words
    pair_discounts: np.ndarray
    sums: np.ndarray

    @classmethod
    def empty(cls) -> Katz:
        ones = np.ones(TRUSTED + 1)
        return cls(np.array([START], np.uint64), np.zeros(1, np.int64), 0, 0, ones, 1.0, 1.0, ones, np.zeros((1, SUMS)))

    def code_of(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the hot contexts, and whether each is one."""
        at = np.minimum(np.searchsorted(self.hot, digests), len(self.hot) - 1)
        return at, self.hot[at] == digests

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """P(word) from its count; words that were never seen count as one type."""
        seen = discounted(counts, self.discounts) / max(self.tokens, 1)
        return np.where(counts > 0, seen * (1 - self.unseen) / self.mass, self.unseen)

    def backoff(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each context: the factor on its discounted shares (1 but where nothing is left for the unseen), and the
        weight of the lower order that makes all its probabilities sum to exactly one."""
        total, by_count, lower = sums[:, 0], sums[:, 1 : TRUSTED + 1], sums[:, TRUSTED + 1]
        taken = by_count @ (np.arange(1, TRUSTED + 1) * (1 - self.pair_discounts[1:]))
        # A context whose counts are all above the trusted ones: it gives 1 / (n + 1) to what it has not seen.
        none = (total > 0) & (taken < 1e-9 * total)
        factor = np.where(none, total / (total + 1), 1.0)
        left = np.where(none, 1 / (total + 1), taken / np.maximum(total, 1))
        weight = left / np.maximum(1 - lower, self.unseen)
        return factor, np.where(total > 0, weight, 1.0)


# Figures of a context: training bigrams; types seen 1, 2, ... TRUSTED times; lower-order probability of all types seen.
SUMS = TRUSTED + 2


def context_sums(context: np.ndarray, counts: np.ndarray, lower: np.ndarray, contexts: int) -> np.ndarray:
    """``SUMS`` figures for each context from its distinct bigrams."""
    figures = [counts, *(counts == r for r in range(1, TRUSTED + 1)), lower * (counts > 0)]
    return np.stack([np.bincount(context, weights=f, minlength=contexts) for f in figures], axis=1)


def fit_words(answers: DataFrame, tokens: int) -> Katz:
    """The lower order from the word shards' answers; the bounded part of them comes to the driver."""
    sizes = np.zeros(TRUSTED + 3)
    for row in answers.where("kind = 'size'").groupBy("value").agg(F.sum("n").alias("n")).collect():
        sizes[row.value] = row.n
    frequent = answers.where("kind = 'frequent'").select("value", "n").collect()
    hot = np.array([row.value for row in frequent] + [START], np.int64).astype(np.uint64)
    order = np.argsort(hot)
    discounts = good_turing(sizes)
    # What the discounts take from the seen words is the probability of an unseen one.
    taken = sum(sizes[r] * r * (1 - discounts[r]) for r in range(1, TRUSTED + 1)) / tokens
    return Katz(
        hot[order], np.array([row.n for row in frequent] + [0], np.int64)[order], tokens, int(sizes.sum()), discounts,
        max(taken, 0.5 / (tokens + 1)), 1 - taken, np.ones(TRUSTED + 1), np.zeros((len(hot), SUMS)),
    )


def word_counts(batch: Batch, counted: pd.DataFrame) -> np.ndarray:
    """The word shards' counts of a batch's words."""
    counts = np.empty(len(batch.words), np.int64)
    answers = counted[counted["kind"] == "batch"].sort_values("shard")["data"]
    counts[np.argsort(batch.words)] = np.concatenate([unpack(value, np.int64)[0] for value in answers])
    return counts


@dataclass
class Pairs:
    """Distinct bigrams of a batch, those of a shard together: places of both words (a context after the last word is
    the start), where each shard's begin, and for each token its bigram."""

    context: np.ndarray
    next: np.ndarray
    shard: np.ndarray
    edges: np.ndarray
    at: np.ndarray
    code: np.ndarray
    is_hot: np.ndarray

    @classmethod
    def of(cls, batch: Batch, model: Katz, shards: int) -> Pairs:
        width = len(batch.words) + 1
        before = np.concatenate([[width - 1], batch.places[:-1]])
        before[batch.starts] = width - 1
        keys, at = np.unique(before * width + batch.places, return_inverse=True)
        context, following = keys // width, keys % width
        digests = np.append(batch.words, np.uint64(START))
        code, is_hot = model.code_of(digests)
        spread = digests[context] * np.uint64(0x9E3779B97F4A7C15)
        spread = np.where(is_hot[context], spread + digests[following] * np.uint64(0xC2B2AE3D27D4EB4F), spread)
        shard = ((spread >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        shard = shard[order].astype(np.int64)
        edges = np.concatenate([[0], np.nonzero(np.diff(shard))[0] + 1, [len(shard)]])
        return cls(context[order], following[order], shard, edges, place[at], code, is_hot)

    def pieces(self) -> Iterator[tuple[int, slice]]:
        for i, j in zip(self.edges[:-1].tolist(), self.edges[1:].tolist()):
            yield int(self.shard[i]), slice(i, j)


def ask_pairs(batches: DataFrame, given: DataFrame, model: Katz, shards: int) -> DataFrame:
    """Each batch's distinct bigrams with their training counts, one row for each pair shard: ``batch, shard, data``.

    Hot words go by their code; any other by its digest and its count, once a row.
    """
    shared = batches.sparkSession.sparkContext.broadcast(model)

    def run(own: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        m, batch = shared.value, Batch.of(own["data"].iloc[0])
        counts = word_counts(batch, counted)
        digests, counts = np.append(batch.words, np.uint64(START)), np.append(counts, 0)
        pairs = Pairs.of(batch, m, shards)
        trained = np.bincount(pairs.at[batch.training()], minlength=len(pairs.context)).astype(np.uint32)
        rows = []
        for shard, piece in pairs.pieces():
            used, at = np.unique(np.concatenate([pairs.context[piece], pairs.next[piece]]), return_inverse=True)
            context, following = np.split(at.astype(np.uint32), 2)
            is_hot = pairs.is_hot[used]
            rows.append((own["batch"].iloc[0], shard, pack(
                is_hot, pairs.code[used[is_hot]].astype(np.uint32), digests[used[~is_hot]], counts[used[~is_hot]],
                np.diff(context, prepend=np.uint32(0)), following, trained[piece],
            )))
        return pd.DataFrame(rows, columns=["batch", "shard", "data"])

    joined = batches.groupBy("batch").cogroup(given.groupBy("batch"))
    return joined.applyInPandas(run, "batch long, shard int, data binary")


PAIR_ANSWER = "kind string, batch long, shard int, data binary"


def answer_pairs(asked: DataFrame, model: Katz) -> DataFrame:
    """Pair shards: sums over the batches. Gives back (``pair``) the counts in the order asked and the figures of the
    contexts that are not hot, and of the whole shard the types by count and its part of the hot contexts' figures
    (``shard``)."""
    shared = asked.sparkSession.sparkContext.broadcast(model)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m, shard = shared.value, int(pdf["shard"].iloc[0])
        digests, seen, contexts, nexts, trained, start = [], [], [], [], [], 0
        for value in pdf["data"]:
            is_hot, code, rare, count, context, following, n = unpack(
                value, bool, np.uint32, np.uint64, np.int64, np.uint32, np.uint32, np.uint32
            )
            own, known = np.empty(len(is_hot), np.uint64), np.empty(len(is_hot), np.int64)
            own[is_hot], own[~is_hot] = m.hot[code], rare
            known[is_hot], known[~is_hot] = m.counts[code], count
            digests.append(own)
            seen.append(known)
            contexts.append(np.cumsum(context, dtype=np.int64) + start)
            nexts.append(following.astype(np.int64) + start)
            trained.append(n)
            start += len(own)
        words, place = np.unique(np.concatenate(digests), return_inverse=True)
        lower = np.empty(len(words))
        lower[place] = m.unigram(np.concatenate(seen))
        context = place[np.concatenate(contexts)]
        keys, at = np.unique(context * len(words) + place[np.concatenate(nexts)], return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate(trained), minlength=len(keys)).astype(np.int64)
        sums = context_sums(keys // len(words), counts, lower[keys % len(words)], len(words))
        code, is_hot = m.code_of(words)
        rows, start = [], 0
        for batch, asked_here in zip(pdf["batch"], nexts, strict=True):
            mine = slice(start, start + len(asked_here))
            start = mine.stop
            # Contexts come in the order of their places in the batch, so runs of one are together.
            runs = context[mine]
            runs = runs[np.concatenate([[True], runs[1:] != runs[:-1]])]
            rows.append(("pair", batch, shard, pack(counts[at[mine]], sums[runs[~is_hot[runs]]].reshape(-1))))
        found = is_hot & (sums[:, 0] > 0)
        sizes = np.bincount(np.minimum(counts[counts > 0], TRUSTED + 2), minlength=TRUSTED + 3)
        rows.append(("shard", 0, shard, pack(sizes, code[found].astype(np.int64), sums[found].reshape(-1))))
        return pd.DataFrame(rows, columns=["kind", "batch", "shard", "data"])

    return asked.groupBy("shard").applyInPandas(run, PAIR_ANSWER)


def fit_pairs(pairs: DataFrame, model: Katz) -> Katz:
    """The model with the discounts of bigrams and the figures of the hot contexts, summed over the shards by Spark."""
    names = [f"f{i}" for i in range(SUMS)]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for value in pdf["data"]:
                sizes, codes, figures = unpack(value, np.int64, np.int64, np.float64)
                by_count = np.zeros((len(sizes), SUMS))
                by_count[:, 0] = sizes
                table = pd.DataFrame(np.concatenate([by_count, figures.reshape(-1, SUMS)]), columns=names)
                # Below zero: the number of types with the count -1 - code.
                table.insert(0, "code", np.concatenate([-1 - np.arange(len(sizes)), codes]))
                yield table

    schema = ", ".join(["code long", *(f"{name} double" for name in names)])
    parts = pairs.where("kind = 'shard'").select("data").mapInPandas(run, schema)
    table = parts.groupBy("code").agg(*(F.sum(name).alias(name) for name in names)).toPandas()
    code, figures = table["code"].to_numpy(np.int64), table[names].to_numpy(np.float64)
    sizes, sums = np.zeros(TRUSTED + 3), np.zeros((len(model.hot), SUMS))
    sizes[-1 - code[code < 0]] = figures[code < 0, 0]
    sums[code[code >= 0]] = figures[code >= 0]
    return replace(model, pair_discounts=good_turing(sizes), sums=sums)


def pair_scores(batch: Batch, counts: np.ndarray, model: Katz, shards: int, replies: pd.DataFrame) -> np.ndarray:
    """log10 P(word | word before) of each token."""
    pairs = Pairs.of(batch, model, shards)
    total, sums = np.empty(len(pairs.context), np.int64), np.zeros((len(counts) + 1, SUMS))
    sums[pairs.is_hot] = model.sums[pairs.code[pairs.is_hot]]
    for (_, piece), value in zip(pairs.pieces(), replies.sort_values("shard")["data"], strict=True):
        total[piece], figures = unpack(value, np.int64, np.float64)
        contexts = np.unique(pairs.context[piece])
        sums[contexts[~pairs.is_hot[contexts]]] = figures.reshape(-1, SUMS)
    factor, weight = model.backoff(sums)
    of, lower = pairs.context, model.unigram(counts)[pairs.next]
    share = factor[of] * discounted(total, model.pair_discounts) / np.maximum(sums[of, 0], 1)
    return np.log10(np.where(total > 0, share, weight[of] * lower))[pairs.at]


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score_batches(batches: DataFrame, answers: DataFrame, model: Katz, shards: int) -> DataFrame:
    """Each batch meets the counts of its words and bigrams, one array for each shard, and scores its documents.

    No shards: nothing was learned, and the scores are zero.
    """
    shared = batches.sparkSession.sparkContext.broadcast(model)

    def run(own: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        m, batch = shared.value, Batch.of(own["data"].iloc[0])
        counts = word_counts(batch, counted)
        base = np.log10((counts + 0.5) / (m.tokens + 0.5 * (m.types + 1)))
        logp = np.zeros(len(batch.places))
        if shards:
            logp = pair_scores(batch, counts, m, shards, counted[counted["kind"] == "pair"])
        ids = pd.array(batch.ids, "Int64")
        ids[~batch.has] = pd.NA
        return pd.DataFrame({
            "doc_id": ids, "held_out": batch.held, "n_tokens": batch.ends - batch.starts,
            "n_known": np.add.reduceat((counts[batch.places] > 0).astype(np.int64), batch.starts),
            "train_tokens": m.tokens, "base_score": np.add.reduceat(base[batch.places], batch.starts),
            "score": np.add.reduceat(logp, batch.starts),
        })

    return batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(run, SCORES)


def katz_scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Rows where ``held_out`` does not hold are the training text. NULL and empty texts are the end alone. Repeated rows
    count as often as they come. No rows: no result. No training rows: every word is unseen, and ``score`` is
    ``base_score``. Other columns are not read. A very long text is one row of its batch, and its words count one by one.
    """
    spark = prepare(docs.sparkSession)
    batches = write_out(encode_batches(docs, held_out), "batches")
    names = ("tokens", "trained", "distinct")
    size = batches.agg(*(F.sum(name).alias(name) for name in names)).first()
    if not size["tokens"]:
        return spark.createDataFrame([], SCORES)
    asked = ask_counts(batches, -(-size["distinct"] // WORDS_PER_SHARD))
    answers = write_out(answer_counts(asked, size["trained"]), "words")
    given = answers.where("kind = 'batch'").select("kind", "batch", "shard", "data")
    if not size["trained"]:
        return score_batches(batches, given, Katz.empty(), 0).withColumn("score", F.col("base_score"))
    model = fit_words(answers, size["trained"])
    shards = -(-size["tokens"] // TOKENS_PER_SHARD)
    pairs = write_out(answer_pairs(ask_pairs(batches, given, model, shards), model), "pairs")
    replies = pairs.where("kind = 'pair'").select("kind", "batch", "shard", "data")
    return score_batches(batches, given.unionByName(replies), fit_pairs(pairs, model), shards)


def score_documents(docs: DataFrame) -> DataFrame:
    """Every fifth document by the checksum of its id is held out."""
    return katz_scores(docs, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1)
