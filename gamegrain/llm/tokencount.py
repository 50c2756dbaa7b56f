"""Token counts under a unigram model, computed once per shared prefix in a trie of pre-tokens."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamegrain.llm.common import prepare, text_of

BOUNDARY = "▁"
# Nodes of a trie; a fuller one is given up and grown anew, so memory is bounded whatever the vocabulary.
NODES = 1_500_000
# Probability of a byte outside the pieces.
BYTE_LOGP = math.log(1e-4 / 256)


def piece_scores(path: str) -> dict[str, float]:
    """Log probability of each piece of a public vocabulary: by Zipf's law over its published order.

    The file holds merge ranks and no probabilities; nothing is trained here.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    whole = math.log(sum(1 / (place + 2) for place in range(len(plain))))
    return {model.id_to_piece(i): -math.log(place + 2) - whole for place, i in enumerate(plain)}


class UnigramTrie:
    """Pre-tokens by prefix. A node holds the forward score of its prefix (log probability of the best segmentation)
    and the number of tokens in it (the fewest among equal scores)."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.forward, self.tokens = [0.0], [0]
        self.count: dict[str, int] = {}
        self.logp: dict[str, float] = {}

    def insert(self, word: str) -> None:
        """Walks the shared prefix, and computes one node for each further character."""
        text, child, forward, tokens = BOUNDARY + word, self.child, self.forward, self.tokens
        path, node = [0], 0
        for at, char in enumerate(text):
            below = child.get((node, char))
            if below is None:
                size = len(char.encode("utf-8", "surrogatepass"))
                best, n = forward[node] + size * BYTE_LOGP, tokens[node] + size
                for start in range(max(0, at + 1 - self.longest), at + 1):
                    logp = self.scores.get(text[start : at + 1])
                    if logp is not None:
                        before = path[start]
                        score = forward[before] + logp
                        if score > best or score == best and tokens[before] + 1 < n:
                            best, n = score, tokens[before] + 1
                below = child[node, char] = len(forward)
                forward.append(best)
                tokens.append(n)
            path.append(below)
            node = below
        self.count[word], self.logp[word] = tokens[node], forward[node]

    def learn(self, words: set[str]) -> None:
        """Makes sure that the trie ends each of the words."""
        missing = words.difference(self.count)
        if len(self.forward) + 8 * len(missing) > NODES:
            self.clear()
            missing = words
        for word in sorted(missing):
            self.insert(word)


@lru_cache(maxsize=1)
def grown(path: str) -> UnigramTrie:
    """One trie for each Python worker."""
    return UnigramTrie(piece_scores(path))


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_words, n_tokens, score`` for every row; nothing is shuffled.

    Pre-tokens are the stretches between white space, each with a boundary mark before it. NULL and empty texts have
    no tokens and the score 0. Of segmentations with equal scores the one with fewest tokens counts. Repeated rows each
    give their row; an empty table gives an empty result; other columns are not read. A very long text is one row, and a
    very long word has a path of its own in the trie, which is grown anew when it is full.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = grown(path)
        for pdf in batches:
            split = [text.split() for text in pdf["text"]]
            trie.learn(set().union(*split))
            count, logp = trie.count.__getitem__, trie.logp.__getitem__
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].astype("Int64"), "n_words": [len(words) for words in split],
                "n_tokens": [sum(map(count, words)) for words in split],
                "score": [math.fsum(map(logp, words)) for words in split],
            })

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return narrow.mapInPandas(run, "doc_id long, n_words long, n_tokens long, score double")
