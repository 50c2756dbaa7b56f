"""Periodic runs of words, caught online by blocks of dyadic length."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamegrain.llm.common import prepare

EXPONENT, LENGTH = 3, 24  # a run has this many periods and words at least
APPENDED = 1 << 16  # words of a document that are appended at once

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MORE = np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(29)

RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
    "collapsed_sha256 string"
)


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Digest of two neighbouring windows from the digests of both."""
    x = (left ^ (left >> _SHIFT)) * _ODD + right
    return (x ^ (x >> _SHIFT)) * _MORE


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common start of two arrays of one length; looks at twice as much each time."""
    at, step, n = 0, 64, len(a)
    while at < n:
        differ = a[at : at + step] != b[at : at + step]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at, step = at + step, 2 * step
    return n


def stretch(period, exponent: int, length: int):
    """Words that agree with those a period further on, in the shortest run of the period."""
    return np.maximum(length, exponent * period) - period


@lru_cache(maxsize=1 << 10)
def served(block: int, exponent: int, length: int) -> tuple[int, int]:
    """Smallest and largest period whose catchers have this block length; none: the first is larger.

    It is half the longest aligned block that a stretch surely holds, so the stretch holds three, or blocks of 1.
    """
    periods = np.arange(1, 8 * block // (exponent - 1) + 1)
    longest = np.log2((stretch(periods, exponent, length) + 1) // 2).astype(np.int64)
    of_block = periods[np.maximum(1, (1 << longest) >> 1) == block]
    return (int(of_block[0]), int(of_block[-1])) if len(of_block) else (1, 0)


class SquareCatcher:
    """Runs of a growing sequence of word numbers.

    A square with period q is a stretch of words that all agree with the words q further on, q of them at least. In a
    run of the least exponent and length that stretch has ``stretch(q)`` words, so it holds a number of whole blocks
    of a dyadic length, see ``served``, one after the other, that begin at multiples of that length. Each completed
    block is a catcher for the periods of its length: it waits for its own words to come again that far on. Appended
    words complete new windows on every level; a window with the digest of a catcher that waits for it is a match, and
    as many matches in a row as the shortest run must hold begin a comparison. It goes back at once and forward as
    words are appended. A stretch as long as its period is a square, and all squares of a stretch are one run.

    With an exponent of 3 or more, matches in a row always hold a square: comparisons are in proportion to the runs of
    the sequence, so the time follows its length times the logarithm, whatever the words are.
    """

    def __init__(self, exponent: int = EXPONENT, length: int = LENGTH):
        if exponent < 2:
            raise ValueError("a run holds a square: its exponent is 2 at least")
        self.exponent, self.length = exponent, length
        self.words = np.zeros(0, np.int64)
        self.digests: dict[int, tuple[int, np.ndarray]] = {}  # block length: first window kept, digests from there on
        self.rows: dict[int, tuple] = {}  # block length: period, start and number of matches in a row that may go on
        self.open: list[tuple[int, int, int]] = []  # period, first and last word of a stretch that reaches the end
        self.found: dict[tuple[int, int], int] = {}  # first word and end of a run: its smallest period
        self.matched: dict[int, int] = {}  # block length: first window that was not compared yet

    def append(self, words: np.ndarray) -> None:
        before = len(self.words)
        self.words = np.concatenate([self.words, words])
        waiting, self.open = self.open, []
        for stretch in waiting:  # comparisons that had reached the end go on
            self._report(*self._advance(*stretch))
        self._catch(before, waiting)

    def _advance(self, period: int, first: int, last: int) -> tuple[int, int, int]:
        """Takes a stretch as far as the words go; keeps it open if it ends with them."""
        n = len(self.words)
        last += _agreeing(self.words[last : n - period], self.words[last + period :])
        if last + period == n:
            self.open.append((period, first, last))
        return period, first, last

    def _catch(self, before: int, waiting: list) -> None:
        n, block = len(self.words), 1
        new, at = self.words[before:].view(np.uint64) * _ODD, before
        # What is known to agree that far: the stretches that went on, then runs at all multiples of their periods.
        met = [(period, first) for period, first, _ in waiting]
        known = [(first, last + period, period) for period, first, last in self.open if (period, first) in set(met)]
        known += [(start, end, period) for (start, end), period in self.found.items() if end > before]
        while len(new):
            first, kept = self.digests.get(block, (at, new[:0]))
            kept = np.concatenate([kept, new])  # windows of this length from ``first`` on
            low, high = served(block, self.exponent, self.length)
            if low <= high and self.exponent * low <= n:
                self._match(block, first, kept, known)
            # Windows of twice the length that are complete now; none of them was before.
            longer = max(0, before - 2 * block + 1)
            if longer + 2 * block <= n:
                left = kept[longer - first : n - 2 * block + 1 - first]
                coming = _paired(left, kept[longer + block - first : n - block + 1 - first])
            else:
                coming = new[:0]
            reach = max(2 * block, high + block) + 2 * block  # as far back as a catcher or a longer window may ask
            drop = max(0, len(kept) - reach)
            self.digests[block] = first + drop, kept[drop:]
            new, at, block = coming, longer, 2 * block

    def _match(self, block: int, first: int, kept: np.ndarray, known: list) -> None:
        """Compares the new windows with the catchers that wait for them."""
        low, high = served(block, self.exponent, self.length)
        at = max(self.matched.get(block, 0), first + low)
        windows = np.arange(at, first + len(kept))
        self.matched[block] = first + len(kept)
        seen, nearest = kept[at - first :], (windows - low) // block * block
        matches = []
        for back in range((high - low) // block + 2):
            catcher = nearest - back * block
            same = np.flatnonzero(seen == kept[np.maximum(catcher - first, 0)])
            if len(same):
                period, start = windows[same] - catcher[same], catcher[same]
                fits = (start >= first) & (period <= high)
                matches.append((period[fits], start[fits], np.ones(int(fits.sum()), np.int64)))
        if block in self.rows:
            matches.append(self.rows.pop(block))
        if not matches:
            return
        periods, starts, times = map(np.concatenate, zip(*matches, strict=True))
        if not len(periods):
            return
        order = np.lexsort((starts, periods))
        periods, starts, times = periods[order], starts[order], times[order]
        ends = starts + times * block
        begins = np.flatnonzero(np.concatenate([[True], (periods[1:] != periods[:-1]) | (starts[1:] != ends[:-1])]))
        periods, starts, times = periods[begins], starts[begins], np.add.reduceat(times, begins)
        going = starts + times * block + periods >= first + len(kept)  # the window they wait for is still to come
        if going.any():
            self.rows[block] = periods[going], starts[going], times[going]
        needed = (stretch(periods, self.exponent, self.length) - block + 1) // block
        enough = times >= needed
        periods, starts = periods[enough], starts[enough]
        for start, end, period in known:
            if not len(periods):
                return
            periods, starts = self._outside(periods, starts, block, start, end, period)
        while len(periods):
            period, start = int(periods[0]), int(starts[0])
            periods, starts = periods[1:], starts[1:]
            again = self.words[start + period : start + period + block]
            if not np.array_equal(self.words[start : start + block], again):  # equal digests, other words
                continue
            back = _agreeing(self.words[:start][::-1], self.words[period : start + period][::-1])
            _, begin, last = self._advance(period, start - back, start + block)
            if run := self._report(period, begin, last):
                known.append((*run, period))
                periods, starts = self._outside(periods, starts, block, *run, period)

    @staticmethod
    def _outside(periods, starts, block: int, start: int, end: int, period: int):
        """Without the matches inside a run at a multiple of its period: they are the same run."""
        same = (periods % period == 0) & (starts >= start) & (starts + periods + block <= end)
        return periods[~same], starts[~same]

    def _report(self, period: int, begin: int, last: int) -> tuple[int, int] | None:
        """A stretch that holds squares is a run; one that may still grow is noted as it stands."""
        end = last + period
        if last - begin < period or end - begin < max(self.length, self.exponent * period):
            return None
        if end < len(self.words):
            self.found[begin, end] = min(period, self.found.get((begin, end), period))
        return begin, end

    def runs(self) -> list[tuple[int, int, int]]:
        """``start, length, period`` of the runs of all words so far, by start, then period."""
        closed = dict(self.found)
        for period, begin, last in self.open:
            end = last + period
            if last - begin >= period and end - begin >= max(self.length, self.exponent * period):
                closed[begin, end] = min(period, closed.get((begin, end), period))
        return sorted(((s, e - s, q) for (s, e), q in closed.items()), key=lambda r: (r[0], r[2]))


def find_runs(words: np.ndarray, appended: int = APPENDED) -> list[tuple[int, int, int]]:
    catcher = SquareCatcher()
    for at in range(0, len(words), appended):
        catcher.append(words[at : at + appended])
    return catcher.runs()


def repeated_by_id(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """A tenth of the documents, told by the checksum of the id, end with a stretch that is repeated."""
    n = len(words)
    checksum = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n == 0 or checksum is None or checksum % 10:
        return words
    number = checksum // 10
    start = number % n
    period = 1 + (n - start) // (3 + number % 8)
    unit = words[start : start + period]
    times = -(-(n - start) // period)
    return words[:start] + (unit * times)[: n - start]


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return words if kept.all() else [words[i] for i in np.flatnonzero(kept).tolist()]


def describe(doc_id: int | None, text: bytes | None) -> tuple:
    words = repeated_by_id((text or b"").split(), doc_id)
    runs = find_runs(pd.factorize(np.array(words, object))[0].astype(np.int64)) if len(words) >= LENGTH else []
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(without_repeats(words, runs))).hexdigest(),
    )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256`` for every row.

    Words are what ASCII white space separates. A tenth of the documents is changed before the search, see
    ``repeated_by_id``; a NULL id has no checksum, so such a row is searched as it is. A NULL or empty text has no words
    and no runs: four NULLs and the digests of nothing. Of runs with the same length in periods the first one counts,
    then the one with the smaller period. Repeated rows each give their row; an empty table gives an empty result;
    other columns are not read, whatever their names. A very long text is one row and stays in one task: it is appended
    in parts, and the digests kept for a level are a few times its block length.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = [None if pd.isna(i) else int(i) for i in pdf["doc_id"]]
            out = pd.DataFrame([describe(i, t) for i, t in zip(ids, pdf["text"], strict=True)], columns=RESULT_NAMES)
            yield out.astype({name: "Int64" for name in RESULT_NAMES[:6]})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInPandas(run, RESULT)


RESULT_NAMES = [field.split()[0] for field in RESULT.split(", ")]
