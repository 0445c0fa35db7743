"""Periodic runs of words by maximal pairs.

Two places of a text that agree in their next m words, but neither in the word
after those nor in the word before, are a maximal pair.  If they stand d words
apart and d is at most m / 2, the d + m words from the first place on are a run
of period d that no neighbouring word extends, and every run of at least three
periods is such a pair: nothing has to be extended afterwards.

The pairs come from the tree of intervals of equal prefixes (LCP intervals) over
the sorted suffixes, from the leaves up.  Every interval holds its places in
order, each with its left-word class, the word before it.  When two children of
an interval of m words meet, partners are places of different children and
different classes within m / 2 words.  Places of one m-word stretch that near to
each other are one period apart each, so partners of a run are neighbours in the
order of the places: the lists are entered at the places of the shorter one, and
the pair's distance is the smallest period.

Suffixes are sorted for many texts at once by prefix doubling.  A suffix leaves
as soon as no other of its text begins alike, and only intervals of so many words
as the shortest run needs are visited.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import at_hand, order_of, slices, spans, texts_of

#: A run has at least so many words, and so many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3
_SPACE = np.zeros(256, bool)
_SPACE[[*range(9, 14), 32]] = True


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, one after another, and how many words each text has."""
    data = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
    keep = ~_SPACE[data]
    start = keep & ~np.r_[False, keep[:-1]]
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    at = np.flatnonzero(start)
    counts = np.diff(np.r_[0, np.searchsorted(at, ends)])
    offsets = np.append(np.flatnonzero(start[keep]), int(keep.sum())).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[keep]))]
    found = pa.Array.from_buffers(pa.large_binary(), len(at), buffers).dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), counts


class _Suffixes:
    """Places whose next ``least`` words stand twice in their text, by suffix, and the words that neighbours share."""

    def __init__(self, codes: np.ndarray, doc: np.ndarray, least: int):
        n = len(codes)
        # rank: first number of the bucket of all suffixes that begin alike; the place after the end is before all.
        rank = np.zeros(n + 1, np.int64)
        at = np.arange(n)
        high, low = doc, codes
        #: For every doubling: places that are not alone there, and their buckets.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.kept = np.zeros(0, np.int64)
        width, base = 1, np.zeros(n, np.int64)
        while len(at):
            order = order_of(high, low)
            at, base = at[order], base[order]
            new = np.r_[True, (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])]
            bucket = np.r_[True, base[1:] != base[:-1]]
            # A bucket keeps the numbers it had; its parts begin where they stand in it.
            here = np.arange(len(at))
            inside = here - np.maximum.accumulate(np.where(bucket, here, 0))
            first = np.maximum.accumulate(np.where(new, here, 0))
            value = base + inside[first]
            rank[at] = value + 1
            size = np.diff(np.append(np.flatnonzero(new), len(at)))
            shared = np.repeat(size > 1, size)
            at, base = at[shared], value[shared]
            by_place = np.argsort(at)
            self.levels.append((at[by_place], base[by_place]))
            if width <= least < 2 * width:
                self.kept = at
            high, low = base, rank[np.minimum(at + width, n)]
            width *= 2
        kept = self.kept[np.argsort(rank[self.kept])]
        self.places = kept
        self.shared = self._shared(kept[:-1], kept[1:]) if len(kept) else kept

    def _shared(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Words that the suffixes at x and y share."""
        x, y = x.copy(), y.copy()
        out = np.zeros(len(x), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            at, bucket = self.levels[k]
            if not len(at):
                continue
            i, j = (np.minimum(np.searchsorted(at, z), len(at) - 1) for z in (x, y))
            same = (at[i] == x) & (at[j] == y) & (bucket[i] == bucket[j])
            step = np.where(same, 1 << k, 0)
            x += step
            y += step
            out += step
        return out


def _met(a: list[int], b: list[int], words: int, left: list[int], out: list, least: int, periods: int) -> list[int]:
    """Two children of an interval of so many words become one list; their maximal pairs that are runs go to ``out``."""
    if len(a) < len(b):
        a, b = b, a
    far, last = words // (periods - 1), len(b) - 1
    spots = [bisect_left(a, x) for x in b]
    for t, x in enumerate(b):
        k = spots[t]
        if k:
            y = a[k - 1]
            if x - y <= far and left[x] != left[y] and (t == 0 or b[t - 1] < y) and words + x - y >= least:
                out.append((y, words + x - y, x - y))
        if k < len(a):
            y = a[k]
            if y - x <= far and left[x] != left[y] and (t == last or b[t + 1] > y) and words + y - x >= least:
                out.append((x, words + y - x, y - x))
    if len(b) * 8 < len(a):
        for x, k in zip(reversed(b), reversed(spots), strict=True):
            a.insert(k, x)
        return a
    a.extend(b)
    a.sort()
    return a


def runs_of(
    codes: np.ndarray, counts: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> tuple[np.ndarray, np.ndarray]:
    """Runs (start, length, period) of texts given by the numbers of their words, and each run's text.

    Sorted by text, start and period; starts count from the first word of the text.
    """
    if periods < 3:
        raise ValueError("fewer than three periods are no maximal pair of their own")
    begin = spans(counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    # A run of d + m words with m >= (periods - 1) * d has an m of at least this.
    shortest = -(-least * (periods - 1) // periods)
    suffixes = _Suffixes(codes, doc, shortest)
    out: list[tuple[int, int, int]] = []
    if len(suffixes.places):
        before = np.r_[-1, codes[:-1]]
        before[begin[:-1][counts > 0]] = -1
        # Only the kept places are looked at.
        left = dict(zip(suffixes.places.tolist(), before[suffixes.places].tolist(), strict=True))
        places, shared = suffixes.places.tolist(), [*suffixes.shared.tolist(), 0]
        stack: list[tuple[int, list[int]]] = []
        for place, words in zip(places, shared, strict=True):
            child = [place]
            while stack and stack[-1][0] > words:
                depth, held = stack.pop()
                child = _met(held, child, depth, left, out, least, periods)
            if words < shortest:
                continue
            if stack and stack[-1][0] == words:
                depth, held = stack.pop()
                child = _met(held, child, depth, left, out, least, periods)
            stack.append((words, child))
    runs = np.array(out, np.int64).reshape(-1, 3)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    text = np.searchsorted(begin, runs[:, 0], side="right") - 1
    runs[:, 0] -= begin[text]
    return runs, text


def without_repeats(text: bytes, runs: np.ndarray) -> bytes:
    """The words of a text joined by blanks; of every run only its first period stays."""
    words = text.split()
    if len(runs):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _found(least: int, periods: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "__text", size=4 << 20):
                texts = texts_of(piece, "__text")
                codes, counts = word_codes(texts)
                runs, owner = runs_of(codes, counts, least, periods)
                ends = spans(np.bincount(owner, minlength=len(texts)))
                short = [without_repeats(t, runs[ends[i] : ends[i + 1]]) for i, t in enumerate(texts)]
                structs = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in range(3)], fields=list(_RUN))
                yield pa.RecordBatch.from_arrays(
                    [
                        *piece.columns[:-1],
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                        pa.array(short, pa.binary()).cast(pa.string()),
                    ],
                    names=[*piece.schema.names[:-1], "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(
    documents: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS, text: str = "text"
) -> DataFrame:
    """Per row of ``documents``: ``doc_id, n_words, runs, collapsed``.

    Words are what ASCII white space leaves.  A run is a stretch of words with
    smallest period q (words q apart are the same) of at least ``least`` words and
    ``periods`` (three or more) periods that no neighbouring word extends.
    ``runs`` has start (words from 0), length and period, by start and period;
    ``collapsed`` the words joined by blanks, without those that a run has after its
    first period.

    ``documents``: ``doc_id`` and the column ``text``; other columns are ignored, whatever
    their names.  A NULL text is empty: no words, no runs, an empty string.  NULL
    and repeated ids, repeated rows each give their row; an empty table gives none.
    Nothing is shuffled; a worker holds one slice of texts, or one whole text.
    """
    at_hand(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long"), F.col(text).cast("string").alias("__text"))
    return rows.mapInArrow(
        _found(least, periods),
        "doc_id long, n_words long, runs array<struct<start long, length long, period long>>, collapsed string",
    )
