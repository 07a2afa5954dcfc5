"""Periodic runs of words, found by seeds on diagonals that are extended.

A run of period q holds two copies, q words apart, of a stretch at least as long as ``max(least - q, (times - 1) * q)``
words. Periods are taken in bands, and in each band all stretches of the smallest guaranteed length (k words) are
indexed. Within a run, k words and the same k words q later are neighbouring occurrences in that index: an occurrence
between them, at d < q, would give the k words the periods d and q, and with d + q <= k + gcd(d, q) the run itself a
smaller period. So neighbouring occurrences alone are the pairs that matter, one a position, however often a phrase is
repeated. Seeds on one diagonal (a lag) are extended to both sides; the furthest word covered of each lag suppresses
seeds that an extension passed already.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import bounded_batches, by_value, unused

by_value(__name__)

#: A run has at least so many words, and so many times its period.
LEAST, TIMES = 24, 3
#: Bytes of texts whose words are looked at together; a longer text is looked at alone.
TOGETHER = 1 << 22
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct([("runs", pa.list_(_RUN)), ("strongest", _RUN), ("collapsed", pa.string())])
_FOUND_SQL = (
    "runs array<struct<start:bigint,length:bigint,period:bigint>>, "
    "strongest struct<start:bigint,length:bigint,period:bigint>, collapsed string"
)


def bands(least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, int, int]]:
    """(smallest period, largest period, words of a seed) of the bands, without end.

    A seed is no longer than any run of the band guarantees, and long enough for neighbouring occurrences to do: two
    occurrences within a period need at least ``seed - period + 2`` words from one to the next.
    """
    low = 1
    while True:
        high, seed = low, max(least - low, (times - 1) * low)
        while True:
            shorter = min(seed, max(least - high - 1, (times - 1) * (high + 1)))
            if 3 * (high + 1) > 2 * shorter + 3:
                break
            high, seed = high + 1, shorter
        yield low, high, seed
        low = high + 1


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Stretches:
    """64-bit hashes of stretches of words: those of 2n words are made of two of n words, as far as asked for."""

    def __init__(self, words: np.ndarray):
        self.levels = [_mixed(words.astype(np.uint64))]

    def at(self, places: np.ndarray, length: int) -> np.ndarray:
        level = length.bit_length() - 1
        while len(self.levels) <= level:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(_joined(last[:-half], last[half:]))
        hashes = self.levels[level]
        rest = length - (1 << level)
        return _joined(hashes[places], hashes[places + rest]) if rest else hashes[places]


def _joined(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return _mixed(one * np.uint64(0x9E3779B97F4A7C15) + other)


def _equal_from(words: np.ndarray, one: int, other: int) -> int:
    """How many words from ``one`` on equal those from ``other`` on (``other`` is the later)."""
    done, step = 0, 32
    while True:
        step = min(step, len(words) - other - done)
        differ = words[one + done:one + done + step] != words[other + done:other + done + step]
        first = int(differ.argmax()) if step else 0
        if not step or differ[first]:
            return done + first
        done, step = done + step, step * 4


def _equal_before(words: np.ndarray, one: int, other: int) -> int:
    """How many words before ``one`` equal those before ``other``."""
    done, step = 0, 32
    while True:
        step = min(step, one - done)
        differ = (words[one - done - step:one - done] != words[other - done - step:other - done])[::-1]
        first = int(differ.argmax()) if step else 0
        if not step or differ[first]:
            return done + first
        done, step = done + step, step * 4


def periodic_runs(words: np.ndarray, longest: int, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of all runs of a row of word numbers, sorted by start and period.

    ``words`` may hold many texts, each followed by a number of its own; ``longest`` bounds the words of one text.
    """
    if times < 3:
        raise ValueError("runs shorter than three periods have no seeds that are sure to be neighbours")
    stretches, found = Stretches(words), {}
    alive = np.arange(len(words))
    for low, high, seed in bands(least, times):
        alive = alive[alive <= len(words) - seed]
        if low * times > longest or len(alive) < 2:
            break
        hashes = stretches.at(alive, seed)
        order = np.argsort(hashes, kind="stable")
        hashes, places = hashes[order], alive[order]
        alike = hashes[1:] == hashes[:-1]
        first, lag = places[:-1][alike], places[1:][alike] - places[:-1][alike]
        alive = np.unique(np.concatenate([first, places[1:][alike]]))  # a longer stretch is repeated only where this is
        fits = (lag >= low) & (lag <= high)
        for start, length, period in _extended(words, first[fits], lag[fits], seed):
            if length >= max(least, times * period):
                # the same stretch with a smaller period is the run; this period is a multiple of it
                found.setdefault((start, length), period)
    runs = sorted((start, period, length) for (start, length), period in found.items())
    return np.array([(s, n, p) for s, p, n in runs], np.int64).reshape(-1, 3)


def _extended(words: np.ndarray, first: np.ndarray, lag: np.ndarray, seed: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of the longest stretch around each seed, lag by lag."""
    if not len(first):
        return
    order = np.lexsort([first, lag])
    first, lag = first[order], lag[order]
    starts = np.flatnonzero(np.r_[True, (lag[1:] != lag[:-1]) | (first[1:] > first[:-1] + seed)])
    ends = np.r_[starts[1:], len(first)] - 1
    covered: dict[int, int] = {}  # the furthest word that an extension of this lag has reached
    for begin, end, apart in zip(first[starts].tolist(), (first[ends] + seed).tolist(), lag[starts].tolist()):
        if begin < covered.get(apart, 0):
            continue
        end += _equal_from(words, end, end + apart)
        begin -= _equal_before(words, begin, begin + apart)
        covered[apart] = end
        yield begin, end - begin + apart, apart


def look_at(texts: list[bytes], least: int = LEAST, times: int = TIMES) -> list[tuple[np.ndarray, str]]:
    """(runs, collapsed text) of each text, given in UTF-8."""
    words = [text.split() for text in texts]  # bytes are split at exactly the six ASCII white-space characters
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    number = _Numbers()
    row = np.full(int((sizes + 1).sum()), -1, np.int64)
    for start, size, text in zip(starts, sizes, words):
        row[start:start + size] = np.fromiter(map(number.__getitem__, text), np.int64, size)
    ends = starts + sizes
    row[ends] = len(number) + np.arange(len(texts))  # each text ends with a number of its own
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    # words of different texts are different numbers, so that no stretch is repeated across texts
    runs = periodic_runs(owner << 40 | row, int(sizes.max(initial=0)), least, times)
    of = np.searchsorted(starts, runs[:, 0], "right") - 1
    first, last = np.searchsorted(of, np.arange(len(texts)), "left"), np.searchsorted(of, np.arange(len(texts)), "right")
    out = []
    for at, text in enumerate(words):
        own = runs[first[at]:last[at]] - np.array([starts[at], 0, 0])
        if len(own):
            keep = np.ones(len(text), bool)
            for start, length, period in own.tolist():
                keep[start + period:start + length] = False
            text = [text[i] for i in np.flatnonzero(keep)]
        out.append((own, b" ".join(text).decode()))
    return out


class _Numbers(dict):
    """A number for each distinct word, in order of appearance."""

    def __init__(self):
        super().__init__()
        self.next = count().__next__

    def __missing__(self, word: bytes) -> int:
        self[word] = number = self.next()
        return number


def _portions(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > TOGETHER:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the largest exact length over period; of equal ones the first by start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def with_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` (text and any other columns) with a column ``periodic``: (runs, strongest, collapsed).

    ``runs`` lists (start, length, period) of every run, by start and period, counted in words; ``strongest`` is the one
    with the largest length over period (ties: smallest start, then period), null without runs; ``collapsed`` is the
    text without the words that a run repeats, joined by single spaces. A null or empty text, or one of white space,
    has no runs and an empty collapsed text. Texts are looked at whole, however long; a text alone must fit in a task.
    Repeated rows repeat, an empty table gives no rows, and if ``docs`` has a column ``periodic`` the new one gets an
    underscore. A task works on what it reads: nothing is shuffled.
    """
    bounded_batches(docs.sparkSession)

    @F.arrow_udf(_FOUND_SQL)
    def periodic(text: pa.Array) -> pa.Array:
        texts = [t or b"" for t in text.cast(pa.binary()).to_pylist()]
        rows = []
        for portion in _portions(texts):
            for own, collapsed in look_at(portion, least, times):
                runs = [tuple(r) for r in own.tolist()]
                best = strongest(runs)
                rows.append({
                    "runs": [dict(zip(("start", "length", "period"), r)) for r in runs],
                    "strongest": dict(zip(("start", "length", "period"), best)) if best else None,
                    "collapsed": collapsed,
                })
        return pa.array(rows, _FOUND)

    return docs.withColumn(unused(docs, "periodic"), periodic(F.col("text")))


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a repeated phrase in a tenth of the texts, to measure the search for runs.

    With h the crc32 of the id as text and g = h // 10, the texts of n > 0 words whose h ends in 0 go on from word
    a = g % n by repeating their 1 + (n - a) // (3 + g % 8) words from there; their words are then joined by single
    spaces. Other texts, and those without id, stay as they are.
    """
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    @F.arrow_udf("string")
    def repeated(text: pa.Array, g: pa.Array) -> pa.Array:
        out = []
        for whole, part in zip(text.cast(pa.binary()).to_pylist(), g.to_pylist()):
            words = whole.split() if whole and part is not None else None
            if words:
                a = part % len(words)
                rest = len(words) - a
                period = 1 + rest // (3 + part % 8)
                phrase = words[a:a + period]
                words[a:] = (phrase * (rest // period + 1))[:rest]
            out.append(b" ".join(words).decode() if words else None)
        return pa.array(out, pa.string())

    chosen = hashed % 10 == 0
    planted = repeated(F.when(chosen, F.col("text")), F.when(chosen, F.floor(hashed / 10)))
    return docs.withColumn("text", F.coalesce(planted, F.col("text")))
