"""Periodic runs of words, found online by a sparse DP over diagonals, and texts without their repeats.

A run is a stretch of words, as long as it can be, that repeats with a smallest period of q words and is at least
`times` * q and `shortest` words long. The words are passed once. For each one, its earlier occurrences say which lags
(diagonals of the word-by-word matrix) match here; a lag that matched at the word before goes on, another one begins.
A lag that stops matching is done: if its matches are enough, the run is emitted there and then. Of lags that give the
same stretch the smallest is its period, all others are its multiples.

Two rules keep the matrix sparse, and neither loses a run:

* Every run has at least `need` matches in a row (5 for 4 periods and 6 words), so an occurrence counts only if the `need` words
  from there on agree, too: these word groups are numbered exactly, by numbering pairs of numbers.
* Inside a stretch of period q that is known for a period or more, lags of 2q and above that stay in the stretch are not followed:
  a multiple of q says nothing new, and any other lag matches less than q words there (two stretches of smallest periods p and q
  share less than p + q words). The chain of occurrences jumps to the first one before the stretch. What such a lag had matched
  at the end of a stretch that it outlives is counted backwards, once.

A word said a million times over therefore costs one step a word. Besides, there is one step for each pair of equal groups of
words in different stretches, up to a quarter of the text apart. Memory is that of one text.

Defined cases: a null text has no word, no run, and an empty text without repeats, as an empty one has; repeated rows get
equal results; an empty table gives no rows; the function makes a column, so other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

Run = tuple[int, int, int]


def groups(words: list[bytes], size: int) -> np.ndarray:
    """A number for each `size` words in a row, by the place of the first: equal numbers, equal words."""
    known: dict[bytes, int] = {}
    single = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    out, have = single, 1
    while have < size:
        step = min(have, size - have)  # what is still to come is covered by a group of the same size, overlapping or not
        left, right = out[: len(out) - step], out[step:]
        out = np.unique(left * len(words) + right, return_inverse=True)[1]
        have += step
    return out


def find_runs(words: list[bytes], shortest: int = 6, times: int = 4) -> list[Run]:
    """(start, length, period) of each run, by start, then period."""
    n = len(words)
    need = min(max(shortest - q, (times - 1) * q) for q in range(1, shortest + 1))
    if n < shortest:
        return []
    number = groups(words, need)
    order = np.argsort(number, kind="stable")
    equal = number[order[1:]] == number[order[:-1]]
    earlier = np.full(len(number), -1, dtype=np.int64)
    earlier[order[1:][equal]] = order[:-1][equal]
    before, at = earlier.tolist(), number.tolist()
    found: list[Run] = []
    active: dict[int, Diagonal] = {}
    last, most = -1, n // times

    def emit(ended: dict[int, Diagonal], end: int) -> None:
        period: dict[int, int] = {}
        for lag, d in ended.items():
            if end - d.first + need - 1 >= max(shortest - lag, (times - 1) * lag):
                period[d.first - lag] = min(lag, period.get(d.first - lag, lag))
        found.extend((start, end + need - 1 - start, lag) for start, lag in period.items())

    for i in np.flatnonzero(earlier >= 0).tolist():
        if i != last + 1:
            emit(active, last + 1)
            active = {}
        last, here = i, at[i]
        now = {lag: d for lag, d in active.items() if at[i - lag] == here}
        known = [(lag, d) for lag, d in now.items() if i - d.first >= lag]
        j = before[i]
        while 0 <= j and i - j <= most:
            lag = i - j
            for q, d in known:
                if 2 * q <= lag and j >= d.first - q:
                    j = d.exit(i, j, q, before)
                    break
            else:
                if lag not in now:
                    first = i
                    while first > lag and at[first - 1] == at[first - 1 - lag]:
                        first -= 1
                    now[lag] = Diagonal(first)
                j = before[j]
        if not active.keys() <= now.keys():
            emit({lag: d for lag, d in active.items() if lag not in now}, i)
        active = now
    emit(active, last + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


class Diagonal:
    """A lag that matches from the place `first` on."""

    __slots__ = ("first", "exits")

    def __init__(self, first: int):
        self.first, self.exits = first, {}

    def exit(self, i: int, j: int, lag: int, before: list[int]) -> int:
        """The next occurrence, from j on, of what stands at i that lies before the stretch; one for each place of a period."""
        phase = (i - self.first) % lag
        if phase not in self.exits:
            while j >= self.first - lag:
                j = before[j]
            self.exits[phase] = j
        return self.exits[phase]


def collapse(text: str | None, shortest: int = 6, times: int = 4) -> tuple[list[Run], str]:
    """The runs of a text, and its words joined by one space without those in a run but after the run's first period."""
    words = text.encode().split() if text else []
    found = find_runs(words, shortest, times)
    if found:
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in found:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return found, b" ".join(words).decode()


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(text: Column | str, shortest: int = 6, times: int = 4) -> Column:
    """`runs` (start, length, period) and `collapsed`, the text without repeats, of each whole text."""
    @F.arrow_udf("runs array<struct<start:long,length:long,period:long>>, collapsed string")
    def of(texts: pa.Array) -> pa.Array:
        found, collapsed = [], []
        for t in texts:
            runs, rest = collapse(t.as_py(), shortest, times)
            found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
            collapsed.append(rest)
        return pa.StructArray.from_arrays([pa.array(found, pa.list_(_RUN)), pa.array(collapsed, pa.string())], ["runs", "collapsed"])

    return of(F.col(text) if isinstance(text, str) else text)
