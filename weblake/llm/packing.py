"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

A piece of length L belongs to class j = capacity // L and a bin of class j takes exactly j
pieces, whatever they are, so bins fill without any search. Documents may be cut: whole
capacities first, then halves, quarters, ... down to `tail`, whose classes fill their bins to
the last token; the rest, shorter than `tail`, is one piece, and its bins waste less than one
such piece. Each partition fills its own bins in one pass (no shuffle, nothing shared); what
waits in open bins is bounded by the classes, not by the data. At the end of a partition the
waiting pieces are laid end to end and cut at the capacity, the last stretch at powers of two,
so no sequence is left half empty.

Defined cases: a null or empty text is the end id alone; a null doc_id is kept; repeated rows are
packed as often as they come; an empty table gives no rows; other columns are left out.
A task that runs again packs the same rows the same way, so lost executors change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblake.llm.tokens import TokenIds

SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "tokens binary")
_ROWS = 4096


def cuts(n: int, capacity: int, tail: int) -> list[int]:
    """Lengths of the pieces of a document of n tokens: capacity, then its halves, then one tail."""
    out = [capacity] * (n // capacity)
    rest, size = n % capacity, capacity // 2
    while rest >= tail and size >= tail:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out + [rest] * (rest > 0)


class HarmonicBins:
    """Open bins of one worker. `add` takes a piece (doc_id, start, doc_tokens, tokens); `closed`
    holds finished rows in SCHEMA order, less those still waiting in open bins."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next = capacity, first_sequence
        self.open: dict[int, list] = {}
        self.closed: list[tuple] = []

    def _close(self, pieces: list) -> None:
        at = 0
        for doc, start, total, tokens in pieces:
            n = len(tokens) // 4
            self.closed.append((doc, start, n, total, self.next, at, tokens))
            at += n
        self.next += 1

    def add(self, piece: tuple) -> None:
        j = self.capacity // (len(piece[3]) // 4)
        waiting = self.open.setdefault(j, [])
        waiting.append(piece)
        if len(waiting) == j:
            self._close(self.open.pop(j))

    def finish(self) -> None:
        """Lay the waiting pieces end to end; cut at the capacity, the last stretch at powers of two."""
        waiting = [p for j in sorted(self.open) for p in self.open[j]]
        self.open.clear()
        left = sum(len(p[3]) // 4 for p in waiting)
        room, pieces = 0, []
        for doc, start, total, tokens in waiting:
            while tokens:
                if not room:
                    if pieces:
                        self._close(pieces)
                        pieces = []
                    room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
                n = min(room, len(tokens) // 4)
                pieces.append((doc, start, total, tokens[: 4 * n]))
                tokens, start = tokens[4 * n:], start + n
                room, left = room - n, left - n
        if pieces:
            self._close(pieces)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, tail: int = 32,
         doc_id: str = "doc_id", text: str = "text", keep: bool = True) -> DataFrame:
    """One row per piece (SCHEMA): where it lies in its document and in its sequence, and its ids
    as little-endian uint32. Sequence ids are unique, not gapless. `keep`: whether Python workers keep their dictionaries for later tasks."""
    end = end_id.to_bytes(4, "little")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                        ("offset", pa.int64()), ("tokens", pa.binary())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(schema)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = TokenIds.of(tokenizer).ids
        bins = HarmonicBins(capacity, TaskContext.get().partitionId() << 40)
        for b in batches:
            docs_, texts = b.column(0), b.column(1)
            for i in range(b.num_rows):
                doc, tokens, at = docs_[i].as_py(), ids(texts[i].as_py()) + end, 0
                total = len(tokens) // 4
                for n in cuts(total, capacity, tail):
                    bins.add((doc, at, total, tokens[4 * at: 4 * (at + n)]))
                    at += n
                if len(bins.closed) >= _ROWS:
                    yield batch(bins.closed)
                    bins.closed = []
        bins.finish()
        TokenIds.of(tokenizer).rest(keep)
        yield batch(bins.closed)

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(work, SCHEMA))
