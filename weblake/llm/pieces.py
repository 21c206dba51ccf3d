"""SentencePiece encoding and decoding with weighted finite-state transducers.

Three machines are compiled from a model file: the normaliser (a space to its mark, the mark put in
front, and runs of spaces to one if the model says so), the pieces (a trie whose ends emit a piece
at weight 1) with byte fallback (a character without a piece emits its UTF-8 bytes), and for models of
merges an acceptor of neighbours: two pieces may stand next to each other only if the merges would
have left them apart, else the weight is infinite. Composing them with an input gives a lattice of
(position, last piece); its shortest path in the tropical semiring is the encoding. For a merge
model exactly one path is finite, the one that the merges lead to; for a unigram model the weights
are the pieces' negated scores, no pair is ruled out, and the path is the likeliest one.

No piece reaches across two neighbouring characters that no piece holds side by side, so an input is cut
there, and each distinct part is solved once per worker (a bounded dictionary).

Defined cases: a null or empty text has no pieces; a mark in the text itself reads as a space, as the model has
it; other columns pass through. Models with a character map in their normaliser are refused.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType
from sentencepiece import sentencepiece_model_pb2

MARK = "▁"
MAX_ENTRIES, MAX_PAIRS = 150_000, 1_000_000
NORMAL, UNKNOWN, USER, BYTE, UNIGRAM, MERGES = 1, 2, 4, 6, 1, 2  # fixed values of the model format


class Neighbours:
    """Which pieces the merges leave side by side. A merge's rank is that of the piece it makes; the
    least rank is merged first, of equal ranks the one further left."""

    def __init__(self, rank: dict[str, int]):
        self.rank = rank
        self.parts: dict[str, tuple[str, str] | None] = {}  # a piece's last merge; None: a single character
        self.known: dict[str, dict[str, bool]] = {}
        self.learnt = 0

    def last_merge(self, piece: str) -> tuple[str, str] | None | bool:
        """The two parts of a piece's last merge, None for a character, False if the merges don't lead to it."""
        if piece not in self.parts:
            now, last = list(piece), None
            while len(now) > 1:
                ranks = [self.rank.get(a + b, inf) for a, b in zip(now, now[1:])]
                least = min(ranks)
                if least == inf:
                    break
                i = ranks.index(least)
                last = now[i], now[i + 1]
                now[i: i + 2] = [now[i] + now[i + 1]]
            self.parts[piece] = last if len(now) == 1 else False
        return self.parts[piece]

    def apart(self, a: str, b: str) -> bool:
        """Undo the merges of both pieces, latest first: at no time may the two parts at the seam have
        been the next merge."""
        bound = inf
        while self.rank.get(a + b, inf) >= bound or (a + b) not in self.rank:
            left, right = self.last_merge(a), self.last_merge(b)
            if not left and not right:
                return True
            if left and (not right or self.rank[a] > self.rank[b]):
                bound, a = self.rank[a], left[1]
            else:
                bound, b = self.rank[b] + 1, right[0]
        return False

    def after(self, a: str) -> dict[str, bool]:
        """What is known of the pieces that may follow `a`."""
        if a not in self.known:
            self.known[a] = {}
        return self.known[a]

    def learn(self, row: dict[str, bool], a: str, b: str) -> bool:
        if self.learnt >= MAX_PAIRS:
            self.known.clear()
            self.learnt = 0
        self.learnt += 1
        row[b] = ok = not a or self.apart(a, b)
        return ok


class _Parts(dict):
    """Ids of a part of normalised text. Of two generations, the older one goes when the younger one is full."""

    def __init__(self, solve):
        self.solve, self.older = solve, {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = array("I", self.solve(part)).tobytes()
        if len(self) >= MAX_ENTRIES:
            self.older = dict(self)
            self.clear()
        self[part] = ids
        return ids


class PieceTransducer:
    _loaded: dict[str, "PieceTransducer"] = {}

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        spec, self.kind = model.normalizer_spec, model.trainer_spec.model_type
        if spec.precompiled_charsmap or self.kind not in (UNIGRAM, MERGES):
            raise ValueError("only unigram and merge models without a character map")
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER)}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        if any(p.type == USER for p in model.pieces):
            raise ValueError("user-defined pieces aren't supported")
        self.weight = {p: -model.pieces[i].score for p, i in self.ids.items()}
        places = {s: k for k, s in enumerate(sorted({model.pieces[i].score for i in self.ids.values()}, reverse=True))}
        self.neighbours = Neighbours({p: places[model.pieces[i].score] for p, i in self.ids.items() if len(p) > 1})
        self.trie: list = [None, {}]  # the piece that ends here, and the nodes that follow
        for piece in self.ids:
            if self.kind == MERGES and self.neighbours.last_merge(piece) is False:
                continue  # no merges lead to it
            node = self.trie
            for c in piece:
                node = node[1].setdefault(c, [None, {}])
            node[0] = piece
        self.pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.parts = _Parts(self.merge_path if self.kind == MERGES else self.shortest_path)
        self.words = _Parts(self._word)
        spoken = [p.piece.encode() if p.type in (NORMAL, USER) else bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else b"" for p in model.pieces]
        spoken[self.unknown] = model.trainer_spec.unk_surface.encode()
        self.spoken = spoken

    @classmethod
    def of(cls, path: str) -> "PieceTransducer":
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def cut(self, text: str) -> list[str]:
        """Parts that no piece reaches across."""
        pairs, parts, start = self.pairs, [], 0
        for i in range(1, len(text)):
            if text[i - 1:i + 1] not in pairs:
                parts.append(text[start:i])
                start = i
        return parts + [text[start:]]

    def _said(self, piece: str) -> list[int]:
        """The ids that an arc emits: the piece's, or its bytes'."""
        if piece in self.ids:
            return [self.ids[piece]]
        return [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown]

    def merge_path(self, part: str) -> list[int]:
        """The one finite path of a merge model: for each position the last piece of the path that leads to it."""
        n, trie, neighbours = len(part), self.trie[1], self.neighbours
        last: list[str | None] = [""] + [None] * n
        for i in range(n):
            before = last[i]
            if before is None:
                continue
            row, follow, j = neighbours.after(before), trie, i
            while j < n:
                node = follow.get(part[j])
                if node is None:
                    break
                j += 1
                piece, follow = node
                if piece is not None:
                    ok = row.get(piece)
                    if ok is None:
                        ok = neighbours.learn(row, before, piece)
                    if ok:
                        last[j] = piece
            if part[i] not in self.ids and (not before or neighbours.apart(before, part[i])):  # byte fallback
                last[i + 1] = part[i]
        out: list[list[int]] = []
        while n:
            out.append(self._said(last[n]))
            n -= len(last[n])
        return [i for some in reversed(out) for i in some]

    def shortest_path(self, part: str) -> list[int]:
        """The cheapest path of a unigram model: for each position the least weight and the last piece."""
        n = len(part)
        best: list[tuple[float, str]] = [(0.0, "")] + [(inf, "")] * n
        for i in range(n):
            arcs, node, j = [(part[i], 1e6)] if part[i] not in self.ids else [], self.trie, i  # byte fallback
            while j < n and (node := node[1].get(part[j])) is not None:
                j += 1
                if node[0]:
                    arcs.append((node[0], self.weight[node[0]]))
            for piece, weight in arcs:
                if best[i][0] + weight < best[i + len(piece)][0]:
                    best[i + len(piece)] = best[i][0] + weight, piece
        out: list[list[int]] = []
        while n:
            out.append(self._said(best[n][1]))
            n -= len(best[n][1])
        return [i for some in reversed(out) for i in some]

    def _word(self, word: str) -> list[int]:
        return array("I", b"".join(map(self.parts.__getitem__, self.cut(MARK + word)))).tolist()

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text as little-endian uint32."""
        if not text:
            return b""
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        words = text.split(" ")
        if self.prefix and "" not in words and MARK not in text:
            return b"".join(map(self.words.__getitem__, words))
        normal = (MARK if self.prefix and text else "") + text.replace(" ", MARK)
        return b"".join(map(self.parts.__getitem__, self.cut(normal)))

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.spoken.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text[:1] == " " else text


def encode_documents(docs: DataFrame, model: str, text: str = "text", out: str = "ids") -> DataFrame:
    """The rows and columns of `docs` and the ids of each whole text as little-endian uint32 bytes."""
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = PieceTransducer.of(model).encode
        for b in batches:
            ids = pa.array([encode(t.as_py()) for t in b.column(at)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, ids], names=[*b.schema.names, out])

    return docs.mapInArrow(work, StructType([*docs.schema.fields, StructField(out, BinaryType())]))


def decoded(ids: Column | str, model: str) -> Column:
    """The text that ids (little-endian uint32 bytes) say; null for null."""
    @F.arrow_udf("string")
    def run(rows: pa.Array) -> pa.Array:
        return pa.array([None if (b := r.as_py()) is None else PieceTransducer.of(model).decode(b) for r in rows], pa.string())

    return run(F.col(ids) if isinstance(ids, str) else ids)
