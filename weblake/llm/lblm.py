"""A log-bilinear language model, trained by noise-contrastive estimation, over corpus-wide word counts.

Words are counted over all training documents (combined per partition, then by word). The most
frequent `VOCABULARY` words, and one class for all others, are the model's outcomes: the score of
word w after the words a, b is q[w].(c1*r[a] + c2*r[b]) + bias[w]. A word of the class "other" takes
the class's probability times its share (c + 0.5) of the class's counts, so that the model is normalised over
all words, those never seen counting as one.

Training runs where the documents are: every partition makes one pass over all of its training
tokens from a common start (fitted on at most `START_DOCS` documents, taken by the hash of their ids), and the partitions'
parameters are averaged by their tokens, in steps of `FAN_IN`. If that sample has no training document, the start is random. The normalisers of all pairs of
context words are computed once, in batched matrix products, and sent to the workers with
the scores: their size depends on `VOCABULARY` alone.

Scoring needs the counts of rare words too. The `HEAD` most frequent words travel with the job, so the
words that many documents share never meet in one task; only the distinct other words of each
document are joined with the counts, by hash.

Defined cases: a null or empty text is the end token alone; a null doc_id counts as the empty id and is for
training; repeated rows are counted and scored as often as they come; an empty table gives no rows;
without training tokens every word is unseen; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblake.llm.simhash import Stage

VOCABULARY, HEAD, START_DOCS, FAN_IN, WIDTH = 1000, 100_000, 400, 32, 16
END = b""  # the end token: no word is empty
_FLUSH = 100_000


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


def tokens(text: str | None) -> list[bytes]:
    return ((text or "").encode().lower().split()) + [END]


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the training documents of a partition; a word may come several times."""
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    for b in batches:
        for doc, text in zip(b.column(0), b.column(1)):
            if not held_out(doc.as_py()):
                counts.update(tokens(text.as_py()))
            if len(counts) >= _FLUSH:
                yield out()
                counts.clear()
    yield out()


class LogBilinear:
    """Parameters and one-pass training. Outcomes 0..size-1; contexts also `size`, the start of a text."""

    def __init__(self, counts: np.ndarray, width: int = WIDTH, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.size = len(counts)
        self.noise = (counts + 0.5) / (counts + 0.5).sum()
        self.r = rng.normal(0, 0.1, (self.size + 1, width)).astype(np.float32)
        self.q = rng.normal(0, 0.1, (self.size, width)).astype(np.float32)
        self.c = np.ones((2, width), dtype=np.float32)
        self.bias = np.log(self.noise).astype(np.float32)
        self.parts = ("r", "q", "c", "bias")

    def pack(self) -> bytes:
        return b"".join(getattr(self, p).tobytes() for p in self.parts)

    def unpack(self, data: bytes) -> "LogBilinear":
        at = 0
        for p in self.parts:
            old = getattr(self, p)
            setattr(self, p, np.frombuffer(data, np.float32, old.size, at).reshape(old.shape).copy())
            at += old.nbytes
        return self

    def start_training(self, rate: float = 0.1, noise: int = 64, seed: int = 2) -> None:
        self.rate, self.k, self.rng = rate, noise, np.random.default_rng(seed)
        self.steps = {p: np.full(getattr(self, p).shape, 1e-2, dtype=np.float32) for p in self.parts}
        self.cumulative = np.cumsum(self.noise)

    def _step(self, part: str, rows, gradient: np.ndarray) -> None:
        """AdaGrad; `rows` may repeat."""
        if rows is not None:
            order = np.argsort(rows, kind="stable")
            first = np.flatnonzero(np.diff(rows[order], prepend=-1))
            gradient, rows = np.add.reduceat(gradient[order], first, axis=0), rows[order][first]
        else:
            rows = slice(None)
        self.steps[part][rows] += gradient * gradient
        getattr(self, part)[rows] -= self.rate * gradient / np.sqrt(self.steps[part][rows])

    def train(self, a: np.ndarray, b: np.ndarray, w: np.ndarray, batch: int = 4096) -> None:
        """One pass over the given positions: words w after b, a (a the nearer)."""
        for at in range(0, len(w), batch):
            x, y, z = a[at:at + batch], b[at:at + batch], w[at:at + batch]
            n = len(z)
            noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(self.k)), self.size - 1)
            ra, rb, qz, qn = self.r[x], self.r[y], self.q[z], self.q[noise]
            context = self.c[0] * ra + self.c[1] * rb
            offset = np.log(self.k * self.noise).astype(np.float32)
            d_data = (qz * context).sum(axis=1) + self.bias[z] - offset[z]
            d_noise = context @ qn.T + (self.bias - offset)[noise]
            g_data = -1 / (1 + np.exp(np.clip(d_data, -30, 30)))
            g_noise = 1 / (1 + np.exp(-np.clip(d_noise, -30, 30)))
            g_context = (g_data[:, None] * qz + g_noise @ qn) / n
            rows = np.concatenate([z, noise])
            g_q = np.concatenate([g_data[:, None] * context, g_noise.T @ context]) / n
            g_bias = np.concatenate([g_data, g_noise.sum(axis=0)]) / n
            self._step("c", None, np.stack([(g_context * ra).sum(axis=0), (g_context * rb).sum(axis=0)]))
            self._step("r", np.concatenate([x, y]), np.concatenate([g_context * self.c[0], g_context * self.c[1]]))
            self._step("q", rows, g_q)
            self._step("bias", rows, g_bias)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores of every outcome by the nearer and by the farther context word; their sum is the model's score."""
        return (self.c[0] * self.r) @ self.q.T + self.bias, (self.c[1] * self.r) @ self.q.T

    def normalisers(self, a: int) -> np.ndarray:
        """The log of the sum over all outcomes, for the nearer word a and every farther word."""
        near, far = self.tables()
        scores = far + near[a]
        most = scores.max(axis=1, keepdims=True)
        return (np.log(np.exp(scores - most).sum(axis=1)) + most[:, 0]).astype(np.float32)


def positions(ids: np.ndarray, ends: np.ndarray, outcomes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearer, farther, word) for the words of several texts laid end to end; `ends`: where each text ends."""
    w = np.minimum(np.where(ids < 0, outcomes - 1, ids), outcomes - 1)
    a, b = np.empty_like(w), np.empty_like(w)
    a[1:], b[2:] = w[:-1], w[:-2]
    first = np.concatenate([[0], ends[:-1]])
    a[first] = b[first] = outcomes
    second = first + 1
    b[second[second < ends]] = outcomes
    return a, b, w


def _ids(batch: pa.RecordBatch, numbers: dict[bytes, int], only_training: bool, least: int = 100_000):
    """Slices of a batch, of `least` words or a little more: (documents, their words, word numbers laid end to end, ends);
    -1: not among `numbers`."""
    docs, words, held = [], [], 0
    for i in range(batch.num_rows):
        doc = batch.column(0)[i].as_py()
        if not (only_training and held_out(doc)):
            docs.append(doc)
            words.append(tokens(batch.column(1)[i].as_py()))
            held += len(words[-1])
        if docs and (held >= least or i == batch.num_rows - 1):
            ids = np.fromiter((numbers.get(w, -1) for ws in words for w in ws), dtype=np.int64)
            yield docs, words, ids, np.cumsum([len(ws) for ws in words])
            docs, words, held = [], [], 0


def fit(docs: DataFrame, model: LogBilinear, numbers: dict[bytes, int], stage: Stage) -> LogBilinear:
    """`model` trained on all training documents: a common start, then one pass per partition, averaged."""
    sc = docs.sparkSession.sparkContext

    def trained(start: bytes, rate: float):
        shared = sc.broadcast((start, model.noise, {w: i for w, i in numbers.items() if i < model.size - 1}))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, noise, numbers = shared.value
            part, seen = TaskContext.get().partitionId(), 0
            own = LogBilinear(noise).unpack(start)
            own.noise = noise
            own.start_training(rate, seed=part)
            for b in batches:
                for _, _, ids, ends in _ids(b, numbers, True):
                    own.train(*positions(ids, ends, own.size))
                    seen += len(ids)
            if seen:
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "seen": pa.array([seen], pa.int64()), "model": [own.pack()]})

        return work

    schema = "part long, seen long, model binary"
    every = max(1, docs.count() // (2 * START_DOCS))
    sample = docs.where((F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0) & (F.length("text") > 0)).limit(START_DOCS).coalesce(1)
    first = sample.mapInArrow(trained(model.pack(), 0.1), schema).first()
    start = bytes(first.model) if first else model.pack()  # no training document in the sample: from the initial parameters
    models = stage(docs.mapInArrow(trained(start, 0.05), schema))

    def mean(group: pd.DataFrame) -> pd.DataFrame:
        seen = group["seen"].sum()
        total = sum(np.frombuffer(m, np.float32) * np.float64(n / seen) for m, n in zip(group["model"], group["seen"]))
        return pd.DataFrame({"part": [group["part"].iloc[0] // FAN_IN], "seen": [seen], "model": [total.astype(np.float32).tobytes()]})

    top = models.agg(F.max("part")).first()[0]
    while top is not None and top > 0:
        models, top = stage(models.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(mean, schema)), top // FAN_IN
    last = models.first()
    return model.unpack(bytes(last.model)) if last else model


def most_frequent(counts: DataFrame) -> list:
    """At most HEAD words (word, c): all of at least some count. Counts are sorted into steps of a sixteenth octave
    first, so that only those words leave the executors."""
    step = F.floor(F.log2("c") * 16)
    held, least = 0, None
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r.step):  # at most 16 a bit
        if held + r["count"] > HEAD:
            break
        held, least = held + r["count"], r.step
    return [] if least is None else counts.where(step >= least).collect()


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    sc, stage = spark.sparkContext, Stage(spark, "lblm")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = stage(docs.mapInArrow(partial_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n, types = int(total[0]), int(total[1])
    head = sorted(most_frequent(counts), key=lambda r: (-r.c, bytes(r.word)))
    numbers = {bytes(r.word): i for i, r in enumerate(head)}
    head_counts = np.array([r.c for r in head], dtype=np.float64)
    all_mass = n + 0.5 * (types + 1)
    size = min(VOCABULARY, len(head))
    other = all_mass - (head_counts[:size] + 0.5).sum()  # of the words outside the vocabulary, and of the unseen
    model = fit(docs, LogBilinear(np.append(head_counts[:size], other - 0.5)), numbers, stage)

    sent = sc.broadcast((model.pack(), model.noise))

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LogBilinear(sent.value[1]).unpack(sent.value[0])
        for b in batches:
            for a in b.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"a": pa.array([a], pa.int64()), "z": [own.normalisers(a).tobytes()]})

    found = spark.range(model.size + 1).mapInArrow(norms, "a long, z binary").collect()  # bounded by VOCABULARY
    z = np.stack([np.frombuffer(r.z, np.float32) for r in sorted(found, key=lambda r: r.a)])
    shared = sc.broadcast((numbers, np.log10(head_counts + 0.5), z, *model.tables(), size))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, log_c, z, near, far, size = shared.value
        part, row, digest = TaskContext.get().partitionId() << 40, 0, xxhash.xxh64_intdigest
        for batch in batches:
            for ids_, words, ids, ends in _ids(batch, numbers, False):
                a, b, w = positions(ids, ends, size + 1)
                first = np.concatenate([[0], ends[:-1]])
                known = ids >= 0
                plain = np.where(known, log_c[ids] if len(log_c) else 0.0, 0.0)
                told = (near[a, w] + far[b, w] - z[a, b]).astype(np.float64) / np.log(10)
                outside = ~known | (ids >= size)
                tails = [Counter(words[i][j] for j in np.flatnonzero(~known[s:e])) for i, (s, e) in enumerate(zip(first, ends))]
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(part + row + np.arange(len(ids_)), pa.int64()), "doc_id": pa.array(ids_, pa.int64()),
                    "held_out": [held_out(d) for d in ids_], "n_tokens": pa.array(ends - first, pa.int64()),
                    "head_known": pa.array(np.add.reduceat(known.astype(np.int64), first)),
                    "n_other": pa.array(np.add.reduceat(outside.astype(np.int64), first)),
                    "head_sum": pa.array(np.add.reduceat(plain, first)),
                    "model_sum": pa.array(np.add.reduceat(told + np.where(outside, plain, 0.0), first)),
                    "tail": pa.array([[{"h": int(np.uint64(digest(t, 42)).astype(np.int64)), "n": k} for t, k in x.items()] for x in tails],
                                     pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())])))})
                row += len(ids_)

    rows = docs.mapInArrow(work, "key long, doc_id long, held_out boolean, n_tokens long, head_known long, n_other long, head_sum double, "
                                 "model_sum double, tail array<struct<h:long,n:long>>")
    totals = ("doc_id", "held_out", "n_tokens", "head_known", "n_other", "head_sum", "model_sum")
    # A row per distinct rare word of a document; the first also carries the document's totals.
    pairs = rows.select("key", *totals, F.posexplode_outer("tail").alias("at", "t"))
    lead = F.coalesce(F.col("at"), F.lit(0)) == 0
    pairs = pairs.select("key", F.when(lead, F.struct(*totals)).alias("doc"), F.coalesce("t.h", "key").alias("h"), F.coalesce("t.n", F.lit(0)).alias("n"))
    rare = counts.select(F.xxhash64("word").alias("h"), "c")
    rare_log = F.log10(F.coalesce(F.col("c"), F.lit(0)) + 0.5)
    summed = (pairs.join(rare, "h", "left").groupBy("key")
              .agg(F.max("doc").alias("doc"), F.sum(F.col("n") * rare_log).alias("tail_sum"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("tail_known")))
    d = F.col("doc")
    return summed.select(
        d["doc_id"].alias("doc_id"), d["held_out"].alias("held_out"), d["n_tokens"].alias("n_tokens"), (d["head_known"] + F.col("tail_known")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (d["head_sum"] + F.col("tail_sum") - d["n_tokens"] * float(np.log10(all_mass))).alias("base_score"),
        (d["model_sum"] + F.col("tail_sum") - d["n_other"] * float(np.log10(other))).alias("score"))
