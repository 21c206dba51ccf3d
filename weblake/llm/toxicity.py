"""Toxicity by a classifier chain.

The categories have an order. Each one's model is linear (logistic) in the presence of selected words and stems, three
measures of the text (length, symbols, repetition) and the log-odds of the categories before
it. In training those log-odds are out-of-fold: they come from models that have not seen the row, so
that a later model learns how far to trust an earlier one on new texts.

The chain is fitted in one task on a bounded sample: about `SAMPLE` labelled documents (never more than twice as many),
taken evenly by the hash of their ids, one text (that of the least hash) for each id.
Copies and near copies among them (equal bands of min-hashes over their less common words) count as one
example with their mean label, so a large group of copies neither picks words nor sets weights. All
documents are scored, each from its whole text.

Defined cases: a null text has no words; null labels are unknown and their rows are left out of that
category's fit; several labels of one id count as their maximum; without labels of both kinds a category has
probability 0; repeated rows are scored alike; other columns pass through; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE, MAX_WORDS, FOLDS, MIN_Z, RARE = 12_000, 400, 3, 6.0, 4
_WORD = re.compile(r"[^\W\d_]+")
_MEASURES = 3


def words_of(text: str | None) -> set[str]:
    """The words of a text in lower case, and the first four and five letters of longer ones as stems (`abcd*`)."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {w[:4] + "*" for w in words if len(w) > 4} | {w[:5] + "*" for w in words if len(w) > 5}


def measures(text: str | None) -> list[float]:
    """Length, share of characters that are neither letters, digits nor white space, share of repeated tokens."""
    text = text or ""
    tokens = text.split()
    plain = sum(len(w) for w in re.findall(r"[\w\s]+", text))
    return [float(np.log1p(len(tokens))), 1 - plain / len(text) if text else 0.0, 1 - len(set(tokens)) / len(tokens) if tokens else 0.0]


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.1, rounds: int = 12) -> np.ndarray:
    """Weights, the last one the intercept's, by Newton steps; only the intercept goes unpenalised. y in [0, 1]."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], l2)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w += step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-4:
            break
    return w


@dataclass
class Link:
    """One category's model."""

    category: str
    words: list[str] = field(default_factory=list)
    weights: np.ndarray | None = None
    center: np.ndarray | None = None
    scale: np.ndarray | None = None


@dataclass
class Examples:
    """Sample rows: word numbers laid end to end with the row of each, the measures, the labels (nan: unknown)."""

    vocabulary: list[str]
    row: np.ndarray
    word: np.ndarray
    measures: np.ndarray
    labels: np.ndarray

    def presence(self, words: list[int], rows: np.ndarray) -> np.ndarray:
        column = np.full(len(self.vocabulary), -1)
        column[words] = np.arange(len(words))
        out = np.zeros((len(self.measures), len(words)))
        used = column[self.word] >= 0
        out[self.row[used], column[self.word[used]]] = 1
        return out[rows]

    def telling(self, y: np.ndarray, rows: np.ndarray) -> list[int]:
        """The words whose presence differs most between the two labels, by a two-sample z."""
        weight = np.zeros(len(self.measures))
        weight[rows] = 1
        positive = np.zeros(len(self.measures))
        positive[rows] = y
        df = np.bincount(self.word, weight[self.row], len(self.vocabulary))
        hits = np.bincount(self.word, positive[self.row], len(self.vocabulary))
        n, n1 = len(rows), y.sum()
        n0, p = n - n1, df / n
        with np.errstate(divide="ignore", invalid="ignore"):
            z = np.abs(hits / n1 - (df - hits) / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
        z[(df < max(RARE, n // 2000)) | ~np.isfinite(z)] = 0
        best = np.argsort(-z, kind="stable")[:MAX_WORDS]
        return [int(i) for i in best if z[i] >= MIN_Z]

    def fit(self, category: str, k: int, rows: np.ndarray, earlier: np.ndarray) -> tuple[Link, list[int]]:
        """`category` (label column k) on the given rows; earlier: log-odds of the categories before it."""
        rows = rows[~np.isnan(self.labels[rows, k])]
        y = self.labels[rows, k]
        if not len(rows) or y.min() == y.max():
            return Link(category), []
        words = self.telling(y, rows)
        rest = np.column_stack([self.measures[rows], earlier[rows]])
        center, scale = rest.mean(axis=0), rest.std(axis=0) + 1e-6
        weights = logistic(np.column_stack([self.presence(words, rows), (rest - center) / scale]), y)
        return Link(category, [self.vocabulary[i] for i in words], weights, center, scale), words

    def odds(self, link: Link, words: list[int], rows: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        if link.weights is None:
            return np.full(len(rows), -30.0)
        rest = (np.column_stack([self.measures[rows], earlier[rows]]) - link.center) / link.scale
        return np.clip(np.column_stack([self.presence(words, rows), rest]) @ link.weights[:-1] + link.weights[-1], -30, 30)


def one_per_copy(word: list[np.ndarray], common: np.ndarray, bands: int = 4, rows: int = 5) -> np.ndarray:
    """The group of each row: rows whose min-hashes over words that aren't `common` agree in a band are copies."""
    rng = np.random.default_rng(5)
    odd = (rng.integers(1, 1 << 62, bands * rows, dtype=np.uint64) << np.uint64(1)) + np.uint64(1)
    parent = np.arange(len(word))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first: dict[tuple, int] = {}
    for i, w in enumerate(word):
        rare = w[~common[w]].astype(np.uint64) + np.uint64(1)
        if len(rare):
            mixed = (rare * np.uint64(0x9E3779B97F4A7C15))[:, None] * odd[None, :]
            least = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).min(axis=0)
            for band in range(bands):
                j = first.setdefault((band, *least[band * rows:(band + 1) * rows].tolist()), i)
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(len(word))])


def _slots(words: str) -> np.ndarray:
    return np.array([zlib.crc32(w.encode()) & (1 << 22) - 1 for w in words.split(" ")], dtype=np.int64)


def fit_chain(sample: pd.DataFrame, categories: list[str]) -> list[Link]:
    """The chain from rows (words joined by spaces, measures, labels), in numpy."""
    sample = sample.sort_values(["h", "words"], kind="stable").reset_index(drop=True)
    # Words in fewer than RARE rows can't be chosen; most words are: they are left out by a table of hashed counts first.
    seen = np.zeros(1 << 22, dtype=np.int32)
    for text in sample["words"]:
        np.add.at(seen, _slots(text), 1)
    numbers: dict[str, int] = {}
    word = [np.unique([numbers.setdefault(w, len(numbers)) for w, n in zip(text.split(" "), seen[_slots(text)]) if n >= RARE]).astype(np.int64) for text in sample["words"]]
    del seen
    df = np.bincount(np.concatenate(word), minlength=len(numbers)) if word else np.zeros(0)
    group = one_per_copy(word, df > 0.05 * len(word))
    keep = np.flatnonzero(group == np.arange(len(group)))
    labels = sample[categories].astype(float).groupby(group).mean().loc[keep].to_numpy()
    word = [word[i] for i in keep]
    lengths = [len(w) for w in word]
    examples = Examples(list(numbers), np.repeat(np.arange(len(word)), lengths), np.concatenate(word) if word else np.zeros(0, np.int64),
                        np.array(sample["measures"].iloc[keep].tolist(), dtype=float).reshape(len(keep), _MEASURES), labels)
    every = np.arange(len(keep))
    fold, earlier, chain = every % FOLDS, np.zeros((len(keep), 0)), []
    for k, category in enumerate(categories):
        link, _ = examples.fit(category, k, every, earlier)
        chain.append(link)
        unseen = np.zeros(len(keep))
        for f in range(FOLDS):
            part, words = examples.fit(category, k, every[fold != f], earlier)
            unseen[fold == f] = examples.odds(part, words, every[fold == f], earlier)
        earlier = np.column_stack([earlier, unseen])
    return chain


def training_rows(docs: DataFrame, labels: DataFrame, categories: list[str], sample: int, doc_id: str, text: str) -> DataFrame:
    """One row (words, measures, h, labels) for each of about `sample` labelled ids, however many rows hold it."""
    known = (labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(*[F.max(c).cast("double").alias(c) for c in categories])
             .withColumn("h", F.xxhash64("id")))
    every = -(-known.count() // sample)  # evenly by hash: about `sample` ids, never more than twice as many
    known = known.where(F.pmod("h", F.lit(max(1, every))) == 0).limit(2 * sample)

    @F.arrow_udf("struct<words:string,measures:array<double>>")
    def read(texts: pa.Array) -> pa.Array:
        return pa.array([{"words": " ".join(sorted(words_of(t.as_py()))), "measures": measures(t.as_py())} for t in texts],
                        pa.struct([("words", pa.string()), ("measures", pa.list_(pa.float64()))]))

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
    rows = rows.groupBy("id", "h", *categories).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return rows.select(read("text").alias("r"), "h", *categories).select("r.words", "r.measures", "h", *categories)


def train(docs: DataFrame, labels: DataFrame, categories: list[str], sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> list[Link]:
    """Fit the chain on about `sample` ids of `labels` (doc_id and one 0/1 column per category)."""
    rows = training_rows(docs, labels, categories, sample, doc_id, text)

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"chain": [pickle.dumps(fit_chain(group, categories))]})

    found = rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fitted, "chain binary").collect()  # one row
    return pickle.loads(bytes(found[0].chain)) if found else [Link(c) for c in categories]


def probabilities(text: Column | str, chain: list[Link]) -> Column:
    """A struct with one probability per category of the chain."""
    names = [link.category for link in chain]

    @F.arrow_udf("struct<" + ",".join(f"`{n}`:double" for n in names) + ">")
    def score(texts: pa.Array) -> pa.Array:
        weights = [dict(zip(link.words, link.weights)) if link.weights is not None else {} for link in chain]
        out = []
        for t in texts:
            t = t.as_py()
            words, rest, odds = words_of(t), measures(t), []
            for link, own in zip(chain, weights):
                if link.weights is None:
                    odds.append(-30.0)
                    continue
                x = (np.array(rest + odds) - link.center) / link.scale
                total = sum(own[w] for w in own.keys() & words) + x @ link.weights[len(link.words):-1] + link.weights[-1]
                odds.append(float(np.clip(total, -30, 30)))
            out.append({n: 1 / (1 + float(np.exp(-o))) if o > -30 else 0.0 for n, o in zip(names, odds)})
        return pa.array(out, pa.struct([(n, pa.float64()) for n in names]))

    return score(F.col(text) if isinstance(text, str) else text)
