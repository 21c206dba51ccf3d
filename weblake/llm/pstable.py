"""Near-duplicate embeddings by Euclidean p-stable hashing, checked exactly.

Vectors are scaled to length 1, so a cosine of c is a distance of sqrt(2 - 2c). A hash is floor((a.v + b) / width), with
a Gaussian vector a and an offset b; `hashes` of them name a bucket of a table. How often two vectors at a distance share a
bucket is known (`meeting`), which gives both numbers from the count of vectors: as many hashes as leave about `crowd` unrelated
vectors in a bucket, and as many tables as miss a pair at the limit with probability `miss` at most. Pairs nearer
than the limit are missed less often by far.

1. Equal vectors of a label are one point, with a count, so copies cost nothing.
2. Every point says its bucket in each table. Buckets of one point, or whose points all share their bucket in the first
   table (their pairs are found there), are left out before any vector is moved.
3. A bucket of over `part_rows` is dealt in parts, and a group is a pair of parts (or a part with itself); smaller buckets share
   groups of about that size. A group compares in blocks and keeps the pairs whose cosine, in double precision, reaches the
   limit and that share no bucket in an earlier table. Each pair is so counted once.
4. A group returns a row per point of a bucket: its number of links, and the least point it joined it to. No pairs are emitted. Links are
   summed per point; the joined points make components by alternating star steps.

Work within a bucket of distinct near copies is the square of its size, as their number of links asks for; it is spread
over tasks, and a row is copied once per part of its bucket.

Defined cases: vectors that are null, empty or zero, or hold a null, NaN or infinity, and vectors without a label link with
nothing; vectors of different lengths aren't compared; every row is a vector of its own, so repeated rows link with each other
and an id that several rows share counts each; a row without an id takes part, the least id of its component being that of the
others (null if there is none), and is kept only in a component of such rows; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblake.llm.simhash import Stage, connected

WIDTH, CROWD, MISS, PART_ROWS, BLOCK = 2.0, 1000, 1e-5, 4096, 512


def meeting(distance: float, width: float) -> float:
    """Probability that one hash of two vectors at a distance is the same."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


@dataclass(frozen=True)
class Tables:
    """`tables` tables of `hashes` hashes each."""

    tables: int
    hashes: int
    width: float = WIDTH
    seed: int = 7

    @classmethod
    def of(cls, points: int, least: float, crowd: int = CROWD, miss: float = MISS, width: float = WIDTH) -> "Tables":
        """For a number of points of which unrelated ones stand at right angles."""
        apart, near = meeting(math.sqrt(2), width), meeting(math.sqrt(max(2 - 2 * least, 1e-12)), width)
        hashes = max(1, math.ceil(math.log(max(points, crowd) / crowd) / -math.log(apart)))
        return cls(max(1, math.ceil(math.log(miss) / math.log1p(-near ** hashes))), hashes, width)

    def buckets(self, unit: np.ndarray, group: np.ndarray) -> np.ndarray:
        """A row per vector: the bucket in each table, as 64-bit numbers that differ by table and by `group`, too."""
        made = np.random.default_rng([self.seed, unit.shape[1]])
        lines = made.standard_normal((unit.shape[1], self.tables * self.hashes))
        cells = np.floor((unit @ lines + made.uniform(0, self.width, lines.shape[1])) / self.width).astype(np.int64)
        cells = cells.reshape(len(unit), self.tables, self.hashes).astype(np.uint64)
        out = _mixed(group.astype(np.uint64)[:, None] * np.uint64(self.tables) + np.arange(self.tables, dtype=np.uint64))
        for h in range(self.hashes):
            out = _mixed(out ^ cells[:, :, h])
        return out.view(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB) + np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(31))


def scaled(rows: np.ndarray) -> np.ndarray:
    """Vectors of length 1."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("nd,nd->n", rows, rows))[:, None]


class _Joined:
    """Least member of each group of rows that links have joined."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            low = np.minimum(x, y)
            np.minimum.at(root, x, low)
            np.minimum.at(root, y, low)
            while not np.array_equal(up := root[root], root):
                root = up
            self.root = root


def links_in(unit: np.ndarray, keys: np.ndarray, copies: np.ndarray, side: np.ndarray | None, table: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of rows that share a bucket of `table`, ordered by their bucket in the first table: per row the copies that it links with, by
    pairs without an earlier bucket in common, and the least row it is joined to. `side`: only pairs of rows on different sides count."""
    n, joined = len(unit), _Joined(len(unit))
    counts = np.zeros(n, dtype=np.int64)
    ends = np.searchsorted(keys[:, 0], keys[:, 0], side="right") if table else np.arange(1, n + 1)
    for a in range(0, n, BLOCK):
        b = min(a + BLOCK, n)
        for c in range(int(ends[a]), n, 8 * BLOCK):
            d = min(c + 8 * BLOCK, n)
            near = unit[a:b] @ unit[c:d].T >= least
            near &= np.arange(c, d)[None, :] >= ends[a:b, None]
            if side is not None:
                near &= side[a:b, None] != side[None, c:d]
            i, j = np.nonzero(near)
            i, j = i + a, j + c
            for t in range(1, table):
                fresh = keys[i, t] != keys[j, t]
                i, j = i[fresh], j[fresh]
            np.add.at(counts, i, copies[j])
            np.add.at(counts, j, copies[i])
            joined.link(i, j)
    return counts, joined.root


def near_duplicates(vectors: DataFrame, least: float = 0.93, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                    part_rows: int = PART_ROWS, crowd: int = CROWD, miss: float = MISS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row."""
    stage = Stage(vectors.sparkSession, "pstable")
    v = F.col("v")
    usable = v.isNotNull() & F.col("label").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("v", F.when(usable, F.transform(v, lambda x: x + 0.0))).withColumn("digest", _digest("v", F.col("label").cast("string")))
    rows = stage(rows)
    points = rows.where("v IS NOT NULL").groupBy("digest").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"), F.first("label").alias("label"), F.first("v").alias("v"))
    points = stage(points.withColumn("point", F.monotonically_increasing_id()).withColumn("group", F.xxhash64(F.col("label").cast("string"), F.size("v"))))
    total = max(1, points.count())
    tables = Tables.of(total, least, crowd, miss)
    points = stage(points.drop("label").mapInArrow(_placed(tables), "digest binary, point long, copies long, first long, v array<double>, keys array<long>"))

    said = points.select("point", F.col("keys")[0].alias("k0"), F.posexplode("keys").alias("table", "bucket"))
    size = said.groupBy("table", "bucket").agg(F.count("*").alias("n"), F.min("k0").alias("lo"), F.max("k0").alias("hi"))
    size = size.where((F.col("n") > 1) & ((F.col("table") == 0) | (F.col("lo") != F.col("hi")))).select("table", "bucket", F.ceil(F.col("n") / part_rows).cast("int").alias("parts"))
    asked = said.select("point", "table", "bucket").join(size, ["table", "bucket"])
    asked = asked.withColumn("mine", F.pmod(F.xxhash64("point"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    shared = F.when(F.col("parts") == 1, F.pmod("bucket", F.lit(-(-total // part_rows)))).otherwise(F.col("bucket"))
    dealt = asked.select("point", "table", "bucket", "mine", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "parts", shared.alias("share"))
    work = dealt.join(points.select("point", "copies", "v", "keys"), "point")

    def compared(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.stack(group["keys"].to_numpy())
        order = np.lexsort((group["point"].to_numpy(), keys[:, 0], group["bucket"].to_numpy()))
        group, keys = group.iloc[order], keys[order]
        point, bucket, copies, mine = (group[c].to_numpy() for c in ("point", "bucket", "copies", "mine"))
        two, table = group["p"].iloc[0] != group["q"].iloc[0], int(group["table"].iloc[0])
        size = np.fromiter(map(len, group["v"]), dtype=np.int64)
        ends = np.flatnonzero((bucket[1:] != bucket[:-1]) | (size[1:] != size[:-1])) + 1
        n, root = np.zeros(len(point), dtype=np.int64), np.arange(len(point))
        for a, b in zip([0, *ends], [*ends, len(point)]):
            if b - a > 1 and not (table and keys[a, 0] == keys[b - 1, 0]):
                unit = scaled(np.stack(group["v"].to_numpy()[a:b]))
                n[a:b], own = links_in(unit, keys[a:b], copies[a:b], mine[a:b] if two else None, table, least)
                root[a:b] = own + a
        linked = n > 0
        return pd.DataFrame({"point": point[linked], "n": n[linked], "root": point[root[linked]]})

    found = stage(work.groupBy("table", "parts", "share", "p", "q").applyInPandas(compared, "point long, n long, root long"))
    roots = connected(found.select(F.col("point").alias("a"), F.col("root").alias("b")), stage).withColumnRenamed("node", "point")
    own = (points.select("digest", "point", "copies", "first")
           .join(found.groupBy("point").agg(F.sum("n").alias("n")), "point", "left")
           .join(roots, "point", "left").withColumn("root", F.coalesce("root", "point")))
    first = own.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stage(own.join(first, "root").select("digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    alone = F.col("v").isNull()
    out = rows.where(~alone).select("vec_id", "digest").join(named, "digest").select("vec_id", "n_links", "component_id")
    out = out.unionByName(rows.where(alone).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _digest(vector: str, label):
    """128 bits of a vector and its label, null for a null vector."""
    @F.arrow_udf("binary")
    def of(vectors: pa.Array, labels: pa.Array) -> pa.Array:
        flat, out = np.asarray(vectors.values), []
        ends = np.asarray(vectors.offsets)
        for k, ok in enumerate(vectors.is_valid().to_pylist()):
            of_label = hashlib.blake2b(digest_size=16, key=hashlib.blake2b((labels[k].as_py() or "").encode(), digest_size=32).digest())
            of_label.update(flat[ends[k]: ends[k + 1]].tobytes())
            out.append(of_label.digest() if ok else None)
        return pa.array(out, pa.binary())

    return of(F.col(vector), label)


def _placed(tables: Tables):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            vectors = batch.column("v")
            size, flat, start = np.diff(np.asarray(vectors.offsets)), np.asarray(vectors.values), np.asarray(vectors.offsets)[:-1]
            group = np.asarray(batch.column("group"))
            for dim in np.unique(size):
                for at in np.array_split(np.flatnonzero(size == dim), 1 + int((size == dim).sum()) // 1024):
                    keys = tables.buckets(scaled(flat[start[at, None] + np.arange(dim)].astype(np.float64)), group[at])
                    part = table.take(pa.array(at)).select(["digest", "point", "copies", "first", "v"])
                    yield from part.append_column("keys", pa.array(list(keys), pa.list_(pa.int64()))).combine_chunks().to_batches()

    return place
