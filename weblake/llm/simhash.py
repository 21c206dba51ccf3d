"""SimHash near-duplicates by vantage-point trees over 64-bit fingerprints.

A fingerprint takes the majority bit of the XXH64 (seed 42) of all word shingles of a text. Equal
fingerprints are grouped first, so copies count once. The distinct fingerprints are then
partitioned by their Hamming distances to a few vantage points: the levels of a tree whose nodes have
one branch per distance. Two fingerprints at most r bits apart lie in branches at most r apart at
every level (triangle inequality), and their distances to a vantage point differ by an even or odd
number as their own distance is even or odd. A fingerprint is therefore a member of its own shard and
visits only the shards that those bounds leave open, each pair of shards one way round. The number of
levels follows from the number of fingerprints; a crowded shard is searched by several tasks, each
with its share of the queries. Within a shard a binary vantage-point tree is built and all
queries go down it together, pruned by the same bound; leaves are compared exactly.

No pairs are emitted: each shard joins what it has linked and returns a star per group (at most one
row per fingerprint in it). The stars are joined to components by alternating large-star and small-star
steps, each written to the shared folder; a hub's neighbours are never gathered in one task.

Random fingerprints lie near 32 bits from every vantage point, so the work grows about as n^1.4.

Defined cases: a null or empty text has fingerprint zero, linked like any other; rows without a doc_id
take part, and a component of such rows alone has a null id; repeated rows get equal results; an
empty table gives no rows; other columns are left out by `components` and kept by `keep_first`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblake.llm.names import free_prefix
from weblake.session import checkpoint_dir

SAMPLE, SHARD_ROWS, LEAF, MAX_LEVELS = 2048, 4000, 256, 8


def fingerprint(text: str | None, words: int = 3) -> int:
    """The fingerprint of one whole text, as an unsigned number."""
    found = text.encode().lower().split() if text else []
    if not found:
        return 0
    joined, n = b" ".join(found), max(1, len(found) - words + 1)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[words - 1:].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at: at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column | str, words: int = 3) -> Column:
    """The fingerprint of each text as a long (the same 64 bits)."""
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), words) for t in texts], dtype=np.uint64).view(np.int64))

    return of(F.col(text) if isinstance(text, str) else text)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b)).astype(np.int16)


def vantage_points(sample: np.ndarray, levels: int) -> np.ndarray:
    """`levels` points of a sample, each chosen to split the sample into as many and as even shards as it can."""
    cells, chosen = np.zeros(len(sample), dtype=np.int64), []
    for _ in range(levels):
        best = None
        for v in sample[:64]:
            split = cells * 65 + distance(sample, v)
            crowd = np.square(np.unique(split, return_counts=True)[1].astype(np.int64)).sum()
            if best is None or crowd < best[0]:
                best = crowd, v, split
        chosen.append(best[1])
        cells = np.unique(best[2], return_inverse=True)[1].astype(np.int64)
    return np.array(chosen, dtype=np.uint64)


def open_branches(levels: int, bits: int) -> np.ndarray:
    """Differences of shard paths that two fingerprints at most `bits` apart can have, one of each sign."""
    found = {d for apart in range(bits + 1) for d in product(range(-apart, apart + 1, 2), repeat=levels)}
    back = sorted(d for d in found if d < (0,) * levels)
    return np.array(back, dtype=np.int64).reshape(len(back), levels)


def search(targets: np.ndarray, queries: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs at most `bits` apart, as (fingerprints of queries, of targets), block by block: a
    vantage-point tree over the targets, all queries going down together."""
    work = [(targets, queries)]
    while work:
        t, q = work.pop()
        if not len(t) or not len(q):
            continue
        if len(t) > LEAF:
            v = t[len(t) // 2]
            dt, dq = distance(t, v), distance(q, v)
            middle = int(np.median(dt))
            inside = dt <= middle
            if 0 < inside.sum() < len(t):
                work += [(t[inside], q[dq <= middle + bits]), (t[~inside], q[dq > middle - bits])]
                continue
        for at in range(0, len(t), LEAF):
            for k in range(0, len(q), 4096):
                x, y = t[at: at + LEAF], q[k: k + 4096]
                i, j = np.nonzero(distance(y[:, None], x[None, :]) <= bits)
                if len(i):
                    yield y[i], x[j]


def stars(targets: np.ndarray, queries: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups that the links of a shard join, as (fingerprint, least fingerprint of its group) for each other one."""
    points = np.unique(np.concatenate([targets, queries]))
    root = np.arange(len(points))
    for a, b in search(np.unique(targets), np.unique(queries), bits):
        a, b = np.searchsorted(points, a), np.searchsorted(points, b)
        while True:
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            low = np.minimum(x, y)
            np.minimum.at(root, x, low)
            np.minimum.at(root, y, low)
            while not np.array_equal(up := root[root], root):
                root = up
    other = root != np.arange(len(points))
    return points[other], points[root[other]]


class Stage:
    """Tables cut from their lineage, in one folder of the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.n = spark, f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(f"{self.folder}/{self.n}")
        return self.spark.read.parquet(f"{self.folder}/{self.n}")


def links(points: DataFrame, bits: int, stage: Stage, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b) edges that join all fingerprints `fp` (distinct longs) at most `bits` apart."""
    total = points.count()
    sample = np.array([r.fp for r in points.where(F.pmod(F.xxhash64("fp"), F.lit(max(1, total // SAMPLE))) == 0).limit(2 * SAMPLE).collect()], dtype=np.int64).view(np.uint64)
    levels = 0
    while total * 0.1 ** levels > shard_rows and levels < MAX_LEVELS:  # at most about a tenth have one distance
        levels += 1
    vantage, moves = vantage_points(sample, levels), open_branches(levels, bits)
    scale = 66 ** np.arange(levels, dtype=np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.asarray(b.column(0))
            path = np.stack([distance(fp.view(np.uint64), v) for v in vantage], axis=1).astype(np.int64) if levels else np.zeros((len(fp), 0), np.int64)
            yield pa.RecordBatch.from_pydict({"shard": path @ scale, "fp": fp, "member": np.ones(len(fp), bool)})
            for move in moves:
                to = path + move
                there = ((to >= 0) & (to <= 64)).all(axis=1)
                yield pa.RecordBatch.from_pydict({"shard": to[there] @ scale, "fp": fp[there], "member": np.zeros(there.sum(), bool)})

    placed = stage(points.select("fp").mapInArrow(place, "shard long, fp long, member boolean"))
    size = placed.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(shard_rows)).cast("int").alias("parts"))
    spread = placed.join(size, "shard").withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    spread = spread.select("shard", "fp", "member", "mine", F.explode(F.when(F.col("member"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("mine"))).alias("part"))

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        fp = group["fp"].to_numpy().view(np.uint64)
        asked = (group["part"] == group["mine"]).to_numpy()
        a, b = stars(fp[group["member"].to_numpy()], fp[asked], bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return stage(spread.groupBy("shard", "part").applyInPandas(joined, "a long, b long").distinct())


def connected(edges: DataFrame, stage: Stage) -> DataFrame:
    """(node, root): the least node reachable, for every node of an edge, by alternating star steps."""
    def stars_of(pairs: DataFrame) -> DataFrame:
        """Pairs (u, v) -> each v, and u, to the least of u and all its v."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return pairs.join(least, "u")

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    before = None
    while (seen := state(now)) != before:
        before = seen
        both = now.union(now.select("v", "u"))
        large = stars_of(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = stars_of(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", "m")).where("u != v").distinct()
        now = stage(small)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def components(docs: DataFrame, words: int = 3, bits: int = 2, doc_id: str = "doc_id", text: str = "text", key: Column | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, fp, component_id (least doc_id among all linked rows, null ones aside); `key`
    adds a column computed from `docs`."""
    stage = Stage(docs.sparkSession, "simhash")
    columns = [F.col(doc_id).alias("doc_id"), fingerprints(text, words).alias("fp")] + ([key.alias("key")] if key is not None else [])
    rows = stage(docs.select(*columns))
    points = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = connected(links(points, bits, stage), stage)
    rooted = points.join(roots, points.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stage(rooted.join(groups, "root").select("fp", "component_id"))
    return rows.join(named, "fp")


def keep_first(docs: DataFrame, words: int = 3, bits: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows and columns of one document per component: that of the least (doc_id, hash of the text), nulls last, once."""
    hashed = F.xxhash64(F.col(text))
    found = components(docs, words, bits, doc_id, text, key=hashed)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp").cast("string")))
    kept = found.withColumn("group", group).groupBy("group").agg(F.min(place).alias("k")).select("k.doc_id", "k.key")
    mark = F.struct(F.col(doc_id).alias("doc_id"), hashed.alias("key"))
    own = free_prefix(docs, "__simhash_")
    rows = docs.withColumn(own, mark)
    kept = kept.select(F.col("doc_id").alias(own + "id"), F.col("key").alias(own + "key"))
    rows = rows.join(kept, F.col(own + ".doc_id").eqNullSafe(F.col(own + "id")) & (F.col(own + ".key") == F.col(own + "key")), "left_semi")
    return rows.dropDuplicates([own]).select(*[F.col(f"`{c}`") for c in docs.columns])
