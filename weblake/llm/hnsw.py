"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Vectors are dealt to shards by hash, equal vectors counting once (they keep their smallest ids, one more than
asked for, which is all that a result can need). A shard's graph has layers, each a sample of the one
below. A node's neighbours in a layer are its nearest ones there, thinned so that they lie in different
directions, and the links back; a whole layer's candidates come from blocked matrix products, as a
shard's size is bounded. The graph is stored flat: one array of neighbour numbers per layer, a fixed
number of places per node, -1 for none, written with the shard's vectors to the shared folder.

Queries go to every shard in blocks. All queries of a block go down the layers together: greedy steps above,
a beam of `ef` in the lowest layer. Each shard returns its `k` best per query, and these are merged.

Inner products are made distances by one further component that gives all vectors of a shard the same
length; the scores returned are inner products of the original vectors in double precision.

Defined cases: vectors that are null, zero, empty or hold null or non-finite components take no part, neither
do rows without an id; vectors of different lengths never meet; of repeated rows one counts; ties go to the smaller id; a
query's own id is no result; with fewer candidates than `k` all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weblake.llm.simhash import Stage

SHARD_ROWS, LINKS, EF, BLOCK, SEED = 8192, 16, 128, 1024, 3
_INDEX = "shard long, dim int, vectors binary, ids binary, ends binary, levels array<binary>, nodes array<binary>"


class Graph:
    """levels[l]: (nodes of layer l, their neighbours as a flat array of `width` places each); layer 0 holds all."""

    def __init__(self, vectors: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors, self.levels = vectors, levels
        self.lifted = self.lift(vectors)

    @staticmethod
    def lift(vectors: np.ndarray) -> np.ndarray:
        """One more component, so that all vectors are as long as the longest: nearest is then largest inner product."""
        square = (vectors * vectors).sum(axis=1)
        return np.column_stack([vectors, np.sqrt(np.maximum(square.max(initial=0) - square, 0))]).astype(np.float32)

    @classmethod
    def build(cls, vectors: np.ndarray, links: int = LINKS, seed: int = SEED) -> "Graph":
        graph = cls(vectors, [])
        top = np.floor(-np.log(1 - np.random.default_rng(seed).random(len(vectors))) / np.log(links)).astype(int)
        for level in range(top.max(initial=0) + 1):
            nodes = np.flatnonzero(top >= level)
            graph.levels.append((nodes, graph._link(nodes, 2 * links if level == 0 else links)))
        return graph

    def _link(self, nodes: np.ndarray, width: int) -> np.ndarray:
        x, n = self.lifted[nodes], len(nodes)
        places = np.full((n, width), -1, dtype=np.int32)
        near = min(n - 1, 2 * width)
        if near < 1:
            return places
        back: list[list[int]] = [[] for _ in range(n)]
        for at in range(0, n, 256):
            rows = np.arange(at, min(at + 256, n))
            closeness = x[rows] @ x.T
            closeness[np.arange(len(rows)), rows] = -np.inf
            found = np.argpartition(-closeness, near - 1, axis=1)[:, :near]
            found = np.take_along_axis(found, np.argsort(-np.take_along_axis(closeness, found, 1), axis=1, kind="stable"), 1)
            among = x[found] @ x[found].transpose(0, 2, 1)
            own = np.take_along_axis(closeness, found, 1)
            kept = np.zeros(found.shape, dtype=bool)
            for j in range(near):  # keep a candidate nearer to the node than to any kept one
                kept[:, j] = ~((among[:, j, :j] > own[:, j, None]) & kept[:, :j]).any(axis=1)
            order = np.argsort(~kept, axis=1, kind="stable")[:, : width // 2 + width // 4]  # the others fill up
            chosen = np.take_along_axis(found, order, 1)
            places[rows, : chosen.shape[1]] = chosen
            for r, c in zip(rows, chosen):
                for other in c[: width // 2]:
                    back[other].append(r)
        used = (places >= 0).sum(axis=1)
        for i, sources in enumerate(back):
            room = width - used[i]
            new = [s for s in sources if s not in places[i, :used[i]]][:room]
            places[i, used[i]: used[i] + len(new)] = new
        return places

    def search(self, queries: np.ndarray, k: int, ef: int = EF) -> tuple[np.ndarray, np.ndarray]:
        """Per query the numbers and closeness (single precision) of the `ef` (at least k) best vectors met, -1 for none."""
        q, n, m = np.column_stack([queries, np.zeros(len(queries))]).astype(np.float32), len(self.vectors), len(queries)
        at = np.full(m, self.levels[-1][0][0])
        for nodes, places in reversed(self.levels[1:]):  # greedy
            row = np.full(n, -1)
            row[nodes] = np.arange(len(nodes))
            best = np.einsum("md,md->m", q, self.lifted[at])
            moving = np.arange(m)
            while len(moving):
                to = places[row[at[moving]]]
                other = nodes[np.maximum(to, 0)]
                c = np.where(to >= 0, np.einsum("md,mjd->mj", q[moving], self.lifted[other]), -np.inf)
                j = c.argmax(axis=1)
                value = c[np.arange(len(moving)), j]
                better = value > best[moving]
                at[moving[better]], best[moving[better]] = other[better, j[better]], value[better]
                moving = moving[better]
        return self._beam(q, at, max(k, ef), self.levels[0][1])

    def _beam(self, q: np.ndarray, start: np.ndarray, ef: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m, n, step = len(q), len(self.vectors), 4
        seen = np.zeros((m, n), dtype=bool)
        beam = np.full((m, ef), -1, dtype=np.int64)
        value = np.full((m, ef), -np.inf, dtype=np.float32)
        done = np.ones((m, ef), dtype=bool)
        rows = np.arange(m)
        beam[:, 0], value[:, 0], done[:, 0] = start, np.einsum("md,md->m", q, self.lifted[start]), False
        seen[rows, start] = True
        while len(rows):
            # the nearest unexpanded nodes of each beam; a beam without one is finished
            order = np.argsort(np.where(done[rows], np.inf, -value[rows]), axis=1, kind="stable")[:, :step]
            pick = ~np.take_along_axis(done[rows], order, 1)
            live = pick.any(axis=1)
            rows, order, pick = rows[live], order[live], pick[live]
            if not len(rows):
                break
            done[rows[:, None], order] = True
            to = np.where(pick[:, :, None], places[np.maximum(beam[rows[:, None], order], 0)], -1).reshape(len(rows), -1)
            to = np.sort(to, axis=1)
            to[:, 1:][to[:, 1:] == to[:, :-1]] = -1
            new = (to >= 0) & ~seen[rows[:, None], np.maximum(to, 0)]
            i, j = np.nonzero(new)
            seen[rows[i], to[i, j]] = True
            c = np.full(to.shape, -np.inf, dtype=np.float32)
            c[i, j] = np.einsum("ed,ed->e", q[rows[i]], self.lifted[to[i, j]])
            both_v = np.concatenate([value[rows], c], axis=1)
            both_n = np.concatenate([beam[rows], np.where(new, to, -1)], axis=1)
            both_d = np.concatenate([done[rows], ~new], axis=1)
            top = np.argpartition(-both_v, ef - 1, axis=1)[:, :ef]
            value[rows], beam[rows], done[rows] = (np.take_along_axis(x, top, 1) for x in (both_v, both_n, both_d))
        return beam, value


def usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & ok & F.exists(vector, lambda x: x != 0)


def build_index(vectors: DataFrame, stage: Stage, keep: int, shard_rows: int = SHARD_ROWS) -> tuple[int, Column, DataFrame]:
    """The number of shards, that of the vectors of length `dim`, and a row per shard (_INDEX) of a table (id, v): vectors, the ids of each (at most `keep`, smallest first) and the layers."""
    spread = vectors.distinct().withColumn("rank", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("rank") <= keep)
    kept = stage(spread.select("id", "v", F.xxhash64("v").alias("h"), F.size("v").alias("dim")))
    sizes = {r.dim: r.n for r in kept.groupBy("dim").agg(F.count_distinct("h").alias("n")).collect()}  # a row per vector length
    shards = F.lit(1)
    for dim, n in sizes.items():
        shards = F.when(F.col("dim") == dim, F.lit(-(-n // shard_rows))).otherwise(shards)

    def built(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["h", "id"], kind="stable")
        x = np.stack(group["v"].to_numpy()).astype(np.float64)
        x, number = np.unique(x, axis=0, return_inverse=True)
        order = np.argsort(number.reshape(-1), kind="stable")
        ids, counts = group["id"].to_numpy(np.int64)[order], np.bincount(number.reshape(-1), minlength=len(x))
        graph = Graph.build(x)
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "dim": [x.shape[1]], "vectors": [x.tobytes()], "ids": [ids.tobytes()],
                             "ends": [np.cumsum(counts).tobytes()], "levels": [[p.astype(np.int32).tobytes() for _, p in graph.levels]],
                             "nodes": [[n.astype(np.int64).tobytes() for n, _ in graph.levels]]})

    dealt = kept.withColumn("shard", F.pmod("h", shards))
    return sum(-(-n // shard_rows) for n in sizes.values()), shards, stage(dealt.groupBy("dim", "shard").applyInPandas(built, _INDEX))


def load(row: dict) -> tuple[Graph, np.ndarray, np.ndarray]:
    """The graph of an index row, its ids, and where each vector's ids end."""
    x = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
    levels = []
    for nodes, places in zip(row["nodes"], row["levels"]):
        nodes = np.frombuffer(nodes, np.int64)
        levels.append((nodes, np.frombuffer(places, np.int32).reshape(len(nodes), -1)))
    return Graph(x, levels), np.frombuffer(row["ids"], np.int64), np.frombuffer(row["ends"], np.int64)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", ef: int = EF,
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row for which `is_query` holds."""
    spark = vectors.sparkSession
    stage = Stage(spark, "hnsw")
    rows = vectors.where(usable(F.col(vector)) & F.col(vec_id).isNotNull())
    one = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    total, shards, index = build_index(one, stage, k + 1, shard_rows)
    queries = rows.where(is_query).select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).distinct()
    blocks = max(1, -(-queries.count() // BLOCK))
    queries = queries.select("id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
    packed = stage(queries.groupBy("dim", "block").agg(F.collect_list("id").alias("qids"), F.flatten(F.collect_list("v")).alias("q")))
    tasks = max(1, 2 * total)  # given, so that small shards aren't merged into few tasks
    asked = packed.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), shards.cast("long") - 1)).alias("shard"), "qids", "q")
    work = asked.repartition(tasks, "dim", "shard").join(index.repartition(tasks, "dim", "shard"), ["dim", "shard"])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                graph, ids, ends = load(row)
                qids, q = np.array(row["qids"]), np.array(row["q"]).reshape(-1, row["dim"])
                out = []
                for at in range(0, len(qids), 256):
                    found, _ = graph.search(q[at:at + 256], k + 1, ef)
                    for own, x, numbers in zip(qids[at:at + 256], q[at:at + 256], found):
                        numbers = numbers[numbers >= 0]
                        score = np.array([float(np.dot(x, graph.vectors[n])) for n in numbers])
                        begin = np.where(numbers > 0, ends[numbers - 1], 0)
                        each = [(s, v) for s, b, e in zip(score, begin, ends[numbers]) for v in ids[b:e].tolist() if v != own]
                        out += [(own, v, s) for s, v in sorted(each, key=lambda t: (-t[0], t[1]))[:k]]
                if out:
                    a, b, c = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], ["query_id", "vec_id", "score"])

    found = work.mapInArrow(searched, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
