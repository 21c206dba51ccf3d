"""Prefix trie of conversations: shared beginnings, and the words that keeping them once would save.

1. Every distinct turn (role, text) gets a number from a dictionary, and a conversation becomes the path of its turns' numbers.
2. Equal paths are one, with its count, least conversation and the digest of its conversations' ids: rows sorted by path and id
   stream through the digest, so a path with any number of conversations takes constant memory.
3. Distinct paths are dealt to shards by ranges, in order, so that the paths below a node lie in neighbouring shards. A shard
   puts its paths into a ternary search tree, the middle path first, then the middles of both halves, and so on, which
   balances the choice among a node's children. A child is made after its parent, so going backwards over the nodes meets
   children before parents: one loop sums members, leaves and savings.
4. Only beginnings of a shard's first and last path can go on in other shards. These boundary nodes are returned as parts; all others
   are done. Parts with the same beginning (named by a chained digest) are added up, and their children among themselves last.
   There are at most twice a path's length of them per shard, so this takes one small task.

A conversation is one path, 12 bytes a turn, in one row; nothing else is gathered per conversation or per node.

Defined cases: turns without a conversation id belong to none and are left out; a null role or text is an empty one; turns
go by number, those without one first, those of equal number by a hash of role and text; repeated rows are turns of their
own; an empty text has no words; an empty table has no conversations and gives no rows, not even a root; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblake.llm.simhash import Stage

WORDS = r"[^\x20\x09-\x0D]+"
SHARD_TURNS = 100_000
NO_IDS = hashlib.sha256(b"").hexdigest()


def encode(turns: DataFrame, stage: Stage, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, path): the turns of each conversation in order, as (id, words)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    key = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = stage(turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.unhex(key).alias("key"), F.regexp_count(text, F.lit(WORDS)).alias("words")))
    entries = stage(rows.groupBy("key").agg(F.first("words").alias("words")).withColumn("id", F.monotonically_increasing_id()))
    coded = rows.select("conv_id", "turn", "key").join(entries, "key").withColumn("tie", F.xxhash64("key"))
    paths = coded.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "tie", "id", "words"))).alias("turns"))
    return stage(paths.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].cast("int").alias("words"))).alias("path")))


def ended(convs: DataFrame, stage: Stage) -> DataFrame:
    """A row per distinct path: path, n (its conversations), first (the least), ends_sha256 (of their ids, ascending, comma-joined)."""
    named = convs.select(F.xxhash64("path").alias("h"), F.xxhash64(F.lit(1), "path").alias("g"), "path", "conv_id")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = path = first = digest = None
        n, done = 0, []

        def flush() -> pa.RecordBatch:
            columns = [pa.array([d[0] for d in done], _PATH), *[pa.array([d[k] for d in done], t) for k, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.string()))]]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, ["path", "n", "first", "ends_sha256"])

        for batch in batches:
            own = zip(batch.column("h").to_pylist(), batch.column("g").to_pylist())
            for i, (now, conv) in enumerate(zip(own, batch.column("conv_id").to_pylist())):
                if now != key:
                    if key is not None:
                        done.append((path, n, first, digest.hexdigest()))
                    key, path, first, n, digest = now, batch.column("path")[i].as_py(), conv, 0, hashlib.sha256()
                digest.update(b"%s%d" % (b"," if n else b"", conv))
                n += 1
            yield flush()
        if key is not None:
            done.append((path, n, first, digest.hexdigest()))
            yield flush()

    dealt = named.repartition("h", "g").sortWithinPartitions("h", "g", "conv_id")
    return stage(dealt.mapInArrow(summed, "path array<struct<id:long,words:int>>, n long, first long, ends_sha256 string"))


_PATH = pa.list_(pa.struct([("id", pa.int64()), ("words", pa.int32())]))


class Tree:
    """A ternary search tree of paths; node 0 is the root, a child's number is above its parent's."""

    def __init__(self):
        self.key, self.low, self.high, self.below, self.parent = [0], [-1], [-1], [-1], [-1]
        self.depth, self.words, self.n, self.first, self.ends = [0], [0], [0], [None], [None]

    def _new(self, parent: int, turn: dict) -> int:
        for column, value in ((self.key, turn["id"]), (self.low, -1), (self.high, -1), (self.below, -1), (self.parent, parent), (self.depth, self.depth[parent] + 1),
                              (self.words, turn["words"]), (self.n, 0), (self.first, None), (self.ends, None)):
            column.append(value)
        return len(self.key) - 1

    def child(self, parent: int, turn: dict) -> int:
        """The child of a node by a turn, made if there is none."""
        links, at, wanted = self.below, parent, turn["id"]
        while (node := links[at]) >= 0:
            if wanted == self.key[node]:
                return node
            links, at = self.low if wanted < self.key[node] else self.high, node
        links[at] = node = self._new(parent, turn)
        return node

    def nodes(self, path: list[dict]) -> list[int]:
        """The nodes of a path, root first."""
        out = [0]
        for turn in path:
            out.append(self.child(out[-1], turn))
        return out

    @classmethod
    def of(cls, paths: list[list[dict]], n: list[int], first: list[int], ends: list[str]) -> "Tree":
        """From distinct paths in order: the middle one first, then the middles of what is left on either side."""
        tree, spans = cls(), [(0, len(paths))]
        for a, b in spans:
            if a < b:
                middle = (a + b) // 2
                node = tree.nodes(paths[middle])[-1]
                tree.n[node], tree.first[node], tree.ends[node] = n[middle], first[middle], ends[middle]
                spans += [(a, middle), (middle + 1, b)]
        return tree


_FIELDS = [("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
           ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()), ("words", pa.int64())]
_NODE = ("depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
         "key binary, parent_key binary, words long")


def shard_nodes(paths: list[list[dict]], n: list[int], first: list[int], ends: list[str]) -> Iterator[tuple]:
    """The nodes of one shard's distinct paths, in order (_FIELDS). Those with a `key` are parts: what they have in this shard, besides
    children that are parts themselves."""
    tree = Tree.of(paths, n, first, ends)
    key: dict[int, bytes] = {}
    for path in (paths[0], paths[-1]):
        at = b""
        for node in tree.nodes(path):
            at = hashlib.blake2b(at + (b"%d" % tree.key[node] if node else b""), digest_size=16).digest()
            key[node] = at
    size = len(tree.key)
    members, least, children, leaves, saved = tree.n, tree.first, [0] * size, [0] * size, [0] * size
    for node in range(size - 1, -1, -1):
        part, p = node in key, tree.parent[node]
        if not part:
            leaves[node] = leaves[node] or 1
            saved[node] += (members[node] - 1) * tree.words[node]
            children[p] += 1
            leaves[p] += leaves[node]
            saved[p] += saved[node]
        if p >= 0:
            members[p] += members[node]
            least[p] = least[node] if least[p] is None else min(least[p], least[node])
    for node in range(size):
        part, p = node in key, tree.parent[node]
        yield (tree.depth[node], least[node], None if part or p in key else least[p], members[node], children[node], leaves[node], saved[node],
               tree.ends[node] or (None if part else NO_IDS), key.get(node), key.get(p), tree.words[node])


def merged(parts: pd.DataFrame) -> pd.DataFrame:
    """Boundary nodes, each summed over its shards, with their children among themselves added."""
    rows = {r["key"]: r for r in parts.sort_values("depth", ascending=False).to_dict("records")}
    for r in rows.values():
        r["n_leaves"] = r["n_leaves"] or 1
        r["saved_tokens"] += (r["n_convs"] - 1) * r["words"]
        parent = rows.get(r["parent_key"])
        if parent is not None:
            parent["n_children"] += 1
            parent["n_leaves"] += r["n_leaves"]
            parent["saved_tokens"] += r["saved_tokens"]
    for r in rows.values():
        parent = rows.get(r["parent_key"])
        r["parent_conv_id"], r["ends_sha256"] = parent and parent["conv_id"], r["ends_sha256"] or NO_IDS
    out = pd.DataFrame(list(rows.values()), columns=[f for f, _ in _FIELDS])
    return out.astype({"parent_conv_id": "Int64"})


def nodes(convs: DataFrame, stage: Stage, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of (conv_id, path) rows: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 per node."""
    paths = ended(convs, stage)
    turns = paths.agg(F.sum(F.size("path") + 1)).first()[0] or 0

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches), schema=_ENDED)
        if held.num_rows:
            rows, done = shard_nodes(*(held.column(c).to_pylist() for c in _ENDED.names)), []
            for row in rows:
                done.append(row)
                if len(done) == 10_000:
                    yield _batch(done)
                    done = []
            yield _batch(done)

    ranges = paths.repartitionByRange(max(1, -(-turns // shard_turns)), "path").sortWithinPartitions("path")
    found = stage(ranges.mapInArrow(built, _NODE))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = found.where("key IS NOT NULL").groupBy("key").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"), *sums,
        F.max("ends_sha256").alias("ends_sha256"), F.first("parent_key").alias("parent_key"), F.first("words").alias("words"))
    boundary = stage(parts.select(*[f for f, _ in _FIELDS]).groupBy(F.lit("all")).applyInPandas(merged, _NODE))
    above = boundary.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    inner = found.where("key IS NULL").join(above, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return inner.select(*out).unionByName(boundary.select(*out))


_ENDED = pa.schema([("path", _PATH), ("n", pa.int64()), ("first", pa.int64()), ("ends_sha256", pa.string())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _FIELDS)] if rows else [pa.array([], t) for _, t in _FIELDS], [f for f, _ in _FIELDS])


def grafted(convs: DataFrame, stage: Stage, every: int = 20, most: int = 3, taken: Column | None = None) -> DataFrame:
    """Conversations whose first `taken` turns (an expression of conv_id, at most `most`) are those of conversation conv_id - conv_id % every."""
    heads = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("head_id"), F.slice("path", 1, most).alias("head"))
    rows = convs.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % every).join(heads, "head_id", "left").withColumn("h", taken.cast("int"))
    own = F.slice("path", F.col("h") + 1, F.greatest(F.size("path") - F.col("h"), F.lit(0)))
    head = F.when(F.col("head").isNull(), F.slice("path", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    return stage(rows.select("conv_id", F.concat(head, own).alias("path")))
