"""Periodic runs of words, the conversation prefix trie, near-duplicate embeddings by p-stable hashing."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from odd_rows import no_docs, odd_docs  # noqa: F401
from weblake.llm import prefixtrie, pstable, wordruns
from weblake.llm.queries import QUERIES
from weblake.llm.simhash import Stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# periodic runs

def runs(words, shortest=6, times=4):
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - first + q >= max(shortest, times * q):
                found.setdefault((first - q, i - first + q), q)
    return sorted(((s, k, q) for (s, k), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("shortest,times", [(6, 4), (4, 2), (2, 2), (9, 3)])
def test_runs_equal_brute_force(shortest, times):
    made = random.Random(5)
    for _ in range(3000):
        letters, words = "abcde"[: made.choice([1, 2, 2, 3, 5])], []
        while len(words) < made.randint(0, 60):
            words += [made.choice(letters) for _ in range(made.randint(1, 5))] * made.choice([1, 1, 2, 3, 6])
        words *= made.choice([1, 1, 1, 2, 5])
        assert wordruns.find_runs([w.encode() for w in words], shortest, times) == runs(words, shortest, times)


def test_nested_stretches_take_few_steps():
    line = [b"-"] * 20 + [b"|"]
    found = wordruns.find_runs(line * 3000)
    assert len(found) == 3001 and (0, 63000, 21) in found
    assert wordruns.find_runs([b"ha"] * 300_000) == [(0, 300_000, 1)]


def test_collapsed_texts(spark, odd_docs, no_docs):
    found = odd_docs.select("doc_id", "text", wordruns.periodic_runs("text").alias("r")).collect()
    assert len(found) == odd_docs.count()
    for r in found:
        words = WORD.findall(r.text or "")
        assert [tuple(x) for x in r.r.runs] == runs(words) and r.r.collapsed == collapsed(words, runs(words))
    assert no_docs.select(wordruns.periodic_runs("text")).count() == 0


def test_op13_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = QUERIES["op13_word_runs"](spark, SF001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        words = WORD.findall(docs[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if n > 3000:
            continue  # the brute force compares all lags
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = runs(words)
        s, k, q = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
        assert tuple(r) == (r.doc_id, len(found), s, k, q, k and 1000 * k // q, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, found).encode()).hexdigest())
    assert sum(r.n_runs for r in rows)


# prefix trie

def trie(paths):
    """{prefix: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)}; paths: {conv_id: ((role, text), ...)}"""
    members = defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    kids = defaultdict(int)
    for p in members:
        kids[p[:-1]] += bool(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
    ends = {p: ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p)) for p, m in members.items()}
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in members.items())


def rows_of(found):
    return sorted(tuple(-1 if v is None else v for v in r) for r in found.collect())


@pytest.mark.parametrize("shard_turns", [3, 40, 100_000])
def test_trie_equals_brute_force(spark, shard_turns):
    made = random.Random(shard_turns)
    paths = {c: tuple(("user", "word " * made.randint(0, 3)) for _ in range(made.choice([0, 1, 2, 3, 4, 9]))) for c in range(120)}
    paths[500] = tuple(("user", "word") for _ in range(400))
    turns = spark.createDataFrame([(c, d, *t) for c, path in paths.items() for d, t in enumerate(path)], "conv_id long, turn long, role string, text string")
    stage = Stage(spark, "trie")
    convs = prefixtrie.encode(turns, stage).select("conv_id", "path")
    empty = spark.createDataFrame([(c,) for c, p in paths.items() if not p], "conv_id long").select("conv_id", F.slice(F.array(F.struct(F.lit(0).cast("long").alias("id"), F.lit(0).alias("words"))), 1, 0).alias("path"))
    assert rows_of(prefixtrie.nodes(convs.unionByName(empty), stage, shard_turns)) == trie(paths)


def test_trie_of_odd_turns(spark):
    rows = [(None, 0, "user", "nobody's"), (1, None, "user", None), (1, 0, None, "b c"), (1, 0, None, "b c"), (2, None, "user", ""), (2, 5, "", "b c"), (3, 1, "user", "x" * 100_000), (-4, 1, "user", "x" * 100_000)]
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n_convs int, path string")
    stage = Stage(spark, "trie")
    long_turn = (("user", "x" * 100_000),)
    want = {1: (("user", ""), ("", "b c"), ("", "b c")), 2: (("user", ""), ("", "b c")), 3: long_turn, -4: long_turn}
    assert rows_of(prefixtrie.nodes(prefixtrie.encode(turns, stage), stage)) == trie(want)
    assert prefixtrie.nodes(prefixtrie.encode(turns.limit(0), stage), stage).count() == 0


def test_grafted_conversations(spark):
    turns = spark.createDataFrame([(c, d, "user", f"{c} {d}") for c, n in ((0, 2), (7, 5), (9, 1), (20, 0), (25, 3), (40, 6)) for d in range(n)], "conv_id long, turn long, role string, text string")
    stage = Stage(spark, "trie")
    convs = prefixtrie.encode(turns, stage)
    name = {r.id: r.conv_id for r in convs.select("conv_id", F.explode("path.id").alias("id")).collect()}
    built = prefixtrie.grafted(convs, stage, 20, 3, F.lit(3)).collect()
    assert {r.conv_id: [name[t.id] for t in r.path] for r in built} == {0: [0, 0], 7: [0, 0, 7, 7], 9: [0, 0], 25: [], 40: [40] * 6}


# p-stable hashing

def near(rows, least):
    """{vec_id: (n_links, component_id, kept)} by comparing all pairs."""
    ok = {i: (label, np.array(v, float) / np.linalg.norm(np.array(v, float))) for i, label, v in rows
          if label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = {i: [j for j in ok if i in ok and j != i and ok[i][0] == ok[j][0] and len(ok[i][1]) == len(ok[j][1]) and ok[i][1] @ ok[j][1] >= least] for i, _, _ in rows}
    root = {i: i for i in links}
    while any(root[i] > root[j] for i in links for j in links[i]):
        for i in links:
            root[i] = min([root[i], *(root[j] for j in links[i])])
    return {i: (len(links[i]), root[i], root[i] == i) for i in links}


@pytest.mark.parametrize("part_rows,crowd", [(8, 5), (4096, 1000)])
def test_near_duplicates_equal_brute_force(spark, part_rows, crowd):
    made = np.random.default_rng(3)
    centres = made.standard_normal((30, 24))
    rows = []
    for i in range(400):
        v = centres[int(made.integers(30)) if i % 3 else 0] + made.standard_normal(24) * made.choice([0.02, 0.15, 0.3])
        rows.append((i, int(made.integers(3)), (v * made.uniform(0.1, 9)).tolist()))
    rows += [(1000 + k, 1, rows[5][2]) for k in range(20)] + [(2000, None, rows[5][2]), (2001, 1, None), (2002, 1, [0.0] * 24), (2003, 1, []), (2004, 1, [float("nan")] * 24),
             (2005, 1, [None] + [1.0] * 23), (2006, 1, [1.0, 0.0]), (2007, 1, [3.0, 0.1]), (2008, 1, [float("inf")] * 24)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, point int, digest string")
    found = pstable.near_duplicates(df, 0.93, part_rows=part_rows, crowd=crowd).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == near(rows, 0.93) and len(found) == len(rows)
    assert pstable.near_duplicates(df.limit(0)).count() == 0


def test_repeated_and_missing_ids(spark):
    a, b = [1.0, 0.0, 0.2], [0.0, 1.0, 0.0]
    df = spark.createDataFrame([(1, 0, a), (1, 0, a), (None, 0, a), (None, 0, b), (2, 0, b)], "vec_id long, label int, embedding array<float>")
    found = sorted((tuple(r) for r in pstable.near_duplicates(df).collect()), key=repr)
    assert found == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 1, 2, False), (2, 1, 2, True)], key=repr)


def test_tables_meet_their_miss_rate():
    assert abs(pstable.meeting(1.0, 1.0) - 0.3687) < 1e-3  # of two vectors one width apart
    made = np.random.default_rng(0)
    x = pstable.scaled(made.standard_normal((4000, 64)))
    y = made.standard_normal(x.shape)
    y = pstable.scaled(y - np.einsum("nd,nd->n", x, y)[:, None] * x)
    y = 0.93 * x + np.sqrt(1 - 0.93 ** 2) * y
    t = pstable.Tables.of(50_000, 0.93, miss=0.05)
    group = np.zeros(len(x), dtype=np.int64)
    missed = (t.buckets(x, group) != t.buckets(y, group)).all(axis=1).mean()
    assert missed < 0.07
