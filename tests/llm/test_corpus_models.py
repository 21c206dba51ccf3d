"""SimHash groups, the language model, the classifier chain, nearest neighbours, the pipeline."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF001
from odd_rows import no_docs, odd_docs  # noqa: F401
from weblake.llm import hnsw, lblm, simhash, toxicity
from weblake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# simhash

def fingerprint(text, n=3):
    words = WORD.findall(lowered(text))
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(points, bits):
    """{point: least point reachable} by comparing all pairs."""
    points = sorted(points)
    root = dict(zip(points, points))
    fps = np.array(points, dtype=np.int64).view(np.uint64)
    todo = True
    while todo:
        todo = False
        for p, f in zip(points, fps):
            near = [points[j] for j in np.flatnonzero(np.bitwise_count(fps ^ f) <= bits)]
            least = min(root[q] for q in near)
            for q in near:
                if root[q] != least:
                    root[q], todo = least, True
    return root


def test_fingerprints(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(40).collect()]
    for t in texts + [None, "", " \n", "One", "one TWO", "É a\x1cb c\xa0d e", "a b c"]:
        assert simhash.fingerprint(t) == fingerprint(t)


@pytest.mark.parametrize("shard_rows", [10, 100, 100_000])
@pytest.mark.parametrize("bits", [1, 2, 3])
def test_components_equal_brute_force(spark, shard_rows, bits):
    rng = np.random.default_rng(bits)
    points = set(rng.integers(-2**63, 2**63 - 1, 400, dtype=np.int64).tolist())
    for p in list(points)[:60]:  # chains and one dense group
        for _ in range(5):
            p ^= (1 << int(rng.integers(63))) ^ (1 << int(rng.integers(63)))
            points.add(p)
    points |= {p ^ (1 << b) for b in range(60)}
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    stage = simhash.Stage(spark, "test")
    found = {r.node: r.root for r in simhash.connected(simhash.links(df, bits, stage, shard_rows), stage).collect()}
    assert {p: found.get(p, p) for p in points} == linked(points, bits)


def test_op4_equals_brute_force(spark):
    docs = {r.doc_id: fingerprint(r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    signed = {d: int(np.uint64(f).view(np.int64)) for d, f in docs.items()}
    root = linked(set(signed.values()), 2)
    least = {}
    for d, f in signed.items():
        least[root[f]] = min(d, least.get(root[f], d))
    rows = QUERIES["op4_simhash_trees"](spark, SF001).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {d: (f"{f:016x}", least[root[signed[d]]]) for d, f in docs.items()}
    assert len(rows) == len(docs)


def test_groups_of_odd_rows(odd_docs, no_docs):
    rows = simhash.components(odd_docs).collect()
    assert len(rows) == 10
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 5)} == {1} and {r.component_id for r in rows if r.doc_id in (4, 6)} == {4}
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 0), (False, 1), (False, 3), (False, 4), (True, 0)]
    assert simhash.components(no_docs).collect() == [] and simhash.keep_first(no_docs).collect() == []


# language model

def test_base_scores_equal_brute_force(spark, odd_docs, no_docs):
    for docs in (spark.read.parquet(f"{SF001}/documents.parquet"), odd_docs):
        texts = [(r.doc_id, WORD.findall(lowered(r.text)) + ["\0"]) for r in docs.collect()]
        counts = Counter(w for d, ws in texts if zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1 for w in ws)
        n, v = sum(counts.values()), len(counts)
        want = sorted((-1 if d is None else d, len(ws), sum(w in counts for w in ws), n, round(sum(math.log10((counts[w] + .5) / (n + .5 * (v + 1))) for w in ws), 6)) for d, ws in texts)
        rows = lblm.score(docs).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
        assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert lblm.score(no_docs).collect() == []


def test_rare_words_by_join_equal_words_at_hand(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(80)
    monkeypatch.setattr(lblm, "VOCABULARY", 50)
    whole = {r.doc_id: r for r in lblm.score(docs).collect()}
    monkeypatch.setattr(lblm, "HEAD", 200)
    for r in lblm.score(docs).collect():
        assert r.base_score == pytest.approx(whole[r.doc_id].base_score) and r.n_known == whole[r.doc_id].n_known
        assert r.score == pytest.approx(whole[r.doc_id].score, rel=1e-3)


def test_the_model_is_normalised_and_learns():
    rng = np.random.default_rng(0)
    follow = rng.permutation(30)
    words = [0]
    for _ in range(40_000):
        words.append(int(follow[words[-1]]) if rng.random() < 0.8 else int(rng.integers(30)))
    words = np.array(words)
    model = lblm.LogBilinear(np.append(np.bincount(words, minlength=30), 0.5))
    model.start_training()
    a, b, w = lblm.positions(words, np.array([len(words)]), model.size)
    for _ in range(3):
        model.train(a, b, w)
    near, far = model.tables()
    for x in (0, 5, model.size):
        assert np.allclose(np.exp(near[x] + far - model.normalisers(x)[:, None]).sum(axis=1), 1, atol=1e-4)
    z = np.stack([model.normalisers(i) for i in range(model.size + 1)])
    mean = (near[a, w] + far[b, w] - z[a, b])[-5000:].mean()
    assert mean > np.log(model.noise)[w[-5000:]].mean() + 0.5  # far better than word counts alone


def test_training_without_a_start_sample(spark):
    docs = spark.range(3200, numPartitions=2).selectExpr("cast(null as long) as doc_id", "'a b a b a b' as text")
    assert docs.where((F.pmod(F.xxhash64("doc_id"), F.lit(3200 // (2 * lblm.START_DOCS))) == 0)).count() == 0
    new = lambda: lblm.LogBilinear(np.array([9600., 9600., 3200., .5]))
    before, model = new(), lblm.fit(docs, new(), {b"a": 0, b"b": 1, b"": 2}, simhash.Stage(spark, "lblm-test"))
    assert not np.allclose(before.q, model.q) and np.isfinite(model.q).all()


def test_positions_do_not_cross_texts():
    a, b, w = lblm.positions(np.array([1, 2, -1, 7, 3]), np.array([3, 4, 5]), 5)
    assert w.tolist() == [1, 2, 4, 4, 3] and a.tolist() == [5, 1, 2, 5, 5] and b.tolist() == [5, 5, 1, 5, 5]


# classifier chain

def made_texts(n, seed):
    rng = np.random.default_rng(seed)
    plain = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(n):
        toxic, junk = rng.random() < 0.2, rng.random() < 0.2
        words = list(rng.choice(plain, 40)) + (list(rng.choice(["vileone", "viletwo", "rotten"], 3)) if toxic else [])
        rows.append((i, " ".join(f"{w}$$$" if junk else w for w in rng.permutation(words)), int(junk), int(toxic), int(toxic and junk)))
    return rows


def test_chain_on_held_out_texts(spark):
    cols = "doc_id long, text string, junk int, toxic int, severe int"
    docs, new = spark.createDataFrame(made_texts(900, 1), cols), spark.createDataFrame(made_texts(400, 2), cols)
    chain = toxicity.train(docs.select("doc_id", "text"), docs.drop("text"), ["junk", "toxic", "severe"])
    p = F.col("p")
    rows = new.select("*", toxicity.probabilities("text", chain).alias("p")).select("junk", "toxic", "severe", (p["junk"] > .5).alias("a"), (p["toxic"] > .5).alias("b"), (p["severe"] > .5).alias("c")).collect()
    for want, got in (("junk", "a"), ("toxic", "b"), ("severe", "c")):  # severe: only the two before it together say so
        assert sum(r[want] == r[got] for r in rows) > 0.97 * len(rows)


def test_copies_count_once():
    word = [np.array([1, 2, 3, 4, 5, 6, 7, 8]), np.array([1, 2, 3, 4, 5, 6, 7, 8]), np.array([11, 12, 13, 14, 15, 16])]
    assert toxicity.one_per_copy(word, np.zeros(20, bool)).tolist() == [0, 0, 2]


def test_chain_on_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, None), (0, 0, None), (4, 0, None), (99, 1, None), (None, 1, None)], "doc_id long, toxic int, other int")
    chain = toxicity.train(odd_docs, labels, ["toxic", "other"])
    rows = odd_docs.select("*", toxicity.probabilities("text", chain).alias("p")).collect()
    assert len(rows) == 10 and all(0 <= r.p.toxic <= 1 and r.p.other == 0 for r in rows)
    assert toxicity.train(no_docs, labels, ["toxic"])[0].weights is None
    assert no_docs.select(toxicity.probabilities("text", chain)).collect() == []


def test_training_rows_are_one_for_each_id(spark):
    docs = spark.range(3000).selectExpr("if(id < 2900, 7, id) as doc_id", "concat('word', id % 2) as text")
    labels = spark.createDataFrame([(7, 1), (7, 0), (2950, 0), (5, 1)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, labels, ["toxic"], 12_000, "doc_id", "text").collect()
    assert sorted(r.toxic for r in rows) == [0, 1]
    assert all(r.words.startswith("word") for r in rows)


# nearest neighbours

def brute_nearest(rows, queries, k):
    out = {}
    for q, x in queries:
        scored = sorted((-float(np.dot(np.array(x, float), np.array(y, float))), v) for v, y in rows if v != q and len(y) == len(x))
        out[q] = [(v, -s) for s, v in scored[:k]]
    return out


@pytest.mark.parametrize("shard_rows", [100, 4000])
def test_recall(spark, shard_rows):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(20, 16))
    x = centers[rng.integers(0, 20, 1200)] + 0.3 * rng.normal(size=(1200, 16))
    x[300:700] = 4 * x[300]  # one very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in hnsw.nearest(df, F.col("vec_id") % 20 == 0, 10, shard_rows=shard_rows).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute_nearest(rows, rows[::20], 10)
    assert got.keys() == want.keys()
    assert sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) >= 0.95 * 10 * len(want)
    assert [v for v, _ in got[400]] == list(range(300, 310))  # ties go to the smaller id


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]), (7, []), (8, [1.0, 2.0, 3.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (None, [1.0, 1.0]), (40, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<float>, score int")
    got = {}
    for r in hnsw.nearest(df, F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got == {0: [(1, 20, 1.0), (2, 1, 0.5), (3, 40, -1.0)], 20: [(1, 0, 1.0), (2, 1, 0.5), (3, 40, -1.0)], 40: [(1, 1, -0.5), (2, 0, -1.0), (3, 20, -1.0)]}
    assert hnsw.nearest(df.limit(0), F.lit(True), 5).collect() == []


# pipeline

def test_pipeline_stages(spark):
    base = spark.read.parquet(f"{SF001}/documents.parquet")
    words = "plain words that say nothing in particular about number {0} and go on for a little while {0} more"
    added = [(1001, words.format("one") + " password = 'abcDEF1234567890'", "en", "new", 1), (1002, words.format("two"), "en", "new", 1), (1003, words.format("two"), "en", "new", 1),
             (1004, None, None, None, None), (None, words.format("three"), "en", None, 1), (1005, "", "en", "new", 0)]
    docs = base.unionByName(spark.createDataFrame(added, base.schema)).withColumn("quality", F.lit("clash"))
    clashes = ["__text", "__fence", "__simhash_key", "__quality", "__Kept_id"]
    docs = docs.withColumns({c: F.lit("clash") for c in clashes})
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = simhash.Stage(spark, "pipeline-test")(stage(spark, docs, SF001))
        seen[name] = {r.doc_id: r for r in docs.collect()}
        if k < 4:
            assert docs.columns == columns and docs.count() <= before.count()
            assert docs.where(" OR ".join(f"{c} IS DISTINCT FROM 'clash'" for c in clashes)).count() == 0
        assert stage(spark, before.limit(0), SF001).collect() == []
    assert {1001, 1002, 1003} <= seen["toxicity"].keys() and {1001, 1002, 1003} <= seen["quality_rules"].keys()
    assert not {1004, 1005} & seen["quality_rules"].keys()
    assert {1001, 1002} <= seen["simhash_near_dedup"].keys() and 1003 not in seen["simhash_near_dedup"]
    assert "abcDEF" not in seen["secret_scans"][1001].text and seen["secret_scans"][1002].text == words.format("two")
    assert seen["packing"].keys() == seen["secret_scans"].keys()


def test_planted_toxic_documents_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lexicon = {"trash", "loser", "clown", "idiot", "worthless", "moron", "scum", "disgusting", "stupid", "pathetic"}
    left = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, "/root/testdata/sf0.01").collect()}
    said = {r.doc_id: len(set(re.findall(r"[a-z]+", (r.text or "").lower())) & lexicon) for r in docs.collect()}
    assert all(d in left for d, n in said.items() if not n)
    assert sum(d not in left for d, n in said.items() if n >= 2) >= 0.9 * sum(n >= 2 for n in said.values())


def test_op3_and_op8_return_every_document(spark):
    n = spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert QUERIES["op3_toxicity_chain"](spark, SF001).count() == n == QUERIES["op8_log_bilinear"](spark, SF001).count()


def test_op6_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    want = brute_nearest(rows, [r for r in rows if r[0] % 20 == 0], 20)
    got = QUERIES["op6_hnsw_shards"](spark, "/root/testdata/sf0.01").toPandas()
    assert isinstance(got, pd.DataFrame) and got.groupby("query_id").size().eq(20).all()
    hits = sum(len({v for v, _ in want[q]} & set(g.vec_id)) for q, g in got.groupby("query_id"))
    assert hits >= 0.9 * 20 * len(want)
