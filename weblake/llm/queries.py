"""The registered queries of this folder: op1 ... op13 and the pipeline, each over its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblake.llm import chat, hnsw, idstore, lblm, packing, pieces, prefixtrie, pstable, quality, secretscan, simhash, toxicity, wordruns
from weblake.llm.oracle import ORACLE_SQL as ORACLE_SQL
from weblake.session import checkpoint_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE)
    return packed.withColumn("ids_crc32", F.crc32("tokens")).drop("tokens")


def op2_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_frequent_lines", "n_left"]
    return judged.select("doc_id", *[f"quality.{f}" for f in fields])


TOXIC_ABOVE = 0.5


def toxicity_chain(spark: SparkSession, docs: DataFrame, sf_dir: str) -> list[toxicity.Link]:
    """Low quality first, then toxic, from the table of labels."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return toxicity.train(docs, labels, ["low_quality", "toxic"])


def op3_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = docs.select("doc_id", toxicity.probabilities("text", toxicity_chain(spark, docs, sf_dir)).alias("p"))
    return scored.select("doc_id", F.col("p.low_quality").alias("p_low_quality"), F.col("p.toxic").alias("p_toxic"), (F.col("p.toxic") > TOXIC_ABOVE).alias("toxic"))


def op4_simhash_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"), words=3, bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_id_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark)}/id-shards-{uuid.uuid4().hex}"
    idstore.write_ids(table(spark, sf_dir, "documents"), folder, BYTE_BPE)
    return idstore.read_ids(spark, folder).withColumn("ids_crc32", F.crc32("tokens")).drop("tokens")


def op6_hnsw_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_secret_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", secretscan.secrets("text").alias("f"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = found.select("doc_id", F.col("f.spans").alias("spans"), "f.cut_off", F.filter("f.spans", lambda s: s["depth"] == 0).alias("base"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return base.select("doc_id", *map(count, secretscan.KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), "cut_off")


def op8_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lblm.score(table(spark, sf_dir, "documents"))


def op9_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded, and whether decoding gives it back (a mark in the text reads as a space)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = pieces.encode_documents(docs, PIECES)
    return ids.select("doc_id", F.floor(F.length("ids") / 4).alias("n_pieces"), F.crc32("ids").alias("ids_crc32"),
                      (pieces.decoded("ids", PIECES) == F.replace("text", F.lit(pieces.MARK), F.lit(" "))).alias("round_trip"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    read = (chat.format_conversations(turns)
            .select("conv_id", "valid", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "valid")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = simhash.Stage(spark, "prefix-trie")
    convs = prefixtrie.encode(table(spark, sf_dir, "conversations"), stage)
    taken = F.crc32(F.col("conv_id").cast("string")) % 4
    return prefixtrie.nodes(prefixtrie.grafted(convs, stage, every=20, most=3, taken=taken), stage)


def op12_pstable_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.93)


def repeating(text: Column | str, seed: Column) -> Column:
    """A tenth of the texts (whose seed is a multiple of ten) repeat their words from some place on, as the contract says."""
    @F.arrow_udf("string")
    def of(texts: pa.Array, seeds: pa.Array) -> pa.Array:
        out = []
        for t, h in zip(texts.to_pylist(), seeds.to_pylist()):
            words = t.split() if t and h is not None and h % 10 == 0 else []
            if words:
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                t = b" ".join([*words[:a], *(words[a + i % p] for i in range(n - a))])
            out.append(t)
        return pa.array(out, pa.binary()).cast(pa.string())

    return of(F.col(text).cast("binary") if isinstance(text, str) else text.cast("binary"), seed)


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = repeating("text", F.crc32(F.col("doc_id").cast("string")))
    found = docs.select("doc_id", wordruns.periodic_runs(text).alias("r")).select("doc_id", "r.*")
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.withColumn("longest", longest).withColumn("length", -F.col("longest.shorter"))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "length", "longest.period",
                        F.floor(1000 * F.col("length") / F.col("longest.period")).alias("exponent_milli"),
                        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_harmonic_packing, op2_quality_lines, op3_toxicity_chain, op4_simhash_trees, op5_id_shards, op6_hnsw_shards, op7_secret_layers, op8_log_bilinear, op9_piece_transducer, op10_chat_format,
    op11_prefix_trie, op12_pstable_hashing, op13_word_runs,
)}
