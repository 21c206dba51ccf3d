"""The corpus pipeline: documents through its stages, each written as Parquet and read again.

1. toxicity: documents that the classifier chain calls toxic go;
2. quality rules: documents that fail the base rules or are depleted go, frequent lines (of a host or of the table) leave the others;
3. SimHash near-dedup: one document of each group stays (3-word shingles, 2 bits);
4. secret scans: what is found, wrapped secrets included, is masked;
5. packing: the rest as pieces of 1024-token sequences, ids included.

All stages but the last keep the columns of their input, whatever they are; `n_chars`, where there is one,
follows a changed text. Null texts count as empty: they fail the quality rules. An empty table passes all stages.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblake.llm import packing, quality, secretscan, simhash, toxicity
from weblake.llm.names import free_prefix
from weblake.llm.queries import BYTE_BPE, TOXIC_ABOVE, toxicity_chain
from weblake.session import checkpoint_dir


def _with_text(docs: DataFrame, names: list[str], text: Column) -> DataFrame:
    """The columns `names` of `docs` with a new text; `n_chars` follows where the text changed."""
    own = free_prefix(docs, "__text")
    docs = docs.withColumn(own, text)
    changed = ~F.col(own).eqNullSafe(F.col("text"))
    new = {"text": F.col(own), "n_chars": F.when(changed, F.length(own)).otherwise(F.col("n_chars")) if "n_chars" in names else None}
    return docs.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"`{c}`") for c in names])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return docs.where(toxicity.probabilities("text", toxicity_chain(spark, docs, sf_dir))["toxic"] <= TOXIC_ABOVE)


# op2's limits (those of its SQL), and two that do not grow with the host or the table.
LINES = quality.Rules(most=50, corpus=100)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = free_prefix(docs, "__quality")
    judged = quality.judge(docs, LINES, out=own).where(F.col(own + ".kept"))
    return _with_text(judged, docs.columns, F.coalesce(own + ".text", "text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, words=3, bits=2)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(docs, docs.columns, secretscan.redacted("text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, BYTE_BPE, keep=False)  # the stages before need the memory


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", apply_quality_rules),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scans", mask_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # the classifier, the fingerprints' components and the tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
