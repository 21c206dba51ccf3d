"""Parquet lake for the star schema: versions, replay-safe writes, keep-last reads.

Layout under one root folder::

    fact/at=<batch>-<token>/event_month=YYYYMM/*.parquet   (ranges of timestamp, sorted)
    dim_ip/at=.../*.parquet     dim_request/ dim_user_agent/ dim_error_details/ dim_anomaly_type/
    page_counts/at=.../event_month=YYYYMM/   (rows per window, address and page of a stream's batches)
    verdicts/at=.../event_month=YYYYMM/      (behaviour verdicts per window and address, ranked)
    rollup/at=.../event_month=YYYYMM/   sketches/at=.../event_month=YYYYMM/     (see weblake.plans.rollups)
    quarantine/at=.../          predictions/at=.../
    _versions/<number>.json     staging/batch_id=N/

* Writing a batch adds folders and publishes one version that names them in all tables
  (:mod:`weblake.sources.versions`). A batch written twice (a restart after a partial write) leaves one copy.
* Dims: each batch writes the keys it saw, without reading what is stored. A read keeps the last batch's row of each id, so
  newer attributes win and a join never multiplies fact rows, however many writers there were; a dim of one segment (a
  backfill, or after :func:`compact`) is unique as written.
* Verdicts: a batch adds what all counts so far say about the windows and addresses that it touches. Counts only grow, and with
  them the rank of a verdict, so the highest rank of a key is the right one, in whatever order rows come. A row stands in every
  month that its window touches, so a fact row finds it in its own month, and a filter on months prunes both tables.
* Month partitions let a time filter prune whole months; within a month rows are dealt to
  files by ranges of time, so row-group min/max on ``timestamp`` are tight.
* :func:`compact` merges segments of like size, so that files follow the rows and not the number of batches. Readers go on
  with the version they have.
* Missing tables read as empty ones.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weblake.operators.detect import BEHAVIOUR_RANKS, DetectConfig, behaviour_verdict, profile_of, ranked_verdict, window_seconds, with_verdict_rows
from weblake.operators.star import DIMS, FACT_SCHEMA, Star, event_month, keep_last
from weblake.plans import rollups
from weblake.schemas import DIM_SCHEMAS, PAGE_COUNTS_SCHEMA, PREDICTIONS_SCHEMA, QUARANTINE_SCHEMA, ROLLUP_SCHEMA, SKETCHES_SCHEMA, VERDICTS_SCHEMA
from weblake.sources import fs, versions
from weblake.sources.versions import Segment, Version

SCHEMAS = {"fact": FACT_SCHEMA, "page_counts": PAGE_COUNTS_SCHEMA, "verdicts": VERDICTS_SCHEMA, "quarantine": QUARANTINE_SCHEMA,
           "rollup": ROLLUP_SCHEMA, "sketches": SKETCHES_SCHEMA, "predictions": PREDICTIONS_SCHEMA, **DIM_SCHEMAS}
MONTH, NO_MONTH = "event_month", "__HIVE_DEFAULT_PARTITION__"


def _p(root: str, name: str) -> str:
    return os.path.join(root, name)


def _exists(spark: SparkSession, path: str) -> bool:
    return fs.exists(spark, path)


def add(df: DataFrame, table: str, root: str, batches: tuple[tuple[int, int], ...], level: int = 0, **options) -> list[Segment]:
    """Write the rows to a folder of their own; the segments, not published yet."""
    spark, folder = df.sparkSession, f"at={batches[-1][1]}-{uuid.uuid4().hex[:12]}"
    writer, path = df.write.options(**options), f"{_p(root, table)}/{folder}"
    if MONTH not in df.columns:
        writer.parquet(path)
        return [Segment(table, f"{table}/{folder}", None, batches, level)]
    writer.partitionBy(MONTH).parquet(path)
    months = sorted(n for n in fs.names(spark, path) if n.startswith(MONTH + "="))
    return [Segment(table, f"{table}/{folder}/{m}", m.split("=", 1)[1], batches, level) for m in months]


def _of_batch(df: DataFrame, batch_id: int) -> DataFrame:
    return df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))


def _in_time_order(fact: DataFrame, parts: int | None = None) -> DataFrame:
    keys = (MONTH, "timestamp", "ip_id")
    dealt = fact.repartitionByRange(parts, *keys) if parts else fact.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys)


def write_fact(fact: DataFrame, root: str, batch_id: int) -> list[Segment]:
    return add(_in_time_order(_of_batch(fact, batch_id)), "fact", root, ((batch_id, batch_id),))


def write_dim(dim: DataFrame, name: str, root: str, batch_id: int) -> list[Segment]:
    return add(_of_batch(dim.select(*DIMS[name].columns), batch_id), name, root, ((batch_id, batch_id),))


def write_page_counts(counts: DataFrame, root: str, batch_id: int) -> list[Segment]:
    keyed = counts.withColumn("ip_id", F.xxhash64("ip")).withColumn(MONTH, event_month("window_start"))
    return add(_of_batch(keyed, batch_id).repartition(MONTH, "window_start").sortWithinPartitions(MONTH, "window_start"), "page_counts", root, ((batch_id, batch_id),))


def write_verdicts(own: list[Segment], root: str, batch_id: int, cfg: DetectConfig, now: Version, spark: SparkSession) -> list[Segment]:
    """What the counts of version `now` and those of the batch (`own`, not published yet) say about the keys of the batch."""
    mine = read_segments(spark, root, own, "page_counts")
    spans = {r[0]: r[1:] for r in mine.groupBy(MONTH).agg(F.min("window_start"), F.max("window_start")).collect()}  # a row per month
    before = [s for s in now.of("page_counts") if s.month in spans and not (s.level == 0 and s.holds(batch_id))]
    counts = mine
    if before:
        low, high = min(a for a, _ in spans.values()), max(b for _, b in spans.values())
        keys = mine.select("window_start", "ip_id").distinct()
        stored = read_segments(spark, root, before, "page_counts").filter(F.col("window_start").between(F.lit(low), F.lit(high)))
        counts = counts.unionByName(stored.join(keys, ["window_start", "ip_id"], "left_semi"))
    per_page = counts.groupBy("window_start", "ip_id", "page").agg(F.sum("n").alias("n"), F.sum("lp").alias("lp"))
    judged = behaviour_verdict(profile_of(per_page.withColumnRenamed("ip_id", "ip"), cfg), cfg).withColumnRenamed("ip", "ip_id")
    rows = judged.select("window_start", "ip_id", ranked_verdict("behavioral_anomaly_type").alias("rank")).filter("rank > 0")
    last = F.timestamp_seconds(F.unix_seconds("window_start") + window_seconds(cfg.window) - 1)
    months = F.transform(F.sequence(F.trunc("window_start", "month"), F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH")), lambda d: F.date_format(d, "yyyyMM"))
    return add(_of_batch(rows.withColumn(MONTH, F.explode(months)), batch_id), "verdicts", root, ((batch_id, batch_id),))


def staged(df: DataFrame, root: str, batch_id: int) -> DataFrame:
    """`df` written once beside the star and read back; a batch that runs again overwrites it."""
    path = _p(root, f"staging/batch_id={int(batch_id)}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_star(star: Star, root: str, batch_id: int, parallel: bool = True) -> list[Segment]:
    """Dims, fact, and rollups where there are any. The dimension writes are independent jobs over the same input, so they are submitted together
    from threads and share the cluster."""
    jobs = [lambda d=dim, n=name: write_dim(d, n, root, batch_id) for name, dim in star.dims.items()]
    jobs.append(lambda: write_fact(star.fact, root, batch_id))
    for table, rows in (("rollup", star.rollup), ("sketches", star.sketches)):
        if rows is not None:
            jobs.append(lambda t=table, r=rows: add(_of_batch(r, batch_id).repartition(MONTH), t, root, ((batch_id, batch_id),)))
    if not parallel:
        return [s for job in jobs for s in job()]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [s for f in [pool.submit(job) for job in jobs] for s in f.result()]


def write_quarantine(bad: DataFrame, root: str, batch_id: int) -> list[Segment]:
    return add(_of_batch(bad, batch_id), "quarantine", root, ((batch_id, batch_id),))


def publish_batch(spark: SparkSession, root: str, batch_id: int, segments: list[Segment], check=None) -> Version:
    return versions.publish(spark, root, versions.batch_change(batch_id, segments, check))


def holds_merged(spark: SparkSession, root: str, batch_id: int) -> bool:
    """Whether a batch was published and is part of a merged segment: a replay of it has nothing to add there."""
    return any(s.level and s.holds(batch_id) for s in versions.latest(spark, root).segments)


def write_predictions(pred: DataFrame, root: str) -> None:
    """Replace the stored forecast (truncate + insert); readers see the old one or the new one."""
    new = add(pred, "predictions", root, ((0, 0),))
    versions.publish(pred.sparkSession, root, lambda now: [s for s in now.segments if s.table != "predictions"] + new)


def rows_of(spark: SparkSession, root: str, segments: list[Segment], table: str, schema: StructType | None = None) -> DataFrame:
    schema = schema or SCHEMAS[table]
    if not segments:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", _p(root, table)).parquet(*[_p(root, s.path) for s in segments]).select(*schema.names)


def read_segments(spark: SparkSession, root: str, segments: list[Segment], table: str, schema: StructType | None = None) -> DataFrame:
    """Rows that are stored already; a batch takes those it has just written by :func:`rows_of`."""
    return rows_of(spark, root, segments, table, schema)


def read_table(spark: SparkSession, root: str, name: str, schema: StructType, version: Version | None = None) -> DataFrame:
    """A table of the lake with its declared schema, of a version or the newest; empty where nothing was written yet."""
    return read_segments(spark, root, (version or versions.latest(spark, root)).of(name), name, schema)


def read_dim(spark: SparkSession, root: str, name: str, version: Version | None = None) -> DataFrame:
    """One row per id, that of the last batch."""
    d, version = DIMS[name], version or versions.latest(spark, root)
    raw = read_table(spark, root, name, d.schema, version)
    if len(version.of(name)) <= 1:
        return raw.select(*d.columns)
    return keep_last(raw, d.id_col, "batch_id", [*d.columns, "batch_id"]).select(*d.columns)


def read_star(spark: SparkSession, root: str, cfg: DetectConfig | None = None, version: Version | None = None) -> Star:
    """Fact and dims of one version of a lake. With `cfg` (a stream's, windowed), rows without a signature anomaly get
    the stored behaviour verdict of their window and address."""
    version = version or versions.latest(spark, root)
    fact = read_table(spark, root, "fact", FACT_SCHEMA, version)
    dims = {name: read_dim(spark, root, name, version) for name in DIMS}
    if cfg is not None and cfg.mode == "windowed":
        stored = read_table(spark, root, "verdicts", VERDICTS_SCHEMA, version)
        best = stored.groupBy(MONTH, "window_start", "ip_id").agg(F.max("rank").alias("rank"))
        kind = F.when(F.col("is_anomaly") == 0, F.col("behavioral_anomaly_type"))
        fact = with_verdict_rows(fact, best, cfg).select(
            *[F.coalesce("anomaly_type_id", F.xxhash64(kind)).alias(c) if c == "anomaly_type_id" else
              F.when(kind.isNotNull(), 1).otherwise(F.col(c)).alias(c) if c == "is_anomaly" else c for c in fact.columns])
        fact = fact.withColumn("anomaly_type_id", F.when(F.col("is_anomaly") == 1, F.col("anomaly_type_id")))
        types = spark.createDataFrame([(t,) for t in BEHAVIOUR_RANKS], "anomaly_type string").select(F.xxhash64("anomaly_type").alias("anomaly_type_id"), "anomaly_type")
        dims["dim_anomaly_type"] = dims["dim_anomaly_type"].unionByName(types).distinct()
    def batches(table: str) -> set:
        return {(s.month, versions.union(list(s.batches))) for s in _by_month(version.of(table))}

    held = batches("rollup") == batches("fact")  # else there were batches without rollups
    rolled = [read_table(spark, root, t, SCHEMAS[t], version) if held else None for t in ("rollup", "sketches")]
    months = sorted({s.month for s in version.of("fact")} - {NO_MONTH})
    return Star(fact, dims, *rolled, months=tuple(months))


def _by_month(segments: list[Segment]) -> list[Segment]:
    """One segment per month that stands for the batches of all."""
    found: dict[str | None, list] = {}
    for s in segments:
        found.setdefault(s.month, []).extend(s.batches)
    return [Segment(segments[0].table, "", m, versions.union(r)) for m, r in found.items()]


def _merged(table: str, rows: DataFrame) -> DataFrame:
    """The rows that stand for those of several segments of a table."""
    if table in DIMS:
        d = DIMS[table]
        return keep_last(rows, d.id_col, "batch_id", [*d.columns, "batch_id"]).join(rows.groupBy(d.id_col).agg(F.max("batch_id").alias("batch_id")), d.id_col)
    if table == "page_counts":
        return rows.groupBy("window_start", "ip", "page", "ip_id", MONTH).agg(F.sum("n").alias("n"), F.sum("lp").alias("lp"), F.max("batch_id").alias("batch_id")).repartition(MONTH, "window_start").sortWithinPartitions(MONTH, "window_start")
    if table == "rollup":
        return rollups.merged_rollup(rows).repartition(MONTH)
    if table == "sketches":
        return rollups.merged_sketches(rows).repartition(MONTH)
    if table == "verdicts":
        return rows.groupBy("window_start", "ip_id", MONTH).agg(F.max("rank").alias("rank"), F.max("batch_id").alias("batch_id"))
    return rows


def compact(spark: SparkSession, root: str, up_to_batch: int | None = None, fanout: int = 8, rows_per_file: int = 5_000_000, whole: bool = False) -> int:
    """Merge, per table and month, segments of one level into one of the next while there are `fanout` of them; the number of
    merged segments. `whole`: all segments of a table and month become one, whatever their levels. Segments of batches after `up_to_batch` are left alone. Each merge is published as a version of its own;
    one whose segments a writer replaced meanwhile is dropped and its rows stay where they are.

    Rows of dims, page counts and verdicts become one per key; the fact is put in order of time again, its files sized by
    `rows_per_file`. The other tables' files are sized by Spark's shuffle."""
    done = 0
    while True:
        groups: dict[tuple, list[Segment]] = {}
        for s in versions.latest(spark, root).segments:
            if s.table != "predictions" and (up_to_batch is None or s.last <= up_to_batch):
                groups.setdefault((s.table, s.month, None if whole else s.level), []).append(s)
        ripe = {k: g for k, g in groups.items() if len(g) >= (2 if whole else fanout)}
        if not ripe:
            return done
        merged = 0
        for (table, _, _), old in ripe.items():
            rows = read_segments(spark, root, old, table)
            if table == "fact":
                rows = _in_time_order(rows, max(1, -(-rows.count() // rows_per_file)))
            batches = versions.union([r for s in old for r in s.batches])
            new = add(_merged(table, rows), table, root, batches, max(s.level for s in old) + 1, **({"maxRecordsPerFile": rows_per_file} if table == "fact" else {}))
            try:
                versions.publish(spark, root, versions.merge_change(old, new))
                merged += len(old)
            except versions.Conflict:
                continue
        done += merged
        if not merged:
            return done


def read_predictions(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "predictions", PREDICTIONS_SCHEMA)
