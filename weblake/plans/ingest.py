"""One batch of raw lines -> quarantine + star schema in the lake, published as one version.

The same function serves a batch backfill and each micro-batch of the
stream (``foreachBatch``). Parsed lines plus quarantined lines are the input:
one parse decides both, and the input is read and parsed once.

* A backfill (``whole=True``) sees all rows of every window, so behaviour
  verdicts are part of the flags. The parsed rows, unparsed lines among them, are written once to a
  staging table beside the star; quarantine, page counts, flags, dims and the fact derive from it, and
  nothing is held on executors.
* A micro-batch (``whole=False``) persists its parsed rows, signature flags included, in one frame. With windowed
  rules it adds its page counts to the lake, and the verdicts that all counts so far give for its keys:
  the rows of a window may come in several batches (one writer at a time; a second one's counts are met by a retry), and
  ``lake.read_star(..., cfg)`` joins the stored verdicts.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblake.operators.detect import DetectConfig, combined, flag_signatures, page_counts, with_signature, with_verdicts
from weblake.operators.parse import all_events, unparsed
from weblake.operators.star import Star, anomaly_types, build_dims, build_fact, with_ids
from weblake.plans import rollups
from weblake.sources import lake, versions


@dataclass
class BatchResult:
    batch_id: int
    skipped: bool = False


def is_parsed_batch(df: DataFrame) -> bool:
    return "ip" in df.columns and "timestamp" in df.columns


def process_batch(batch: DataFrame, batch_id: int, root: str, ranges: DataFrame,
                  cfg: DetectConfig, whole: bool = True, max_bytes: int | None = None, **geo) -> BatchResult:
    """`batch`: raw `(message, log_type)` lines, or already-unified events
    (unparsed rows have ``ip = ''``). `whole`: the batch is the whole input, no window goes on in another."""
    if batch.isEmpty():
        return BatchResult(batch_id, skipped=True)
    spark = batch.sparkSession
    if whole:
        lake.publish_batch(spark, root, batch_id, _backfill(batch, batch_id, root, ranges, cfg, max_bytes, **geo))
        return BatchResult(batch_id)
    if cfg.mode == "windowed" and lake.holds_merged(spark, root, batch_id):
        return BatchResult(batch_id, skipped=True)  # its counts are part of merged ones
    events = _events(batch, max_bytes)
    events = (flag_signatures(events) if cfg.mode == "windowed" else events).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        segments = []
        good = events.filter(F.col("ip") != "")
        if "message" in events.columns:
            segments += lake.write_quarantine(unparsed(events), root, batch_id)  # fills the cache
            good = good.drop("message")
        if cfg.mode == "windowed":
            counts = lake.write_page_counts(page_counts(good, cfg), root, batch_id)
            segments += lake.write_star(_rolled(Star.build(good, ranges, **geo), good), root, batch_id) + counts
        else:
            counts = []
            segments += _flagged_star(good, root, batch_id, ranges, cfg, **geo)
        _publish(spark, root, batch_id, segments, counts, cfg)
    finally:
        events.unpersist()
    return BatchResult(batch_id)


def _publish(spark, root: str, batch_id: int, segments: list, counts: list, cfg: DetectConfig) -> None:
    """Publish a micro-batch with its verdicts; they are made again if other counts came meanwhile."""
    if not counts:
        lake.publish_batch(spark, root, batch_id, segments)
        return
    while True:
        seen = versions.latest(spark, root)
        verdicts = lake.write_verdicts(counts, root, batch_id, cfg, seen, spark)

        def same_counts(now):
            if {r for s in now.of("page_counts") for r in s.batches} != {r for s in seen.of("page_counts") for r in s.batches}:
                raise versions.Conflict("other counts came")

        try:
            lake.publish_batch(spark, root, batch_id, segments + verdicts, same_counts)
            return
        except versions.Conflict:
            continue


def _flagged_star(good: DataFrame, root: str, batch_id: int, ranges: DataFrame, cfg: DetectConfig, **geo) -> list:
    """Write the star of a batch that is flagged by itself. The verdicts are joined once, to narrow rows, for the fact; the dims but the
    anomaly's come from the rows before them, and the anomaly types are those of the written fact."""
    flagged = combined(with_verdicts(with_ids(with_signature(good)), page_counts(good, cfg), cfg))
    star = _rolled(Star(build_fact(flagged), build_dims(good, ranges, **geo)), good)
    segments = lake.write_star(star, root, batch_id)
    fact = lake.rows_of(good.sparkSession, root, [s for s in segments if s.table == "fact"], "fact")
    return segments + lake.write_dim(anomaly_types(fact), "dim_anomaly_type", root, batch_id)


def _rolled(star: Star, events: DataFrame) -> Star:
    return replace(star, rollup=rollups.rollup_of(events), sketches=rollups.sketches_of(events))


def _events(batch: DataFrame, max_bytes: int | None) -> DataFrame:
    """Unified events; the raw line is only kept where it is needed, in unparsed rows."""
    if is_parsed_batch(batch):
        events = batch
    else:
        events = all_events(batch, keep=("message",), max_bytes=max_bytes)
    if "message" in events.columns:
        events = events.withColumn("message", F.when(F.col("ip") == "", F.col("message")))
    return events


def _backfill(batch: DataFrame, batch_id: int, root: str, ranges: DataFrame, cfg: DetectConfig,
              max_bytes: int | None, **geo) -> list:
    events = lake.staged(_events(batch, max_bytes), root, batch_id)
    bad = lake.write_quarantine(unparsed(events), root, batch_id) if "message" in events.columns else []
    good = events.filter(F.col("ip") != "").drop("message")
    return bad + _flagged_star(good, root, batch_id, ranges, cfg, **geo)


def _fingerprint(spark, inputs: list[str], extra: str) -> str:
    """Digest of input paths, sizes and modification times plus settings."""
    import hashlib

    from weblake.sources import fs

    h = hashlib.sha256(extra.encode())
    for path in inputs:
        size, mtime = fs.status(spark, path)
        h.update(f"{path}|{size}|{mtime}".encode())
    return h.hexdigest()[:16]


def _code_digest() -> str:
    """Digest of the modules a stored star depends on: a changed parser gets a new lake."""
    import hashlib
    import inspect

    from weblake import fixtures
    from weblake.functions import ip, patterns
    from weblake.operators import detect, geo, parse, star

    return hashlib.sha256("".join(inspect.getsource(m) for m in (ip, patterns, detect, geo, parse, star, fixtures, lake, versions, rollups)).encode()).hexdigest()


def ensure_lake(spark, lines, inputs: list[str], ranges, cfg: DetectConfig,
                base: str | None = None, **geo) -> str:
    """Build the star for `lines` once (batch 0) and return its folder.

    The folder lives under the shared checkpoint folder and is named after a
    fingerprint of the inputs and settings; a marker file is written last, so
    an interrupted build is simply redone -- the writes are replay-safe.
    """
    import os

    from weblake.session import checkpoint_dir

    base = base or os.path.join(checkpoint_dir(spark), "weblake-lake")
    root = os.path.join(base, _fingerprint(spark, inputs, f"{_code_digest()}|{cfg!r}|{geo!r}"))
    marker = os.path.join(root, "_BUILT")
    if lake._exists(spark, marker):
        return root
    # `lines` / `ranges` may be DataFrames or callables (only needed to build)
    lines = lines() if callable(lines) else lines
    ranges = ranges() if callable(ranges) else ranges
    process_batch(lines, 0, root, ranges, cfg, **geo)
    spark.createDataFrame([(1,)], "ok int").coalesce(1).write.mode("overwrite").json(marker)
    return root
