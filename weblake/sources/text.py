"""Tagged text scans and multi-line record stitching.

A log file is read as lines tagged with its ``log_type``. Error logs can
carry continuation lines (a stack, a wrapped message); a record starts at a
line matching a start pattern and every other line joins the record before
it.

* Text held in a column (:func:`stitch`): a per-row regex split at each
  newline followed by a start. No window, no shuffle, each text whole.
* Log files (:func:`read_stitched`): read as lines, so a large file is split
  across tasks like any text input and never becomes one row. Within each
  file split a running count of starts numbers the records; a small table
  with one row per split (a map-side combined count over a second scan)
  adds the starts of the file's earlier splits. Lines before a split's
  first start get that offset unchanged, which is exactly the record still
  open from an earlier split. The window is bounded by a split; the lines are shuffled twice, the input read twice.
* Records of bounded size: with ``max_bytes`` a record is cut into numbered parts. A line belongs to the part in which it
  begins: bytes of the record before it, over ``max_bytes``. The bytes before a line are counted like the starts, within the
  split and, for the record still open at its head, by a segmented sum over the splits before. So a part holds at most ``max_bytes``
  and one line more, and a file without any start is many groups, not one. Without ``max_bytes`` a record is one group.
* Streams (:func:`stitch_stream`): lines that come over time, with their file and place. The open part of each file is kept as
  state between micro-batches and bounded by ``max_bytes``; records and parts are those of the whole file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weblake.functions.patterns import ERROR_RECORD_START


def read_tagged(spark: SparkSession, paths: dict[str, str | list[str]]) -> DataFrame:
    """`{log_type: path(s)}` -> `(message, log_type)`, one row per line."""
    out = None
    for log_type, p in paths.items():
        df = spark.read.text(p).select(F.col("value").alias("message"), F.lit(log_type).alias("log_type"))
        out = df if out is None else out.unionByName(df)
    return out


def read_tagged_stream(spark: SparkSession, path: str, log_type: str) -> DataFrame:
    """Streaming variant: new files under `path` become new lines."""
    return spark.readStream.text(path).select(
        F.col("value").alias("message"), F.lit(log_type).alias("log_type")
    )


def stitch(df: DataFrame, text: str = "text", start: str = "[A-Z]",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """Split each `text` into records: `(*keep, rec, record)`.

    A record starts at a line matching ``^start``; lines before the first
    start form record 0, so records are numbered as a running count of starts.
    A record's text is its lines joined by a newline.
    """
    parts = F.split(F.col(text), rf"\n(?={start})")
    first_is_start = F.col(text).rlike(rf"^(?:{start})").cast("int")
    return df.select(*keep, F.posexplode(parts).alias("_pos", "record"), first_is_start.alias("_f")).select(
        *keep, (F.col("_pos") + F.col("_f")).alias("rec"), "record"
    )


def file_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`(file, blk, seq, line)`: lines with their file, split start and a
    per-task sequence number taken straight after the scan (line order
    within a split)."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("blk"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )


def _is_start(start: str) -> Column:
    return F.col("line").rlike(rf"^(?:{start})").cast("int")


def _size() -> Column:
    """Bytes of a line and its end."""
    return F.octet_length("line").cast("bigint") + 1


def _split_sums(lines: DataFrame, start: str) -> DataFrame:
    """Per split: `base`, the starts in the file's earlier splits; `carried`, the bytes that the record open at its head already has."""
    # sums per split straight from the scan: combined map-side, so this branch shuffles one row per split and task, never the lines
    in_last = F.when(_is_start(start) == 1, F.struct("seq"))
    last = lines.groupBy("file", "blk").agg(F.sum(_is_start(start)).alias("n"), F.sum(_size()).alias("total"), F.max(in_last)["seq"].alias("at"))
    order = Window.partitionBy("file").orderBy("blk")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tail = lines.join(last.select("file", "blk", "at"), ["file", "blk"]).filter(F.col("seq") >= F.col("at")).groupBy("file", "blk").agg(F.sum(_size()).alias("tail"))
    ends = last.join(tail, ["file", "blk"], "left").withColumn("begun", F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).over(upto))
    in_record = Window.partitionBy("file", "begun").orderBy("blk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("open", F.sum(F.coalesce("tail", "total")).over(in_record))
    return ends.select("file", "blk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.coalesce(F.lag("open").over(order), F.lit(0)).alias("carried"))


def stitch_lines(lines: DataFrame, start: str = ERROR_RECORD_START, max_bytes: int | None = None) -> DataFrame:
    """`(file, blk, seq, line)` -> `(file, rec, record)`, records numbered per
    file from 1 (lines before the file's first start are record 0); with `max_bytes` `(file, rec, part, record)`, parts from 0."""
    in_split = Window.partitionBy("file", "blk").orderBy("seq").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = lines.withColumn("lr", F.sum(_is_start(start)).over(in_split))
    if max_bytes is None:
        earlier = Window.partitionBy("file").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
        # starts per split straight from the scan: combined map-side, so this
        # branch shuffles one row per split and task, never the lines
        stats = lines.groupBy("file", "blk").agg(F.sum(_is_start(start)).alias("n"))
        offsets = stats.select("file", "blk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
        keys = ["file", "rec"]
    else:
        in_record = Window.partitionBy("file", "blk", "lr").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
        local = local.withColumn("own", F.coalesce(F.sum(_size()).over(in_record), F.lit(0)))
        offsets, keys = _split_sums(lines, start), ["file", "rec", "part"]
    numbered = local.join(offsets, ["file", "blk"]).withColumn("rec", F.col("base") + F.col("lr"))
    if max_bytes is not None:
        before = F.col("own") + F.when(F.col("lr") == 0, F.col("carried")).otherwise(0)
        numbered = numbered.withColumn("part", F.floor(before / F.lit(max_bytes)))
    parts = F.array_sort(F.collect_list(F.struct("blk", "seq", "line")))
    return numbered.select(*keys, "blk", "seq", "line").groupBy(*keys).agg(
        F.concat_ws("\n", F.transform(parts, lambda x: x["line"])).alias("record"))


def read_stitched(spark: SparkSession, path: str | list[str], log_type: str = "error",
                  start: str = ERROR_RECORD_START, max_bytes: int | None = None) -> DataFrame:
    """Log files -> stitched records `(file, rec, message, log_type)`, with `max_bytes` their parts, too (`part`)."""
    found = stitch_lines(file_lines(spark, path), start, max_bytes)
    return found.select("file", "rec", *(["part"] if max_bytes is not None else []), F.col("record").alias("message"), F.lit(log_type).alias("log_type"))


_OPEN = "rec long, before long, part long, any boolean, text string"


def stitch_stream(lines: DataFrame, start: str = ERROR_RECORD_START, max_bytes: int = 1_000_000, idle: str | None = None) -> DataFrame:
    """A stream `(file, place, line)`, places rising within a file from batch to batch, -> `(file, rec, part, record)` as
    :func:`stitch_lines` gives for the whole file. A part is returned once the next part or record begins, its file ends (a NULL line
    says so; later lines go on counting records), or nothing came for `idle` (`"10 minutes"`; what comes then is a further part).
    A micro-batch's lines of one file are sorted in one task: bound them by the source's rate options."""
    matches = re.compile(start).match

    def stitched(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rec, before, part, some, text = state.get if state.exists else (0, 0, 0, False, "")
        held, out = [text] if some else [], []

        def close() -> None:
            if held:
                out.append((key[0], rec, part, "\n".join(held)))
                held.clear()

        if state.hasTimedOut:
            close()
            before = (part + 1) * max_bytes
        else:
            rows = pd.concat(list(batches)).sort_values("place", kind="stable")
            for line in rows["line"]:
                if line is None:
                    close()
                    before = max(before, (part + 1) * max_bytes)
                    continue
                if matches(line):
                    close()
                    rec, before, part = rec + 1, 0, 0
                if before // max_bytes != part:
                    close()
                    part = before // max_bytes
                held.append(line)
                before += len(line.encode()) + 1
        state.update((rec, before, part, bool(held), "\n".join(held)))
        if idle and held:
            state.setTimeoutDuration(int(pd.Timedelta(idle).total_seconds() * 1000))
        yield pd.DataFrame(out, columns=["file", "rec", "part", "record"])

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout
    return lines.select("file", "place", "line").groupBy("file").applyInPandasWithState(
        stitched, "file string, rec long, part long, record string", _OPEN, "append", timeout)
