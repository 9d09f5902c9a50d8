"""Structured streaming forms of the ledgers: dedup, windows, budgets and incremental timelines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_events(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """A stream over Parquet files of events, in the schema of those that are there; a single file is a folder of one."""
    schema = spark.read.parquet(path).schema
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    status = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if not status.isDirectory():
        reader, path = reader.option("pathGlobFilter", where.getName()), where.getParent().toString()
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def deduplicated(stream: DataFrame, key: list[str], time: str, late: str) -> DataFrame:
    """One row for each delivery key within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, time: str, late: str, width: str, by: str) -> DataFrame:
    """Tumbling counts and sums; rows later than the watermark are dropped by it."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


_TIMELINE = "resource_id long, seq long, outcome string, version long"


def incremental_timeline(stream: DataFrame) -> DataFrame:
    """J4 without end: state is each resource's current fingerprints, first content and version number.

    Columns: resource_id, seq, input_fp, parser_fp, content_hash, failed_code. Rows of a batch go in seq
    order; an older seq than the state's is late and is told as such, never rewriting history.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = list(state.get) if state.exists else [None, None, None, 0, -1]
        rows = pd.concat(list(frames)).sort_values("seq")
        out = []
        for r in rows.itertuples():
            if r.seq <= now[4]:
                out.append((key[0], r.seq, "late", now[3]))
                continue
            now[4] = int(r.seq)
            if isinstance(r.failed_code, str):
                outcome = "failed"
            elif (r.input_fp, r.parser_fp) != (now[0], now[1]):
                outcome = "created" if now[0] is None else "changed"
                now[:4] = [r.input_fp, r.parser_fp, r.content_hash, now[3] + 1]
            else:
                outcome = "unchanged" if r.content_hash == now[2] else "failed"
            out.append((key[0], r.seq, outcome, now[3]))
        state.update(tuple(now))
        yield pd.DataFrame(out, columns=["resource_id", "seq", "outcome", "version"])

    held = T.StructType([T.StructField("input_fp", T.StringType()), T.StructField("parser_fp", T.StringType()), T.StructField("content", T.StringType()), T.StructField("version", T.LongType()), T.StructField("seq", T.LongType())])
    return stream.groupBy("resource_id").applyInPandasWithState(step, _TIMELINE, held, "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, place: str) -> DataFrame:
    """Runs a stream over all that is there and returns what it wrote, as a Parquet table below ``place``.

    Only appended rows are written: windows once the watermark has passed them. A last batch that holds no data lets
    the watermark move on, so windows are complete but for those that the watermark has not reached at the end.
    """
    out = f"{place}/rows"
    q = stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def drain_totals(stream: DataFrame, keys: list[str], place: str) -> DataFrame:
    """Runs an aggregation over all that is there and returns its last totals.

    Every batch appends the groups that it changed, under its number; the row of the last batch of each group counts.
    """
    out = f"{place}/changes"

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    q = stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = stream.sparkSession.read.parquet(out).drop("batch")
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in stream.columns if c not in keys]), "_batch").alias("_last"))
    return last.select(*keys, "_last.*").select(*stream.columns)
