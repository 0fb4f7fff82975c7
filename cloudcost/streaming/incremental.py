"""Incremental daily load as Structured Streaming.

Raw export files land in a folder partitioned by ingestion date. A file stream with
``trigger(availableNow=True)`` and a checkpoint picks up new files, each exactly once: a
micro-batch is summed to partial sums by (ingestion day, key), staged, and all that follows
reads the staged sums. They are kept as parts under the micro-batch's number, so a replayed
batch replaces its own parts and nothing else. The usage days that the batch touches are rolled up
from all their parts and overwritten in the daily table: a day is the sum of everything
that has landed for it, however late a line comes. Folders of landed files are never read
again. The checkpoint replaces the reference's sync-history ledger.

Parts belong to one checkpoint (they lie under the stream's id). With a new checkpoint the
stream reads everything again and counts only its own parts.

``ws`` and ``we`` bound the ingestion days that count in a rollup. Lines outside them are kept
as parts all the same: a later run with a wider window counts them for the days it touches,
and ``rebuild`` rolls up all days.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import daily
from ..plans.jobs import overwrite_partitions, parts_of_days, read_table, staging, values_of
from ..session import scratch_path, shuffles_freed

PART_KEYS = ["usage_month", "batch_id"]


def _parts_path(table_dir: str, stream_id: str) -> str:
    return f"{table_dir}_parts/{stream_id}"


def _roll_up(parts: DataFrame, ws: dt.date, we: dt.date) -> DataFrame:
    inside = parts.filter(F.col("partition_date").between(F.lit(ws), F.lit(we)))
    return daily.gcp_daily_from_parts(inside, internal=True)


def upsert_batch(batch: DataFrame, batch_id: int, stream_id: str, table_dir: str, ws: dt.date, we: dt.date) -> None:
    """One micro-batch; running it again with the same rows and number changes nothing."""
    spark = batch.sparkSession
    path = _parts_path(table_dir, stream_id)
    with staging(spark) as stage:
        new = stage(daily.gcp_parts(batch).withColumn("batch_id", F.lit(batch_id).cast("int")))
        overwrite_partitions(new, path, PART_KEYS)
        days = new.select("usage_date", "usage_month").distinct()
        months = values_of(days, "usage_month")
        if not months:
            return
        rows = stage(_roll_up(parts_of_days(spark.read.parquet(path), days, months), ws, we))
        with shuffles_freed(spark):
            (rows.write.mode("overwrite").partitionBy("usage_date")
             .option("partitionOverwriteMode", "dynamic").parquet(table_dir))


def gcp_incremental_load(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint_dir: str,
                         ws: dt.date, we: dt.date, files_per_trigger: int | None = None) -> int:
    """Run the stream until all landed files are processed; the number of lines it read."""
    reader = spark.readStream.schema(spark.read.parquet(landing_dir).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        upsert_batch(batch, batch_id, stream_id, table_dir, ws, we)
    q = (reader.parquet(landing_dir).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(p.numInputRows for p in q.recentProgress)


def rebuild(spark: SparkSession, table_dir: str, stream_id: str, ws: dt.date, we: dt.date) -> None:
    """Roll all days up again from the stored parts, for another window; no export is read."""
    rows = _roll_up(spark.read.parquet(_parts_path(table_dir, stream_id)), ws, we)
    old = read_table(spark, table_dir)
    overwrite_partitions(rows, table_dir, ["usage_date"], [] if old is None else values_of(old, "usage_date"))


def read_daily_table(spark: SparkSession, table_dir: str) -> DataFrame:
    t = spark.read.parquet(table_dir)
    return t.select(*[F.col(c).cast("date").alias(c) if c == "usage_date" else F.col(c)
                      for c in daily.GCP_COLUMNS])


def land(export: DataFrame, landing: str) -> None:
    """Write an export as its job would: folders by ingestion day, files of bounded size."""
    with shuffles_freed(export.sparkSession):
        (export.repartition("partition_date").write.mode("append").option("maxRecordsPerFile", 1_000_000)
         .partitionBy("partition_date").parquet(landing))


def run_fixture_stream(spark: SparkSession, export: DataFrame, ws: dt.date, we: dt.date,
                       late_from: dt.date | None = None) -> DataFrame:
    """Land the export by ingestion date, stream it in several micro-batches and return the
    final daily table (equal to the batch A3 over the window). With ``late_from`` the lines
    of later ingestion days land after a first complete run of the stream."""
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    landing, table, ckpt = f"{base}/landing", f"{base}/table", f"{base}/_checkpoint"
    steps = [export] if late_from is None else [export.filter(F.col("partition_date") < F.lit(late_from)),
                                                export.filter(F.col("partition_date") >= F.lit(late_from))]
    for step in steps:
        land(step, landing)
        gcp_incremental_load(spark, landing, table, ckpt, ws, we, files_per_trigger=8 if len(steps) == 1 else 40)
    return read_daily_table(spark, table)
