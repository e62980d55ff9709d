"""Incremental ingest and streaming forms of batch operators (Structured Streaming)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from terrace.operators.series import decision
from terrace.plans.facts import FactStore
from terrace.schemas import bronze_schema
from terrace.session import cut_lineage, exists


def ingest_new_files(
    spark: SparkSession, landing: str, entity: str, target: str, checkpoint: str, batch_id: str,
) -> StreamingQuery:
    """Append the files that arrived since the last call, each exactly once.

    The checkpoint remembers which files were taken, so calling again - or after a crash -
    neither skips nor repeats a file. Ends when all present files are stored.
    """
    arriving = (
        spark.readStream.schema(bronze_schema(entity)).option("header", True).csv(landing))
    audited = arriving.select(
        "*", F.current_timestamp().alias("_ingestion_ts"),
        F.col("_metadata.file_name").alias("_source_file"), F.lit(batch_id).alias("_batch_id"))
    return (
        audited.writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_stream(spark: SparkSession, path: str, schema: StructType, files: int | None = None) -> DataFrame:
    """Parquet files as they arrive; at most `files` of them in a micro-batch."""
    reader = spark.readStream.schema(schema)
    return (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(path)


def file_block() -> Column:
    """Number of the file block a row was read from: as many values as there are blocks."""
    return F.xxhash64("_metadata.file_path", "_metadata.file_block_start")


def drop_resent(
    arriving: DataFrame, keys: Sequence[str], ts: str, lateness: str, spread: Column | None = None
) -> DataFrame:
    """One row per key among rows at most `lateness` apart; the state is bounded by that span.

    `spread` is for keys sent very many times: copies are first reduced to one per key and value
    of `spread` (such as `file_block()`), so no task receives all copies of a key.
    """
    marked = arriving.withWatermark(ts, lateness)
    if spread is not None:
        marked = marked.withColumn("_spread", spread).dropDuplicatesWithinWatermark(
            [*keys, "_spread"]).drop("_spread")
    return marked.dropDuplicatesWithinWatermark(list(keys))


def advise(scored: DataFrame, prediction: str) -> DataFrame:
    """The decision rule; a stateless projection, so it serves batch and stream alike."""
    return scored.withColumn("advice", decision(prediction))


def store_all_available(
    stream: DataFrame, target: str, checkpoint: str, timeout: int | None = None
) -> None:
    """Write what is available now to Parquet and wait for the end."""
    query = (
        stream.writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finish(query, timeout)


def store_with_late(
    arriving: DataFrame, kept: FactStore, late: FactStore, ts: str, lateness: str, progress: str,
    checkpoint: str,
) -> StreamingQuery:
    """Store each row once: on time in `kept`, behind the watermark in `late`. Nothing is dropped.

    The watermark of a micro-batch is the newest time of all earlier ones less `lateness`, an interval
    such as `2 days`; it is stored in `progress` with the batch's number. Both stores know a load by its
    name, here the batch's number, so a batch that is run again after a crash adds nothing twice.
    Copies are found by id among all stored rows, also where the first one came late.
    """
    spark = arriving.sparkSession

    def newest_before(batch: int):
        if not exists(spark, progress):
            return None
        return spark.read.schema("newest timestamp, batch int").parquet(progress).filter(
            F.col("batch") < batch).agg(F.max("newest") - F.expr(f"INTERVAL {lateness}")).first()[0]

    def store(rows: DataFrame, batch: int) -> None:
        rows = cut_lineage(rows)  # read for both stores and for the newest time
        mark = newest_before(batch)
        behind = F.lit(False) if mark is None else F.col(ts) < F.lit(mark)
        kept.add(rows.filter(~behind), f"batch{batch}")
        # A copy of what is kept isn't late.
        late.add(kept.unseen(rows.filter(behind)), f"batch{batch}")
        (rows.agg(F.max(ts).cast("timestamp").alias("newest")).withColumn("batch", F.lit(batch))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(progress))

    return (arriving.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def finish(query: StreamingQuery, timeout: int | None = None) -> None:
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream did not finish in {timeout} s")
