"""Incremental ingest: each file is read exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plinth.sources import manifest
from plinth.sources.csv_drop import CORRUPT, CSV_FORMAT, LINEAGE, file_digests, rejected_rows, text_schema
from plinth.streaming.upsert import Batch, once


def csv_stream(
    spark: SparkSession, path: str, columns: list[str], *, files_per_batch: int | None = None
) -> DataFrame:
    """New files of a CSV drop as they land, all columns text, bound by position.

    Surplus fields are cut; :func:`landing_stream` keeps such rows as rejects.
    """
    reader = spark.readStream.schema(text_schema(columns)).options(**CSV_FORMAT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)


def landing_stream(
    spark: SparkSession, path: str, columns: list[str], *, files_per_batch: int | None = None
) -> DataFrame:
    """As :func:`csv_stream`, with the text of malformed rows and each row's file and its time."""
    reader = spark.readStream.schema(text_schema([*columns, CORRUPT])).options(**CSV_FORMAT)
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path).select(
        *columns, CORRUPT, F.col("_metadata.file_path").alias(LINEAGE[0]), F.col("_metadata.file_modification_time").alias(LINEAGE[1])
    )


def landing_batch(stage: str, columns: list[str]) -> Batch:
    """Batch function that lands a :func:`landing_stream` in a stage table with lineage, each content once.

    A file whose content key is in the stage already, under whatever name, adds no rows, and of
    equal files in one batch the first by name does. Rows that have more fields than columns go to
    ``<stage>_rejects`` with a reason. ``<stage>_files`` lists every file seen, with its key and whether it was
    loaded. The three are written by batch number, so a repeated batch replaces what it wrote.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name, time, key, copied = LINEAGE
        files = sorted(r[0] for r in batch.select(name).distinct().collect())  # files of one batch
        if not files:
            return
        # `files` are addresses as Spark writes them; keys are taken of these files alone
        digests = file_digests(spark, files).select(F.col("path").alias(name), F.col("content_key").alias(key))
        earlier = [n for n in manifest.names(spark, f"{stage}_files") if n.startswith("batch=") and int(n[6:]) < batch_id]
        seen = spark.createDataFrame([], f"{key} string")
        if earlier:
            paths = [f"{stage}_files/{n}" for n in earlier]
            seen = spark.read.schema(f"{key} string, loaded boolean").parquet(*paths).where("loaded").select(key).distinct()
        first = digests.groupBy(key).agg(F.min(name).alias("_first"))
        listed = digests.join(first, key).join(seen.withColumn("_seen", F.lit(True)), key, "left").select(
            name, key, (F.col("_seen").isNull() & (F.col(name) == F.col("_first"))).alias("loaded")
        )
        listed.write.mode("overwrite").parquet(f"{stage}_files/batch={batch_id}")
        listed = spark.read.schema(listed.schema).parquet(f"{stage}_files/batch={batch_id}")
        # as many rows as the batch has files
        rows = batch.join(F.broadcast(listed.where("loaded").drop("loaded")), name).withColumn(copied, F.current_timestamp())
        landed, rejected = rejected_rows(rows, columns)
        rejected.select(CORRUPT, "_reason", *LINEAGE).write.mode("overwrite").parquet(f"{stage}_rejects/batch={batch_id}")
        landed.select(*columns, *LINEAGE).write.mode("overwrite").parquet(f"{stage}/batch={batch_id}")

    return once(run)


def parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, *, glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def append_new(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append what has landed since the last run to a parquet table and stop.

    The checkpoint records consumed files together with the commit of the batch: a failed run
    leaves them unconsumed and the next run takes them again.
    """
    return (
        stream.writeStream.format("parquet").option("path", table)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
