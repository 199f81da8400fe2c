"""Micro-batch upsert of streamed rows into bucketed tables and their dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plinth.operators.latest import latest_per_key
from plinth.operators.merge import GONE, merge
from plinth.operators.scd2 import scd2_apply
from plinth.plans import layers
from plinth.plans.entities import Entity
from plinth.sources import manifest
from plinth.sources.bucketed import BucketedTable

Batch = Callable[[DataFrame, int], None]


def once(run: Batch) -> Batch:
    """Keep the batch while it is worked on, as it is read several times."""

    def kept(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            run(batch, batch_id)
        finally:
            batch.unpersist()

    return kept


def newest_wins(target: DataFrame, source: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Upsert in which a late row never replaces a newer one; repeating it changes nothing."""
    both = target.unionByName(source.select(*target.columns))
    return latest_per_key(both, keys, order_by)


def upsert_batch(
    table: BucketedTable, order_by: list[str], transform: Callable[[DataFrame], DataFrame] | None = None
) -> Batch:
    """Batch function that upserts into a table, newest row per key."""

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        delta = latest_per_key(rows, table.keys, order_by)
        table.upsert(delta, batch_id + 1, lambda old, new: newest_wins(old, new, table.keys, order_by))

    return once(run)


def dimension_batch(
    clean: BucketedTable, dim: BucketedTable, tracked: list[str], order_by: list[str],
    as_of: Callable[[int], Column], hk: str = "hk",
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> Batch:
    """Batch function for a clean table and its type-2 dimension.

    The tables share a log and advance together; a repeated batch writes the same versions of
    both again.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        delta = latest_per_key(rows, clean.keys, order_by)
        state = clean.stage(delta, batch_id + 1, lambda old, new: newest_wins(old, new, clean.keys, order_by))
        _publish_with_dimension(clean, state, dim, delta, tracked, as_of(batch_id), batch_id + 1, hk)

    return once(run)


def _publish_with_dimension(
    clean: BucketedTable, state: dict, dim: BucketedTable, delta: DataFrame, tracked: list[str], as_of: Column,
    version: int, hk: str,
) -> None:
    """Bring the dimension to the clean table's new state of the batch's keys, and publish both."""
    if not clean.log or clean.log != dim.log:
        raise ValueError("the clean table and its dimension need one log, to advance together")
    keys, spark = clean.keys, delta.sparkSession
    # a clean table that keeps tombstones closes the version of a deleted key
    soft = GONE in clean.schema.names
    current = clean.staged(spark, state).join(delta.select(*keys).distinct(), keys, "left_semi").select(
        *keys, *tracked, (F.col(GONE) if soft else F.lit(False)).alias(GONE)
    )

    def apply(old: DataFrame, new: DataFrame) -> DataFrame:
        images = new.select(F.when(F.col(GONE), "DELETE").otherwise("INSERT").alias("_action"), (~F.col(GONE)).alias("_is_update"), *keys, *tracked)
        return scd2_apply(old, images, keys, tracked, as_of, hk=hk)

    manifest.publish(spark, clean.log, version, {clean.path: state, dim.path: dim.stage(current, version, apply)})


def entity_batch(
    entity: Entity, clean: BucketedTable, dim: BucketedTable, rejects: str, as_of: Callable[[int], Column]
) -> Batch:
    """Batch function for an entity's landed rows: quarantine, clean table by the entity's own merge
    rules, dimension. Rows that cannot be merged go to ``rejects``, per batch, with their reason.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        valid, bad = layers.split_stage(batch, entity)
        bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
        delta = latest_per_key(layers.clean_rows(valid, entity).select(*clean.schema.names), entity.keys, [entity.modified])
        state = clean.stage(
            delta, batch_id + 1, lambda old, new: layers.merge_clean(old, new, entity, newer_only=True).table()
        )
        _publish_with_dimension(clean, state, dim, delta, entity.tracked, as_of(batch_id), batch_id + 1, entity.hk)

    return once(run)


def replace_batch(table: BucketedTable) -> Batch:
    """Batch function for an aggregate in update mode: a key's new value replaces the old one."""

    def run(batch: DataFrame, batch_id: int) -> None:
        table.upsert(
            batch.select(*table.schema.names), batch_id + 1,
            lambda old, new: merge(old, new, table.keys).table(),
        )

    return once(run)


def run_available(stream: DataFrame, batch: Batch, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything that has landed, batch by batch, and stop."""
    return (
        stream.writeStream.foreachBatch(batch).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
