"""Live KPIs: streamed order items keep the stored fact and the KPI state up to date.

A batch goes in three steps, each of which can be run again: the old and new fact rows of the
touched orders are written under the batch's number; the months they are in are written aside and put in place;
the state of the batch before, with these change rows applied, is written under the number. A batch
that died in between is repeated by Structured Streaming and comes to the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from plinth.operators.latest import latest_per_key
from plinth.operators.merge import merge
from plinth.plans import kpi_incremental
from plinth.plans.fact import FACT_KEYS
from plinth.plans.fact_store import MONTH, FactStore
from plinth.session import stored
from plinth.sources import manifest
from plinth.streaming.upsert import Batch, once


def state_path(root: str, version: int) -> str:
    return f"{root}/state={version}"


def latest_state(spark: SparkSession, root: str, schema: T.StructType, upto: int | None = None) -> DataFrame:
    """The KPI state after the newest batch, or after batch ``upto``; empty before the first one."""
    done = [int(n.split("=")[1]) for n in manifest.names(spark, root) if n.startswith("state=")]
    done = [v for v in done if (upto is None or v <= upto) and "_SUCCESS" in manifest.names(spark, state_path(root, v))]
    return spark.read.schema(schema).parquet(state_path(root, max(done))) if done else spark.createDataFrame([], schema)


def kpi_batch(store: FactStore, root: str, grain: list[str], state_schema: T.StructType, modified: str) -> Batch:
    """Batch function for fact rows of items, new or changed, with the column ``modified`` to tell which is newer.

    An item that comes again replaces its row unless it is older (the fact keeps ``modified``).
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        delta = latest_per_key(batch.select(*store.schema.names), FACT_KEYS, [modified])
        # the same orders as those of the delta, without finding its rows once more
        touched = stored(batch.select("order_id").distinct(), "live-touched")
        held = store.read(spark).drop(MONTH).join(touched, "order_id", "left_semi").select(*store.schema.names)
        rows = merge(held, delta, FACT_KEYS, newer_than=modified).table()
        changes = store.replace_orders(spark, rows, touched, f"{root}/changes={batch_id}")
        after = store.read(spark, kpi_incremental.touched_days(changes))
        before = latest_state(spark, root, state_schema, batch_id - 1)
        kpi_incremental.apply_changes(before, changes, after, grain).write.mode("overwrite").parquet(state_path(root, batch_id))

    return once(run)
