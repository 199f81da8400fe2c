"""Tables stored as parquet by key bucket and version, so an upsert rewrites only what it touches.

``<path>/v=<version>/_bucket=<n>/`` holds a bucket as a batch wrote it; the log (by default
``<path>/log``) says which version of each bucket belongs to the table, or that the bucket is
empty. Readers go by the log alone, so a batch that died half way is never seen and is simply
written again.

In a table that is ``placed`` the files are buckets of Spark's own kind as well, sorted by the keys:
rows that lie by the keys already are written where they are, and an upsert reads a bucket as one
task instead of moving the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.sources import manifest

BUCKET = "_bucket"
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
Apply = Callable[[DataFrame, DataFrame], DataFrame]


def buckets_in_place(spark: SparkSession, name: str, path: str, schema: T.StructType, part: T.StructField, keys: list[str], buckets: int) -> DataFrame:
    """Files of Spark's own buckets below folders by ``part``, as table ``name``: one task reads a bucket."""
    place = path.replace("'", "\\'")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema.fields, part])
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{part.name}`) "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    spark.catalog.recoverPartitions(name)
    return spark.table(name)


@contextmanager
def keys_may_deal_alone(spark: SparkSession) -> Iterator[None]:
    """Joins on more columns than the rows are dealt by leave them where they are, on both sides."""
    before = spark.conf.get(_ALL_KEYS)
    spark.conf.set(_ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_ALL_KEYS, before)


@dataclass(frozen=True)
class BucketedTable:
    path: str
    schema: T.StructType
    keys: list[str]
    buckets: int
    log: str = ""  # tables that share one advance together
    placed: bool = False  # needs a catalog for names of its own; ``apply`` may only join or group, by the keys or more columns

    @property
    def _log(self) -> str:
        return self.log or f"{self.path}/log"

    def create(self, df: DataFrame) -> None:
        """Initial load, version 0."""
        state = self._written(self._dealt(df) if self.placed else df, 0, set(range(self.buckets)))
        manifest.publish(df.sparkSession, self._log, 0, {self.path: state})

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The whole table, by default as of the newest version."""
        return self._load(spark, self._state(spark, version))

    def upsert(self, delta: DataFrame, version: int, apply: Apply) -> None:
        """Write ``apply(current rows, delta)`` for the buckets in which ``delta`` has keys, and publish.

        Versions count up from 1; repeating one replaces what it wrote before.
        """
        manifest.publish(delta.sparkSession, self._log, version, {self.path: self.stage(delta, version, apply)})

    def stage(self, delta: DataFrame, version: int, apply: Apply) -> dict[int, int | None]:
        """As :meth:`upsert`, but nothing is published yet: returns the table's state for the log."""
        spark = delta.sparkSession
        touched = {r[0] for r in delta.select(self._bucket()).distinct().collect()}  # at most `buckets` ints
        before = self._state(spark, version - 1)
        held = {b: v for b, v in before.items() if b in touched}
        if not self.placed:
            return before | self._written(apply(self._load(spark, held), delta), version, touched)
        name = f"plinth_{uuid.uuid4().hex}"
        try:
            with keys_may_deal_alone(spark):
                return before | self._written(apply(self._in_place(spark, held, name), self._dealt(delta)), version, touched)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # its files are not its own

    def staged(self, spark: SparkSession, state: dict[int, int | None]) -> DataFrame:
        """The table in a state that :meth:`stage` returned."""
        return self._load(spark, state)

    def _state(self, spark: SparkSession, version: int | None) -> dict[int, int | None]:
        return manifest.latest(spark, self._log, version).get(self.path, {})

    def _bucket(self):
        hashed = F.hash if self.placed else F.xxhash64  # Spark deals rows by the first
        return F.pmod(hashed(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _dealt(self, df: DataFrame) -> DataFrame:
        """Rows by bucket, a task each; those that lie so already do not move."""
        return df.repartition(self.buckets, *self.keys)

    def _in_place(self, spark: SparkSession, state: dict[int, int | None], name: str) -> DataFrame:
        """Buckets as one task each: read so from one version (as table ``name``), dealt again from several."""
        versions = {v for v in state.values() if v is not None}
        if len(versions) != 1:
            return self._dealt(self._load(spark, state))
        kept = [b for b, v in state.items() if v is not None]
        rows = buckets_in_place(spark, name, f"{self.path}/v={versions.pop()}", self.schema, T.StructField(BUCKET, T.IntegerType()), self.keys, self.buckets)
        return rows.where(F.col(BUCKET).isin(kept)).select(*self.schema.names)

    def _written(self, df: DataFrame, version: int, touched: set[int]) -> dict[int, int | None]:
        # keys are unique and hashed, so buckets are even; a task gets one bucket, as its number is the task's
        folder = f"{self.path}/v={version}"
        rows = df.select(*self.schema.names, self._bucket())
        if self.placed:
            name = f"plinth_{uuid.uuid4().hex}"
            by_key = rows.write.mode("overwrite").partitionBy(BUCKET).bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
            by_key.option("compression", "zstd").option("path", folder).saveAsTable(name)
            df.sparkSession.sql(f"DROP TABLE {name}")  # the files stay
        else:
            rows.repartitionById(self.buckets, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        filled = {int(n.split("=")[1]) for n in manifest.names(df.sparkSession, folder) if n.startswith(f"{BUCKET}=")}
        return {b: version if b in filled else None for b in touched | filled}

    def _load(self, spark: SparkSession, state: dict[int, int | None]) -> DataFrame:
        paths = [f"{self.path}/v={v}/{BUCKET}={b}" for b, v in sorted(state.items()) if v is not None]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths).select(*self.schema.names)
