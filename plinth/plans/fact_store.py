"""The fact as plain Parquet, partitioned by order month and sorted by day inside.

A report on a period reads its months only, and inside them the row groups of its days; a batch
writes only the months in which it changes rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.plans.fact import Replaced, replace_orders
from plinth.session import new_dir, stored
from plinth.sources import manifest
from plinth.sources.bucketed import buckets_in_place, keys_may_deal_alone

MONTH, DAY, ORDER = "order_month", "order_date", "order_id"
#: Names the folder that says that all new months of a batch are written aside.
_READY = "_ready"


def month_of(day: str | Column) -> Column:
    return F.date_format(day, "yyyy-MM")


@dataclass(frozen=True)
class FactStore:
    """Fact rows with ``order_date`` at ``path``; ``schema`` is that of the rows.

    With ``buckets``, as many as a shuffle of the session has, the files of a month are buckets by order
    of Spark's own kind: rows that lie by order already are written where they are, and a batch meets
    the fact without moving it. This needs a catalog for names of its own.
    """

    path: str
    schema: T.StructType
    buckets: int = 0

    def create(self, rows: DataFrame) -> None:
        self._write(rows.select(*self.schema.names), self.path)

    def _write(self, rows: DataFrame, path: str, placed: DataFrame | None = None) -> None:
        """Write rows, and those of ``placed``, which are dealt already."""
        if self.buckets:
            dealt = rows.withColumn(MONTH, month_of(DAY)).repartition(self.buckets, ORDER)  # rows that lie so do not move
            both = dealt if placed is None else dealt.unionByName(placed)
            name = f"plinth_{uuid.uuid4().hex}"
            by_order = both.write.mode("overwrite").partitionBy(MONTH).bucketBy(self.buckets, ORDER).sortBy(DAY)
            by_order.option("compression", "zstd").option("path", path).saveAsTable(name)
            rows.sparkSession.sql(f"DROP TABLE {name}")  # the files stay
            return
        # days of a month lie together, so a day's rows are few row groups; adaptive execution splits large months
        dealt = rows.withColumn(MONTH, month_of(DAY)).repartition(MONTH)
        both = dealt if placed is None else dealt.unionByName(placed)
        both.sortWithinPartitions(MONTH, DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)

    def read(self, spark: SparkSession, days: list[date] | None = None) -> DataFrame:
        """All rows, or those of some days. The list has a day of the calendar once, so it stays short."""
        schema = T.StructType([*self.schema.fields, T.StructField(MONTH, T.StringType())])
        if days is not None and not days:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).parquet(self.path)
        if days is None:
            return rows
        return rows.where(F.col(MONTH).isin(sorted({f"{d:%Y-%m}" for d in days})) & F.col(DAY).isin(days))

    def of_period(self, spark: SparkSession, dates: DataFrame) -> DataFrame:
        """Rows of the days in ``dates`` (rows of the date dimension), joined to them.

        The months to read are found while the query runs, from the rows of the date dimension
        that its filters leave.
        """
        calendar = F.broadcast(dates.withColumn(MONTH, month_of("calendar_date")))  # one row per day
        return self.read(spark).join(calendar, [MONTH]).where(F.col(DAY) == F.col("calendar_date"))

    def replace_orders(self, spark: SparkSession, rows: DataFrame, touched: DataFrame, aside: str | None = None) -> DataFrame:
        """Make the rows of the ``touched`` orders exactly ``rows``, which are rows of these orders; returns the change rows.

        Only the months that hold a row of these orders, before or after, are read and written. Old
        and new images of the touched orders are written aside first: the change rows are read from
        there. The new months are written aside as well and then put in place one by one, so a batch
        that fails while it replaces months can be run again. With ``aside``, a path of its own for
        each batch, such a repetition goes by the images and months that are there already.
        """
        with self._in_place(spark) as table:
            if aside and "_SUCCESS" in manifest.names(spark, aside):
                return self._replace(spark, table, spark.read.parquet(aside), aside)
            replaced = self._images(table, rows, touched)
            if aside:
                replaced.write.mode("overwrite").parquet(aside)
                return self._replace(spark, table, spark.read.schema(replaced.schema).parquet(aside), aside)
            return self._replace(spark, table, stored(replaced, "fact-replaced"), new_dir(spark, "fact-replaced"))

    @contextmanager
    def _in_place(self, spark: SparkSession) -> Iterator[DataFrame]:
        """All rows with their month, to be joined by order; those of buckets stay where they are for it."""
        if not self.buckets:
            yield self.read(spark)
            return
        name = f"plinth_{uuid.uuid4().hex}"
        try:
            with keys_may_deal_alone(spark):
                yield buckets_in_place(spark, name, self.path, self.schema, T.StructField(MONTH, T.StringType()), [ORDER], self.buckets)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # its files are not its own

    def _images(self, table: DataFrame, rows: DataFrame, touched: DataFrame) -> DataFrame:
        """Old and new images of the touched orders, those without either as the touched orders they are."""
        touched = stored(touched.select("order_id").distinct(), "fact-touched")
        ids = touched.hint("shuffle_hash") if self.buckets else touched  # the fact need not be sorted for a few orders
        held = table.drop(MONTH).join(ids, "order_id", "left_semi").select(*self.schema.names)
        return replace_orders(held, rows.select(*self.schema.names), touched).rows

    def _replace(self, spark: SparkSession, table: DataFrame, images: DataFrame, aside: str) -> DataFrame:
        done = Replaced(images, self.schema.names, {})
        ready = f"{aside}-months"
        if _READY not in manifest.names(spark, ready):
            manifest.remove(spark, ready)
            sides = F.explode(F.filter(F.array("_old", "_new"), lambda side: side.isNotNull()))
            months = [r[0] for r in images.select(sides.alias("_row")).select(month_of(F.col("_row")[DAY])).distinct().collect()]  # of the calendar
            if None in months:
                raise ValueError("a fact row without a day is in no month and cannot be replaced")
            self._write(done.table(), ready, self._kept(table.where(F.col(MONTH).isin(months)), images.where("_old IS NOT NULL")))
            for month in set(months) - {n.split("=")[1] for n in manifest.names(spark, ready) if "=" in n}:
                manifest.folder(spark, f"{ready}/{MONTH}={month}")  # nothing is left in it
            manifest.folder(spark, f"{ready}/{_READY}")
        for name in manifest.names(spark, ready):
            if name.startswith(f"{MONTH}="):  # those put in place before are not there any more
                manifest.put(spark, f"{ready}/{name}", f"{self.path}/{name}")
        return done.changes()

    def _kept(self, part: DataFrame, old: DataFrame) -> DataFrame:
        """Rows of some months without those of orders that have an old image, dealt as they are written."""
        if self.buckets:
            ids = old.select(F.col("_old.order_id").alias("order_id")).distinct()
            return part.join(ids.hint("shuffle_hash"), "order_id", "left_anti").select(*self.schema.names, MONTH)
        # old images by their months: dealt like the rows of the months, so that what stays moves once
        gone = old.select(month_of(F.col("_old")[DAY]).alias(MONTH), F.col("_old.order_id").alias("order_id")).distinct()
        return part.repartition(MONTH).join(gone.repartition(MONTH), [MONTH, "order_id"], "left_anti").select(*self.schema.names, MONTH)
