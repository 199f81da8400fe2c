"""Registered queries that take an entity the whole way: files, quarantine, clean table, dimension."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.operators.merge import Merged
from plinth.operators.scd2 import new_versions
from plinth.plans import entities as E
from plinth.plans import layers
from plinth.plans.queries import iso
from plinth.sources import given

Files = Callable[[SparkSession, str], tuple[DataFrame, DataFrame]]


def _loaded(spark: SparkSession, sf: str, entity: E.Entity, files: Files) -> tuple[DataFrame, Merged]:
    """The clean table of day 0, and day 1 merged into it; rows that do not convert stay out."""
    day_0, day_1 = (layers.clean_rows(layers.split_stage(f, entity)[0], entity) for f in files(spark, sf))
    return day_0, layers.merge_clean(day_0, day_1, entity)


def _dimension(day_0: DataFrame, changes: DataFrame, entity: E.Entity) -> DataFrame:
    dim = new_versions(day_0, entity.keys, entity.tracked, given.at(given.DAY_0), entity.hk, entity.hash_cols)
    return iso(layers.apply_dim(dim, changes, entity, given.at(given.DAY_1)))


def merge_customer_address(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses after day 1: new offices, new landmarks, owners as first loaded."""
    return iso(_loaded(spark, sf, E.CUSTOMER_ADDRESS, given.address_files)[1].table())


def merge_delivery_agent(spark: SparkSession, sf: str) -> DataFrame:
    """Agents after day 1: new ones, new ratings, names as first loaded."""
    return iso(_loaded(spark, sf, E.DELIVERY_AGENT, given.agent_files)[1].table())


def merge_delivery(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries after day 1, by delivery, order and agent."""
    return iso(_loaded(spark, sf, E.DELIVERY, given.delivery_files)[1].table())


def quarantine_entities(spark: SparkSession, sf: str) -> DataFrame:
    """What of day 1 cannot be merged, with its reason."""
    addresses = layers.split_stage(given.address_files(spark, sf)[1], E.CUSTOMER_ADDRESS)[1]
    deliveries = layers.split_stage(given.delivery_files(spark, sf)[1], E.DELIVERY)[1]
    return addresses.select(F.lit("customer_address").alias("entity"), F.col("addressid").alias("id"), "_reason").unionByName(
        deliveries.select(F.lit("delivery").alias("entity"), F.col("deliveryid").alias("id"), "_reason")
    )


def dim_restaurant(spark: SparkSession, sf: str) -> DataFrame:
    """All restaurants are sent again; only those whose attributes differ get a version."""
    day_0, merged = _loaded(spark, sf, E.RESTAURANT, given.restaurant_files)
    return _dimension(day_0, merged.changes(), E.RESTAURANT)


def _new_rows(changes: DataFrame) -> DataFrame:
    """What an append-only stream of a clean table delivers."""
    return changes.where((F.col("_action") == "INSERT") & ~F.col("_is_update"))


def dim_customer_address(spark: SparkSession, sf: str) -> DataFrame:
    """Fed by an append-only stream: offices appear, moved landmarks do not."""
    day_0, merged = _loaded(spark, sf, E.CUSTOMER_ADDRESS, given.address_files)
    return _dimension(day_0, _new_rows(merged.changes()), E.CUSTOMER_ADDRESS)


def dim_delivery_agent(spark: SparkSession, sf: str) -> DataFrame:
    """Fed by an append-only stream: new agents appear, new ratings do not."""
    day_0, merged = _loaded(spark, sf, E.DELIVERY_AGENT, given.agent_files)
    return _dimension(day_0, _new_rows(merged.changes()), E.DELIVERY_AGENT)


QUERIES = {
    "merge_customer_address": merge_customer_address,
    "merge_delivery_agent": merge_delivery_agent,
    "merge_delivery": merge_delivery,
    "quarantine_entities": quarantine_entities,
    "dim_restaurant": dim_restaurant,
    "dim_customer_address": dim_customer_address,
    "dim_delivery_agent": dim_delivery_agent,
}
