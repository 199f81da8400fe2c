"""One row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plinth.operators.joins import heavy_keys


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Keep each key's newest row; ties fall to the remaining columns, so the order is total.

    Spark plans the rank filter as a group limit on both sides of the shuffle: every map task
    sends at most one row per key, so a key that holds a third of the table stays cheap.
    """
    tiebreak = [c for c in df.columns if c not in keys and c not in order_by]
    newest = [F.col(c).desc_nulls_last() for c in [*order_by, *tiebreak]]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def latest_by(df: DataFrame, keys: list[str], order_by: list[str], by: str, partitions: int) -> DataFrame:
    """:func:`latest_per_key` whose rows leave in ``partitions`` by one of the keys, after one shuffle.

    No group limit comes before that shuffle, so the rows of keys that a sketch finds to hold more
    than a hundredth of the table are ranked by themselves first.
    """
    [hot] = heavy_keys(df, [keys])
    if hot:
        often = F.xxhash64(*keys).isin(hot)
        df = df.where(~often).unionByName(latest_per_key(df.where(often), keys, order_by))
    return latest_per_key(df.repartition(partitions, by), keys, order_by)


def single_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Pass the table through, failing the query when a key occurs more than once."""
    rest = [c for c in df.columns if c not in keys]
    row = F.max(F.struct(*rest)) if rest else F.lit(True)
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), row.alias("_row"))
    checked = F.when(
        F.col("_n") > 1, F.raise_error(F.lit(f"several source rows for one key ({', '.join(keys)})"))
    ).otherwise(F.col("_row"))
    out = grouped.select(*keys, checked.alias("_row"))
    return out.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)
