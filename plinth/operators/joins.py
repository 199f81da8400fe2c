"""Joins that hold up when one key owns a large share of the big side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def splits_skew(spark: SparkSession) -> bool:
    """Whether adaptive execution will split skewed join partitions in this session."""
    flags = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(spark.conf.get(f) == "true" for f in flags)


def heavy_keys(
    df: DataFrame, keys: list[list[str]], share: float = 0.01, tracked: int = 4096
) -> list[list[int]]:
    """For each join key, hashes of its values that hold more than ``share`` of the rows.

    One mergeable sketch per key in one scan of the key columns, which ends in a single row of at
    most ``1/share`` entries per key. A key the sketch overestimates is salted without need;
    results never depend on these lists.
    """
    k = int(1 / share)
    sketches = [
        F.expr(f"approx_top_k(xxhash64({', '.join(f'`{c}`' for c in on)}), {k}, {max(tracked, 2 * k)})")
        for on in keys
    ]
    row = df.agg(F.count(F.lit(1)), *sketches).first()
    return [[t["item"] for t in top or [] if t["count"] > share * row[0]] for top in row[1:]]


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", *,
    heavy: list[int], salts: int = 64, condition: Column | None = None,
) -> DataFrame:
    """Equi-join in which the ``heavy`` keys of ``left`` are spread over ``salts`` tasks.

    Only right rows with a heavy key are repeated, once per salt; all others join as usual. The
    salt depends on the row and its input partition, so a recomputed task salts alike.
    ``how`` may be inner, left, left_semi or left_anti (the repeated side is the right one).
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salting repeats the right side, so a {how} join would be wrong")
    if not heavy:
        return _join(left, right, on, how, condition)
    hot = F.xxhash64(*on).isin(heavy)
    spread = F.pmod(F.xxhash64(*left.columns, F.spark_partition_id()), F.lit(salts)).cast("int")
    salted_left = left.withColumn("_salt", F.when(hot, spread).otherwise(F.lit(0)))
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.withColumn("_salt", F.explode(copies))
    return _join(salted_left, salted_right, [*on, "_salt"], how, condition).drop("_salt")


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str, condition: Column | None) -> DataFrame:
    if condition is None:
        return left.join(right, on, how)
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    match = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_r_{c}") for c in on], condition)
    return left.join(renamed, match, how).drop(*[f"_r_{c}" for c in on])


def lookup_dim(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, hk: str, out: str, *,
    at: str | None = None, extra: list[str] | None = None, heavy: list[int] = (), how: str = "inner",
) -> DataFrame:
    """Add a dimension's hash key (and ``extra`` attributes) to fact rows.

    With ``at`` the version valid at that time is taken (``dim`` needs ``valid_from``), otherwise
    ``dim`` must hold one row per key. Spark broadcasts a dimension by its known size; larger ones
    are shuffled, with the given heavy keys salted. A fact row is checked against all versions of
    its key: a dimension fed by loads has one per load at most. For a dimension built from a raw
    log use :func:`plinth.operators.ordered.asof_join`, which forms no pairs.
    """
    cols = [F.col(dim_key).alias(fact_key), F.col(hk).alias(out)]
    cols += [F.col(c) for c in extra or []]
    condition = None
    if at:
        cols += [F.col("valid_from").alias("_from"), F.col("eff_end").alias("_until")]
        t = F.col(at)
        condition = (F.col("_from").isNull() | (t >= F.col("_from"))) & (
            F.col("_until").isNull() | (t < F.col("_until"))
        )
    joined = salted_join(facts, dim.select(*cols), [fact_key], how, heavy=list(heavy), condition=condition)
    return joined.drop("_from", "_until") if at else joined
