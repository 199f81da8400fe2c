"""Connected components of a graph given as a table of edges, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.skew import dealt_anew
from plinth.session import new_dir

#: Rounds after which the edges must have become stars; a path of n nodes needs about log2(n).
MAX_ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    """_u, m: each node and the smallest of it and its neighbours. One row per task and node leaves the scan."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return least.select(dealt_anew("u").alias("_u"), F.least("u", "m").alias("m"))


def _joined(edges: DataFrame) -> DataFrame:
    # adaptive execution splits the edges of a hub, as both sides of the join are shuffled for it
    return edges.join(_least(edges), F.col("u") == F.col("_u")).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _joined(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Expects u > v in every edge."""
    rows = _joined(edges)
    links = rows.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return links.unionByName(rows.select("u", F.col("m").alias("v"))).distinct()


def stars(edges: DataFrame) -> DataFrame:
    """u, v for every node that is not the smallest of its component: v is the smallest one.

    ``edges`` has two columns u, v of one integer type. Alternates the large-star and small-star
    steps; every round is written to the shared folder, so a lost executor costs one round.
    """
    spark = edges.sparkSession
    place = new_dir(spark, "components")

    def stored(df: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        path = f"{place}/{name}"
        df.write.parquet(path)
        found = spark.read.schema(edges.schema).parquet(path)
        state = found.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first()
        return found, tuple(state)

    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, state = stored(ordered, "0")
    if not state[0]:
        return now
    for k in range(1, MAX_ROUNDS + 1):
        after, reached = stored(_small_star(_large_star(now)), str(k))
        if reached == state:
            return after
        now, state = after, reached
    raise RuntimeError("components did not settle")
