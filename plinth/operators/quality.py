"""Row-level quarantine and table-level integrity checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def wrong_delimiter(first: str, second: str, delimiter: str = "|") -> Column:
    """A row written with another delimiter lands whole in the first column."""
    return F.coalesce(F.col(first).contains(delimiter) & F.col(second).isNull(), F.lit(False))


def not_castable(c: str, dtype: str) -> Column:
    """Text is present but does not convert."""
    return F.col(c).isNotNull() & F.col(c).try_cast(dtype).isNull()


def broken(rules: dict[str, Column]) -> Column:
    """True when a row breaks at least one rule."""
    return reduce(lambda a, b: a | b, [F.coalesce(r, F.lit(False)) for r in rules.values()])


def reasons(rules: dict[str, Column]) -> Column:
    """Names of all broken rules, joined by ``;``."""
    return F.concat_ws(";", *[F.when(rule, F.lit(name)) for name, rule in rules.items()])


def split_rows(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the others with their ``_reason``. Both are plain filters over ``df``."""
    bad = broken(rules)
    return df.where(~bad), df.where(bad).withColumn("_reason", reasons(rules))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that survive a DELETE: where the condition is false or unknown."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def _per_column(row: DataFrame, names: list[str], value: str) -> DataFrame:
    """Turn a one-row table of per-column numbers into one row per column."""
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias(value)) for n in names])
    return row.select(F.inline(pairs))


def castability_report(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Per column, how many texts would not convert; one pass, before any merge."""
    row = df.agg(*[F.count_if(not_castable(c, t)).alias(c) for c, t in types.items()])
    return _per_column(row, list(types), "bad_rows")


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _per_column(row, cols, "null_rows")


def check_length(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    row = df.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()])
    return _per_column(row, list(limits), "too_long")


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    return counted.where(F.col("key_rows") > 1)


def check_fk(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign keys without a partner and how many rows carry them.

    The fact is reduced to one row per key before it is shuffled for the join, so a key that owns
    a third of the fact costs one row.
    """
    used = fact.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("orphan_rows"))
    return used.join(dim.select(F.col(pk).alias(fk)), fk, "left_anti")


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per layer with its number of rows."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def write_checked(
    df: DataFrame, path: str, *, not_null: list[str] = (), lengths: dict[str, int] | None = None,
    castable: dict[str, str] | None = None, rules: dict[str, Column] | None = None, mode: str = "append",
) -> dict[str, int]:
    """Write a table and return the counts of all checks, taken while it is written, in the same job.

    Keys: ``rows``, ``null <column>``, ``too long <column>``, ``not castable <column>`` and the names
    of ``rules`` (how many rows break them). Nothing is read a second time and nothing is shuffled:
    each task counts its rows, and the counts come back with the write. Checks that have to see all
    rows of a key together (:func:`check_unique`, :func:`check_fk`) need jobs of their own.
    """
    counts = {"rows": F.count(F.lit(1))}
    counts |= {f"null {c}": F.count_if(F.col(c).isNull()) for c in not_null}
    counts |= {f"too long {c}": F.count_if(F.length(c) > n) for c, n in (lengths or {}).items()}
    counts |= {f"not castable {c}": F.count_if(not_castable(c, t)) for c, t in (castable or {}).items()}
    counts |= {name: F.count_if(F.coalesce(rule, F.lit(False))) for name, rule in (rules or {}).items()}
    seen = Observation()
    df.observe(seen, *[count.alias(name) for name, count in counts.items()]).write.mode(mode).parquet(path)
    return seen.get


#: Buckets that :func:`reconcile` compares by their digests.
RECONCILE_BUCKETS = 4096


def reconcile(
    left: DataFrame, right: DataFrame, keys: list[str], compare: list[str], buckets: int = RECONCILE_BUCKETS
) -> DataFrame:
    """Keys in which two layers differ: the ``keys`` and ``difference`` (``lost``, ``added``, ``changed``).

    Keys are dealt to buckets by hash. A bucket's digest does not depend on the order of its rows:
    count, sum and xor of row hashes, which are partial aggregates, so one row for each bucket and
    task is shuffled. Rows are compared in buckets that differ only. A key that stands there several
    times counts as changed unless both layers hold the same rows. NULL keys are keys here.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))

    def digested(df: DataFrame, side: str) -> DataFrame:
        h = F.xxhash64(*keys, *compare)
        return df.groupBy(bucket.alias("_bucket")).agg(
            F.struct(F.count(F.lit(1)), F.sum(h.cast("decimal(20,0)")), F.bit_xor(h)).alias(f"_{side}")
        )

    # at most `buckets` rows
    differing = digested(left, "l").join(digested(right, "r"), "_bucket", "full_outer").where(~F.col("_l").eqNullSafe(F.col("_r"))).select("_bucket")

    def rows_of(df: DataFrame, sign: int) -> DataFrame:
        part = df.select(*keys, *compare, bucket.alias("_bucket")).join(F.broadcast(differing), "_bucket", "left_semi")
        return part.select(*keys, F.struct(*compare).alias("_row"), F.lit(sign).alias("_side"))

    both = rows_of(left, 1).unionByName(rows_of(right, -1))
    # equal rows cancel out; what is left of a key tells how it differs
    rest = both.groupBy(*keys, "_row").agg(F.sum("_side").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    per_key = rest.groupBy(*keys).agg(
        F.max((F.col("_n") != 0).cast("int")).alias("_differs"),
        F.sum(F.col("_n")).alias("_more"), F.sum(F.col("_rows")).alias("_rows"),
    ).where("_differs = 1")
    only = F.abs("_more") == F.col("_rows")  # all rows of the key are on one side
    difference = F.when(only & (F.col("_more") > 0), "lost").when(only, "added").otherwise("changed")
    return per_key.select(*keys, difference.alias("difference"))
