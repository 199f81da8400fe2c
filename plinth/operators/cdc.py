"""Change rows between two states of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.operators.merge import any_differs, change_rows, fields, metadata_of, without_null_keys


def snapshot_diff(
    prev: DataFrame, curr: DataFrame, keys: list[str], compare: list[str] | None = None
) -> DataFrame:
    """Inserts, updates (two rows each) and deletes that lead from ``prev`` to ``curr``.

    Both sides hold one row per key. Rows equal in all ``compare`` columns (default: all) are
    dropped before anything is exploded. Rows with a NULL key take no part (``null_keys`` lists
    them); column metadata stays.
    """
    cols, metadata = curr.columns, metadata_of(curr, prev)
    prev, curr = without_null_keys(prev, keys), without_null_keys(curr, keys)
    old = prev.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.struct(*cols).alias("_old"))
    new = curr.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.struct(*cols).alias("_new"))
    on = reduce(lambda a, b: a & b, [F.col(f"_p_{k}") == F.col(f"_c_{k}") for k in keys])
    differing = old.join(new, on, "full_outer").where(
        F.col("_old").isNull()
        | F.col("_new").isNull()
        | any_differs("_old", "_new", compare or [c for c in cols if c not in keys])
    )
    exploded = differing.select(F.explode(change_rows(F.col("_old"), F.col("_new"))).alias("c"))
    return exploded.select("c._action", "c._is_update", *fields("c._row", cols, metadata))


def inserts_only(prev: DataFrame, curr: DataFrame, keys: list[str]) -> DataFrame:
    """Append-only view of the same step: rows whose key is new. Rows with a NULL key take no part."""
    added = without_null_keys(curr, keys).join(prev.select(*keys), keys, "left_anti").select(*curr.columns)
    return added.select(
        F.lit("INSERT").alias("_action"), F.lit(False).alias("_is_update"), *curr.columns
    )


def appended_since(df: DataFrame, position: str, consumed: Column | int) -> DataFrame:
    """Rows of an append-only table behind the last consumed position (load number or time)."""
    return df.where(F.col(position) > (consumed if isinstance(consumed, Column) else F.lit(consumed)))


def replay(prev: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Apply change rows to a table: drop every touched key, add the INSERT images."""
    touched = changes.select(*keys).distinct()
    kept = prev.join(touched, keys, "left_anti").select(*prev.columns)
    return kept.unionByName(changes.where(F.col("_action") == "INSERT").select(*prev.columns))


def net_changes(changes: DataFrame, keys: list[str], batch: str, compare: list[str] | None = None) -> DataFrame:
    """What several batches of change rows come to: as if the states before and after had been compared.

    Per key only the first old and the last new image count; a row that was inserted and deleted
    again vanishes, and so does one that ended as it began (in all ``compare`` columns, default:
    all). ``batch`` orders the batches; a batch has at most one DELETE and one INSERT of a key, in
    that order. Both images are partial aggregates, so a key with many changes sends one row per
    task. Rows with a NULL key take no part.
    """
    cols = [c for c in changes.columns if c not in ("_action", "_is_update", batch)]
    inserted = F.col("_action") == "INSERT"
    place, image = F.struct(F.col(batch), inserted), F.struct(*cols)
    folded = without_null_keys(changes, keys).groupBy(*keys).agg(
        # structs of their own, as min_by and max_by skip nothing: an image may be missing
        F.min_by(F.struct(F.when(~inserted, image).alias("v")), place).alias("_first"),
        F.max_by(F.struct(F.when(inserted, image).alias("v")), place).alias("_last"),
    ).select(F.col("_first.v").alias("_old"), F.col("_last.v").alias("_new"))
    differing = folded.where(
        (F.col("_old").isNull() != F.col("_new").isNull())
        | (F.col("_old").isNotNull() & F.col("_new").isNotNull() & any_differs("_old", "_new", compare or [c for c in cols if c not in keys]))
    )
    exploded = differing.select(F.explode(change_rows(F.col("_old"), F.col("_new"))).alias("c"))
    return exploded.select("c._action", "c._is_update", *fields("c._row", cols, metadata_of(changes)))


def changes_of_log(log: DataFrame, keys: list[str], order_by: list[str], gone: Column) -> DataFrame:
    """Change rows of a log of states, each with the log's columns; ``gone`` marks rows that delete their key.

    The state before a row is the row before it, if that was not a deletion.
    """
    before = Window.partitionBy(*keys).orderBy(*order_by)
    image = F.struct(*log.columns)
    stepped = without_null_keys(log, keys).select(
        image.alias("_row"), F.when(~gone, image).alias("_new"), F.lag(F.struct(F.when(~gone, image).alias("v"))).over(before)["v"].alias("_old"),
    )
    known, stays = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def row(action: str, is_update: Column, of: str) -> Column:
        # a deleted image carries the place of the change that deletes it
        values = [F.col("_row")[c].alias(c) if c in order_by else F.col(of)[c].alias(c) for c in log.columns]
        return F.struct(F.lit(action).alias("_action"), is_update.alias("_is_update"), F.struct(*values).alias("_row"))

    rows = F.when(known & stays, F.array(row("DELETE", F.lit(True), "_old"), row("INSERT", F.lit(True), "_new"))).when(
        stays, F.array(row("INSERT", F.lit(False), "_new"))
    ).when(known, F.array(row("DELETE", F.lit(False), "_old")))
    exploded = stepped.select(F.explode(rows).alias("c"))
    return exploded.select("c._action", "c._is_update", *fields("c._row", log.columns, metadata_of(log)))
